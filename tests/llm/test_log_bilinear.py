"""Operator 6: base scores against plain Python, a normalised model, and a gain on held-out text."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import log_bilinear as lb


def tokens(text):
    return (text or "").encode().lower().split() + [b" "]


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


@pytest.mark.parametrize("frequent", [400_000, 20])
def test_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lb, "FREQUENT", frequent)
    monkeypatch.setattr(lb, "STEPS", 20)
    rows = documents()
    got = lb.with_scores(spark.createDataFrame(rows, SCHEMA)).collect()
    counts = Counter(w for r in rows if trains(r[0]) for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for r in rows:
        words = tokens(r[1])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        wanted.append((str(r[0]), not trains(r[0]), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == sorted(wanted)
    assert all(r.score < 0 for r in got)


def test_probabilities_of_all_words_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(lb, "STEPS", 20)
    monkeypatch.setattr(lb, "TOP_WORDS", 5)
    monkeypatch.setattr(lb, "ENDINGS", 4)
    texts = spark.createDataFrame([(r[1],) for r in documents(n=15)], "text STRING")
    model, counts = lb.learn(texts)
    vocabulary = {bytes(r.word): r.n for r in counts.collect()}
    size = model.classes.size
    table = 10.0 ** lb.log_probabilities(np.frombuffer(model.params), size).astype(float).reshape(size, size, size)
    assert table.sum(axis=2) == pytest.approx(1, abs=1e-4)
    # A context, then each word of the vocabulary, or one never seen in each class that takes such words.
    unseen = [b"qqqq"] + [b"qqqq" + e for e in model.classes.endings]
    heads = [w for w in vocabulary if w != b" "][:3]
    for head in heads:
        total = 0.0
        for word in [w for w in vocabulary if w != b" "] + unseen:
            codes, begins, words = lb.numbered([head + b" " + word])
            triple = lb.class_triples(codes, begins, words, model.classes)[1]
            own = triple % size
            share = (vocabulary.get(word, 0) + 0.1) / (10 ** model.shares[own] * 10**model.log_total)
            total += table.reshape(-1)[triple] * share
        end = lb.class_triples(*lb.numbered([head]), model.classes)[1]
        assert total + table.reshape(-1)[end] == pytest.approx(1, abs=1e-3)


def test_held_out_text_gains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lb.with_scores(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.97 * sum(r.base_score for r in rows)
    assert sum(r.score for r in rows) / sum(r.n_tokens for r in rows) > sum(r.base_score for r in rows) / sum(r.n_tokens for r in rows) + 0.1


def test_tokens_are_numbered_as_split():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice([*" \t\n\x0b\x1c\x85", "a", "B", "é", "\u3000", "日"], rng.integers(0, 40))).encode() for _ in range(300)] + [b"", b" ", b"\n\n"]
    codes, begins, words = lb.numbered(texts)
    found = [words[i].as_py() for i in codes]
    wanted = [w for t in texts for w in tokens(t.decode())]
    assert found == wanted and begins.tolist() == np.cumsum([0] + [len(tokens(t.decode())) for t in texts])[:-1].tolist()


def test_triples_of_runs_are_summed(spark, monkeypatch):
    texts = [(r[1],) for r in documents()]
    df = spark.createDataFrame(texts, "text STRING").coalesce(2)
    classes = lb.Classes((b"a", b"two"), (b"aa", b"bb"))
    whole = {r.triple: r.n for r in lb.triple_counts(df, classes).collect()}
    monkeypatch.setattr(lb, "HELD_TRIPLES", 50)
    assert {r.triple: r.n for r in lb.triple_counts(df, classes).collect()} == whole
    assert sum(whole.values()) == sum(len(tokens(t)) for (t,) in texts)


def test_a_worker_holds_one_table_of_pairs():
    size = 1500
    params = np.random.default_rng(3).normal(0, 0.3, 2 * size * lb.WIDTH + 2 * lb.WIDTH + size)
    tracemalloc.start()
    ready = lb.scorer(params, size)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 4.5 * size * size and most < 13 * size * size
    context, target, scale, bias = lb._parts(params, size)
    triples = np.random.default_rng(4).integers(0, size, (50, 3)) % (size - 1)
    for (first, second, own), got in zip(triples, lb.log_probability(ready, (triples[:, 0] * size + triples[:, 1]) * size + triples[:, 2])):
        p = np.exp(target @ (context[first] * scale[0] + context[second] * scale[1]) + bias)[: size - 1]
        assert got == pytest.approx(np.log10(p[own] / p.sum()), abs=1e-4)


def test_empty_tables(spark):
    assert lb.with_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = lb.with_scores(spark.createDataFrame([(None, "a b")], "doc_id BIGINT, text STRING")).collect()
    assert [tuple(r[:5]) for r in rows] == [(None, True, 3, 0, 0)]
    assert rows[0].base_score == pytest.approx(0, abs=1e-9)


def test_noise_contrastive_steps_learn_a_rule():
    size = 6
    triples = np.array([(a * size + b) * size + (b + 1) % 4 for a in range(4) for b in range(4)])
    n = np.ones(len(triples), np.int64)
    classes = lb.Classes((b"a", b"b", b"c"), ())
    assert classes.size == size
    start = lb.initial(classes, np.ones(size - 1))
    noise = np.full(size, 1 / size)
    after = lb.nce_steps(start, size, triples, n, noise, 400, 1)
    before, now = (10.0 ** lb.log_probabilities(p, size)[triples].astype(float) for p in (start, after))
    assert now.mean() > 0.8 > before.mean()


def test_a_pass_takes_every_triple_with_its_whole_count():
    n = np.array([1] * 5000 + [10**9, 3])
    order, weights = lb.shares_of(n, 1000, np.random.default_rng(1))
    assert np.bincount(order, weights, len(n)) == pytest.approx(n)
    assert len(order) <= len(n) + 1000 and weights.max() <= n.sum() / 1000
    # A triple that one in 10**9 draws would meet leaves its mark on its own context's vector.
    size = 8
    triples = np.array([(1 * size + 1) * size + 2, (4 * size + 5) * size + 3])
    start = lb.initial(lb.Classes((b"a", b"b", b"c", b"d", b"e"), ()), np.ones(size - 1))
    after = lb.nce_steps(start, size, triples, np.array([10**9, 1]), np.full(size, 1 / size), 2, 1)
    moved = (lb._parts(after, size)[0] != lb._parts(start, size)[0]).any(axis=1)
    assert moved.tolist() == [i in (1, 4, 5) for i in range(size)]


def test_steps_tasks_and_top_words_grow(spark, monkeypatch):
    monkeypatch.setattr(lb, "STEPS", 2)
    monkeypatch.setattr(lb, "ROUNDS", 1)
    monkeypatch.setattr(lb, "TOP_WORDS", 5)
    texts = spark.createDataFrame([(" ".join(f"w{i * j % 997}" for j in range(300)),) for i in range(1, 40)], "text STRING")
    model, counts = lb.learn(texts)
    assert len(model.classes.words) == int(counts.count() ** 0.5) > 5


def test_scores_equal_the_plain_softmax():
    size, rng = 7, np.random.default_rng(5)
    params = rng.normal(0, 1, 2 * size * lb.WIDTH + 2 * lb.WIDTH + size)
    context, target, scale, bias = lb._parts(params, size)
    table = lb.log_probabilities(params, size).reshape(size, size, size)
    for first in range(size):
        for second in range(size):
            p = np.exp(target @ (context[first] * scale[0] + context[second] * scale[1]) + bias)[: size - 1]
            assert table[first, second, : size - 1] == pytest.approx(np.log10(p / p.sum()), abs=1e-4)
