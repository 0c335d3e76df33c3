"""Operator 7: the lexicon automaton against edit distances, quotation, and held-out accuracy."""

import math
import random
import time

import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_find_equals_edit_distance():
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 9))) for _ in range(12)]
    stems = ["bbbb", "cacac"]
    lexicon = tx.Lexicon(tuple((w, False, 2.0) for w in dict.fromkeys(words)) + tuple((s, True, 1.5) for s in stems), frozenset({"abcabc"}))
    for _ in range(4000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 10)))
        stem = 1.5 if any(word.startswith(s) for s in stems) else 0.0
        exact = word in words
        near = word not in lexicon.clean and any(len(w) >= tx.FUZZY_FROM and distance(w, word) == 1 for w in words)
        wanted = (2.0, False) if exact else (stem, False) if stem else (2.0, True) if near else (0.0, False)
        assert lexicon.find(word) == wanted, word


def test_quoted_and_near_hits_are_told_apart():
    lexicon = tx.Lexicon((("idiot", False, 3.0), ("moronic", False, 3.0)))
    plain, quoted, near = (tx.features(t, lexicon, {}) for t in ("you idiot there", 'he said "you idiot there" to me', "you morronic person"))
    assert plain[1] > 0 == plain[2] == plain[3]
    assert quoted[2] > 0 == quoted[1]
    assert near[3] > 0 == near[1]
    crowd, alone = tx.features("idiot idiot idiot", lexicon, {}), tx.features("idiot" + " word" * 40 + " idiot" + " word" * 40 + " idiot", lexicon, {})
    assert crowd[4] > alone[4]


def test_every_row_is_scored(spark):
    rows = documents()
    labels = spark.createDataFrame([(r[0], 1 if r[0] % 2 else 0) for r in rows if r[0] is not None] + [(None, 1), (5000, 1), (3, None)], "doc_id BIGINT, toxic INT")
    docs = spark.createDataFrame(rows, SCHEMA)
    got = tx.with_scores(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert tx.with_scores(docs.where("1 = 0"), labels).collect() == []
    none = tx.with_scores(docs, labels.where("1 = 0")).collect()
    assert {r.predicted for r in none} == {0}


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_held_out_accuracy(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = tx.with_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    bad, good = ([r.score for r in rows if r.toxic == x] for x in (1, 0))
    assert sum((x > y) + 0.5 * (x == y) for x in bad for y in good) / len(bad) / len(good) > 0.96
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97


def test_the_densest_window_of_a_long_text_is_found():
    lexicon = tx.Lexicon((("idiot", False, 3.0),))
    text = "idiot" + " word" * 5 + " idiot" + " word" * 5 + " idiot" + (" word" * 20 + " idiot") * 2000
    assert tx.features(text, lexicon, {})[4] == pytest.approx(math.log(1 + 3))


def plain_features(text, lexicon):
    words = tx._WORD.findall(text.lower())
    parts = tx._PART.findall(text.lower())
    hits, marks, at = [], [], 0
    for part in parts:
        if part in tx._MARKS:
            marks.append(at)
        else:
            weight, near = lexicon.find(part)
            if weight:
                hits.append((at, weight, near))
            at += 1
    sums = [0.0, 0.0, 0.0]
    for place, weight, near in hits:
        before = any(place - tx.WINDOW <= m <= place for m in marks)
        after = any(place < m <= place + tx.WINDOW + 1 for m in marks)
        sums[1 if before and after else 2 if near else 0] += weight
    close = max((sum(abs(p - q) <= tx.WINDOW for q, _, _ in hits) for p, _, _ in hits), default=0)
    share = 100 * len(hits) / len(words) if words else 0
    return [1.0, *map(math.log1p, sums), math.log1p(close), math.log1p(share), math.log(1 + len(words)) / 10]


def test_features_equal_plain_counting():
    rng = random.Random(9)
    lexicon = tx.Lexicon((("idiot", False, 3.0), ("moronic", False, 2.0), ("scum", True, 4.0)), frozenset({"moronix"}))
    pool = ["idiot", "moronic", "moroni", "moronix", "scumbag", "word", "a", '"', "“", "”", "«", ",", "Über"]
    for _ in range(400):
        text = " ".join(rng.choices(pool, [1, 1, 1, 1, 1, 9, 9, 2, 1, 1, 1, 3, 3], k=rng.randint(0, 120)))
        assert tx.features(text, lexicon, {}) == pytest.approx(plain_features(text, lexicon))


def test_many_quoted_hits_take_little_time():
    lexicon = tx.Lexicon((("idiot", False, 3.0),))
    start = time.perf_counter()
    found = tx.features('he said "idiot" and ' * 100_000, lexicon, {})
    assert time.perf_counter() - start < 2 and found[2] > 0 == found[1]


def test_the_sample_is_that_of_the_lowest_hashes(spark):
    rows = [(i, f"text {i}", 1 if i % 7 == 0 else 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    got = tx.labelled_sample(df, df, "doc_id", "text", "toxic", each=50).collect()
    lots = {r.doc_id: r.h for r in df.selectExpr("doc_id", "xxhash64('toxic', doc_id) h").collect()}
    for label in (0, 1):
        wanted = sorted((i for i, _, x in rows if x == label), key=lots.__getitem__)[:50]
        assert sorted(r.id for r in got if r.toxic == label) == sorted(wanted)


def test_all_terms_that_pass_are_entries(spark):
    words = [f"{a}{b}{c}qq" for a in "bcdfghklmn" for b in "aeiou" for c in "prstvwxyz"]
    rows = [(i, " ".join(words), 1) for i in range(40)] + [(i, "harmless text", 0) for i in range(40, 120)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    model = tx.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {e[0] for e in model["entries"] if not e[1]} == set(words)


def test_longer_stems_use_no_entries_and_no_near_miss_is_dropped(spark):
    letters = "cefghijklmnpqstuvy"
    near = {x for c in letters for x in (f"{c}adwordx", f"b{c}dwordx", f"ba{c}wordx", f"{c}badwordx", f"b{c}adwordx", f"ba{c}dwordx")}
    rows = [(i, "badwordx zzzzqq", 1) for i in range(40)] + [(i, " ".join(sorted(near)), 0) for i in range(40, 120)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    model = tx.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {e[:2] for e in model["entries"]} == {("badw", True), ("badwordx", False), ("zzzz", True), ("zzzzqq", False)}
    assert model["clean"] == near
