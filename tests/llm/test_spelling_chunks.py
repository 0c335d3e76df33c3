"""Operator 11 against all pairs."""

import random
import zlib
from collections import Counter

import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import spelling_chunks as sc

LETTERS = {*"abcdefghijklmnopqrstuvwxyz", *map(chr, range(0xC0, 0x100))}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) > len(b) + 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def plain_counts(rows, every=199):
    n = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if c in LETTERS else " " for c in low).split():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6}


def plain_forms(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(((-n[v], v) for v in near[w] if n[v] >= 5 * n[w]), default=None)
        form[w] = best and best[1]

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def vocabulary(seed, letters="abé", lengths=(6, 9), size=300):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(size)}
    return {w: rng.choice([1, 2, 5, 9, 30, 200, 2000]) for w in words}


def collected(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_forms_equal_all_pairs(spark, seed):
    n = vocabulary(seed)
    df = spark.createDataFrame([*n.items(), (None, 3)], "word STRING, n BIGINT")
    assert collected(sc.with_forms(df)) == plain_forms(n)


@pytest.mark.parametrize("crowd", [0, 1, 8, 10**9])
def test_crowded_chunks_lose_no_pair(spark, crowd):
    # Half of the words share their first half, a third their second.
    rng = random.Random(7)
    n = {("shared" if i % 2 else "".join(rng.choice("xyz") for _ in range(6))) + ("ending" if i % 3 == 0 else "".join(rng.choice("pq") for _ in range(rng.randint(5, 7)))): 1 for i in range(400)}
    df = spark.createDataFrame(list(n.items()), "word STRING, n BIGINT")
    got = sc.near_words(df, crowd).collect()
    assert sorted((r.a, r.b) for r in got) == sorted((a, b) for a in n for b in n if one_edit(a, b) and (len(a), a) > (len(b), b))


def test_candidates_stay_in_proportion_to_the_words(spark):
    # 1,296 words that share their first half and most of the rest: the square would be 1.7 million pairs.
    words = ["sharedprefix" + a + b + "zz" + c + d for a in "abcdef" for b in "abcdef" for c in "abcdef" for d in "abcdef"]
    df = spark.createDataFrame([(w, 1) for w in words], "word STRING, n BIGINT")
    pairs = sc.near_words(df)
    assert pairs.count() == 1296 * 4 * 5 // 2


def test_words_of_documents(spark):
    rows = [(r[0], r[1]) for r in documents(n=60)]
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdefghàÿ") for _ in range(rng.randint(5, 12))) for _ in range(60)]
    rows += [(1000 + i, " ".join(rng.choice([w, w.upper(), w.title(), w + "×", w + "Āx"]) for w in rng.choices(names, k=400))) for i in range(30)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "doc_id BIGINT, text STRING, word STRING, n STRING, size STRING")
    counts = plain_counts(rows)
    assert {r.word: r.n for r in sc.word_counts(df).collect()} == counts
    assert collected(sc.variants(df)) == plain_forms({w: c for w, c in counts.items() if c >= 5})


def test_empty_tables(spark):
    assert sc.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert sc.variants(spark.createDataFrame([(1, None), (None, ""), (2, "short 123")], "doc_id BIGINT, text STRING")).collect() == []
