"""Operator 12 against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import divergence_skyband as ds


def plain(rows, least=3, top=200):
    """``rows``: text, lang, source."""
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang, source in groups:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def p(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // (n + len(kept)) for t in kept}

        own, whole = p(counts[lang, source]), p(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        pairs = []
        for other in sources:
            if other != source:
                q = p(counts[lang, other])
                pairs.append((-sum(f(own[t], q[t]) for t in kept), other.encode(), other))
        terms = [(-f(own[t], whole[t]), t.encode(), t) for t in kept if counts[lang, source][t] and own[t] > whole[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return sorted(out)


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeÄé日ß") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s1", "s2", "ß", "", None, "z"])
        some = words[len(source or "") * 13 + ord((source or "a")[0]) % 20 :][:80]
        rows.append((" ".join(rng.choice([w, w.upper(), w + "9", w + "_"]) for w in rng.choices(some, k=rng.randint(0, 60))), rng.choice(["en", "en", "de", None]), source))
    return rows + [(None, "en", "only"), ("once", "fr", "x"), ("", "fr", None), ("rare words here", "xx", "a"), ("others there", "xx", "b")] + rows[:3] * 2


@pytest.mark.parametrize(("least", "top"), [(3, 200), (3, 4), (1, 1)])
def test_divergence_equals_plain_counting(spark, monkeypatch, least, top):
    monkeypatch.setattr(ds, "FLUSH", 300)
    monkeypatch.setattr(ds, "HELD", 100)
    monkeypatch.setattr(ds, "PIECE", 20)
    rows = texts(3)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "text STRING, lang STRING, source STRING, term STRING, size STRING, rank INT").repartition(5)
    assert sorted(map(tuple, ds.divergence(df, least=least, top=top).collect())) == plain(rows, least, top)


def test_awkward_documents(spark):
    rows = documents(n=60)
    got = ds.divergence(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == plain([(r[1], r[2], r[3]) for r in rows])
    assert ds.divergence(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("grid", [2, 16, 256])
@pytest.mark.parametrize("k", [1, 3, 200])
def test_skyband_keeps_what_fewer_than_k_dominate(monkeypatch, k, grid):
    monkeypatch.setattr(ds, "GRID", grid)
    monkeypatch.setattr(ds, "STEP", 50)
    rng = np.random.default_rng(k)
    n, total = rng.integers(1, 12, 700), rng.integers(1, 40, 700)
    terms = [bytes(rng.integers(97, 123, 5).tolist()) for _ in range(700)]
    got = set(ds.skyband(n, total, pa.array(terms), k).tolist())
    key = [(t, i) for i, t in enumerate(terms)]
    above = [sum(n[j] >= n[i] and total[j] <= total[i] and key[j] <= key[i] for j in range(700) if j != i) for i in range(700)]
    assert got == {i for i in range(700) if above[i] < k}
    assert len(ds.skyband(np.zeros(0, int), np.zeros(0, int), pa.array([], pa.string()), k)) == 0


def test_counts_beyond_long_products(spark):
    # Ten thousand million occurrences: the product with the scale needs more than 63 bits.
    df = spark.createDataFrame([(10**10, 4 * 10**10, 7)], "n BIGINT, size BIGINT, terms BIGINT")
    from pyspark.sql import functions as F

    assert df.select(ds.share(F.col("n"), F.col("size"), F.col("terms"))).first()[0] == 1 + 10**9 * (10**10 + 1) // (4 * 10**10 + 7)
