"""Operators 1 and 8 against plain Python."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import block_tables, segment_popcount
from tidemark.llm.common import components

BLANK = re.compile("[\x20\x09-\x0d]+")


def plain_print(text):
    words = [w for w in BLANK.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, linked):
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for i in range(n):
            for j in range(n):
                if linked(i, j):
                    root[i] = root[j] = min(root[i], root[j])
        if before == root:
            return root
    return root


def plain_components(ids, prints, bits):
    root = roots(len(ids), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= bits)
    lowest = {r: min((x for x, y in zip(ids, root) if y == r and x is not None), default=None) for r in set(root)}
    return [lowest[r] for r in root]


def test_near_duplicates_equal_brute_force(spark):
    rows = documents()
    got = segment_popcount.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [plain_print(r[1]) for r in rows]
    wanted = zip([r[0] for r in rows], [f"{p:016x}" for p in prints], plain_components([r[0] for r in rows], prints, 3))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_close_pairs_lose_none(spark, bits):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = {p - (p >> 63 << 64) for p in prints}
    got = segment_popcount.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp BIGINT"), bits).collect()
    wanted = {(min(a, b), max(a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert {(min(r), max(r)) for r in got} == wanted
    with pytest.raises(ValueError):
        segment_popcount.close_pairs(spark.createDataFrame([(1,)], "fp BIGINT"), 4)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert segment_popcount.near_duplicates(none).collect() == []
    assert block_tables.edited_fingerprints(none).collect() == []
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300), (None, 5)]
    got = dict(components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect())
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}


def plain_edited(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for r, after in zip(ordered, ordered[1:] + ordered[:1]):
        text = r[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + (after[1] or "")[:half]
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after[1] or ""))
    return out


@pytest.mark.parametrize("span_bits", [2, 12])
def test_edited_texts(spark, monkeypatch, span_bits):
    monkeypatch.setattr(block_tables, "SPAN_BITS", span_bits)
    rows = documents()
    got = block_tables.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    wanted = plain_edited(rows)
    assert sorted(map(repr, [tuple(r[:3]) for r in got])) == sorted(map(repr, [w[:3] for w in wanted]))
    prints, rest = {}, []
    for w in wanted:
        mine = [r for r in got if r[0] == w[0] and r[2] == w[2] and r[1] == w[1]]
        assert mine
        for r in mine:
            assert prints.setdefault(w[3], r.fingerprint) == r.fingerprint
        rest.append((mine[0], w))
    bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    for r, w in rest:
        assert r.near_edited == bits(r.fingerprint, r.edited_fingerprint)
        if w[0] is not None and w[0] % 3 == 0 and w[0] > 0:
            assert r.near_next == bits(r.fingerprint, prints[w[5]])
    assert prints[""] == "0" * 32


@pytest.mark.parametrize("step", [1, 1000, 2**40])
def test_sparse_ids_make_few_spans(spark, monkeypatch, step):
    monkeypatch.setattr(block_tables, "SPAN_BITS", 4)
    rng = random.Random(step)
    ids = rng.sample(range(-300 * step, 300 * step), 400) if step > 1 else list(range(-200, 200))
    docs = spark.createDataFrame([(i, f"text of {i}") for i in ids] + [(None, "none")], "doc_id BIGINT, text STRING")
    rows = block_tables.with_next(docs).where("not extra").collect()
    assert len({r.span for r in rows}) < 80
    order = sorted(ids, reverse=True)
    wanted = dict(zip(order, [f"text of {i}" for i in order[1:]] + ["none"]))
    assert {r.doc_id: r.next_text for r in rows if r.doc_id is not None} == wanted
    assert [r.next_text for r in rows if r.doc_id is None] == [f"text of {order[0]}"]


def test_fingerprint_counts_votes(spark):
    text = "a b a b c"
    df = spark.createDataFrame([(text,)], "t STRING")
    hashes = [r[0] for r in df.select(F.explode(block_tables.term_hashes(F.col("t")))).collect()]
    assert len(hashes) == 5 and hashes[0] == hashes[2]
    row = block_tables.fingerprint_columns(df.withColumn("k", F.lit(1)), ["k"], ["t"]).first()
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 5)
    assert row.hi_0 & (2**64 - 1) == wanted


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_block_tables_find_each_pair_once(spark, radius):
    rng = random.Random(radius)
    prints = {rng.getrandbits(128) for _ in range(20)} | {0, 2**128 - 1}
    for p in list(prints):
        for _ in range(8):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(128), rng.randint(1, 8))))
    signed = lambda x: x - (x >> 63 << 64)
    rows = {(signed(p >> 64), signed(p & (2**64 - 1))): p for p in prints}
    got = block_tables.near_pairs(spark.createDataFrame(list(rows), "hi BIGINT, lo BIGINT"), radius).collect()
    pairs = [(rows[r[0], r[1]], rows[r[2], r[3]], r[4]) for r in got]
    found = sorted((min(a, b), max(a, b), n) for a, b, n in pairs)
    assert found == sorted((a, b, (a ^ b).bit_count()) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius)


def test_count_near_adds_copies(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, 0), (4, -1, -1)], "id INT, hi BIGINT, lo BIGINT")
    assert {r.id: r.n_near for r in block_tables.count_near(df).collect()} == {1: 2, 2: 2, 3: 2, 4: 0}
