"""Operator 5: exact round trip, no padding, and the curve."""

import itertools
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import curve_packing


@pytest.mark.parametrize(("dimensions", "depth"), [(2, 4), (3, 2), (4, 2)])
def test_curve_visits_each_neighbour(dimensions, depth):
    cells = np.array(list(itertools.product(range(1 << depth), repeat=dimensions)))
    keys = curve_packing.hilbert_key(cells, depth)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def slow():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def test_ids_equal_the_tokenizer():
    encoder = curve_packing.Encoder(*(str(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("json", "tiktoken")))
    texts = [r[1] or "" for r in documents()] + ["a<|endoftext|>b", " \n\n x\t\ty  ", "don't I'll 'S 123,456 ½ ²   z", "é" * 500, "‍👩‍👩‍👧 \r\n\r\n", "\x00\x1f\x7f"]
    for text in texts:
        assert encoder.ids(text).tolist() == [*slow().encode(text, add_special_tokens=False).ids, 1]


def test_special_tokens_stand_for_themselves():
    encoder = curve_packing.Encoder(*(str(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("json", "tiktoken")))
    special, rng, tokenizer = list(encoder.special), np.random.default_rng(3), slow()
    assert special
    pool = [*special, special[0][:-1], special[0][1:], " ", "  ", "\n", "a", "don't", "x<", "|>", "é", ""]
    for _ in range(500):
        text = "".join(rng.choice(pool, rng.integers(0, 12)))
        assert encoder.ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text
    start = time.perf_counter()
    for i in range(1000):
        encoder.ids(f"some text {i} {special[0]} and more of it " * 5)
    assert time.perf_counter() - start < 1


def test_ranges_are_dealt_out_evenly_and_in_order(spark):
    rows = [(i, f"word{i % 97} text{i % 89} number {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    pieces = curve_packing.pack(docs, sequence=64).selectExpr("sequence_id >> 40 as part", "length")
    sizes = {r.part: r.n for r in pieces.groupBy("part").sum("length").toDF("part", "n").collect()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(sizes) == set(range(partitions)) and max(sizes.values()) < 2 * min(sizes.values())


def test_ranges_are_even_by_size():
    rng = np.random.default_rng(4)
    # A tenth of the documents are a hundred times as long, and lie together.
    sampled = [(int(rng.integers(0, 1000)), 10) for _ in range(900)] + [(int(rng.integers(400, 420)), 1000) for _ in range(100)]
    bounds = curve_packing.even_bounds(sampled, 16)
    sizes = np.bincount(np.searchsorted(bounds, [p for p, _ in sampled], side="right"), [n for _, n in sampled])
    assert sizes.max() < 3 * sizes.sum() / 16
    assert curve_packing.even_bounds([], 8) == () and curve_packing.even_bounds([(5, 9)], 8) == (5,)


@pytest.mark.parametrize("sequence", [2048, 64])
def test_round_trip(spark, sequence):
    rows = documents()
    got = curve_packing.pack(spark.createDataFrame(rows, SCHEMA), sequence=sequence).collect()
    tokenizer, wanted = slow(), defaultdict(list)
    for r in rows:
        wanted[r[0]].append(tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (1,))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end == sequence or end & (end - 1) == 0 and end < sequence
    assert set(pieces) == set(wanted)
    for doc_id, texts in wanted.items():
        assert sum(r.length for r in pieces[doc_id]) == sum(map(len, texts))
        for r in pieces[doc_id]:
            assert any(r.doc_tokens == len(t) and r.ids_crc32 == zlib.crc32(np.array(t[r.start : r.start + r.length], "<u4").tobytes()) for t in texts)
        if len(texts) == 1:
            ordered = sorted(pieces[doc_id], key=lambda r: r.start)
            assert [r.start for r in ordered] == [0, *np.cumsum([r.length for r in ordered])[:-1]]


def test_empty_table(spark):
    assert curve_packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_like_documents_are_neighbours():
    texts = ["the cat sat on the mat and the dog " * 20, "der hund und die katze schlafen heute " * 20]
    tokenizer = slow()
    ids = [np.array(tokenizer.encode(t[i:], add_special_tokens=False).ids, "<u4") for t in texts for i in (0, 8, 16)]
    keys = curve_packing.curve_keys([curve_packing.document_vector(x) for x in ids])
    order = np.argsort(keys) // 3
    assert (np.diff(order) != 0).sum() == 1
