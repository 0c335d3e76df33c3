"""Near-duplicates by SimHash, found through bit counts of segments.

A text's fingerprint is taken over its word shingles. Segments of two bits are each mapped to their number
of ones; the Manhattan distance of two such vectors never exceeds the Hamming distance of the fingerprints. Within
three bits, one half of the vector is therefore equal or differs by one in one segment, so the join is an equality
on grid cells: a half vector meets itself and its neighbours one step up. With short segments few fingerprints share a
cell: of two at random one pair in 6.6 million shares that of a half. The full Manhattan distance and then the
exact Hamming distance are conditions of the join, so candidates that fail are never rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_text_columns, components, written

SHINGLE = 3
SEED = 42
MAX_BITS = 3

SEGMENT = 2  # bits
_ALL = (1 << SEGMENT) - 1

# The ones of a segment, pushed to the low end: equal counts give equal codes, and codes differ in as many bits as counts.
_PUSHED = [(1 << bin(i).count("1")) - 1 for i in range(1 << SEGMENT)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    begins = [0, *ends[: len(words) - shingle]] if len(words) >= shingle else [0]
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    votes, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, len(ends), step):
        hashes = [xxhash.xxh64_intdigest(joined[b : e - 1], SEED) for b, e in zip(begins[at : at + step], ends[at : at + step], strict=True)]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with ``text`` replaced by its fingerprint as a (signed) long. A null text has the fingerprint 0."""

    def values(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))]

    return add_text_columns(docs, text, f"{name} BIGINT", values)


def _pushed(fp: Column) -> Column:
    table = F.array(*[F.lit(x).cast("bigint") for x in _PUSHED])
    code = F.lit(0).cast("bigint")
    for at in range(0, 64, SEGMENT):
        ones = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit(_ALL)).cast("int")
        code = code.bitwiseOR(F.shiftleft(F.element_at(table, ones + 1), at))
    return code


def _cell(half: Column, side: int) -> Column:
    return half.bitwiseOR(F.lit(side << 32))


def close_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs ``a, b`` of the distinct fingerprints in ``fp`` that differ in 1 to ``max_bits`` (0 to 3) bits, once or twice each.

    Rows grow with the fingerprints (2 and 34 a fingerprint) and with the pairs found, not with the candidates.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("max_bits must be 0 to 3: a half vector is then equal or one step away")
    coded = prints.select("fp", _pushed(F.col("fp")).alias("code"))
    low, high = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("code", 32)
    own = F.array(_cell(low, 0), _cell(high, 1))
    up = []
    for side, half in enumerate((low, high)):
        for at in range(0, 32, SEGMENT):
            ones = F.shiftright(half, at).bitwiseAND(F.lit(_ALL))
            up.append(F.when(ones != _ALL, _cell(half + F.shiftleft(ones + 1, at), side)))
    left = coded.select(F.col("fp").alias("a"), F.col("code").alias("code_a"), F.explode(own).alias("cell"))
    stay = coded.select(F.col("fp").alias("b"), F.col("code").alias("code_b"), F.lit(False).alias("up"), F.explode(own).alias("cell"))
    step = coded.select(F.col("fp").alias("b"), F.col("code").alias("code_b"), F.lit(True).alias("up"), F.explode(F.array(*up)).alias("cell"))
    right = stay.unionByName(step.where("cell is not null"))
    near = (
        (left["cell"] == right["cell"])
        & (F.col("up") | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (F.col("a") != F.col("b"))
    )
    return left.join(right, near).select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``<doc_id>, fingerprint`` (16 hex digits) ``, component_id``.

    Texts whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the smallest id
    reachable by links. Null and blank texts have the fingerprint 0 and are linked like others. Repeated rows and
    ids stay. A null id is never a component id; where a component has no other, its ``component_id`` is null.
    An empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    prints = written(fingerprints(rows, "body"), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(close_pairs(classes, max_bits))
    own = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    own = written(own, "classes")
    firsts = own.groupBy("root").agg(F.min("first").alias("component_id"))
    named = own.join(firsts, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
