"""Packing documents into sequences along a space-filling curve.

A document's tokens are hashed into a vector, projected to a few dimensions and placed on a Hilbert curve. Documents
are range-sorted along the curve, and each range is cut into sequences without gaps, so a sequence holds neighbours
on the curve. The last sequence of a range is cut into powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tidemark.llm.common import runs_of, utf8

SEQUENCE = 2048
END_ID = 1
DIMENSIONS, DEPTH = 4, 11
FEATURES = 1024
TIE_BITS = 19
RANGES, SAMPLED = 4, 24  # ranges per partition, and documents sampled per range to make them about equal


class Encoder:
    """Token ids as the ``tokenizers`` file gives them.

    The rank file holds the same vocabulary for a faster library. A text is cut at the special tokens that ``tokenizers``
    names, which stand for their own ids; ones that take blanks beside them along are refused.
    """

    def __init__(self, vocabulary: str, ranks: str):
        added = Tokenizer.from_file(vocabulary).get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("special tokens that depend on what stands beside them are not supported")
        self.special = {t.content: i for i, t in added.items()}
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        table = {token: i for token, i in table.items() if i not in added}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=self.special)

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.special):
            found = self.fast.encode(text, allowed_special="all")
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END_ID], dtype="<u4")


@cache
def _encoder(vocabulary: str, ranks: str) -> Encoder:
    return Encoder(vocabulary, ranks)


@cache
def _projection() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((FEATURES, DIMENSIONS))


def document_vector(ids: np.ndarray) -> np.ndarray:
    """Counts of hashed token ids, scaled to length 1."""
    counts = np.bincount((ids.astype(np.uint64) * 2654435761 >> 16) % FEATURES, minlength=FEATURES).astype(float)
    return counts / np.sqrt(counts @ counts)


def hilbert_key(cells: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, dimensions) with coordinates below ``2 ** depth``.

    Each level of the curve is a copy of the curve reflected and with its axes exchanged; the two loops undo both
    from the top level down, after which a Gray code over the interleaved bits is the place.
    """
    axes = [x.astype(np.int64) for x in cells.T]
    for level in range(depth - 1, 0, -1):
        bit = 1 << level
        low = bit - 1
        for d, own in enumerate(axes):
            inside = (own & bit) != 0
            swap = np.where(inside, 0, (axes[0] ^ own) & low)
            flip = np.where(inside, low, 0)
            axes[0] = axes[0] ^ flip ^ swap
            if d:
                axes[d] = own ^ swap
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros_like(axes[0])
    for level in range(depth - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(depth - 1, -1, -1):
        for own in axes:
            key = key << 1 | ((own ^ turn) >> level & 1)
    return key


def curve_keys(vectors: list[np.ndarray]) -> np.ndarray:
    along = np.array(vectors) @ _projection()
    return hilbert_key(((np.tanh(along / 2) + 1) / 2 * ((1 << DEPTH) - 1)).astype(np.int64))


def tokenized(docs: DataFrame, doc_id: str, text: str, vocabulary: str, ranks: str, bounds: tuple = ()) -> DataFrame:
    """``id, place, range, ids``: place on the curve (ties spread by a hash of id and tokens), its rank among ``bounds``, the ids' bytes."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    schema = StructType([rows.schema["id"], *StructType().add("place", "long").add("range", "integer").add("ids", "binary").fields])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, ranks)
        for batch in batches:
            texts, names = utf8(batch.column(1)), batch.column(0)
            for begin, end in runs_of(texts):
                ids = [encoder.ids(t.decode()) for t in texts[begin:end]]
                keys = curve_keys([document_vector(x) for x in ids])
                packed = [_narrow(x) for x in ids]
                tie = [xxhash.xxh32_intdigest(f"{name}|".encode() + x[:64]) >> (32 - TIE_BITS) for name, x in zip(names.slice(begin, end - begin).to_pylist(), packed, strict=True)]
                places = keys << TIE_BITS | np.array(tie, np.int64)
                rank = np.searchsorted(np.array(bounds, np.int64), places, side="right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([names.slice(begin, end - begin), pa.array(places), pa.array(rank), pa.array(packed, pa.binary())], names=schema.names)

    return rows.mapInArrow(step, schema)


def _narrow(ids: np.ndarray) -> bytes:
    """Ids in two bytes each if all fit; the first byte tells."""
    return b"\2" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\4" + ids.tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


class Packer:
    """Cuts a run of documents into full sequences; ``close`` cuts what is left into powers of two."""

    def __init__(self, first: int, sequence: int = SEQUENCE):
        self.sequence, self.full = first, sequence
        self.held: list[tuple[int, int, np.ndarray]] = []  # row, start, ids
        self.room = sequence
        self.pieces: list[tuple[int, int, int, int, int, int]] = []  # row, start, length, crc32, sequence, offset

    def _put(self, row: int, start: int, ids: np.ndarray, offset: int) -> None:
        self.pieces.append((row, start, len(ids), zlib.crc32(ids.tobytes()), self.sequence, offset))

    def _flush(self, size: int) -> None:
        """The first ``size`` held ids become a sequence."""
        offset, rest = 0, []
        for row, start, ids in self.held:
            if fits := min(len(ids), size - offset):
                self._put(row, start, ids[:fits], offset)
            if fits < len(ids):
                rest.append((row, start + fits, ids[fits:]))
            offset += fits
        self.held, self.sequence = rest, self.sequence + 1

    def add(self, row: int, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.room]
            self.held.append((row, start, part))
            self.room -= len(part)
            start += len(part)
            if not self.room:
                self._flush(self.full)
                self.room = self.full

    def close(self) -> None:
        left = self.full - self.room
        while left:
            size = 1 << (left.bit_length() - 1)
            self._flush(size)
            left -= size


def even_bounds(sampled: list[tuple[int, int]], ranges: int) -> tuple[int, ...]:
    """Places that cut ``(place, size)`` into ranges of about equal size together: long documents are alike, so they lie close."""
    if not sampled:
        return ()
    places, sizes = np.array(sorted(sampled), np.int64).T
    at = np.searchsorted(np.cumsum(sizes), sizes.sum() * np.arange(1, ranges) / ranges)
    return tuple(sorted(set(places[np.minimum(at, len(places) - 1)].tolist())))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, ranks: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: ``<doc_id>, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its token ids and then id 1; a null text is an empty one, so each row of ``docs`` gives at
    least one piece. Pieces of a sequence fill it from offset 0 without gaps. Sequences have ``sequence`` ids, but
    for the last ones of a range, whose lengths are powers of two. Repeated rows are packed each; ids may be null
    or repeat. An empty table gives no pieces. Ranges are found on a sample of ``SAMPLED`` documents a range,
    which bears on how even they are and on nothing else; equal documents differ in their tie, so they are split too.
    """
    vocabulary = vocabulary or str(public_tokenizers.path("byte_bpe_50k.json"))
    ranks = ranks or str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges, rows = RANGES * partitions, docs.count()
    few = docs.select(doc_id, text).sample(min(1.0, SAMPLED * ranges / max(1, rows)), 5)
    bounds = even_bounds([tuple(r) for r in tokenized(few, doc_id, text, vocabulary, ranks).select("place", F.octet_length("ids")).collect()], ranges)
    tokens = tokenized(docs, doc_id, text, vocabulary, ranks, bounds)
    # Neighbouring ranges share a partition, and each partition has as many.
    by_range = F.floor(F.col("range") / RANGES).cast("int")
    placed = tokens.repartitionById(partitions, by_range).sortWithinPartitions("range", "place", "id", "ids")
    schema = StructType([placed.schema["id"], *StructType().add("start", "long").add("length", "long").add("ids_crc32", "long").add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long").fields])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, rows, count = Packer(TaskContext.get().partitionId() << 40, sequence), {}, 0  # rows: id and tokens, as long as they are held

        def out() -> pa.RecordBatch:
            row, start, length, crc, seq, offset = zip(*packer.pieces, strict=True)
            arrays = [pa.array([rows[r][0] for r in row], schema_id), *[pa.array(x, pa.int64()) for x in (start, length, crc, [rows[r][1] for r in row], seq, offset)]]
            packer.pieces.clear()
            for done in set(rows) - {r for r, _, _ in packer.held}:
                del rows[done]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        schema_id = None
        for batch in batches:
            schema_id = batch.schema.field("id").type
            for name, data in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids = _wide(data)
                rows[count] = (name, len(ids))
                packer.add(count, ids)
                count += 1
            if packer.pieces:
                yield out()
        packer.close()
        if packer.pieces:
            yield out()

    return placed.mapInArrow(step, schema).withColumnRenamed("id", doc_id)

