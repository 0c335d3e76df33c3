"""Exact removal of repeated passages by induced suffix sorting.

Every byte string of ``width`` bytes that also starts earlier in the corpus is found, and the bytes it covers are
removed. Suffixes are sharded so that equal strings meet: a string belongs to its anchor, the smallest hash of the
shorter grams within it, and neighbouring strings mostly share one. Segments (all strings of one anchor in one place)
whose anchor occurs once need no sorting; segments that are equal throughout are settled by their first place. What is
left, different segments around the same anchor, is sorted exactly: each shard is a text of its own, whose suffixes
are put in order by induced sorting. Suffixes that descend to the right of a smaller neighbour are sorted first, by
their names; all others are induced from them, smallest first and then largest first, through queues in order of the
leading byte. The queues are kept in files once they exceed a bound; the text of a shard and its arrays are in memory.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import free_name, utf8, written

WIDTH = 100
GRAM = 32
CHUNK = 1 << 18  # bytes that are hashed at once
HELD = 1 << 20  # queued positions that a shard keeps in memory; the rest is in files
SHARDS = 4  # shards per shuffle partition
_BASE = 0x9E3779B97F4A7C15
_LAST = (1 << 63) - 1


class Spool:
    """A first-in, first-out queue of positions per leading symbol, in a file beyond ``held`` entries in all.

    Symbols are taken in order, so together the queues are a priority queue by (symbol, time of entry).
    """

    def __init__(self, symbols: int, held: int = HELD):
        self.queues: list[list] = [[] for _ in range(symbols)]
        self.held, self.count, self.file = held, 0, None

    def push(self, symbols: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(symbols, kind="stable")
        symbols, values = symbols[order], values[order]
        if not len(symbols):
            return
        cuts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        for begin, end in zip(cuts, [*cuts[1:], len(symbols)], strict=True):
            part = values[begin:end]
            if self.count + len(part) > self.held:
                self.file = self.file or tempfile.TemporaryFile()
                self.file.seek(0, 2)
                self.queues[symbols[begin]].append((self.file.tell(), len(part)))
                part.astype(np.int64).tofile(self.file)
            else:
                self.count += len(part)
                self.queues[symbols[begin]].append(part)

    def pop(self, symbol: int) -> np.ndarray:
        """All that has been queued for the symbol."""
        parts, self.queues[symbol] = self.queues[symbol], []
        out = []
        for part in parts:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.fromfile(self.file, np.int64, part[1])
            else:
                self.count -= len(part)
            out.append(part)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _types(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the next one; the last place is the smallest symbol."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    nearest = np.full(n, n - 1)
    nearest[differs] = differs
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    inner = nearest < n - 1
    smaller[inner] = text[nearest[inner]] < text[nearest[inner] + 1]
    tail = ~inner
    tail[-1] = False
    smaller[tail] = False
    return smaller


def _induced(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int, held: int) -> Iterator[np.ndarray]:
    """All suffixes in order, as batches from the last to the first, induced from the ordered ``seeds``."""
    seed_from = np.searchsorted(text[seeds], np.arange(symbols + 1))
    up, larger = Spool(symbols, held), Spool(symbols, held)

    def push_larger(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[~smaller[before]]
        up.push(text[before], before)

    for symbol in range(symbols):
        while len(batch := up.pop(symbol)):
            larger.push(np.full(len(batch), symbol), batch)
            push_larger(batch)
        push_larger(seeds[seed_from[symbol] : seed_from[symbol + 1]])
    up.close()
    down = Spool(symbols, held)

    def push_smaller(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[smaller[before]]
        down.push(text[before], before)

    down.push(text[-1:], np.array([len(text) - 1]))  # nothing stands after the end to induce it
    for symbol in range(symbols - 1, -1, -1):
        while len(batch := down.pop(symbol)):
            push_smaller(batch)
            yield batch
        batch = larger.pop(symbol)[::-1]
        push_smaller(batch)
        if len(batch):
            yield batch
    down.close()
    larger.close()


def suffix_order(text: np.ndarray, depth: int, symbols: int = 258, held: int = HELD) -> Iterator[np.ndarray]:
    """Places of all suffixes, ordered by their first ``depth`` symbols, in batches from the largest to the smallest.

    ``text`` ends with the symbol 0, which is nowhere else.
    """
    smaller = _types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(lms):
        lms = np.array([len(text) - 1])
    # First by the leading symbol alone: one round of induction then orders the substrings between such places.
    rough = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    found = [b[is_lms[b]] for b in _induced(text, smaller, rough, symbols, held)]
    ordered = np.concatenate(found)[::-1]
    # Equal substrings get the same name; names are then ordered by what follows, doubling the reach each time.
    number = np.empty(len(text), np.int64)
    number[lms] = np.arange(len(lms))
    after = np.r_[lms[1:], len(text) - 1]
    size = after - lms + 1
    a, b = ordered[:-1], ordered[1:]
    same = size[number[a]] == size[number[b]]
    open_, k = np.flatnonzero(same), 0
    while len(open_):
        differ = text[a[open_] + k] != text[b[open_] + k]
        same[open_[differ]] = False
        k += 1
        open_ = open_[~differ & (k < size[number[a[open_]]])]
    rank = np.empty(len(lms), np.int64)
    rank[number[ordered]] = np.r_[0, np.cumsum(~same)]
    reach, m = 1, len(lms)
    while reach <= depth and rank.max() + 1 < m:
        second = np.full(m, -1)
        second[: max(0, m - reach)] = rank[reach:]
        order = np.lexsort((second, rank))
        x, y = rank[order], second[order]
        rank = np.empty(m, np.int64)
        rank[order] = np.r_[0, np.cumsum((x[1:] != x[:-1]) | (y[1:] != y[:-1]))]
        reach *= 2
    yield from _induced(text, smaller, lms[np.argsort(rank, kind="stable")], symbols, held)


def repeated(segments: list[bytes], width: int = WIDTH, held: int = HELD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of equal windows: arrays ``group, place``; places count bytes of the joined segments, each with one sign after it.

    Only groups with two windows or more; a window doesn't leave its segment. Groups come whole, some at a time.
    """
    if not segments:
        return
    text = np.frombuffer(b"".join(s + b"\0" for s in segments) + b"\0", np.uint8).astype(np.int16)
    ends = np.cumsum([len(s) + 1 for s in segments]) - 1
    text += 2
    text[ends], text[-1] = 1, 0
    room = np.zeros(len(text), np.int64)
    begin = 0
    for end in ends:
        room[begin : end + 1] = np.arange(end - begin, -1, -1)
        begin = end + 1
    carried, group = np.zeros(0, np.int64), 0
    for batch in suffix_order(text, width, held=held):
        batch = batch[room[batch] >= width]
        batch = np.r_[carried, batch]
        if len(batch) < 2:
            carried = batch
            continue
        a, b = batch[:-1], batch[1:]
        alike = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        for k in range(width):  # the common prefix of neighbours, up to the width
            open_ = open_[text[a[open_] + k] == text[b[open_] + k]]
            if not len(open_):
                break
        alike[:] = False
        alike[open_] = True
        number = np.r_[0, np.cumsum(~alike)]
        last = number == number[-1]
        counts = np.bincount(number)
        keep = (counts[number] > 1) & ~last
        if keep.any():
            yield group + number[keep], batch[keep]
        group += int(number[-1])
        carried = batch[last]
    if len(carried) > 1:
        yield np.full(len(carried), group), carried


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + WIDTH + 8
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, np.uint64(_BASE))], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)], dtype=np.uint64)
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def anchors(pieces: list[tuple[int, int, bytes]], width: int, gram: int) -> list[np.ndarray]:
    """Segments of ``(text, offset, bytes)`` pieces: arrays ``text, begin, span, key, content``.

    A segment is ``span + 1`` neighbouring windows from ``begin`` that share an anchor; ``key`` is the anchor's
    hash, ``content`` one of all its bytes and of the anchor's place in them.
    """
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    up, down = _powers()
    n, steps = len(data), width - gram + 1
    if n < width:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    sizes = np.array([len(p[2]) for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), sizes)
    begins = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)]
        grams = _mixed((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    place = np.uint64(CHUNK * 2 - 1)
    ranked = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(ranked) // steps) * steps, np.uint64(2**64 - 1))
    padded[: len(ranked)] = ranked
    rows = padded.reshape(-1, steps)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    least = np.minimum(right[:windows], left[steps - 1 : steps - 1 + windows])
    anchor = (least & place).astype(np.int64)
    inside = owner[:windows] == owner[width - 1 :]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:windows] != owner[: windows - 1])]
    first = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.r_[new[1:], True] & inside)
    # Within a piece the windows inside it are neighbours, so each first has its stop.
    last_inside = np.flatnonzero(inside & np.r_[~inside[1:], True])
    stop = np.union1d(stop, last_inside)
    span = stop - first
    with np.errstate(over="ignore"):
        content = (total[stop + width] - total[first]) * down[first]
        content = _mixed(content + _mixed((anchor[first] - first).astype(np.uint64) * np.uint64(4096) + span.astype(np.uint64)))
    which = owner[first]
    texts = np.array([p[0] for p in pieces])[which]
    offset = np.array([p[1] for p in pieces])[which] + first - begins[which]
    return [texts, offset, span, grams[anchor[first]], content]


def _pieces(texts: list[bytes], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts, long ones in overlapping parts, in groups of at most ``CHUNK`` bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text) < width:
            continue
        step = CHUNK - width + 1
        for at in range(0, max(1, len(text) - width + 1), step):
            part = text[at : at + CHUNK]
            if size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


_SEGMENT = "key BIGINT, content BIGINT, a BIGINT, b INT, begin BIGINT, span INT, known BOOLEAN"


def _segments(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """Segments of ``a, b, body``; ``known`` ones have an earlier equal segment in the same batch, and their key is arbitrary."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for pieces in _pieces(utf8(batch.column(2)), width):
                text, begin, span, key, content = anchors(pieces, width, gram)
                a, b = ids[0][text], ids[1][text]
                order = np.lexsort((begin, b, a, content, key))
                key, content, a, b, begin, span = (x[order] for x in (key, content, a, b, begin, span))
                known = np.r_[False, (key[1:] == key[:-1]) & (content[1:] == content[:-1])] if len(key) else np.zeros(0, bool)
                key = np.where(known, _mixed(a.astype(np.uint64) + begin.astype(np.uint64)), key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(a), pa.array(b), pa.array(begin), pa.array(span.astype(np.int32)), pa.array(known)],
                    names=["key", "content", "a", "b", "begin", "span", "known"],
                )

    return rows.mapInArrow(step, _SEGMENT)


def _met_again(segments: DataFrame) -> DataFrame:
    """Of segments sorted by key, the known ones and those whose key has another row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.RecordBatch | None = None
        before = None
        for batch in batches:
            if carried is not None:
                batch = pa.Table.from_batches([carried, batch]).combine_chunks().to_batches()[0]
            key, known = batch.column("key").to_numpy(), batch.column("known").to_numpy(zero_copy_only=False)
            same = key[1:] == key[:-1]
            again = np.r_[key[:1] == before if before is not None else [False], same] | np.r_[same, False] | known
            carried = batch.slice(batch.num_rows - 1) if not again[-1] else None
            again[-1] = again[-1] and carried is None
            before = key[-1] if carried is None else (key[-2] if len(key) > 1 else before)
            if again.any():
                yield batch.filter(pa.array(again))
        # A row that was carried to the end met no equal key.

    return segments.mapInArrow(step, segments.schema)


def _bits(rows: DataFrame) -> tuple[int, bytes]:
    """A bitmap of hashed ``a, b``, of 16 bits a row and 16 MB at most: rows whose bit is not set are surely absent."""
    size = 1 << min(27, max(15, (16 * rows.count()).bit_length()))
    at = F.pmod(F.xxhash64("a", "b"), F.lit(size))
    parts = rows.select(at.alias("at")).groupBy(F.floor(F.col("at") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(32768)).cast("bigint")).alias("bits"))
    out = bytearray(size // 8)
    for r in parts.collect():
        out[r.part * 4096 : (r.part + 1) * 4096] = r.bits
    return size, bytes(out)


def _filtered(rows: DataFrame, bitmap: tuple[int, bytes], present: bool) -> DataFrame:
    """Rows whose bit is set, or the others."""
    size, bits = bitmap
    at = free_name(rows, "at")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            found = (table[place >> 3] >> (place & 7) & 1).astype(bool)
            yield batch.filter(pa.array(found == present))

    placed = rows.withColumn(at, F.pmod(F.xxhash64("a", "b"), F.lit(size)))
    return placed.mapInArrow(step, placed.schema).drop(at)


def _fetched(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``key, a, b, begin, bytes`` of the wanted segments; only texts that hold one are shuffled."""
    lists = wanted.groupBy("a", "b").agg(F.collect_list(F.struct("key", "begin", "span")).alias("parts"))
    joined = _filtered(rows, _bits(lists.select("a", "b")), True).join(lists, ["a", "b"])
    part = F.explode("parts").alias("p")
    body = joined.select("a", "b", F.col("body").cast("binary").alias("body"), part)
    return body.select("p.key", "a", "b", "p.begin", F.substring("body", (F.col("p.begin") + 1).cast("int"), F.col("p.span") + width).alias("bytes"))


def _sorted_out(fetched: DataFrame, width: int, held: int) -> DataFrame:
    """Spans ``a, b, begin, stop`` of windows that also start earlier, by induced sorting of each shard."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, begin, segments = [], [], [], []
        for batch in batches:
            a.append(batch.column("a").to_numpy())
            b.append(batch.column("b").to_numpy())
            begin.append(batch.column("begin").to_numpy())
            segments += batch.column("bytes").to_pylist()
        if not segments:
            return
        a, b, begin = (np.concatenate(x) for x in (a, b, begin))
        base = np.cumsum([len(s) + 1 for s in segments]) - np.array([len(s) + 1 for s in segments])
        late = []
        for group, place in repeated(segments, width, held):
            own = np.searchsorted(base, place, side="right") - 1
            order = np.lexsort((begin[own] + place - base[own], b[own], a[own], group))
            late.append(place[order][np.r_[False, group[order][1:] == group[order][:-1]]])
        if not late:
            return
        place = np.sort(np.concatenate(late))
        own = np.searchsorted(base, place, side="right") - 1
        new = np.r_[True, (np.diff(place) != 1) | (np.diff(own) != 0)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(place)] - 1
        own, start = own[first], (begin[own] + place - base[own])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[own]), pa.array(b[own]), pa.array(start[first]), pa.array(start[last] + width)], names=["a", "b", "begin", "stop"]
        )

    shards = SHARDS * int(fetched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fetched.repartition(shards, "key").mapInArrow(step, "a BIGINT, b INT, begin BIGINT, stop BIGINT")


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` in which two columns ``a, b`` give the order of documents: by id, null ids last, equal ids by text."""
    a = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    if docs.select(a.alias("a")).groupBy("a").count().where("count > 1").isEmpty():
        return docs.withColumns({"a": a, "b": F.lit(0)})
    within = Window.partitionBy("a").orderBy(F.col(doc_id).isNull(), F.coalesce(F.col(text), F.lit("")))
    return written(docs.withColumn("a", a).withColumn("b", F.row_number().over(within)), "numbered")


def repeated_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, held: int = HELD) -> DataFrame:
    """``a, b, spans``: per text of ``a, b, body`` with a repeated window, the spans that such windows cover (they may overlap)."""
    segments = _segments(rows, width, gram)
    met = written(_met_again(segments.repartition("key").sortWithinPartitions("key")), "met")
    open_ = met.where("not known")
    place = F.struct("a", "b", "begin")
    firsts = open_.groupBy("key", "content").agg(F.min(place).alias("first"), F.first("span").alias("span"))
    firsts = written(firsts, "firsts")
    later = open_.join(firsts.select("key", "content", "first"), ["key", "content"]).where(place != F.col("first"))
    whole = met.where("known").select("a", "b", "begin", "span").unionByName(later.select("a", "b", "begin", "span"))
    whole = whole.select("a", "b", "begin", (F.col("begin") + F.col("span") + width).alias("stop"))
    mixed = firsts.groupBy("key").count().where("count > 1").select("key")
    wanted = firsts.join(mixed, "key").select("key", "first.a", "first.b", "first.begin", "span")
    fine = _sorted_out(_fetched(rows, written(wanted, "wanted"), width), width, held)
    spans = whole.unionByName(fine)
    return written(spans.groupBy("a", "b").agg(F.collect_list(F.struct("begin", "stop")).alias("spans")), "spans")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans as maximal runs, in order."""
    out: list[list[int]] = []
    for begin, stop in sorted((s["begin"], s["stop"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([begin, stop])
    return [tuple(x) for x in out]


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for begin, stop in runs:
        out.append(data[at:begin])
        at = stop
    return b"".join([*out, data[at:]])


def _whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs shrunk so that they cut no character in two."""
    inner = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    out = []
    for begin, stop in runs:
        while begin < stop and inner(begin):
            begin += 1
        while stop > begin and inner(stop):
            stop -= 1
        if begin < stop:
            out.append((begin, stop))
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with each byte removed that lies in a string of ``width`` bytes which also starts earlier, and the figures of that.

    Adds ``n_bytes, n_removed, n_spans, kept_sha256`` (over bytes, as removed) and replaces ``text`` by what is left,
    where removed runs are shrunk to whole characters. Earlier means a smaller id or the same document further
    left; null ids come last, rows with the same id are ordered by text. A null text counts as empty and stays
    null. Extra columns stay; where a name is taken, the column that is added has another (:func:`figure_names`). An
    empty table gives an empty result. Texts without a repeated string are not shuffled.
    """
    if not 8 <= gram < width:
        raise ValueError("gram must be at least 8 and below width")
    names = [*docs.columns, *figure_names(docs).values()]
    # Inside, the columns go by their places, so that no name of theirs can meet one that is used here.
    kept = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (kept[docs.columns.index(c)] for c in (doc_id, text))
    rows = numbered(docs.toDF(*kept), doc_id, text)
    spans = repeated_spans(rows.select("a", "b", F.col(text).alias("body")), width, gram)
    bitmap = _bits(spans)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    zero = F.lit(0).cast("bigint")
    clean = _filtered(rows, bitmap, False).select(*kept, size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), sha.alias("kept_sha256"))
    schema = StructType(clean.schema.fields)
    at = kept.index(text)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, figures = utf8(batch.column(at)), []
            missing = batch.column(at).is_null().to_pylist()
            texts = []
            for data, found, absent in zip(bodies, batch.column(len(kept)).to_pylist(), missing, strict=True):
                runs = merged(found or [])
                figures.append((len(data), sum(y - x for x, y in runs), len(runs), hashlib.sha256(_kept(data, runs)).hexdigest()))
                texts.append(None if absent else _kept(data, _whole_characters(data, runs)).decode())
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[: len(kept)])]
            columns += [pa.array([f[i] for f in figures], pa.string() if i == 3 else pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    touched = _filtered(rows, bitmap, True).join(spans, ["a", "b"], "left").select(*kept, "spans")
    return clean.unionByName(touched.mapInArrow(step, schema)).toDF(*names)


def figure_names(docs: DataFrame) -> dict[str, str]:
    """The columns that ``remove_repeats`` adds to those of ``docs``: names that are free there."""
    return {name: free_name(docs, name) for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
