"""Audit of sources: how far each one's use of terms is from the other sources of its language, and by which terms.

Terms are counted once per document and task, and meet once, by language and term. What a term adds to the divergence
grows with its count in the group and falls with its count in the language. So a term that ``TOP`` others dominate
(count in the group as high, count in the language as low, name as early) cannot be among the first ``TOP``: each
partition keeps the skyband of its terms of a group, the skybands of a group are merged, and only what is left is ranked exactly.
Pairs of sources sum over the terms that both have; what the others add depends on one count and is summed by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import runs_of, utf8, written

# Terms are ASCII letters and whatever is not ASCII, as bytes of UTF-8; shares are in units of 1 / SCALE.
_TERM = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
SCALE = 1_000_000_000
LEAST_DOCS, TOP = 3, 200

PIECE = 1 << 20  # bytes of a text that are split at once
FLUSH = 1 << 20  # counts that a task holds before it brings equal ones together and passes them on
HELD = 1 << 17  # terms of a group that a task holds before it cuts them to their skyband
PARTS = 16  # in which the terms of a group are dealt out
GRID, STEP = 256, 256  # steps of a skyband's grid in either direction, terms that are told at once


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in lower case with blanks for what is no term, in parts of about ``size`` bytes that cut no term."""
    text, at = text.translate(_TERM), 0
    while len(text) - at > size and (end := text.find(b" ", at + size)) >= 0:
        yield text[at:end]
        at = end
    yield text[at:]


def _counted(texts: list[bytes], groups: np.ndarray) -> pa.Table:
    """``group, term, n, docs`` over texts and the number of each one's group."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        for piece in pieces(text):
            parts.append(piece)
            owner.append(i)
    lists = pc.ascii_split_whitespace(pa.array(parts, pa.binary()).cast(pa.string()))
    flat, owner = lists.flatten(), np.repeat(np.array(owner), pc.list_value_length(lists).to_numpy())
    real = pc.not_equal(pc.binary_length(flat), 0)  # blanks at the ends leave empty ones
    coded, owner = flat.filter(real).dictionary_encode(), owner[real.to_numpy(zero_copy_only=False)]
    size = max(1, len(coded.dictionary))
    # First by text and term, so that each text counts once, then by group and term.
    by_text, n = np.unique(owner * size + coded.indices.to_numpy(), return_counts=True)
    key = groups[by_text // size] * size + by_text % size
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n, begin) if len(key) else n
    term = coded.dictionary.take(pa.array(key[begin] % size))
    return pa.table({"group": key[begin] // size, "term": term, "n": sums.astype(np.int64), "docs": np.diff(np.r_[begin, len(key)])})


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` over ``lang, source, text`` without nulls; a task gives a term several times at most if it has many."""

    def flushed(held: list[pa.Table], groups: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
        sums = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        names = [pa.array([g[i] for g in groups], pa.string()) for i in (0, 1)]
        columns = [*[x.take(sums["group"].combine_chunks()) for x in names], sums["term"], sums["n_sum"], sums["docs_sum"]]
        yield from pa.table(columns, names=["lang", "source", "term", "n", "docs"]).to_batches(max_chunksize=1 << 16)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held, rows = [], 0
        for batch in batches:
            texts = utf8(batch.column(2))
            own = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            numbers = np.array([groups.setdefault(g, len(groups)) for g in own], np.int64)
            for begin, end in runs_of(texts):
                held.append(_counted(texts[begin:end], numbers[begin:end]))
                rows += held[-1].num_rows
                if rows > FLUSH:
                    yield from flushed(held, groups)
                    held, rows = [], 0
        if held:
            yield from flushed(held, groups)

    return docs.select("lang", "source", "text").mapInArrow(step, "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT")


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, n, total, leads``: terms in ``least`` documents of a language or more; one row of each term leads."""
    sums = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    told = sums.withColumns({"total": F.sum("n").over(term), "in_docs": F.sum("docs").over(term), "leads": F.min("source").over(term) == F.col("source")})
    return told.where(F.col("in_docs") >= least).select("lang", "source", "term", "n", "total", "leads")


def _steps(values: np.ndarray) -> np.ndarray:
    """``values`` by the step of the grid they lie on: equal values share one."""
    edges = np.unique(np.quantile(values, np.arange(1, GRID) / GRID, method="nearest"))
    return np.searchsorted(edges, values, side="left")


def skyband(n: np.ndarray, total: np.ndarray, terms: pa.Array, k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate: ``n`` as high, ``total`` as low, name as early.

    In order of ``n`` a dominating term comes earlier. A grid over the other two tells for most terms whether the
    earlier ones on lower steps are ``k`` already, or those on steps as low are not; the rest are compared one by one.
    """
    if not len(n):
        return np.zeros(0, np.int64)
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(terms))
    order = np.lexsort((rank, total, -n))
    # Of terms with equal counts the first k by name come into question.
    begin = np.flatnonzero(np.r_[True, (n[order][1:] != n[order][:-1]) | (total[order][1:] != total[order][:-1])])
    order = order[np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)])) < k]
    t, r = total[order], rank[order]
    a, b = _steps(t), _steps(r)
    wide = int(b.max()) + 2
    grid, kept = np.zeros((int(a.max()) + 2, wide), np.int64), np.zeros(len(order), bool)
    for at in range(0, len(order), STEP):
        own = slice(at, min(at + STEP, len(order)))
        below = grid.cumsum(axis=0).cumsum(axis=1)
        least, most = below[a[own], b[own]], below[a[own] + 1, b[own] + 1]
        beside = np.tril((t[own] <= t[own, None]) & (r[own] <= r[own, None]), -1).sum(axis=1)
        kept[own] = most + beside < k
        for i in np.flatnonzero((least < k) & ~kept[own]) + at:
            kept[i] = np.count_nonzero((t[:i] <= t[i]) & (r[:i] <= r[i])) < k
        np.add.at(grid.ravel(), (a[own] + 1) * wide + b[own] + 1, 1)
    return order[kept]


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """``lang, source, term, n, total``: of each partition and group, the terms that fewer than ``k`` others there dominate.

    A group's rows stand together in a partition; a task holds those of one group, cut down again and again.
    """
    names = ["lang", "source", "term", "n", "total"]

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return rows.take(pa.array(skyband(rows.column("n").to_numpy(), rows.column("total").to_numpy(), rows.column("term"), k)))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, size, bound = None, [], 0, HELD
        for batch in batches:
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            begins = [i for i, x in enumerate(groups) if not i or x != groups[i - 1]]
            for begin, end in zip(begins, [*begins[1:], len(groups)], strict=True):
                if groups[begin] != group and held:
                    yield cut(held)
                    held, size, bound = [], 0, HELD
                group = groups[begin]
                held.append(batch.slice(begin, end - begin))
                size += end - begin
                if size > bound:
                    held = [cut(held)]
                    size = held[0].num_rows
                    bound = max(HELD, 2 * size)
        if held:
            yield cut(held)

    together = rows.select(*names).sortWithinPartitions("lang", "source")
    return together.mapInArrow(step, "lang STRING, source STRING, term STRING, n BIGINT, total BIGINT")


def share(n: Column, size: Column, terms: Column) -> Column:
    """One more than the floor of ``SCALE`` times the smoothed share, in whole numbers throughout."""
    whole = "decimal(20,0)"
    product = (n + 1).cast(whole) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", product, F.greatest(size + terms, F.lit(1)).cast(whole)) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pairs(kept: DataFrame, stats: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language.

    The sum over all terms is that over the terms of the one with the other's count taken as zero, and the reverse,
    and the rest with both zero, put right by the terms that both have.
    """
    none = share(F.lit(0), F.col("size"), F.col("terms"))
    groups = stats.select("lang", "source", "size", "terms", none.alias("none"))
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", share(F.col("n"), F.col("size"), F.col("terms")).alias("p"), "none")
    shares = written(shares, "shares")
    by_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "none")).alias("held")).where(F.size("held") > 1)
    both = by_term.select("lang", F.explode("held").alias("a"), "held").select("lang", "a", F.explode("held").alias("b")).where("a.source <> b.source")
    a, b = {x: F.col(f"a.{x}") for x in ("p", "none")}, {x: F.col(f"b.{x}") for x in ("p", "none")}
    right = apart(a["p"], b["p"]) - apart(a["p"], b["none"]) - apart(a["none"], b["p"]) + apart(a["none"], b["none"])
    right = both.select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), right.alias("value"))

    # How often a group has each share: far fewer rows than terms.
    often = written(shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times")), "often")
    others = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("other_none"))
    met = often.join(others, "lang").where("source <> other")
    one = met.select("lang", "source", F.col("other").alias("item"), (F.col("times") * apart(F.col("p"), F.col("other_none"))).alias("value"))
    two = met.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), (F.col("times") * apart(F.col("other_none"), F.col("p"))).alias("value"))

    numbers = groups.join(often.groupBy("lang", "source").agg(F.sum("times").alias("own")), ["lang", "source"], "left").select("lang", "source", "terms", "none", F.coalesce("own", F.lit(0)).alias("own"))
    x, y = (numbers.select("lang", *[F.col(c).alias(f"{c}_{side}") for c in ("source", "terms", "none", "own")]) for side in "ab")
    rest = F.col("terms_a") - F.col("own_a") - F.col("own_b")
    rest = x.join(y, "lang").where("source_a <> source_b").select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.when(F.col("terms_a") > 0, rest * apart(F.col("none_a"), F.col("none_b"))).otherwise(0).alias("value"))
    return right.unionByName(one).unionByName(two).unionByName(rest).groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))


def _top_terms(kept: DataFrame, stats: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value``: the terms of each group that its share exceeds the language's in, those that can be among the first ``top``."""
    parts = skybands(kept.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(PARTS))), top)
    left = skybands(parts.repartition("lang", "source"), top).join(stats, ["lang", "source"])
    p, q = share(F.col("n"), F.col("size"), F.col("terms")), share(F.col("total"), F.col("lang_size"), F.col("terms"))
    told = left.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    return told.where("p > q").select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of language and source.

    Part ``pair`` has the other sources of the language, part ``term`` the first ``top`` terms that the group uses more
    than its language does. A null text, language or source is an empty one; repeated rows are documents of their
    own; ties go by name; other columns are not looked at; an empty table gives an empty result.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = written(kept_terms(term_counts(rows), least), "terms")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("leads").alias("leads"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    of_lang = Window.partitionBy("lang")
    size = F.coalesce("size", F.lit(0))
    stats = groups.select("lang", "source", size.alias("size"), F.coalesce(F.sum("leads").over(of_lang), F.lit(0)).alias("terms"), F.coalesce(F.sum("size").over(of_lang), F.lit(0)).alias("lang_size"))
    stats = written(stats, "groups")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(ranked)
    pairs = _pairs(kept, stats).withColumn("rank", rank).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    terms = _top_terms(kept, stats, top).withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
