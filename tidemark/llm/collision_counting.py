"""Nearest neighbours by collision counting on sorted projections.

Equal vectors are one class. Classes are dealt into blocks; a block projects its unit vectors on orthonormal
directions and sorts each projection on its own. A query opens a window around its own value in every projection and
widens it step by step: a step at which a vector enters is a collision, and weighs what the window's square grows by
after it. As the squares of all differences add up to at most the squared distance, a vector within some
distance of the query has to gather a certain weight of collisions: those that do are verified by cosine, and no other can
be that near.

A query begins in one block, with narrow windows: the vectors of most weight there show how far as many as are asked
for surely lie. For that reach the windows of the same sorted arrays are widened (virtual rehashing), there and in every
other block. So the answer is exact; what the windows save depends on how much nearer the neighbours are than the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

NEAREST, EVERY = 5, 50
BLOCK, CHUNK = 8192, 128  # vectors of a block, queries that are sent to a block together
PROJECTIONS, LEVELS, SPREAD = 256, 16, 3.0  # at most; windows end at SPREAD times the mean difference of a vector within reach
FIRST_REACH, FIRST_TRIED, FARTHEST = 0.25, 8, 2.0  # of the rows asked for, FIRST_TRIED times as many are tried at first
_SLACK, _LEAST_REACH = 1e-9, 1e-6  # more than rounding can do to a projection, and far more
_PLAIN = 1e60  # squares and products of components between 1 / _PLAIN and _PLAIN stay finite


def plain_scale(vectors: np.ndarray) -> np.ndarray:
    """The vectors as doubles; one whose largest component is extreme is divided by it, which leaves its direction."""
    vectors = np.ascontiguousarray(vectors, np.float64)
    most = np.abs(vectors).max(axis=1, keepdims=True)
    return np.where((most > _PLAIN) | (most < 1 / _PLAIN), vectors / most, vectors)


def summed(x: np.ndarray) -> np.ndarray:
    """Sums of the rows, from the first component to the last, so that they are the same wherever they are taken."""
    return np.cumsum(x, axis=-1)[..., -1]


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.clip(summed(vectors * query) / np.sqrt(summed(vectors * vectors) * summed(query * query)), -1, 1)


@lru_cache(maxsize=4)
def directions(width: int) -> np.ndarray:
    basis, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((width, width)))
    return basis[:, :PROJECTIONS]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Index:
    """One block: every projection as a sorted array of values and the places of their vectors."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = plain_scale(vectors), ids
        self.first = np.array([x[0] for x in ids], np.int64)
        self.rows = np.array([len(x) for x in ids], np.int64)
        along = unit(self.vectors) @ directions(vectors.shape[1])
        self.order = np.ascontiguousarray(np.argsort(along, axis=0).T)
        self.values = np.ascontiguousarray(np.sort(along, axis=0).T)

    def gathered(self, along: np.ndarray, reach: np.ndarray) -> Iterator[np.ndarray]:
        """For each query, by its projections ``along`` and its reach, the weight that each vector gathers, in squares of the reach."""
        m, width = len(self.values), self.vectors.shape[1]
        windows = np.arange(1, LEVELS + 1) * (SPREAD / LEVELS / np.sqrt(width))
        inner = np.r_[0, windows[:-1]] ** 2
        # From the outer left step over the inner one, which both sides share, to the outer right one.
        weights = np.tile(windows[-1] ** 2 - np.r_[inner[::-1], inner[1:]], m)
        edges = np.r_[-windows[::-1], windows] * reach[:, None] + np.r_[[-_SLACK] * LEVELS, [_SLACK] * LEVELS]
        at = np.stack([np.searchsorted(values, x[:, None] + edges) for values, x in zip(self.values, along.T, strict=True)])
        for own in at.transpose(1, 0, 2):
            places = np.concatenate([order[x[0] : x[-1]] for order, x in zip(self.order, own, strict=True)])
            yield np.bincount(places, np.repeat(weights, np.diff(own).ravel()), len(self.first))

    def collided(self, along: np.ndarray, reach: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the places of all vectors that can lie within its reach."""
        most = len(self.values) * SPREAD**2 / self.vectors.shape[1]
        for weight in self.gathered(along, np.maximum(reach, _LEAST_REACH)):
            yield np.flatnonzero(weight >= most - 1 - 1e-6)

    def best(self, places: np.ndarray, query: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Of ``places`` the best classes, as many as ``rows`` rows need, with their scores; best first, ties by smallest id."""
        scores = cosines(self.vectors[places], query)
        order = np.lexsort((self.first[places], -scores))[:rows]
        return places[order], scores[order]

    def surely(self, queries: np.ndarray, along: np.ndarray, rows: int) -> np.ndarray:
        """For each query a distance within which ``rows`` rows lie, or the farthest there is."""
        reach = np.full(len(queries), FARTHEST)
        tried = min(len(self.first), FIRST_TRIED * rows)
        for i, weight in enumerate(self.gathered(along, np.full(len(queries), FIRST_REACH))):
            places, scores = self.best(np.argpartition(-weight, tried - 1)[:tried], queries[i], rows)
            held = np.cumsum(self.rows[places]) >= rows
            if held.any():
                reach[i] = np.sqrt(max(0.0, 2 - 2 * scores[held.argmax()]))
        return reach + 2 * _SLACK

    def search(self, queries: np.ndarray, reach: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each query the best classes within its reach, their scores, and a distance within which ``rows`` rows surely lie; a
        reach that is not finite is found first."""
        along = unit(queries) @ directions(queries.shape[1])
        if not np.isfinite(reach).all():
            reach = np.where(np.isfinite(reach), reach, self.surely(queries, along, rows))
        for query, places, at in zip(queries, self.collided(along, reach), reach, strict=True):
            yield *self.best(places, query, rows), float(at)


def usable(vector: str) -> Column:
    def fine(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes_of(rows: DataFrame, asked: Column, most: int) -> DataFrame:
    """``hash, vector, ids, asked, width``: equal vectors once, with their ``most`` smallest ids and whether one of all their ids is asked for."""
    told = rows.withColumn("asked", asked)
    place = F.row_number().over(Window.partitionBy("hash", "vector", "asked").orderBy("vec_id"))
    few = told.withColumn("place", place).where(F.col("place") <= most)
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, most)
    return few.groupBy("hash", "vector").agg(ids.alias("ids"), F.max("asked").alias("asked")).withColumn("width", F.size("vector"))


_FOUND = "query BIGINT, ids ARRAY<BIGINT>, score DOUBLE, own BOOLEAN, needed DOUBLE"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _searched(index: DataFrame, asks: DataFrame, rows: int) -> DataFrame:
    """The best classes for each query in each block it is sent to. ``asks``: ``width, block, queries`` (id, vector, reach)."""
    held = index.select("width", "block", F.col("id"), "vector", "ids", F.lit(None).cast(asks.schema["queries"].dataType).alias("queries"))
    sent = asks.select("width", "block", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast(index.schema["vector"].dataType).alias("vector"), F.lit(None).cast("array<bigint>").alias("ids"), "queries")

    def answers(block: Index, own: dict[int, int], width: int, queries: pa.Array) -> Iterator[pa.RecordBatch]:
        out = ([], [], [], [], [])
        found = block.search(plain_scale(_matrix(queries.field("vector"), width)), queries.field("reach").to_numpy(), rows)
        for query, (places, scores, needed) in zip(queries.field("id").to_pylist(), found, strict=True):
            for place, score in zip(places.tolist(), scores.tolist(), strict=True):
                for column, value in zip(out, (query, block.ids[place], score, own.get(query) == place, needed), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.bool_(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=["query", "ids", "score", "own", "needed"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block, own = None, [], None, {}
        for batch in batches:
            cells = list(zip(batch.column("width").to_pylist(), batch.column("block").to_pylist(), strict=True))
            is_ask = batch.column("queries").is_valid().to_pylist()
            begin = 0
            while begin < len(cells):
                end = begin + 1
                while end < len(cells) and cells[end] == cells[begin] and is_ask[end] == is_ask[begin]:
                    end += 1
                if cells[begin] != key:
                    key, parts, block = cells[begin], [], None
                part = batch.slice(begin, end - begin)
                if not is_ask[begin]:
                    parts.append(part)
                else:
                    if block is None and parts:
                        vectors = np.concatenate([_matrix(p.column("vector"), key[0]) for p in parts])
                        own = {x: i for i, x in enumerate(x for p in parts for x in p.column("id").to_pylist())}
                        block, parts = Index(vectors, [x for p in parts for x in p.column("ids").to_pylist()]), []
                    for at in range(len(part) if block is not None else 0):
                        yield from answers(block, own, key[0], part.column("queries").slice(at, 1).flatten())
                begin = end

    both = held.unionByName(sent).repartition("width", "block").sortWithinPartitions("width", "block", F.col("queries").isNotNull())
    return both.mapInArrow(step, _FOUND)


def nearest(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = NEAREST, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every`` divides, the ``k`` others of largest cosine, or all if they are fewer.

    Ties go to the smaller id. Vectors of different lengths are not compared. Rows without an id, and vectors
    that are null, empty or zero or hold null or non-finite components, take no part. A repeated row counts once;
    rows of one id with different vectors are rows of their own, each asked for and each a candidate of the others.
    Other columns are not looked at; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")).where(F.col("vec_id").isNotNull() & usable("vector"))
    rows = rows.distinct().withColumn("hash", F.xxhash64("vector"))
    asked = F.col("vec_id") % every == 0
    classes = written(classes_of(rows, asked, k + 1).withColumn("id", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy("width").agg(F.ceil(F.count("*") / block).alias("blocks"), F.ceil(F.count_if("asked") / chunk).alias("chunks"))
    dealt = classes.join(sizes, "width").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = written(dealt.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("chunk")), F.greatest("chunks", F.lit(1)))), "blocks")

    home = F.pmod(F.col("chunk"), F.col("blocks"))
    query = dealt.where("asked").select("width", "blocks", "chunk", "id", "vector")
    packed = F.collect_list(F.struct("id", "vector", "reach")).alias("queries")
    first = query.withColumn("reach", F.lit(float("inf"))).groupBy("width", "blocks", "chunk").agg(packed).withColumn("block", home)
    found = written(_searched(dealt, first, k + 1), "home")
    reach = found.groupBy(F.col("query").alias("id")).agg(F.min("needed").alias("reach"))
    bounded = query.join(reach, "id", "left").withColumn("reach", F.coalesce("reach", F.lit(FARTHEST + 2 * _SLACK)))
    others = bounded.groupBy("width", "blocks", "chunk").agg(packed).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")).where(F.col("block") != home)
    found = found.unionByName(written(_searched(dealt, others, k + 1), "others"))

    best = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.element_at("ids", 1)))
    few = found.withColumn("place", best).where(F.col("place") <= k + 1).select(F.col("query").alias("id"), F.explode("ids").alias("vec_id"), "score", "own")
    by_row = F.row_number().over(Window.partitionBy("id").orderBy(F.col("score").desc(), "vec_id", "own"))
    few = few.withColumn("place", by_row).where(F.col("place") <= k + 1).drop("place")
    asking = rows.where(asked).select(F.col("vec_id").alias("query_id"), "hash", "vector").join(classes.where("asked").select("hash", "vector", "id"), ["hash", "vector"]).select("query_id", "id")
    rank = F.row_number().over(Window.partitionBy("query_id", "id").orderBy(F.col("score").desc(), "vec_id", "own"))
    answer = asking.join(few, "id").where((F.col("vec_id") != F.col("query_id")) | ~F.col("own")).withColumn("rank", rank)
    return answer.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
