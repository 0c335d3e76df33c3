"""Near-duplicate embeddings: exact pairs above a cosine threshold by dual traversal of cover trees.

Equal vectors are one class. Classes are sorted so that similar directions are neighbours and cut into blocks of
``BLOCK`` vectors of one label; each block gets a cover tree: nested nets with halving radii, every point with its
ancestor in each net. Two blocks whose covering balls are further apart than the threshold never meet. For the rest,
both trees are descended together: a pair of nodes is dropped when its covering radii prove that no pair below it
can link, and taken whole when they prove that all do. A task gives one row per vector, not per link, so dense groups
cost no more rows than loose ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import components, written

THRESHOLD = 0.93
BLOCK = 1024
LEVELS = 8
_SLACK = 1e-6  # more than rounding can do to a distance


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def nested_nets(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """``path[l, i]``: the ancestor of point ``i`` in net ``l``; the last row is the points themselves.

    Net 0 is one point; net ``l`` covers all points within its radius, which is half that of net ``l - 1``, and
    its points are further apart than that. Points are added farthest first.
    """
    n = len(points)
    level, parent = np.full(n, levels + 1), np.zeros(n, np.int64)
    own, level[0] = np.zeros(n, np.int64), 0
    apart = ((points - points[0]) ** 2).sum(axis=1)
    radius = np.sqrt(apart.max())
    for at in range(1, levels + 1):
        radius /= 2
        above = own.copy()
        while apart[far := int(apart.argmax())] > radius * radius and level[far] > levels:
            level[far], parent[far] = at, above[far]
            now = ((points - points[far]) ** 2).sum(axis=1)
            own[now < apart] = far
            apart = np.minimum(apart, now)
            apart[far] = 0
    last = level > levels
    parent[last] = own[last]
    path = np.empty((levels + 2, n), np.int64)
    path[-1] = np.arange(n)
    for at in range(levels, -1, -1):
        path[at] = np.where(level[path[at + 1]] <= at, path[at + 1], parent[path[at + 1]])
    return path


class Tree:
    """A cover tree in the order of its leaves: per level the nodes' points, covering radii, leaves and children."""

    def __init__(self, points: np.ndarray, path: np.ndarray):
        order = np.lexsort(path[::-1])
        self.order, self.points = order, points[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        path = place[path[:, order]]
        self.heads, self.begins, self.radii, self.children = [], [], [], []
        for row in path:
            begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            away = np.sqrt(((self.points - self.points[row]) ** 2).sum(axis=1))
            self.heads.append(row[begins])
            self.radii.append(np.maximum.reduceat(away, begins))
            self.begins.append(np.r_[begins, len(row)])
        for upper, lower in zip(self.begins[:-1], self.begins[1:], strict=True):
            self.children.append(np.searchsorted(lower, upper))


def _cosines(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], step: int = 1 << 14) -> np.ndarray:
    """Products of rows: ``x`` and ``y`` are points and the places of the rows to take, which are gathered ``step`` at a time."""
    out = np.empty(len(x[1]))
    for at in range(0, len(out), step):
        out[at : at + step] = np.einsum("nd,nd->n", x[0][x[1][at : at + step]], y[0][y[1][at : at + step]])
    return out


def descend(a: Tree, b: Tree, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of leaves ``a_begin, a_end, b_begin, b_end`` whose pairs all reach the threshold; together every such pair once."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold))
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    last = len(a.heads) - 1
    for at in range(last + 1):
        cosine = _cosines((a.points, a.heads[at][i]), (b.points, b.heads[at][j]))
        if at == last:
            keep = cosine >= threshold
            yield i[keep], i[keep] + 1, j[keep], j[keep] + 1
            return
        apart = np.sqrt(np.maximum(0, 2 - 2 * cosine))
        cover = a.radii[at][i] + b.radii[at][j]
        whole = apart + cover < reach - _SLACK
        if whole.any():
            yield a.begins[at][i[whole]], a.begins[at][i[whole] + 1], b.begins[at][j[whole]], b.begins[at][j[whole] + 1]
        open_ = ~whole & (apart <= reach + cover + _SLACK)
        i, j = i[open_], j[open_]
        if not len(i):
            return
        a_from, b_from = a.children[at][i], b.children[at][j]
        a_n, b_n = a.children[at][i + 1] - a_from, b.children[at][j + 1] - b_from
        pair = np.repeat(np.arange(len(i)), a_n * b_n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(a_n * b_n) - a_n * b_n, a_n * b_n)
        i, j = a_from[pair] + k // b_n[pair], b_from[pair] + k % b_n[pair]


def _joined(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches by links."""
    root = np.arange(n)
    if not links:
        return root
    u, v = (np.concatenate(x) for x in zip(*links, strict=True))
    while True:
        low = np.minimum(root[u], root[v])
        after = root.copy()
        np.minimum.at(after, root[u], low)
        np.minimum.at(after, root[v], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _spread(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ranges, and the begin of the range of each."""
    n = ends - begins
    own = np.repeat(begins, n)
    return own, own + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)


def links_between(a: Tree, b: Tree | None, weights_a: np.ndarray, weights_b: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf of ``a`` and then of ``b`` (None: pairs within ``a``): linked weight, and a position it is joined to."""
    other, weights_o = (a, weights_a) if b is None else (b, weights_b)
    n_a, n = len(a.order), len(a.order) + (0 if b is None else len(b.order))
    shift = 0 if b is None else n_a
    grown, sums_a, sums_o = np.zeros(n + 1, np.int64), np.r_[0, np.cumsum(weights_a)], np.r_[0, np.cumsum(weights_o)]
    joined = []
    for a0, a1, b0, b1 in descend(a, other, threshold):
        np.add.at(grown, a0, sums_o[b1] - sums_o[b0])
        np.add.at(grown, a1, sums_o[b0] - sums_o[b1])
        if b is not None:
            np.add.at(grown, b0 + shift, sums_a[a1] - sums_a[a0])
            np.add.at(grown, b1 + shift, sums_a[a0] - sums_a[a1])
        joined += [_spread(a0, a1), tuple(x + shift for x in _spread(b0, b1)), (a0, b0 + shift)]
    linked = np.cumsum(grown)[:n]
    if b is None:
        own = np.einsum("nd,nd->n", a.points, a.points) >= threshold
        linked -= np.where(own, weights_a, 0)
    return linked, _joined(n, joined)


@cache
def _directions(width: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((3, width, 16))


def direction_code(points: np.ndarray) -> np.ndarray:
    """A sort key that similar directions often share: the nearest of 32 fixed directions, three times over."""
    code = np.zeros(len(points), np.int64)
    for directions in _directions(points.shape[1]):
        along = points @ directions
        best = np.abs(along).argmax(axis=1)
        code = code * 32 + best * 2 + (np.take_along_axis(along, best[:, None], 1)[:, 0] < 0)
    return code


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(label: str, vector: str) -> Column:
    def fine(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))

    return F.coalesce(F.col(label).isNotNull() & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _coded(classes: DataFrame) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, width = batch.column("vector"), batch.column("width").to_numpy()
            code = np.zeros(len(width), np.int64)
            for w in np.unique(width):
                own = np.flatnonzero(width == w)
                code[own] = direction_code(unit(_matrix(vectors.take(pa.array(own)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    from pyspark.sql.types import LongType, StructType

    return classes.mapInArrow(step, StructType([*classes.schema.fields, *StructType().add("code", LongType()).fields]))


_TREE_ROWS = "block BIGINT, grp STRING, id BIGINT, weight BIGINT, point ARRAY<DOUBLE>, path ARRAY<INT>"


def _blocks(coded: DataFrame, block: int) -> DataFrame:
    """Consecutive rows of one label and width, ``block`` at most, each with its cover tree."""

    def grown(held: pd.DataFrame, key: int) -> pd.DataFrame:
        points = unit(np.array(held["vector"].tolist(), dtype=np.float64))
        path = nested_nets(points).astype(np.int32)
        return pd.DataFrame({"block": key, "grp": held["grp"].to_numpy(), "id": held["id"].to_numpy(), "weight": held["weight"].to_numpy(), "point": list(points), "path": list(path.T)})

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        key, held = TaskContext.get().partitionId() << 32, None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held):
                same = int((held["grp"] != held["grp"].iloc[0]).to_numpy().argmax()) or len(held)
                if same == len(held) and same < block:
                    break
                yield grown(held.iloc[: min(same, block)], key)
                held, key = held.iloc[min(same, block) :], key + 1
        if held is not None and len(held):
            yield grown(held, key)

    ordered = coded.repartitionByRange("grp", "code", "id").sortWithinPartitions("grp", "code", "id")
    return ordered.select("grp", "id", "weight", "vector").mapInPandas(step, _TREE_ROWS)


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``<vec_id>, n_links`` (other vectors linked directly), ``component_id, kept``.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine in double
    precision is at least ``threshold`` (above 0). Vectors that are null, empty or all zero, or that hold null or
    non-finite components, link with nothing. ``component_id`` is the smallest id reachable, the own included; null
    ids are never one unless nothing else is reachable. Repeated rows are rows of their own, and link. Other
    columns are not looked at; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"), _usable(label, vector).alias("usable"))
    grp = F.concat_ws("/", F.col("label").cast("string"), F.size("vector").cast("string"))
    usable = rows.where("usable").select("vec_id", "vector", grp.alias("grp")).withColumn("hash", F.xxhash64("grp", "vector"))
    classes = usable.groupBy("hash", "grp", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    coded = written(_coded(classes.select("grp", "id", "weight", "vector", F.size("vector").alias("width"))), "coded")
    trees = written(_blocks(coded, block), "trees")

    head = F.element_at("path", 1)
    tops = trees.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy(F.element_at("path", -1))) - 1)
    top = tops.where(head == F.col("place")).select("block", "grp", F.col("point").alias("top"))
    away = F.sqrt(F.aggregate(F.zip_with("point", "top", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    balls = written(trees.join(top.select("block", "top"), "block").groupBy("block", "grp", "top").agg(F.max(away).alias("radius")), "balls")
    a = balls.select("grp", F.col("block").alias("block_a"), F.col("top").alias("top_a"), F.col("radius").alias("radius_a"))
    b = balls.select("grp", F.col("block").alias("block_b"), F.col("top").alias("top"), F.col("radius").alias("radius_b")).withColumnRenamed("top", "point")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _SLACK
    gap = F.sqrt(F.aggregate(F.zip_with("point", "top_a", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    meet = a.join(b, "grp").where((F.col("block_a") <= F.col("block_b")) & (gap <= F.col("radius_a") + F.col("radius_b") + reach)).select("block_a", "block_b")
    meet = written(meet, "meetings")

    sides = meet.select("block_a", "block_b", F.col("block_a").alias("block")).unionByName(meet.where("block_a < block_b").select("block_a", "block_b", F.col("block_b").alias("block")))

    def task(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for own in dict.fromkeys(key):
            part = held[held["block"] == own]
            path = np.array(part["path"].tolist()).T
            part = part.iloc[np.argsort(path[-1], kind="stable")]
            tree = Tree(np.array(part["point"].tolist()), np.array(part["path"].tolist()).T)
            parts.append((tree, part["weight"].to_numpy()[tree.order], part["id"].to_numpy()[tree.order]))
        (tree_a, weight_a, ids), (tree_b, weight_b, ids_b) = parts[0], parts[1] if len(parts) > 1 else (None, None, np.array([], np.int64))
        linked, joined = links_between(tree_a, tree_b, weight_a, weight_b, threshold)
        ids = np.concatenate([ids, ids_b])
        keep = (linked > 0) | (joined != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[keep], "b": ids[joined][keep], "linked": linked[keep]})

    found = sides.join(trees, "block").groupBy("block_a", "block_b").applyInPandas(task, "a BIGINT, b BIGINT, linked BIGINT")
    found = written(found, "links")
    counts = found.groupBy("a").agg(F.sum("linked").alias("linked"))
    named = classes.select("id", "first", "weight", "hash", "vector", "grp").join(components(found).withColumnRenamed("node", "id"), "id", "left")
    named = written(named.withColumn("root", F.coalesce("root", "id")).join(counts.withColumnRenamed("a", "id"), "id", "left"), "named")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("hash", "grp", "vector", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    linked = usable.join(named, ["hash", "grp", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.unionByName(alone).select(F.col("vec_id").alias(vec_id), "n_links", "component_id", kept)
