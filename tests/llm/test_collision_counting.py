"""Operator 13 against all pairs."""

import numpy as np
import pytest

from tests.llm.test_cover_tree import SCHEMA, vectors
from tidemark.llm import collision_counting as cc


def plain(rows, every=50, k=5):
    """``rows``: id, vector. Distinct usable rows; scores as the operator takes them."""
    fine = {(i, tuple(np.float32(y) for y in x)) for i, x in rows if i is not None and x and all(y is not None and np.isfinite(y) for y in x) and any(x)}
    out = []
    for i, x in fine:
        if i % every == 0:
            others = [(j, y) for j, y in fine if (j, y) != (i, x) and len(y) == len(x)]
            if others:
                scores = cc.cosines(cc.plain_scale(np.array([y for _, y in others])), cc.plain_scale(np.array([x]))[0])
                best = sorted((-s, j) for s, (j, _) in zip(scores.tolist(), others))[:k]
                out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize(("block", "chunk", "every"), [(8192, 128, 50), (16, 3, 4), (7, 2, 1)])
def test_nearest_equal_all_pairs(spark, block, chunk, every):
    v = [x.tolist() for x in vectors(5)] + [vectors(5)[3].tolist()] * 20
    rows = [(i * 2, x) for i, x in enumerate(v)]
    bad = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [2.0, 1.0], [3.0]]
    rows += [(1000 + 50 * i, x) for i, x in enumerate(bad)] + [(None, v[0]), rows[8], rows[8], (100, v[7]), (0, v[3]), (2000, [1e-30] * 6), (-50, [1e38] * 5 + [-1e38])]
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)
    got = sorted(map(tuple, cc.nearest(df, every=every, block=block, chunk=chunk).collect()))
    assert got == plain(rows, every)


def test_few_rows(spark):
    assert cc.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert [(r.rank, r.vec_id) for r in cc.nearest(df).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert cc.nearest(df.where("vec_id = 0")).collect() == []


@pytest.mark.parametrize("width", [3, 64, 300])
def test_windows_miss_nothing_within_reach(width):
    rng = np.random.default_rng(width)
    base = rng.standard_normal((20, width))
    points = base[rng.integers(20, size=500)] + rng.standard_normal((500, width)) * rng.choice([0.05, 0.5, 2], size=(500, 1))
    block = cc.Index(points, [[i] for i in range(500)])
    along = cc.unit(block.vectors) @ cc.directions(width)
    for i in range(0, 500, 25):
        apart = np.sqrt(np.maximum(0, 2 - 2 * cc.cosines(block.vectors, block.vectors[i])))
        for reach in (0.1, 0.5, 1.0, 1.9):
            (places,) = block.collided(along[i : i + 1], np.array([reach]))
            assert set(np.flatnonzero(apart <= reach)) <= set(places.tolist())


def test_windows_leave_out_what_is_far():
    # Neighbours at a distance of about a third, all else at about 1.4.
    rng = np.random.default_rng(1)
    base = rng.standard_normal((400, 64))
    points = np.repeat(base, 10, axis=0) + 0.25 * rng.standard_normal((4000, 64))
    block = cc.Index(points, [[i] for i in range(4000)])
    along = cc.unit(block.vectors) @ cc.directions(64)
    assert np.mean([len(x) for x in block.collided(along[::100], np.full(40, 0.4))]) < 12
    ((places, _, needed),) = block.search(block.vectors[:1], np.array([np.inf]), 6)
    assert set(places.tolist()) <= set(range(10)) and needed < 0.5


def test_scores_do_not_depend_on_the_company():
    points = cc.plain_scale(vectors(2).astype(float))
    whole = cc.cosines(points, points[0])
    assert all(cc.cosines(points[i : i + 1], points[0])[0] == whole[i] for i in range(len(points)))
    assert whole == pytest.approx(cc.unit(points) @ cc.unit(points)[0])
