"""Operator 2 against all pairs."""

import numpy as np
import pytest

from tests.llm.test_fingerprints import roots
from tidemark.llm import cover_tree

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, block STRING, id STRING, weight STRING"


def vectors(seed, n=120, width=6):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((8, width))
    out = [(base[rng.integers(8)] + rng.standard_normal(width) * rng.choice([0, 0.05, 0.3])) * rng.uniform(0.1, 9) for _ in range(n)]
    return np.array(out, dtype=np.float32)


@pytest.mark.parametrize("seed", range(4))
def test_nets_cover_and_halve(seed):
    points = cover_tree.unit(vectors(seed).astype(float))
    path = cover_tree.nested_nets(points)
    widest = np.sqrt(((points - points[path[0]]) ** 2).sum(1)).max()
    for at, row in enumerate(path[:-1]):
        below = path[at + 1]
        step = np.sqrt(((points[below] - points[row]) ** 2).sum(1))
        assert step.max() <= widest / 2**at + 1e-9
        assert set(row) <= set(below)
    assert len(set(path[0])) == 1 and (path[-1] == np.arange(len(points))).all()


@pytest.mark.parametrize("threshold", [0.3, 0.93, 0.9999])
def test_dual_traversal_gives_each_pair_once(threshold):
    a, b = (cover_tree.unit(vectors(s).astype(float)) for s in (1, 1 + 1))
    b[:40] = a[:40]
    trees = [cover_tree.Tree(x, cover_tree.nested_nets(x)) for x in (a, b)]
    seen = np.zeros((len(a), len(b)), int)
    for a0, a1, b0, b1 in cover_tree.descend(*trees, threshold):
        for w, x, y, z in zip(a0, a1, b0, b1):
            seen[w:x, y:z] += 1
    wanted = np.einsum("id,jd->ij", trees[0].points, trees[1].points)
    near = np.abs(wanted - threshold) < 1e-12
    assert ((seen == (wanted >= threshold)) | near).all()


@pytest.mark.parametrize(("threshold", "block"), [(0.93, 1024), (0.93, 7), (0.5, 16)])
def test_near_vectors_equal_all_pairs(spark, threshold, block):
    v = [x.tolist() for x in vectors(5)] + [vectors(5)[3].tolist()] * 5
    rows = [(i * 2, x, i % 2 if i % 11 else None) for i, x in enumerate(v)]
    bad = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [1.0, 2.0]]
    rows += [(1001 + i, x, 0) for i, x in enumerate(bad)] + [(None, v[0], 0), (None, v[1], 1), rows[8], rows[8]]
    df = spark.createDataFrame([(*r, None, "x", "y") for r in rows], SCHEMA)
    got = cover_tree.near_vectors(df, threshold=threshold, block=block).collect()
    fine = [x is not None and len(x) > 0 and all(y is not None and np.isfinite(y) for y in x) and any(x) for _, x, _ in rows]

    def linked(i, j):
        if i == j or not (fine[i] and fine[j]) or rows[i][2] is None or rows[i][2] != rows[j][2] or len(rows[i][1]) != len(rows[j][1]):
            return False
        x, y = (np.array(rows[k][1], dtype=np.float32).astype(float) for k in (i, j))
        return int(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold)

    link = [[linked(i, j) for j in range(len(rows))] for i in range(len(rows))]
    root = roots(len(rows), lambda i, j: link[i][j])
    lowest = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    wanted = [(rows[i][0], sum(link[i]), lowest[root[i]], rows[i][0] is not None and rows[i][0] == lowest[root[i]]) for i in range(len(rows))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_empty_table(spark):
    assert cover_tree.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
