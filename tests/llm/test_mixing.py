"""Operator 3 against plain Python."""

from collections import Counter

import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - most * sum(sizes[s] for s in full)
        share = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 1, "c": 1}, {"a": 0, "b": 5, None: 7}, {"a": 0}, {"é": 3, "z": 3, "Z": 100, "a": 1, None: 1}, {"a": 1, "b": 1, "c": 50, "d": 2, "e": 1}]
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "s STRING, n BIGINT")
    got = {r.s: r.target for r in mixing.source_targets(df, "s", "n").collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_takes_what_the_plan_says(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    plan, names = mixing.mix_plan(docs)
    assert names["size"] == "_size" and set(docs.columns) < set(plan.columns)
    rows = plan.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["_size"] == len((r.text or "").split()) and 0 <= r.copies <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter((r.doc_id, r.text) for r in mixed.collect())
    wanted = Counter()
    for r in rows:
        wanted[r.doc_id, r.text] += r.copies
    assert taken == +wanted
    assert mixing.mix(docs.where("1 = 0")).collect() == []
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix(docs.repartition(3)).collect()))


def test_targets_are_met(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}" if i % 3 else "hot") for i in range(9000)]
    plan, names = mixing.mix_plan(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"))
    for r in plan.groupBy("source", "target").agg({"copies": "sum"}).collect():
        taken = sum(x["size"] * x.copies for x in plan.where(plan.source == r.source).collect())
        assert taken == pytest.approx(r.target, rel=0.05)


def test_plan_is_native(spark):
    plan = mixing.mix(spark.createDataFrame(documents(), SCHEMA))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
