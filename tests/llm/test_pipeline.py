"""The pipeline against the operators' plain forms."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import SCHEMA, documents
from tests.llm.test_fingerprints import plain_print, roots
from tests.llm.test_induced_sort import plain, planted


def test_stages_keep_the_columns_and_decide_as_they_should(spark):
    rows = planted(4)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, "")
        assert docs.columns == before.columns, name
        kept[name] = docs.collect()
        docs = spark.createDataFrame(kept[name], docs.schema)
    key = lambda r: (str(r[0]), str(r[1]))
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(map(key, kept["language_id"])) == sorted(map(key, lettered))
    prints = [plain_print(r[1]) for r in lettered]
    root = roots(len(lettered), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    best = {}
    for r, x in zip(lettered, root):
        best[x] = min(best.get(x, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept["simhash_near_dedup"]) == sorted(best.values())
    survivors = [tuple(r) for r in kept["simhash_near_dedup"]]
    removed = sum(x[2] for x in plain(survivors, 100))
    sizes = lambda rs: sum(len((r[1] or "").encode()) for r in rs)
    assert 0 <= sizes(kept["suffix_array_dedup"]) - (sizes(survivors) - removed) <= 6 * sum(x[3] for x in plain(survivors, 100))
    assert {r.doc_id for r in kept["mix_sources"]} <= {r.doc_id for r in kept["suffix_array_dedup"]}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").agg(F.sum("length")).first()[0] > 0


def test_whole_run_and_empty_documents(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, folder)
    sequences = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r.n == 2048 or r.n & (r.n - 1) == 0 for r in sequences)
    spark.createDataFrame([], spark.read.parquet(f"{folder}/documents.parquet").schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("column", ["text", "source", "lang", "doc_id"])
def test_columns_of_nulls(spark, column):
    docs = spark.createDataFrame(documents(n=8), SCHEMA)
    docs = docs.withColumn(column, F.lit(None).cast(docs.schema[column].dataType))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    docs.collect()


def test_no_stage_touches_columns_of_other_names(spark):
    names = ["a", "b", "spans", "score", "lang_pred", "n_bytes", "n_removed", "n_spans", "kept_sha256", "row_number", "component_id", "fp", "copies", "rate", "at", "body", "c0", "key"]
    docs = spark.createDataFrame(planted(5), SCHEMA).drop("fp", "Body").withColumns({n: F.lit(f"{n} of the user") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, "")
        assert docs.columns == before.columns, name
        rows = docs.select(*names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"{n} of the user" for n in names)], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
