"""From documents to packed training sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import cross_parse, curve_packing, induced_sort, mixing, segment_popcount
from tidemark.llm.common import free_name, written
from tidemark.session import configure
from tidemark.sources.tables import read_table

# Language ID, near-duplicates and packing have no SQL form; the pipeline is tested against plain Python instead.
ORACLE_SQL = None


def _with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row; a written table, so the number is the same whenever it is read."""
    name = free_name(docs, "row_number")
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language stay; those without a letter, which have none, go. Labels are learned from the training folds."""
    configure(spark)
    samples = cross_parse.learn(docs.where(cross_parse.in_training("doc_id")), "doc_id", "text", "lang")
    found = cross_parse.identify(docs, samples, keep=True)
    language = cross_parse.added_names(docs)["lang_pred"]
    return found.where(F.col(language) != cross_parse.UNKNOWN).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: the one with the smallest id, of equal ids the first row."""
    configure(spark)
    rows, row = _with_row(docs)
    groups = segment_popcount.near_duplicates(rows.select(row, "text"), doc_id=row)
    ids = groups.join(rows.select(row, "doc_id"), row).select(row, "component_id", "doc_id")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)
    kept = ids.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col(f"first.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that an earlier document, or an earlier place, has too are cut out."""
    configure(spark)
    cut = induced_sort.remove_repeats(docs)
    removed = induced_sort.figure_names(docs)["n_removed"]
    size = F.when(F.col(removed) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars").cast("bigint")).alias("n_chars")
    return cut.select(*[size if c == "n_chars" else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights take it."""
    configure(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens along the curve."""
    configure(spark)
    return curve_packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("curve_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
