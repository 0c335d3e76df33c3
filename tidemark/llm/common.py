"""Helpers that several operators share: written tables, text batches, free names, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# Fixed value: the white space that separates words (ASCII space, tab to carriage return).
BLANKS = r"\x20\x09-\x0D"
WORD = f"[^{BLANKS}]+"

BATCH_BYTES = 1 << 21


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared scratch folder: lineage ends there, and a lost executor costs a read.

    The folder is left for the owner of ``spark.checkpoint.dir`` to clear, as results are lazy and still read it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores before it until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def id_crc32(doc_id: str | Column) -> Column:
    """CRC-32 of the id written as text; folds are taken from it."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(column.cast("string"), "UTF-8"))


def runs_of(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of positions whose texts have about ``limit`` bytes together: they bound what a step holds."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null as an empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def add_text_columns(
    rows: DataFrame, text: str, fields: str, values: Callable[[list[bytes]], list[pa.Array]], keep: bool = False
) -> DataFrame:
    """Replace the column ``text`` by ``fields`` (a DDL list), which ``values`` makes from the texts of a batch; or ``keep`` it too."""
    spark = rows.sparkSession
    kept = [f for f in rows.schema.fields if keep or f.name != text]
    added = spark.createDataFrame([], fields).schema.fields
    at = rows.columns.index(text)
    names = [f.name for f in kept] + [f.name for f in added]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [c for i, c in enumerate(batch.columns) if keep or i != at]
            yield pa.RecordBatch.from_arrays([*others, *values(utf8(batch.column(at)))], names=names)

    from pyspark.sql.types import StructType

    return rows.mapInArrow(step, StructType([*kept, *added]))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``a``-``b`` (longs): ``node, root``, the root being the smallest node reachable.

    Large-star and small-star steps in turn, each a few joins and aggregates on all links; every step is written
    down, so that a lost executor repeats one step. Null ends are no links. A node without a link has no row.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    state = _digest(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _digest(links)
        if before == state:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
