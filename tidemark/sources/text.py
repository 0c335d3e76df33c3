"""Offset lines from a file or a string."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Places in a line number: of the file among all files, of the split in its file (bytes), of the line in its task.
SPLIT_DIGITS, LINE_DIGITS = 13, 19

_ROOT = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty lines of a text file, or of the files in a folder, as ``line_no, value``.

    Line numbers (decimals) rise through all files, by path, and through each file, however it is split and whichever
    tasks read it. They are not consecutive: :func:`numbered` makes them so.
    """
    lines = _placed_lines(spark, path)
    scale = lambda digits: F.lit(f"{10**digits}").cast("decimal(38,0)")
    split = F.col("file").cast("decimal(38,0)") * scale(SPLIT_DIGITS + LINE_DIGITS) + F.col("split").cast("decimal(38,0)") * scale(LINE_DIGITS)
    line_no = (split + F.col("place").cast("decimal(38,0)")).cast("decimal(38,0)").alias("line_no")
    return lines.select(line_no, "value").filter(F.col("value") != "")


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines as ``file, split, place, value``: the file's number by path, the byte where the split begins, and a number that
    rises within a split."""
    text = spark.read.text(path)
    # A path without a host is written with one slash or three.
    files = sorted(re.sub(_ROOT, r"\1:/", f) for f in text.inputFiles())
    lines = text.select(
        F.regexp_replace("_metadata.file_path", _ROOT, "$1:/").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    if len(files) < 2:
        return lines.select(F.lit(0).alias("file"), "split", "place", "value")
    # One row per file; Spark has their list on the driver anyway, and broadcasts it as its size allows.
    numbers = spark.createDataFrame(list(enumerate(files)), "file int, path string")
    known = F.coalesce("file", F.raise_error(F.concat(F.lit("not a file that was listed: "), "path")).cast("int"))
    return lines.join(numbers, "path", "left").select(known.alias("file"), "split", "place", "value")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a text file, or of the files in a folder, as ``line_no, value`` with numbers from 0 without gaps.

    Only the splits are counted up in one task, a row for each.
    """
    lines = _placed_lines(spark, path)
    splits = lines.groupBy("file", "split").agg(F.count("*").alias("lines"), F.min("place").alias("first"))
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select("file", "split", "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("begin"))
    joined = lines.join(begins, ["file", "split"])
    return joined.select((F.col("begin") + F.col("place") - F.col("first")).alias("line_no"), "value")


def split_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The lines of a multi-line text column as ``line_no, value``, next to the columns in ``keep``."""
    return df.select(*keep, F.posexplode(F.split(text, "\n")).alias("pos", "value")).select(
        *keep, F.col("pos").cast("bigint").alias("line_no"), "value"
    )
