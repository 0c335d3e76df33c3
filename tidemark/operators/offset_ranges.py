"""Analysis of parsed offset ranges.

Input rows: ``line_no, topic, partition, from_offset, until_offset, delta``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.offset_lines import range_text

LOWEST = 3

# Fixed values of the text report.
RANGE_LINE = "\t%d-> %s"
STATS_LINE = "%s 统计: count=%d, minDelta=%d, maxDelta=%d, averageDelta=%d"
LOWEST_LINE = "\t最小Delta %d : %s"


def topic_stats(ranges: DataFrame) -> DataFrame:
    """A5: count, least, greatest and average delta per topic; the average is cut towards zero."""
    return ranges.groupBy("topic").agg(
        F.count("*").alias("cnt"),
        F.min("delta").alias("min_delta"),
        F.max("delta").alias("max_delta"),
        F.expr("sum(delta) div count(*)").alias("avg_delta"),
    )


def lowest_deltas(ranges: DataFrame, lowest: int = LOWEST) -> DataFrame:
    """The ``lowest`` smallest distinct deltas per topic, for topics with more of them than that.

    Of ranges with the same delta the last line is shown. Ranking keeps one row more than is
    reported: it proves that the topic has enough, and lets Spark cut each task's rows to that many
    per topic before they are brought together, however many a topic has.
    """
    per_delta = ranges.groupBy("topic", "delta").agg(
        *[F.max_by(c, "line_no").alias(c) for c in ("partition", "from_offset", "until_offset")]
    )
    by_delta = Window.partitionBy("topic").orderBy("delta")
    ranked = per_delta.withColumn("rank", F.row_number().over(by_delta)).filter(F.col("rank") <= lowest + 1)
    return (
        ranked.withColumn("__found", F.count("*").over(Window.partitionBy("topic")))
        .filter((F.col("__found") > lowest) & (F.col("rank") <= lowest))
        .select("topic", "rank", "delta", "partition", "from_offset", "until_offset")
    )


def ranges_by_topic(ranges: DataFrame) -> DataFrame:
    """A4: the ranges of each topic in line order, one row per range.

    The rows are dealt out by (topic, line) and sorted where they are: read in partition order they are the lists,
    and a topic of any size is spread over tasks.
    """
    order = ["topic", "line_no", "partition", "from_offset", "until_offset"]
    return ranges.select(*order, "delta").repartitionByRange(*order).sortWithinPartitions(*order)


def report_lines(ranges: DataFrame, lowest: int = LOWEST) -> DataFrame:
    """K8: the text report. Sort by ``topic, section, position`` to read it in order.

    Sections: 0 the topic name, 1 its ranges in line order, 2 its statistics, 3 its smallest deltas.
    """
    stats = topic_stats(ranges)
    place = ranges.schema["line_no"].dataType

    def section(df: DataFrame, number: int, position: Column, line: Column) -> DataFrame:
        return df.select(
            "topic", F.lit(number).alias("section"), position.cast(place).alias("position"), line.alias("line")
        )

    def entry(number: int, line) -> Column:
        return F.struct(F.lit(number).alias("section"), line.alias("line"))

    totals = F.format_string(STATS_LINE, "topic", "cnt", "min_delta", "max_delta", "avg_delta")
    headed = stats.select("topic", F.explode(F.array(entry(0, F.col("topic")), entry(2, totals))).alias("entry")).select(
        "topic", "entry.section", F.lit(0).cast(place).alias("position"), "entry.line"
    )
    listed = section(ranges, 1, F.col("line_no"), F.format_string(RANGE_LINE, F.col("partition"), range_text()))
    smallest = section(
        lowest_deltas(ranges, lowest), 3, F.col("rank"), F.format_string(LOWEST_LINE, F.col("delta"), range_text())
    )
    return headed.unionByName(listed).unionByName(smallest)


def write_report(report: DataFrame, path: str) -> None:
    """K8: the report as text files that are in order, by their names and within; read them with ``sources.text.numbered``.

    Its lines are dealt out by ranges of (topic, section, position), so that a topic of any size is spread over files.
    """
    order = ["topic", "section", "position"]
    report.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)
