"""Load-stream builder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of a generated record.
DEFAULT_MESSAGE = "hello i am a test message"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def ticks(spark: SparkSession, rate: int, count: int = -1) -> DataFrame:
    """``timestamp, value`` rows: endless at ``rate`` per second, or a bounded table of ``count``."""
    if count < 0:
        return spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    return spark.range(count).select(F.current_timestamp().alias("timestamp"), F.col("id").alias("value"))


def generated_records(ticks: DataFrame, template: dict[str, list] | None = None, seed: int | None = None) -> DataFrame:
    """One JSON record per ``timestamp, value`` row.

    A template names the fields and the values to draw from; fields without values are left out.
    The counter is the row's ``value``, as text.
    """
    fields = []
    if template:
        for position, (name, choices) in enumerate(template.items()):
            if choices:
                draw = F.rand() if seed is None else F.rand(seed + position)
                texts = F.array(*[F.lit(json.dumps(c)) for c in choices])
                picked = F.element_at(texts, (F.floor(draw * len(choices)) + 1).cast("int"))
                fields += [F.lit(name), F.parse_json(picked)]
    else:
        fields += [F.lit("@message"), F.lit(DEFAULT_MESSAGE).cast("variant")]
        fields += [F.lit("@tid"), F.spark_partition_id().cast("bigint").cast("variant")]
    fields += [F.lit("@timestamp"), F.date_format("timestamp", TIMESTAMP_FORMAT).cast("variant")]
    fields += [F.lit("batchCount"), F.col("value").cast("string").cast("variant")]
    return ticks.select(F.to_json(F.create_map(*fields)).alias("value"))
