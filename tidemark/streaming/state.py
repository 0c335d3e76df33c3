"""What streaming queries hold in their state (M1, X1), read from their checkpoints with Spark's state data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def window_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys of the windows that are still open, with the partition of the state that holds them."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "partition_id")


def throttle_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key, last``: the last emissions that a :func:`throttle_stream` has stopped with.

    As the ``initial`` of another one they carry it over to a new checkpoint, such as one with more partitions.
    """
    state = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    # Checkpoints from before the buckets have a single value per key.
    key, value = ("user_map_key", "user_map_value") if "user_map_key" in state.columns else ("key", "value")
    # State with a time limit has the time at which it ends next to its value.
    held = f"{value}.value" if "ttlExpirationMs" in state.schema[value].dataType.names else value
    return state.selectExpr(f"{key}.key as key", f"{held}.ms as last")
