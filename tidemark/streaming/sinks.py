"""Stream writers (K1-K7, K9).

Each function returns a ``DataStreamWriter``; call ``start()`` on it. The checkpoint is the record of
progress: a query restarted with the same one goes on where it stopped (X2, S4).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import drop_folder

# Checkpoint and bucket-check intervals, and the name of an hourly bucket.
CHECKPOINT_INTERVAL = "10 seconds"
BUCKET_INTERVAL = "5 seconds"
BUCKET_FORMAT = "yyyy-MM-dd--HH"

# Micro-batches after which a changelog is folded.
FOLD_EVERY = 100


def _writer(df: DataFrame, checkpoint: str, mode: str, interval: str | None) -> DataStreamWriter:
    """``interval=None`` takes what is there now and ends; otherwise the query runs on."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def batch_writer(
    df: DataFrame, checkpoint: str, mode: str, interval: str | None, write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return _writer(df, checkpoint, mode, interval).foreachBatch(write)


def kafka_sink(
    df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append", interval: str | None = CHECKPOINT_INTERVAL
) -> DataStreamWriter:
    """K1: the text column ``value`` to a topic."""
    writer = _writer(df.select("value"), checkpoint, mode, interval).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic)


def console_sink(
    df: DataFrame, checkpoint: str, prefix: str = "", mode: str = "append", interval: str | None = CHECKPOINT_INTERVAL
) -> DataStreamWriter:
    """K3: the text column ``value`` to the console."""
    lines = df.select(F.concat(F.lit(prefix), "value").alias("value"))
    return _writer(lines, checkpoint, mode, interval).format("console").option("truncate", False)


def memory_sink(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """K4: rows kept on the driver under a table name. For tests on small inputs."""
    return _writer(df, checkpoint, mode, None).format("memory").queryName(name)


def with_bucket(df: DataFrame, time: str | Column | None = None) -> DataFrame:
    """Name the hourly bucket of each row, by the clock or by a time column."""
    if time is None:
        time = F.current_timestamp()
    return df.withColumn("bucket", F.date_format(time, BUCKET_FORMAT))


def bucketed_text_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    time: str | Column | None = None,
    files_per_bucket: int | None = None,
    interval: str | None = BUCKET_INTERVAL,
    roll_records: int | None = None,
) -> DataStreamWriter:
    """K2: the text column ``value``, one line per row, in a folder per hour; read with :func:`read_buckets`.

    By the clock, a micro-batch writes to one hour. By a time column each task may write to many;
    ``files_per_bucket`` then brings the rows of an hour together in that many tasks, so that there
    are fewer files and no single task gets a whole busy hour. The task goes by a hash of all columns of ``df``,
    so equal texts are spread as far as their rows differ. ``roll_records`` begins a new file after so many lines.
    Each micro-batch adds files of its own; :func:`fold_buckets` makes them few.
    """
    lines = with_bucket(df, time)
    if files_per_bucket:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        lines = lines.withColumn("__part", part).repartition("bucket", "__part")
    lines = lines.select("bucket", "value")
    writer = _writer(lines, checkpoint, "append", interval).format("text").option("path", path)
    if roll_records:
        writer = writer.option("maxRecordsPerFile", roll_records)
    return writer.partitionBy("bucket")


def _bucket_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.schema("value STRING, bucket STRING").text(path)
    return lines.select("value", "bucket", F.col("_metadata.file_path").alias("file"))


def _folded_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``file, fold``: the files of the sink that are folded, and by which fold; none before the first."""
    try:
        return spark.read.schema("file STRING, fold STRING").parquet(f"{path}-folded/done")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def fold_buckets(spark: SparkSession, path: str, before: str | None = None, files_per_bucket: int = 1) -> int:
    """Bring the files of the hours before the bucket ``before`` (the newest one there is) into few, and say how many there were.

    The lines go to ``<path>-folded``; the fold counts from the moment its list of files is there, which is one file. A reader
    sees each line once at any time, and so it does if a fold is stopped half way or if lines of an hour come after its
    fold: their files are not on a list. The files of the sink stay for readers that have begun, and for the sink's log.
    """
    lines, done = _bucket_lines(spark, path), _folded_files(spark, path)
    if before is None:
        before = lines.agg(F.max("bucket")).first()[0] or ""
    open_ = lines.filter(F.col("bucket") < before)
    if done is not None:
        open_ = open_.join(done, "file", "left_anti")
    files = [r.file for r in open_.select("file").distinct().collect()]
    if not files:
        return 0
    fold = uuid.uuid4().hex
    # From here on exactly these files: the sink may add some meanwhile.
    listed = spark.createDataFrame([(f, fold) for f in files], "file string, fold string")
    chosen = lines.join(listed, "file", "left_semi")
    part = F.pmod(F.xxhash64("file", F.monotonically_increasing_id()), F.lit(files_per_bucket))
    chosen = chosen.withColumn("part", part).repartition("bucket", "part").select("value", "bucket")
    chosen.write.partitionBy("bucket").text(f"{path}-folded/lines/fold={fold}")
    listed.coalesce(1).write.mode("append").parquet(f"{path}-folded/done")
    return len(files)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """``value, bucket``: all lines of a bucketed text sink, each once, from folded files as far as there are."""
    lines, done = _bucket_lines(spark, path), _folded_files(spark, path)
    if done is None:
        return lines.drop("file")
    folds = [f"{path}-folded/lines/fold={r.fold}" for r in done.select("fold").distinct().collect()]
    folded = [spark.read.schema("value STRING, bucket STRING").text(f).select("value", "bucket") for f in folds]
    return reduce(DataFrame.unionByName, folded, lines.join(done, "file", "left_anti").select("value", "bucket"))


def append_sink(df: DataFrame, path: str, checkpoint: str, interval: str | None = CHECKPOINT_INTERVAL) -> DataStreamWriter:
    """K7: rows that are final, as Parquet. An aggregate needs a watermark."""
    return _writer(df, checkpoint, "append", interval).format("parquet").option("path", path)


def changelog_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
    keys: tuple[str, ...] = (),
    fold_every: int = FOLD_EVERY,
) -> DataStreamWriter:
    """K6: every change of the result, a folder per micro-batch; read with :func:`latest_rows`.

    A micro-batch that is run again replaces its own folder. Given the ``keys`` of the result, every ``fold_every``
    micro-batches the older folders are folded into one, so the log stays about as long as the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys and batch_id > 1 and batch_id % fold_every == 0:
            _fold(batch.sparkSession, path, keys, batch_id - 1)

    return batch_writer(df, checkpoint, "update", interval, write)


def _fold(spark: SparkSession, path: str, keys: tuple[str, ...], last: int) -> None:
    """Add to the folder of batch ``last``, which is never run again, the newest rows of keys that it lacks, and remove
    the older folders. At each step a reader finds the newest row of every key."""
    log = spark.read.parquet(path)
    older, newer = log.filter(F.col("batch_id") < last), log.filter(F.col("batch_id") == last).select(*keys)
    same = reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    rest = latest_rows(older, *keys).alias("o").join(newer.alias("n"), same, "left_anti")
    rest.write.mode("append").parquet(f"{path}/batch_id={last}")
    for row in older.select("batch_id").distinct().collect():
        drop_folder(spark, f"{path}/batch_id={row.batch_id}")


def latest_rows(changelog: DataFrame, *keys: str) -> DataFrame:
    """The result that a changelog leads to: the newest row of each key."""
    rest = [c for c in changelog.columns if c not in (*keys, "batch_id")]
    return changelog.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The newest of the results in the folder of a snapshot sink."""
    newest = snapshots.agg(F.max("batch_id").alias("newest")).first().newest
    return snapshots.where(F.col("batch_id") == newest).drop("batch_id")


def snapshot_sink(df: DataFrame, path: str, checkpoint: str, interval: str | None = CHECKPOINT_INTERVAL) -> DataStreamWriter:
    """K6 as a whole: each micro-batch writes the full result to a folder of its own; read with :func:`latest_snapshot`.

    The last two stay, so a reader always finds a whole one. State and output are the full result (complete mode keeps
    all of it), so this is for results that stay small.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        drop_folder(batch.sparkSession, f"{path}/batch_id={batch_id - 2}")

    return batch_writer(df, checkpoint, "complete", interval, write)
