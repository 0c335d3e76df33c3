"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every transform relies on: UTC conversions, last-one-wins for a repeated JSON name, state that lives on
# disk (RocksDB) instead of the executor heap, and batches for Python that long texts do not swell.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "tidemark", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **RUNTIME_CONF,
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path for checkpoints and written tables, in the folder that the cluster names."""
    parent = shared_parent(spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master)
    return f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_parent(named: str | None, master: str) -> str:
    """Only a local session may go without a named folder: a machine-local one is lost with its executor."""
    if named:
        return named
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_parent()


@functools.cache
def _local_parent() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")
