"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# The event schema has two fields that differ only by case (``ta`` and ``TA``), and all
# timestamps are UTC.
REQUIRED_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to a session someone else built."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scale_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a batch run over ``input_bytes`` of input.

    AQE merges small shuffle partitions but never splits an aggregation's partition, so the
    starting number has to fit the input: one partition per 128 MB, at least three per core.
    """
    partitions = max(3 * cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),  # operators that number their groups read this one
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * TARGET_PARTITION_BYTES),
    }


def build_session(
    app: str = "playtide", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **REQUIRED_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        # Streaming totals keep one row of state per key; RocksDB holds it off-heap and on disk.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


#: Folders that this process made under the shared folder, and those of the scope that is open.
_MADE: list[str] = []
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    path = f"{base.rstrip('/')}/playtide/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    (_MADE if scope is None else scope).append(path)
    return path


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders of this library's own making, wherever Spark can reach them."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, also after an error; frames that read it must be used before."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        remove_folders(spark, made)


def clear_work(spark: SparkSession) -> None:
    """Remove what this process has staged outside of scopes. Call it when no result that reads it is needed any more."""
    remove_folders(spark, _MADE)
    _MADE.clear()
