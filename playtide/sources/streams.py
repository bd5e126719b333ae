"""Stream sources; the connector and its options come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_stream(
    spark: SparkSession, fmt: str, options: dict[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """Any Structured Streaming source whose connector is on the classpath.

    The start position (latest or earliest) is one of the connector's options.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def read_text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New text files of a folder, one row ``value`` per line."""
    options = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    return read_stream(spark, "text", options, path)
