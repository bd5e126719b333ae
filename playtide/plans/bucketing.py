"""Events by date and hour, and the day a table was last filled to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playtide.functions.times import date_parts
from playtide.operators.lookup import split_realm

PARTITIONS = ("year", "month", "day", "hour")
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@dataclass(frozen=True)
class Buckets:
    events: DataFrame
    per_date: DataFrame
    missed: DataFrame


def bucket_events(events: DataFrame, realms: DataFrame) -> Buckets:
    """Events of known realms with their date parts, and how many there are per date."""
    known, missed = split_realm(events, realms)
    rows = dated(known)
    return Buckets(rows, count_per_date(rows), missed)


def dated(known: DataFrame) -> DataFrame:
    """Events whose realm is resolved, with their date parts."""
    return known.withColumns(date_parts(F.col("ts")))


def count_per_date(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date").agg(F.count("date").alias("count")).orderBy("date")


def write_buckets(rows: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Write events under ``year=/month=/day=/hour=`` folders.

    The rebalance hint gathers an hour's events into few files and splits an hour that is too
    large for one task.
    """
    writer = rows.hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS)
    if fmt == "json":
        writer = writer.option("timestampFormat", JSON_TIMESTAMP)
    writer.format(fmt).save(path)


def high_water_mark(
    table: DataFrame, column: str = "start_at", today: Column | None = None
) -> DataFrame:
    """The last day in a table as ``yyyy/MM/dd``, or yesterday when the table is empty."""
    yesterday = F.date_sub(F.current_date() if today is None else today, 1)
    last = F.coalesce(F.max(column).cast("date"), yesterday)
    return table.agg(F.date_format(last, "yyyy/MM/dd").alias("day"))
