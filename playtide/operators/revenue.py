"""Revenue by realm, payment provider, currency and time bucket."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from playtide.functions.times import bucket_start

KEYS = ("realm_id", "payment_provider", "currency", "ts")


def in_time_range(
    df: DataFrame, start: str | datetime | None = None, end: str | datetime | None = None
) -> DataFrame:
    """Rows with ``start <= ts < end``; without a start all rows are kept, whatever the end."""
    if not start:
        return df
    kind = df.schema["ts"].dataType
    kept = df.where(F.col("ts") >= F.lit(start).cast(kind))
    return kept.where(F.col("ts") < F.lit(end).cast(kind)) if end else kept


def nonzero_amounts(payments: DataFrame) -> DataFrame:
    """Payments with an amount that is neither missing nor zero."""
    # Plain comparisons, which reach the Parquet scan.
    return payments.where(F.col("amount_with_tax").isNotNull() & (F.col("amount_with_tax") != 0))


def _bucketed(payments: DataFrame, window: str, week_mode: str, needed: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Amounts by bucket; rows without a ``needed`` column go before the bucket is worked out, so the scan skips them."""
    rows = nonzero_amounts(payments).na.drop(subset=list(needed))
    return rows.withColumn("ts", bucket_start(F.col("ts"), window, week_mode))


def revenue_by_window(payments: DataFrame, window: str, week_mode: str = "calendar") -> DataFrame:
    """Sum of amounts per realm, provider, currency and bucket, for rows that have all of them."""
    amounts = _bucketed(payments, window, week_mode, KEYS)
    return amounts.groupBy(*KEYS).agg(F.sum("amount_with_tax").alias("amount_with_tax"))


def revenue_cube(payments: DataFrame, window: str, week_mode: str = "calendar") -> DataFrame:
    """All 16 grouping sets of the revenue keys; ``grouping_id`` tells them apart.

    The cube copies each of its input rows 16 times, so it runs over the finest sums.
    """
    finest = _bucketed(payments, window, week_mode).groupBy(*KEYS).agg(
        F.sum("amount_with_tax").alias("amount_with_tax")
    )
    return finest.cube(*KEYS).agg(
        F.sum("amount_with_tax").alias("amount_with_tax"),
        F.grouping_id().alias("grouping_id"),
    )
