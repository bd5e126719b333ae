"""Exchange-rate sheets and currency conversion."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from playtide.functions.times import closest_weekday, parse_date
from playtide.operators.lookup import lookup_join


def unpivot_rates(sheet: DataFrame, date_format: str = "dd MMM yyyy") -> DataFrame:
    """A wide sheet (``Date`` and one text column per currency) as date, currency, rate.

    Columns without a real name, and cells that hold no number (such as N/A), give no row.
    """
    currencies = [
        c for c in sheet.columns
        if c != "Date" and c.strip() and not re.fullmatch(r"_c\d+", c)
    ]
    cells = sheet.select(
        F.col("Date").cast("string").alias("Date"),
        *[F.col(f"`{c}`").cast("string").alias(c.strip()) for c in currencies],
    )
    long = cells.unpivot("Date", [c.strip() for c in currencies], "currency", "rate")
    return long.select(
        parse_date(F.col("Date"), date_format).alias("date"),
        "currency",
        F.trim("rate").try_cast("decimal(12,4)").alias("rate"),
    ).na.drop()


def rates_of_day(rates: DataFrame, day: str) -> DataFrame:
    """Rates of one day, given as ``yyyy/MM/dd``; an error when the sheet lacks it."""
    chosen = rates.where(F.col("date") == F.to_date(F.lit(day), "yyyy/MM/dd"))
    if chosen.isEmpty():
        raise ValueError(f"no exchange rates for {day}")
    return chosen


def rate_pairs(rates: DataFrame, currency: str) -> DataFrame:
    """Each rate beside the target currency's rate of the same day, one row per day and currency.

    A sheet loaded twice leaves duplicates, which would multiply the joined rows.
    """
    daily = rates.groupBy("date", "currency").agg(F.max("rate").cast("double").alias("rate"))
    target = F.max(F.when(F.col("currency") == currency.upper(), F.col("rate")))
    return daily.select(
        F.col("date").alias("rate_date"),
        F.col("currency").alias("rate_currency"),
        "rate",
        target.over(Window.partitionBy("date")).alias("target_rate"),
    )


def join_weekday_rates(df: DataFrame, rates: DataFrame, currency: str = "USD") -> DataFrame:
    """Add ``rate_date``, ``rate`` and ``target_rate`` of the closest weekday at or before ``ts``.

    The weekday rule becomes a column, so the join is a plain equi-join on currency and date.
    """
    dated = df.withColumn("rate_date", closest_weekday(F.col("ts").cast("date")))
    pairs = rate_pairs(rates, currency).withColumnRenamed("rate_date", "__day")
    joined = lookup_join(dated, pairs, {"currency": "rate_currency", "rate_date": "__day"})
    return joined.drop("rate_currency", "__day")


def convert_currency(
    df: DataFrame,
    rates: DataFrame,
    column: str = "amount_with_tax",
    currency: str = "USD",
    on_missing: str = "error",
) -> DataFrame:
    """Add ``<column>_<currency>``: the amount in the target currency, rounded to a whole number.

    Rates are per one unit of the sheet's base currency, so an amount goes to the base and from
    there to the target. Rows already in the target currency keep their amount, rows without a
    currency drop out, and a null amount stays null. A missing rate fails the query when it runs, within the same pass over the
    data; ``on_missing="null"`` leaves the new column null instead.
    """
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    currency = currency.upper()  # as the sheet's currencies
    known = df.where(F.col("currency").isNotNull())
    joined = join_weekday_rates(known, rates, currency)
    amount = F.col(column)
    converted = F.round(amount.cast("double") / F.col("rate") * F.col("target_rate")).cast("bigint")
    if on_missing == "error":
        message = F.concat(
            F.lit("no exchange rate for "), F.col("currency"), F.lit(" on "), F.col("rate_date").cast("string")
        )
        no_rate = F.col("rate").isNull() | F.col("target_rate").isNull()
        converted = F.when(no_rate, F.raise_error(message).cast("bigint")).otherwise(converted)
    same = F.col("currency") == currency
    new = F.when(same, amount.cast("bigint")).otherwise(converted)
    return joined.withColumn(f"{column}_{currency.lower()}", new).drop("rate_date", "rate", "target_rate")
