"""Revenue tables per hour, day, week or month, with amounts in one target currency."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from playtide.operators.rates import convert_currency, rates_of_day, unpivot_rates
from playtide.operators.revenue import in_time_range, revenue_by_window

TABLES = {
    "hour": "revenue_hourly",
    "day": "revenue_daily",
    "week": "revenue_weekly",
    "month": "revenue_monthly",
}


def revenue_rollup(
    payments: DataFrame,
    rates: DataFrame,
    window: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    currency: str = "USD",
    week_mode: str = "calendar",
    on_missing: str = "error",
) -> DataFrame:
    """Revenue rows of one window size: keys, amount, and amount in the target currency.

    Payments are summed before they meet the rates, so the conversion sees one row per key and
    bucket however many payments there are. It uses the rate of the bucket's first day; the label
    is the calendar start of that day's hour, day, week or month.
    """
    sums = revenue_by_window(in_time_range(payments, start, end), window, week_mode)
    converted = convert_currency(sums, rates, "amount_with_tax", currency, on_missing)
    suffix = currency.lower()
    labelled = converted.withColumn("ts", F.date_trunc(window, "ts"))
    return labelled.withColumnsRenamed(
        {"amount_with_tax": "amount", f"amount_with_tax_{suffix}": f"amount_{suffix}"}
    ).select("realm_id", "payment_provider", "currency", "ts", "amount", f"amount_{suffix}")


def exchange_rates(
    sheet: DataFrame, date_format: str = "dd MMM yyyy", day: str | None = None
) -> DataFrame:
    """Rates from a wide sheet, of all its days or of one day (``yyyy/MM/dd``) that must exist."""
    rates = unpivot_rates(sheet, date_format)
    return rates_of_day(rates, day) if day else rates
