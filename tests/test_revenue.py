from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playtide.operators import rates as rate_ops, revenue as ops
from playtide.plans.revenue import exchange_rates, revenue_rollup

PAYMENT = "realm_id int, payment_provider string, currency string, amount_with_tax int, ts timestamp"


def at(minutes, day=1):
    return datetime(2018, 1, day, minutes // 60, minutes % 60)


@pytest.fixture
def payments(spark):
    return spark.createDataFrame([
        (1, "STRIPE", "TRY", 0, at(0)), (1, "STRIPE", "AUD", None, at(0)),
        (1, "STRIPE", "USD", 100, at(0)), (1, "STRIPE", "USD", 100, at(1)),
        (1, "STRIPE", "GBP", 799, at(2)), (1, "STRIPE", "GBP", 799, at(3)),
        (1, "GOOGLE_IAP", "USD", 100, at(4)), (1, "GOOGLE_IAP", "USD", 100, at(5)),
        (2, "APPLE_IAP", "USD", 100, at(6)), (2, "APPLE_IAP", "USD", 100, at(7)),
        (1, "STRIPE", "USD", 100, at(60)), (1, "STRIPE", "USD", 100, at(61)),
    ], PAYMENT)


@pytest.mark.parametrize("start,end,n", [
    ("2018-01-01 00:00:00", None, 12), ("2018-01-01 00:00:00", "2018-01-01 01:00:00", 10),
    (None, "2018-01-01 01:00:00", 12), ("2018-01-01 01:00:00", None, 2),
])
def test_time_range(payments, start, end, n):
    assert ops.in_time_range(payments, start, end).count() == n


def test_hourly_revenue(payments):
    rows = {(r.realm_id, r.payment_provider, r.currency, r.ts.hour, r.amount_with_tax)
            for r in ops.revenue_by_window(payments, "hour").collect()}
    assert rows == {
        (1, "STRIPE", "USD", 0, 200), (1, "STRIPE", "GBP", 0, 1598), (1, "GOOGLE_IAP", "USD", 0, 200),
        (2, "APPLE_IAP", "USD", 0, 200), (1, "STRIPE", "USD", 1, 200),
    }


def test_finest_cube_rows_are_the_rollup(payments):
    cube = ops.revenue_cube(payments, "hour")
    finest = cube.where("grouping_id = 0").drop("grouping_id").na.drop()
    assert finest.exceptAll(ops.revenue_by_window(payments, "hour")).isEmpty()
    plain = payments.where("amount_with_tax <> 0").withColumn("ts", F.date_trunc("hour", "ts")).cube(*ops.KEYS).agg(
        F.sum("amount_with_tax").alias("amount_with_tax"), F.grouping_id().alias("grouping_id"))
    assert sorted(map(str, cube.collect())) == sorted(map(str, plain.collect()))


def test_rows_without_a_key_are_left_out(spark, payments):
    more = payments.unionByName(spark.createDataFrame([(None, "STRIPE", "USD", 5, at(0)), (1, None, "USD", 5, at(0))], PAYMENT))
    assert ops.revenue_by_window(more, "hour").count() == 5


RATES = [(date(2018, 1, 1), "GBP", 1.15), (date(2018, 1, 1), "USD", 1.30), (date(2018, 1, 5), "GBP", 1.10), (date(2018, 1, 5), "USD", 1.20)]


@pytest.fixture
def rates(spark):
    return spark.createDataFrame(RATES, "date date, currency string, rate double")


def pounds(spark):
    return spark.createDataFrame([(1, "STRIPE", "GBP", a, at(0, d)) for a, d in ((10000, 1), (20000, 6), (30000, 7))], PAYMENT)


def test_conversion_uses_the_weekday_before(spark, rates):
    converted = rate_ops.convert_currency(pounds(spark), rates)
    assert len(converted.columns) == 6
    assert sorted(r.amount_with_tax_usd for r in converted.collect()) == [11304, 21818, 32727]


def test_conversion_keeps_target_rows_and_drops_rows_without_currency(spark, rates):
    rows = spark.createDataFrame([(1, "S", "USD", 77, at(0, 20)), (1, "S", "USD", None, at(0, 20)), (1, "S", None, 5, at(0))], PAYMENT)
    assert sorted(str(r.amount_with_tax_usd) for r in rate_ops.convert_currency(rows, rates).collect()) == ["77", "None"]


def test_rates_loaded_twice_do_not_multiply_rows(spark, rates):
    assert rate_ops.convert_currency(pounds(spark), rates.unionAll(rates)).count() == 3


def test_missing_rate_fails_or_gives_null(spark, rates):
    late = spark.createDataFrame([(1, "STRIPE", "GBP", 100, at(0, 9))], PAYMENT)
    with pytest.raises(PySparkException, match="no exchange rate for GBP on 2018-01-09"):
        rate_ops.convert_currency(late, rates).collect()
    assert rate_ops.convert_currency(late, rates, on_missing="null").first().amount_with_tax_usd is None


def test_other_target_currency(spark, rates):
    dollars = spark.createDataFrame([(1, "S", "USD", 1300, at(0))], PAYMENT)
    assert rate_ops.convert_currency(dollars, rates, currency="GBP").first().amount_with_tax_gbp == 1150


def test_rollup_pipeline(payments, rates):
    rows = revenue_rollup(payments, rates, "day", "2018-01-01 00:00:00", "2018-01-01 01:00:00")
    assert rows.columns == ["realm_id", "payment_provider", "currency", "ts", "amount", "amount_usd"]
    found = {(r.realm_id, r.payment_provider, r.currency, r.amount, r.amount_usd) for r in rows.collect()}
    assert found == {(1, "STRIPE", "USD", 200, 200), (1, "STRIPE", "GBP", 1598, 1806), (1, "GOOGLE_IAP", "USD", 200, 200), (2, "APPLE_IAP", "USD", 200, 200)}


def sheet(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in columns))


def test_sheet_columns_without_a_name_are_ignored(spark):
    wide = sheet(spark, ["Date", "GBP", " USD", "_c1", "  "], ("01 January 2018", "1.1000", "1.000", " ", " "))
    rates = exchange_rates(wide)
    assert rates.columns == ["date", "currency", "rate"]
    assert {(str(r.date), r.currency, str(r.rate)) for r in rates.collect()} == {("2018-01-01", "GBP", "1.1000"), ("2018-01-01", "USD", "1.0000")}
    assert dict(rates.dtypes) == {"date": "date", "currency": "string", "rate": "decimal(12,4)"}


def test_sheet_cells_without_a_number_are_dropped(spark):
    assert exchange_rates(sheet(spark, ["Date", "GBP"], ("01 January 2018", "N/A"))).count() == 0


def test_rates_of_one_day(spark):
    wide = sheet(spark, ["Date", "GBP"], ("01 January 2018", "1.1"), ("02 January 2018", "1.2"))
    assert [str(r.rate) for r in exchange_rates(wide, day="2018/01/02").collect()] == ["1.2000"]
    with pytest.raises(ValueError):
        exchange_rates(wide, day="2018/01/03")


def test_the_time_range_reaches_the_scan(spark, payments, tmp_path):
    payments.write.parquet(str(tmp_path / "p"))
    rows = ops.in_time_range(spark.read.parquet(str(tmp_path / "p")), "2018-01-01 00:00:00", "2018-01-01 01:00:00")
    plan = ops.revenue_by_window(rows, "hour")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2018-01-01" in plan and "LessThan(ts,2018-01-01" in plan
