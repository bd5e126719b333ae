from datetime import date

import pytest
from pyspark.sql import functions as F

from playtide.functions import fields, times


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_sorted_join_skips_nulls_and_keeps_null_arrays(spark):
    rows = spark.createDataFrame([(["b", None, "a"],), ([],), (None,)], "items array<string>")
    assert [r[0] for r in rows.select(fields.sorted_join(F.col("items"))).collect()] == ["a,b", "", None]


@pytest.mark.parametrize("code,name", [(1, "SESSION_CHECK"), (8, "HEALTH_CHECK"), (-1, "OTHER"), (99, None), (None, None)])
def test_action_name(spark, code, name):
    assert one(spark, fields.action_name(F.lit(code).cast("tinyint"))) == name


def test_key_values_last_wins(spark):
    assert one(spark, fields.key_values(F.lit("a=1&b=2&a=3=4&c"))) == {"a": "3", "b": "2", "c": None}
    assert one(spark, fields.key_values(F.lit("a:1|b:2"), "|", ":")) == {"a": "1", "b": "2"}


def test_last_part_matching_takes_first_field(spark):
    entries = F.create_map(*[F.lit(x) for x in ("a", "1", "smtp-timestamp", "2", "timestamp", "3")])
    assert one(spark, fields.last_part_matching(entries, "timestamp")) == "2"
    assert one(spark, fields.last_part_matching(entries, "zone")) is None


def test_millis_to_timestamp(spark):
    assert one(spark, times.millis_to_timestamp(F.lit("1528672255490")).cast("string")) == "2018-06-10 23:10:55.49"
    assert one(spark, times.millis_to_timestamp(F.lit("n/a"))) is None


@pytest.mark.parametrize("text,pattern,expected", [
    ("01 January 2018", "dd MMM yyyy", date(2018, 1, 1)),
    ("1 Jan 2018", "dd MMM yyyy", date(2018, 1, 1)),
    ("2018-01-01", "yyyy-MM-dd", date(2018, 1, 1)),
    ("2018-01-01", "dd MMM yyyy", None),
])
def test_parse_date(spark, text, pattern, expected):
    assert one(spark, times.parse_date(F.lit(text), pattern)) == expected


@pytest.mark.parametrize("day,expected", [
    ("2018-01-01", "2018-01-01"), ("2018-01-05", "2018-01-05"), ("2018-01-06", "2018-01-05"), ("2018-01-07", "2018-01-05"),
])
def test_closest_weekday(spark, day, expected):
    assert str(one(spark, times.closest_weekday(F.lit(day).cast("date")))) == expected


@pytest.mark.parametrize("window,mode,expected", [
    ("hour", "calendar", "2024-01-15 10:00:00"), ("day", "calendar", "2024-01-15 00:00:00"),
    ("week", "calendar", "2024-01-15 00:00:00"), ("week", "epoch", "2024-01-11 00:00:00"),
    ("month", "calendar", "2024-01-01 00:00:00"),
])
def test_bucket_start(spark, window, mode, expected):
    rows = spark.createDataFrame([("2024-01-15 10:20:30",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert rows.select(times.bucket_start(F.col("t"), window, mode).cast("string")).first()[0] == expected


def test_bucket_start_rejects_unknown_windows():
    with pytest.raises(ValueError):
        times.bucket_start(F.col("t"), "year")


def test_date_parts(spark):
    parts = times.date_parts(F.lit("2018-06-01 05:04:03").cast("timestamp"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert row.asDict() == {"date": "2018-06-01", "year": "2018", "month": "06", "day": "01", "hour": "05"}


@pytest.mark.parametrize("text", [
    "Mon, 01 Jan 2018 10:00:00 +0000", "1 Jan 2018 12:00:00 +0200", "2018-01-01T10:00:00Z", "2018-01-01 10:00:00",
])
def test_loose_timestamp(spark, text):
    assert one(spark, times.loose_timestamp(F.lit(text)).cast("string")) == "2018-01-01 10:00:00"


def test_row_ids(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("n", "abc")], "x string, y string")
    for mode in ("digest", "hash", "sequence"):
        ids = [r["id"] for r in fields.add_row_id(rows, "id", mode).collect()]
        assert len(set(ids)) == 4
    again = fields.add_row_id(rows.repartition(3), "id")
    assert again.exceptAll(fields.add_row_id(rows, "id")).isEmpty()
    with pytest.raises(ValueError):
        fields.add_row_id(rows, "id", "random")


def test_drop_nested(spark):
    rows = spark.sql("""
        select 1 k, named_struct('a', 1, 'b', named_struct('c', 2, 'd', 3),
          'items', array(named_struct('x', 1, 'y', 2), named_struct('x', 3, 'y', 4))) s""")
    def names(path):
        return fields.drop_nested(rows, path).schema.simpleString()
    assert "c:int" not in names("s.b.c") and "d:int" in names("s.b.c")
    assert names("s.nothing") == names("t.nothing") == rows.schema.simpleString()
    slim = fields.drop_nested(rows, "s.items.x").first()["s"]["items"]
    assert [item.asDict() for item in slim] == [{"y": 2}, {"y": 4}]
    assert fields.drop_nested(rows, "k").columns == ["s"]
