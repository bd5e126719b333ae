import random

import pytest
from pyspark.sql import functions as F

from playtide.operators import lookup, skew
from playtide.operators.skew import hot_counted, hot_keys, measured_bytes, semi_join, split_hot_join


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, some keys are null, the rest are spread."""
    draw = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{draw.randrange(400)}") for i in range(3000)]
    return spark.createDataFrame(rows, "i int, k string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 400, 2)], "k string, v int")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def tasks_of(hot):
    return [] if hot.table is None else sorted(r["__tasks"] for r in hot.table.collect())


def rows_by_task(df):
    """How many rows each task of a join's last stage gives."""
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_hot_keys_are_counted(skewed, monkeypatch):
    counts = {r["k"]: r["n"] for r in skewed.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert tasks_of(hot_keys(skewed, ["k"], 40)) == [-(-counts["hot"] // 40)]
    assert hot_keys(skewed, ["k"], 1).null_tasks >= counts[None]
    assert hot_keys(skewed, ["k"]).table is None and hot_keys(skewed.limit(0), ["k"]).table is None
    several = sum(n > 5 for k, n in counts.items() if k is not None)
    assert several > 100 and len(tasks_of(hot_keys(skewed, ["k"], 5))) == several
    monkeypatch.setattr(skew, "MOST_HOT", 10)  # the limit rises: ten keys cannot all have over a tenth of the rows
    assert tasks_of(hot_keys(skewed, ["k"], 5)) == [-(-counts["hot"] * 10 // 3000)]


def test_counts_at_hand_give_the_same_hot_keys(skewed):
    counts = skewed.groupBy("k").agg(F.count("*").alias("rows"), F.max("i").alias("last"))
    given, counted = hot_counted(counts, ["k"], "rows", 40), hot_keys(skewed, ["k"], 40)
    assert tasks_of(given) == tasks_of(counted) and given.null_tasks == counted.null_tasks
    joined = split_hot_join(skewed, counts, ["k"], "inner", hot=given)
    assert same(joined, skewed.join(counts, "k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_split_join_equals_plain_join(skewed, dim, how):
    assert same(split_hot_join(skewed, dim, ["k"], how), skewed.join(dim, "k", how))
    assert same(split_hot_join(skewed, dim, ["k"], how, 20), skewed.join(dim, "k", how))


def test_split_join_spreads_the_hot_key(skewed, dim):
    hot = hot_keys(skewed, ["k"], 40)
    salts = skew._salted(skewed, ["k"], hot).groupBy("k").agg(F.countDistinct("__salt").alias("n"))
    found = {r.k: r.n for r in salts.collect()}
    assert found["hot"] == tasks_of(hot)[0] and found[None] > 1 and found["k1"] == 1


def test_split_join_with_int_and_bigint_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 0)], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (3, "b")], "k bigint, v string")
    assert split_hot_join(left, right, ["k"], "inner").count() == 200
    with pytest.raises(TypeError):
        split_hot_join(left, right.withColumn("k", F.col("k").cast("string")), ["k"], "inner")


def test_lookup_join_gives_the_same_either_way(skewed, dim):
    small = lookup.lookup_join(skewed, dim.withColumnRenamed("k", "name"), {"k": "name"})
    large = lookup.lookup_join(skewed, dim.withColumnRenamed("k", "name"), {"k": "name"}, limit_bytes=0)
    assert small.columns == ["i", "k", "name", "v"] and same(small, large)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()


def test_semi_join_does_not_multiply(skewed, spark):
    wanted = spark.createDataFrame([("hot",), ("hot",), ("k1",), (None,)], "k string")
    expected = skewed.where(F.col("k").isin("hot", "k1"))
    small, large = semi_join(skewed, wanted, "k"), semi_join(skewed, wanted, "k", 0, 40)
    assert same(small, expected) and same(large, expected)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
    assert "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning(k#" not in plans[0].split("BroadcastExchange")[0]
    assert "__salt" in plans[1]


def test_a_key_of_a_two_thousandth_is_split(spark):
    """20 of 40,000 rows: below what a sketch of a thousand keys tells apart."""
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    assert tasks_of(hot_keys(rows, ["k"], 8)) == [3]
    wanted = spark.createDataFrame([(-1,), (7,)], "k bigint")
    assert semi_join(rows, wanted, "k", 0, 8).count() == 21


@pytest.mark.parametrize("kind", ["aggregate", "distinct"])
def test_a_hot_key_is_split_next_to_an_aggregate(spark, kind):
    """Spark's own skew join leaves this one whole, as one input comes from an aggregate."""
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    counts = rows.groupBy("k").agg(F.count("*").alias("n")) if kind == "aggregate" else rows.select("k").distinct()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    held = {k: spark.conf.get(k) for k in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        how = "inner" if kind == "aggregate" else "left_semi"
        plain, split = rows.join(counts, "k", how), split_hot_join(rows, counts, ["k"], how, 500)
        assert max(rows_by_task(plain)) > 10_000
        assert sum(rows_by_task(split)) == 30_000 and max(rows_by_task(split)) < 7000  # of 8 tasks
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)


def test_measured_bytes_counts_text(spark):
    rows = spark.createDataFrame([("x" * 100, 1), (None, 2)], "s string, n int")
    assert measured_bytes(rows) == 100 + 2 * 32
    assert measured_bytes(rows.limit(0)) == 0


def test_names_fall_back_to_a_default(spark):
    names = spark.createDataFrame([("e1", "Play")], "id string, name string")
    rows = spark.createDataFrame([("e1",), ("e9",), (None,)], "e string")
    assert sorted(r.e for r in lookup.replace_by_name(rows, names, "e").collect()) == ["", "", "Play"]
    assert lookup.replace_by_name(rows, names, "e", None).where("e is null").count() == 2


def test_tournaments_of_unknown_properties_drop_out(spark):
    rows = spark.createDataFrame([(1, 10, "Cup"), (9, 11, "Other")], "property_id int, tournament_id int, name string")
    properties = spark.createDataFrame([(5, 1, "League")], "sport_id int, property_id int, name string")
    assert [tuple(r) for r in lookup.tournaments(rows, properties).collect()] == [(5, 1, 10, "Cup")]


def test_equal_copies_of_a_row_spread_too(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("k"), F.lit(1).alias("i"))
    hot = hot_keys(copies, ["k"], 400)
    assert skew._salted(copies, ["k"], hot).select("__salt").distinct().count() > 5
