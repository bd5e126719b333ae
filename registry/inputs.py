"""Operator inputs derived from the given tables: event logs, lookups, rate sheets, messages.

The tables hold no media events, so each input is a projection of a whole table. The SQL in
``registry.oracles`` states the same projections for DuckDB.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from playtide.plans import accounts
from playtide.plans.revenue import exchange_rates
from playtide.schemas import EVENT
from playtide.session import configure, work_dir

JSON_TS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with ``k`` from its JSON text and a zoned timestamp."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumns({"k": k, "ts": F.col("ts").cast("timestamp")})


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _struct(kind: T.StructType, values: dict[str, str]) -> str:
    """SQL for a struct of the given type from SQL per field; fields without a value are null."""
    return f"named_struct({', '.join(f"'{name}', {sql}" for name, sql in _typed(kind, values).items())})"


def _typed(kind: T.StructType, values: dict[str, str]) -> dict[str, str]:
    """SQL per field, in field order. A struct is taken as built: a cast would hide its fields from Catalyst."""
    return {
        f.name: values[f.name] if f.name in values and isinstance(f.dataType, T.StructType)
        else f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in kind.fields
    }


def _event_rows(
    rows: DataFrame, data: dict[str, str], payload: dict[str, str], top: dict[str, str], *keep: str
) -> DataFrame:
    payload_type = EVENT["payload"].dataType
    nested = {**payload, "data": _struct(payload_type["data"].dataType, data)}
    root = _typed(EVENT, {**top, "payload": _struct(payload_type, nested)})
    return rows.selectExpr(*[f"{sql} AS {name}" for name, sql in root.items()], *keep)


def event_log(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """One media event per row of ``events``; ``keep`` names columns of that table to carry along."""
    cid = "CASE WHEN k = 1 THEN '' WHEN k > 1 THEN concat('s', user_id, '-', date_format(ts, 'yyyyMMdd')) END"
    data = {
        "ta": "event_type",
        "TA": """CASE event_type
            WHEN 'signup' THEN 'REGISTER_USER'
            WHEN 'purchase' THEN 'SUCCESSFUL_PURCHASE'
            WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'FAILED_LOGIN' WHEN k % 4 > 1 THEN 'SUCCESSFUL_LOGIN' END
            WHEN 'click' THEN CASE k % 10 WHEN 0 THEN 'EVENT_WENT_LIVE' WHEN 1 THEN 'EVENT_WENT_NOTLIVE' ELSE 'OK' END
            ELSE 'OK' END""",
        "cid": cid,
        "device": "elt(k % 3 + 1, 'BROWSER', 'IOS', 'ANDROID')",
        "startedAt": "if(k % 20 = 2, 'n/a', string(unix_millis(date_trunc('day', ts))))",
        "DGE_EVENT_ID": "k",
        "PAYMENT_PROVIDER": "elt(k % 3 + 1, 'STRIPE', 'GOOGLE_IAP', 'APPLE_IAP')",
        "PRICE_WITH_TAX_AMOUNT": "CASE WHEN k % 10 = 0 THEN 0 WHEN k % 10 < 9 THEN round(value * 100) END",
        "PRICE_WITH_TAX_CURRENCY": "elt(k % 4 + 1, 'USD', 'GBP', 'AUD', NULL)",
        "IS_TRIAL": "k % 2 = 0",
        "TRIAL_DAYS": "k % 8",
        "REVOKED": "k % 7 = 0",
        "CANCELLED": "k % 6 = 0",
        "SKU": "concat('sku-', k % 5)",
    }
    payload = {
        "action": "CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'error' THEN 6 WHEN 'signup' THEN 7 ELSE -1 END",
        "cid": cid,
        "progress": "floor(value * 10)",
        "video": "k % 5",
    }
    top = {
        "clientIp": "concat('10.0.', user_id % 7, '.', k)",
        "country": "elt(int(user_id % 4) + 1, 'GB', 'US', 'FR', NULL)",
        "customerId": "user_id",
        "realm": "concat('NATION_', user_id % 30)",
        "town": "concat('T', user_id % 13)",
        "ts": "ts",
    }
    return _event_rows(events(spark, sf_dir), data, payload, top, *keep)


def catalogue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue event per row of ``part``; its type follows the part's type."""
    small = "p_partkey % 2000000000"
    start = "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, int(p_partkey))"
    video = {
        "title": "p_name",
        "description": "p_brand",
        "eventId": "p_partkey",
        "tournamentId": "p_size",
        "propertyId": "p_size % 10",
        "sportId": "p_size % 5",
        "deleted": "p_size % 2 = 0",
        "geoRestriction": """named_struct(
            'geoRestrictionType', elt(p_size % 2 + 1, 'WHITELIST', 'BLACKLIST'), 'countries', array('US', p_brand, 'GB'))""",
        "updatedAt": f"{start} + INTERVAL 1 DAY",
        "startDate": start,
        "endDate": f"{start} + make_interval(0, 0, 0, 0, 0, 0, p_size * 61)",
        "thumbnailUrl": "concat('http://thumbs.example/', p_partkey)",
        "thumbnail": "concat('thumb-', p_partkey)",
        "vodDveId": small,
        "draft": "p_size % 4 = 0",
        "duration": "p_size * 60",
        "tags": "array_append(split(p_name, ' '), p_type)",
    }
    data_type = EVENT["payload"].dataType["data"].dataType
    data = {
        "TA": """CASE WHEN p_type = 'ECONOMY' THEN 'NEW_VOD_FROM_DVE' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'UPDATED_VOD'
            WHEN p_type IN ('LARGE', 'PROMO') THEN 'LIVESTREAMING_EVENT_UPDATED' ELSE 'OK' END""",
        "v": _struct(data_type["v"].dataType, video),
        "vid": small,
    }
    top = {"realm": "concat('NATION_', p_size % 30)", "ts": start}
    return _event_rows(table(spark, sf_dir, "part"), data, {"action": "-1"}, top)


def realms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("realm_id"), F.col("n_name").alias("name")
    )


def purchase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with about half of its events delivered twice."""
    log = event_log(spark, sf_dir)
    copies = F.array_repeat(F.lit(0), 1 + F.col("payload.data.DGE_EVENT_ID") % 2)
    return log.withColumn("copy", F.explode(copies)).drop("copy")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.purchases(purchase_log(spark, sf_dir), realms(spark, sf_dir)).payments


def rate_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide sheet with a row per day from seven days before the first event to the last one.

    ISK has gaps, and two columns without a name hold blanks.
    """
    span = table(spark, sf_dir, "events").agg(
        F.date_sub(F.min("ts").cast("date"), 7).alias("first"), F.max("ts").cast("date").alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("d"))
    day = F.dayofmonth("d")

    def rate(index: int) -> Column:
        return (F.lit(1) + (day % 10) / 100.0 + F.lit(index / 10)).cast("decimal(12,4)").cast("string")

    return days.select(
        F.date_format("d", "dd MMM yyyy").alias("Date"),
        rate(1).alias(" GBP"),
        rate(2).alias(" USD"),
        rate(3).alias(" AUD"),
        F.when(day % 3 == 0, "N/A").otherwise(rate(4)).alias(" ISK"),
        F.lit(" ").alias("_c5"),
        F.lit(" ").alias("  "),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange_rates(rate_sheet(spark, sf_dir))


def experiment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment names from ``region``, variant names from ``nation``."""
    experiments = table(spark, sf_dir, "region").select(
        _text("e", F.col("r_regionkey")).alias("id"), F.col("r_name").alias("name")
    )
    variants = table(spark, sf_dir, "nation").select(
        _text("v", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name")
    )
    return experiments.unionByName(variants)


def message_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message record per row of ``events``: event_id, record."""
    mail, view = "event_type = 'error'", "event_type = 'view'"
    at = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    fields = {
        "event_name": """CASE event_type WHEN 'signup' THEN 'REGISTER_SUCCESS' WHEN 'purchase' THEN 'PURCHASE_CONFIRMATION'
            WHEN 'click' THEN 'STREAM_RATING' END""",
        "message_type": f"if({view}, 'VIDEO_HB', NULL)",
        "role": f"if({mail}, 'email-delivery', NULL)",
        "user_id": f"if({mail}, NULL, concat('u', user_id))",
        "product_id": "if(event_type IN ('view', 'click'), concat('p', k % 10), NULL)",
        "update_interval": f"if({view} AND k % 9 > 0, k, NULL)",
        "event_value": """CASE WHEN event_type = 'purchase' AND k = 50 THEN 'unknown'
            WHEN event_type = 'purchase' THEN string(int(round(value))) WHEN event_type = 'click' THEN string(k % 5 + 1) END""",
        "event_cat_sku": "if(event_type = 'purchase', concat('sku', k % 3), NULL)",
        "latitude": "if(k % 2 = 1, k / 2, NULL)",
        "longitude": "if(k % 4 = 1, k / 4, NULL)",
        "experiments": """filter(array(named_struct('experiment_id', concat('e', k % 7), 'variant_id', concat('v', k % 40))),
            x -> k % 3 > 0)""",
        "message_id": f"if({mail} AND k % 4 > 0, concat('m', event_id), NULL)",
        "provider_message_id": f"if({mail}, concat('pm', k), NULL)",
        "recipient": f"if({mail} AND k % 5 > 0, concat('r', user_id), NULL)",
        "cmd": f"if({mail}, elt(k % 2 + 1, 'delivered', 'bounced'), NULL)",
        "status_code": f"if({mail}, string(k + 200), NULL)",
        "data": f"if({mail} AND k % 6 > 0, concat('note ', k), NULL)",
        "smtp_timestamp": f"if({mail} AND k % 2 = 0, {at}, NULL)",
        "timestamp": f"if({mail} AND k % 2 = 1, {at}, NULL)",
        "sent_at": at,
    }
    record = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    return events(spark, sf_dir).selectExpr("event_id", f"to_json(named_struct({record})) AS record")


def sent_at() -> Column:
    """Arrival time of a message, taken from its own text so that results can be repeated."""
    return F.get_json_object("record", "$.sent_at").cast("timestamp")


def packed(records: DataFrame, per_line: int, left: str, sep: str, right: str) -> DataFrame:
    """Text lines ``value`` with up to ``per_line`` records each, by event id."""
    group = F.floor(F.col("event_id") / per_line)
    lines = records.groupBy(group.alias("line")).agg(F.sort_array(F.collect_list("record")).alias("records"))
    return lines.select(_text(left, F.array_join("records", sep), right).alias("value"))


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry up to twenty records each, as JSON arrays."""
    return packed(message_records(spark, sf_dir), 20, "[", ",", "]")


def write_text(lines: DataFrame, label: str) -> str:
    """Write text lines to the shared folder in two parts, so that a stream sees several files."""
    path = work_dir(lines.sparkSession, label)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    lines.select("value", half.alias("half")).write.partitionBy("half").text(path)
    return path


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as a stream of about two micro-batches."""
    files = len(spark.read.text(path).inputFiles())
    reader = spark.readStream.option("maxFilesPerTrigger", str(max(1, math.ceil(files / 2))))
    return reader.option("lineSep", "\n").text(path).select("value")


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as DuckDB has them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])
