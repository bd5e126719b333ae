"""Every registered query: one per operator or pipeline, each over whole tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide import schemas
from playtide.functions import fields, times
from playtide.operators import lookup, plays as play_ops, rates as rate_ops, revenue as revenue_ops, skew
from playtide.plans import accounts, bucketing, catalogue, jobs, plays, revenue
from playtide.session import work_dir
from playtide.sources import csv, packed_json, streams, tables
from playtide.streaming import fanout, messages, text
from registry import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inputs.plain_times(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def _log_and_realms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return inputs.event_log(spark, sf_dir), inputs.realms(spark, sf_dir)


def _flat(events: DataFrame) -> DataFrame:
    data = "payload.data."
    return events.select(
        F.col("clientIp").alias("client_ip"), "country", F.col("customerId").alias("customer_id"),
        F.col("payload.action").alias("action"), F.col("payload.cid").alias("cid"),
        F.col(data + "TA").alias("event_type"), F.col(data + "ta").alias("source_type"),
        F.col(data + "device").alias("device"), F.col(data + "startedAt").alias("started_millis"),
        F.col("payload.progress").alias("progress"), F.col("payload.video").alias("video"),
        "realm", "town", "ts",
    )


# --- sources -------------------------------------------------------------------------------

def _packed_file(spark: SparkSession, sf_dir: str) -> str:
    """The event log as JSON objects back-to-back, up to fifty on a line."""
    log = inputs.event_log(spark, sf_dir, "event_id")
    record = F.to_json(F.struct(*schemas.EVENT.names), inputs.JSON_TS)
    numbered = log.select("event_id", record.alias("record"))
    return inputs.write_text(inputs.packed(numbered, 50, "", "", ""), "packed-json")


@query
def packed_json_scan(spark, sf_dir):
    return _flat(packed_json.read_packed_json(spark, _packed_file(spark, sf_dir)))


@query
def packed_json_lines_scan(spark, sf_dir):
    return _flat(packed_json.read_packed_json(spark, _packed_file(spark, sf_dir), layout="lines"))


@query
def packed_json_measured(spark, sf_dir):
    """A log of both kinds of files: the events of even ids back-to-back, the others on lines, as each file is found to be."""
    log = inputs.event_log(spark, sf_dir, "event_id")
    numbered = log.select("event_id", F.to_json(F.struct(*schemas.EVENT.names), inputs.JSON_TS).alias("record"))
    path = work_dir(spark, "mixed-json")
    even = F.col("event_id") % 2 == 0
    inputs.packed(numbered.where(even), 50, "", "", "").write.text(f"{path}/kind=packed")
    numbered.where(~even).select(F.col("record").alias("value")).write.text(f"{path}/kind=lines")
    return _flat(packed_json.read_packed_json(spark, path, layout="measured"))


@query
def packed_json_corrupt(spark, sf_dir):
    """Text that is no event log: each line of the documents is a record, and none parses."""
    path = inputs.write_text(inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value")), "corrupt")
    read = packed_json.read_packed_json(spark, path, layout="lines", corrupt="_corrupt")
    return read.select("customerId", F.col("_corrupt").alias("record")).groupBy("customerId").agg(
        F.count("record").alias("records"), F.sum(F.length("record")).alias("characters")
    ).select(F.col("customerId").alias("customer_id"), "records", "characters")


def _csv_file(rows: DataFrame, label: str, header: bool = True, sep: str = ",") -> str:
    path = work_dir(rows.sparkSession, label)
    rows.write.options(header=header, sep=sep, escape='"').csv(path)
    return path


@query
def typed_csv_load(spark, sf_dir):
    path = _csv_file(inputs.realms(spark, sf_dir), "realm-csv", header=False, sep=";")
    return csv.read_typed_csv(spark, path, schemas.REALM, header=False, sep=";")


@query
def vod_catalogue_backfill(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("vod_id"),
        (F.col("p_partkey") + 1000).alias("vod_dve_id"),
        (F.col("p_size") % 30).alias("realm_operator_id"),
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("title"),
        F.col("p_type").alias("description"),
        (F.col("p_size") * 60).alias("duration"),
        F.concat(F.lit("http://thumbs.example/"), "p_partkey").alias("thumbnail_url"),
        (F.col("p_size") % 2).alias("deleted"),
        (F.col("p_size") % 3).alias("draft"),
        F.lit("2018-01-01 00:00:00").alias("imported_at"),
        F.lit("2018-01-02 00:00:00").alias("updated_at"),
    )
    path = _csv_file(rows, "vod-csv")
    return catalogue.vod_backfill(csv.read_typed_csv(spark, path, schemas.VOD_CATALOGUE_CSV))


@query
def wide_csv_rates(spark, sf_dir):
    """The rate sheet as plain CSV files."""
    sheet = inputs.rate_sheet(spark, sf_dir)
    path = work_dir(spark, "wide-csv")
    sheet.write.options(header=True).csv(path)
    return _rates_as_text(revenue.exchange_rates(csv.read_wide_csv(spark, path)))


@query
def sport_property_load(spark, sf_dir):
    """Regions stand in for sports and nations for their properties, loaded by jobs; then tournaments from customers."""
    store = _warehouse(spark, sf_dir)
    regions, nations = inputs.table(spark, sf_dir, "region"), inputs.table(spark, sf_dir, "nation")
    jobs.load_lookup(spark, store, "sport", _csv_file(regions.select(F.col("r_regionkey").alias("sport_id"), F.col("r_name").alias("name")), "sport"))
    properties = nations.select(F.col("n_regionkey").alias("sport_id"), F.col("n_nationkey").alias("property_id"), F.col("n_name").alias("name"))
    jobs.load_lookup(spark, store, "sport_property", _csv_file(properties, "property"))
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("property_id"), F.col("c_custkey").alias("tournament_id"), F.col("c_name").alias("name"))
    jobs.load_tournaments(spark, store, _csv_file(rows, "tournaments"))
    found = store.scan("sport_property_tournament").withColumnRenamed("name", "tournament")
    return found.join(store.scan("sport").withColumnRenamed("name", "sport"), "sport_id").select("sport", "property_id", "tournament_id", "tournament")


def _zip_archives(sheet: DataFrame) -> DataFrame:
    """The sheet's rows as one zipped CSV per month: at most 31 lines each."""
    header = ",".join(c if c.strip() and not c.startswith("_") else "" for c in sheet.columns)
    lines = sheet.select(
        F.substring("Date", 4, 8).alias("month"), F.concat_ws(",", *[f"`{c}`" for c in sheet.columns]).alias("line")
    )

    def zipped(month: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("rates.csv", "\n".join([header, *month["line"]]) + "\n")
        return pd.DataFrame({"path": [month["month"].iloc[0]], "content": [buffer.getvalue()]})

    return lines.groupBy("month").applyInPandas(zipped, "path string, content binary")


def _rates_as_text(rates: DataFrame) -> DataFrame:
    return rates.select(F.col("date").cast("string").alias("date"), "currency", F.col("rate").cast("string").alias("rate"))


@query
def zipped_csv_rates(spark, sf_dir):
    archives = _zip_archives(inputs.rate_sheet(spark, sf_dir))
    sheet = csv.lines_to_wide(csv.archive_lines(archives))
    return _rates_as_text(revenue.exchange_rates(sheet))


@query
def key_value_lookup(spark, sf_dir):
    """Orders of a customer as ``customer,order`` lines in order-key order: the last order wins."""
    orders = inputs.table(spark, sf_dir, "orders")
    lines = orders.select(
        F.concat_ws(",", "o_custkey", "o_orderkey", "o_orderstatus").alias("value"), F.col("o_orderkey").alias("at")
    )
    return csv.key_value_lines(lines, F.col("at"))


@query
def rates_unpivot(spark, sf_dir):
    return _rates_as_text(rate_ops.unpivot_rates(inputs.rate_sheet(spark, sf_dir)))


@query
def rates_of_last_day(spark, sf_dir):
    last = bucketing.high_water_mark(inputs.table(spark, sf_dir, "events"), "ts").first()["day"]
    return _rates_as_text(revenue.exchange_rates(inputs.rate_sheet(spark, sf_dir), day=last))


# --- filters and lookups -------------------------------------------------------------------

@query
def type_filter(spark, sf_dir):
    return _flat(inputs.event_log(spark, sf_dir).where(lookup.of_type("REGISTER_USER", "FAILED_LOGIN")))


@query
def action_filter(spark, sf_dir):
    return _flat(inputs.event_log(spark, sf_dir).where(lookup.of_action(schemas.USER_SIGN_IN)))


@query
def valid_sessions(spark, sf_dir):
    return _flat(inputs.event_log(spark, sf_dir).where(lookup.has_session()))


@query
def invalid_sessions(spark, sf_dir):
    return _flat(plays.session_durations(*_log_and_realms(spark, sf_dir)).invalid)


@query
def realm_resolve(spark, sf_dir):
    resolved = lookup.resolve_realm(*_log_and_realms(spark, sf_dir))
    return resolved.select(F.col("customerId").alias("customer_id"), "ts", "realm", "realm_id", "name")


@query
def realm_resolve_split(spark, sf_dir):
    """The same join as when the lookup is too large to broadcast."""
    log, realms = _log_and_realms(spark, sf_dir)
    resolved = lookup.lookup_join(log, realms, {"realm": "name"}, limit_bytes=0)
    return resolved.select(F.col("customerId").alias("customer_id"), "ts", "realm", "realm_id", "name")


@query
def missed_realms(spark, sf_dir):
    return _flat(lookup.split_realm(*_log_and_realms(spark, sf_dir))[1])


@query
def event_metrics(spark, sf_dir):
    return lookup.event_metrics(*_log_and_realms(spark, sf_dir))


@query
def drop_nested_field(spark, sf_dir):
    records = inputs.message_records(spark, sf_dir).withColumn("m", F.from_json("record", schemas.MESSAGE))
    slim = fields.drop_nested(fields.drop_nested(records, "m.experiments.variant_id"), "m.latitude")
    return slim.select(
        "event_id",
        F.to_json("m.experiments").alias("experiments"),
        F.array_join(F.array(*[F.lit(n) for n in slim.schema["m"].dataType.names]), ",").alias("fields"),
    )


@query
def tournament_lookup(spark, sf_dir):
    """Customers stand in for tournaments, nations for properties, regions for sports."""
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("property_id"), F.col("c_custkey").alias("tournament_id"), F.col("c_name").alias("name")
    )
    properties = inputs.table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("sport_id"), F.col("n_nationkey").alias("property_id"), F.col("n_name").alias("name")
    )
    return lookup.tournaments(rows, properties)


@query
def experiment_lookup_default(spark, sf_dir):
    records = inputs.message_records(spark, sf_dir).select(F.col("record").alias("value"))
    named = messages.with_experiment(messages.decode_messages(records), inputs.experiment_names(spark, sf_dir))
    return named.groupBy("event_name", "message_type", "role", "experiment_id", "variant_id").agg(F.count("*").alias("n"))


@query
def record_dispatch(spark, sf_dir):
    records = inputs.message_records(spark, sf_dir).select(F.col("record").alias("value"))
    return messages.decode_messages(records).groupBy(messages.record_kind().alias("kind")).agg(F.count("*").alias("n"))


# --- buckets and marks ---------------------------------------------------------------------

@query
def date_bucket_roundtrip(spark, sf_dir):
    path = work_dir(spark, "buckets")
    bucketing.write_buckets(bucketing.bucket_events(*_log_and_realms(spark, sf_dir)).events, path)
    back = packed_json.read_json(spark, path, schemas.BUCKETED_EVENT)
    return back.groupBy("year", "month", "day", "hour", "date", "realm_id", "name").agg(
        F.count("*").alias("events"),
        F.sum("payload.progress").alias("progress"),
        F.count("payload.data.TA").alias("typed"),
        F.min("ts").alias("first_at"),
        F.max("ts").alias("last_at"),
    )


@query
def events_per_date(spark, sf_dir):
    return bucketing.bucket_events(*_log_and_realms(spark, sf_dir)).per_date


@query
def high_water_mark(spark, sf_dir):
    return bucketing.high_water_mark(catalogue.event_times(*_log_and_realms(spark, sf_dir)).starts)


# --- pipelines -----------------------------------------------------------------------------

@query
def event_start(spark, sf_dir):
    return catalogue.event_times(*_log_and_realms(spark, sf_dir)).starts


@query
def event_finish(spark, sf_dir):
    return catalogue.event_times(*_log_and_realms(spark, sf_dir)).finishes


@query
def logins(spark, sf_dir):
    return accounts.logins(*_log_and_realms(spark, sf_dir)).result


@query
def signups(spark, sf_dir):
    return accounts.signups(*_log_and_realms(spark, sf_dir)).result


@query
def live_catalogue(spark, sf_dir):
    return catalogue.live_catalogue(inputs.catalogue_log(spark, sf_dir), inputs.realms(spark, sf_dir)).result


@query
def vod_catalogue(spark, sf_dir):
    return catalogue.vod_catalogue(inputs.catalogue_log(spark, sf_dir), inputs.realms(spark, sf_dir)).result


@query
def vod_plays(spark, sf_dir):
    return plays.vod_plays(*_log_and_realms(spark, sf_dir)).result


@query
def live_plays(spark, sf_dir):
    return plays.live_plays(*_log_and_realms(spark, sf_dir)).result


def _halves(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events up to noon, as loaded by an earlier run, and the events after it."""
    return log.where(F.hour("ts") < 12), log.where(F.hour("ts") >= 12)


@query
def vod_plays_merged(spark, sf_dir):
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    return plays.vod_plays(later, realms, plays.vod_plays(earlier, realms).result).result


@query
def live_plays_merged(spark, sf_dir):
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    return plays.live_plays(later, realms, plays.live_plays(earlier, realms).result).result


@query
def live_plays_recomputed(spark, sf_dir):
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    return plays.live_plays(later, realms, plays.live_plays(earlier, realms).result, recompute=True).result


@query
def vod_plays_latest(spark, sf_dir):
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    return plays.all_vod_plays(later, realms, plays.vod_plays(earlier, realms).result)


@query
def semi_join_sessions(spark, sf_dir):
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    watched = later.where(lookup.of_action(schemas.VOD_PROGRESS) & lookup.has_session())
    sessions = watched.select(F.col("payload.cid").alias("session_id"))
    return play_ops.touched_plays(plays.vod_plays(earlier, realms).result, sessions)


@query
def semi_join_split(spark, sf_dir):
    """The same when the sessions are too many to broadcast: keys with over 50 plays go to several tasks."""
    log, realms = _log_and_realms(spark, sf_dir)
    earlier, later = _halves(log)
    watched = later.where(lookup.of_action(schemas.VOD_PROGRESS) & lookup.has_session())
    sessions = watched.select(F.col("payload.cid").alias("session_id"))
    return skew.semi_join(plays.vod_plays(earlier, realms).result, sessions, "session_id", 0, 50)


@query
def aggregate_join_split(spark, sf_dir):
    """Events beside their user's totals; the totals tell which users are too large for one task."""
    rows = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    totals = rows.groupBy("user_id").agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"))
    totals = tables.staged(totals, "user-totals")
    hot = skew.hot_counted(totals, ["user_id"], "events", 50)
    return skew.split_hot_join(rows, totals, ["user_id"], "inner", hot=hot)


@query
def session_durations(spark, sf_dir):
    return plays.session_durations(*_log_and_realms(spark, sf_dir)).result


@query
def payments(spark, sf_dir):
    return inputs.payments(spark, sf_dir)


@query
def subscriptions(spark, sf_dir):
    return accounts.purchases(inputs.purchase_log(spark, sf_dir), inputs.realms(spark, sf_dir)).subscriptions


@query
def payments_from_buckets(spark, sf_dir):
    """Payments from date-bucketed events, which carry their realm id."""
    path = work_dir(spark, "payment-buckets")
    bucketing.write_buckets(
        bucketing.bucket_events(inputs.purchase_log(spark, sf_dir), inputs.realms(spark, sf_dir)).events, path
    )
    return accounts.purchases(packed_json.read_json(spark, path, schemas.BUCKETED_EVENT)).payments


@query
def stable_row_id(spark, sf_dir):
    return fields.add_row_id(inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "row_id")


# --- revenue -------------------------------------------------------------------------------

@query
def time_range_payments(spark, sf_dir):
    rows = revenue_ops.in_time_range(inputs.payments(spark, sf_dir), "2024-01-05 06:00:00", "2024-01-20 18:00:00")
    return revenue_ops.nonzero_amounts(rows).select("realm_id", "payment_provider", "currency", "amount_with_tax", "ts")


@query
def weekday_asof_rates(spark, sf_dir):
    joined = rate_ops.join_weekday_rates(inputs.payments(spark, sf_dir), inputs.rates(spark, sf_dir))
    return joined.select(
        "payment_id", "currency", "ts", F.col("rate_date").cast("string").alias("rate_date"),
        F.round(F.col("rate") * 10000).cast("int").alias("rate_e4"),
        F.round(F.col("target_rate") * 10000).cast("int").alias("target_rate_e4"),
    )


@query
def convert_currency(spark, sf_dir):
    converted = rate_ops.convert_currency(inputs.payments(spark, sf_dir), inputs.rates(spark, sf_dir))
    return converted.select("payment_id", "currency", "ts", "amount_with_tax", "amount_with_tax_usd")


@query
def convert_currency_gbp(spark, sf_dir):
    converted = rate_ops.convert_currency(
        inputs.payments(spark, sf_dir), inputs.rates(spark, sf_dir), currency="GBP", on_missing="null"
    )
    return converted.select("payment_id", "currency", "ts", "amount_with_tax", "amount_with_tax_gbp")


def _revenue(window: str, week_mode: str = "calendar") -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return revenue.revenue_rollup(
            inputs.payments(spark, sf_dir), inputs.rates(spark, sf_dir), window, week_mode=week_mode
        )

    return build


for _window, _table in revenue.TABLES.items():
    _build = _revenue(_window)
    _build.__name__ = _table
    query(_build)
_build = _revenue("week", "epoch")
_build.__name__ = "revenue_weekly_epoch"
query(_build)


@query
def revenue_cube(spark, sf_dir):
    return revenue_ops.revenue_cube(inputs.payments(spark, sf_dir), "day")


# --- jobs ----------------------------------------------------------------------------------

def _warehouse(spark: SparkSession, sf_dir: str) -> tables.FolderStore:
    store = tables.FolderStore(spark, work_dir(spark, "warehouse"))
    store.append(inputs.realms(spark, sf_dir), "realm")
    return store


@query
def vod_plays_rejected(spark, sf_dir):
    """The audit rows of a job: events without a session id, and events of unknown realms."""
    store = _warehouse(spark, sf_dir)
    jobs.vod_plays(spark, store, inputs.event_log(spark, sf_dir))
    return store.scan("vod_plays_rejected").select(
        "reason", "realm", "session_id", "customer_id", "ts",
        F.get_json_object("event", "$.payload.progress").cast("bigint").alias("progress"),
    )


@query
def job_run_counts(spark, sf_dir):
    store = _warehouse(spark, sf_dir)
    for job in (jobs.logins, jobs.vod_plays, jobs.event_times):
        job(spark, store, inputs.event_log(spark, sf_dir), run_id="a-day")
    return store.scan("job_run").select("job", "wanted", "known", "missed", "invalid")


@query
def vod_plays_rerun(spark, sf_dir):
    """A job that runs twice with one run id."""
    store = _warehouse(spark, sf_dir)
    for _ in range(2):
        jobs.vod_plays(spark, store, inputs.event_log(spark, sf_dir), run_id="a-day")
    return store.scan("vod_play").select(*play_ops.VOD_PLAY_COLUMNS)


@query
def vod_plays_by_date(spark, sf_dir):
    """Two runs merged into a table stored by date, of which the second one rewrites its own days only."""
    store = _warehouse(spark, sf_dir)
    for events in _halves(inputs.event_log(spark, sf_dir)):
        jobs.vod_plays(spark, store, events, keep="dates")
    return store.scan("vod_play").select(*play_ops.VOD_PLAY_COLUMNS)


@query
def plays_append_after_latest(spark, sf_dir):
    """A table that one run rewrites and the next one adds to."""
    store = _warehouse(spark, sf_dir)
    earlier, later = _halves(inputs.event_log(spark, sf_dir))
    jobs.vod_plays(spark, store, earlier, keep="latest")
    jobs.vod_plays(spark, store, later)
    return store.scan("vod_play").select(*play_ops.VOD_PLAY_COLUMNS)


@query
def revenue_of_range(spark, sf_dir):
    """Revenue of two weeks, from payments stored by date: the other dates' folders are not read."""
    store = _warehouse(spark, sf_dir)
    jobs.purchases(spark, store, inputs.purchase_log(spark, sf_dir))
    store.append(inputs.rates(spark, sf_dir), "exchange_rate")
    jobs.revenue_rollup(spark, store, "day", "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return store.scan("revenue_daily")


# --- scalar functions ----------------------------------------------------------------------

@query
def array_mkstring(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")
    return part.select("p_partkey", fields.sorted_join(F.concat(F.split("p_name", " "), F.array("p_type", F.lit(None)))).alias("words"))


@query
def action_name(spark, sf_dir):
    log = inputs.event_log(spark, sf_dir)
    return log.groupBy(fields.action_name(F.col("payload.action")).alias("action")).agg(F.count("*").alias("n"))


@query
def millis_to_ts(spark, sf_dir):
    rows = inputs.events(spark, sf_dir)
    millis = F.when(F.col("k") % 20 == 2, "n/a").otherwise(F.unix_millis("ts").cast("string"))
    return rows.select("event_id", times.millis_to_timestamp(millis).alias("at"))


@query
def str_to_map(spark, sf_dir):
    line = F.expr("concat('id=', event_id, '&type=', event_type, '&k=', k, '&id=', user_id)")
    pairs = inputs.events(spark, sf_dir).select("event_id", fields.key_values(line).alias("m"))
    return pairs.select(
        "event_id", *[F.col("m")[key].alias(key) for key in ("id", "type", "k")], F.size("m").alias("pairs")
    )


# --- text ----------------------------------------------------------------------------------

def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select(F.explode(F.split("text", "\n")).alias("value"))


@query
def word_count(spark, sf_dir):
    return text.word_count(_document_lines(spark, sf_dir))


def _pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir)
    return rows.select(F.concat(F.lit("type="), "event_type", F.lit("&k="), "k").alias("value"))


@query
def pair_count(spark, sf_dir):
    return text.word_count(_pair_lines(spark, sf_dir), "&")


def _routed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir)
    kind = F.col("event_type")
    first = F.when(kind == "view", "ONE").when(kind == "click", "TWO").otherwise(kind)
    rest = F.when(F.col("k") > 0, F.concat(F.lit(" "), "event_id", F.lit(" "), "k")).otherwise("")
    return rows.select(F.concat(first, rest).alias("value"))


@query
def first_word_route(spark, sf_dir):
    return text.first_word_routes(_routed_lines(spark, sf_dir))


# --- streams -------------------------------------------------------------------------------

NOW = {"availableNow": True}


def _fan_out(spark: SparkSession, sf_dir: str, *names: str) -> tables.FolderStore:
    source = inputs.write_text(inputs.message_lines(spark, sf_dir), "messages")
    store = tables.FolderStore(spark, work_dir(spark, "stream-tables"))
    queries = fanout.start_fan_out(
        inputs.text_stream(spark, source), inputs.experiment_names(spark, sf_dir), store,
        work_dir(spark, "stream-checkpoint"), names or tuple(messages.BRANCHES), NOW, inputs.sent_at(),
    )
    fanout.run_to_end(queries)
    return store


@query
def stream_register(spark, sf_dir):
    return _fan_out(spark, sf_dir, "register_user").scan("register_user").drop("batch_id")


@query
def stream_purchases(spark, sf_dir):
    return _fan_out(spark, sf_dir, "purchases").scan("purchases").drop("batch_id")


@query
def stream_ratings(spark, sf_dir):
    return _fan_out(spark, sf_dir, "ratings").scan("ratings").drop("batch_id")


@query
def stream_email_status(spark, sf_dir):
    return _fan_out(spark, sf_dir, "email_status").scan("email_status").drop("batch_id")


@query
def stream_video_play(spark, sf_dir):
    return fanout.latest_totals(_fan_out(spark, sf_dir, "video_play").scan("video_play"))


@query
def stream_fan_out(spark, sf_dir):
    """All five tables and the dead letters of one run, counted per table."""
    store = _fan_out(spark, sf_dir)
    counts = [
        store.scan(name).agg(F.lit(name).alias("target"), F.count("*").alias("n"))
        for name in messages.BRANCHES if name != "video_play"
    ]
    counts.append(
        fanout.latest_totals(store.scan("video_play")).agg(F.lit("video_play").alias("target"), F.count("*").alias("n"))
    )
    dead = store.find(fanout.DEAD_LETTERS)
    if dead is not None:
        counts.append(dead.groupBy(F.concat(F.lit("dead "), "branch").alias("target")).agg(F.count("*").alias("n")))
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query
def stream_word_count(spark, sf_dir):
    path = inputs.write_text(_document_lines(spark, sf_dir), "words")
    store = tables.FolderStore(spark, work_dir(spark, "word-tables"))
    fanout.run_to_end([
        text.start_word_count(inputs.text_stream(spark, path), store, "words", work_dir(spark, "word-checkpoint"), trigger=NOW)
    ])
    return store.scan("words")


@query
def stream_routes(spark, sf_dir):
    path = inputs.write_text(_routed_lines(spark, sf_dir), "routes")
    store = tables.FolderStore(spark, work_dir(spark, "route-tables"))
    fanout.run_to_end([
        text.start_routes(inputs.text_stream(spark, path), store, work_dir(spark, "route-checkpoint"), NOW)
    ])
    routed = [store.scan(t).select(F.lit(t).alias("route"), "payload") for t in (*text.ROUTES.values(), text.OTHER_ROUTE)]
    return routed[0].unionByName(routed[1]).unionByName(routed[2])


@query
def stream_batch_counts(spark, sf_dir):
    path = inputs.write_text(inputs.message_lines(spark, sf_dir), "counted")
    store = tables.FolderStore(spark, work_dir(spark, "count-tables"))
    stream = messages.decode_messages(inputs.text_stream(spark, path))
    fanout.run_to_end([
        fanout.start_batch_counts(stream, store, "counts", work_dir(spark, "count-checkpoint"), NOW)
    ])
    return store.scan("counts").agg(F.sum("n").alias("records"))


@query
def stream_batch_counts_each(spark, sf_dir):
    """Records of two micro-batches: every other message arrives before the first run of the stream, the rest after it."""
    records, path = inputs.message_records(spark, sf_dir), work_dir(spark, "arrivals")
    store, state = tables.FolderStore(spark, work_dir(spark, "each-tables")), work_dir(spark, "each-checkpoint")
    for part in range(2):
        arrived = records.where(F.floor(F.col("event_id") / 20) % 2 == part)
        inputs.packed(arrived, 20, "[", ",", "]").select("value").write.mode("append").text(path)
        stream = messages.decode_messages(streams.read_text_stream(spark, path))
        fanout.run_to_end([fanout.start_batch_counts(stream, store, "counts", state, NOW)])
    return store.scan("counts").select("batch_id", "n")


def _viewings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.message_records(spark, sf_dir)
    named = messages.with_experiment(
        messages.decode_messages(records.select(F.col("record").alias("value"))), inputs.experiment_names(spark, sf_dir)
    )
    return messages.viewing_rows(named, inputs.sent_at()).drop("record")


def _by_hours(rows: DataFrame, hours: int) -> list[DataFrame]:
    """The rows of each so many hours of the day."""
    part = F.floor(F.hour("event_datetime") / hours)
    return [rows.where(part == i) for i in range(24 // hours)]


@query
def cumulative_watch_time(spark, sf_dir):
    """Two batches appended to a log of totals; the second reads the totals of the first."""
    store = tables.FolderStore(spark, work_dir(spark, "totals"))
    for batch_id, rows in enumerate(_by_hours(_viewings(spark, sf_dir), 12)):
        fanout.append_totals(rows, store, "viewing", batch_id, messages.VIEWING_KEYS)
    return store.scan("viewing")


@query
def cumulative_watch_time_folded(spark, sf_dir):
    """Six batches appended to a log whose totals are folded into a snapshot after every second one."""
    store = tables.FolderStore(spark, work_dir(spark, "folded"))
    for batch_id, rows in enumerate(_by_hours(tables.staged(_viewings(spark, sf_dir), "viewings"), 4)):
        fanout.append_totals(rows, store, "viewing", batch_id, messages.VIEWING_KEYS, fold_every=2)
    return store.scan("viewing")


@query
def cumulative_overwrite(spark, sf_dir):
    """Two batches summed into a table that is rewritten, and the second one once more."""
    store = tables.FolderStore(spark, work_dir(spark, "rewrite"))
    first, second = _by_hours(_viewings(spark, sf_dir), 12)
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        fanout.rewrite_totals(rows, store, "viewing", batch_id)
    return store.scan("viewing")


@query
def stream_rewrite(spark, sf_dir):
    """Watch time summed into a table that each micro-batch rewrites."""
    source = inputs.write_text(inputs.message_lines(spark, sf_dir), "rewrite-messages")
    store = tables.FolderStore(spark, work_dir(spark, "rewrite-tables"))
    fanout.run_to_end([fanout.start_rewrite(
        inputs.text_stream(spark, source), inputs.experiment_names(spark, sf_dir), store, "video_play",
        work_dir(spark, "rewrite-checkpoint"), NOW, inputs.sent_at(),
    )])
    return store.scan("video_play")
