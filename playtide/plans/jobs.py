"""The pipelines as jobs: read an event log and stored tables, compute, write to tables.

Each job takes a session, the table store and the event log: a path of packed JSON, or a frame of events. For a
path, ``layout`` says how its files are cut, as in ``read_packed_json``.
Several jobs over the same large log are best given a frame that was parsed once and stored as
Parquet, from which each job reads just its columns. With ``dry_run=True`` nothing is written
and the job gives a preview of what it would write, by table.

A job reads its log once. The events it wants go through the realm lookup, get their outcome and are staged by
it; results and audit rows come from there, and the counts are observed on the way. Events that give no result are
written to ``<job>_rejected``, and the counts of each run to ``job_run``. With a ``run_id`` the rows of a job replace
those that a run of the same id wrote before, so a job can be run again after a failure; without one they are added.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import wraps
from inspect import signature

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from playtide import schemas
from playtide.operators import plays as play_ops
from playtide.operators.lookup import (
    INVALID, KNOWN, MISSED, audit_rows, of_action, outcome_counts, tagged, tournaments,
)
from playtide.operators.skew import fits_broadcast
from playtide.plans import accounts, bucketing, catalogue, plays, revenue
from playtide.sources.csv import read_typed_csv, read_wide_csv, read_zipped_csv
from playtide.sources.packed_json import read_json, read_packed_json
from playtide.session import work_scope
from playtide.sources.tables import TableStore, date_of, in_dates, preview, staged

Log = str | DataFrame


def _scoped(job: Callable) -> Callable:
    """A job whose staged rows are removed when it is done; what it gives back does not read them. Previews may."""
    kind = signature(job)

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        if kind.bind(spark, *args, **kwargs).arguments.get("dry_run"):
            return job(spark, *args, **kwargs)
        with work_scope(spark):
            return job(spark, *args, **kwargs)

    return run


@dataclass(frozen=True)
class Counts:
    """Events of a run: all of the log where they were parsed here, those the job wants, and these by outcome."""

    total: int | None
    wanted: int
    known: int
    missed: int
    invalid: int


class Report(dict):
    """What a job gives: previews by table for a dry run, and the counts of a run that wrote."""

    def __init__(self, previews: dict[str, DataFrame] | None = None, counts: Counts | None = None):
        super().__init__(previews or {})
        self.counts = counts


def _emit(
    store: TableStore, tables: dict[str, DataFrame], dry_run: bool, show: int = 20, run_id: str | None = None
) -> Report:
    if dry_run:
        return Report({table: preview(rows, show) for table, rows in tables.items()})
    for table, rows in tables.items():
        store.append(rows, table, run_id)
    return Report()


# Event fields each job reads; the others are skipped while parsing.
_WHO = ("realm", "customerId", "country", "town", "ts")
_TYPE = "payload.data.TA"
_PLAY = (
    *_WHO, "payload.action", "payload.cid", "payload.video", "payload.progress", "payload.data.device",
    "payload.data.startedAt",
)


@dataclass(frozen=True)
class Split:
    """A job's events by outcome, with ``realm_id`` and ``name``, and their counts unless it is a dry run."""

    rows: DataFrame
    counts: Counts | None

    @property
    def known(self) -> DataFrame:
        return self.rows.where(F.col("outcome") == KNOWN)

    @property
    def valid(self) -> DataFrame:
        """Events with a session id, of known and unknown realms."""
        return self.rows.where(F.col("outcome").isin(KNOWN, MISSED))


def _split(
    spark: SparkSession, store: TableStore, log: Log, layout: str, fields: tuple[str, ...], wanted: Column | None, dry_run: bool,
    sessions: bool = False,
) -> Split:
    """The wanted events of a log after its only pass."""
    parsed = not isinstance(log, DataFrame)
    if parsed:
        schema = schemas.pick_fields(schemas.EVENT, *fields) if fields else schemas.EVENT
        events = read_packed_json(spark, log, schema, layout)
    else:
        # The lookup adds these.
        events = log.drop("realm_id", "name", "outcome")
    realms = store.scan("realm")
    chosen = (lambda rows: rows) if wanted is None else (lambda rows: rows.where(wanted))
    if dry_run:
        return Split(tagged(chosen(events), realms, sessions), None)
    all_rows, by_outcome = Observation(), Observation()
    if parsed:  # on a stored frame this would keep the filter from the scan
        events = events.observe(all_rows, F.count("*").alias("total"))
    events = chosen(events)
    if not fits_broadcast(realms.select("realm_id", "name")):
        events = staged(events, "wanted")  # a join that shuffles counts its keys first
    rows = staged(tagged(events, realms, sessions).observe(by_outcome, *outcome_counts()), "events", "outcome")
    found = by_outcome.get or dict.fromkeys(("wanted", KNOWN, MISSED, INVALID), 0)
    return Split(rows, Counts((all_rows.get or {}).get("total", 0) if parsed else None, **found))


def _finish(
    store: TableStore, job: str, split: Split, tables: dict[str, DataFrame], dry_run: bool, run_id: str | None,
    if_any: bool = False,
) -> Report:
    """Write a job's results, the events that gave none, and the counts of the run.

    The run is listed last: a run that is not listed may be incomplete, and can be run again by its id.
    """
    rejected = f"{job}_rejected"
    if dry_run:
        return Report({**{t: preview(r) for t, r in tables.items()}, rejected: preview(audit_rows(split.rows))})
    counts = split.counts
    for table, rows in tables.items():
        if if_any:
            store.append_if_any(rows, table, run_id, counts.known)
        else:
            store.append(rows, table, run_id)
    store.append_if_any(audit_rows(split.rows), rejected, run_id, counts.missed + counts.invalid)
    _list_run(store, job, counts, run_id)
    return Report(counts=counts)


def _list_run(store: TableStore, job: str, counts: Counts, run_id: str | None) -> None:
    run = [(job, run_id or uuid.uuid4().hex, counts.total, counts.wanted, counts.known, counts.missed, counts.invalid)]
    kind = "job string, run string, total bigint, wanted bigint, known bigint, missed bigint, invalid bigint"
    row = store.spark.createDataFrame(run, kind).withColumn("finished_at", F.current_timestamp())
    store.append(row, "job_run", None if run_id is None else f"{job}-{run_id}")


@_scoped
def event_times(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    fields = ("realm", "ts", _TYPE, "payload.data.DGE_EVENT_ID")
    split = _split(spark, store, log, layout, fields, catalogue.is_change(), dry_run)
    tables = {"event_start": catalogue.start_rows(split.known), "event_finish": catalogue.finish_rows(split.known)}
    return _finish(store, "event_times", split, tables, dry_run, run_id)


@_scoped
def date_buckets(
    spark: SparkSession, store: TableStore, log: Log, bucket_path: str, dry_run: bool = False, layout: str = "packed",
    run_id: str | None = None,
) -> Report:
    """Events of known realms to folders by hour; the report has their counts per date as ``per_date``."""
    split = _split(spark, store, log, layout, (), None, dry_run)
    rows = bucketing.dated(split.known.drop("outcome"))
    per_date = bucketing.count_per_date(rows)
    if dry_run:
        return Report({"events": preview(rows), "per_date": per_date})
    bucketing.write_buckets(rows, bucket_path)
    _finish(store, "date_buckets", split, {}, dry_run, run_id)
    counted = spark.createDataFrame(per_date.collect(), per_date.schema)  # a row for each date
    return Report({"per_date": counted}, split.counts)


@_scoped
def live_catalogue(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    split = _split(spark, store, log, layout, ("realm", "ts", _TYPE, "payload.data.v"), catalogue.is_live_update(), dry_run)
    return _finish(store, "live_catalogue", split, {"live_catalogue": catalogue.live_catalogue_rows(split.known)}, dry_run, run_id)


@_scoped
def vod_catalogue(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    fields = ("realm", "ts", _TYPE, "payload.data.v", "payload.data.vid")
    split = _split(spark, store, log, layout, fields, catalogue.is_vod_update(), dry_run)
    return _finish(store, "vod_catalogue", split, {"vod_catalogue": catalogue.vod_catalogue_rows(split.known)}, dry_run, run_id)


@_scoped
def logins(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    fields = (*_WHO, "clientIp", "payload.action", _TYPE, "payload.data.device")
    split = _split(spark, store, log, layout, fields, accounts.is_login(), dry_run)
    return _finish(store, "logins", split, {"user_logins": accounts.login_rows(split.known)}, dry_run, run_id, if_any=True)


@_scoped
def signups(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    split = _split(spark, store, log, layout, (*_WHO, _TYPE, "payload.data.device"), accounts.is_signup(), dry_run)
    return _finish(store, "signups", split, {"signups": accounts.signup_rows(split.known)}, dry_run, run_id, if_any=True)


def _plays(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool, keep: str, layout: str, run_id: str | None,
    kind: str, action: int, rows: Callable, rollup: Callable,
) -> Report:
    if keep not in ("append", "latest", "dates"):
        raise ValueError("keep must be 'append', 'latest' or 'dates'")
    split = _split(spark, store, log, layout, _PLAY, of_action(action), dry_run, sessions=True)
    stored = store.find(kind)
    if dry_run or keep == "append":
        if stored is not None and run_id is not None and "run_id" in stored.columns:
            # What an earlier try of this run wrote is no earlier play.
            stored = stored.where(~F.col("run_id").eqNullSafe(F.lit(run_id)))
        return _finish(store, f"{kind}s", split, {kind: rows(split.known, split.valid, stored)}, dry_run, run_id)
    beats = play_ops.heartbeats(split.known)
    if keep == "latest":
        store.replace(rollup(beats, stored), kind)
    else:
        # A play is stored by the day it started, which is part of its key: only those days' plays can change.
        if stored is not None:
            days = beats.select(date_of(F.col("started_at")).alias("date")).distinct()
            stored = stored.join(F.broadcast(days), "date", "left_semi")
        store.replace_dates(rollup(beats, stored), kind)
    return _finish(store, f"{kind}s", split, {}, dry_run, run_id)


@_scoped
def live_plays(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, keep: str = "append",
    layout: str = "packed", run_id: str | None = None,
) -> Report:
    """New and extended live plays. ``keep`` is as for ``vod_plays``."""
    return _plays(spark, store, log, dry_run, keep, layout, run_id, "live_play", schemas.LIVE_WATCHING, plays.live_rows,
                  play_ops.live_rollup)


@_scoped
def vod_plays(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, keep: str = "append",
    layout: str = "packed", run_id: str | None = None,
) -> Report:
    """New and extended on-demand plays.

    ``keep="append"`` adds them; ``"latest"`` rewrites the table with one row per play; ``"dates"`` does so for the days
    on which the new events' plays started, in a table that is always written this way, and reads and writes no other day.
    """
    return _plays(spark, store, log, dry_run, keep, layout, run_id, "vod_play", schemas.VOD_PROGRESS, plays.vod_rows,
                  play_ops.vod_rollup)


@_scoped
def session_durations(
    spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, layout: str = "packed", run_id: str | None = None
) -> Report:
    watched = of_action(schemas.VOD_PROGRESS, schemas.LIVE_WATCHING)
    split = _split(spark, store, log, layout, _PLAY, watched, dry_run, sessions=True)
    rows = play_ops.session_rollup(play_ops.heartbeats(split.known))
    return _finish(store, "session_durations", split, {"session_duration": rows}, dry_run, run_id)


@_scoped
def purchases(spark: SparkSession, store: TableStore, log: Log, dry_run: bool = False, run_id: str | None = None) -> Report:
    """Payments and subscriptions from date-bucketed events, given by their path or as a frame.

    A frame of raw events, without ``realm_id``, goes through the realm lookup.
    """
    events = log if isinstance(log, DataFrame) else read_json(spark, log, schemas.BUCKETED_EVENT)
    realms = None if "realm_id" in events.columns else store.scan("realm")
    rows = accounts.distinct_purchases(events, realms)
    bought = accounts.split_purchases(rows if dry_run else staged(rows, "purchases"))
    return _emit(store, {"payment": bought.payments, "subscription": bought.subscriptions}, dry_run, run_id=run_id)


def exchange_rates(
    spark: SparkSession,
    store: TableStore,
    path: str,
    zipped: bool = True,
    header: bool = True,
    sep: str = ",",
    day: str | None = None,
    date_format: str = "dd MMM yyyy",
    table: str = "exchange_rate",
    dry_run: bool = False,
    show: int = 20,
) -> Report:
    sheet = (read_zipped_csv if zipped else read_wide_csv)(spark, path, header, sep)
    return _emit(store, {table: revenue.exchange_rates(sheet, date_format, day)}, dry_run, show)


def revenue_rollup(
    spark: SparkSession,
    store: TableStore,
    window: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    week_mode: str = "calendar",
    dry_run: bool = False,
    show: int = 20,
) -> Report:
    payments, rates = in_dates(store.scan("payment"), start, end), store.scan("exchange_rate")
    rows = revenue.revenue_rollup(payments, rates, window, start, end, week_mode=week_mode)
    return _emit(store, {revenue.TABLES[window]: rows}, dry_run, show)


LOOKUP_SCHEMAS = {
    "realm": schemas.REALM,
    "sport": schemas.SPORT,
    "sport_property": schemas.SPORT_PROPERTY,
}


def load_lookup(
    spark: SparkSession,
    store: TableStore,
    table: str,
    path: str,
    header: bool = True,
    sep: str = ",",
    dry_run: bool = False,
) -> Report:
    """Append a realm, sport or sport property CSV to its table."""
    rows = read_typed_csv(spark, path, LOOKUP_SCHEMAS[table], header, sep)
    return _emit(store, {table: rows}, dry_run)


def load_tournaments(
    spark: SparkSession, store: TableStore, path: str, header: bool = True, sep: str = ",", dry_run: bool = False
) -> Report:
    rows = read_typed_csv(spark, path, schemas.TOURNAMENT, header, sep)
    found = tournaments(rows, store.scan("sport_property"))
    return _emit(store, {"sport_property_tournament": found}, dry_run)


def load_vod_backfill(
    spark: SparkSession, store: TableStore, path: str, header: bool = True, sep: str = ",", dry_run: bool = False
) -> Report:
    rows = read_typed_csv(spark, path, schemas.VOD_CATALOGUE_CSV, header, sep)
    return _emit(store, {"vod_catalogue": catalogue.vod_backfill(rows)}, dry_run)
