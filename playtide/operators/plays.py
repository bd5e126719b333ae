"""Play and session aggregation, and the merge with rows of earlier runs.

Every aggregate here is a min or a max, so it combines on the map side and a session that holds a
large share of the events reaches its reducer as few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playtide.functions.times import millis_to_timestamp, seconds_between
from playtide.operators.skew import semi_join
from playtide.schemas import LIVE_PLAY_KEYS, SESSION_KEYS, VOD_PLAY_KEYS, VOD_PROGRESS

LIVE_PLAY_COLUMNS = (
    "realm_id", "session_id", "customer_id", "video_id", "device", "duration", "started_at",
    "start_at", "end_at", "country", "town",
)
VOD_PLAY_COLUMNS = tuple(c for c in LIVE_PLAY_COLUMNS if c != "device")
SESSION_COLUMNS = tuple(c for c in VOD_PLAY_COLUMNS if c != "video_id")


def heartbeats(resolved: DataFrame) -> DataFrame:
    """One flat row per play event, starting and ending at the event's time."""
    return resolved.select(
        "realm_id",
        F.col("payload.cid").alias("session_id"),
        F.col("customerId").alias("customer_id"),
        F.col("payload.video").alias("video_id"),
        F.col("payload.data.device").alias("device"),
        F.col("payload.action").alias("action"),
        F.col("payload.progress").alias("progress"),
        millis_to_timestamp(F.col("payload.data.startedAt")).alias("started_at"),
        F.col("ts").alias("start_at"),
        F.col("ts").alias("end_at"),
        "country",
        "town",
    )


def _rollup(rows: DataFrame, keys: tuple[str, ...], duration: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        duration.alias("duration"),
        F.min("start_at").alias("start_at"),
        F.max("end_at").alias("end_at"),
    )


def touched_plays(plays: DataFrame, sessions: DataFrame) -> DataFrame:
    """Stored plays of the sessions that occur in the new events."""
    return semi_join(plays, sessions, "session_id")


def vod_rollup(beats: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Plays from progress events, merged with stored plays: longest progress, first and last time."""
    rows = beats.withColumn("duration", F.col("progress")).select(*VOD_PLAY_COLUMNS)
    if stored is not None:
        rows = rows.unionByName(stored.select(*VOD_PLAY_COLUMNS))
    return _rollup(rows, VOD_PLAY_KEYS, F.max("duration")).select(*VOD_PLAY_COLUMNS)


def live_rollup(
    beats: DataFrame, stored: DataFrame | None = None, recompute: bool = False
) -> DataFrame:
    """Plays from watch events, merged with stored plays in the same single aggregation.

    The duration is the longest of the partial plays: the new events' own span and each stored
    duration. ``recompute=True`` takes the span of the merged play instead.
    """
    rows = beats.withColumn("duration", F.lit(None).cast("bigint")).withColumn("fresh", F.lit(True))
    columns = [*LIVE_PLAY_COLUMNS, "fresh"]
    rows = rows.select(*columns)
    if stored is not None:
        rows = rows.unionByName(stored.withColumn("fresh", F.lit(False)).select(*columns))
    fresh_start = F.min(F.when(F.col("fresh"), F.col("start_at")))
    fresh_end = F.max(F.when(F.col("fresh"), F.col("end_at")))
    longest = F.greatest(F.max("duration"), seconds_between(fresh_start, fresh_end))
    plays = _rollup(rows, LIVE_PLAY_KEYS, longest)
    if recompute:
        plays = plays.withColumn("duration", seconds_between(F.col("start_at"), F.col("end_at")))
    return plays.select(*LIVE_PLAY_COLUMNS)


def session_rollup(beats: DataFrame) -> DataFrame:
    """Session durations of both kinds of play, from one pass over the events.

    On-demand sessions last as long as their furthest progress, live ones from their first to
    their last event. A session with both kinds gives one row for each.
    """
    rolled = beats.groupBy(*SESSION_KEYS, "action").agg(
        F.max("progress").alias("progress"),
        F.min("start_at").alias("start_at"),
        F.max("end_at").alias("end_at"),
    )
    duration = F.when(F.col("action") == VOD_PROGRESS, F.col("progress")).otherwise(
        seconds_between(F.col("start_at"), F.col("end_at"))
    )
    return rolled.withColumn("duration", duration).select(*SESSION_COLUMNS)


def merge_watch_time(
    batch: DataFrame, stored: DataFrame, keys: tuple[str, ...], latest: str = "event_datetime"
) -> DataFrame:
    """New cumulative totals of the keys that occur in ``batch``.

    ``stored`` is a log of totals per key, so its largest value is the latest total. Keys without
    new rows are left as they are and give no row.
    """
    nothing = F.lit(None).cast("bigint")
    fresh = batch.select(
        *keys, F.col("duration").alias("added"), nothing.alias("held"), latest, F.lit(True).alias("fresh")
    )
    kept = stored.select(
        *keys, nothing.alias("added"), F.col("duration").alias("held"), latest, F.lit(False).alias("fresh")
    )
    total = F.coalesce(F.sum("added"), F.lit(0)) + F.coalesce(F.max("held"), F.lit(0))
    merged = fresh.unionByName(kept).groupBy(*keys).agg(
        total.alias("duration"), F.max(latest).alias(latest), F.max("fresh").alias("fresh")
    )
    return merged.where("fresh").drop("fresh")


def add_durations(batch: DataFrame, stored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sum of stored and new durations per key, for all keys of both."""
    columns = [*keys, "duration"]
    rows = batch.select(*columns).unionByName(stored.select(*columns))
    return rows.groupBy(*keys).agg(F.sum("duration").alias("duration"))
