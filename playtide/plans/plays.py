"""Live plays, on-demand plays and session durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playtide.operators import plays as ops
from playtide.operators.lookup import Outcome, has_session, of_action, split_realm
from playtide.schemas import LIVE_WATCHING, VOD_PROGRESS


def _touched(valid: DataFrame, stored: DataFrame | None) -> DataFrame | None:
    """Stored plays of the batch's sessions, whether or not the event's realm is known."""
    if stored is None:
        return None
    return ops.touched_plays(stored, valid.select(F.col("payload.cid").alias("session_id")))


def _invalid(watched: DataFrame) -> DataFrame:
    return watched.where(~F.coalesce(has_session(), F.lit(False)))


def vod_plays(events: DataFrame, realms: DataFrame, stored: DataFrame | None = None) -> Outcome:
    watched = events.where(of_action(VOD_PROGRESS))
    valid = watched.where(has_session())
    known, missed = split_realm(valid, realms)
    return Outcome(vod_rows(known, valid, stored), missed, _invalid(watched))


def vod_rows(known: DataFrame, valid: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Plays of resolved events, with the stored plays of all valid sessions merged in."""
    return ops.vod_rollup(ops.heartbeats(known), _touched(valid, stored))


def live_plays(
    events: DataFrame, realms: DataFrame, stored: DataFrame | None = None, recompute: bool = False
) -> Outcome:
    watched = events.where(of_action(LIVE_WATCHING))
    valid = watched.where(has_session())
    known, missed = split_realm(valid, realms)
    return Outcome(live_rows(known, valid, stored, recompute), missed, _invalid(watched))


def live_rows(
    known: DataFrame, valid: DataFrame, stored: DataFrame | None = None, recompute: bool = False
) -> DataFrame:
    """Plays of resolved events, with the stored plays of all valid sessions merged in."""
    return ops.live_rollup(ops.heartbeats(known), _touched(valid, stored), recompute)


def session_durations(events: DataFrame, realms: DataFrame) -> Outcome:
    watched = events.where(of_action(VOD_PROGRESS, LIVE_WATCHING))
    valid = watched.where(has_session())
    known, missed = split_realm(valid, realms)
    return Outcome(ops.session_rollup(ops.heartbeats(known)), missed, _invalid(watched))


def all_vod_plays(events: DataFrame, realms: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Every stored play with the new events merged in: one row per play, for a table rewrite."""
    valid = events.where(of_action(VOD_PROGRESS) & has_session())
    return ops.vod_rollup(ops.heartbeats(split_realm(valid, realms)[0]), stored)


def all_live_plays(events: DataFrame, realms: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Every stored play with the new events merged in: one row per play, for a table rewrite."""
    valid = events.where(of_action(LIVE_WATCHING) & has_session())
    return ops.live_rollup(ops.heartbeats(split_realm(valid, realms)[0]), stored)
