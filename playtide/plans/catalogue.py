"""Event start and finish, live and on-demand catalogue feeds, and the lookup loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playtide.functions.fields import sorted_join
from playtide.functions.times import seconds_between
from playtide.operators.lookup import Outcome, of_type, split_realm

WENT_LIVE, WENT_OFF = "EVENT_WENT_LIVE", "EVENT_WENT_NOTLIVE"
NEW_VOD, UPDATED_VOD = "NEW_VOD_FROM_DVE", "UPDATED_VOD"
LIVE_UPDATED = "LIVESTREAMING_EVENT_UPDATED"


@dataclass(frozen=True)
class EventTimes:
    starts: DataFrame
    finishes: DataFrame
    missed: DataFrame


def event_times(events: DataFrame, realms: DataFrame) -> EventTimes:
    """When live events went on and off air."""
    known, missed = split_realm(events.where(is_change()), realms)
    return EventTimes(start_rows(known), finish_rows(known), missed)


def is_change() -> Column:
    return of_type(WENT_LIVE, WENT_OFF)


def _times(known: DataFrame, kind: str, name: str) -> DataFrame:
    event_id = F.col("payload.data.DGE_EVENT_ID").alias("event_id")
    return known.where(of_type(kind)).select(event_id, "realm_id", F.col("ts").alias(name))


def start_rows(known: DataFrame) -> DataFrame:
    return _times(known, WENT_LIVE, "start_at")


def finish_rows(known: DataFrame) -> DataFrame:
    return _times(known, WENT_OFF, "finish_at")


def live_catalogue(events: DataFrame, realms: DataFrame) -> Outcome:
    known, missed = split_realm(events.where(is_live_update()), realms)
    return Outcome(live_catalogue_rows(known), missed)


def is_live_update() -> Column:
    return of_type(LIVE_UPDATED)


def live_catalogue_rows(known: DataFrame) -> DataFrame:
    """The rows of live events whose realm is resolved."""
    video = "payload.data.v."
    start, end = F.col(video + "startDate"), F.col(video + "endDate")
    return known.select(
        "realm_id",
        F.col(video + "title").alias("title"),
        F.col(video + "eventId").alias("event_id"),
        F.col(video + "sportId").alias("sport_id"),
        F.col(video + "tournamentId").alias("tournament_id"),
        F.col(video + "propertyId").alias("property_id"),
        seconds_between(start, end).alias("duration"),
        F.col(video + "thumbnail").alias("thumbnail_url"),
        F.col(video + "deleted").alias("deleted"),
        F.col(video + "geoRestriction.geoRestrictionType").alias("geo_restriction_type"),
        sorted_join(F.col(video + "geoRestriction.countries")).alias("geo_restriction_countries"),
        start.alias("start_at"),
        end.alias("finish_at"),
        F.col(video + "updatedAt").alias("updated_at"),
    )


def vod_catalogue(events: DataFrame, realms: DataFrame) -> Outcome:
    """On-demand videos; the import time is known only for newly added ones."""
    known, missed = split_realm(events.where(is_vod_update()), realms)
    return Outcome(vod_catalogue_rows(known), missed)


def is_vod_update() -> Column:
    return of_type(UPDATED_VOD, NEW_VOD)


def vod_catalogue_rows(known: DataFrame) -> DataFrame:
    """The rows of videos whose realm is resolved."""
    video = "payload.data.v."
    return known.select(
        F.col("payload.data.vid").alias("video_id"),
        F.col(video + "vodDveId").alias("video_dve_id"),
        "realm_id",
        F.col(video + "title").alias("title"),
        F.col(video + "description").alias("description"),
        F.col(video + "duration").alias("duration"),
        F.col(video + "thumbnailUrl").alias("thumbnail_url"),
        F.col(video + "deleted").alias("deleted"),
        F.col(video + "draft").alias("draft"),
        sorted_join(F.col(video + "tags")).alias("tags"),
        F.when(of_type(NEW_VOD), F.col("ts")).alias("imported_at"),
        F.col("ts").alias("updated_at"),
    )


def vod_backfill(rows: DataFrame) -> DataFrame:
    """Catalogue rows from the CSV export; tags are unknown and both times are set to the epoch."""
    epoch = F.to_timestamp(F.lit("01-01-1970 00:00:00"), "MM-dd-yyyy HH:mm:ss")
    return rows.select(
        F.col("vod_id").alias("video_id"),
        F.col("vod_dve_id").alias("video_dve_id"),
        F.col("realm_operator_id").alias("realm_id"),
        "title",
        "description",
        "duration",
        "thumbnail_url",
        F.col("deleted").cast("boolean").alias("deleted"),
        F.col("draft").cast("boolean").alias("draft"),
        F.lit(None).cast("string").alias("tags"),
        epoch.alias("imported_at"),
        epoch.alias("updated_at"),
    )
