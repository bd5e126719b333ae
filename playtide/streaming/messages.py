"""From stream messages to the rows of the five stream tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from playtide.functions.fields import last_part_matching
from playtide.functions.times import loose_timestamp
from playtide.operators.lookup import replace_by_name
from playtide.schemas import MESSAGE

# Coordinates outside the valid range mark a missing position.
NO_LATITUDE, NO_LONGITUDE = 181, 361

#: Fixed value: the type of messages that report watch time.
HEARTBEAT = "VIDEO_HB"

_UNREAD = "__unread"

WATCH_KEYS = (
    "user_id", "content_id", "experiment_id", "variant_id", "geo_latitude", "geo_longitude",
)
VIEWING_KEYS = WATCH_KEYS[:4]


def decode_messages(messages: DataFrame, column: str = "value", mark: str | None = None) -> DataFrame:
    """One row per record of each message, whose text is a JSON array of records or one record.

    ``record`` keeps the record's text; ``readable`` is false when it is no JSON object or a field
    has the wrong shape. Records are parsed inside the explode, so filters on their fields do not
    parse them again. With ``mark`` records are parsed only where their text holds these characters, or an escape
    that could stand for them: all records with a value of that name, and perhaps some others.
    """
    text = F.trim(F.col(column).cast("string"))
    if mark is not None:
        messages = messages.where(_holds(text, mark))
    many = F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    records = F.filter(F.when(text.startswith("["), many).otherwise(F.array(text)), lambda r: r != "")
    if mark is not None:
        records = F.filter(records, lambda r: _holds(r, mark))
    schema = T.StructType([*MESSAGE.fields, T.StructField(_UNREAD, T.StringType())])
    options = {"columnNameOfCorruptRecord": _UNREAD}
    parsed = F.transform(
        records, lambda r: F.struct(r.alias("record"), F.from_json(r, schema, options).alias("m"))
    )
    rows = messages.select(F.explode(parsed).alias("r"))
    readable = F.col("r.m").isNotNull() & F.col(f"r.m.{_UNREAD}").isNull()
    return rows.select(*[F.col(f"r.m.{f}").alias(f) for f in MESSAGE.names], "r.record", readable.alias("readable"))


def _holds(text: Column, mark: str) -> Column:
    return text.contains(mark) | text.contains("\\u")


def decode_heartbeats(messages: DataFrame, column: str = "value") -> DataFrame:
    """As ``decode_messages``, for the heartbeats among the records alone."""
    return decode_messages(messages, column, HEARTBEAT)


def decode_avro(messages: DataFrame, avro_schema: str, column: str = "value") -> DataFrame:
    """One row per Avro-encoded message record; needs the ``spark-avro`` package on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    rows = messages.select(from_avro(F.col(column), avro_schema, {"mode": "PERMISSIVE"}).alias("m"))
    return decode_messages(rows.select(F.to_json("m").alias("value")))


def with_experiment(
    messages: DataFrame, names: DataFrame, default: str | None = "", small: bool | None = None
) -> DataFrame:
    """Names of the first experiment and its variant; ``default`` without one or for unknown ids."""
    first = F.get("experiments", F.lit(0))
    ids = messages.withColumns({
        "experiment_id": first.getField("experiment_id"),
        "variant_id": first.getField("variant_id"),
    })
    named = replace_by_name(ids, names, "experiment_id", default, small)
    return replace_by_name(named, names, "variant_id", default, small)


def _position() -> list[Column]:
    return [
        _or_missing("latitude", NO_LATITUDE).alias("geo_latitude"),
        _or_missing("longitude", NO_LONGITUDE).alias("geo_longitude"),
    ]


def _or_missing(name: str, default: int) -> Column:
    """The field as a number, ``default`` when it is absent, null when it holds something else."""
    field = F.col(name)
    return F.when(field.isNull(), F.lit(default).cast("double")).otherwise(field.try_cast("double"))


def _whole(text: str) -> Column:
    return F.col(text).try_cast("double").try_cast("int")


def _watched() -> Column:
    return _or_missing("update_interval", 0).try_cast("int")


def register_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    return messages.select(
        "user_id", arrival.alias("event_datetime"), *_position(), "experiment_id", "variant_id", "record"
    )


def video_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    return messages.select(
        "user_id", F.col("product_id").alias("content_id"), "experiment_id", "variant_id",
        *_position(), _watched().alias("duration"), arrival.alias("event_datetime"), "record",
    )


def purchase_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    return messages.select(
        _whole("event_value").alias("price"), "user_id", F.col("event_cat_sku").alias("package_id"),
        arrival.alias("eventtime"), *_position(), "experiment_id", "variant_id", "record",
    )


def rating_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    return messages.select(
        _whole("event_value").alias("rating"), "user_id", F.col("product_id").alias("content_id"),
        arrival.alias("event_datetime"), *_position(), "experiment_id", "variant_id", "record",
    )


def email_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(name, F.lit(""))

    stamped = last_part_matching(F.from_json("record", "map<string,string>"), "timestamp")
    return messages.select(
        text("message_id").alias("message_id"),
        text("provider_message_id").alias("provider_message_id"),
        text("recipient").alias("recipient_id"),
        F.col("cmd").alias("email_status"),
        text("status_code").alias("status_code"),
        text("data").alias("status_message"),
        loose_timestamp(stamped).alias("event_timestamp"),
        "record",
    )


def viewing_rows(messages: DataFrame, arrival: Column) -> DataFrame:
    """Watch rows of all messages; a registration counts under the content id ``register``."""
    registered = F.col("event_name") == "REGISTER_SUCCESS"
    content = F.when(registered, F.lit("register")).otherwise(F.col("product_id"))
    return messages.where("readable").select(
        "user_id", content.alias("content_id"), "experiment_id", "variant_id",
        _watched().alias("duration"), arrival.alias("event_datetime"), "record",
    )


_GEO = ("geo_latitude", "geo_longitude")


@dataclass(frozen=True)
class Branch:
    """One stream table: which messages go there, their rows, and the columns that must have a value."""

    table: str
    accepts: Callable[[], Column]
    rows: Callable[[DataFrame, Column], DataFrame]
    required: tuple[str, ...]

    def apply(self, messages: DataFrame, arrival: Column) -> DataFrame:
        return self.rows(messages.where(F.col("readable") & self.accepts()), arrival)

    def usable(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.required])


BRANCHES = {
    b.table: b
    for b in (
        Branch("register_user", lambda: F.col("event_name") == "REGISTER_SUCCESS", register_rows, _GEO),
        Branch("video_play", lambda: F.col("message_type") == HEARTBEAT, video_rows, ("duration", *_GEO)),
        Branch("purchases", lambda: F.col("event_name") == "PURCHASE_CONFIRMATION", purchase_rows, ("price", *_GEO)),
        Branch("ratings", lambda: F.col("event_name") == "STREAM_RATING", rating_rows, ("rating", *_GEO)),
        Branch("email_status", lambda: F.col("role") == "email-delivery", email_rows, ("event_timestamp",)),
    )
}


def record_kind() -> Column:
    """Which row builder a record calls for, by its message type and then its event name."""
    watching = F.col("message_type").isin(HEARTBEAT, "VIDEO_STOP")
    name = F.col("event_name")
    return (
        F.when(watching, "video")
        .when(name == "PURCHASE_CONFIRMATION", "purchase")
        .when(name.isin("REGISTER_USER", "REGISTER_SUCCESS"), "register")
        .otherwise("other")
    )
