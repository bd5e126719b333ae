"""Fixed schemas and codes of the event log, the lookups and the stream messages."""

from __future__ import annotations

from pyspark.sql import types as T

# Action codes of the event log.
SESSION_CHECK = 1
VOD_PROGRESS = 2
LIVE_WATCHING = 3
VOD_ACCESS_CHECK = 4
LIVE_ACCESS_CHECK = 5
USER_SIGN_IN = 6
USER_SIGN_UP = 7
HEALTH_CHECK = 8
OTHER = -1

ACTION_NAMES = {
    SESSION_CHECK: "SESSION_CHECK",
    VOD_PROGRESS: "VOD_PROGRESS",
    LIVE_WATCHING: "LIVE_WATCHING",
    VOD_ACCESS_CHECK: "VOD_ACCESS_CHECK",
    LIVE_ACCESS_CHECK: "LIVE_ACCESS_CHECK",
    USER_SIGN_IN: "USER_SIGN_IN",
    USER_SIGN_UP: "USER_SIGN_UP",
    HEALTH_CHECK: "HEALTH_CHECK",
    OTHER: "OTHER",
}

STRING, BOOLEAN, TIMESTAMP = T.StringType(), T.BooleanType(), T.TimestampType()
BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
FLOAT = T.FloatType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


VIDEO = _struct(
    title=STRING,
    description=STRING,
    eventId=LONG,
    tournamentId=LONG,
    propertyId=LONG,
    sportId=LONG,
    deleted=BOOLEAN,
    geoRestriction=_struct(geoRestrictionType=STRING, countries=T.ArrayType(STRING)),
    updatedAt=TIMESTAMP,
    startDate=TIMESTAMP,
    endDate=TIMESTAMP,
    thumbnailUrl=STRING,
    thumbnail=STRING,
    vodDveId=INT,
    live=BOOLEAN,
    draft=BOOLEAN,
    duration=LONG,
    tags=T.ArrayType(STRING),
)

DATA = _struct(
    ta=STRING,
    TA=STRING,
    cid=STRING,
    device=STRING,
    startedAt=STRING,
    v=VIDEO,
    vid=INT,
    DGE_EVENT_ID=INT,
    PAYMENT_PROVIDER=STRING,
    PRICE_WITH_TAX_AMOUNT=FLOAT,
    PRICE_WITH_TAX_CURRENCY=STRING,
    IS_TRIAL=BOOLEAN,
    TRIAL_DAYS=INT,
    REVOKED=BOOLEAN,
    CANCELLED=BOOLEAN,
    SKU=STRING,
)

EVENT = _struct(
    clientIp=STRING,
    country=STRING,
    customerId=STRING,
    payload=_struct(action=BYTE, cid=STRING, data=DATA, progress=LONG, video=LONG),
    realm=STRING,
    town=STRING,
    ts=TIMESTAMP,
)

# Events as written by the date bucketing job; the last four are partition folders.
BUCKETED_EVENT = T.StructType([
    *EVENT.fields,
    *_struct(
        realm_id=INT, name=STRING, date=STRING, year=STRING, month=STRING, day=STRING, hour=STRING
    ).fields,
])

REALM = _struct(realm_id=INT, name=STRING)
SPORT = _struct(sport_id=INT, name=STRING)
SPORT_PROPERTY = _struct(sport_id=INT, property_id=INT, name=STRING)
TOURNAMENT = _struct(property_id=INT, tournament_id=INT, name=STRING)
VOD_CATALOGUE_CSV = _struct(
    vod_id=LONG,
    vod_dve_id=LONG,
    realm_operator_id=SHORT,
    title=STRING,
    description=STRING,
    duration=LONG,
    thumbnail_url=STRING,
    deleted=INT,
    draft=INT,
    imported_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)

# Superset of the fields the stream branches read from one message record. Values stay text, as a
# field may hold a number or a number's text; only what a branch needs is cast.
MESSAGE = _struct(
    event_name=STRING,
    message_type=STRING,
    role=STRING,
    user_id=STRING,
    product_id=STRING,
    update_interval=STRING,
    event_value=STRING,
    event_cat_sku=STRING,
    latitude=STRING,
    longitude=STRING,
    experiments=T.ArrayType(_struct(experiment_id=STRING, variant_id=STRING)),
    message_id=STRING,
    provider_message_id=STRING,
    recipient=STRING,
    cmd=STRING,
    status_code=STRING,
    data=STRING,
)


def pick_fields(schema: T.StructType, *paths: str) -> T.StructType:
    """The schema cut down to the fields at the given dotted paths, so that no others are parsed."""
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    unknown = set(wanted) - set(schema.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return T.StructType([
        field if "" in wanted[field.name]
        else T.StructField(field.name, pick_fields(field.dataType, *wanted[field.name]))
        for field in schema.fields if field.name in wanted
    ])


# Output columns of the play tables, in table order.
LIVE_PLAY_KEYS = (
    "realm_id", "session_id", "customer_id", "video_id", "device", "started_at", "country", "town",
)
VOD_PLAY_KEYS = tuple(k for k in LIVE_PLAY_KEYS if k != "device")
SESSION_KEYS = tuple(k for k in VOD_PLAY_KEYS if k != "video_id")

#: Fact tables that are stored by date, and the time that gives it.
FACT_TIMES = {
    "payment": "ts",
    "subscription": "ts",
    "vod_play": "started_at",
    "live_play": "started_at",
    "session_duration": "start_at",
}
