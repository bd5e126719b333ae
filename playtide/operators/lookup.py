"""Lookup joins and the audit outputs that go with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playtide.operators.skew import BROADCAST_LIMIT_BYTES, fits_broadcast, split_hot_join


@dataclass(frozen=True)
class Outcome:
    """What a pipeline gives: its rows, and the rows it could not use.

    ``missed`` holds events whose realm is unknown, ``invalid`` events without a session id. All
    three are lazy; nothing runs until one is written or read.
    """

    result: DataFrame
    missed: DataFrame | None = None
    invalid: DataFrame | None = None


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    how: str = "left",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join ``df`` to a lookup; ``on`` maps columns of ``df`` to columns of ``dim``.

    All columns of both sides are kept. The lookup is broadcast when its measured size is within
    the limit; beyond it the join shuffles, with hot keys split. ``small`` carries the outcome of
    ``fits_broadcast`` from a caller that joins the same lookup again and again.
    """
    # Keys get names of their own; a lookup column the events already have is theirs to keep.
    names = {d: f"__key_{i}" for i, d in enumerate(on.values())}
    added = [c for c in dim.columns if c not in df.columns]
    left = df.withColumns({names[d]: F.col(c) for c, d in on.items()})
    right = dim.select(*[F.col(d).alias(n) for d, n in names.items()], *added)
    keys = list(names.values())
    if fits_broadcast(right, limit_bytes) if small is None else small:
        joined = left.join(F.broadcast(right), keys, how)
    else:
        joined = split_hot_join(left, right, keys, how)
    return joined.select(*df.columns, *added)


def resolve_realm(events: DataFrame, realms: DataFrame) -> DataFrame:
    """Add ``realm_id`` and ``name`` to each event; both null when the realm is unknown."""
    return lookup_join(events, realms.select("realm_id", "name"), {"realm": "name"})


def split_realm(events: DataFrame, realms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of known realms with ``realm_id`` and ``name``, and the events of all other realms."""
    resolved = resolve_realm(events, realms)
    found = F.col("realm_id").isNotNull()
    return resolved.where(found), resolved.where(~found).select(*events.columns)


def has_session() -> Column:
    """True for a usable session id, false for a null or empty one."""
    cid = F.col("payload.cid")
    return cid.isNotNull() & (cid != "")


def of_type(*names: str) -> Column:
    kind = F.col("payload.data.TA")
    return kind == names[0] if len(names) == 1 else kind.isin(*names)


def of_action(*codes: int) -> Column:
    action = F.col("payload.action")
    return action == codes[0] if len(codes) == 1 else action.isin(*codes)


#: What becomes of an event: a result, an event of an unknown realm, or one without a session id.
KNOWN, MISSED, INVALID = "known", "missed", "invalid"


def tagged(events: DataFrame, realms: DataFrame, sessions: bool = False) -> DataFrame:
    """Events with ``realm_id``, ``name`` and an ``outcome``: known, missed or, where sessions count, invalid."""
    outcome = F.when(F.col("realm_id").isNotNull(), KNOWN).otherwise(MISSED)
    if sessions:
        outcome = F.when(F.coalesce(has_session(), F.lit(False)), outcome).otherwise(INVALID)
    return resolve_realm(events, realms).withColumn("outcome", outcome)


def outcome_counts() -> list[Column]:
    """Totals over tagged events: how many there are in all and of each outcome."""
    outcome = F.col("outcome")
    return [F.count("*").alias("wanted"), *(F.count_if(outcome == kind).alias(kind) for kind in (KNOWN, MISSED, INVALID))]


def audit_rows(tagged_events: DataFrame) -> DataFrame:
    """Events that gave no result, with the reason and the whole event as JSON."""
    event = [c for c in tagged_events.columns if c not in ("realm_id", "name", "outcome")]
    cid = F.col("payload.cid") if "cid" in tagged_events.schema["payload"].dataType.names else F.lit(None).cast("string")
    who = F.col("customerId") if "customerId" in event else F.lit(None).cast("string")
    return tagged_events.where(F.col("outcome") != KNOWN).select(
        F.col("outcome").alias("reason"), "realm", cid.alias("session_id"), who.alias("customer_id"), "ts",
        F.to_json(F.struct(*event)).alias("event"),
    )


def event_metrics(events: DataFrame, realms: DataFrame) -> DataFrame:
    """Total, matched, missed and invalid-session counts in one pass over the events."""
    slim = events.select("realm", F.col("payload.cid").alias("cid"))
    return resolve_realm(slim, realms).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("realm_id").isNotNull()).alias("matched"),
        F.count_if(F.col("realm_id").isNull()).alias("missed"),
        F.count_if(F.coalesce(F.col("cid"), F.lit("")) == "").alias("invalid"),
    )


def tournaments(rows: DataFrame, properties: DataFrame) -> DataFrame:
    """Tournament rows with the sport their property belongs to; unknown properties drop out."""
    sports = properties.select("property_id", "sport_id")
    return lookup_join(rows, sports, {"property_id": "property_id"}, "inner").select(
        "sport_id", "property_id", "tournament_id", "name"
    )


def replace_by_name(
    df: DataFrame, names: DataFrame, key: str, default: str | None = "", small: bool | None = None
) -> DataFrame:
    """Replace an id column by its name from an ``id, name`` lookup, or by ``default``."""
    dim = names.select(F.col("id").alias("__id"), F.col("name").alias("__name"))
    joined = lookup_join(df, dim, {key: "__id"}, small=small)
    return joined.withColumn(key, F.coalesce("__name", F.lit(default))).drop("__id", "__name")
