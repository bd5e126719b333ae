"""Logins, sign-ups, and payments with their subscriptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playtide.functions.fields import add_row_id
from playtide.operators.lookup import Outcome, of_action, of_type, resolve_realm, split_realm
from playtide.schemas import USER_SIGN_IN


def logins(events: DataFrame, realms: DataFrame) -> Outcome:
    """Sign-in attempts; anything but a successful login, also a missing type, is a failure."""
    known, missed = split_realm(events.where(is_login()), realms)
    return Outcome(login_rows(known), missed)


def is_login() -> Column:
    return of_action(USER_SIGN_IN)


def login_rows(known: DataFrame) -> DataFrame:
    """The rows of sign-in attempts whose realm is resolved."""
    succeeded = F.coalesce(of_type("SUCCESSFUL_LOGIN"), F.lit(False))
    return known.select(
        "realm_id",
        "town",
        "country",
        F.col("clientIp").alias("client_ip"),
        F.col("payload.data.device").alias("device"),
        "ts",
        succeeded.alias("is_success"),
        F.col("customerId").alias("customer_id"),
    )


def signups(events: DataFrame, realms: DataFrame) -> Outcome:
    known, missed = split_realm(events.where(is_signup()), realms)
    return Outcome(signup_rows(known), missed)


def is_signup() -> Column:
    return of_type("REGISTER_USER")


def signup_rows(known: DataFrame) -> DataFrame:
    """The rows of registrations whose realm is resolved."""
    return known.select(
        "realm_id",
        "town",
        "country",
        "ts",
        F.col("payload.data.device").alias("device"),
        F.col("customerId").alias("customer_id"),
    )


@dataclass(frozen=True)
class Purchases:
    payments: DataFrame
    subscriptions: DataFrame


def distinct_purchases(
    events: DataFrame, realms: DataFrame | None = None, id_mode: str = "digest"
) -> DataFrame:
    """One row per different purchase, with a payment id.

    Date-bucketed events carry ``realm_id`` already; others need the realm lookup.
    """
    bought = events.where(of_type("SUCCESSFUL_PURCHASE"))
    if "realm_id" not in events.columns:
        if realms is None:
            raise ValueError("events without realm_id need the realm lookup")
        bought = resolve_realm(bought, realms)
    data = "payload.data."
    rows = bought.select(
        F.col("customerId").alias("customer_id"),
        "realm_id",
        "town",
        "country",
        "ts",
        F.col(data + "PAYMENT_PROVIDER").alias("payment_provider"),
        F.col(data + "PRICE_WITH_TAX_AMOUNT").alias("amount_with_tax"),
        F.col(data + "PRICE_WITH_TAX_CURRENCY").alias("currency"),
        F.col(data + "IS_TRIAL").alias("is_trial"),
        F.col(data + "TRIAL_DAYS").alias("trial_days"),
        F.col(data + "SKU").alias("sku"),
        F.col(data + "REVOKED").alias("revoked"),
        F.col(data + "CANCELLED").alias("cancelled"),
    )
    return add_row_id(rows.distinct(), "payment_id", id_mode)


def purchases(
    events: DataFrame, realms: DataFrame | None = None, id_mode: str = "digest"
) -> Purchases:
    """Payments and subscriptions of the same purchases, tied by the payment id.

    The id is a digest of the row, so both tables agree even when they are computed in separate
    jobs or some of their tasks run again.
    """
    return split_purchases(distinct_purchases(events, realms, id_mode))


def split_purchases(rows: DataFrame) -> Purchases:
    payments = rows.select(
        "customer_id", "realm_id", "town", "country", "ts", "payment_provider",
        F.col("amount_with_tax").cast("int").alias("amount_with_tax"),
        "currency", "sku", "payment_id",
    )
    subscriptions = rows.select(
        "customer_id", "realm_id", "town", "country", "ts", "payment_id", "is_trial",
        "trial_days", "sku", "revoked", "cancelled",
    )
    return Purchases(payments, subscriptions)
