"""Directory users, their attributes and their event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import epoch_ms_parts
from concordat.operators.common import first_row, lookup_join

# Event types that count as activity, and exported attributes.
ACTIVE_TYPES = ("LOGIN", "UPDATE_PROFILE")
SYSTEM_REALM = "master"
ATTRIBUTES = {
    "realm_id": "societe-codeGestionnaire",
    "idkpep": "kpepId",
    "birthdate": "birthDate",
    "email_other": "email_other",
    "channel": "ActivationData-DeepLink-Chanel",
    "middlename": "middleName",
    "phonenumber": "phoneNumber",
    "origincreation": "originCreation",
}


def to_epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without zone, read as UTC."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.floor(micros / 1000).cast("bigint")


def day_between(ms: Column, first: str, last: str) -> Column:
    """Calendar day of an epoch-millisecond value within two days, inclusive.

    Bounds are turned into milliseconds, so the filter stays on the raw column
    and reaches the scan.
    """
    def start(day: str, shift: int = 0) -> Column:
        days = F.datediff(F.lit(day).cast("date"), F.lit("1970-01-01").cast("date")) + shift
        return days.cast("bigint") * F.lit(86_400_000).cast("bigint")

    return (ms >= start(first)) & (ms < start(last, 1))


def date_range_on_epoch(rows: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows whose epoch-millisecond column falls on a day of the range."""
    return rows.where(day_between(F.col(column), first, last))


def latest_events(events: DataFrame, first: str, last: str) -> DataFrame:
    """Latest counted event per user."""
    kept = date_range_on_epoch(events.where(F.col("type").isin(*ACTIVE_TYPES)), "event_time", first, last)
    return first_row(kept, ["user_id"], [F.col("event_time").desc(), F.col("event_id").desc()])


def activity_choice(users: DataFrame, events: DataFrame, first: str, last: str) -> DataFrame:
    """Latest event when not older than the creation of the account, else the creation.

    An account kept for its creation must have been created within the range.
    """
    latest = latest_events(events, first, last).select(F.col("user_id").alias("id"), "type", "client_id", "event_time")
    rows = lookup_join(users.where(F.col("realm_id") != SYSTEM_REALM), latest, ["id"])
    active = F.coalesce(F.col("event_time") >= F.col("created_timestamp"), F.lit(False))
    stamp = F.when(active, F.col("event_time")).otherwise(F.col("created_timestamp"))
    day, clock = epoch_ms_parts(stamp)
    out = rows.where(active | day_between(F.col("created_timestamp"), first, last))
    return out.select(
        "id",
        "email",
        "first_name",
        "last_name",
        stamp.alias("stamp"),
        F.when(active, F.col("type")).otherwise("CREATION").alias("type"),
        F.when(active, F.col("client_id")).alias("client"),
        day.cast("string").alias("date_evt"),
        clock.alias("heure_evt"),
    )


def attribute_pivot(attributes: DataFrame) -> DataFrame:
    """Entity-attribute-value rows to one row per user with the exported attributes."""
    kept = attributes.where(F.col("name").isin(*ATTRIBUTES.values()))
    return kept.groupBy("user_id").agg(
        *[F.max(F.when(F.col("name") == name, F.col("value"))).alias(col) for col, name in ATTRIBUTES.items()]
    )


def attribute_pivot_join(users: DataFrame, attributes: DataFrame) -> DataFrame:
    """Users with their attributes; absent attributes are ''."""
    wide = attribute_pivot(attributes).withColumnRenamed("user_id", "id")
    rows = lookup_join(users, wide.withColumnsRenamed({"realm_id": "attr_realm_id"}), ["id"])
    names = ["attr_realm_id" if c == "realm_id" else c for c in ATTRIBUTES]
    return rows.select(*users.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in names])


def distinct_on(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in a total order (``DISTINCT ON``)."""
    return first_row(rows, keys, order)
