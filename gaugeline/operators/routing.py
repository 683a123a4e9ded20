"""Message classes and the side tables made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions.status import is_bad_or_null, is_bad_status, is_bad_status_text

READING = "reading"
BAD_VALUE = "bad_value"
SUBSCRIPTION_STATUS = "subscription_status"
EVENT = "event"
EVENT_SUBSCRIPTION_STATUS = "event_subscription_status"
UNPARSABLE = "unparsable"
UNKNOWN = "unknown"

#: Classes that no table but that of the dead letters takes.
DEAD = (UNPARSABLE, UNKNOWN)


def message_class() -> Column:
    """Class of a row of :func:`gaugeline.operators.parsing.parse_messages`."""
    kind = F.col("type")
    has_id = F.col("node_id").isNotNull()
    return (
        F.when(F.col("unparsable"), UNPARSABLE)
        .when(kind == fixed.TYPE_BAD_VALUE, BAD_VALUE)
        .when(kind == fixed.TYPE_SUBSCRIPTION_STATUS, SUBSCRIPTION_STATUS)
        .when(kind == fixed.TYPE_EVENT, EVENT)
        .when(kind == fixed.TYPE_EVENT_SUBSCRIPTION_STATUS, EVENT_SUBSCRIPTION_STATUS)
        .when(has_id & is_bad_or_null("status_code", "value"), BAD_VALUE)
        .when(has_id, READING)
        .otherwise(UNKNOWN)
    )


def classify(messages: DataFrame, target: str = "message_class") -> DataFrame:
    return messages.withColumn(target, message_class())


def of_class(classified: DataFrame, *classes: str) -> DataFrame:
    return classified.where(F.col("message_class").isin(*classes))


def readings(classified: DataFrame, include_bad: bool = False) -> DataFrame:
    """Readings; with ``include_bad`` also bad values, which have an id and mostly no value."""
    return of_class(classified, READING, BAD_VALUE) if include_bad else of_class(classified, READING)


def bad_values(classified: DataFrame, keep=()) -> DataFrame:
    """Side table of bad values."""
    return of_class(classified, BAD_VALUE).select(
        *keep,
        "timestamp",
        "node_id",
        "equipment_name",
        "production_line",
        "status_code",
        "source_timestamp",
        "server_timestamp",
        is_bad_status("status_code").alias("bad_status"),
    )


def connection_health(classified: DataFrame, keep=()) -> DataFrame:
    """Side table of both kinds of subscription status, with a bad flag."""
    return of_class(classified, SUBSCRIPTION_STATUS, EVENT_SUBSCRIPTION_STATUS).select(
        *keep,
        "timestamp",
        "type",
        "status",
        "equipment_name",
        "production_line",
        is_bad_status_text("status").alias("is_bad"),
    )


def dead_letters(classified: DataFrame, payload: str, keep=()) -> DataFrame:
    """Side table of messages that no other table takes, with the payload as it came."""
    return of_class(classified, *DEAD).select(*keep, "message_class", F.col(payload).alias("payload"))


def events(classified: DataFrame, keep=()) -> DataFrame:
    """Side table of server events."""
    return of_class(classified, EVENT).select(*keep, "timestamp", "event", "equipment_name", "production_line")
