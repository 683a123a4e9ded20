"""Operators that remember: removal of messages sent twice, and statistics in windows of event time.

Both keep state by key in the state store, spread over the shuffle partitions, and forget it as the
watermark passes. Rows older than the watermark are left out there and counted in the progress of the
query (:func:`late_rows`). In a batch there is no watermark: nothing is late, and all windows close.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions.times import parse_iso
from gaugeline.operators.filtering import value_expression
from gaugeline.streaming.ingest import with_watermark

#: The time by which a message is remembered.
SENT_TIME = "sent_time"


def with_sent_time(messages: DataFrame, arrival: str, default_offset: str = "+00:00") -> DataFrame:
    """When a message was made: its source time, else its producer's time, else its ``arrival``, a
    timestamp that every message has."""
    read = [parse_iso(name, default_offset) for name in ("source_timestamp", "timestamp")]
    return messages.withColumn(SENT_TIME, F.coalesce(*read, arrival))


def drop_resent(
    messages: DataFrame, position: Sequence[str], delay: str = fixed.WATERMARK_DELAY, time: str = SENT_TIME, number: Sequence[str] = (),
) -> DataFrame:
    """The first of the messages of each node and source time.

    A producer that delivers at least once sends a message again, with the same node and source time, when
    its answer is lost. Such a message is dropped if it is at most ``delay`` behind the newest one seen;
    any that is later than that is dropped as late. Without source time the producer's own time tells
    messages apart. A message that lacks a node id or both times, such as one that does not parse, is itself
    only at its place ``position`` on the bus. Messages of a node spread over the state by their time.

    Where different messages of a node may have one time, as when several machines report under one node id,
    ``number`` names the columns that tell them apart and that a message keeps when it is sent again, such as its
    number at the producer.
    """
    stamp = F.coalesce(F.concat(F.lit("s"), "source_timestamp"), F.concat(F.lit("p"), "timestamp"))
    place = F.when(F.col("node_id").isNull() | stamp.isNull(), F.to_json(F.struct(*position)))
    keyed = messages.withColumns({"_stamp": stamp, "_place": place})
    kept = with_watermark(keyed, time, delay).dropDuplicatesWithinWatermark(["node_id", "_stamp", "_place", *number])
    return kept.drop("_stamp", "_place")


def window_stats(
    rows: DataFrame,
    width: str,
    by: Sequence[str] = fixed.HIERARCHY,
    delay: str | None = fixed.WATERMARK_DELAY,
    time: str = "EventTime",
    value: str = "ValueDouble",
) -> DataFrame:
    """``(*by, window_start, window_end, n, n_values, avg_value, max_value, min_value)`` of each place in each
    tumbling window of event time in which it has rows.

    In append mode a window leaves once, when the watermark, ``delay`` behind the newest row, has passed its
    end. ``None`` as delay keeps the watermark that ``time`` has from :func:`drop_resent` before. Rows are reduced
    before the shuffle, so a hot place is a few rows a task.
    """
    number = value_expression(rows, value)
    marked = rows if delay is None else with_watermark(rows, time, delay)
    stats = marked.groupBy(*by, F.window(time, width).alias("_window")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(number).alias("n_values"),
        F.avg(number).alias("avg_value"),
        F.max(number).alias("max_value"),
        F.min(number).alias("min_value"),
    )
    return stats.select(
        *by, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
        "n", "n_values", "avg_value", "max_value", "min_value")


def late_rows(progress: Iterable) -> int:
    """Rows that stateful operators left out as late, from reports of progress: those of a query
    (``recentProgress``, the last hundred) or of a :class:`gaugeline.streaming.monitor.ProgressLog`."""
    return sum(int(operator["numRowsDroppedByWatermark"]) for report in progress for operator in report["stateOperators"])
