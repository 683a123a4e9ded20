"""Start, drain and await streaming queries."""

from __future__ import annotations

import logging

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeline import fixed

log = logging.getLogger(__name__)

#: Triggers for ``DataStreamWriter.trigger``. ``AS_FAST_AS_POSSIBLE`` starts the next batch at once.
EVERY_20_SECONDS = {"processingTime": fixed.TRIGGER_INTERVAL}
EVERY_10_SECONDS = {"processingTime": fixed.TRIGGER_INTERVAL_SHORT}
AS_FAST_AS_POSSIBLE: dict = {}
ALL_THERE_IS = {"availableNow": True}


def with_watermark(df: DataFrame, time_column: str = "EventTime", delay: str = fixed.WATERMARK_DELAY) -> DataFrame:
    """Declare how late rows may be. It takes effect only in a stateful operator downstream: a
    plain append writes rows however late they are."""
    return df.withWatermark(time_column, delay)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that ends by itself; a failure is raised with its cause."""
    try:
        query.awaitTermination()
    except StreamingQueryException:
        log.error("query %s failed: %s", query.name or query.id, root_cause(query))
        raise
    return query


def root_cause(query: StreamingQuery) -> str | None:
    """The text of the failure that ended a query, ``None`` if nothing did."""
    failure = query.exception()
    return None if failure is None else str(failure)
