"""A roll-up of readings per node and date, kept with every write.

Each batch of readings is also written as partial aggregates: for each node and date in it the number of rows,
the number, sum, least and greatest of its values, and its first and last time. Partials of one node and date
merge by adding up, so late rows need no more than a partial of their own, and statistics, lists of nodes and
counts are had without reading any reading.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators.filtering import value_expression
from gaugeline.sinks.tables import BATCH, Table, require_same_run


def partials(rows: DataFrame, by: Sequence[str], date: str, time: str, value: str) -> DataFrame:
    """``(*by, date, n, n_values, sum_value, min_value, max_value, first_time, last_time)``, a row for each
    node and date among ``rows``, nulls included. Hot nodes are reduced before the shuffle."""
    number = value_expression(rows, value)
    return rows.groupBy(*by, date).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(number).alias("n_values"),
        F.sum(number).alias("sum_value"),
        F.min(number).alias("min_value"),
        F.max(number).alias("max_value"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partials of each group of ``by`` as one row with the same columns; without ``by`` one row for all."""
    return parts.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_values"), F.lit(0)).alias("n_values"), F.sum("sum_value").alias("sum_value"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def stats(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average, largest and smallest value of each group, as ``readings.value_stats`` has them from the readings."""
    average = F.when(F.col("n_values") > 0, F.col("sum_value") / F.col("n_values"))
    return merged(parts, by).select(*by, average.alias("avg_value"), "max_value", "min_value")


@dataclass(frozen=True)
class RolledUp:
    """A table of readings and its roll-up as one destination.

    ``by`` are the columns that tell nodes apart, ``date``, ``time`` and ``value`` those of a reading.
    Both tables may lag each other while a batch is being written: the readings come first, so the
    roll-up never counts a row that is not there yet. Rows must not be deleted from the readings alone.
    """

    readings: Table
    rollup: Table
    by: Sequence[str] = ("displayName",)
    date: str = "eventDate"
    time: str = "eventTime"
    value: str = "valueDouble"

    def _partials(self, rows: DataFrame) -> DataFrame:
        return partials(rows, self.by, self.date, self.time, self.value)

    def write_batch(self, df: DataFrame, mode: str = "append") -> None:
        """Append rows and their partials; with ``mode="overwrite"`` both tables start anew. ``df`` is read twice: a
        table or file that stays as it is, or rows that the caller has stored."""
        self.readings.write_batch(df, mode)
        self.rollup.write_batch(self._partials(df), mode)

    def write_stream(self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None, name: str | None = None) -> StreamingQuery:
        """Append each batch to both tables. Rows and partials carry the number of their batch, and a batch that is
        run again overwrites its own in both (:meth:`gaugeline.sinks.tables.Table.write_stream_balanced`)."""
        for table in (self.readings, self.rollup):
            require_same_run(df.sparkSession, table.path, checkpoint)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = batch.persist()
            try:
                self.readings.write_numbered(rows, batch_id, checkpoint)
                self.rollup.write_numbered(self._partials(rows), batch_id, checkpoint)
            finally:
                rows.unpersist()

        writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def condense(self, parts: DataFrame) -> DataFrame:
        """The roll-up with one row a node and date, to be written as a table in its place from time to time."""
        return merged(parts.drop(BATCH), [*self.by, self.date])
