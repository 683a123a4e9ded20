"""Expectations on rows of a stream that act: failing rows go to a table of their own, and too many stop the query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.sinks.tables import Table, require_same_run

#: The column of a failing row that lists the expectations it fails.
FAILED = "failed_expectations"


class ExpectationFailed(Exception):
    """A batch in which too large a share of the rows fails an expectation."""


@dataclass(frozen=True)
class Expectation:
    """``condition`` is to hold for each row; a row for which it is NULL fails. A batch is refused if more than
    ``max_share`` of its rows fail; with 1 none is."""

    name: str
    condition: Column
    max_share: float = 1.0


def flagged(rows: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The rows with :data:`FAILED`, the names of what each fails; empty for a row that meets all."""
    names = [F.when(~F.coalesce(e.condition, F.lit(False)), F.lit(e.name)) for e in expectations]
    return rows.withColumn(FAILED, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def counts(flagged_rows: DataFrame, expectations: Sequence[Expectation]) -> dict[str, int]:
    """Rows that fail each expectation, and all rows under the name ``rows``, in one pass."""
    failing = [F.count_if(F.array_contains(FAILED, e.name)).alias(f"e{i}") for i, e in enumerate(expectations)]
    found = flagged_rows.agg(F.count(F.lit(1)).alias("rows"), *failing).first()
    return {"rows": found["rows"], **{e.name: found[f"e{i}"] for i, e in enumerate(expectations)}}


@dataclass(frozen=True)
class Checked:
    """A destination that checks each batch before it lets it in.

    Rows that meet all expectations go to ``table``, the others to ``failing`` with the names of what they
    fail. If an expectation fails in too large a share of a batch, its failing rows are written for
    inspection, nothing goes to ``table``, and the query ends with :class:`ExpectationFailed`, which names the
    expectation and the counts. The batch is not committed then: the query started again, with the cause mended
    or other bounds, takes it in whole, overwriting what the first attempt wrote, so no row is lost or doubled.
    """

    table: Table
    failing: Table
    expectations: Sequence[Expectation]

    def write_stream(self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None, name: str | None = None) -> StreamingQuery:
        for table in (self.table, self.failing):
            require_same_run(df.sparkSession, table.path, checkpoint)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = flagged(batch, self.expectations).persist()
            try:
                found = counts(rows, self.expectations)
                self.failing.write_numbered(rows.where(F.size(FAILED) > 0), batch_id, checkpoint)
                broken = [e for e in self.expectations if found[e.name] > e.max_share * found["rows"]]
                if broken:
                    causes = "; ".join(f"{e.name}: {found[e.name]} of {found['rows']} rows fail, {e.max_share:g} may" for e in broken)
                    raise ExpectationFailed(f"batch {batch_id} refused: {causes}")
                self.table.write_numbered(rows.where(F.size(FAILED) == 0).drop(FAILED), batch_id, checkpoint)
            finally:
                rows.unpersist()

        writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        return (writer.trigger(**trigger) if trigger else writer).start()
