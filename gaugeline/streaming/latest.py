"""A table of the latest value of each place, kept by a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline import fixed, storage
from gaugeline.sinks.tables import require_same_run


def latest_state(rows: DataFrame, by: Sequence[str] = fixed.HIERARCHY, time: str = "EventTime", tie_break: Sequence[str] = ()) -> DataFrame:
    """The latest row of each place as an aggregate: in a stream's update mode a batch gives the places that it
    changes, and the state holds one row a place. Rows without a time are the earliest."""
    others = [name for name in rows.columns if name not in by]
    order = F.struct(time, *tie_break)
    latest = rows.groupBy(*by).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return latest.select(*[F.col(name) if name in by else F.col(f"_row.`{name}`").alias(name) for name in rows.columns])


def start(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    by: Sequence[str] = fixed.HIERARCHY,
    time: str = "EventTime",
    tie_break: Sequence[str] = (),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keep the table below ``root``: a folder a place, with the one file of its latest row.

    Only the folders of places whose rows a batch holds are replaced, whatever the size of the table. A batch that
    is run again finds the state it had before and replaces the same folders by the same rows. A batch is
    written aside and moved into place at its end; a reader may miss a place at that moment. Places may not
    be empty text, which a folder's name cannot tell from null.
    """
    require_same_run(rows.sparkSession, root, checkpoint)

    def replace(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(root)

    state = latest_state(rows, by, time, tie_break)
    writer = state.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as it is now. ``schema`` gives the types of places that are not text, and the order of columns."""
    if not storage.exists(spark, root):
        raise FileNotFoundError(f"no table at {root}")
    table = (spark.read.schema(schema) if schema else spark.read).parquet(root)
    return table.select(*schema.fieldNames()) if schema else table
