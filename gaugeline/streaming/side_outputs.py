"""One parse, several tables: readings and side tables from one stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline import storage
from gaugeline.operators import hierarchy, routing
from gaugeline.operators.hierarchy import Plant
from gaugeline.plans.history import messages
from gaugeline.sinks.tables import require_same_run

TABLES = ("readings", "bad_values", "connection_health", "events", "dead_letters")

#: The message as it came, which a dead letter keeps.
PAYLOAD = "json"


def split(classified: DataFrame, plant: Plant = Plant(), as_of=None, keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The tables of :data:`TABLES` from classified messages that have kept their payload: every message
    is a row of one of them."""
    rows = hierarchy.with_tag(routing.readings(classified), plant, by_name=True)
    return {
        "readings": hierarchy.to_hierarchy(rows, plant, as_of, keep),
        "bad_values": routing.bad_values(classified, keep),
        "connection_health": routing.connection_health(classified, keep),
        "events": routing.events(classified, keep),
        "dead_letters": routing.dead_letters(classified, PAYLOAD, keep),
    }


def to_keep(classified: DataFrame) -> DataFrame:
    """Classified messages with the payload of dead letters only, the one table that has it."""
    return classified.withColumn(PAYLOAD, F.when(F.col("message_class").isin(*routing.DEAD), F.col(PAYLOAD)))


def start(
    envelope: DataFrame,
    root: str,
    checkpoint: str,
    plant: Plant = Plant(),
    as_of=None,
    keep: Sequence[str] = (),
    trigger: Mapping | None = None,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Write every table below ``root``, each batch to a folder of its own.

    A batch that is run again after a failure overwrites its own folders and nothing else, so each
    row lands once. The batch is parsed once and kept while its tables are written, without the payload of
    messages that are no dead letters. A table format with
    transactions gets one table each instead, and drops a batch that it has already.
    """
    require_same_run(envelope.sparkSession, root, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = to_keep(messages(batch, (*keep, PAYLOAD), payload=PAYLOAD)).persist()
        try:
            for name, table in split(parsed, plant, as_of, keep).items():
                # Rebalanced, as a side table may have a few rows in each of many tasks.
                rows = table.hint("rebalance")
                if table_format == "parquet":
                    rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
                else:
                    done = {"txnAppId": f"{checkpoint}/{name}", "txnVersion": str(batch_id)}
                    rows.write.format(table_format).mode("append").options(**done).save(f"{root}/{name}")
        finally:
            parsed.unpersist()

    writer = envelope.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _complete(spark: SparkSession, root: str, table: str) -> tuple[list[tuple[int, int]], list[int]]:
    """Ranges of batches that are merged, and numbers of the other batches, those that have their success marker."""
    names = [path.split("/")[-2] for path in storage.matching(spark, f"{root}/{table}/*/_SUCCESS")]
    merged = sorted(tuple(map(int, name.removeprefix("merged=").split("-"))) for name in names if name.startswith("merged="))
    numbers = sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))
    return merged, [n for n in numbers if not any(low <= n <= high for low, high in merged)]


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The batches of a parquet side table that are complete, merged or as written: one that is being written,
    or written again, has no success marker and stays out."""
    merged, numbers = _complete(spark, root, table)
    path = f"{root}/{table}"
    parts = [*[f"{path}/merged={low}-{high}" for low, high in merged], *[f"{path}/batch={n}" for n in numbers]]
    if not parts:
        raise FileNotFoundError(f"no complete batch below {path}")
    return spark.read.parquet(*parts)


def compact(spark: SparkSession, root: str, table: str) -> tuple[int, int] | None:
    """Merge the batches since the last call into one folder of larger files; returns the first and the last of them.

    Runs beside the stream, again and again: each call reads the new batches only. The newest batch stays out,
    as it may have to be run again, and so does what follows a batch that is not complete. Readers take the merged rows from
    the moment that they are complete, and the batches until then; :func:`retire` deletes these.
    """
    merged, numbers = _complete(spark, root, table)
    first = merged[-1][1] + 1 if merged else (numbers[0] if numbers else 0)
    last = first
    while last in numbers and last < numbers[-1]:
        last += 1
    if last - first < 2:
        return None
    path = f"{root}/{table}"
    rows = spark.read.parquet(*[f"{path}/batch={n}" for n in range(first, last)])
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/merged={first}-{last - 1}")
    return first, last - 1


def retire(spark: SparkSession, root: str, table: str) -> int:
    """Delete the batches that are merged, once no reader needs them; returns how many."""
    merged, _ = _complete(spark, root, table)
    gone = [name for name in storage.folders(spark, f"{root}/{table}") if name.startswith("batch=")
            and any(low <= int(name.removeprefix("batch=")) <= high for low, high in merged)]
    for name in gone:
        storage.delete(spark, f"{root}/{table}/{name}")
    return len(gone)
