"""Tables as destinations."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline import storage
from gaugeline.session import scratch_path


def spread(df: DataFrame, partition_by: Sequence[str], files_per_partition: int, salt_from: Sequence[str]) -> DataFrame:
    """Rows of a table partition together, in ``files_per_partition`` tasks and so files.

    Without this every task writes a file for every tag it holds. The salt is taken from the row, by
    default from all of it, so that a rerun task routes its rows as before and rows of equal time part.
    """
    salt = F.pmod(F.xxhash64(*(salt_from or df.columns)), F.lit(files_per_partition))
    return df.repartition(*partition_by, salt)


#: The partition column that a balanced stream adds.
BATCH = "IngestBatch"


def require_same_run(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Refuse a folder whose batches another checkpoint has numbered: the same numbers would now
    stand for other rows."""
    if storage.folders(spark, root) and not storage.exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{root} holds batches that {checkpoint} knows nothing of: give one or the other anew")


@contextlib.contextmanager
def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> Iterator[DataFrame]:
    """The rows stored in buckets by ``key``, so that joins on it need not shuffle them, for the length of a
    ``with`` block. Nothing lazy may outlive it. There are as many buckets as shuffle partitions, or ``buckets``."""
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = "buckets_" + path.rpartition("-")[2]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        storage.delete(spark, path)


@dataclass(frozen=True)
class Table:
    """A table at ``path``.

    ``merge_schema`` lets a later writer add columns (for parquet the reader merges). With
    ``files_per_partition`` a stream gathers each table partition before it writes; a batch is
    rebalanced instead, where adaptive execution splits a hot partition by its real size. Parquet
    files get bloom filters on the columns ``bloom_on``: a scan for a value skips row groups that lack it.
    """

    path: str
    format: str = "parquet"
    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    merge_schema: bool = False
    files_per_partition: int | None = None
    salt_from: Sequence[str] = ()
    bloom_on: Sequence[str] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def _options(self) -> dict[str, str]:
        blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in self.bloom_on}
        return {**({"mergeSchema": "true"} if self.merge_schema else {}), **blooms, **self.options}

    def write_stream(
        self,
        df: DataFrame,
        checkpoint: str,
        trigger: Mapping | None = None,
        name: str | None = None,
    ) -> StreamingQuery:
        """Append each batch. ``trigger`` as for ``DataStreamWriter.trigger``; none means at once."""
        if self.partition_by and self.files_per_partition:
            df = spread(df, self.partition_by, self.files_per_partition, self.salt_from)
        writer = (
            df.writeStream.format(self.format)
            .outputMode("append")
            .options(**self._options())
            .option("checkpointLocation", checkpoint)
        )
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if trigger:
            writer = writer.trigger(**trigger)
        if name:
            writer = writer.queryName(name)
        return writer.start(self.path)

    def write_stream_balanced(
        self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None, name: str | None = None
    ) -> StreamingQuery:
        """Append each batch in tasks of equal size: adaptive execution gathers the table partitions that are small
        and splits those that are large, by their size in this batch, so a hot tag takes as many tasks as it needs.

        Rows also get their batch's number as the last partition column :data:`BATCH`. A batch that is run
        again overwrites its own partitions, and so adds no row, provided that a row's partition
        follows from the row alone. A table format with transactions drops a batch that it has already.
        """
        if BATCH in df.columns:
            raise ValueError(f"a column is named {BATCH}")
        require_same_run(df.sparkSession, self.path, checkpoint)

        def write(batch: DataFrame, batch_id: int) -> None:
            self.write_numbered(batch, batch_id, checkpoint)

        writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def write_numbered(self, batch: DataFrame, batch_id: int, checkpoint: str) -> None:
        """One batch of :meth:`write_stream_balanced`."""
        rows = batch.hint("rebalance", *self.partition_by).withColumn(BATCH, F.lit(batch_id))
        if self.sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        writer = rows.write.format(self.format).partitionBy(*self.partition_by, BATCH).options(**self._options())
        if self.format == "parquet":
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(self.path)
        else:
            done = {"txnAppId": f"{checkpoint}:{self.path}", "txnVersion": str(batch_id)}
            writer.mode("append").options(**done).save(self.path)

    def write_batch(self, df: DataFrame, mode: str = "append", ranges: int | None = None) -> None:
        """With ``ranges`` that many tasks each write a range of ``sort_by``, at the price of a pass to
        sample it; rows of equal time are told apart by a hash of the row."""
        if ranges:
            df = df.repartitionByRange(ranges, *self.partition_by, *self.sort_by, F.xxhash64(*df.columns))
        elif self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
        if self.partition_by or self.sort_by:
            df = df.sortWithinPartitions(*self.partition_by, *self.sort_by)
        writer = df.write.format(self.format).mode(mode).options(**self._options())
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save(self.path)
