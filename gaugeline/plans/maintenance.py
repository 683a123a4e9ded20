"""Upkeep of stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.sinks.tables import Table
from gaugeline.sources.files import read_table


#: Rows that a task sorts, and so the most in a file, unless the caller says otherwise: well-compressed rows take
#: many times the bytes of their files in memory.
FILE_ROWS = 1_000_000


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    table_format: str = "parquet",
    only: Column | None = None,
    file_bytes: int = 128 * 1024 * 1024,
    file_rows: int = FILE_ROWS,
) -> None:
    """Rewrite a table of many small files as a new table at ``target``.

    With ``sort_by`` each file gets a range of it: a hot table partition is cut along the range,
    and later scans skip files and row groups by their statistics. Without, rows are rebalanced by
    table partition and by size. ``only`` limits the work to some partitions, such as the days
    since the last run. There are as many ranges as the files with rows of that work have ``file_bytes``, or as that
    work has ``file_rows`` if that is more, so that what a task sorts does not grow with the table. The old table
    stays as it is; readers move to the new path when the write has succeeded.
    """
    rows = read_table(spark, path, table_format)
    if only is not None:
        rows = rows.where(only)
    table = Table(target, table_format, partition_by, sort_by)
    ranges = _ranges(rows, file_bytes, file_rows) if sort_by else None
    table.write_batch(rows, mode="errorifexists", ranges=ranges)


#: Bits of a cell's number along each side of the curve.
CELL_BITS = 16


def _spread(cell: Column) -> Column:
    """The bits of a number of 16 bits, each followed by a free one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return cell


def curve_key(across: Column, along: Column) -> Column:
    """The place of a cell on the Z-curve over two sides of 2**16 cells: neighbours on it are near in both."""
    return F.shiftleft(_spread(across), 1).bitwiseOR(_spread(along))


def with_curve_key(rows: DataFrame, tag: str, time: str, target: str) -> DataFrame:
    """The rows with their place on a curve over tag and time.

    Tags lie along their side in order, each as far in as rows come before it, so that frequent tags are far
    apart; times lie evenly between the first and the last. Nulls come first.
    """
    cells = 1 << CELL_BITS
    # One row a tag: the window holds the list of tags, never rows.
    before = Window.orderBy(F.col(tag).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    tags = rows.groupBy(tag).agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(tag).alias("_tag"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_all"))
    across = F.floor(F.col("_before") * (cells - 1) / F.col("_all")).cast("long")
    ends = rows.agg(F.struct(F.unix_micros(F.min(time)).alias("first"), F.unix_micros(F.max(time)).alias("last"))).scalar()
    span = F.greatest(ends["last"] - ends["first"], F.lit(1))
    along = F.coalesce(F.floor((F.unix_micros(time) - ends["first"]) * F.lit(float(cells - 1)) / span).cast("long"), F.lit(0).cast("long"))
    placed = rows.join(tags, rows[tag].eqNullSafe(tags["_tag"]))
    return placed.withColumn(target, curve_key(across, along)).drop("_tag", "_before", "_all")


def compact_by_curve(
    spark: SparkSession,
    path: str,
    target: str,
    tag: str = "Tag",
    time: str = "EventTime",
    table_format: str = "parquet",
    only: Column | None = None,
    file_bytes: int = 128 * 1024 * 1024,
    file_rows: int = FILE_ROWS,
) -> None:
    """Rewrite a table as a new one without folders, whose files each hold a range of a curve over tag and time.

    For tables of very many tags, where a folder a tag makes too many files, and a range of tags alone would leave
    queries by time to read every file. A query for a tag skips files by its least and greatest tags, a query for a stretch of time by its
    times, each about the square root of all files. Equal places on the curve are told apart by a hash of the row,
    so a hot tag at one time is still cut. Other arguments are as for :func:`compact`.
    """
    rows = read_table(spark, path, table_format)
    if only is not None:
        rows = rows.where(only)
    ranges = _ranges(rows, file_bytes, file_rows)
    keyed = with_curve_key(rows, tag, time, "_place").repartitionByRange(ranges, "_place", F.xxhash64(*rows.columns))
    keyed.drop("_place").sortWithinPartitions(tag, time).write.format(table_format).mode("errorifexists").save(target)


def _selected(rows: DataFrame) -> tuple[int, int]:
    """Bytes of the files that hold any of ``rows`` of a stored table, and how many rows these are, in one pass. Only
    the columns of a filter are read."""
    files = rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    found = files.agg(F.sum("bytes"), F.sum("n")).first()
    return found[0] or 0, found[1] or 0


def selected_bytes(rows: DataFrame) -> int:
    """Bytes of the files that hold any of ``rows`` of a stored table. Only the columns of a filter are read."""
    return _selected(rows)[0]


def _ranges(rows: DataFrame, file_bytes: int, file_rows: int) -> int:
    size, count = _selected(rows)
    return max(1, -(-size // file_bytes), -(-count // file_rows))


def file_sizes(spark: SparkSession, path: str):
    """Files and bytes below a path by folder, to tell whether a table needs compaction."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
