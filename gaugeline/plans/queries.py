"""Queries on the stored tables. Each returns a DataFrame; errors are raised.

``tie_break`` names columns that order rows of equal time, so that a limit cuts at the same row
every time. Null times come last in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.operators import filtering, readings


def _newest_first(time: Column, tie_break: Sequence[str]) -> list[Column]:
    return [time.desc_nulls_last(), *[F.desc_nulls_last(c) for c in tie_break]]


def _oldest_first(time: Column, tie_break: Sequence[str]) -> list[Column]:
    return [time.asc_nulls_last(), *[F.asc_nulls_last(c) for c in tie_break]]


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return df
    if limit < 0:
        raise ValueError("limit must not be negative")
    return df.limit(limit)


def _name_column(df: DataFrame) -> str:
    name = filtering.find_column(df, ("displayName", "display_name", "Tag"))
    if name is None:
        raise ValueError(f"no name column among {df.columns}")
    return name


def _value_column(df: DataFrame) -> str:
    name = filtering.find_column(df, ("ValueDouble", "value", "RawData"))
    if name is None:
        raise ValueError(f"no value column among {df.columns}")
    return name


def _newest(
    df: DataFrame, time: Column, n: int | None, tie_break: Sequence[str], date_partition: str | None, counts: DataFrame | None = None
) -> DataFrame:
    """The ``n`` newest rows.

    ``date_partition`` is for tables stored by date: only the newest dates that hold ``n`` rows are read,
    through a pushed scalar subquery on the partition. The rows of each date are taken from the roll-up
    ``counts``, or else counted, which reads no more than the filter's columns. Rows without a date are
    those without a time; they come last, and are read too if the dates hold fewer than ``n``.
    """
    if date_partition and n:
        date = F.col(date_partition)
        newer = Window.orderBy(F.col("d").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        rows_of = F.count(F.lit(1)) if counts is None else F.sum("n")
        # In the type that the partition has here: a cast of the partition itself would hide it.
        day = date.cast(df.schema[date_partition].dataType).alias("d")
        days = (df if counts is None else counts).groupBy(day).agg(rows_of.alias("n"))  # one row a date
        days = days.withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0))).where(F.col("newer") < n)
        none = F.coalesce(F.bool_or(F.col("d").isNull()), F.lit(False))
        bounds = days.agg(F.struct(F.min("d").alias("first"), none.alias("none"))).scalar()
        df = df.where((date >= bounds["first"]) | (date.isNull() & bounds["none"]))
    return _limited(df.orderBy(*_newest_first(time, tie_break)), n)


def list_nodes(df: DataFrame) -> DataFrame:
    """Distinct display names, NULL included."""
    return readings.distinct_values(df, _name_column(df))


def latest_for_node(
    df: DataFrame,
    node: str,
    limit: int | None = fixed.LATEST_LIMIT,
    tie_break: Sequence[str] = (),
    date_partition: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The newest rows of one node; ``limit=None`` for all. With the table's roll-up as ``counts``
    (:mod:`gaugeline.plans.rollup`) no other date than those of the result is read at all."""
    name = _name_column(df)
    rows = df.where(F.col(name) == node)
    own = None if counts is None else counts.where(F.col(name) == node)
    return _newest(rows, filtering.time_expression(df), limit, tie_break, date_partition, own)


def node_stats(df: DataFrame, node: str | None = None, value: str | None = None) -> DataFrame:
    """Average, largest and smallest value: one row for ``node`` (all NULL if it has none), or one
    row for every node."""
    name = _name_column(df)
    value = value or _value_column(df)
    if node is None:
        return readings.value_stats(df, [name], value)
    return readings.value_stats(df.where(F.col(name) == node), value=value)


def query_by_time(
    df: DataFrame, start, end, limit: int | None = fixed.RANGE_LIMIT, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, oldest first."""
    time = filtering.time_expression(df)
    bounds = [*filtering.date_bounds(df, start, end), *filtering.time_bounds(time, start, end)]
    rows = filtering.where_all(df, bounds)
    return _limited(rows.orderBy(*_oldest_first(time, tie_break)), limit)


def filter_readings(
    df: DataFrame,
    node: str | None = None,
    start=None,
    end=None,
    quality: str | None = None,
    value: float | None = None,
    min_value: float | None = None,
    max_value: float | None = None,
    limit: int | None = fixed.FILTER_LIMIT,
    tie_break: Sequence[str] = (),
    value_column: str | None = None,
) -> DataFrame:
    """Rows that meet whichever conditions are given, oldest first; ``limit=None`` for all."""
    time = filtering.time_expression(df)
    conditions = [
        *([] if node is None else [F.col(_name_column(df)) == node]),
        *filtering.date_bounds(df, start, end),
        *filtering.time_bounds(time, start, end),
        *filtering.quality_condition(quality),
    ]
    if any(bound is not None for bound in (value, min_value, max_value)):
        number = filtering.value_expression(df, value_column or _value_column(df))
        conditions += filtering.value_bounds(number, min_value, max_value)
        if value is not None:
            conditions.append(number == F.lit(float(value)))
    return _limited(filtering.where_all(df, conditions).orderBy(*_oldest_first(time, tie_break)), limit)


def latest(
    df: DataFrame, n: int | None = fixed.LATEST_LIMIT, tie_break: Sequence[str] = (), date_partition: str | None = None
) -> DataFrame:
    """The newest rows by whichever time column there is; without one the first by ``tie_break``, or
    without that any ``n`` rows."""
    if filtering.find_column(df, fixed.TIME_COLUMNS) is None:
        return _limited(df.orderBy(*tie_break) if tie_break else df, n)
    return _newest(df, filtering.time_expression(df), n, tie_break, date_partition)


def query_path(
    df: DataFrame,
    enterprise: str,
    site: str,
    line: str,
    equipment: str,
    tag: str,
    start=None,
    end=None,
    min_value: float | None = None,
    max_value: float | None = None,
    limit: int | None = fixed.PATH_LIMIT,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest rows of one place in the hierarchy, with the number read from the text as ``value``.

    Bounds go to the stored number where the table has one, and so to the scan.
    """
    if limit is not None and not 0 <= limit <= fixed.PATH_LIMIT_MAX:
        raise ValueError(f"limit must be None for all, or between 0 and {fixed.PATH_LIMIT_MAX}")
    place = zip(fixed.HIERARCHY, (enterprise, site, line, equipment, tag))
    number = filtering.value_expression(df, filtering.find_column(df, ("ValueDouble", "RawData")))
    conditions = [
        *[F.col(level) == name for level, name in place],
        *filtering.date_bounds(df, start, end),
        *filtering.time_bounds(F.col("EventTime"), start, end),
        *filtering.value_bounds(number, min_value, max_value),
    ]
    rows = filtering.where_all(df, conditions).withColumn("value", number)
    return _limited(rows.orderBy(*_newest_first(F.col("EventTime"), tie_break)), limit)


def dump(df: DataFrame, n: int | None = fixed.DUMP_LIMIT, order_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """How many rows there are, and the first ``n`` of them by ``order_by``; ``n=None`` for all."""
    return readings.row_count(df), _limited(df.orderBy(*order_by) if order_by else df, n)
