"""Filters on readings and stored tables."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import fixed
from gaugeline.functions.numbers import numeric_value
from gaugeline.functions.times import as_timestamp, parse_iso


def drop_null_ids(df: DataFrame, column: str = "node_id") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def device_node_ids(device_path: str = fixed.DEVICE_PATH, tags: Sequence[str] = fixed.DEVICE_TAGS, namespace: int = 2) -> list[str]:
    """Node ids of a device's tags."""
    return [f"ns={namespace};s={device_path}.{tag}" for tag in tags]


def allow_node_ids(df: DataFrame, ids: Sequence[str] | None = None, column: str = "node_id") -> DataFrame:
    """Rows with one of the exact ids; ``isin`` reaches a parquet scan as ``In``. No list, or an empty
    one, keeps everything."""
    return df.where(F.col(column).isin(list(ids))) if ids else df


def split_list(text: str | None) -> list[str]:
    """Items of a comma-separated setting, blanks dropped."""
    return [item.strip() for item in (text or "").split(",") if item.strip()]


def allow_tags(df: DataFrame, tags: str | Sequence[str] | None = None, column: str = "Tag") -> DataFrame:
    """Rows with one of the clean tags; no list, or an empty one, keeps everything."""
    wanted = split_list(tags) if isinstance(tags, str) else list(tags or ())
    return df.where(F.col(column).isin(wanted)) if wanted else df


def drop_diagnostics(df: DataFrame, node_id: str = "node_id", tag: str = "Tag") -> DataFrame:
    """Rows that name no diagnostics, by id or tag. A NULL id or tag is dropped too."""
    by_id = F.col(node_id).contains(".Diagnostics.")
    by_tag = F.lower(F.col(tag)).startswith("diagnostics")
    return df.where(~by_id & ~by_tag)


def prefix_probe(
    df: DataFrame,
    prefix: str = fixed.NODE_ID_PREFIX,
    column: str = "node_id",
    limit: int = fixed.PROBE_LIMIT,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A few rows below a node-id prefix, for a look at what arrives."""
    rows = df.where(F.col(column).startswith(prefix))
    return (rows.orderBy(*order_by) if order_by else rows).limit(limit)


def find_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate among the columns, ignoring case, as the table spells it."""
    spelled = {}
    for name in df.columns:
        spelled.setdefault(name.lower(), name)
    return next((spelled[c.lower()] for c in candidates if c.lower() in spelled), None)


def time_expression(df: DataFrame, column: str | None = None) -> Column:
    """The time column as a timestamp: bare where it is one (so that bounds reach the scan),
    parsed where it is text."""
    name = column or find_column(df, fixed.TIME_COLUMNS)
    if name is None:
        raise ValueError(f"no time column among {df.columns}")
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.StringType):
        return parse_iso(name)
    if isinstance(data_type, T.TimestampNTZType):
        return F.col(name).cast("timestamp")
    return F.col(name)


def value_expression(df: DataFrame, column: str) -> Column:
    """The value column as a double: bare where numeric, guarded cast where text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return numeric_value(column)
    return F.col(column)


def _given(bound) -> bool:
    """Empty text counts as absent; zero counts as present."""
    return bound is not None and not (isinstance(bound, str) and bound == "")


def time_bounds(time: Column, start=None, end=None) -> list[Column]:
    """Both ends inclusive, each optional."""
    bounds = []
    if _given(start):
        bounds.append(time >= as_timestamp(start))
    if _given(end):
        bounds.append(time <= as_timestamp(end))
    return bounds


def date_bounds(df: DataFrame, start=None, end=None, column: str = "EventDate") -> list[Column]:
    """Bounds on the date column that follow from bounds on the time, to prune date partitions.

    A day wider on either side, so that they hold whatever zone the dates were taken in. A date
    read from a partition path is text, and ISO text sorts like the date.
    """
    name = find_column(df, (column,))
    if name is None:
        return []
    data_type = df.schema[name].dataType
    bounds = []
    if _given(start):
        bounds.append(F.col(name) >= F.date_sub(as_timestamp(start).cast("date"), 1).cast(data_type))
    if _given(end):
        bounds.append(F.col(name) <= F.date_add(as_timestamp(end).cast("date"), 1).cast(data_type))
    return bounds


def value_bounds(value: Column, low: float | None = None, high: float | None = None) -> list[Column]:
    """Both ends inclusive, each optional. A row without a number fails any bound given."""
    bounds = []
    if _given(low):
        bounds.append(value >= F.lit(float(low)))
    if _given(high):
        bounds.append(value <= F.lit(float(high)))
    return bounds


def quality_condition(quality: str | None, column: str = "quality") -> list[Column]:
    """Equality; the text ``null`` asks for rows without a quality."""
    if not _given(quality):
        return []
    return [F.col(column).isNull() if quality == "null" else F.col(column) == quality]


def where_all(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """Rows that meet every condition; no condition keeps everything."""
    return df.where(functools.reduce(operator.and_, conditions)) if conditions else df
