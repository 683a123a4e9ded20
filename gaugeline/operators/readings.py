"""Aggregates, samples, latest values and typed values of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions.numbers import value_kind
from gaugeline.operators.filtering import value_expression
from gaugeline.operators.parsing import computed_once


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included."""
    return df.select(column).distinct()


def value_stats(df: DataFrame, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Average, largest and smallest number per group; without ``by`` one row, also of no input."""
    number = value_expression(df, value)
    return df.groupBy(*by).agg(
        F.avg(number).alias("avg_value"),
        F.max(number).alias("max_value"),
        F.min(number).alias("min_value"),
    )


def row_count(df: DataFrame, target: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(target))


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark cuts every group to ``n`` rows in each input partition before the shuffle, so a hot
    group reaches its task already small; the session setting for that allows for any sensible ``n``.
    """
    rank = "_rank"
    whole = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= n).drop(rank)


def first_samples(
    df: DataFrame,
    by: Sequence[str] = fixed.HIERARCHY,
    time: str = "EventTime",
    tie_break: Sequence[str] = (),
    n: int = fixed.SAMPLES_PER_TAG,
) -> DataFrame:
    """The first ``n`` samples of each place: a tag is unique only within its equipment."""
    order = [F.asc_nulls_last(time), *[F.asc_nulls_last(c) for c in tie_break]]
    return first_per_group(df, by, order, n)


def latest_values(
    df: DataFrame,
    by: Sequence[str] = fixed.HIERARCHY,
    time: str = "EventTime",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The latest row of each place in the hierarchy: a tag is unique only within its equipment. Associative, so batches can be folded into a stored result."""
    order = [F.desc_nulls_last(time), *[F.desc_nulls_last(c) for c in tie_break]]
    return first_per_group(df, by, order, 1)


def with_typed_value(df: DataFrame, source: str = "RawData", json_type: str | None = None) -> DataFrame:
    """``kind`` (integer, float, string; NULL for no value) and one typed column for each kind.

    With the column ``json_type`` (:func:`gaugeline.operators.parsing.with_value_type`) only a JSON number is a
    number; without, or where that is NULL, any text that looks like one.
    """
    text, kind = F.trim(source), F.col("kind")
    looks = value_kind(source)
    if json_type is not None:
        known = F.col(json_type).isNotNull() & (F.col(json_type) != "number")
        looks = F.when(known & F.col(source).isNotNull(), "string").otherwise(looks)
    # The kind vouches for the casts: no need to match the patterns again.
    return computed_once(df, "kind", looks).withColumns(
        {
            "value_integer": F.when(kind == "integer", text.try_cast("bigint")),
            "value_float": F.when(kind == "float", text.try_cast("double")),
            "value_string": F.when(kind == "string", F.col(source)),
        }
    )
