"""Numbers that are stored as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_LARGEST_DOUBLE = 1.7976931348623157e308


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def numeric_value(raw: Column | str) -> Column:
    """Text to double, NULL unless the text is a plain decimal or exponent number.

    A bare ``try_cast`` accepts ``12d``, ``NaN`` and ``Infinity``; one NaN then wins every
    ``max`` and poisons every ``avg``. The pattern and the range test keep them out.
    """
    text = F.trim(_col(raw))
    number = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(number) <= F.lit(_LARGEST_DOUBLE)), number)


def finite(value: Column | str) -> Column:
    """A double, NULL when it is NaN or infinite."""
    number = _col(value)
    return F.when(~F.isnan(number) & (F.abs(number) <= F.lit(_LARGEST_DOUBLE)), number)


def value_kind(raw: Column | str) -> Column:
    """``integer``, ``float`` or ``string`` by the look of the text; NULL for no value.

    Whole numbers beyond 64 bits count as ``float``: no integer column could hold them.
    """
    text = F.trim(_col(raw))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull(), "integer")
        .when(numeric_value(text).isNotNull(), "float")
        .otherwise("string")
    )


def integer_value(raw: Column | str) -> Column:
    """Text to bigint, NULL unless the text is a whole number that fits."""
    text = F.trim(_col(raw))
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))
