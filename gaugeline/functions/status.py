"""Status codes and quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions.numbers import integer_value


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def status_severity(status_code: Column | str) -> Column:
    """Top two bits of the 32-bit code: 0 good, 1 uncertain, 2 bad (3 is reserved)."""
    return F.shiftright(integer_value(status_code), 30).bitwiseAND(F.lit(3)).cast("int")


def is_bad_status(status_code: Column | str) -> Column:
    """Whether the code says bad; a missing code does not."""
    return F.coalesce(status_severity(status_code) >= 2, F.lit(False))


def is_bad_or_null(status_code: Column | str, value: Column | str) -> Column:
    return is_bad_status(status_code) | _col(value).isNull()


def is_bad_status_text(status: Column | str) -> Column:
    """Bad flag of a status that arrives as text: by its name where it has one, else by a hexadecimal
    code, else by a number that stands alone or as ``value=``. Other numbers, such as durations, say nothing."""
    text = _col(status)
    code = F.regexp_extract(text, r"0[xX]([0-9A-Fa-f]{8})(?![0-9A-Fa-f])", 1)
    number = F.regexp_extract(text, r"(?:^\s*|value=)(\d+)(?=\s*$|\))", 1)
    flag = (
        F.when(text.rlike(r"\b(Good|Uncertain|Bad)"), text.rlike(r"\bBad"))
        .when(code != "", is_bad_status(F.conv(code, 16, 10)))
        .when(number != "", is_bad_status(number))
    )
    return F.coalesce(flag, F.lit(False))


def quality_or_good(quality: Column | str) -> Column:
    """A missing or empty quality counts as ``Good``."""
    value = _col(quality)
    return F.when(value != "", value).otherwise("Good")
