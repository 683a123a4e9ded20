"""ISO time text, event time, and time text for the wire."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.fixed import MAX_FUTURE_SECONDS

_NAIVE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"

MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_timestamp(value: Column | str | dt.datetime | None) -> Column:
    """A moment given as a column, ISO text or datetime; ``None`` is now.

    Text and datetimes without an offset are UTC, whatever the zone of the process.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        moment = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    else:
        moment = dt.datetime.fromisoformat(value)
        moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(moment.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def parse_iso_offset(text: Column | str) -> Column:
    """ISO time that carries an offset or ``Z``; NULL for anything else."""
    value = _col(text)
    return F.when(value.rlike(_WITH_OFFSET), value.try_cast("timestamp"))


def parse_iso_naive(text: Column | str, default_offset: str = "+00:00") -> Column:
    """ISO time without an offset, read at ``default_offset``; NULL for anything else."""
    value = _col(text)
    return F.when(value.rlike(_NAIVE), F.concat(value, F.lit(default_offset)).try_cast("timestamp"))


def parse_iso(text: Column | str, default_offset: str = "+00:00") -> Column:
    """ISO time with an offset, else without. The pattern guards a cast, which parses faster
    than a formatter and would on its own take ``2025`` or ``10:00`` for a time."""
    return F.coalesce(parse_iso_offset(text), parse_iso_naive(text, default_offset))


def event_time(
    source: Column | str,
    ingest: Column | str,
    as_of: Column | str | dt.datetime | None = None,
    default_offset: str = "+00:00",
) -> Column:
    """Source time, else ingest time, else ``as_of``."""
    return F.coalesce(parse_iso(source, default_offset), parse_iso(ingest, default_offset), as_timestamp(as_of))


def clamp_future(
    time: Column | str,
    as_of: Column | str | dt.datetime | None = None,
    max_future_seconds: int = MAX_FUTURE_SECONDS,
) -> Column:
    """``as_of`` in place of a time more than ``max_future_seconds`` after it."""
    now = as_timestamp(as_of)
    value = _col(time)
    limit = now + F.make_dt_interval(secs=F.lit(max_future_seconds))
    return F.when(value <= limit, value).otherwise(now)


def event_date(time: Column | str) -> Column:
    return F.to_date(_col(time))


def iso_text(time: Column | str, pattern: str = MICROS_Z) -> Column:
    """A time as wire text. Spark's JSON writer would cut it to milliseconds."""
    return F.date_format(_col(time), pattern)


def ingest_stamp(as_of: Column | str | dt.datetime | None = None) -> Column:
    """The time a reading is taken in, as millisecond ISO text with ``Z``."""
    return iso_text(as_timestamp(as_of), MILLIS_Z)
