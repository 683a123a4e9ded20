"""Readings as keyed messages, by topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import fixed
from gaugeline.operators.parsing import normalise_values


def topic_for(message_type: Column | str, values: str = fixed.TOPIC_VALUES, events: str = fixed.TOPIC_EVENTS) -> Column:
    """Events and the status of their subscription go to the second topic, all else to the first."""
    kind = F.col(message_type) if isinstance(message_type, str) else message_type
    return F.when(kind.isin(fixed.TYPE_EVENT, fixed.TYPE_EVENT_SUBSCRIPTION_STATUS), events).otherwise(values)


def to_messages(
    df: DataFrame,
    key: str = "node_id",
    fields: Sequence[str] | None = None,
    topic: Column | str = fixed.TOPIC_VALUES,
    keep: Sequence[str] = (),
    as_read: Sequence[str] = ("value", "status_code"),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """``topic``, binary ``key`` and binary JSON ``value``, ready for the Kafka sink.

    A NULL key leaves the choice of partition to the producer, as for status messages. Text columns of
    ``as_read`` hold the text of a parsed JSON value: a number, boolean, list or object goes out as such,
    at the end of the message, anything else as text. ``types`` names the column with the JSON type of such a column
    (:func:`gaugeline.operators.parsing.with_value_type`), so that a value goes out as what it came as, text
    that looks like a number too; without, the look of the text decides.
    """
    types = dict(types or {})
    keep = [*keep, *[n for n in types.values() if n not in keep]]
    names = [n for n in df.columns if n not in keep] if fields is None else list(fields)
    texts = [n for n in as_read if n in names and isinstance(df.schema[n].dataType, T.StringType)]
    safe = normalise_values(df, *names)
    plain = F.to_json(F.struct(*[n for n in names if n not in texts])) if len(texts) < len(names) else F.lit("{}")
    added = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), json_text(n, types.get(n))) for n in texts])  # NULLs stay out
    inner = F.substring(plain, F.lit(2), F.length(plain) - 2)
    payload = F.concat(F.lit("{"), F.concat_ws(",", F.nullif(inner, F.lit("")), F.nullif(added, F.lit(""))), F.lit("}")) if texts else plain
    return safe.select(
        *[n for n in keep if n not in types.values()],
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        F.col(key).cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
    )


def json_text(column: str, json_type: str | None = None) -> Column:
    """The JSON of a text column. With the column ``json_type`` text of the type ``string`` is a JSON string and
    text of any other type stands as it is. Without, or where that is NULL, it stands as it is if it is a
    JSON number, boolean, list or object."""
    text = F.col(column)
    array = F.to_json(F.array(text))
    quoted = F.substring(array, F.lit(2), F.length(array) - 2)
    scalar = text.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$") | text.isin("true", "false")
    nested = text.rlike(r"^[\[{]") & F.try_parse_json(text).isNotNull()
    by_look = F.when(scalar | nested, text).when(text.isNotNull(), quoted)
    if json_type is None:
        return by_look
    kind = F.col(json_type)
    return F.when((kind == "string") & text.isNotNull(), quoted).when(kind.isNotNull(), text).otherwise(by_look)
