"""From message payloads to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.functions.numbers import finite, numeric_value


def decode(df: DataFrame, source: str = "value", target: str = "json") -> DataFrame:
    """Binary column to text."""
    return df.withColumn(target, F.col(source).cast("string"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The table with a column that filters and projections above it do not compute again.

    Catalyst moves a filter below a projection and puts the whole expression into it, a second
    time. It does not move one below a generator that makes the column.
    """
    others = [f"`{c}`" for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    payload: str = "json",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep`` plus a struct ``message`` and the flag ``unparsable``.

    The payload is parsed once a record, also under filters on its fields.
    """
    full = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(payload), full, {"columnNameOfCorruptRecord": schemas.CORRUPT})
    needed = dict.fromkeys([*keep, payload])
    rows = computed_once(df.select(*needed), "message", parsed).select(*keep, "message")
    # Text that is not an object is flagged; an empty payload gives no struct at all.
    unparsable = F.col("message").isNull() | F.col(f"message.{schemas.CORRUPT}").isNotNull()
    return rows.withColumn("unparsable", unparsable)


def parse_messages(
    df: DataFrame,
    payload: str = "json",
    keep: Sequence[str] = (),
) -> DataFrame:
    """All fields of all producer contracts as text, ids and names trimmed.

    One row per record, also for records that do not parse.
    """
    clash = set(keep) & {*schemas.MESSAGE.fieldNames(), "unparsable"}
    if clash:
        raise ValueError(f"columns to keep share names with message fields: {sorted(clash)}")
    names = [n for n in schemas.MESSAGE.fieldNames() if n not in ("node_id", "display_name", "nodeId", "displayName")]
    m = "message."
    return parse_json(df, schemas.MESSAGE, payload, keep).select(
        *keep,
        F.trim(F.coalesce(f"{m}node_id", f"{m}nodeId")).alias("node_id"),
        F.trim(F.coalesce(f"{m}display_name", f"{m}displayName")).alias("display_name"),
        *[F.col(m + n).alias(n) for n in names],
        "unparsable",
    )


def parse_flat(df: DataFrame, payload: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """The flat text table of six columns. One row per record; junk gives a row of NULLs."""
    m = "message."
    return parse_json(df, schemas.MESSAGE_FLAT, payload, keep).select(
        *keep,
        F.col(f"{m}node_id").alias("nodeId"),
        F.col(f"{m}display_name").alias("displayName"),
        F.col(f"{m}value").alias("value"),
        F.col(f"{m}timestamp").alias("timestamp"),
        F.col(f"{m}source_timestamp").alias("sourceTimestamp"),
        F.col(f"{m}quality").alias("quality"),
    )


def parse_flat_plain(df: DataFrame, payload: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """The flat text table without quality and without rows that lack a node id."""
    m = "message."
    rows = parse_json(df, schemas.MESSAGE_FLAT_PLAIN, payload, keep).select(
        *keep,
        F.col(f"{m}node_id").alias("nodeId"),
        F.col(f"{m}display_name").alias("displayName"),
        F.col(f"{m}value").alias("value"),
        F.col(f"{m}timestamp").alias("timestamp"),
        F.col(f"{m}source_timestamp").alias("sourceTimestamp"),
    )
    return rows.where(F.col("nodeId").isNotNull())


def parse_typed(df: DataFrame, payload: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """The typed camelCase contract, expanded to its columns; a value that is no number is NULL."""
    rows = parse_json(df, schemas.MESSAGE_TYPED, payload, keep).select(*keep, "message.*").drop(schemas.CORRUPT)
    return rows.withColumn("value", finite("value"))


def with_numeric_value(df: DataFrame, source: str = "RawData", target: str = "value") -> DataFrame:
    """A double read from the text column, NULL where the text is no number."""
    return df.withColumn(target, numeric_value(source))


def with_variant(df: DataFrame, payload: str = "json", field: str = "value", target: str = "value_variant") -> DataFrame:
    """A field of the payload as VARIANT, read once a record: lists, objects and numbers of up to 38 digits keep
    their parts for ``variant_get``. NULL where the payload is no JSON, as with a bare NaN in it."""
    return computed_once(df, target, F.variant_get(F.try_parse_json(payload), f"$.{field}", "variant"))


def with_value_type(df: DataFrame, payload: str = "json", field: str = "value", target: str = "value_type") -> DataFrame:
    """The JSON type of a field: ``string``, ``number``, ``boolean``, ``array`` or ``object``; NULL if it is null or
    missing, or the payload is no JSON. Beside the parsed text, in which ``"12"`` and ``12`` are alike."""
    shape = F.schema_of_variant(F.variant_get(F.try_parse_json(payload), f"$.{field}", "variant"))
    rows = computed_once(df, target, shape)
    kind = F.regexp_extract(target, "^[A-Z]+", 0)
    return rows.withColumn(
        target,
        F.when(kind.isin("STRING", "BOOLEAN", "ARRAY", "OBJECT"), F.lower(kind)).when(F.col(target).isNotNull() & (kind != "VOID"), "number"))


def json_safe(column: Column, data_type: T.DataType) -> Column:
    """A column as it may go into a message: times as ISO text, non-finite numbers as NULL, also within
    nested data, which stays nested, and everything else as it is."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: json_safe(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(column, lambda _, item: json_safe(item, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [json_safe(column[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(data_type, T.TimestampNTZType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(data_type, T.DateType):
        return column.cast("string")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return finite(column.cast("double"))
    if isinstance(data_type, T.BinaryType):
        return F.base64(column)
    return column


def normalise_values(df: DataFrame, *columns: str) -> DataFrame:
    """Apply :func:`json_safe` to the named columns, or to all."""
    chosen = columns or tuple(df.columns)
    return df.withColumns({name: json_safe(F.col(name), df.schema[name].dataType) for name in chosen})


def to_records(df: DataFrame, target: str = "record") -> DataFrame:
    """One JSON object per row, NULL fields included, times in microseconds."""
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return df.select(F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]), options).alias(target))
