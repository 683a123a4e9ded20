"""Schemas of messages, stored tables and the tag catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


#: Envelope of the message bus, as the Kafka source delivers it with headers.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
            ),
        ),
    ]
)

#: Union of all producer contracts. Text throughout: typing happens after parsing, so one bad
#: field never costs the record. The camelCase names serve the typed contract.
MESSAGE = _text(
    "timestamp",
    "node_id",
    "display_name",
    "equipment_name",
    "production_line",
    "value",
    "status_code",
    "quality",
    "source_timestamp",
    "server_timestamp",
    "type",
    "status",
    "event",
    "nodeId",
    "displayName",
)

#: Contract of the flat tables, with and without the quality field.
MESSAGE_FLAT = _text("timestamp", "node_id", "display_name", "value", "source_timestamp", "quality")
MESSAGE_FLAT_PLAIN = _text("timestamp", "node_id", "display_name", "value", "source_timestamp")

#: Typed camelCase contract.
MESSAGE_TYPED = T.StructType(
    [
        T.StructField("nodeId", T.StringType()),
        T.StructField("displayName", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

FLAT_TABLE = _text("nodeId", "displayName", "value", "timestamp", "sourceTimestamp", "quality")
FLAT_TABLE_PLAIN = _text("nodeId", "displayName", "value", "timestamp", "sourceTimestamp")
FLAT_TABLE_TYPED = MESSAGE_TYPED

HIERARCHY_TABLE = T.StructType(
    [
        T.StructField("Enterprise", T.StringType()),
        T.StructField("Site", T.StringType()),
        T.StructField("ProductionLine", T.StringType()),
        T.StructField("Equipment", T.StringType()),
        T.StructField("Tag", T.StringType()),
        T.StructField("RawData", T.StringType()),
        T.StructField("StatusCode", T.StringType()),
        T.StructField("EventTime", T.TimestampType()),
        T.StructField("EventDate", T.DateType()),
    ]
)

CATALOGUE = T.StructType(
    [
        T.StructField("node_id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("node_class", T.StringType()),
        T.StructField("path", T.ArrayType(T.StringType())),
    ]
)
