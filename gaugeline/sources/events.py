"""The ``events`` table seen as a stream of sensor messages, and node catalogues made from it.

The rules are messy on purpose: missing values, bad payloads, missing times, names with spaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline import fixed
from gaugeline.sources.files import read_parquet

#: "Now" for these data: late January, so that the last days lie in the future.
AS_OF = "2024-01-25T00:00:00"

#: What a message keeps besides its payload: where it stands on the bus, a unique tie-break.
POSITION = ("offset",)

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# The adapter is SQL text: rules on columns of the table read best that way.

_TAG = """CASE event_type WHEN 'click' THEN 'Comp_Pressure' WHEN 'view' THEN 'Comp_Motor_Current_ A'
  WHEN 'purchase' THEN 'Comp_Motor_Speed' WHEN 'signup' THEN 'Comp_Freq'
  WHEN 'error' THEN 'Diagnostics.LastError' END"""

_NODE_ID = f"'{fixed.NODE_ID_PREFIX}' || tag"

# The time a message is taken in: a second after its source time, without an offset.
_INGEST = "date_format(ts + INTERVAL 1 SECOND, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_SOURCE = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"

# Every field but the value.
_READING = f"""
  {_INGEST} AS timestamp,
  IF(event_id % 97 = 0, '{fixed.TYPE_BAD_VALUE}', NULL) AS type,
  {_NODE_ID} AS node_id,
  IF(event_id % 97 = 0, NULL, tag) AS display_name,
  IF(event_id % 11 = 0, NULL, 'Compressor-' || user_id % 3) AS equipment_name,
  IF(event_id % 7 = 0, NULL, 'Line-' || user_id % 2) AS production_line,
  CASE WHEN event_id % 97 = 0 THEN 2150891520L WHEN event_id % 31 = 0 THEN 1083179008L ELSE 0L END AS status_code,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'Bad' WHEN event_id % 31 = 0 THEN 'Uncertain'
    ELSE 'Good' END AS quality,
  IF(event_id % 13 = 0, NULL, {_SOURCE}) AS source_timestamp"""

# Numbers, text, booleans and lists, as the wire allows them; NULL for none. Some texts look like numbers or
# booleans, some numbers have 21 digits, some lists hold lists and objects.
_MIXED_VALUE = """CASE WHEN event_id % 97 = 0 THEN NULL
  WHEN event_id % 12 = 1 THEN '"' || event_id || '"'
  WHEN event_id % 60 = 7 THEN '"true"'
  WHEN event_id % 6 = 0 THEN string(event_id)
  WHEN event_id % 6 = 1 THEN '"' || event_type || '"'
  WHEN event_id % 30 = 2 THEN '123456789012' || lpad(string(event_id), 9, '0')
  WHEN event_id % 6 = 2 THEN string(user_id % 2 = 0)
  WHEN event_id % 30 = 3 THEN '[[' || user_id || ',"e"],{"k":' || event_id || '}]'
  WHEN event_id % 6 = 3 THEN '[' || user_id || ',' || event_id || ']'
  WHEN event_id % 6 = 4 THEN user_id || 'e2'
  ELSE string(value) END"""

_TYPED_VALUE = """CASE WHEN event_id % 19 = 0 THEN '"abc"' WHEN event_id % 23 = 0 THEN '"NaN"' ELSE string(value) END"""

_CONTROL_TYPE = f"""CASE WHEN event_id % 53 = 0 THEN '{fixed.TYPE_SUBSCRIPTION_STATUS}'
  WHEN event_id % 59 = 0 THEN '{fixed.TYPE_EVENT_SUBSCRIPTION_STATUS}'
  WHEN event_type = 'error' THEN '{fixed.TYPE_EVENT}' END"""

_BRANCHES = "array('Modbus', 'Server', 'BacNet', 'Plant', 'redundancy group')"


def read(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/events.parquet")


def _with_raw_value(json: str, raw: str) -> str:
    """The message with a value put in as it is, which ``to_json`` would quote; none if NULL."""
    return f"""CASE WHEN {raw} IS NULL THEN {json}
      ELSE left({json}, length({json}) - 1) || ',"value":' || {raw} || '}}' END"""


def _envelope(rows: DataFrame, key: str, payload: str, topic: str = f"'{fixed.TOPIC_VALUES}'") -> DataFrame:
    return rows.selectExpr(
        f"CAST({key} AS BINARY) AS key",
        f"CAST({payload} AS BINARY) AS value",
        f"{topic} AS topic",
        "CAST(user_id % 6 AS INT) AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "0 AS timestampType",
        "array(struct('source' AS key, CAST(event_type AS BINARY) AS value)) AS headers",
    )


def readings(events: DataFrame, mixed_values: bool = False) -> DataFrame:
    """Reading and bad-value messages in the envelope of the bus, one per event."""
    rows = events.selectExpr("*", f"{_TAG} AS tag")
    if mixed_values:
        rows = rows.selectExpr("*", f"to_json(struct({_READING})) AS json", f"{_MIXED_VALUE} AS raw")
        text = _with_raw_value("json", "raw")
    else:
        text = f"to_json(struct({_READING}, IF(event_id % 97 = 0, NULL, value) AS value))"
    return _envelope(rows, _NODE_ID, f"CASE WHEN event_id % 101 = 0 THEN '{{bad' ELSE {text} END")


def controls(events: DataFrame) -> DataFrame:
    """Status and event messages: subscription status, event subscription status, server events."""
    rows = events.selectExpr("*", f"{_CONTROL_TYPE} AS type").where("type IS NOT NULL")
    message = f"""struct({_INGEST} AS timestamp, type,
      CASE WHEN type = '{fixed.TYPE_EVENT}' THEN NULL WHEN event_id % 6 = 0 THEN 'BadNoCommunication'
        WHEN event_id % 6 = 1 THEN 'BadNoCommunication (0x80310000)' WHEN event_id % 6 = 2 THEN 'Bad (timeout after 5000 ms)'
        WHEN event_id % 6 = 3 THEN 'StatusCode(value=2150694912)' WHEN event_id % 6 = 4 THEN 'code 0x00000000 after 300 ms'
        ELSE 'Good' END AS status,
      IF(type = '{fixed.TYPE_EVENT}', props, NULL) AS event,
      '{fixed.DEFAULT_EQUIPMENT}' AS equipment_name, '{fixed.DEFAULT_LINE}' AS production_line)"""
    topic = f"IF(type = '{fixed.TYPE_SUBSCRIPTION_STATUS}', '{fixed.TOPIC_VALUES}', '{fixed.TOPIC_EVENTS}')"
    return _envelope(rows, "CAST(NULL AS STRING)", f"to_json({message})", topic)


def typed(events: DataFrame) -> DataFrame:
    """Messages of the typed camelCase contract; some values are text, some not finite."""
    rows = events.selectExpr(
        "*",
        f"""to_json(struct('ns=2;s=' || event_type AS nodeId, IF(event_id % 29 = 0, NULL, event_type) AS displayName,
          {_SOURCE} AS timestamp)) AS json""",
        f"{_TYPED_VALUE} AS raw",
    )
    payload = f"CASE WHEN event_id % 101 = 0 THEN '{{bad' ELSE {_with_raw_value('json', 'raw')} END"
    return _envelope(rows, "'ns=2;s=' || event_type", payload)


def catalogue(events: DataFrame) -> DataFrame:
    """The device's tags as they occur, one of them unnamed, and three nodes that never report."""
    seen = events.selectExpr(f"{_TAG} AS tag").distinct().where("tag <> 'Comp_Freq'")
    rows = seen.selectExpr(
        f"{_NODE_ID} AS node_id",
        "tag AS display_name",
        "'Variable' AS node_class",
        "array('Objects', 'Modbus', 'PLC', tag) AS path",
    )
    silent = events.sparkSession.sql(
        f"""SELECT * FROM VALUES
        ('{fixed.NODE_ID_PREFIX}Comp_Oil_run_time', 'Comp_Oil_run_time', 'Variable',
          array('Objects', 'Modbus', 'PLC', 'Comp_Oil_run_time')),
        ('ns=2;s=PLC_S7_200_SMART', 'PLC_S7_200_SMART', 'Object', array('Objects', 'Modbus', 'PLC')),
        ('ns=0;i=2259', 'State', 'Variable', array('Objects', 'Server', 'ServerStatus', 'State'))
        AS silent(node_id, display_name, node_class, path)"""
    )
    return rows.unionByName(silent)


#: Node id of a user and event type in the wider catalogue.
SPACE_NODE_ID = """CASE WHEN user_id % 11 = 5 THEN 'i=' || user_id || '.' || event_type
  ELSE 'ns=' || user_id % 4 || ';s=U' || user_id || '.' || event_type END"""


def address_space(events: DataFrame) -> DataFrame:
    """A wider catalogue: one node for each user and event type, spread over branches, classes,
    namespaces and depths."""
    name = "IF(user_id % 10 = 3, 'inputarguments ' || user_id, event_type || ' ' || user_id)"
    return events.select("user_id", "event_type").distinct().selectExpr(
        f"{SPACE_NODE_ID} AS node_id",
        f"{name} AS display_name",
        "IF(user_id % 9 = 4, 'Object', 'Variable') AS node_class",
        f"""IF(user_id % 19 = 7, NULL, concat(array('Objects', element_at({_BRANCHES}, CAST(user_id % 5 + 1 AS INT))),
          array_repeat('Cell', CAST(user_id % 13 AS INT)),
          IF(user_id % 17 = 3, array(CAST(NULL AS STRING)), CAST(array() AS ARRAY<STRING>)),
          IF(event_type = 'error', array('Diagnostics'), CAST(array() AS ARRAY<STRING>)), array({name}))) AS path""",
    )


_DEVICE = "'ns=2;s=D' || user_id"


def tree_nodes(events: DataFrame) -> DataFrame:
    """Nodes of a server, without their paths: the root, a device for each user, a variable for each of its
    event types. Some devices have no name, some a name that excludes them, some are variables."""
    users, pairs = events.select("user_id").distinct(), events.select("user_id", "event_type").distinct()
    devices = users.selectExpr(
        f"{_DEVICE} AS node_id",
        "CASE WHEN user_id % 29 = 11 THEN NULL WHEN user_id % 13 = 5 THEN 'server room ' || user_id ELSE 'Device ' || user_id END AS display_name",
        "IF(user_id % 23 = 9, 'Variable', 'Object') AS node_class")
    variables = pairs.selectExpr(f"{_DEVICE} || '.' || event_type AS node_id", "event_type AS display_name", "'Variable' AS node_class")
    root = events.sparkSession.sql("SELECT 'i=85' AS node_id, 'Objects' AS display_name, 'Object' AS node_class")
    return root.unionByName(devices).unionByName(variables)


def tree_links(events: DataFrame) -> DataFrame:
    """Links between these nodes: devices form a tree below the root; some have a second parent, some lead back
    to one above or to themselves, and some have no parent at all. Some parents are not listed."""
    users, pairs = events.select("user_id").distinct(), events.select("user_id", "event_type").distinct()
    device = lambda user: f"'ns=2;s=D' || CAST({user} AS BIGINT)"
    link = lambda rows, parent, child, when="true": rows.where(when).selectExpr(f"{parent} AS parent_id", f"{child} AS child_id")
    return (
        link(users, "'i=85'", _DEVICE, "user_id = 0")
        .unionByName(link(users, device("(user_id - 1) div 2"), _DEVICE, "user_id > 0 AND user_id % 19 <> 7"))
        .unionByName(link(users, device("user_id div 3"), _DEVICE, "user_id % 7 = 3"))
        .unionByName(link(users, _DEVICE, device("user_id div 4"), "user_id % 17 = 4"))
        .unionByName(link(users, _DEVICE, _DEVICE, "user_id % 31 = 8"))
        .unionByName(link(users, device("user_id + 1000000"), _DEVICE, "user_id % 37 = 6"))
        .unionByName(link(pairs, _DEVICE, f"{_DEVICE} || '.' || event_type"))
    )
