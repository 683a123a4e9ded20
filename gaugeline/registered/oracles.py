"""For each registered query the SQL that gives the same rows from the given tables.

The SQL works on the columns of ``events`` by the rules of the message adapter; it never sees JSON.
"""

from __future__ import annotations

_PREFIX = "ns=2;s=PLC_S7_200_SMART.Compressor."
_AS_OF = "TIMESTAMP '2024-01-25 00:00:00'"

# What a message carries, before the payload of every 101st is broken.
_SENT = f"""
sent AS (
  SELECT event_id, ts, user_id, event_type, value, props,
    event_id % 101 = 0 AS broken,
    CASE event_type WHEN 'click' THEN 'Comp_Pressure' WHEN 'view' THEN 'Comp_Motor_Current_ A'
      WHEN 'purchase' THEN 'Comp_Motor_Speed' WHEN 'signup' THEN 'Comp_Freq'
      WHEN 'error' THEN 'Diagnostics.LastError' END AS sent_tag,
    strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%f') AS sent_ingest
  FROM events
)"""

# Parsed fields: NULL where the payload is broken.
_MSG = f"""
{_SENT},
msg AS (
  SELECT event_id, broken,
    CASE WHEN NOT broken THEN '{_PREFIX}' || sent_tag END AS node_id,
    CASE WHEN NOT broken AND event_id % 97 <> 0 THEN sent_tag END AS display_name,
    CASE WHEN NOT broken AND event_id % 11 <> 0 THEN 'Compressor-' || (user_id % 3) END AS equipment_name,
    CASE WHEN NOT broken AND event_id % 7 <> 0 THEN 'Line-' || (user_id % 2) END AS production_line,
    CASE WHEN NOT broken AND event_id % 97 <> 0 THEN CAST(value AS VARCHAR) END AS value,
    CASE WHEN NOT broken AND event_id % 97 <> 0 THEN value END AS number,
    CASE WHEN broken THEN NULL WHEN event_id % 97 = 0 THEN 2150891520
      WHEN event_id % 31 = 0 THEN 1083179008 ELSE 0 END AS code,
    CASE WHEN broken OR event_id % 17 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'Bad'
      WHEN event_id % 31 = 0 THEN 'Uncertain' ELSE 'Good' END AS quality,
    CASE WHEN NOT broken AND event_id % 97 = 0 THEN 'opcua_bad_value' END AS type,
    CASE WHEN NOT broken AND event_id % 13 <> 0 THEN ts END AS source_time,
    CASE WHEN NOT broken THEN ts + INTERVAL 1 SECOND END AS ingest_time,
    CASE WHEN NOT broken AND event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS source_timestamp,
    CASE WHEN NOT broken THEN sent_ingest END AS timestamp,
    CASE WHEN broken THEN 'unparsable' WHEN event_id % 97 = 0 THEN 'bad_value' ELSE 'reading' END AS message_class,
    event_type, user_id, ts
  FROM sent
)"""

# Status and event messages, made from some of the events.
_CONTROL = f"""
control AS (
  SELECT event_id, props,
    CASE WHEN event_id % 53 = 0 THEN 'opcua_subscription_status'
      WHEN event_id % 59 = 0 THEN 'opcua_event_subscription_status' ELSE 'opcua_event' END AS type,
    CASE event_id % 6 WHEN 0 THEN 'BadNoCommunication' WHEN 1 THEN 'BadNoCommunication (0x80310000)'
      WHEN 2 THEN 'Bad (timeout after 5000 ms)' WHEN 3 THEN 'StatusCode(value=2150694912)'
      WHEN 4 THEN 'code 0x00000000 after 300 ms' ELSE 'Good' END AS code_name,
    strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    CASE WHEN event_id % 53 = 0 THEN 'OPCUA' ELSE 'OPCUA_EVENTS' END AS topic
  FROM events
  WHERE event_id % 53 = 0 OR event_id % 59 = 0 OR event_type = 'error'
)"""

# Value text of the messages with values of all kinds, the JSON type it came as, and what it is read as.
_MIXED = f"""
{_MSG},
shaped AS (
  SELECT *, CAST(number AS VARCHAR) AS number_text,
    CASE WHEN broken OR event_id % 97 = 0 THEN NULL
      WHEN event_id % 12 = 1 THEN 'digits' WHEN event_id % 60 = 7 THEN 'truth'
      WHEN event_id % 6 = 0 THEN 'integer' WHEN event_id % 6 = 1 THEN 'text'
      WHEN event_id % 30 = 2 THEN 'long' WHEN event_id % 6 = 2 THEN 'boolean'
      WHEN event_id % 30 = 3 THEN 'nested' WHEN event_id % 6 = 3 THEN 'list'
      WHEN event_id % 6 = 4 THEN 'hundreds' ELSE 'number' END AS shape
  FROM msg
),
mixed AS (
  SELECT event_id, node_id, broken, user_id, shape,
    CASE shape WHEN 'digits' THEN CAST(event_id AS VARCHAR) WHEN 'truth' THEN 'true' WHEN 'integer' THEN CAST(event_id AS VARCHAR)
      WHEN 'text' THEN event_type WHEN 'long' THEN '123456789012' || lpad(CAST(event_id AS VARCHAR), 9, '0')
      WHEN 'boolean' THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
      WHEN 'nested' THEN '[[' || user_id || ',"e"],{{"k":' || event_id || '}}]' WHEN 'list' THEN '[' || user_id || ',' || event_id || ']'
      WHEN 'hundreds' THEN CAST(user_id * 100.0::DOUBLE AS VARCHAR) WHEN 'number' THEN number_text END AS raw,
    CASE WHEN shape IN ('digits', 'truth', 'text') THEN 'string' WHEN shape IN ('nested', 'list') THEN 'array'
      WHEN shape = 'boolean' THEN 'boolean' WHEN shape IS NOT NULL THEN 'number' END AS json_type,
    CASE WHEN shape = 'integer' THEN 'integer' WHEN shape IN ('long', 'hundreds', 'number') THEN 'float'
      WHEN shape IS NOT NULL THEN 'string' END AS kind,
    CASE WHEN shape IN ('digits', 'integer') THEN CAST(event_id AS DOUBLE)
      WHEN shape = 'long' THEN CAST('123456789012' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS DOUBLE)
      WHEN shape = 'hundreds' THEN user_id * 100.0::DOUBLE WHEN shape = 'number' THEN number END AS number
  FROM shaped
)"""

_SECOND_TAG = "CASE sent_tag WHEN 'Diagnostics.LastError' THEN 'LastError' ELSE replace(sent_tag, ' ', '') END"

# Rows of the hierarchy table before any choice of nodes.
_PLACED = f"""
{_MSG},
placed AS (
  SELECT event_id, 'Acme' AS "Enterprise", 'North' AS "Site",
    coalesce(production_line, 'Line-1') AS "ProductionLine",
    coalesce(equipment_name, 'Compressor') AS "Equipment",
    CASE event_type WHEN 'view' THEN 'Comp_Motor_Current_A' WHEN 'error' THEN 'Diagnostics_LastError'
      ELSE substr(node_id, {len(_PREFIX) + 1}) END AS "Tag",
    value AS "RawData", CAST(code AS VARCHAR) AS "StatusCode",
    CASE WHEN coalesce(source_time, ingest_time) <= {_AS_OF} + INTERVAL 600 SECOND
      THEN coalesce(source_time, ingest_time) ELSE {_AS_OF} END AS "EventTime",
    node_id AS "NodeId", number AS "ValueDouble", message_class, event_type
  FROM msg
  WHERE NOT broken
),
history AS (
  SELECT event_id, "Enterprise", "Site", "ProductionLine", "Equipment", "Tag", "RawData", "StatusCode",
    "EventTime", CAST(CAST("EventTime" AS DATE) AS VARCHAR) AS "EventDate", "NodeId", "ValueDouble",
    message_class, event_type
  FROM placed
)"""

_NINE = '"Enterprise", "Site", "ProductionLine", "Equipment", "Tag", "RawData", "StatusCode", "EventTime", "EventDate"'
_ALL = f'event_id, {_NINE}, "NodeId", "ValueDouble"'
_LISTED = "event_type <> 'error'"

_FLAT = f"""
{_MSG},
flat AS (
  SELECT event_id, node_id AS "nodeId", display_name AS "displayName", value, timestamp,
    source_timestamp AS "sourceTimestamp", quality, ingest_time AS "eventTime", number AS "valueDouble"
  FROM msg
)"""

_START, _END = "TIMESTAMP '2024-01-05 00:00:00'", "TIMESTAMP '2024-01-12 12:00:00'"
_OLDEST = '"eventTime" ASC NULLS LAST, event_id ASC'

# The catalogue of the device's tags, and the wider one.
_CATALOGUE = f"""
listed AS (
  SELECT DISTINCT '{_PREFIX}' || sent_tag AS node_id, sent_tag AS display_name
  FROM sent WHERE sent_tag <> 'Comp_Freq'
  UNION ALL
  SELECT '{_PREFIX}Comp_Oil_run_time', 'Comp_Oil_run_time'
  UNION ALL
  SELECT 'ns=0;i=2259', 'State'
)"""

_SPACE = """
pairs AS (SELECT DISTINCT user_id, event_type FROM events),
space AS (
  SELECT user_id, event_type,
    CASE WHEN user_id % 11 = 5 THEN 'i=' || user_id || '.' || event_type
      ELSE 'ns=' || (user_id % 4) || ';s=U' || user_id || '.' || event_type END AS node_id,
    CASE WHEN user_id % 10 = 3 THEN 'inputarguments ' || user_id
      ELSE event_type || ' ' || user_id END AS display_name,
    CASE WHEN user_id % 9 = 4 THEN 'Object' ELSE 'Variable' END AS node_class,
    CASE user_id % 5 WHEN 0 THEN 'Modbus' WHEN 1 THEN 'Server' WHEN 2 THEN 'BacNet'
      WHEN 3 THEN 'Plant' ELSE 'redundancy group' END AS branch
  FROM pairs
),
nodes AS (
  SELECT node_id, display_name, node_class,
    CASE WHEN user_id % 19 <> 7 THEN 'Objects/' || branch || repeat('/Cell', CAST(user_id % 13 AS INTEGER))
      || CASE WHEN event_type = 'error' THEN '/Diagnostics' ELSE '' END || '/' || display_name END AS path,
    user_id, event_type, branch,
    3 + user_id % 13 + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END + CASE WHEN user_id % 17 = 3 THEN 1 ELSE 0 END AS steps
  FROM space
)"""
_NODE = "node_id, display_name, node_class, path"

# The tree of nodes and links; {words} tells which names are left out, {leaf} which classes are not walked
# through, {levels} how deep the walk goes.
_TREE = """
users AS (SELECT DISTINCT user_id AS u FROM events),
variables AS (SELECT DISTINCT user_id AS u, event_type FROM events),
tree_nodes AS (
  SELECT 'i=85' AS node_id, 'Objects' AS display_name, 'Object' AS node_class
  UNION ALL
  SELECT 'ns=2;s=D' || u, CASE WHEN u % 29 = 11 THEN NULL WHEN u % 13 = 5 THEN 'server room ' || u ELSE 'Device ' || u END,
    CASE WHEN u % 23 = 9 THEN 'Variable' ELSE 'Object' END FROM users
  UNION ALL
  SELECT 'ns=2;s=D' || u || '.' || event_type, event_type, 'Variable' FROM variables
),
tree_links AS (
  SELECT 'i=85' AS parent_id, 'ns=2;s=D0' AS child_id FROM users WHERE u = 0
  UNION SELECT 'ns=2;s=D' || ((u - 1) // 2), 'ns=2;s=D' || u FROM users WHERE u > 0 AND u % 19 <> 7
  UNION SELECT 'ns=2;s=D' || (u // 3), 'ns=2;s=D' || u FROM users WHERE u % 7 = 3
  UNION SELECT 'ns=2;s=D' || u, 'ns=2;s=D' || (u // 4) FROM users WHERE u % 17 = 4
  UNION SELECT 'ns=2;s=D' || u, 'ns=2;s=D' || u FROM users WHERE u % 31 = 8
  UNION SELECT 'ns=2;s=D' || u, 'ns=2;s=D' || u || '.' || event_type FROM variables
),
open_nodes AS (SELECT * FROM tree_nodes WHERE NOT coalesce({words}, false)),
walk AS (
  SELECT node_id, node_class, 0 AS depth FROM open_nodes WHERE node_id = 'i=85'
  UNION
  SELECT n.node_id, n.node_class, w.depth + 1
  FROM walk w JOIN tree_links l ON l.parent_id = w.node_id JOIN open_nodes n ON n.node_id = l.child_id
  WHERE w.depth < {levels} AND NOT {leaf}
),
least AS (SELECT node_id, min(depth) AS depth FROM walk GROUP BY node_id),
placed AS (
  SELECT n.*, x.depth, (
    SELECT min(l.parent_id) FROM tree_links l JOIN least p ON p.node_id = l.parent_id JOIN open_nodes w ON w.node_id = l.parent_id
    WHERE l.child_id = n.node_id AND p.depth = x.depth - 1 AND NOT {leaf}) AS parent_id
  FROM least x JOIN open_nodes n ON n.node_id = x.node_id
),
named AS (
  SELECT node_id, display_name AS path FROM placed WHERE depth = 0
  UNION
  SELECT p.node_id, concat_ws('/', a.path, p.display_name) FROM named a JOIN placed p ON p.parent_id = a.node_id
)"""


def _tree(words: str, leaf: str, levels: int) -> str:
    return "WITH RECURSIVE " + _TREE.format(words=words, leaf=leaf, levels=levels)


_INFRASTRUCTURE = "regexp_matches(lower(display_name), 'server|diagnostics|security|aggregatefunctions|namespaces|bacnet|dnp3|redundancy')"
_BROWSED = """
SELECT p.node_id, display_name, node_class, parent_id, path, CAST(depth AS INTEGER) AS depth
FROM placed p JOIN named n ON n.node_id = p.node_id"""

_PLACE = '"Enterprise", "Site", "ProductionLine", "Equipment", "Tag"'
_LATEST = f"""
SELECT event_id, {_NINE} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_PLACE} ORDER BY "EventTime" DESC, event_id DESC) AS rn
  FROM history WHERE message_class = 'reading' AND {_LISTED}
) WHERE rn = 1"""


def _first(n: int, columns: str) -> str:
    return f"""WITH {_PLACED}
SELECT event_id, {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_PLACE} ORDER BY "EventTime" ASC, event_id ASC) AS rn
  FROM history WHERE message_class = 'reading' AND {_LISTED}
) WHERE rn <= {n}"""


_HISTORY_ROWS = f"WITH {_PLACED} SELECT {_ALL} FROM history WHERE message_class = 'reading' AND {_LISTED}"
_TYPED_COLUMNS = """event_id, node_id, raw AS "RawData", kind,
  CASE WHEN kind = 'integer' THEN CAST(event_id AS VARCHAR) END AS value_integer,
  CASE WHEN kind = 'float' THEN number END AS value_float,
  CASE WHEN kind = 'string' THEN raw END AS value_string"""

ORACLES: dict[str, str] = {
    "parse_flat": f"""WITH {_FLAT}
SELECT event_id, "nodeId", "displayName", value, timestamp, "sourceTimestamp", quality FROM flat""",
    "parse_flat_plain": f"""WITH {_FLAT}
SELECT event_id, "nodeId", "displayName", value, timestamp, "sourceTimestamp" FROM flat WHERE "nodeId" IS NOT NULL""",
    "parse_typed": """
SELECT event_id,
  CASE WHEN event_id % 101 <> 0 THEN 'ns=2;s=' || event_type END AS "nodeId",
  CASE WHEN event_id % 101 <> 0 AND event_id % 29 <> 0 THEN event_type END AS "displayName",
  CASE WHEN event_id % 101 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 THEN value END AS value,
  CASE WHEN event_id % 101 <> 0 THEN ts END AS timestamp
FROM events""",
    "parse_messages": f"""WITH {_MIXED}
SELECT m.event_id, m.node_id, display_name, timestamp, equipment_name, production_line, raw AS value,
  CAST(code AS VARCHAR) AS status_code, quality, source_timestamp, CAST(NULL AS VARCHAR) AS server_timestamp,
  type, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS event, m.broken AS unparsable, message_class
FROM msg m JOIN mixed x ON m.event_id = x.event_id""",
    "numeric_value": f"""WITH {_MIXED} SELECT event_id, raw AS "RawData", number AS value FROM mixed""",
    "normalise_values": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS moment,
  '[' || user_id || ',' || event_id || ']' AS pair, '[' || value || ',null]' AS series,
  '{"user_id":' || user_id || ',"event_type":"' || event_type || '","at":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS detail,
  CASE WHEN event_id % 23 <> 0 THEN value END AS number, event_type
FROM events""",
    "to_records": f"""WITH {_SENT}
SELECT '{{"position":' || event_id || ',"key":"{_PREFIX}' || sent_tag || '","timestamp":"'
  || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","topic":"OPCUA"}}' AS record
FROM sent""",
    "classify_messages": f"""WITH {_MSG}, {_CONTROL}
SELECT 'OPCUA' AS topic, event_id, message_class FROM msg
UNION ALL
SELECT topic, event_id, substr(type, 7) AS message_class FROM control""",
    "bad_values": f"""WITH {_MSG}
SELECT event_id, timestamp, node_id, equipment_name, production_line, CAST(code AS VARCHAR) AS status_code,
  source_timestamp, CAST(NULL AS VARCHAR) AS server_timestamp, TRUE AS bad_status
FROM msg WHERE message_class = 'bad_value'""",
    "connection_health": f"""WITH {_CONTROL}
SELECT event_id, timestamp, type, code_name AS status, 'Compressor' AS equipment_name, 'Line-1' AS production_line,
  event_id % 6 < 4 AS is_bad
FROM control WHERE type <> 'opcua_event'""",
    "event_messages": f"""WITH {_CONTROL}
SELECT event_id, timestamp, props AS event, 'Compressor' AS equipment_name, 'Line-1' AS production_line
FROM control WHERE type = 'opcua_event'""",
    "status_severity": f"""WITH {_MSG}
SELECT event_id, CAST(code AS VARCHAR) AS status_code, CAST(code >> 30 AS VARCHAR) AS severity,
  coalesce(code >> 30 = 2, FALSE) OR value IS NULL AS bad_or_null
FROM msg""",
    "drop_null_ids": f"""WITH {_MSG}
SELECT 'OPCUA' AS topic, event_id, node_id FROM msg WHERE node_id IS NOT NULL""",
    "node_allowlist": f"""WITH {_MSG}
SELECT event_id, node_id, value FROM msg WHERE NOT broken AND {_LISTED}""",
    "allowlist_semi_join": f"""WITH {_MSG}, {_CATALOGUE}
SELECT event_id, node_id, value FROM msg WHERE node_id IN (SELECT node_id FROM listed)""",
    "tag_allowlist": f"""WITH {_MSG}
SELECT event_id, CASE event_type WHEN 'view' THEN 'Comp_Motor_Current_A' ELSE display_name END AS "Tag", value
FROM msg WHERE message_class = 'reading' AND event_type IN ('click', 'view', 'purchase')""",
    "drop_diagnostics": f"""WITH {_MSG}
SELECT 'OPCUA' AS topic, event_id, node_id,
  replace(substr(node_id, {len(_PREFIX) + 1}), ' ', '') AS "Tag"
FROM msg WHERE node_id NOT LIKE '%.Diagnostics.%'""",
    "prefix_probe": f"""WITH {_MSG}
SELECT event_id, node_id, display_name, value FROM msg
WHERE starts_with(node_id, '{_PREFIX}') ORDER BY event_id LIMIT 25""",
    "derive_tag": f"""WITH {_MSG}, cut AS (SELECT event_id, node_id, substr(node_id, {len(_PREFIX) + 1}) AS raw FROM msg)
SELECT event_id, node_id, raw AS raw_tag, replace(raw, ' ', '') AS no_spaces,
  replace(replace(raw, ' ', ''), '.', '_') AS "Tag"
FROM cut""",
    "tag_fallback_chain": f"""WITH {_MSG}, cut AS (
  SELECT event_id, display_name, node_id, substr(node_id, {len(_PREFIX) + 1}) AS raw FROM msg)
SELECT event_id, CAST(NULL AS VARCHAR) AS from_name, raw AS from_id,
  replace(display_name, 'Diagnostics.', '') AS last_of_name, replace(raw, 'Diagnostics.', '') AS last_of_id,
  raw AS raw_tag
FROM cut""",
    "event_time": f"""WITH {_MSG}
SELECT event_id, source_time, ingest_time, ingest_time - INTERVAL 330 MINUTE AS ingest_time_at_offset,
  coalesce(source_time, ingest_time, {_AS_OF}) AS event_time
FROM msg""",
    "future_clamp": f"""WITH {_MSG}, first AS (
  SELECT event_id, coalesce(source_time, ingest_time, {_AS_OF}) AS t FROM msg),
clamped AS (SELECT event_id, CASE WHEN t <= {_AS_OF} + INTERVAL 600 SECOND THEN t ELSE {_AS_OF} END AS t FROM first)
SELECT event_id, t AS "EventTime", CAST(CAST(t AS DATE) AS VARCHAR) AS "EventDate" FROM clamped""",
    "late_flag": f"""WITH {_PLACED}
SELECT event_id, "Tag", "EventTime", "EventTime" < {_AS_OF} - INTERVAL 10 MINUTE AS is_late
FROM history WHERE message_class = 'reading' AND {_LISTED}""",
    "ingest_stamp": """
SELECT event_id, substr(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 1, 23) || 'Z' AS stamp FROM events""",
    "node_id_format": """
SELECT event_id, 'ns=' || (user_id % 4) || ';s=' || event_type || '.' || user_id AS node_id FROM events""",
    "quality_default": f"""WITH {_MSG}
SELECT event_id, quality, coalesce(quality, 'Good') AS quality_or_good FROM msg""",
    "hierarchy_table": _HISTORY_ROWS,
    "hierarchy_with_bad": f"""WITH {_PLACED} SELECT event_id, {_NINE} FROM history WHERE {_LISTED}""",
    "hierarchy_by_tag": f"""WITH {_PLACED} SELECT event_id, {_NINE} FROM history
WHERE message_class = 'reading' AND event_type IN ('click', 'view', 'purchase')""",
    "hierarchy_unfiltered": f"WITH {_PLACED} SELECT {_ALL} FROM history WHERE message_class = 'reading'",
    "hierarchy_other_device": f"""WITH {_PLACED}
SELECT event_id, {_NINE}, replace("NodeId", 'PLC_S7_200_SMART.Compressor', 'OTHER.Dev') AS "NodeId", "ValueDouble"
FROM history WHERE message_class = 'reading' AND {_LISTED}""",
    "stored_hierarchy": _HISTORY_ROWS,
    "source_enrichment": f"""WITH {_MSG}
SELECT event_id, node_id, value, 'Compressor' AS equipment_name, 'Line-1' AS production_line FROM msg""",
    "list_nodes": f"""WITH {_FLAT} SELECT DISTINCT "displayName" FROM flat""",
    "latest_for_node": f"""WITH {_FLAT}
SELECT * FROM flat WHERE "displayName" = 'Comp_Pressure'
ORDER BY "eventTime" DESC NULLS LAST, event_id DESC LIMIT 10""",
    "node_stats": f"""WITH {_FLAT}
SELECT round(avg("valueDouble"), 6) AS avg_value, max("valueDouble") AS max_value, min("valueDouble") AS min_value
FROM flat WHERE "displayName" = 'Comp_Motor_Speed'""",
    "node_stats_absent": f"""WITH {_FLAT}
SELECT avg("valueDouble") AS avg_value, max("valueDouble") AS max_value, min("valueDouble") AS min_value
FROM flat WHERE "displayName" = 'no such node'""",
    "node_stats_all": f"""WITH {_FLAT}
SELECT "displayName", round(avg("valueDouble"), 6) AS avg_value, max("valueDouble") AS max_value,
  min("valueDouble") AS min_value
FROM flat GROUP BY "displayName\"""",
    "query_by_time": f"""WITH {_FLAT}
SELECT * FROM flat WHERE "eventTime" BETWEEN {_START} AND {_END} ORDER BY {_OLDEST} LIMIT 5000""",
    "query_by_time_on_text": f"""WITH {_FLAT}
SELECT event_id, "nodeId", "displayName", value, timestamp, "sourceTimestamp", quality
FROM flat WHERE "eventTime" BETWEEN {_START} AND {_END} ORDER BY {_OLDEST} LIMIT 5000""",
    "filter_readings": f"""WITH {_FLAT}
SELECT * FROM flat WHERE "eventTime" >= {_START} AND quality = 'Good' AND "valueDouble" BETWEEN 0 AND 25.5
ORDER BY {_OLDEST} LIMIT 100""",
    "filter_quality": f"""WITH {_FLAT} SELECT * FROM flat WHERE quality = 'Uncertain'""",
    "filter_quality_null": f"""WITH {_FLAT} SELECT * FROM flat WHERE quality IS NULL""",
    "filter_value_eq": f"""WITH {_FLAT}
SELECT * FROM flat WHERE "valueDouble" = 12.31::DOUBLE ORDER BY {_OLDEST} LIMIT 100""",
    "node_range_filter": f"""WITH {_FLAT}
SELECT * FROM flat WHERE "displayName" = 'Comp_Freq' AND "valueDouble" BETWEEN 5 AND 60
  AND "eventTime" BETWEEN {_START} AND TIMESTAMP '2024-01-28 00:00:00'""",
    "result_count": f"""WITH {_FLAT}
SELECT count(*) AS count FROM flat WHERE quality = 'Good' AND "eventTime" >= {_START}""",
    "latest_any": f"""{_HISTORY_ROWS} ORDER BY "EventTime" DESC NULLS LAST, event_id DESC LIMIT 10""",
    "latest_untimed": f"""WITH {_FLAT} SELECT event_id, "displayName", value FROM flat ORDER BY event_id LIMIT 10""",
    "cached_snapshot": f"""WITH {_FLAT}
SELECT "displayName", max("valueDouble") AS max_value, min("valueDouble") AS min_value, count(*) AS count
FROM flat GROUP BY "displayName\"""",
    "query_path": f"""WITH {_PLACED}
SELECT {_ALL}, "ValueDouble" AS value FROM history
WHERE message_class = 'reading' AND {_LISTED} AND "ProductionLine" = 'Line-1' AND "Equipment" = 'Compressor-1'
  AND "Tag" = 'Comp_Motor_Current_A' AND "ValueDouble" BETWEEN 2 AND 90
  AND "EventTime" BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-24 00:00:00'
ORDER BY "EventTime" DESC NULLS LAST, event_id DESC LIMIT 250""",
    "query_path_by_date": f"""WITH {_PLACED}
SELECT {_ALL}, "ValueDouble" AS value FROM history
WHERE message_class = 'reading' AND {_LISTED} AND "ProductionLine" = 'Line-0' AND "Equipment" = 'Compressor'
  AND "Tag" = 'Comp_Freq'
  AND "EventTime" BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
ORDER BY "EventTime" DESC NULLS LAST, event_id DESC LIMIT 1000""",
    "dump_count": f"""WITH {_PLACED} SELECT count(*) AS count FROM history
WHERE message_class = 'reading' AND {_LISTED}""",
    "dump_rows": f"{_HISTORY_ROWS} ORDER BY event_id LIMIT 10000",
    "tag_list": f"""WITH {_SENT}, {_CATALOGUE}
SELECT node_id, display_name FROM listed UNION ALL SELECT 'ns=2;s=PLC_S7_200_SMART', 'PLC_S7_200_SMART'""",
    "name_lookup_join": f"""WITH {_MSG}, {_CATALOGUE}
SELECT m.event_id, m.node_id, m.value, coalesce(l.display_name, m.node_id) AS display_name
FROM msg m LEFT JOIN listed l ON m.node_id = l.node_id WHERE m.node_id IS NOT NULL""",
    "name_lookup_large": f"""WITH {_SPACE}
SELECT e.event_id, e.value, n.node_id,
  CASE WHEN starts_with(n.display_name, 'view') THEN n.node_id ELSE n.display_name END AS display_name
FROM events e JOIN nodes n ON e.user_id = n.user_id AND e.event_type = n.event_type""",
    "catalogue_coverage": f"""WITH {_MSG}, {_CATALOGUE}
SELECT count(*) AS discovered, count(*) FILTER (WHERE node_id IN (SELECT node_id FROM msg)) AS subscribed FROM listed""",
    "namespace_filter": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes WHERE user_id % 11 = 5 OR user_id % 4 IN (0, 2)""",
    "namespaced_ids": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes WHERE user_id % 11 <> 5""",
    "keyword_filter": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes WHERE user_id % 10 <> 3""",
    "node_class_filter": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes WHERE user_id % 9 <> 4""",
    "tags_to_sample": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes
WHERE user_id % 9 <> 4 AND user_id % 11 <> 5 AND user_id % 10 <> 3""",
    "catalogue_cap": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes ORDER BY node_id LIMIT 40""",
    "subtree_filter": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes
WHERE user_id % 19 = 7 OR (branch IN ('Modbus', 'Plant') AND event_type <> 'error' AND steps <= 11)""",
    "device_variables": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes
WHERE node_class = 'Variable' AND user_id % 19 <> 7 AND user_id % 17 <> 3 AND user_id % 13 > 0""",
    "diagnostics_branch": f"""WITH {_SPACE} SELECT {_NODE} FROM nodes WHERE event_type <> 'error' OR user_id % 19 = 7""",
    "first_n_per_tag": _first(5, f'{_PLACE}, "RawData", "StatusCode", "EventTime"'),
    "first_many_per_tag": _first(1500, f'{_PLACE}, "RawData", "EventTime"'),
    "latest_per_tag": f"WITH {_PLACED} {_LATEST}",
    "typed_values": f"""WITH {_MIXED} SELECT {_TYPED_COLUMNS} FROM mixed""",
    "typed_table": f"""WITH {_MIXED} SELECT {_TYPED_COLUMNS} FROM mixed WHERE kind IS NOT NULL""",
    "kafka_envelope_roundtrip": f"""WITH {_MSG}
SELECT event_id, 'OPCUA' AS topic, node_id AS key, node_id, value, CAST(code AS VARCHAR) AS status_code,
  ingest_time AS moment
FROM msg WHERE node_id IS NOT NULL""",
    "published_payload": f"""WITH {_MIXED}
SELECT m.event_id, CASE WHEN m.broken THEN '{{}}' ELSE '{{"node_id":"' || m.node_id || '"'
  || CASE WHEN raw IS NULL THEN '' WHEN json_type = 'string' THEN ',"value":"' || raw || '"' ELSE ',"value":' || raw END
  || ',"status_code":' || code || '}}' END AS payload
FROM msg m JOIN mixed x ON m.event_id = x.event_id""",
    "topic_fanout": f"""WITH {_MSG}, {_CONTROL}
SELECT event_id, 'OPCUA' AS topic, node_id AS key,
  CASE WHEN broken THEN '{{}}' ELSE '{{"node_id":"' || node_id || '"'
    || CASE WHEN type IS NULL THEN '' ELSE ',"type":"' || type || '"' END || '}}' END AS value
FROM msg
UNION ALL
SELECT event_id, topic, NULL AS key, '{{"type":"' || type || '"'
  || CASE WHEN type = 'opcua_event' THEN ',"event":"' || replace(props, '"', '\\"') || '"'
     ELSE ',"status":"' || code_name || '"' END || '}}' AS value
FROM control""",
    "stream_hierarchy": _HISTORY_ROWS,
    "stream_flat": f"""WITH {_FLAT}
SELECT event_id, "nodeId", "displayName", value, timestamp, "sourceTimestamp" FROM flat WHERE "nodeId" IS NOT NULL""",
    "stream_resume": f"""WITH {_PLACED} SELECT event_id, {_NINE} FROM history
WHERE message_class = 'reading' AND {_LISTED}""",
    "stream_side_outputs": f"""WITH {_PLACED}, {_CONTROL}
SELECT 'readings' AS table_name, {_ALL} FROM history WHERE message_class = 'reading'
UNION ALL BY NAME SELECT 'bad_values' AS table_name, event_id, timestamp, node_id, equipment_name, production_line,
  CAST(code AS VARCHAR) AS status_code, source_timestamp, CAST(NULL AS VARCHAR) AS server_timestamp, TRUE AS bad_status
FROM msg WHERE message_class = 'bad_value'
UNION ALL BY NAME SELECT 'connection_health' AS table_name, event_id, timestamp, type, code_name AS status,
  'Compressor' AS equipment_name, 'Line-1' AS production_line, event_id % 6 < 4 AS is_bad
FROM control WHERE type <> 'opcua_event'
UNION ALL BY NAME SELECT 'events' AS table_name, event_id, timestamp, props AS event, 'Compressor' AS equipment_name,
  'Line-1' AS production_line FROM control WHERE type = 'opcua_event'
UNION ALL BY NAME SELECT 'dead_letters' AS table_name, event_id, message_class, '{{bad' AS payload FROM msg WHERE broken""",
    "stream_name_lookup": f"""WITH {_MSG}, {_CATALOGUE}
SELECT m.event_id, m.node_id, m.value, coalesce(l.display_name, m.node_id) AS display_name
FROM msg m LEFT JOIN listed l ON m.node_id = l.node_id WHERE m.node_id IS NOT NULL""",
    "stream_job": f"""WITH {_PLACED}, timed AS (
  SELECT h.* EXCLUDE ("EventTime", "EventDate"), coalesce(source_time, ingest_time - INTERVAL 330 MINUTE) AS t
  FROM history h JOIN msg m ON h.event_id = m.event_id
), clamped AS (
  SELECT * EXCLUDE (t), CASE WHEN t <= {_AS_OF} + INTERVAL 86400 SECOND THEN t ELSE {_AS_OF} END AS "EventTime" FROM timed
), dated AS (SELECT *, CAST(CAST("EventTime" AS DATE) AS VARCHAR) AS "EventDate" FROM clamped)
SELECT {_ALL} FROM dated WHERE message_class = 'reading' AND {_LISTED}""",
    "stream_schema_evolution": f"""WITH {_FLAT}
SELECT event_id, "nodeId", "displayName", value, timestamp, "sourceTimestamp",
  CASE WHEN event_id % 2 = 1 THEN quality END AS quality
FROM flat WHERE event_id % 2 = 1 OR "nodeId" IS NOT NULL""",
    "stream_latest_upsert": f"WITH {_PLACED} {_LATEST}",
    "compacted_history": _HISTORY_ROWS,
    "browse_tree": _tree(_INFRASTRUCTURE, "coalesce(w.node_class = 'Variable', false)", 10) + _BROWSED,
    "browse_tree_whole": _tree("false", "false", 4) + _BROWSED,
    "browse_unreached": _tree(_INFRASTRUCTURE, "coalesce(w.node_class = 'Variable', false)", 40) + """
SELECT * FROM tree_nodes WHERE node_id NOT IN (SELECT node_id FROM least)""",
    "stream_deduplicated": f"""WITH {_MSG}
SELECT event_id, node_id, value, source_timestamp, message_class FROM msg""",
    "stream_window_stats": f"""WITH {_PLACED},
timed AS (
  SELECT p.*, coalesce(m.source_time, m.ingest_time) AS sent FROM history p JOIN msg m ON m.event_id = p.event_id
  WHERE p.message_class = 'reading' AND p.event_type <> 'error'
),
binned AS (SELECT *, time_bucket(INTERVAL 6 HOUR, sent, TIMESTAMP '2024-01-01') AS window_start FROM timed)
SELECT {_PLACE}, window_start, window_start + INTERVAL 6 HOUR AS window_end, count(*) AS n, count("ValueDouble") AS n_values,
  round(avg("ValueDouble"), 6) AS avg_value, max("ValueDouble") AS max_value, min("ValueDouble") AS min_value
FROM binned GROUP BY ALL
HAVING window_start + INTERVAL 6 HOUR <= (SELECT max(coalesce(source_time, ingest_time, ts)) FROM msg) - INTERVAL 20 DAY""",
    "stream_balanced": _HISTORY_ROWS,
    "value_types": f"""WITH {_MIXED} SELECT event_id, raw AS value, json_type AS value_type FROM mixed""",
    "value_parts": f"""WITH {_MIXED}
SELECT event_id, CASE WHEN shape = 'list' THEN user_id END AS first, CASE WHEN shape = 'list' THEN event_id END AS second,
  CASE WHEN shape = 'nested' THEN user_id END AS inner_first, CASE WHEN shape = 'nested' THEN event_id END AS inner_key,
  CASE WHEN shape = 'long' THEN raw WHEN shape IN ('integer', 'digits') THEN CAST(event_id AS VARCHAR) END AS whole
FROM mixed WHERE NOT broken AND shape IS NOT NULL""",
    "node_days_rolled_up": f"""WITH {_FLAT}
SELECT "displayName", CAST(CAST("eventTime" AS DATE) AS VARCHAR) AS "eventDate", count(*) AS n, count("valueDouble") AS n_values,
  round(sum("valueDouble"), 4) AS sum_value, min("valueDouble") AS min_value, max("valueDouble") AS max_value,
  min("eventTime") AS first_time, max("eventTime") AS last_time
FROM flat GROUP BY ALL""",
    "compacted_by_curve": _HISTORY_ROWS,
    "stream_type_widening": """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN CAST(event_id * 10000000000 AS VARCHAR)
  WHEN 2 THEN CAST(value AS VARCHAR) ELSE 'v' || event_id END AS reading
FROM events""",
    "stream_checked": f"""WITH {_PLACED}
SELECT {_ALL}, concat_ws(',', CASE WHEN "ValueDouble" IS NULL THEN 'has a number' END, CASE WHEN "StatusCode" <> '0' THEN 'status is good' END)
  AS failed_expectations
FROM history WHERE message_class = 'reading' AND {_LISTED}""",
}
ORACLES["latest_for_node_counted"] = ORACLES["latest_for_node"]
ORACLES["node_stats_rolled_up"] = ORACLES["node_stats_all"]
