"""Hand-written rows for what messages get wrong."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions import numbers, status, tags, times
from gaugeline.operators import filtering, hierarchy, parsing, routing
from gaugeline.operators.hierarchy import Plant
from gaugeline.plans import history

AS_OF = "2025-12-20T00:00:00"
PREFIX = fixed.NODE_ID_PREFIX


def column(spark, values, build, kind="string"):
    """Results of a column function, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("x")).alias("y")).collect()]


def parsed(spark, payloads):
    rows = spark.createDataFrame(list(enumerate(payloads)), "offset int, value string")
    envelope = rows.withColumn("value", F.col("value").cast("binary"))
    return history.messages(envelope, ("offset",)).orderBy("offset")


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def moments(spark, values, build):
    """Like :func:`column` for functions that give a time, as UTC."""
    found = column(spark, values, lambda x: F.unix_micros(build(x)))
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return [None if m is None else epoch + dt.timedelta(microseconds=m) for m in found]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ("{bad", "unparsable"),
        ("[]", "unparsable"),
        ("5", "unparsable"),
        ("", "unparsable"),
        (None, "unparsable"),
        ("{}", "unknown"),
        ('{"value": 3}', "unknown"),
        ('{"node_id": "a", "value": 1, "status_code": 0}', "reading"),
        ('{"node_id": "a", "value": 1}', "reading"),
        ('{"node_id": "a", "value": null, "status_code": 0}', "bad_value"),
        ('{"node_id": "a", "value": 1, "status_code": 2150891520}', "bad_value"),
        ('{"node_id": "a", "value": 1, "status_code": 1083179008}', "reading"),
        ('{"node_id": "a", "value": 1, "type": "opcua_bad_value"}', "bad_value"),
        ('{"type": "opcua_subscription_status", "status": "Good"}', "subscription_status"),
        ('{"type": "opcua_event", "event": "e"}', "event"),
        ('{"type": "opcua_event_subscription_status", "status": "Good"}', "event_subscription_status"),
        ('{"nodeId": "a", "value": 1}', "reading"),
    ],
)
def test_message_class(spark, payload, expected):
    assert parsed(spark, [payload]).first()["message_class"] == expected


def test_values_as_text(spark):
    raw = ["12.50", "1e3", "true", "[1,2]", "null", '"s"', "123456789012345678901", '{"a":1}']
    rows = parsed(spark, [f'{{"node_id":"a","value":{v}}}' for v in raw]).collect()
    assert [r["value"] for r in rows] == [
        "12.5", "1000.0", "true", "[1,2]", None, "s", "123456789012345678901", '{"a":1}'
    ]


def test_non_finite_value_keeps_the_record(spark):
    rows = parsed(spark, ['{"node_id":" a ","value":NaN}', '{"node_id":"b","value":Infinity}'])
    found = parsing.with_numeric_value(rows, "value", "number").orderBy("offset").collect()
    assert [(r["node_id"], r["number"]) for r in found] == [("a", None), ("b", None)]


def test_numeric_value(spark):
    cases = {
        "12": 12.0, " 12 ": 12.0, "-1.5e-3": -0.0015, ".5": 0.5, "5.": 5.0, "+7": 7.0,
        "12d": None, "12f": None, "NaN": None, "Infinity": None, "true": None, "abc": None, "": None,
        "1e999": None, None: None, "0x10": None, "1_000": None,
    }
    assert column(spark, list(cases), numbers.numeric_value) == list(cases.values())


def test_largest_number_is_not_the_largest_text(spark):
    rows = spark.createDataFrame([("9",), ("10",), ("100.5",), ("NaN",), (None,)], "value string")
    number = numbers.numeric_value("value")
    assert tuple(rows.agg(F.max(number), F.min(number)).first()) == (100.5, 9.0)


def test_value_kind(spark):
    cases = {
        "12": "integer", "-3": "integer", "12.0": "float", "1e3": "float", "99999999999999999999": "float",
        "true": "string", "abc": "string", "": "string", None: None, "NaN": "string",
    }
    assert column(spark, list(cases), numbers.value_kind) == list(cases.values())


def test_iso_times(spark):
    cases = {
        "2025-12-12T10:00:00+05:30": utc("2025-12-12T04:30:00"),
        "2025-12-12T10:00:00.123456": utc("2025-12-12T10:00:00.123456"),
        "2025-12-12T10:00:00.123Z": utc("2025-12-12T10:00:00.123"),
        "2025-12-12T10:00:00": utc("2025-12-12T10:00:00"),
        "junk": None, "2025": None, "10:00:00": None, "2025-12-12": None, "": None, None: None,
        "2025-13-01T00:00:00Z": None, "2025-12-12 10:00:00": None,
    }
    assert moments(spark, list(cases), times.parse_iso) == list(cases.values())


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        found = moments(spark, ["2025-12-12T10:00:00", "2025-12-12T10:00:00Z"], times.parse_iso)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [utc("2025-12-12T10:00:00")] * 2


def test_default_offset(spark):
    found = moments(spark, ["2025-12-12T10:00:00"], lambda x: times.parse_iso(x, "+05:30"))
    assert found == [utc("2025-12-12T04:30:00")]


@pytest.mark.parametrize(
    "source, ingest, expected",
    [
        ("2025-12-12T10:00:00Z", "2025-12-12T10:00:01", "2025-12-12T10:00:00"),
        ("junk", "2025-12-12T10:00:01", "2025-12-12T10:00:01"),
        (None, "junk", "2025-12-20T00:00:00"),
        ("2025-12-20T00:10:00Z", None, "2025-12-20T00:10:00"),
        ("2025-12-20T00:10:00.000001Z", None, "2025-12-20T00:00:00"),
        ("2030-01-01T00:00:00Z", "2025-12-12T10:00:01", "2025-12-20T00:00:00"),
    ],
)
def test_event_time(spark, source, ingest, expected):
    rows = spark.createDataFrame([(source, ingest)], "source_timestamp string, timestamp string")
    found = hierarchy.with_event_time(rows, AS_OF).select(F.unix_micros("EventTime"), "EventDate").first()
    assert found[0] == utc(expected).timestamp() * 1_000_000
    assert found[1] == utc(expected).date()


def test_event_time_defaults_to_now(spark):
    rows = spark.createDataFrame([(None, None)], "source_timestamp string, timestamp string")
    found = hierarchy.with_event_time(rows).select(F.unix_micros("EventTime")).first()[0] / 1_000_000
    assert abs(found - dt.datetime.now(dt.timezone.utc).timestamp()) < 120


def test_clean_tag(spark):
    cases = {"Comp_Motor_Current_ A": "Comp_Motor_Current_A", "A.B": "A_B", "a-- b": "a_b", "x\ty": "xy", None: None}
    assert column(spark, list(cases), tags.clean_tag) == list(cases.values())


def test_tag_priority(spark):
    cases = [
        ("PLC_S7_200_SMART.Compressor.X", PREFIX + "Y", "X"),
        ("Comp_Pressure", PREFIX + "Comp_Pressure", "Comp_Pressure"),
        ("Some.Name", "ns=2;s=Other.Thing", "Name"),
        (None, "ns=2;s=Other.Thing", "Thing"),
        ("", "plain", "plain"),
        (None, PREFIX.replace("ns=2", "ns=7") + "Z", "Z"),
        (None, None, None),
    ]
    rows = spark.createDataFrame(cases, "display_name string, node_id string, expected string")
    for r in rows.select("expected", tags.raw_tag("display_name", "node_id").alias("found")).collect():
        assert r["found"] == r["expected"]


def test_dots_in_the_device_path_are_not_wildcards(spark):
    assert column(spark, ["ns=2;s=PLC_S7_200_SMARTxCompressor.Y"], tags.tag_from_node_id) == [None]


def test_empty_names_never_become_partition_values(spark):
    rows = spark.createDataFrame(
        [(PREFIX, "", "", "1", "0", None, None)],
        "node_id string, production_line string, equipment_name string, value string, status_code string, "
        "source_timestamp string, timestamp string",
    )
    found = hierarchy.to_hierarchy(hierarchy.with_tag(rows), Plant("E"), AS_OF).first()
    assert (found["ProductionLine"], found["Equipment"], found["Tag"]) == ("Line-1", "Compressor", "untagged")


def test_status(spark):
    cases = {"0": 0, "1083179008": 1, "2150891520": 2, "4294967295": 3, "x": None, None: None}
    assert column(spark, list(cases), status.status_severity) == list(cases.values())
    assert column(spark, list(cases), status.is_bad_status) == [False, False, True, True, False, False]
    texts = {
        "BadNoCommunication": True, "Good": False, "StatusCode(value=2150891520)": True,
        "StatusCode(value=0)": False, None: False, "NotBad": False, "Bad (timeout after 5000 ms)": True,
        "BadNoCommunication (0x80310000)": True, "0x80310000": True, "2150891520": True, "after 5000 ms": False,
    }
    assert column(spark, list(texts), status.is_bad_status_text) == list(texts.values())


def test_quality_default(spark):
    assert column(spark, ["Bad", "", None], status.quality_or_good) == ["Bad", "Good", "Good"]


def test_diagnostics_and_null_ids(spark):
    rows = spark.createDataFrame(
        [("ns=2;s=a.Diagnostics.x", "x"), ("ns=2;s=b", "diagnosticsCount"), (None, "c"), ("ns=2;s=d", "d")],
        "node_id string, Tag string",
    )
    assert [r["Tag"] for r in filtering.drop_diagnostics(rows).collect()] == ["d"]
    assert filtering.allow_node_ids(rows, ["ns=2;s=d"]).count() == 1
    assert filtering.allow_node_ids(rows).count() == filtering.allow_node_ids(rows, []).count() == 4
    assert filtering.drop_null_ids(rows).count() == 3


def test_whole_allow_list_survives_ingest(spark):
    payloads = [json.dumps({"node_id": PREFIX + t, "value": 1, "status_code": 0}) for t in fixed.DEVICE_TAGS]
    rows = spark.createDataFrame([(p,) for p in payloads], "value string")
    found = history.hierarchy_rows(rows.withColumn("value", F.col("value").cast("binary")), as_of=AS_OF)
    assert sorted(r["Tag"] for r in found.collect()) == sorted(t.replace(" ", "") for t in fixed.DEVICE_TAGS)
    assert len(fixed.DEVICE_TAGS) == 23


def test_original_node_id_tells_equal_tags_apart(spark):
    ids = [PREFIX + "A.B", PREFIX + "A_B"]
    rows = spark.createDataFrame([(json.dumps({"node_id": i, "value": 1}),) for i in ids], "value string")
    found = history.hierarchy_rows(rows.withColumn("value", F.col("value").cast("binary")), ids=ids, as_of=AS_OF)
    assert {r["Tag"] for r in found.collect()} == {"A_B"}
    assert {r["NodeId"] for r in found.collect()} == set(ids)


def test_tag_list_setting(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "Tag string")
    assert filtering.allow_tags(rows, " a , ,").count() == 1
    assert filtering.allow_tags(rows, "").count() == 2
    assert filtering.allow_tags(rows).count() == 2


def test_contracts_of_both_producers_give_one_table(spark):
    rows = parsed(
        spark,
        [
            '{"node_id":"n","value":1,"status_code":0,"equipment_name":"E","timestamp":"2025-12-12T10:00:00"}',
            '{"node_id":"n","value":1,"quality":"Good","timestamp":"2025-12-12T10:00:00.123Z"}',
        ],
    ).collect()
    assert [(r["status_code"], r["quality"]) for r in rows] == [("0", None), (None, "Good")]


def test_kept_columns_may_not_hide_message_fields(spark):
    with pytest.raises(ValueError):
        parsing.parse_messages(spark.createDataFrame([("{}", 1)], "json string, timestamp int"), keep=("timestamp",))


def test_micros_survive_json(spark):
    rows = spark.sql("SELECT timestamp'2025-12-12 10:00:00.778549' AS t")
    record = parsing.to_records(rows).first()["record"]
    assert json.loads(record)["t"] == "2025-12-12T10:00:00.778549Z"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ_9 .;-\té", max_size=12), min_size=1, max_size=60))
def test_clean_tag_matches_python(spark, texts):
    import re

    expected = [re.sub(r"[^A-Za-z0-9_]+", "_", re.sub(r"[ \t]+", "", t)) for t in texts]
    assert column(spark, texts, tags.clean_tag) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.eE+-d", max_size=8), min_size=1, max_size=60))
def test_numeric_value_matches_python(spark, texts):
    def expected(text):
        try:
            number = float(text)
        except ValueError:
            return None
        return number if abs(number) < float("inf") else None

    assert column(spark, texts, numbers.numeric_value) == [expected(t) for t in texts]


def test_routing_is_complete(spark):
    rows = parsed(spark, ['{"node_id":"a","value":1}', "{}", "x", '{"type":"opcua_event","event":"e"}'])
    assert rows.count() == 4
    assert routing.readings(rows).count() == 1
    assert routing.events(rows).count() == 1
