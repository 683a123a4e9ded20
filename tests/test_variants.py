"""Values keep their JSON type from the wire and back."""

import json

from pyspark.sql import functions as F

from gaugeline.operators import parsing, publishing, readings
from gaugeline.plans import history

VALUES = {
    1: "12", 2: '"12"', 3: "true", 4: '"true"', 5: "123456789012345678901", 6: '[1,["a",{"k":2}]]', 7: '{"b":1,"a":[1]}', 8: "null", 9: '""', 10: '"[1]"',
    11: "1.0", 12: '"say \\"12\\""', 13: "-0.5", 14: '"null"', 15: '" 12 "',
}


def parsed(spark):
    rows = [(i, bytearray(f'{{"node_id":"n","value":{v}}}'.encode())) for i, v in VALUES.items()]
    rows += [(90, bytearray(b"{bad")), (91, bytearray(b'{"node_id":"n"}')), (92, None), (93, bytearray(b"")), (94, bytearray(b'{"node_id":"n","value":NaN}'))]
    return parsing.with_value_type(history.messages(spark.createDataFrame(rows, "offset long, value binary"), ("offset", "json")))


def test_types_of_values(spark):
    found = {r["offset"]: r["value_type"] for r in parsed(spark).collect()}
    names = {int: "number", float: "number", str: "string", bool: "boolean", list: "array", dict: "object", type(None): None}
    assert found == {**{i: names[type(json.loads(v))] for i, v in VALUES.items()}, 90: None, 91: None, 92: None, 93: None, 94: None}


def test_published_values_are_as_they_came(spark):
    sent = publishing.to_messages(parsed(spark), fields=("node_id", "value"), keep=("offset",), types={"value": "value_type"})
    assert sent.columns == ["offset", "topic", "key", "value"]
    found = {r["offset"]: bytes(r["value"]).decode() for r in sent.collect()}
    for i, v in VALUES.items():
        back = json.loads(found[i])
        assert back == {"node_id": "n", **({} if v == "null" else {"value": json.loads(v)})}
        if v != "null":
            assert type(back["value"]) is type(json.loads(v)) and found[i].endswith(f'"value":{v}}}')
    assert found[90] == found[92] == "{}"
    assert json.loads(found[94]) == {"node_id": "n", "value": '"NaN"'}


def test_typed_columns_follow_the_type(spark):
    rows = readings.with_typed_value(parsed(spark), "value", "value_type")
    found = {r["offset"]: (r["kind"], r["value_integer"], r["value_float"], r["value_string"]) for r in rows.collect()}
    assert found[1] == ("integer", 12, None, None) and found[2] == ("string", None, None, "12")
    assert found[4] == ("string", None, None, "true") and found[5] == ("float", None, 123456789012345678901.0, None)
    assert found[8] == found[90] == found[91] == (None,) * 4
    assert found[15] == ("string", None, None, " 12 ") and found[11] == ("float", None, 1.0, None)
    by_look = {r["offset"]: r["kind"] for r in readings.with_typed_value(parsed(spark), "value").collect()}
    assert by_look[2] == "integer"


def test_parts_of_variants(spark):
    rows = parsing.with_variant(parsing.decode(spark.createDataFrame([(bytearray(b'{"value":[1,{"k":123456789012345678901}]}'),), (bytearray(b"{"),), (None,)], "value binary")))
    r = rows.select(F.try_variant_get("value_variant", "$[1].k", "decimal(38,0)").cast("string").alias("k"), F.try_variant_get("value_variant", "$[0]", "bigint").alias("a")).collect()
    assert [tuple(x) for x in r] == [("123456789012345678901", 1), (None, None), (None, None)]
