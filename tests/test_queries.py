import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import catalogue, filtering, readings
from gaugeline.plans import queries


@pytest.fixture(scope="module")
def flat(spark):
    rows = [
        (1, "a", "9", "2025-01-01T00:00:00", "Good"),
        (2, "a", "10", "2025-01-01T00:00:02", None),
        (3, "a", "100.5", "2025-01-01T00:00:02Z", "Bad"),
        (4, "b", "abc", "2025-01-01T05:30:03+05:30", "Good"),
        (5, None, None, None, None),
        (6, "b", "0", "2025-01-01T00:00:04", "Good"),
    ]
    return spark.createDataFrame(rows, "id int, displayName string, value string, timestamp string, quality string")


def ids(df):
    return [r["id"] for r in df.collect()]


def test_list_nodes_keeps_null(flat):
    assert {r[0] for r in queries.list_nodes(flat).collect()} == {"a", "b", None}


def test_latest_breaks_ties(flat):
    assert ids(queries.latest_for_node(flat, "a", 2, ("id",))) == [3, 2]
    assert ids(queries.latest(flat, 10, ("id",))) == [6, 4, 3, 2, 1, 5]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 6, 10])
def test_newest_dates_give_the_same_rows(flat, n):
    typed = flat.withColumn("eventTime", filtering.time_expression(flat) + F.expr("make_dt_interval(id % 3)")).drop("timestamp")
    typed = typed.withColumn("eventDate", F.col("eventTime").cast("date").cast("string"))
    plain = queries.latest(typed, n, ("id",))
    assert ids(queries.latest(typed, n, ("id",), date_partition="eventDate")) == ids(plain)


def test_no_limit_gives_all_rows(flat):
    assert queries.latest(flat, None, ("id",)).count() == 6
    assert ids(queries.latest_for_node(flat, "a", None, ("id",), date_partition=None)) == [3, 2, 1]


def test_latest_without_a_time_column(spark):
    assert queries.latest(spark.range(50), 10).count() == 10


def test_time_column_is_found_in_any_case(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "TS int, Time int, x int")
    assert filtering.find_column(rows, ("eventtime", "timestamp", "time", "ts")) == "Time"


def test_stats_are_numeric(flat):
    assert tuple(queries.node_stats(flat, "a").first()) == (pytest.approx(39.8333333), 100.5, 9.0)
    assert tuple(queries.node_stats(flat, "none").first()) == (None, None, None)
    assert {r["displayName"]: r["max_value"] for r in queries.node_stats(flat).collect()} == {"a": 100.5, "b": 0.0, None: None}


def test_time_range_includes_both_ends(flat):
    found = queries.query_by_time(flat, "2025-01-01T00:00:00", "2025-01-01T00:00:03", tie_break=("id",))
    assert ids(found) == [1, 2, 3, 4]
    zone = dt.timezone(dt.timedelta(hours=1))
    start = dt.datetime(2025, 1, 1, 1, 0, 2, tzinfo=zone)
    assert ids(queries.query_by_time(flat, start, dt.datetime(2025, 1, 1, 0, 0, 2), tie_break=("id",))) == [2, 3]


def test_optional_conditions(flat):
    assert ids(queries.filter_readings(flat, quality="Good", tie_break=("id",))) == [1, 4, 6]
    assert ids(queries.filter_readings(flat, quality="null", tie_break=("id",))) == [2, 5]
    assert ids(queries.filter_readings(flat, quality="", start="", tie_break=("id",))) == [1, 2, 3, 4, 6, 5]
    assert ids(queries.filter_readings(flat, value=0)) == [6]
    assert ids(queries.filter_readings(flat, min_value=0, max_value=10, tie_break=("id",))) == [1, 2, 6]
    assert ids(queries.filter_readings(flat, node="b", tie_break=("id",), limit=1)) == [4]
    assert ids(queries.filter_readings(flat, node="b", limit=None, tie_break=("id",))) == [4, 6]


def test_limits_are_checked(flat):
    with pytest.raises(ValueError):
        queries.latest_for_node(flat, "a", -1)
    with pytest.raises(ValueError):
        queries.query_path(flat, "e", "s", "l", "q", "t", limit=1001)


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError):
        queries.list_nodes(spark.range(1))
    with pytest.raises(ValueError):
        queries.query_by_time(spark.range(1), None, None)


def test_dump(spark):
    count, rows = queries.dump(spark.range(25), 10)
    assert (count.first()["count"], rows.count()) == (25, 10)


def hot(spark, n=20_000):
    """A third of all rows in one group, the rest in many."""
    tag = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
    return spark.range(n).select("id", tag.alias("Tag"), F.timestamp_seconds(F.col("id") * 7919 % n).alias("EventTime"))


@pytest.mark.parametrize("n", [1, 5, 1000, 3000])
def test_first_samples_of_hot_groups(spark, n):
    rows = hot(spark)
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: (r["EventTime"], r["id"])):
        expected.setdefault(r["Tag"], []).append(r["id"])
    expected = {tag: sorted(found[:n]) for tag, found in expected.items()}
    found = {}
    for r in readings.first_samples(rows, ("Tag",), tie_break=("id",), n=n).collect():
        found.setdefault(r["Tag"], []).append(r["id"])
    assert {tag: sorted(v) for tag, v in found.items()} == expected


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_name_lookup_by_broadcast_and_by_shuffle(spark, bound):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    try:
        _look_up(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _look_up(spark):
    rows = hot(spark).select(F.col("Tag").alias("node_id"), "id").union(spark.sql("SELECT NULL, 1L"))
    listed = spark.createDataFrame(
        [("hot", "Hot"), ("hot", "Another"), ("t1", "One"), ("t2", None), (None, "x"), ("t9", "Nine")],
        "node_id string, display_name string",
    )
    names = {"hot": "Another", "t1": "One", "t9": "Nine"}
    found = catalogue.with_display_name(rows, listed).collect()
    assert len(found) == rows.count()
    assert all(r["display_name"] == names.get(r["node_id"], r["node_id"]) for r in found)
    allowed = catalogue.allow_listed(rows, listed)
    assert allowed.count() == rows.where(F.col("node_id").isin("hot", "t1", "t2", "t9")).count()


def test_coverage(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",)], "node_id string")
    reports = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "node_id string")
    assert tuple(catalogue.coverage(listed, reports).first()) == (2, 1)


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame(
        [
            ("ns=0;i=1", "Server", "Variable", ["Objects", "Server"]),
            ("ns=2;s=a", "Pressure", "Variable", ["Objects", "PLC", "Pressure"]),
            ("ns=2;s=b", "InputArguments", "Variable", ["Objects", "PLC", "InputArguments"]),
            ("ns=3;s=c", "x", "Variable", ["Objects", "bacnet devices", "x"]),
            ("i=5", "Count", "Object", ["Objects", "PLC", "Diagnostics", "Count"]),
            ("ns=2;s=d", None, "Variable", ["Objects"] + ["c"] * 10 + ["d"]),
            ("ns=2;s=e", "Count", "Variable", ["Objects", "PLC", "Diagnostics", "Count"]),
            ("ns=2;s=f", "Listed", "Variable", None),
            ("ns=2;s=g", "Gap", "Variable", ["Objects", None, "Gap"]),
        ],
        "node_id string, display_name string, node_class string, path array<string>",
    )


def listed_ids(df):
    return sorted(r["node_id"] for r in df.collect())


def test_catalogue_filters(nodes):
    everything = listed_ids(nodes)
    assert listed_ids(catalogue.allow_namespaces(nodes, "0, 3")) == ["i=5", "ns=0;i=1", "ns=3;s=c"]
    assert listed_ids(catalogue.allow_namespaces(nodes, "")) == everything
    assert listed_ids(catalogue.allow_namespaces(nodes, "x,2")) == everything
    assert listed_ids(catalogue.drop_keywords(nodes)) == sorted(set(everything) - {"ns=0;i=1"})
    assert listed_ids(catalogue.namespaced_only(nodes)) == sorted(set(everything) - {"i=5"})
    assert listed_ids(catalogue.of_node_class(nodes, "Object")) == ["i=5"]
    assert listed_ids(catalogue.cap(nodes, 2)) == everything[:2]
    assert listed_ids(catalogue.cap(nodes, 0)) == everything
    assert listed_ids(catalogue.drop_subtrees(nodes)) == ["ns=2;s=a", "ns=2;s=b", "ns=2;s=f", "ns=2;s=g"]
    assert listed_ids(catalogue.drop_subtrees(nodes, max_depth=None)) == ["ns=2;s=a", "ns=2;s=b", "ns=2;s=d", "ns=2;s=f", "ns=2;s=g"]
    assert listed_ids(catalogue.diagnostics_branch(nodes)) == sorted(set(everything) - {"i=5", "ns=2;s=e"})
    assert listed_ids(catalogue.device_variables(nodes, "PLC")) == ["ns=2;s=a", "ns=2;s=b"]
    assert listed_ids(catalogue.device_variables(nodes, "PLC", True)) == ["ns=2;s=a", "ns=2;s=b", "ns=2;s=e"]
    assert listed_ids(catalogue.diagnostics_branch(nodes, include=True)) == everything
    assert listed_ids(catalogue.tags_to_sample(nodes)) == ["ns=2;s=a", "ns=2;s=d", "ns=2;s=e", "ns=2;s=f", "ns=2;s=g", "ns=3;s=c"]
