"""What the optimizer must make of the queries."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import catalogue, filtering
from gaugeline.registered import views
from gaugeline.registered.queries import REGISTERED

QUERIES = REGISTERED


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize(
    "name", ["hierarchy_table", "hierarchy_by_tag", "parse_flat", "classify_messages", "event_time", "typed_values"]
)
def test_ingest_is_map_only_and_parses_once(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "Exchange" not in text
    messages = 2 if name == "classify_messages" else 1  # the union of two sources reads each once
    assert text.count("from_json(") <= messages


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_in_any_plan(spark, small, name):
    if name.startswith(("stream_", "compacted", "browse_", "node_days")):
        pytest.skip("the plan left after the stream or the walk is a scan")
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan(QUERIES[name](spark, small)))


def test_path_query_prunes_partitions_and_pushes_bounds(spark, small):
    text = formatted(QUERIES["query_path"](spark, small))
    for level in ("Enterprise", "Site", "ProductionLine", "Equipment", "Tag"):
        assert re.search(rf"PartitionFilters: .*\({level}#\d+ = ", text)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(EventTime,.*GreaterThanOrEqual\(ValueDouble,2.0\)", text)
    assert "TakeOrderedAndProject" in text


def test_path_query_prunes_dates_where_they_are_partitions(spark, small):
    text = formatted(QUERIES["query_path_by_date"](spark, small))
    assert re.search(r"PartitionFilters: .*EventDate#\d+ >= 2024-01-07.*EventDate#\d+ <= 2024-01-16", text)
    assert re.search(r"PushedFilters: .*EqualTo\(Tag,Comp_Freq\)", text)


def test_time_range_prunes_dates_and_pushes_times(spark, small):
    text = formatted(QUERIES["query_by_time"](spark, small))
    assert re.search(r"PartitionFilters: .*eventDate#\d+ >= 2024-01-04.*eventDate#\d+ <= 2024-01-13", text)
    assert "GreaterThanOrEqual(eventTime" in text
    assert "TakeOrderedAndProject" in text


def test_stats_read_two_columns_and_aggregate_before_the_shuffle(spark, small):
    df = QUERIES["node_stats_all"](spark, small)
    assert "ReadSchema: struct<displayName:string,valueDouble:double>" in formatted(df)
    assert "partial_avg" in plan(df)


def test_allow_list_is_pushed_as_in(spark, small):
    table = views.stored_flat(spark, small)
    text = formatted(filtering.allow_node_ids(table, ["a", "b"], "nodeId"))
    assert "In(nodeId, [a,b])" in text


@pytest.mark.parametrize("name, date", [("latest_any", "EventDate"), ("latest_for_node", "eventDate")])
def test_newest_rows_read_the_newest_dates_only(spark, small, name, date):
    text = formatted(QUERIES[name](spark, small))
    assert re.search(rf"PartitionFilters: .*{date}#\d+ >= .*[sS]ubquery", text)


def test_samples_are_cut_before_the_shuffle(spark, small):
    text = plan(QUERIES["first_n_per_tag"](spark, small))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert "row_number(), 5, Partial" in text


def test_samples_of_any_size_have_one_plan(spark, small):
    text = plan(QUERIES["first_many_per_tag"](spark, small))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert "row_number(), 1500, Partial" in text


def test_no_job_runs_while_a_lookup_is_built(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise("x").alias("node_id"))
    listed = spark.createDataFrame([("hot", "Hot"), ("x", "X")], "node_id string, display_name string")
    spark.sparkContext.setJobGroup("lookup", "building a plan")
    catalogue.with_display_name(rows, listed)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", ["hierarchy_table", "parse_flat", "typed_values"])
def test_ingest_is_map_only_at_any_size(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, LARGER))
