"""The roll-up kept with every write, and what it saves."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import queries, rollup
from gaugeline.plans.rollup import RolledUp
from gaugeline.sinks.tables import Table
from gaugeline.sources.files import read_table
from gaugeline.streaming import ingest
from gaugeline.registered import views
from gaugeline.registered.queries import REGISTERED
from tests.test_plans import formatted, plan
from tests.test_streams import forget_commit

SCHEMA = "displayName string, eventDate date, eventTime timestamp, valueDouble double"


def rows(spark, *listed):
    text = spark.createDataFrame(listed, "displayName string, moment string, valueDouble double")
    return text.select("displayName", F.to_date("moment").alias("eventDate"), F.to_timestamp("moment").alias("eventTime"), "valueDouble")


@pytest.fixture
def tables(tmp_path):
    return RolledUp(Table(f"{tmp_path}/readings", partition_by=("eventDate",), bloom_on=("displayName",)), Table(f"{tmp_path}/rollup"))


def same_as_readings(spark, tables):
    stored, parts = read_table(spark, tables.readings.path), read_table(spark, tables.rollup.path)
    exact = lambda df: sorted(map(str, df.collect()))
    assert exact(rollup.stats(parts, ("displayName",))) == exact(queries.node_stats(stored))
    assert exact(rollup.stats(parts)) == exact(queries.node_stats(stored.withColumn("displayName", F.lit("all")), "all"))
    assert rollup.merged(parts, ()).first()["n"] == stored.count()
    for node in ("a", "b", "none"):
        for n in (1, 3, 100):
            counted = queries.latest_for_node(stored, node, n, ("valueDouble",), "eventDate", parts)
            assert list(map(str, counted.collect())) == list(map(str, queries.latest_for_node(stored, node, n, ("valueDouble",)).collect()))
    return parts


def test_appends_and_late_rows(spark, tables):
    tables.write_batch(rows(spark, ("a", "2024-01-02 01:00:00", 1.0), ("a", "2024-01-02 02:00:00", None), ("b", "2024-01-03 00:00:00", 8.0), (None, "2024-01-03 00:00:00", 2.0)))
    same_as_readings(spark, tables)
    tables.write_batch(rows(spark, ("a", "2024-01-01 00:00:00", -4.0), ("a", "2024-01-02 00:30:00", 0.5), ("b", None, 3.0), ("b", "2024-01-09 00:00:00", 1.5)))
    parts = same_as_readings(spark, tables)
    assert parts.count() == 7 and tables.condense(parts).count() == 6
    assert rollup.stats(tables.condense(parts)).collect() == rollup.stats(parts).collect()
    tables.write_batch(rows(spark, ("b", "2024-01-09 00:00:00", 1.0)), mode="overwrite")
    assert same_as_readings(spark, tables).count() == 1
    assert tuple(rollup.stats(read_table(spark, tables.rollup.path).where("false")).first()) == (None, None, None)


def test_stream_and_replay(spark, tables, tmp_path):
    source, checkpoint = str(tmp_path / "in"), tmp_path / "c"

    def run():
        query = tables.write_stream(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), str(checkpoint), ingest.ALL_THERE_IS)
        ingest.drain(query)
        return same_as_readings(spark, tables)

    for part in range(3):
        rows(spark, *[("a", f"2024-01-0{day} 0{part}:00:00", float(day * part)) for day in (1, 2, 3)]).coalesce(1).write.mode("append").parquet(source)
    assert run().count() == 9
    forget_commit(checkpoint, 2)
    assert run().count() == 9  # the batch run again replaces its own rows and partials
    assert read_table(spark, tables.readings.path).count() == 9
    with pytest.raises(ValueError, match="holds batches"):
        tables.write_stream(spark.readStream.schema(SCHEMA).parquet(source), str(tmp_path / "other"))


def test_statistics_read_no_reading(spark, small):
    text = formatted(REGISTERED["node_stats_rolled_up"](spark, small))
    assert "/rollup" in text and "/readings" not in text
    assert "partial_sum" in plan(rollup.partials(views.flat(spark, small), ("displayName",), "eventDate", "eventTime", "valueDouble"))


def test_newest_rows_take_their_dates_from_the_rollup(spark, small):
    text = formatted(REGISTERED["latest_for_node_counted"](spark, small))
    scans = re.findall(r"Location: \S+ \[(\S+)\]", text)
    assert sum("/readings" in path for path in scans) == 1  # once, for the rows themselves
    assert re.search(r"PartitionFilters: .*eventDate#\d+ >= .*[sS]ubquery", text)
    df = REGISTERED["latest_for_node_counted"](spark, small)
    df.collect()
    # One of thirty days is read.
    metrics = re.search(r"number of partitions read: (\d+)", df._jdf.queryExecution().executedPlan().toString())
    assert metrics is None or int(metrics.group(1)) <= 2


def test_files_have_bloom_filters(spark, tables):
    import pyarrow.parquet as pq
    from pathlib import Path

    tables.write_batch(rows(spark, *[(f"node{i}", "2024-01-02 01:00:00", 1.0) for i in range(500)]))
    files = list(Path(tables.readings.path).rglob("*.parquet"))
    plain = Table(f"{tables.readings.path}-plain", partition_by=("eventDate",))
    plain.write_batch(read_table(spark, tables.readings.path))
    size = lambda found: sum(f.stat().st_size for f in found)
    assert files and size(files) > size(Path(plain.path).rglob("*.parquet"))
    assert pq.ParquetFile(files[0]).metadata.num_rows
    assert read_table(spark, tables.readings.path).where("displayName = 'node7'").count() == 1
