"""Streams that remember: messages sent twice, windows of event time, late rows, restarts."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gaugeline.registered import queries, views
from gaugeline.sinks.tables import Table
from gaugeline.sources.files import read_table
from gaugeline.streaming import ingest, stateful
from gaugeline.streaming.monitor import ProgressLog
from tests.check import compare

MESSAGE = "offset long, node_id string, source_timestamp string, timestamp string, value string, arrival timestamp"


def message(offset, node, source, made, value="1", arrival="2024-01-01 00:00:00"):
    return offset, node, source, made, value, arrival


class Run:
    """A query over a folder that grows by a file a call."""

    def __init__(self, spark, path, schema, chain):
        self.spark, self.path, self.schema, self.chain = spark, path, schema, chain

    def __call__(self, *rows):
        times = [c.split()[0] for c in self.schema.split(", ") if c.endswith(" timestamp")]
        texts = ", ".join(c.replace(" timestamp", " string") for c in self.schema.split(", "))
        made = self.spark.createDataFrame(rows, texts).withColumns({n: F.col(n).cast("timestamp") for n in times})
        made.coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")
        query = Table(f"{self.path}/out").write_stream(self.chain(stream), f"{self.path}/c", ingest.ALL_THERE_IS)
        return ingest.drain(query)

    def rows(self, *columns):
        return sorted(map(tuple, read_table(self.spark, f"{self.path}/out").select(*columns).collect()), key=str)


@pytest.fixture
def sent(spark, tmp_path):
    chain = lambda df: stateful.drop_resent(stateful.with_sent_time(df, "arrival"), ("offset",), "10 minutes")
    return Run(spark, tmp_path, MESSAGE, chain)


def test_resent_messages_are_dropped(sent):
    first = [
        message(1, "a", "2024-01-01T00:00:00Z", "x"), message(2, "a", "2024-01-01T00:00:01Z", "x"), message(3, "b", "2024-01-01T00:00:00Z", "x"),
        message(4, "a", "2024-01-01T00:00:00Z", "x"),  # sent again within a batch
        message(5, "a", None, "2024-01-01T00:00:00Z"), message(6, None, "2024-01-01T00:00:00Z", "x"), message(7, None, None, None), message(8, "a", None, None),
    ]
    sent(*first)
    # Sent again later, from other places of the bus; messages without an id or a time are each their own.
    sent(*[(r[0] + 10, *r[1:]) for r in first])
    kept = {r[0] for r in sent.rows("offset")}
    assert len(kept & {1, 4}) == 1 and kept - {1, 4} == {2, 3, 5, 6, 7, 8, 16, 17, 18}


def test_messages_of_one_time_are_told_apart_by_number(spark, tmp_path):
    chain = lambda df: stateful.drop_resent(stateful.with_sent_time(df, "arrival"), ("offset",), "10 minutes", number=("offset",))
    run = Run(spark, tmp_path, MESSAGE, chain)
    first = [message(i, "a", "2024-01-01T00:00:00Z", "x") for i in (1, 2)] + [message(3, None, None, None), message(3, None, None, None)]
    run(*first)
    run(*first, message(4, "a", "2024-01-01T00:00:00Z", "x"))
    assert [r[0] for r in run.rows("offset")] == [1, 2, 3, 4]


@pytest.fixture(scope="module")
def repeated(spark, small, tmp_path_factory):
    """The events three times with shifted ids: messages of a node share their times. ``days`` also moves the copies apart."""

    def make(days=0):
        folder = tmp_path_factory.mktemp("repeated")
        events = spark.read.parquet(f"{small}/events.parquet")
        copies = events.crossJoin(spark.range(3).withColumnRenamed("id", "copy"))
        moved = copies.withColumn("event_id", F.expr("event_id + copy * 1000")).withColumn("ts", F.expr(f"ts + make_dt_interval(copy * {days})"))
        moved.select(*events.columns).coalesce(1).sortWithinPartitions("event_id").write.parquet(f"{folder}/parts")
        (part,) = folder.glob("parts/*.parquet")
        part.rename(folder / "events.parquet")
        return str(folder)

    return make


@pytest.mark.parametrize("days", [0, 200])
def test_messages_of_repeated_tables_are_whole(spark, repeated, days):
    folder = repeated(days)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    for name, dropped in (("stream_deduplicated", ()), ("stream_window_stats", ("avg_value",))):
        build = lambda s, f: entry.queries()[name](s, f).drop(*dropped)  # noqa: B023, E731
        sql = f"SELECT * EXCLUDE (avg_value) FROM ({entry.oracle_sql()[name]})" if dropped else entry.oracle_sql()[name]
        assert compare(spark, con, folder, build, sql) is None


def test_state_spreads_with_the_messages_and_lies_on_disk(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "STATE_ROWS", 50)
    path = str(tmp_path / "once")
    assert queries._by_parts(spark, small, lambda once: once.select("offset"), path).distinct().count() == 1000
    state = tmp_path / "once-checkpoint" / "state" / "0"
    assert len([f for f in state.iterdir() if f.name.isdigit()]) == 20
    assert list(state.glob("*/*.zip")) and not list(state.glob("*/*.delta"))  # RocksDB's snapshots


def test_state_is_forgotten_and_late_rows_are_counted(sent):
    at = lambda minute: f"2024-01-01T00:{minute:02}:00Z"
    query = sent(*[message(i, "n", at(i), "x") for i in range(8)])
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert held[0] == 8
    query = sent(message(100, "n", at(40), "x"))
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert held[-1] == 1  # the watermark has passed the first eight
    query = sent(message(101, "n", at(3), "x"), message(102, "n", at(40), "x"), message(103, "n", at(41), "x"))
    assert stateful.late_rows(query.recentProgress) == 1  # its first sending is forgotten, so it may not pass
    assert [r[0] for r in sent.rows("offset")] == sorted([*range(8), 100, 103], key=str)


READING = "place string, EventTime timestamp, ValueDouble double"


@pytest.fixture
def windows(spark, tmp_path):
    return Run(spark, tmp_path, READING, lambda df: stateful.window_stats(df, "10 minutes", ("place",), "5 minutes"))


def at(minute):
    return f"2024-01-01 {minute // 60:02}:{minute % 60:02}:00"


def test_windows_equal_the_batch_and_survive_restarts(spark, windows):
    parts = [[(f"p{i % 3}", at(m), float(i) if i % 4 else None) for i, m in enumerate(range(start, start + 40, 2))] for start in (0, 36, 72)]
    log = ProgressLog().attach(spark)
    try:
        for part in parts:
            windows(*part)
        windows(("p0", at(200), 1.0))  # moves the watermark on
        before = windows.rows("place", "window_start", "n", "n_values", "avg_value", "max_value", "min_value")
        windows(("p0", at(3), 99.0), ("p1", at(4), 99.0))  # too late: counted, and no window changes
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        log.detach(spark)
    assert stateful.late_rows(log.progress) == 2
    after = windows.rows("place", "window_start", "n", "n_values", "avg_value", "max_value", "min_value")
    assert after == before
    everything = spark.createDataFrame([r for part in parts for r in part], "place string, EventTime string, ValueDouble double")
    batch = stateful.window_stats(everything.withColumn("EventTime", F.col("EventTime").cast("timestamp")), "10 minutes", ("place",))
    assert sorted(map(tuple, batch.select("place", "window_start", "n", "n_values", "avg_value", "max_value", "min_value").collect()), key=str) == after


def test_hot_place_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("place"), F.timestamp_seconds("id").alias("EventTime"), F.col("id").cast("double").alias("ValueDouble"))
    plan = stateful.window_stats(rows, "10 minutes", ("place",))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") > plan.index("Exchange hashpartitioning")
    assert stateful.window_stats(rows.where("false"), "10 minutes", ("place",)).count() == 0
