import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import fixed, storage
from gaugeline.operators import hierarchy, readings
from gaugeline.plans import history, maintenance
from gaugeline.registered import views
from gaugeline.sinks import messages as message_sinks
from gaugeline.sinks.tables import BATCH, Table, spread
from gaugeline.sources import events as adapter
from gaugeline.sources.files import FileSource, cached, read_parquet, read_table, read_tag_list
from gaugeline.streaming import ingest, side_outputs
from gaugeline.streaming import latest as latest_stream
from gaugeline.streaming.monitor import ProgressLog

PLANT, AS_OF, KEEP = views.PLANT, views.AS_OF, views.KEEP


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*[F.col(c).cast("string") for c in columns]).collect()))


@pytest.fixture(scope="module")
def envelope(spark, small):
    return views.envelope(spark, small)


@pytest.fixture(scope="module")
def staged(spark, small):
    """Five files in an order that is not that of time."""
    path = views.scratch_path(spark, "staged")
    views.envelope(spark, small).repartition(5, "offset").write.parquet(path)
    return path


def stream(spark, path, schema, files=1):
    return FileSource(path, schema=schema, max_files_per_trigger=files).read_stream(spark)


def hierarchy_rows(df):
    return history.hierarchy_rows(df, PLANT, views.IDS, AS_OF, keep=KEEP)


def test_stream_equals_batch_and_resumes(spark, staged, envelope, tmp_path):
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run():
        table = Table(target, partition_by=fixed.HIERARCHY)
        rows = hierarchy_rows(stream(spark, staged, envelope.schema))
        return ingest.drain(table.write_stream(rows, checkpoint, ingest.ALL_THERE_IS, name="resumable"))

    first = run()
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 5
    expected = rows_of(hierarchy_rows(envelope))
    assert rows_of(read_table(spark, target)) == expected
    run()
    assert rows_of(read_table(spark, target)) == expected


def test_late_rows_are_appended(spark, staged, envelope, tmp_path):
    """A watermark without state drops nothing: all files after the first hold rows older than it."""
    target = str(tmp_path / "table")
    rows = ingest.with_watermark(hierarchy_rows(stream(spark, staged, envelope.schema)))
    ingest.drain(Table(target).write_stream(rows, str(tmp_path / "checkpoint"), ingest.ALL_THERE_IS))
    assert read_table(spark, target).count() == hierarchy_rows(envelope).count()


def test_gathered_stream_writes_fewer_files(spark, staged, envelope, tmp_path):
    def files(name, **how):
        target = str(tmp_path / name)
        rows = hierarchy_rows(stream(spark, staged, envelope.schema, files=5))
        table = Table(target, partition_by=fixed.HIERARCHY, **how)
        ingest.drain(table.write_stream(rows, f"{target}-checkpoint", ingest.ALL_THERE_IS))
        return read_table(spark, target)

    plain, gathered = files("plain"), files("gathered", files_per_partition=1, salt_from=KEEP)
    assert rows_of(plain) == rows_of(gathered)
    assert len(gathered.inputFiles()) < len(plain.inputFiles())


def test_tag_that_looks_numeric_stays_text(spark, tmp_path):
    target = str(tmp_path / "table")
    rows = spark.createDataFrame([("1", 1.0), ("007", 2.0)], "Tag string, v double")
    Table(target, partition_by=("Tag",)).write_batch(rows)
    assert {r["Tag"] for r in read_table(spark, target).collect()} == {"1", "007"}


def forget_commit(checkpoint, batch):
    """As if the query had died after its batch was written and before that was noted."""
    for name in (f"{batch}", f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink()


def test_latest_table_survives_replay(spark, staged, envelope, tmp_path):
    root, checkpoint = str(tmp_path / "latest"), tmp_path / "c"

    def run():
        rows = hierarchy_rows(stream(spark, staged, envelope.schema))
        return ingest.drain(latest_stream.start(rows, root, str(checkpoint), tie_break=KEEP, trigger=ingest.ALL_THERE_IS))

    run()
    table = hierarchy_rows(envelope)
    expected = rows_of(readings.latest_values(table, tie_break=KEEP))
    assert rows_of(latest_stream.read(spark, root, table.schema)) == expected
    for _ in range(2):
        forget_commit(checkpoint, 4)
        replay = run()
        assert [p["batchId"] for p in replay.recentProgress if p["numInputRows"]] == [4]
        assert rows_of(latest_stream.read(spark, root, table.schema)) == expected


def test_latest_table_replaces_changed_places_only(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "latest", "c"))
    schema = "place string, unit int, at timestamp, seq int, value double"

    def run(*rows):
        spark.createDataFrame(rows, "place string, unit int, at string, seq int, value double").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        rows_ = spark.readStream.schema(schema).parquet(source)
        query = latest_stream.start(rows_, root, checkpoint, ("place", "unit"), "at", ("seq",), ingest.ALL_THERE_IS)
        ingest.drain(query)
        return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in (tmp_path / "latest").glob("place=*/unit=*/*.parquet")}

    first = run(*[(f"p{i}", i % 2, "2024-01-01 00:00:00", i, float(i)) for i in range(12)])
    second = run(("p3", 1, "2024-01-01 00:00:00", 99, 0.5), ("p4", 0, None, 100, 7.0), ("p4", 0, "2023-12-31 00:00:00", 101, 8.0))
    # One place has a newer row; the rows of the other are older, so its latest row is written as it was.
    assert len(first) == len(second) == 12 and len(first.items() & second.items()) == 10
    third = run(("new", 5, None, 1, 1.0))
    assert len(third) == 13 and second.items() <= third.items()
    read = latest_stream.read(spark, root, spark.createDataFrame([], schema).schema)
    assert {(r["place"], r["unit"]): (r["seq"], r["value"]) for r in read.collect()} == {
        **{(f"p{i}", i % 2): (i, float(i)) for i in range(12)}, ("p3", 1): (99, 0.5), ("new", 5): (1, 1.0)}
    with pytest.raises(FileNotFoundError):
        latest_stream.read(spark, str(tmp_path / "none"))


def test_a_new_checkpoint_needs_a_new_folder(spark, staged, envelope, tmp_path):
    root = str(tmp_path / "out")
    rows = stream(spark, staged, envelope.schema, files=5)
    ingest.drain(side_outputs.start(rows, root, str(tmp_path / "c1"), PLANT, AS_OF, KEEP, ingest.ALL_THERE_IS))
    with pytest.raises(ValueError, match="holds batches"):
        side_outputs.start(rows, root, str(tmp_path / "c2"), PLANT, AS_OF, KEEP)
    with pytest.raises(ValueError, match="holds batches"):
        latest_stream.start(rows, root, str(tmp_path / "c2"))


def test_side_outputs_land_once_after_a_replay(spark, small, tmp_path):
    source = views.events(spark, small)
    both = adapter.readings(source).unionByName(adapter.controls(source))
    staged, root = str(tmp_path / "staged"), str(tmp_path / "out")
    both.repartition(3, "offset").write.parquet(staged)
    for attempt in range(2):
        if attempt:
            forget_commit(tmp_path / "c", 2)
        query = side_outputs.start(
            stream(spark, staged, both.schema), root, str(tmp_path / "c"), PLANT, AS_OF, KEEP, ingest.ALL_THERE_IS
        )
        ingest.drain(query)
    # A batch that is being written again has no success marker: readers leave it out until it has.
    marker = next((tmp_path / "out" / "events").glob("batch=*/_SUCCESS"))
    whole = side_outputs.read(spark, root, "events").count()
    marker.unlink()
    assert side_outputs.read(spark, root, "events").count() < whole
    marker.touch()
    expected = side_outputs.split(history.messages(both, (*KEEP, "json")), PLANT, AS_OF, KEEP)
    assert sum(table.count() for table in expected.values()) == both.count()
    for name in side_outputs.TABLES:
        assert rows_of(side_outputs.read(spark, root, name)) == rows_of(expected[name])


def test_only_dead_letters_keep_their_payload_while_tables_are_written(envelope):
    kept = side_outputs.to_keep(history.messages(envelope, (*KEEP, side_outputs.PAYLOAD)))
    counts = {r["message_class"]: (r["n"], r["payloads"]) for r in kept.groupBy("message_class").agg(F.count("*").alias("n"), F.count("json").alias("payloads")).collect()}
    assert {"reading", "bad_value", "unparsable"} <= set(counts)
    assert all(payloads == (n if name in ("unparsable", "unknown") else 0) for name, (n, payloads) in counts.items())


def test_staged_files_do_not_grow_with_the_table(spark, small, monkeypatch):
    monkeypatch.setattr(views, "STAGED_ROWS", 100)
    parts = list(views.parts_by_time(spark, small))
    for path in (views.staged_envelope(spark, small), parts[-1]):
        files = read_parquet(spark, path).groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == 1000 and max(r["count"] for r in files) <= 100


def test_side_tables_are_compacted_again_and_again(spark, small, tmp_path):
    source = views.events(spark, small)
    both = adapter.readings(source).unionByName(adapter.controls(source))
    staged, root, checkpoint = str(tmp_path / "staged"), str(tmp_path / "out"), tmp_path / "c"

    def take(part):
        both.where(F.col("offset") % 3 == part).repartition(3, "offset").write.mode("append").parquet(staged)
        ingest.drain(side_outputs.start(stream(spark, staged, both.schema), root, str(checkpoint), PLANT, AS_OF, KEEP, ingest.ALL_THERE_IS))
        return rows_of(side_outputs.read(spark, root, "bad_values"))

    expected = take(0)
    assert side_outputs.compact(spark, root, "bad_values") == (0, 1)  # the newest may have to be run again
    assert rows_of(side_outputs.read(spark, root, "bad_values")) == expected
    assert side_outputs.compact(spark, root, "bad_values") is None
    assert side_outputs.retire(spark, root, "bad_values") == 2
    forget_commit(checkpoint, 2)
    expected = take(1)
    marker = tmp_path / "out" / "bad_values" / "batch=4" / "_SUCCESS"
    marker.unlink()  # as if it were being written again: what follows it waits
    assert side_outputs.compact(spark, root, "bad_values") == (2, 3)
    marker.touch()
    assert rows_of(side_outputs.read(spark, root, "bad_values")) == expected
    expected = take(2)
    assert side_outputs.compact(spark, root, "bad_values") == (4, 7)
    assert side_outputs.retire(spark, root, "bad_values") == 6
    assert rows_of(side_outputs.read(spark, root, "bad_values")) == expected
    everything = side_outputs.split(history.messages(both, (*KEEP, "json")), PLANT, AS_OF, KEEP)["bad_values"]
    assert rows_of(everything) == expected
    assert len(side_outputs.read(spark, root, "bad_values").inputFiles()) < 9


def test_schema_evolution(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    spark.createDataFrame([(1, "q")], "id int, quality string").write.parquet(source)
    schema = "id int, quality string"

    def run(*columns):
        rows = spark.readStream.schema(schema).parquet(source).select(*columns)
        ingest.drain(Table(target, merge_schema=True).write_stream(rows, checkpoint, ingest.ALL_THERE_IS))

    run("id")
    spark.createDataFrame([(2, "r")], schema).write.mode("append").parquet(source)
    run("id", "quality")
    assert sorted(map(tuple, read_parquet(spark, target, merge_schema=True).collect())) == [(1, None), (2, "r")]


def test_progress_and_failure_are_reported(spark, staged, envelope, tmp_path):
    progress = ProgressLog().attach(spark)
    try:
        rows = stream(spark, staged, envelope.schema, files=5)
        query = Table(str(tmp_path / "ok")).write_stream(rows, str(tmp_path / "c1"), ingest.ALL_THERE_IS, name="watched")
        ingest.drain(query)
        assert ingest.root_cause(query) is None

        def fail(batch, batch_id):
            raise ValueError("no room left")

        broken = rows.writeStream.foreachBatch(fail).trigger(availableNow=True).start()
        with pytest.raises(StreamingQueryException, match="no room left"):
            ingest.drain(broken)
        assert "no room left" in ingest.root_cause(broken)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        progress.detach(spark)
    assert {p.name for p in progress.progress} >= {"watched"}
    assert sum(p.numInputRows for p in progress.progress if p.name == "watched") == 1000
    assert any("no room left" in f for f in progress.failures)


def test_raw_tap(spark, staged, envelope):
    rows = stream(spark, staged, envelope.schema, files=5)
    query = message_sinks.raw_tap(rows, "memory", "tapped", ingest.ALL_THERE_IS)
    ingest.drain(query)
    assert spark.table("tapped").columns == ["timestamp", "key", "value"]
    assert spark.table("tapped").count() == 1000


def test_source_steps_destination(spark, staged, envelope, tmp_path):
    source = FileSource(staged, schema=envelope.schema)
    steps = [history.messages, hierarchy.with_tag, lambda df: hierarchy.to_hierarchy(df, PLANT, AS_OF)]
    history.run_batch(spark, source, steps, Table(str(tmp_path / "batch")))
    query = history.run_stream(
        spark, source, steps, Table(str(tmp_path / "stream")),
        checkpoint=str(tmp_path / "c"), trigger=ingest.ALL_THERE_IS,
    )
    ingest.drain(query)
    batch, streamed = (read_table(spark, str(tmp_path / n)) for n in ("batch", "stream"))
    assert batch.count() == 1000
    assert rows_of(batch) == rows_of(streamed)
    wrong = T.StructType([T.StructField("EventTime", T.StringType())])
    with pytest.raises(ValueError, match="EventTime"):
        history.run_batch(spark, source, steps, Table(str(tmp_path / "wrong")), wrong)
    assert not (tmp_path / "wrong").exists()


def test_hot_tag_of_one_time_is_spread(spark):
    """Nine of ten rows have one tag and one time: no task gets more than its share of that tag."""
    tag = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(20_000).select("id", tag.alias("Tag"), F.timestamp_seconds(F.lit(0)).alias("EventTime"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = spread(rows, ("Tag",), 6, ()).groupBy(F.spark_partition_id()).agg(F.count_if(F.col("Tag") == "hot").alias("n"))
        sizes = [r["n"] for r in dealt.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) <= 18_000 / 2


def skewed(spark, n=400_000):
    """Nine of ten rows have one tag, dealt over many files."""
    tag = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 70).cast("string")))
    return spark.range(0, n, 1, 16).select("id", tag.alias("Tag"), F.xxhash64("id").alias("noise"))


def test_balanced_stream_splits_a_hot_tag(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "c"
    rows = skewed(spark)
    rows.write.parquet(source)
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.maxPartitionBytes": "512k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for attempt in range(2):
            if attempt:
                forget_commit(checkpoint, 0)
            stream_ = spark.readStream.schema(rows.schema).parquet(source)
            table = Table(target, partition_by=("Tag",), sort_by=("id",))
            query = ingest.drain(table.write_stream_balanced(stream_, str(checkpoint), ingest.ALL_THERE_IS))
            assert sum(p["numInputRows"] for p in query.recentProgress) == 400_000
            stored = read_table(spark, target)
            assert rows_of(stored.groupBy("Tag").count()) == rows_of(rows.groupBy("Tag").count())
            assert stored.select("id").distinct().count() == stored.count() == 400_000
            files = stored.groupBy("Tag", F.input_file_name().alias("file")).count().collect()
            assert max(r["count"] for r in files) < 400_000 / 6  # no task above its share
            # A tag of few rows is gathered into one file or two.
            assert all(sum(r["Tag"] == f"t{k}" for r in files) <= 2 for k in range(0, 70, 10))
    finally:
        for key in settings:
            spark.conf.unset(key)
    with pytest.raises(ValueError, match="holds batches"):
        table.write_stream_balanced(stream_, str(tmp_path / "other"))
    with pytest.raises(ValueError, match=BATCH):
        table.write_stream_balanced(stream_.withColumn(BATCH, F.lit(1)), str(checkpoint))


def test_cached_snapshot_sees_new_rows_next_time(spark, tmp_path):
    path = tmp_path / "table"
    spark.range(3).coalesce(1).write.parquet(str(path))
    with cached(read_table(spark, str(path))) as snapshot:
        # Another writer, whose rows this session hears nothing of.
        shutil.copy(next(path.glob("part-*.parquet")), path / "part-other.parquet")
        assert snapshot.is_cached
        assert snapshot.count() == 3
    assert not snapshot.is_cached
    with cached(read_table(spark, str(path))) as snapshot:
        assert snapshot.count() == 6


def test_compaction_keeps_rows_and_cuts_hot_partitions(spark, tmp_path):
    rows = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 7).cast("string"))).alias("Tag"),
        F.timestamp_seconds("id").alias("EventTime"),
    )
    path, target = str(tmp_path / "small"), str(tmp_path / "sorted")
    rows.repartition(40).write.partitionBy("Tag").parquet(path)
    maintenance.compact(spark, path, target, ("Tag",), ("EventTime",))
    table = read_table(spark, target)
    assert rows_of(table) == rows_of(rows)
    assert len(table.inputFiles()) < len(read_table(spark, path).inputFiles()) / 2
    ranges = (
        table.where("Tag = 'hot'")
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("id").alias("a"), F.max("id").alias("b"))
        .orderBy("a")
        .collect()
    )
    assert all(x["b"] < y["a"] for x, y in zip(ranges, ranges[1:]))
    sizes = maintenance.file_sizes(spark, target).collect()
    assert sum(r["files"] for r in sizes if "Tag=" in r["folder"]) == len(table.inputFiles())
    only = str(tmp_path / "only")
    maintenance.compact(spark, path, only, ("Tag",), ("EventTime",), only=F.col("Tag") == "t3", file_bytes=64 * 1024)
    assert {r[0] for r in read_table(spark, only).select("Tag").distinct().collect()} == {"t3"}
    small = maintenance.selected_bytes(read_table(spark, path).where("Tag = 't3'"))
    assert small < maintenance.selected_bytes(read_table(spark, path)) / 4
    # As many files as the part that is selected asks for, not the whole table.
    assert len(read_table(spark, only).inputFiles()) <= -(-small // (64 * 1024)) + 1
    only = str(tmp_path / "only-hot")
    maintenance.compact(spark, path, only, ("Tag",), only=F.col("Tag") == "hot")
    assert {r[0] for r in read_table(spark, only).select("Tag").distinct().collect()} == {"hot"}


def test_tag_lists(spark, tmp_path):
    (tmp_path / "n.json").write_text(
        '{"nodes": [{"node_id": "ns=2;s=T", "display_name": "Temp"},\n {"node_id": "ns=2;s=P"}, {"name": "x"}]}'
    )
    (tmp_path / "empty.json").write_text('{"nodes": []}')
    expected = [("ns=2;s=P", "ns=2;s=P"), ("ns=2;s=T", "Temp")]
    assert sorted(map(tuple, read_tag_list(spark, str(tmp_path / "n.json")).collect())) == expected
    assert read_tag_list(spark, str(tmp_path / "empty.json")).count() == 0
