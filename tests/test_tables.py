"""Layout along a curve, columns that widen, expectations that act."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeline.plans import maintenance
from gaugeline.sinks.tables import BATCH, Table
from gaugeline.sinks.widening import WideningTable
from gaugeline.sources.files import read_table
from gaugeline.streaming import ingest
from gaugeline.streaming.expectations import FAILED, Checked, Expectation, counts, flagged
from tests.test_streams import rows_of


def test_curve_keys_interleave(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (65535, 65535), (1234, 54321)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", maintenance.curve_key(F.col("a"), F.col("b")).alias("k"))
    for r in df.collect():
        assert r["k"] == int("".join(x + y for x, y in zip(f"{r['a']:016b}", f"{r['b']:016b}")), 2)


def test_files_along_the_curve_skip_on_tag_and_on_time(spark, tmp_path):
    """Many tags, one of which has a third of the rows: few files hold a tag, and few a stretch of time."""
    tag = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("t%03d", F.xxhash64("id") % 200 + 200))
    rows = spark.range(0, 120_000, 1, 8).select("id", tag.alias("Tag"), F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(86_400 * 30))).alias("EventTime"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, None), (-2, "hot", None)], "id long, Tag string, EventTime timestamp"))
    path, target = str(tmp_path / "plain"), str(tmp_path / "curve")
    rows.write.parquet(path)
    size = maintenance.selected_bytes(read_table(spark, path)) // 64
    maintenance.compact_by_curve(spark, path, target, file_bytes=size)
    table = read_table(spark, target)
    assert rows_of(table) == rows_of(rows)
    spans = table.groupBy(F.input_file_name().alias("f")).agg(
        F.min("Tag").alias("a"), F.max("Tag").alias("b"), F.min("EventTime").alias("first"), F.max("EventTime").alias("last"), F.count("*").alias("n")).collect()
    assert len(spans) >= 48 and max(r["n"] for r in spans) < 3 * 120_000 / len(spans)
    of_tag = sum(r["a"] <= "t123" <= r["b"] for r in spans if r["a"])
    moment = rows.where("id = 77").first()["EventTime"]
    of_time = sum(r["first"] <= moment <= r["last"] for r in spans if r["first"])
    assert of_tag <= len(spans) / 3 and of_time <= len(spans) / 3
    only = str(tmp_path / "only")
    maintenance.compact_by_curve(spark, path, only, only=F.col("Tag") == "t007")
    assert rows_of(read_table(spark, only)) == rows_of(rows.where("Tag = 't007'"))
    empty = str(tmp_path / "empty")
    maintenance.compact_by_curve(spark, path, empty, only=F.lit(False))
    assert spark.read.schema(rows.schema).parquet(empty).count() == 0


def test_no_task_of_a_compaction_sorts_more_than_its_rows(spark, tmp_path):
    """Rows that take few bytes in a file are many in memory: the files are far below ``file_bytes``."""
    path = str(tmp_path / "plain")
    spark.range(0, 2_500_000, 1, 4).select("id", F.lit("t").alias("Tag"), F.timestamp_seconds(F.col("id") % 1000).alias("EventTime")).write.parquet(path)
    targets = str(tmp_path / "sorted"), str(tmp_path / "curve")
    maintenance.compact(spark, path, targets[0], ("Tag",), ("EventTime",))
    maintenance.compact_by_curve(spark, path, targets[1])
    for target in targets:
        files = read_table(spark, target).groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == 2_500_000 and len(files) >= 3
        assert max(r["count"] for r in files) < 1.5 * 1_000_000


def test_columns_widen_and_never_narrow(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    table = WideningTable(str(tmp_path / "table"), partition_by=("day",))

    def run(*rows, select):
        spark.createDataFrame(rows, "id int, v string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("id int, v string").parquet(source).selectExpr("id", "concat('d', id % 2) AS day", *select)
        ingest.drain(table.write_stream(stream, checkpoint, ingest.ALL_THERE_IS))

    run((1, "7"), (2, None), select=["CAST(v AS INT) AS v"])
    run((3, "8"), select=["CAST(v AS INT) AS v"])
    run((4, "9000000000"), select=["CAST(v AS BIGINT) AS v"])
    assert table.schema(spark).simpleString() == "struct<id:int,v:bigint>"
    run((5, "1.5"), select=["CAST(v AS DOUBLE) AS v", "'new' AS extra"])
    run((6, "text"), select=["v", "'more' AS extra"])
    expected = {(1, "7", None), (2, None, None), (3, "8", None), (4, "9000000000", None), (5, "1.5", "new"), (6, "text", "more")}
    assert set(map(tuple, table.read(spark).select("id", "v", "extra").collect())) == expected
    assert {r["day"] for r in table.read(spark).collect()} == {"d0", "d1"}
    for narrow in ("CAST(v AS INT) AS v", "CAST(v AS DOUBLE) AS v"):
        with pytest.raises(ValueError, match="narrower"):
            run((7, "1"), select=[narrow])
    with pytest.raises(ValueError, match="do not widen"):
        run((7, "1"), select=["current_date() AS v"])
    assert set(map(tuple, table.read(spark).select("id", "v", "extra").collect())) == expected  # stopped before the write
    run((8, "x"), select=["v", "'z' AS extra"])  # and takes up what had come meanwhile
    assert {r["id"] for r in table.read(spark).collect()} == {1, 2, 3, 4, 5, 6, 7, 8}
    with pytest.raises(FileNotFoundError):
        WideningTable(str(tmp_path / "none")).read(spark)


def test_a_bad_batch_stops_the_query_and_loses_no_row(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    table, failing = Table(str(tmp_path / "good"), partition_by=("tag",)), Table(str(tmp_path / "bad"))

    def run(share):
        stream = spark.readStream.schema("id int, tag string, v double").option("maxFilesPerTrigger", 1).parquet(source)
        checks = [Expectation("positive", F.col("v") > 0, share), Expectation("has a tag", F.col("tag").isNotNull())]
        ingest.drain(Checked(table, failing, checks).write_stream(stream, checkpoint, ingest.ALL_THERE_IS, "checked"))

    def stored(t):
        return sorted(r["id"] for r in read_table(spark, t.path).collect())

    def arrive(*rows):
        spark.createDataFrame(rows, "id int, tag string, v double").coalesce(1).write.mode("append").parquet(source)

    arrive((1, "a", 1.0), (2, "b", -1.0), (3, None, 5.0), (4, "a", None))
    run(0.5)
    assert stored(table) == [1] and stored(failing) == [2, 3, 4]
    arrive((5, "a", -1.0), (6, "a", -2.0), (7, "c", 3.0))
    for _ in range(2):  # again the same end, and nothing doubled
        with pytest.raises(StreamingQueryException, match="batch 1 refused: positive: 2 of 3 rows fail, 0.5 may"):
            run(0.5)
        assert stored(table) == [1] and stored(failing) == [2, 3, 4, 5, 6]
    arrive((8, "d", 1.0))
    run(0.9)
    assert stored(table) == [1, 7, 8] and stored(failing) == [2, 3, 4, 5, 6]
    found = {r["id"]: r[FAILED] for r in read_table(spark, failing.path).collect()}
    assert found[2] == ["positive"] and found[3] == ["has a tag"] and found[4] == ["positive"]
    assert read_table(spark, table.path).where(F.col(BATCH).isNull()).count() == 0


def test_counts_of_nothing(spark):
    checks = [Expectation("never", F.lit(False)), Expectation("unknown", F.lit(None).cast("boolean"))]
    assert counts(flagged(spark.range(3), checks), checks) == {"rows": 3, "never": 3, "unknown": 3}
    assert counts(flagged(spark.range(0), checks), checks) == {"rows": 0, "never": 0, "unknown": 0}
    assert flagged(spark.range(1), []).first()[FAILED] == []
