"""Options, schemas and settings, without a broker or a store."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.plans import history
from gaugeline.registered import views
from gaugeline.session import SESSION_CONF, configure, scratch_path, scratch_root
from gaugeline.sinks.messages import KafkaSink
from gaugeline.sources.files import delta_conf, object_store_conf
from gaugeline.sources.kafka import KafkaSource


def test_kafka_source_options():
    assert KafkaSource("h:1").options() == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "OPCUA", "startingOffsets": "latest"
    }
    hardened = KafkaSource.hardened("h:1", "a,b", max_offsets_per_trigger=200_000)
    assert hardened.options() == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": "200000",
    }
    assert hardened.backfill().options()["startingOffsets"] == "earliest"
    batch = hardened.batch_options()
    assert batch["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in batch


def test_kafka_sink_options():
    assert KafkaSink("h:1").options() == {
        "kafka.bootstrap.servers": "h:1", "kafka.acks": "all", "kafka.compression.type": "lz4"
    }


def test_store_settings_hold_no_credentials_of_their_own():
    conf = object_store_conf("http://store:9000")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any(key.endswith((".access.key", ".secret.key")) for key in conf)
    with_keys = object_store_conf("e", ssl=True, access_key="a", secret_key="b")
    assert with_keys["spark.hadoop.fs.s3a.secret.key"] == "b"
    assert set(delta_conf()) == {"spark.sql.extensions", "spark.sql.catalog.spark_catalog"}


def test_envelope_has_the_shape_of_the_bus(spark, small):
    envelope = views.envelope(spark, small)
    assert {f.name: f.dataType.simpleString() for f in envelope.schema} == {
        f.name: f.dataType.simpleString() for f in schemas.ENVELOPE
    }


def test_tables_have_their_schemas(spark, small):
    envelope = views.envelope(spark, small)
    rows = history.hierarchy_rows(envelope, views.PLANT, as_of=views.AS_OF, extra=False)
    assert rows.columns == schemas.HIERARCHY_TABLE.fieldNames()
    assert history.require_schema(rows, schemas.HIERARCHY_TABLE) is rows
    assert history.require_schema(history.flat_rows(envelope), schemas.FLAT_TABLE)
    with pytest.raises(ValueError, match="quality"):
        history.require_schema(history.flat_rows(envelope).drop("quality"), schemas.FLAT_TABLE)


def test_observed_counts(spark, small):
    observation = Observation("ingest")
    rows = history.observed(history.messages(views.envelope(spark, small)), observation)
    rows.write.format("noop").mode("overwrite").save()
    found = spark.read.parquet(f"{small}/events.parquet").agg(
        F.count(F.lit(1)),
        F.expr("count_if(event_id % 97 = 0 AND event_id % 101 <> 0)"),
        F.expr("count_if(event_id % 101 = 0)"),
    ).first()
    assert tuple(observation.get[k] for k in ("rows", "bad_values", "unparsable")) == tuple(found)


def test_session_settings_are_applied_to_any_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    configure(other)
    assert all(other.conf.get(key) == value for key, value in SESSION_CONF.items())


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_is_refused_on_a_cluster_without_one():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
