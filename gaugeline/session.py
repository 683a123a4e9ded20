"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime SQL settings that results depend on. Everything else is left to the submitter.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A tag called "1" must come back from a partition path as text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Up to this many rows a group are kept in each input partition before the shuffle of "first n of each
    # group", so that a hot group reaches its task small.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_CONF` to a session that somebody else built."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def session(app_name: str = "gaugeline", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build a session. Hosts, credentials and sizes come from ``conf`` or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    ``spark.checkpoint.dir`` names it. Without that setting a local session gets a fresh
    temporary folder; a cluster session is refused, as a driver-local path is not shared.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="gaugeline-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that no earlier call has returned."""
    return f"{scratch_root(spark)}/gaugeline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
