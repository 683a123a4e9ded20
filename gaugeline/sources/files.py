"""Files and tables as sources, and settings of the store they lie in."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



@dataclass(frozen=True)
class FileSource:
    """Files below ``path``. A stream needs a schema; ``max_files_per_trigger`` caps its batches."""

    path: str
    format: str = "parquet"
    schema: T.StructType | None = None
    max_files_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        if self.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.load(self.path)

    def read_batch(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_table(spark: SparkSession, path: str, table_format: str = "parquet", **options: str) -> DataFrame:
    """Snapshot of a stored table through its own format, so that removed and uncommitted files of
    a transactional table stay out."""
    return spark.read.format(table_format).options(**options).load(path)


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The table, filled into the cache, for the length of a ``with`` block. New rows show in the next."""
    snapshot = df.persist(level)
    try:
        snapshot.count()
        yield snapshot
    finally:
        snapshot.unpersist()


def read_tag_list(spark: SparkSession, path: str) -> DataFrame:
    """Node ids and names from a ``nodes`` list in a JSON file; entries without an id are dropped."""
    schema = "nodes array<struct<node_id: string, display_name: string, name: string>>"
    nodes = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("nodes").alias("node"))
    return nodes.where("node.node_id is not null").select(
        "node.node_id",
        F.coalesce("node.display_name", "node.name", "node.node_id").alias("display_name"),
    )


def object_store_conf(
    endpoint: str,
    path_style: bool = True,
    ssl: bool = False,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Session settings for an S3-compatible store. Keys only if the caller hands them over;
    otherwise the credential provider of the cluster applies."""
    prefix = "spark.hadoop.fs.s3a."
    conf = {
        f"{prefix}impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        f"{prefix}endpoint": endpoint,
        f"{prefix}path.style.access": str(path_style).lower(),
        f"{prefix}connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key is not None and secret_key is not None:
        conf[f"{prefix}access.key"] = access_key
        conf[f"{prefix}secret.key"] = secret_key
    return conf


def delta_conf() -> dict[str, str]:
    """Session settings for ``table_format="delta"``; the jar is the submitter's to add."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }
