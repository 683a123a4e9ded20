"""Folder operations through Hadoop, so that they work on any store Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; empty where there is no such path."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, found by one call to the store's listing."""
    hadoop_path, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop_path) or [])


def file_count(spark: SparkSession, path: str) -> int:
    hadoop_path, fs = _path(spark, path)
    return fs.getContentSummary(hadoop_path).getFileCount()


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and the latest change below a path: tells whether a table is still the same."""
    hadoop_path, fs = _path(spark, path)
    files = [s for s in fs.listStatus(hadoop_path) if s.isFile()]
    return len(files), sum(s.getLen() for s in files), max((s.getModificationTime() for s in files), default=0)


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small settings file."""
    return spark.read.text(path, wholetext=True).first()[0]
