"""The message bus and the console as destinations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class KafkaSink:
    """Takes ``topic``, ``key`` and ``value``. The connector jar is the submitter's to add."""

    servers: str
    extra: Mapping[str, str] = field(default_factory=lambda: {"kafka.acks": "all", "kafka.compression.type": "lz4"})

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.extra}

    def write_stream(self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
        writer = df.writeStream.format("kafka").options(**self.options()).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def write_batch(self, df: DataFrame) -> None:
        df.write.format("kafka").options(**self.options()).save()


def raw_tap(envelope: DataFrame, sink: str = "console", name: str | None = None, trigger: Mapping | None = None) -> StreamingQuery:
    """Show what arrives: time, key and payload as they are, untruncated."""
    writer = (
        envelope.select("timestamp", "key", "value")
        .writeStream.format(sink)
        .outputMode("append")
    )
    if sink == "console":
        writer = writer.option("truncate", "false")
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()
