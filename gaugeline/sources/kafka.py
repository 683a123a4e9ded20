"""Kafka source. The connector jar is the submitter's to add."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from gaugeline import fixed


@dataclass(frozen=True)
class KafkaSource:
    """``topics`` is one name or several, separated by commas. Options left at ``None`` are not set."""

    servers: str
    topics: str = fixed.TOPIC_VALUES
    starting_offsets: str = "latest"
    fail_on_data_loss: bool | None = None
    include_headers: bool | None = None
    max_offsets_per_trigger: int | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def hardened(cls, servers: str, topics: str = fixed.TOPIC_VALUES, **changes) -> KafkaSource:
        """Headers, a rate cap, and no failure when the broker has dropped old offsets."""
        settings = {
            "fail_on_data_loss": False,
            "include_headers": True,
            "max_offsets_per_trigger": fixed.MAX_OFFSETS_PER_TRIGGER,
        }
        return cls(servers, topics, **{**settings, **changes})

    def backfill(self) -> KafkaSource:
        """The same source from the first offset still held."""
        return replace(self, starting_offsets="earliest")

    def options(self) -> dict[str, str]:
        optional = {
            "failOnDataLoss": self.fail_on_data_loss,
            "includeHeaders": self.include_headers,
            "maxOffsetsPerTrigger": self.max_offsets_per_trigger,
        }
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topics,
            "startingOffsets": self.starting_offsets,
            **{name: str(value).lower() for name, value in optional.items() if value is not None},
            **self.extra,
        }

    def batch_options(self) -> dict[str, str]:
        """A batch reads from the first offset (``latest`` is no start for it) and has no triggers."""
        options = self.options()
        options.pop("maxOffsetsPerTrigger", None)
        if options["startingOffsets"] == "latest":
            options["startingOffsets"] = "earliest"
        return options

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()

    def read_batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self.batch_options()).load()
