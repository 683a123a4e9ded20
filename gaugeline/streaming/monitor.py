"""Progress of streaming queries."""

from __future__ import annotations

import collections
import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Logs every batch of every query of a session and holds the last few reports."""

    def __init__(self, held: int = 1000):
        self.progress = collections.deque(maxlen=held)
        self.failures = collections.deque(maxlen=held)

    def onQueryStarted(self, event):
        log.info("started %s %s", event.name, event.id)

    def onQueryProgress(self, event):
        self.progress.append(event.progress)
        log.info("progress (%s): %s", event.progress.name, event.progress.json)

    def onQueryIdle(self, event):
        log.info("idle %s", event.id)

    def onQueryTerminated(self, event):
        if event.exception:
            self.failures.append(event.exception)
            log.error("ended %s: %s", event.id, event.exception)
        else:
            log.info("ended %s", event.id)

    def attach(self, spark: SparkSession) -> ProgressLog:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)
