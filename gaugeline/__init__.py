"""gaugeline: a telemetry historian written as Spark DataFrame transforms.

Readings arrive as JSON on a message stream, are parsed, classified, filtered and
placed in a plant hierarchy, and land in lake tables that the query functions read.
Every transform is ``DataFrame -> DataFrame`` and works in batch and in a stream.
"""

from gaugeline.session import configure, scratch_path, session

__all__ = ["configure", "scratch_path", "session"]
