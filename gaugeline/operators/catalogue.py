"""The tag catalogue: filters on it, and joins of readings with it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions.tags import mentions_any, namespace_index


def namespace_list(text: str | None) -> list[int]:
    """Namespace numbers of a comma-separated setting; text that is no list of numbers means none."""
    try:
        return [int(item) for item in (text or "").split(",") if item.strip()]
    except ValueError:
        return []


def allow_namespaces(catalogue: DataFrame, namespaces: str | Iterable[int] | None) -> DataFrame:
    """Ids in one of the namespaces; an empty list keeps everything."""
    wanted = namespace_list(namespaces) if isinstance(namespaces, str) or namespaces is None else list(namespaces)
    return catalogue.where(namespace_index("node_id").isin(wanted)) if wanted else catalogue


def drop_keywords(catalogue: DataFrame, keywords=fixed.INFRASTRUCTURE_KEYWORDS, column: str = "display_name") -> DataFrame:
    """Names that mention none of the keywords, in any case. A NULL name is kept."""
    return catalogue.where(~F.coalesce(mentions_any(column, keywords), F.lit(False)))


def namespaced_only(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(F.col("node_id").startswith("ns="))


def of_node_class(catalogue: DataFrame, node_class: str = "Variable") -> DataFrame:
    return catalogue.where(F.col("node_class") == node_class)


def cap(catalogue: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` nodes by id; 0 means all."""
    return catalogue.orderBy("node_id").limit(limit) if limit else catalogue


def drop_subtrees(
    catalogue: DataFrame, keywords=fixed.INFRASTRUCTURE_KEYWORDS, max_depth: int | None = fixed.MAX_BROWSE_DEPTH
) -> DataFrame:
    """Nodes with no excluded step on their path, at most ``max_depth`` levels below the root. A node
    whose path is not known, as from a tag list, is kept."""
    excluded = F.exists("path", lambda step: F.coalesce(mentions_any(step, keywords), F.lit(False)))
    rows = catalogue.where(~F.coalesce(excluded, F.lit(False)))
    return rows if max_depth is None else rows.where(F.coalesce(F.size("path") <= max_depth + 1, F.lit(True)))


def diagnostics_branch(catalogue: DataFrame, include: bool = False) -> DataFrame:
    """Without ``include``, drop variables that sit below a step named for diagnostics, at any depth. A
    path or step that is not known excludes nothing."""
    if include:
        return catalogue
    above = F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0)))
    below = F.exists(above, lambda step: F.coalesce(step.contains("Diagnostics"), F.lit(False)))
    return catalogue.where(~F.coalesce(below, F.lit(False)))


def device_variables(catalogue: DataFrame, device: str, include_diagnostics: bool = False) -> DataFrame:
    """Variables directly below the step ``device``; with ``include_diagnostics`` also those directly
    below a step of it named for diagnostics. Nodes without a path are none of these."""
    step = lambda back: F.try_element_at("path", F.lit(-back))
    direct = step(2) == device
    diagnostics = step(2).contains("Diagnostics") & (step(3) == device)
    wanted = direct | diagnostics if include_diagnostics else direct
    return of_node_class(catalogue).where(F.coalesce(wanted, F.lit(False)))


def tags_to_sample(catalogue: DataFrame) -> DataFrame:
    """Variables that carry process data: no infrastructure, no method arguments, namespaced id."""
    rows = of_node_class(namespaced_only(catalogue))
    return drop_keywords(rows, fixed.INFRASTRUCTURE_KEYWORDS + fixed.METHOD_KEYWORDS)


def _one_name_per_id(catalogue: DataFrame, column: str) -> DataFrame:
    """A node listed twice must not double its readings."""
    return catalogue.where(F.col("node_id").isNotNull()).groupBy("node_id").agg(F.min(column).alias("catalogue_name"))


def with_display_name(readings: DataFrame, catalogue: DataFrame, target: str = "display_name") -> DataFrame:
    """Name of each reading's node from the catalogue, the node id where it has none.

    A plain equi-join, also of a stream with the stored catalogue: Spark broadcasts a catalogue that it
    knows to be small, and adaptive execution splits a node with very many readings.
    """
    names = _one_name_per_id(catalogue, "display_name")
    columns = [name for name in readings.columns if name != target]
    joined = readings.select(*columns).join(names, "node_id", "left")
    return joined.select(*columns, F.coalesce("catalogue_name", "node_id").alias(target))


def allow_listed(readings: DataFrame, allowed: DataFrame, column: str = "node_id") -> DataFrame:
    """Rows whose id is in the table ``allowed``."""
    return readings.join(allowed.select(column).distinct(), column, "left_semi")


def coverage(catalogue: DataFrame, readings: DataFrame) -> DataFrame:
    """How many catalogue nodes there are, and how many of them report."""
    reporting = readings.select("node_id").distinct().withColumn("reports", F.lit(True))
    nodes = catalogue.select("node_id").distinct()
    return nodes.join(reporting, "node_id", "left").agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if("reports").alias("subscribed"),
    )
