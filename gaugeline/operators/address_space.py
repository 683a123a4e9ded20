"""The walk of a server's address space, from its nodes and the links between them.

Nodes are found level by level from the roots. A level is one equi-join of the nodes found last with all
steps, and each node is kept when it is first reached, so circles end and a node with several parents is
one row. Steps are stored once, in buckets of their parent, so no level shuffles them again; each level is
stored too, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import fixed
from gaugeline.functions.tags import mentions_any
from gaugeline.session import scratch_path
from gaugeline.sinks.tables import bucketed

#: Columns of a walk: a node, the parent it was reached through, how far below the root, and the names down to it.
COLUMNS = "node_id string, display_name string, node_class string, parent_id string, path array<string>, depth int"


def _excluded(keywords: Sequence[str]) -> Column:
    return F.coalesce(mentions_any("display_name", keywords), F.lit(False)) if keywords else F.lit(False)


def _nodes(nodes: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """One row an id, of those whose name does not exclude them."""
    rows = nodes.where("node_id is not null").groupBy("node_id").agg(F.min(F.struct("display_name", "node_class")).alias("n"))
    return rows.select("node_id", "n.*").where(~_excluded(keywords))


def browse(
    nodes: DataFrame,
    links: DataFrame,
    roots: Sequence[str],
    keywords: Sequence[str] = fixed.INFRASTRUCTURE_KEYWORDS,
    max_depth: int | None = fixed.MAX_BROWSE_DEPTH,
    leaf_classes: Sequence[str] = ("Variable",),
) -> DataFrame:
    """``(node_id, display_name, node_class, parent_id, path, depth)`` of every node that a walk reaches.

    ``nodes`` has ``node_id``, ``display_name`` and ``node_class``, ``links`` has ``parent_id`` and
    ``child_id``; other columns are ignored. A node whose name mentions one of ``keywords``, in any case, is left out, and nothing is
    reached through it; a node without a name is kept. Nodes of ``leaf_classes`` are found, but not
    walked through. ``max_depth`` levels below the roots are walked, all with ``None``.

    ``depth`` is the least number of links from a root. ``parent_id`` is the smallest of the parents one
    level above through which the node is reached, and ``path`` the names from the root along these
    parents. Links from or to a node that is not listed, or to itself, lead nowhere; repeated links and
    nodes count once, a node listed under several names under the smallest. A root that is not listed is
    not found. The result lies in the shared scratch folder.
    """
    spark = nodes.sparkSession
    root = scratch_path(spark, "browse")
    listed = _nodes(nodes, keywords)
    first = listed.where(F.col("node_id").isin(list(roots)))
    first.withColumns({"parent_id": F.lit(None).cast("string"), "path": F.array("display_name")}).write.parquet(f"{root}/depth=0")
    steps = links.select("parent_id", F.col("child_id").alias("node_id")).where("parent_id <> node_id").distinct().join(listed, "node_id")
    with bucketed(steps, "parent_id") as stored:
        depth = 0
        while max_depth is None or depth < max_depth:
            level = _levels(spark, root, depth).where(~F.coalesce(F.col("node_class").isin(list(leaf_classes)), F.lit(False)))
            found = stored.join(level.select(F.col("node_id").alias("parent_id"), F.col("path").alias("above")), "parent_id")
            known = _levels(spark, root, *range(depth + 1)).select("node_id")
            depth += 1
            reached = found.join(known, "node_id", "left_anti").groupBy("node_id", "display_name", "node_class").agg(
                F.min("parent_id").alias("parent_id"), F.min_by("above", "parent_id").alias("above"))
            path = F.concat("above", F.array("display_name")).alias("path")
            reached.select("node_id", "display_name", "node_class", "parent_id", path).write.parquet(f"{root}/depth={depth}")
            if _levels(spark, root, depth).isEmpty():
                break
    return spark.read.schema(COLUMNS).parquet(root)


def _levels(spark: SparkSession, root: str, *depths: int) -> DataFrame:
    return spark.read.schema(COLUMNS.rpartition(",")[0]).parquet(*[f"{root}/depth={depth}" for depth in depths])


def unreached(nodes: DataFrame, browsed: DataFrame) -> DataFrame:
    """Listed nodes that the walk has not found: orphans, and those below an excluded or a leaf node."""
    return _nodes(nodes, ()).join(browsed.select("node_id"), "node_id", "left_anti")


def below(browsed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Nodes on or below the node at the path ``names`` from the root."""
    return browsed.where(F.slice("path", 1, len(names)) == F.array(*map(F.lit, names)))
