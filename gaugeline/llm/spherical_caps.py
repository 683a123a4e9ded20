"""Similarity join of vectors by spherical-cap filters.

Filters are directions on the sphere, and a vector passes a filter if its angle to the direction is
small enough. The directions are a random product code: coordinates are cut into blocks, each block has
its own few random unit vectors, and a direction takes one of each block, so ``code ** blocks``
directions need only ``code * blocks`` short inner products. All directions beyond a bound are listed by
walking the blocks and dropping what can no longer reach it.

No link is lost. Let ``d`` be the angle of the least similarity. Each vector lives at its nearest
direction, at angle ``t``. If x and y are linked and ``t(x) <= t(y)``, the angle between y and the home
of x is at most ``t(x) + d <= t(y) + d``. So each vector visits all directions within ``t + d`` and
meets, in its visits, every linked vector that is as near to its own home or nearer. That order also
makes each pair come up once only.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.llm.tables import components, written

BLOCKS, CODE = 2, 64
#: Rows of a home, and of its visitors, that one comparison takes; larger buckets are cut into such parts.
PART = 256
#: Added to angles, for rounding.
SLACK = 1e-7


@functools.lru_cache(maxsize=8)
def code_vectors(dimension: int, blocks: int, code: int, seed: int) -> list[tuple[slice, np.ndarray]]:
    """Coordinates of each block and its code vectors, of length ``1 / sqrt(blocks)``. A dimension below
    the number of blocks has fewer blocks."""
    rng = np.random.default_rng([seed, dimension])
    blocks = max(1, min(blocks, dimension))
    edges = np.linspace(0, dimension, blocks + 1).astype(int)
    found = []
    for begin, end in zip(edges, edges[1:]):
        vectors = rng.standard_normal((code, end - begin))
        found.append((slice(begin, end), vectors / np.linalg.norm(vectors, axis=1, keepdims=True) / math.sqrt(blocks)))
    return found


def nearest(unit: np.ndarray, blocks: int = BLOCKS, code: int = CODE, seed: int = 1):
    """For each row of ``unit`` its nearest direction and the angle to it."""
    products = [unit[:, where] @ vectors.T for where, vectors in code_vectors(unit.shape[1], blocks, code, seed)]
    home = np.zeros(len(unit), np.int64)
    for p in products:
        home = home * code + p.argmax(axis=1)
    return home, np.arccos(np.clip(sum(p.max(axis=1) for p in products), -1, 1))


def decode(unit: np.ndarray, blocks: int = BLOCKS, code: int = CODE, reach: float = 0.0, seed: int = 1):
    """For each row of ``unit`` its home and the angle to it; and rows, filters and angles of all
    directions within that angle plus ``reach``."""
    home, angle = nearest(unit, blocks, code, seed)
    products = [unit[:, where] @ vectors.T for where, vectors in code_vectors(unit.shape[1], blocks, code, seed)]
    best = [p.max(axis=1) for p in products]
    bound = np.cos(np.minimum(angle + reach, math.pi)) - SLACK
    rows, filters, sums = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for i, p in enumerate(products):
        rest = sum(best[i + 1:], np.zeros(len(unit)))  # what later blocks can still add
        order = np.argsort(-p, axis=1, kind="stable")
        ranked = -np.take_along_axis(p, order, axis=1)
        least = bound[rows] - sums - rest[rows]
        # Entries of each row's ranked list that reach the bound: products lie in [-1, 1], so rows are
        # set 4 apart and all searched in one sorted list.
        lifted = (ranked + 4 * np.arange(len(unit))[:, None]).ravel()
        counts = np.searchsorted(lifted, np.clip(-least, -1.5, 1.5) + 4 * rows, side="right") - rows * code
        chosen = ragged.take(np.arange(code), np.zeros(len(rows), np.int64), counts)
        rows, filters, sums = (np.repeat(v, counts) for v in (rows, filters, sums))
        sums = sums - ranked[rows, chosen]
        filters = filters * code + order[rows, chosen]
    return home, angle, rows, filters, np.arccos(np.clip(sums, -1, 1))


def _rows(column: pa.Array) -> np.ndarray:
    """The vectors of one length, each scaled by a power of two, which is exact: squares of very large or
    small components must neither overflow nor vanish."""
    vectors = np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit_rows(column: pa.Array) -> np.ndarray:
    vectors = _rows(column)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch):
    """Parts of a batch whose vectors have one length."""
    sizes = np.asarray(pc.list_value_length(batch.column("v")))
    for size in np.unique(sizes):
        yield batch.take(pa.array(np.flatnonzero(sizes == size)))


def _capped(vectors: DataFrame, reach: float, blocks: int, code: int, seed: int, visits: bool) -> DataFrame:
    """``(id, label, d, home, angle)`` of ``vectors(id, label, v)``; with ``visits`` a row for each direction
    that a vector visits, with ``filter`` and the angle ``at`` to it."""
    kind = vectors.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fields = [("id", pa.int64()), ("label", batch.schema.field("label").type), ("d", pa.int32()), ("home", pa.int64()), ("angle", pa.float64())]
            schema = pa.schema(fields + [("filter", pa.int64()), ("at", pa.float64())] * visits)
            for whole in _by_length(batch):
                for begin in range(0, whole.num_rows, 512):
                    part = whole.slice(begin, 512)
                    unit = _unit_rows(part.column("v"))
                    if visits:
                        home, angle, rows, filters, at = decode(unit, blocks, code, reach, seed)
                    else:
                        home, angle = nearest(unit, blocks, code, seed)
                        rows = np.arange(len(unit))
                    own = part.take(pa.array(rows))
                    found = [own.column("id"), own.column("label"), np.full(len(rows), unit.shape[1], np.int32), home[rows], angle[rows]]
                    yield ragged.table(schema, found + ([filters, at] if visits else []))

    columns = f"id long, label {kind}, d int, home long, angle double"
    return vectors.select("id", "label", "v").mapInArrow(run, columns + ", filter long, at double" * visits)


def _compare(schema: pa.Schema, similarity: float):
    """Links of the vectors that live in a bucket part with those that visit it: ``(kind, a, b)`` with the
    copies that a document's links add (kind 0), or a link that joins components (kind 1)."""

    def block(lives, visits):
        ids_a, angle_a, n_a, a = lives
        ids_b, angle_b, n_b, b = visits
        cosine = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
        before = (angle_a[:, None] < angle_b) | ((angle_a[:, None] == angle_b) & (ids_a[:, None] < ids_b))
        linked = (cosine >= similarity) & before
        sums_a, sums_b = linked @ n_b, n_a @ linked
        yield from ((0, i, int(s)) for i, s in zip(ids_a, sums_a) if s)
        yield from ((0, i, int(s)) for i, s in zip(ids_b, sums_b) if s)
        # Connect what the links connect with one link a row: label both sides until nothing changes.
        label_a, label_b = ids_a.copy(), ids_b.copy()
        top = np.iinfo(np.int64).max
        while linked.any():
            new_a = np.minimum(label_a, np.where(linked, label_b, top).min(axis=1))
            new_b = np.minimum(label_b, np.where(linked, new_a[:, None], top).min(axis=0))
            if (new_a == label_a).all() and (new_b == label_b).all():
                break
            label_a, label_b = new_a, new_b
        yield from ((1, i, j) for i, j in zip(ids_a, label_a) if i != j)
        yield from ((1, i, j) for i, j in zip(ids_b, label_b) if i != j)

    def run(batches):
        for rows in ragged.groups(batches, "bucket"):
            lives = np.asarray(rows["lives"].combine_chunks())
            if lives.any() and not lives.all():
                sides = []
                for side in (lives, ~lives):
                    own = rows.filter(pa.array(side)).combine_chunks()
                    sides.append((np.asarray(own["id"]), np.asarray(own["angle"]), np.asarray(own["n"]), _rows(own["v"].combine_chunks())))
                found = list(block(*sides))
                if found:
                    yield ragged.table(schema, list(zip(*found)))

    return run


def similarity_join(
    rows: DataFrame, similarity: float = 0.98, blocks: int = BLOCKS, code: int = CODE, seed: int = 1
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``rows(vec_id, embedding, label)``.

    Two vectors are linked if their labels are equal and not null and their cosine, in double precision,
    is at least ``similarity``. ``n_links`` counts the other vectors so linked, ``component_id`` is the
    smallest vec_id that links reach, ``kept`` tells whether that is the vector itself. A vector that is
    null, empty, zero, or has null or non-finite components links with nothing, nor do vectors of
    different lengths. Rows that repeat a vec_id are vectors with links of their own, but have one
    component. A row without vec_id has no component and no links and is kept.
    Equal vectors are compared once. Other columns are ignored; an empty table gives an empty result.
    """
    reach = math.acos(similarity) + SLACK
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < math.inf))
    sound = F.coalesce(sound, F.lit(False))
    usable = rows.where(sound)
    # One row for equal vectors of a label; ids of these are distinct unless an input id repeats.
    unique = usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    unique = written(unique.withColumn("node", F.xxhash64("id", "label", "v")), "vectors")
    named = unique.select(F.col("node").alias("id"), "v", "label", "n")
    homes = written(_capped(named, reach, blocks, code, seed, visits=False).withColumnRenamed("home", "filter"), "homes")
    visits = _capped(named, reach, blocks, code, seed, visits=True)
    # A bucket's visitors that may meet a link there, and the parts of large buckets.
    key = ["label", "d", "filter"]
    buckets = homes.groupBy(*key).agg(F.count("*").alias("living"), F.min("angle").alias("least"), F.max("angle").alias("most"))
    coming = visits.join(buckets, key).where(f"angle >= least and at <= most + {reach + SLACK!r} and not (living = 1 and filter = home)")
    coming = written(coming.select("id", *key, "angle", "living"), "coming")
    sizes = coming.groupBy(*key).agg(F.count("*").alias("visiting"), F.first("living").alias("living"))
    sizes = sizes.withColumns({"a": F.ceil(F.col("living") / PART), "b": F.ceil(F.col("visiting") / PART)})
    sizes = written(sizes.select(*key, "a", "b"), "sizes")
    salt = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    living = homes.join(sizes, key).withColumn("i", salt("a")).withColumn("j", every("b")).withColumn("lives", F.lit(True))
    coming = coming.drop("living").join(sizes, key).withColumn("j", salt("b")).withColumn("i", every("a")).withColumn("lives", F.lit(False))
    both = living.select("id", "angle", "lives", *key, "i", "j").unionByName(coming.select("id", "angle", "lives", *key, "i", "j"))
    both = both.join(named.select("id", "v", "n"), "id").withColumn("bucket", F.xxhash64(*key, "i", "j"))
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])
    dealt = both.select("bucket", "id", "angle", "lives", "n", "v").repartition("bucket").sortWithinPartitions("bucket")
    found = written(dealt.mapInArrow(_compare(schema, similarity), "kind int, a long, b long"), "found")

    # Back from distinct vectors to ids. Components are those of ids, so a repeated id joins its vectors.
    nodes = unique.select(F.col("node").alias("a"), F.col("id").alias("id_a"))
    counts = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("more"))
    links = found.where("kind = 1").select("a", "b").distinct().join(nodes, "a").join(nodes.withColumnsRenamed({"a": "b", "id_a": "id_b"}), "b")
    joined = components(links.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    info = unique.join(counts, unique.node == counts.a, "left").join(joined, unique.id == joined.node, "left")
    info = info.select("label", "v", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = usable.join(info, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
