"""Near-duplicate texts by DartMinHash signatures and banded joins.

Each element of a weighted set owns a region of the plane, from 0 to its weight along one axis and over
all ranks along the other. Darts fall on the plane at places that only a hash of the element decides,
one a unit of area on average. A dart hits a set if it lies below the element's weight. Every dart
belongs to one of k coordinates, and a signature keeps the dart of lowest rank for each. Two sets agree
in a coordinate with a probability equal to their weighted Jaccard similarity. Only ranks up to a limit
have to be looked at: about k ln k darts a set, however many elements it has.

Texts are sets of word shingles. Signatures are cut into bands, texts that agree in a band are
candidates, and candidates are compared by their whole texts. A group of very many near copies is not
expanded into pairs. All members of a bucket are compared with one of them, the hub, and merged, and what
stays apart with a pivot of its own, a few rounds long. Of the pairs that are not connected by then, only
those are compared that may be similar, which follows from how each differs from their hub.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.llm.tables import bucketed, components, discard, written

COORDINATES, BAND_ROWS = 240, 6
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Rounds in which bucket members are compared with one pivot only, before all that is left is compared.
PIVOT_ROUNDS = 3
#: Bytes of the bitmap of what sets two texts apart; rows of a family that are compared at a time.
BITMAP, FAMILY_PART = 128, 512

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_CELLS = 1 << 18


@functools.cache
def _poisson() -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2 ... darts in a unit of area."""
    return np.cumsum([math.exp(-1) / math.factorial(n) for n in range(20)])


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _throw(out: np.ndarray, sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, limits: np.ndarray, seed: int) -> None:
    """Lower ``out[set, coordinate]`` to the lowest dart below each set's rank limit. The plane is cut in
    slabs of weight [0, 1), [1, 2), [2, 4) ..., and these in cells of area one along the ranks."""
    k = out.shape[1]
    slab, low, width = 0, 0.0, 1.0
    while len(elements):
        rows = np.flatnonzero(weights > low)
        if not len(rows):
            return
        cells = np.ceil(limits[sets[rows]] * width).astype(np.int64)
        ends = np.cumsum(cells)
        begin = 0
        while begin < len(rows):  # so many elements that their cells fit in memory
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _CELLS, side="right")))
            own = np.repeat(rows[begin:end], cells[begin:end])
            cell = np.arange(len(own)) - np.repeat(np.cumsum(cells[begin:end]) - cells[begin:end], cells[begin:end])
            place = ragged.mix(ragged.mix(elements[own] + np.uint64(seed * 1000 + slab)) + cell.astype(np.uint64))
            darts = np.searchsorted(_poisson(), _unit(ragged.mix(place)), side="right")
            own, cell, place = (np.repeat(v, darts) for v in (own, cell, place))
            number = np.arange(len(own)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = ragged.mix(place + (number + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            rank = (cell + _unit(dart)) / width
            hit = rank < limits[sets[own]]
            second = ragged.mix(dart)
            hit &= low + width * _unit(second) < weights[own]
            own, rank, second = own[hit], rank[hit], ragged.mix(second[hit])
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | second >> np.uint64(32)
            np.minimum.at(out.reshape(-1), sets[own] * k + (second % np.uint64(k)).astype(np.int64), value)
            begin = end
        slab, low, width = slab + 1, low + width, max(1.0, low + width)


def signatures(sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int = COORDINATES, seed: int = 1) -> np.ndarray:
    """DartMinHash signatures (n x k) of n weighted sets, given as rows of set number, element hash and
    weight above 0; each element once a set. A set without elements keeps the highest value everywhere."""
    out = np.full((n, k), _NONE)
    totals = np.bincount(sets, weights, n) if len(sets) else np.zeros(n)
    limits = np.divide(k * (math.log(k) + 2), totals, out=np.zeros(n), where=totals > 0)
    todo = totals > 0
    while todo.any():
        own = todo[sets]
        _throw(out, sets[own], elements[own], weights[own], limits, seed)
        todo &= (out == _NONE).any(axis=1)  # a coordinate without a dart: look at twice as many ranks
        limits = np.where(todo, limits * 2, limits)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    n, k = signature.shape
    bands = signature[:, : k // rows * rows].reshape(n, k // rows, rows)
    keys = np.broadcast_to(np.arange(k // rows, dtype=np.uint64), (n, k // rows)).copy()
    for j in range(rows):
        keys = ragged.mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j])
    return keys


def sketch(docs: DataFrame, k: int, rows: int, words: int, weight: str, seed: int) -> DataFrame:
    """``(id, digest, bands)`` of each row of ``docs(id, text)``; no bands for a text without words."""
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in ragged.sliced(batches):
            sets, elements, counts = ragged.shingles(batch.column("text"), words)
            weights = counts.astype(float) if weight == "count" else np.ones(len(counts))
            keys = band_keys(signatures(sets, elements, weights, batch.num_rows, k, seed), rows).view(np.int64)
            some = np.bincount(sets, minlength=batch.num_rows) > 0
            bands = [row if full else None for row, full in zip(keys, some)]
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()[:16] for t in ragged.texts(batch.column("text")).to_pylist()]
            yield ragged.table(schema, [batch.column("id"), digests, bands])

    return docs.mapInArrow(run, "id long, digest binary, bands array<long>")


def _compared(pairs: DataFrame, texts: DataFrame, words: int, weight: str) -> DataFrame:
    """Pairs ``(id, hub)`` with what their whole texts share: ``shared`` shingles, ``missing`` ones that only
    the hub has, ``added`` ones that only the other has, and a bitmap ``bits`` of the last two."""
    schema = pa.schema([("id", pa.int64()), ("hub", pa.int64()), ("shared", pa.int64()), ("missing", pa.int64()), ("added", pa.int64()), ("bits", pa.binary())])

    def run(batches):
        for batch in batches:
            sizes = np.asarray(pc.add(pc.binary_length(batch.column("t")), pc.binary_length(batch.column("h")))).astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // ragged.SLICE_BYTES)) + 1
            for part in (batch.slice(s, e - s) for s, e in zip([0, *cuts], [*cuts, batch.num_rows])):
                n = part.num_rows
                if not n:
                    continue
                both = pa.concat_arrays([ragged.texts(part.column("t")), ragged.texts(part.column("h"))])
                sets, elements, counts = ragged.shingles(both, words)
                counts = counts if weight == "count" else np.ones(len(counts), np.int64)
                pair, of_hub = sets % n, sets >= n
                order = np.lexsort((of_hub, elements, pair))
                pair, elements, counts, of_hub = pair[order], elements[order], counts[order], of_hub[order]
                second = np.zeros(len(pair), bool)  # the hub's row of an element that both have
                second[1:] = (pair[1:] == pair[:-1]) & (elements[1:] == elements[:-1])
                first = np.append(second[1:], False)[: len(pair)]
                same = np.zeros(len(pair), np.int64)
                at = np.flatnonzero(second)
                same[at] = same[at - 1] = np.minimum(counts[at], counts[at - 1])
                more = counts - same  # copies that the other text lacks
                shared = np.bincount(pair[first], same[first], n)
                missing, added = np.bincount(pair, more * of_hub, n), np.bincount(pair, more * ~of_hub, n)
                copies = np.repeat(np.arange(len(pair)), more)
                number = np.arange(len(copies)) - np.repeat(np.cumsum(more) - more, more)
                bit = ragged.mix(elements[copies] * np.uint64(2) + of_hub[copies] + ragged.mix(number.astype(np.uint64))) % np.uint64(8 * BITMAP)
                bits = np.zeros((n, 8 * BITMAP), np.uint8)
                bits[pair[copies], bit.astype(np.int64)] = 1
                packed = np.packbits(bits, axis=1)
                yield ragged.table(schema, [part.column("id"), part.column("hub"), shared.astype(np.int64), missing.astype(np.int64), added.astype(np.int64), [row.tobytes() for row in packed]])

    # ``texts`` lies in buckets by id and is not shuffled; only the texts of pairs are. Many pairs of one
    # hub lie in one shuffled partition of the last join, which adaptive execution may split.
    hubs = texts.join(pairs.select(F.col("hub").alias("id")).distinct(), "id", "left_semi").withColumnsRenamed({"id": "hub", "text": "h"})
    joined = pairs.join(texts.withColumnRenamed("text", "t"), "id").join(hubs, "hub")
    return joined.select("id", "hub", "t", "h").mapInArrow(run, "id long, hub long, shared long, missing long, added long, bits binary")


def _links_of(compared: DataFrame, similarity: float) -> DataFrame:
    union = F.col("shared") + F.col("missing") + F.col("added")
    return compared.where((union > 0) & (F.col("shared") >= similarity * union - 1e-9)).select(F.col("id").alias("a"), F.col("hub").alias("b"))


def _possible(families: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(id, hub)`` of a family that are in different components and may be similar.

    All of a family have been compared with its hub H. Two of them, x and y, share
    ``|H| - missing(x) - missing(y)`` shingles and those that both lack or both add to H, of which their
    bitmaps bound the number. Only pairs that this allows to be similar come out, so a large family of
    near copies costs a product of small matrices and hardly any rows. Large families come in parts.
    """
    schema = pa.schema([("id", pa.int64()), ("hub", pa.int64())])

    def side(rows):
        bits = np.unpackbits(np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
        number = {name: np.asarray(rows[name].combine_chunks()) for name in ("id", "component", "size", "missing", "added")}
        return bits, number, number["missing"] + number["added"] - bits.sum(axis=1)

    def run(batches):
        for rows in ragged.groups(batches, "block"):
            part = np.asarray(rows["part"].combine_chunks())
            low, high = rows.filter(pa.array(part == part.min())), rows.filter(pa.array(part == part.max()))
            if np.asarray(rows["two"].combine_chunks())[0] and part.min() == part.max():
                continue  # of two parts of a family only one has rows here
            (x, a, hidden_a), (y, b, hidden_b) = side(low), side(high)
            both = x @ y.T + np.minimum(hidden_a[:, None], hidden_b)
            shared = a["size"][:, None] - a["missing"][:, None] - b["missing"] + both
            total = (a["size"] - a["missing"] + a["added"])[:, None] + (b["size"] - b["missing"] + b["added"])
            may = (shared >= similarity * (total - shared) - 1e-6) & (a["component"][:, None] != b["component"])
            i, j = np.nonzero(may)
            first, second = a["id"][i], b["id"][j]
            pairs = np.unique(np.stack([np.minimum(first, second), np.maximum(first, second)]), axis=1)
            yield ragged.table(schema, [pairs[0], pairs[1]])

    sizes = families.groupBy("hub").agg(F.count("*").alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    parted = families.join(sizes.select("hub", F.ceil(F.col("n") / FAMILY_PART).alias("parts")), "hub")
    parted = parted.withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    parted = parted.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    parted = parted.withColumn("block", F.xxhash64("hub", low, high)).withColumn("two", low != high)
    dealt = parted.select("block", "part", "two", "id", "component", "size", "missing", "added", "bits")
    return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(run, "id long, hub long")


def near_duplicates(
    docs: DataFrame, k: int = COORDINATES, rows: int = BAND_ROWS, words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY, weight: str = "presence", seed: int = 1,
) -> DataFrame:
    """Classes of near-duplicate texts: ``(doc_id, text_id, class_id, n_copies, kept)`` for each row of ``docs``.

    Two texts are linked if their sets of ``words``-word shingles have a Jaccard similarity of at least
    ``similarity``; with ``weight="count"`` shingles weigh as often as they occur. A class is a connected
    component of links, ``class_id`` its smallest doc_id. ``text_id`` is the smallest doc_id with the same
    text, ``n_copies`` how many rows have that text. ``kept`` marks the one document of a class to keep.

    A link at exactly 0.8 is found with probability 1 - (1 - 0.8 ** rows) ** (k / rows), 0.999995 by
    default; no pair below the similarity is linked. Texts of fewer words than a shingle are one shingle.
    Texts without words, null ones too, link with nothing: each is its own class. Rows that repeat a
    doc_id count as one document: they are classed alike. A row without doc_id is kept, in no class.
    Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    known = docs.where("id is not null")
    drawn = written(sketch(known, k, rows, words, weight, seed), "sketch")
    digests = drawn.where("bands is not null").groupBy("digest").agg(F.min("id").alias("text_id"), F.count("*").alias("n_copies"))
    classed = written(drawn.select("id", "digest").join(digests, "digest", "left").select(
        "id", F.coalesce("text_id", "id").alias("text_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")), "texts")

    # Band rows of one document a text, without buckets of one.
    single = drawn.join(digests.withColumnRenamed("text_id", "id"), ["digest", "id"], "left_semi")
    banded = single.select(F.explode("bands").alias("key"), "id")
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = written(banded.join(shared, "key", "left_semi").distinct(), "members")
    with bucketed(known.join(members.select("id").distinct(), "id", "left_semi"), "id") as texts:
        links = _linked(classed, members, texts, words, similarity, weight)
    found = components(links)
    named = classed.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "text_id", F.coalesce("component", "id").alias("class_id"), "n_copies")
    none = F.lit(None).cast("long")
    unnamed = docs.where("id is null").select("id", none.alias("text_id"), none.alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    return named.unionByName(unnamed).select(
        F.col("id").alias("doc_id"), "text_id", "class_id", "n_copies",
        F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


def _linked(classed: DataFrame, members: DataFrame, texts: DataFrame, words: int, similarity: float, weight: str) -> DataFrame:
    """Links ``(a, b)`` that connect what the links of all candidate pairs connect."""
    links = classed.where("id <> text_id").select(F.col("id").alias("a"), F.col("text_id").alias("b")).distinct()
    # All members of a bucket with its hub; two members of a bucket are always of one hub's family.
    hubs = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("hub"))
    used: list[str] = []
    pairs = written(members.join(hubs, "key").where("id <> hub").select("id", "hub").distinct(), "pairs", used)
    compared = written(_compared(pairs, texts, words, weight), "compared", used)
    links = links.unionByName(_links_of(compared, similarity))
    for turn in range(1, PIVOT_ROUNDS):
        found = components(links)
        states = members.join(found.withColumnRenamed("node", "id"), "id", "left")
        states = written(states.select("key", "id", F.coalesce("component", "id").alias("component")), "states", used)
        # What is not in the component with most members of its bucket meets a pivot of its own kind.
        sizes = states.groupBy("key", "component").agg(F.count("*").alias("n"))
        main = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("main")).where("parts > 2")
        rest = states.join(main.select("key", "main"), "key").where("component <> main")
        pivots = rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "component")).alias("p"))
        pairs = rest.join(pivots, "key").where("component <> p.component").select("id", F.col("p.id").alias("hub")).distinct()
        more = _links_of(_compared(written(pairs, "pairs", used), texts, words, weight), similarity)
        links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    found = components(links)
    families = compared.withColumn("size", F.col("shared") + F.col("missing")).select("hub", "id", "size", "missing", "added", "bits")
    none = F.lit(0).cast("long")
    centres = families.select("hub", F.col("hub").alias("id"), "size", none.alias("missing"), none.alias("added"), F.lit(bytes(BITMAP)).alias("bits")).distinct()
    families = families.unionByName(centres).join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    pairs = written(_possible(families, similarity).distinct(), "pairs", used)
    more = _links_of(_compared(pairs, texts, words, weight), similarity)
    links = written(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "links")
    discard(links.sparkSession, used)
    return links
