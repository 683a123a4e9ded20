"""Removal of repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a text: each step shifts the hash by a bit and adds a random number
that belongs to the byte, so the hash depends on the last 16 bytes only. Chunks may begin where words
begin. Of every run of ``window`` word beginnings the one with the lowest hash before it is a cut, so
cuts depend on nearby content alone, an insertion moves only the cuts next to it, and no chunk has more
than ``window`` words. Chunks that follow each other make up a passage: from each chunk on, and from each
chunk back, as few as have ``min_words`` words together. Passages are named by a digest of their bytes. All
but the first passage of a digest, by doc_id and place, are repeats and are taken out: what goes stood
together before. Passages forward and back cover any longer run of chunks that two texts share.

A passage of w words that two texts share has equal cuts in both, but for its first and last
2 * window words at most and the three or four words that fill the hash: with the defaults at least 17
words of a passage of 51 lie in whole chunks of both, enough to be a repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.llm.tables import written

#: Word beginnings of which one is a cut; words that a repeated passage has at least.
WINDOW, MIN_WORDS = 8, 16
#: Bytes that the rolling hash looks back.
ROLL = 16

_GEAR = ragged.mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint16)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of the numbers of the last 16 bytes, each shifted by its
    distance. Pairs, then fours, eights and sixteens of bytes are put together."""
    h = _GEAR[data]
    step = 1
    while step < ROLL:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint16(step)
        h = h + shifted
        step *= 2
    return h


def cuts(data: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of a text's bytes begin, and where its words begin. The first chunk begins at 0,
    with any white space before the first word."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(data) and not blank[0]:
        begins = np.append(0, begins)
    if len(begins) < 2:
        return np.zeros(min(1, len(data)), np.int64), begins
    before = gear_hash(data)[begins[1:] - 1]  # at the end of what comes before the word
    # Of equal hashes the first counts: place in the text must not decide, or shifted copies would differ.
    views = np.lib.stride_tricks.sliding_window_view(before, min(window, len(before)))
    low = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return np.append(0, begins[1:][low]), begins


def _chunks(text: str, window: int, min_words: int = MIN_WORDS):
    """The chunks of a text: its bytes, where each begins and ends, and its words. And the passages: the
    first chunk, the one after the last, and the digest of each, by place."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    starts, begins = cuts(data, window)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    counts = np.diff(np.append(np.searchsorted(begins, starts), len(begins)))
    words = np.append(0, np.cumsum(counts))
    n = len(counts)
    after = np.searchsorted(words, words[:-1] + min_words)  # forward from each chunk, n + 1 if too few follow
    before = np.searchsorted(words, words[1:] - min_words, side="right") - 1  # back from each chunk, -1 if too few
    forward, back = np.flatnonzero(after <= n), np.flatnonzero(before >= 0)
    spans = np.unique(np.concatenate([forward * (n + 1) + after[forward], before[back] * (n + 1) + back + 1]))
    first, last = spans // (n + 1), spans % (n + 1)
    digests = [xxhash.xxh3_128_digest(raw[s:e]) for s, e in zip(starts[first].tolist(), ends[last - 1].tolist())]
    return raw, starts, ends, counts, (first, last, digests)


def chunk_table(docs: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, digest, check)``: a row for each different passage of a text, the digest being 96 bits in two numbers."""
    schema = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("check", pa.int32())])

    def run(batches):
        for batch in ragged.sliced(batches):
            strings = ragged.strings(ragged.texts(batch.column("text")))
            found = [dict.fromkeys(_chunks(text, window, min_words)[-1][-1]) for text in strings]
            both = np.frombuffer(b"".join(b"".join(d) for d in found), np.int32).reshape(-1, 4)
            ids = np.repeat(np.asarray(batch.column("id")), [len(d) for d in found])
            yield ragged.table(schema, [ids, both[:, :2].copy().view(np.int64).ravel(), both[:, 2]])

    return docs.mapInArrow(run, "id long, digest long, check int")


def repeats(docs: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, digests, firsts)``: of each document the passages that an earlier document has too and, for each,
    the first such document. The lists of a document are no longer than twice its chunks.

    Passages are counted before and after the shuffle; only the digest joins them again, and many rows of
    one digest may be split by adaptive execution, as the other side has one row a digest.
    """
    chunks = chunk_table(docs, window, min_words)
    key = ["digest", "check"]
    first = chunks.groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = chunks.join(first, key).where("id > first")
    return later.groupBy("id").agg(F.collect_list(F.struct("digest", "first")).alias("found")).select(
        "id", F.col("found.digest").alias("digests"), F.col("found.first").alias("firsts"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_chunks``, ``n_removed`` chunks, ``removed_words``, ``removed_spans``
    (characters ``[begin, end)`` of ``text``) and ``first_docs`` (documents that hold the kept copies).

    The first copy, by doc_id and place in the text, stays; later ones go, being of ``min_words`` words
    at least, within a document too. Null texts stay null, empty ones and texts without words
    empty or as they are. Rows that repeat a doc_id are one document: no passage of one is a repeat of the
    other. A row without doc_id is no document's copy; only what it repeats itself goes. Columns of these
    names are replaced; an empty table stays so.
    """
    added = ["clean_text", "n_chunks", "n_removed", "removed_words", "removed_spans", "first_docs"]
    docs = docs.drop(*added, "_digests", "_firsts", "_clean")
    known = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")).where("id is not null and text is not null")
    found = written(repeats(known, window, min_words).withColumnsRenamed({"id": "doc_id", "digests": "_digests", "firsts": "_firsts"}), "repeats")
    fields = [pa.field("text", pa.string()), pa.field("n_chunks", pa.int32()), pa.field("n_removed", pa.int32()), pa.field("removed_words", pa.int32()),
              pa.field("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), pa.field("first_docs", pa.list_(pa.int64()))]

    def clean(doc_id, text: str, elsewhere, firsts):
        raw, starts, ends, counts, passages = _chunks(text, window, min_words)
        origin = dict(zip(elsewhere or [], firsts or []))
        repeated, gone, seen = np.zeros(len(starts), bool), set(), set()
        for b, e, digest in zip(*passages):
            first = origin.get(int.from_bytes(digest[:8], "little", signed=True))
            if first is not None or digest in seen:
                repeated[b:e] = True
                gone.add(doc_id if first is None else first)
            seen.add(digest)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8)))
        sizes = np.append(0, np.cumsum(counts))
        runs = list(zip(edges[::2], edges[1::2]))
        if not runs:
            return text, len(starts), 0, 0, [], []
        keep, spans, at, chars = [], [], 0, 0
        for b, e in runs:
            begin, end = int(starts[b]), int(ends[e - 1])
            kept = raw[at:begin]
            keep.append(kept)
            first_char = chars + len(kept.decode("utf-8", "surrogatepass"))
            chars = first_char + len(raw[begin:end].decode("utf-8", "surrogatepass"))
            spans.append({"begin": first_char, "end": chars})
            at = end
        keep.append(raw[at:])
        return b"".join(keep).decode("utf-8", "surrogatepass"), len(starts), sum(e - b for b, e in runs), int(sum(sizes[e] - sizes[b] for b, e in runs)), spans, sorted(gone - {None})

    @F.arrow_udf("struct<text:string,n_chunks:int,n_removed:int,removed_words:int,spans:array<struct<begin:int,end:int>>,first_docs:array<long>>")
    def cleaned(doc_id: pa.Array, text: pa.Array, elsewhere: pa.Array, firsts: pa.Array) -> pa.Array:
        kind, parts = pa.struct(fields), []
        for begin in range(0, len(text), 64):  # a few texts at a time as strings
            columns = zip(*(c.slice(begin, 64).to_pylist() for c in (doc_id, text, elsewhere, firsts)))
            rows = [clean(i, t, d, f) if t is not None else (None, 0, 0, 0, [], []) for i, t, d, f in columns]
            parts.append(pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], fields=fields))
        ragged.give_back()
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    joined = docs.join(found, "doc_id", "left")
    joined = joined.withColumn("_clean", cleaned(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("_digests"), F.col("_firsts")))
    return joined.select(*docs.columns, F.col("_clean.text").alias("clean_text"), "_clean.n_chunks", "_clean.n_removed",
                         "_clean.removed_words", F.col("_clean.spans").alias("removed_spans"), "_clean.first_docs")
