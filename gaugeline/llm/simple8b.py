"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector in its top 4 bits and, below, equally many bits for each of the ids that
it packs; ids are packed until one does not fit. Ids come in blocks, and a file lists the first word of
every block, so that blocks can be decoded apart, all at once in numpy. A value too wide for any
selector is an escape: a word with the escape selector, and the value as the next word.

Layout of a file (little-endian)::

    magic "GS8B" | uint32 ids a block | uint64 ids | uint64 documents | uint64 words
    int64 doc_id of each document | uint8 1 where the doc_id is null, padded to 8 bytes
    uint32 ids of each document, padded to 8 bytes | uint32 first word of each block, padded to 8 bytes
    uint64 words

Files are rows of a table with their shard and part, written by Spark: its commit makes a lost executor's
file appear once or not at all, on any store.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.session import scratch_path

#: Fixed values of the format: ids in a word and bits for each, by selector. Selector 0 is the escape.
PACKED = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

MAGIC = b"GS8B"
BLOCK_IDS = 1024
#: Ids after which a file ends, at the next document.
FILE_IDS = 1 << 18


#: Ids that a step of packing looks at first; only very narrow ids reach further.
_NEAR = 12


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    """At least the bits of each id; one more for some of over 52 bits, where a float rounds up."""
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of unsigned ids, and the first word of each block of ``block`` ids.

    A word begins where the word before ended, so all blocks step along together. Each step looks at the
    widest of the next ids and takes the selector of most ids that all fit; the last word of a block may
    hold fewer ids than its selector allows.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    blocks = -(-n // block)
    most = PACKED[1]
    widths = np.zeros((blocks, block + most), np.uint8)  # bits of each id; past a block's end nothing is too wide
    flat = np.zeros(blocks * block, np.uint8)
    flat[:n] = _bit_lengths(ids)
    widths[:, :block] = flat.reshape(blocks, block)
    sizes = np.minimum(n - np.arange(blocks) * block, block)
    packed, bits = np.array(PACKED), np.array(BITS)
    near = 1 + np.flatnonzero(packed[1:] <= _NEAR)
    position, alive = np.zeros(blocks, np.int64), np.arange(blocks)
    begins, selectors = [], []
    while len(alive):
        at = position[alive]
        widest = np.maximum.accumulate(widths[alive[:, None], at[:, None] + np.arange(_NEAR)], axis=1)
        fits = widest[:, packed[near] - 1] <= bits[near]
        selector = np.where(fits.any(axis=1), near[fits.argmax(axis=1)], 0)
        narrow = np.flatnonzero(widest[:, -1] <= bits[near[0] - 1])  # may take more than _NEAR ids
        if len(narrow):
            far = np.arange(1, near[0])
            longer = np.maximum.accumulate(widths[alive[narrow][:, None], at[narrow][:, None] + np.arange(most)], axis=1)
            more = longer[:, packed[far] - 1] <= bits[far]
            selector[narrow] = np.where(more.any(axis=1), far[more.argmax(axis=1)], selector[narrow])
        begins.append(alive * block + at)
        selectors.append(selector)
        position[alive] = at + packed[selector]
        alive = alive[position[alive] < sizes[alive]]
    begins = np.concatenate([*begins, np.zeros(0, np.int64)])
    order = np.argsort(begins)
    begins, chosen = begins[order], np.concatenate([*selectors, np.zeros(0, np.int64)])[order]
    ends = np.minimum((begins // block + 1) * block, n)
    count = np.minimum(packed[chosen], ends - begins)
    words = chosen.astype(np.uint64) << np.uint64(60)
    width = bits[chosen].astype(np.uint64)
    more = np.flatnonzero(chosen)
    for j in range(most):
        more = more[count[more] > j]
        if not len(more):
            break
        words[more] |= ids[begins[more] + j] << (width[more] * np.uint64(j))
    escape = chosen == 0
    place = np.arange(len(words)) + np.cumsum(escape) - escape
    out = np.zeros(len(words) + int(escape.sum()), np.uint64)
    out[place] = words
    out[place[escape] + 1] = ids[begins[escape]]
    return out, place[np.searchsorted(begins, np.arange(blocks) * block)].astype(np.uint32)


def unpack(words: np.ndarray, firsts: np.ndarray, n: int, block: int = BLOCK_IDS) -> np.ndarray:
    """The ids of :func:`pack`. Only escapes are looked for word by word."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    if (words < np.uint64(1) << np.uint64(60)).any():  # the value of an escape is no word, however it looks
        for position in np.flatnonzero(selector == 0):
            if head[position]:
                head[position + 1] = False
    place = np.flatnonzero(head)
    chosen = selector[place]
    count = np.array(PACKED + (1,), np.int64)[chosen]
    # A block's last word holds what is left of the block.
    owner = np.searchsorted(firsts, place, side="right") - 1
    before = np.cumsum(count) - count
    first_word = np.searchsorted(place, firsts)
    start = before[first_word][owner] if len(place) else before
    size = np.minimum((owner + 1) * block, n) - owner * block
    count = np.minimum(count, size - (before - start))
    index = np.repeat(np.arange(len(place)), count)
    slot = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
    width = np.array(BITS + (60,), np.uint64)[chosen][index]
    values = (words[place][index] >> (width * slot.astype(np.uint64))) & ((np.uint64(1) << width) - np.uint64(1))
    escaped = chosen[index] == 0
    values[escaped] = words[place[index[escaped]] + 1]
    return values


def _padded(array: np.ndarray) -> bytes:
    data = array.tobytes()
    return data + bytes(-len(data) % 8)


def to_file(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    words, firsts = pack(ids)
    nulls = np.asarray(pc.is_null(doc_ids)).astype(np.uint8)
    return b"".join([
        MAGIC, np.uint32(BLOCK_IDS).tobytes(), np.array([len(ids), len(sizes), len(words)], "<u8").tobytes(),
        np.asarray(pc.fill_null(doc_ids, 0)).astype("<i8").tobytes(), _padded(nulls),
        _padded(sizes.astype("<u4")), _padded(firsts.astype("<u4")), words.astype("<u8").tobytes()])


def from_file(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Doc ids, how many ids each document has, and all ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a file of Simple-8b words")
    block = int(np.frombuffer(data, "<u4", 1, 4)[0])
    n, docs, n_words = (int(v) for v in np.frombuffer(data, "<u8", 3, 8))
    at = 32

    def read(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(data, kind, count, at)
        at += values.nbytes + -values.nbytes % 8
        return values

    doc_ids, nulls = read("<i8", docs), read("u1", docs)
    sizes, firsts, words = read("<u4", docs), read("<u4", -(-n // block)), read("<u8", n_words)
    return pa.array(doc_ids, mask=nulls.astype(bool)), sizes.astype(np.int64), unpack(words, firsts, n, block)


@functools.lru_cache(maxsize=1)
def _word_ids(path: str) -> _WordIds:
    """Once a process: later tasks of a worker know its words."""
    from tokenizers import Tokenizer

    return _WordIds(Tokenizer.from_file(path))


class _WordIds:
    """Ids of texts by a byte-level tokenizer that drops white space and case: each distinct word is
    encoded once. Texts that hold an added token are encoded whole, as it may span words or end within one."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.added = "|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values())
        self.known = ragged.Known(tokenizer, lower=True, most=500_000)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        column = ragged.texts(column)
        whole = np.flatnonzero(np.asarray(pc.match_substring_regex(column, self.added, ignore_case=True))) if self.added else []
        if not len(whole):
            return self._by_words(column)
        found = self.tokenizer.encode_batch([column[int(i)].as_py() for i in whole], add_special_tokens=False)
        mask = np.zeros(len(column), bool)
        mask[whole] = True
        ids, sizes = self._by_words(pc.if_else(pa.array(mask), "", column))
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, e in zip(whole, found):
            parts[i] = np.array(e.ids, ids.dtype)
        return np.concatenate(parts), np.fromiter(map(len, parts), sizes.dtype, len(parts))

    def _by_words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = ragged.apart(column, " ")
        # Case may go first where no mark could make one character of a letter in one case only.
        column = pc.if_else(pc.match_substring_regex(column, r"\p{M}"), column, pc.ascii_lower(column))
        codes, vocabulary, offsets = ragged.words(column)
        found = self.known.places(ragged.strings(vocabulary))[codes]
        sizes = self.known.sizes[found]
        counts = np.concatenate([[0], np.cumsum(sizes)])
        return ragged.take(self.known.ids, self.known.begins[found], sizes), np.diff(counts[offsets])


def files(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``(shard, part, n_ids, data)``: files of all documents in ascending doc_id order, nulls first.

    Documents are dealt out by ranges of doc_id, ties by a hash of the text, so a doc_id that very many
    rows share is still spread. ``(shard, part)`` orders the files. A file ends with the document in
    which it reaches ``FILE_IDS`` ids; a document is never split. Equal rows keep each their own entry.
    """
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())])

    def run(batches):
        encode, shard, part = _word_ids(path), TaskContext.get().partitionId(), 0
        doc_ids, sizes, ids, held = [], [], [], 0

        def flush():
            return ragged.table(schema, [[shard], [part], [held], [to_file(pa.concat_arrays(doc_ids), np.concatenate(sizes), np.concatenate(ids))]])

        for batch in ragged.sliced(batches, limit=3 * ragged.SLICE_BYTES):
            flat, counts = encode(batch.column("text"))
            ends = np.cumsum(counts + 1) - 1
            with_end = np.full(len(flat) + len(counts), end_id, np.uint32)
            keep = np.ones(len(with_end), bool)
            keep[ends] = False
            with_end[keep] = flat
            doc_ids.append(batch.column("doc_id"))
            sizes.append(counts + 1)
            ids.append(with_end)
            held += len(with_end)
            if held >= FILE_IDS:
                yield flush()
                doc_ids, sizes, ids, held, part = [], [], [], 0, part + 1
        if doc_ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return ordered.select("doc_id", "text").mapInArrow(run, "shard int, part int, n_ids long, data binary")


def documents_in(stored: DataFrame, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document in files: ``start`` counts the
    ids of all documents before it, from the ids of each file summed by shard and then over shards;
    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers."""
    columns = "shard int, part int, doc_id long, at long, n_tokens long, ids_crc32 long"
    fields = [("shard", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, part, data = (batch.column(i)[row].as_py() for i in range(3))
                doc_ids, sizes, ids = from_file(data)
                small, ends = ids.astype("<u4"), np.cumsum(sizes)
                for begin in range(0, len(sizes), 256):
                    own = slice(begin, begin + 256)
                    starts, n = ends[own] - sizes[own], len(sizes[own])
                    crcs = [zlib.crc32(small[s:e].tobytes()) for s, e in zip(starts, ends[own])]
                    found = [[shard] * n, [part] * n, doc_ids[own], starts, sizes[own], crcs]
                    if with_ids:
                        offsets = np.append(starts, ends[own][-1]) - starts[0]
                        found.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[starts[0]:ends[own][-1]].astype(np.int64))))
                    yield ragged.table(schema, found)

    heads = stored.select("shard", "part", "n_ids")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier_shards = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a writing task
    shards = heads.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier_shards), F.lit(0)).alias("before"))
    starts = heads.withColumn("within", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).join(shards, "shard")
    rows = stored.select("shard", "part", "data").mapInArrow(run, columns + ", ids array<long>" * with_ids)
    placed = rows.join(starts.select("shard", "part", (F.col("before") + F.col("within")).alias("file_start")), ["shard", "part"])
    return placed.select("doc_id", (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def write(docs: DataFrame, path: str, end_id: int, folder: str) -> None:
    """Write the files of ``docs`` to ``folder``."""
    files(docs, path, end_id).write.parquet(folder)


def digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode ``docs``, write the files to the shared scratch folder, and read back what they hold."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "simple8b")
    write(docs, path, end_id, folder)
    return documents_in(spark.read.schema("shard int, part int, n_ids long, data binary").parquet(folder), with_ids=False)
