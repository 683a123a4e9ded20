"""Arrow and numpy helpers for lists of unequal length, such as the words of many texts."""

from __future__ import annotations

import ctypes
import functools
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at a time, so that a batch of long texts stays small in memory.
SLICE_BYTES = 2 << 20


def texts(column: pa.Array) -> pa.Array:
    """A text column without nulls: a null text is an empty one."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def strings(column: pa.Array) -> list[str]:
    """The strings of a column without nulls; several times as fast as ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


@functools.cache
def _trim():
    """The C library's call that returns free memory to the system, if it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that is free: workers outlive their tasks, and what they hold counts for later stages."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of at most ``limit`` bytes of text, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start] - sizes[start]
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
        batch = sizes = None
        give_back()


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, which equal values must follow each other in; held one group at a time."""
    held, current = [], None
    for batch in batches:
        keys = np.asarray(batch.column(key))
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
        for begin, end in zip(edges, edges[1:]):
            if held and keys[begin] != current:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            current = keys[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)]


def words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: codes of all words, the words by code, and where
    each text's codes begin (one entry more than texts)."""
    lists = pc.ascii_split_whitespace(texts(column))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    offsets -= offsets[0]
    full = np.asarray(pc.not_equal(flat, "")) if len(flat) else np.zeros(0, bool)
    if not full.all():
        flat = flat.filter(pa.array(full))
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(column: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string: the sum of its bytes, each mixed with its place, mixed again."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]].astype(np.uint64) if data else np.zeros(0, np.uint64)
    lengths, edges = np.diff(edges), edges - edges[0]
    data |= (np.arange(len(data)) - np.repeat(edges[:-1], lengths) + 1).astype(np.uint64) << np.uint64(8)
    sums = np.append(np.uint64(0), np.cumsum(mix(data * np.uint64(0x9E3779B97F4A7C15))))
    return mix(mix(sums[edges[1:]] - sums[edges[:-1]] + np.uint64(seed)) + lengths.astype(np.uint64))


def windows(codes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` codes that lie within one text, and the place of each window."""
    lengths = np.maximum(np.diff(offsets) - size + 1, 0)
    at = take(np.arange(len(codes)), offsets[:-1], lengths)
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[at + j].astype(np.uint64) + np.uint64(1))
    return out, at


def shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct word shingles of each text: the text's place in the column, a 64-bit hash and how
    often the text has it, ordered by place and hash. A text of fewer words, but some, is one shingle."""
    codes, vocabulary, offsets = words(column)
    hashes = hashed(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    values, at = windows(hashes, offsets, size)
    place = np.searchsorted(offsets, at, side="right") - 1
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = [np.bitwise_xor.reduce(mix(hashes[offsets[i]:offsets[i + 1]] + np.arange(counts[i], dtype=np.uint64))) for i in short]
        values = np.concatenate([values, mix(np.array(extra, np.uint64) + counts[short].astype(np.uint64))])
        place = np.concatenate([place, short])
    order = np.lexsort((values, place))
    values, place = values[order], place[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (place[1:] != place[:-1])
    starts = np.flatnonzero(first)
    return place[first], values[first], np.diff(np.append(starts, len(values)))


def table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def byte_characters() -> list[str]:
    """For each byte its printable character: itself where it has one, else the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return [chr(256 + others.index(b)) if b in others else chr(b) for b in range(256)]


#: Letters from here on take the longer way: which they are depends on the version of Unicode.
_LATIN = "\u0250"
#: A letter below that and the marks after it, which never share a token with it. Not so U+0130, whose
#: lower case ends in a mark.
_MARKED = "([a-zA-ZÀ-ÖØ-öø-\u012f\u0131-\u024f])([.,;:!?]+)"


def apart(column: pa.Array, separator: str) -> pa.Array:
    """Texts with ``separator`` between words and marks after them, so that a word is one string with any."""
    return pc.replace_substring_regex(column, _MARKED, rf"\1{separator}\2")


class Known:
    """Ids of strings by a tokenizer of the tokenizers library, each distinct string encoded once.

    All ids lie in one array; a string has a place in ``begins`` and ``sizes``. Beyond ``most`` strings
    the store starts afresh, which bounds its memory. ``lower`` tells that the tokenizer ignores case.

    A plain word, letters alone behind at most one space, is one match of the tokenizer's pattern, so it
    goes to the tokenizer's model as it is, in byte characters, unless offsets are wanted.
    """

    def __init__(self, tokenizer, with_offsets: bool = False, lower: bool = False, most: int = 150_000):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer, self.with_offsets, self.lower = tokenizer, with_offsets, lower
        self.bytes = str.maketrans(dict(enumerate(byte_characters())))
        self._clear()

    def _clear(self) -> None:
        self._places: dict[str, int] = {}
        self.ids, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.offsets = np.zeros((0, 2), np.int32)

    def _plain(self, string: str) -> str | None:
        """A plain word's bytes as characters."""
        letters = string[1:] if string[:1] == " " and not self.lower else string
        if self.lower:
            string = letters = letters.lower()
        if not letters.isalpha() or max(letters) >= _LATIN:
            return None
        return string.encode().decode("latin-1").translate(self.bytes)

    def _encoded(self, strings: list[str]) -> tuple[list[list[int]], np.ndarray | None]:
        if self.with_offsets:
            encoded = self.tokenizer.encode_batch(strings, add_special_tokens=False)
            spans = itertools.chain.from_iterable(itertools.chain.from_iterable(e.offsets for e in encoded))
            return [e.ids for e in encoded], np.fromiter(spans, np.int32).reshape(-1, 2)
        plain = [self._plain(s) for s in strings]
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(p)] if p else None for p in plain]
        rest = [i for i, p in enumerate(plain) if not p]
        for i, e in zip(rest, self.tokenizer.encode_batch([strings[i] for i in rest], add_special_tokens=False)):
            ids[i] = e.ids
        return ids, None

    def places(self, strings: list[str]) -> np.ndarray:
        """The place of each of some distinct strings. Places hold until the next call."""
        if len(self._places) > self.most:
            self._clear()
        new = [s for s in strings if s not in self._places]
        if new:
            ids, offsets = self._encoded(new)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._places.update(zip(new, range(len(self._places), len(self._places) + len(new))))
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum()))])
            if offsets is not None:
                self.offsets = np.concatenate([self.offsets, offsets])
        return np.fromiter(map(self._places.__getitem__, strings), np.int64, len(strings))
