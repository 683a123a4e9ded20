"""Byte-level BPE by a heap of merge ranks over a linked list of symbols.

A tokenizer file of the tokenizers library gives the vocabulary, the merges in order of rank, the added
tokens and the rule that parts a text in matches. Each match is encoded here: its bytes are symbols of a
doubly linked list, and a heap holds the rank and place of each pair that may be merged. The least
entry is merged if its pair still stands at its place, and skipped as stale otherwise; a merge makes two
new neighbours and so at most two new entries. A match of n bytes takes O(n log n) steps however long it
is. Decoding puts the strings of the vocabulary one after the other.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged

_CUT = "\x00"
#: A space before white space or the end, where a text must not be cut; and the character that marks cuts.
_UNSAFE = r" ([\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)|\x00"
#: Settings of the file under which ids depend on its vocabulary, merges and byte-level matches alone.
_PLAIN = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


class Bpe:
    """Vocabulary, merges and added tokens of a file. Files whose ids depend on more are refused."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        model, cutter = settings["model"], settings["pre_tokenizer"] or {}
        if model["type"] != "BPE" or any((model.get(k) or v) != v for k, v in _PLAIN.items()):
            raise ValueError("not a plain BPE model")
        if settings["normalizer"] or cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("texts must go to the byte-level matches as they are")
        added = settings["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("an added token must be literal text")
        vocabulary = model["vocab"]
        self.width = 1 + max(itertools.chain(vocabulary.values(), (t["id"] for t in added)))
        self.bytes = [vocabulary[c] for c in ragged.byte_characters()]
        self.ranks, self.joined = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[a] * self.width + vocabulary[b]] = rank
            self.joined.append(vocabulary[a + b])
        back = {c: b for b, c in enumerate(ragged.byte_characters())}
        self.added = {t["content"]: t["id"] for t in added}
        self.strings = [b""] * self.width  # bytes of each id; an id without a token has none
        for text, i in itertools.chain(vocabulary.items(), self.added.items()):
            self.strings[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
        self.literal = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.cutter = Tokenizer.from_file(path).pre_tokenizer

    def merge(self, data: bytes) -> list[int]:
        """Ids of one match."""
        ids, ranks, width, n = [self.bytes[b] for b in data], self.ranks, self.width, len(data)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []  # rank and place of a pair's left symbol in one number; the least rank first, then the leftmost
        for i in range(n - 1):
            rank = ranks.get(ids[i] * width + ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if ids[i] < 0 or j == n or ranks.get(ids[i] * width + ids[j]) != rank:
                continue  # stale: one of the pair has been merged since
            ids[i], ids[j] = self.joined[rank], -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                rank = ranks.get(ids[i] * width + ids[k])
                if rank is not None:
                    heapq.heappush(queue, rank * n + i)
            if h >= 0:
                rank = ranks.get(ids[h] * width + ids[i])
                if rank is not None:
                    heapq.heappush(queue, rank * n + h)
        return [i for i in ids if i >= 0]

    def matches(self, text: str) -> list[str]:
        """The matches and added tokens that a text consists of."""
        found = []
        for piece in re.split(f"({self.literal})", text) if self.literal else [text]:
            if piece in self.added:
                found.append(piece)
            elif piece:
                found += [piece[b:e] for _, (b, e) in self.cutter.pre_tokenize_str(piece)]
        return found


class _Store(ragged.Known):
    """Ids of distinct segments of texts, each merged once."""

    def __init__(self, bpe: Bpe):
        super().__init__(bpe)
        self.back = str.maketrans({c: b for b, c in enumerate(ragged.byte_characters())})

    def _bytes(self, match: str) -> bytes:
        return match.translate(self.back).encode("latin-1")

    def _encoded(self, strings: list[str]) -> tuple[list[list[int]], None]:
        bpe, found = self.tokenizer, []
        for string in strings:
            word = string[1:] if string[:1] == " " else string
            if string in bpe.added:
                found.append([bpe.added[string]])
            elif word.isalpha() and max(word) < ragged._LATIN:  # letters behind at most one space are one match
                found.append(bpe.merge(string.encode()))
            else:
                found.append([i for match, _ in bpe.cutter.pre_tokenize_str(string) for i in bpe.merge(self._bytes(match))])
        return found, None


class _Encoder:
    """Encodes texts. A text is cut before single spaces and between a word and the marks after it: a match
    always begins there, so the segments may be encoded apart, each distinct one once. A text with other
    spaces or added tokens is cut in its matches."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.store = bpe, _Store(bpe)
        self.unsafe = f"{_UNSAFE}|{bpe.literal}" if bpe.literal else _UNSAFE

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        column = ragged.texts(column)
        unsafe = pc.match_substring_regex(column, self.unsafe)
        rows = np.flatnonzero(np.asarray(unsafe))
        column, whole = pc.if_else(unsafe, "", column), column
        lists = pc.split_pattern(pc.replace_substring(ragged.apart(column, _CUT), " ", f"{_CUT} "), _CUT)
        coded = lists.flatten().dictionary_encode()
        keys, starts = np.asarray(coded.indices), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        segments = ragged.strings(coded.dictionary)
        codes = {}
        if len(rows):
            code = {s: i for i, s in enumerate(segments)}
            for row in rows.tolist():
                codes[row] = np.array([code.setdefault(m, len(code)) for m in self.bpe.matches(whole[row].as_py())], np.int64)
            segments = list(code)
        places = self.store.places(segments)
        begins, sizes = self.store.begins[places], self.store.sizes[places]
        for row in range(len(column)):
            own = codes[row] if row in codes else keys[starts[row]:starts[row + 1]]
            yield ragged.take(self.store.ids, begins[own], sizes[own])


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    """Once a process: later tasks of a worker know its segments."""
    return _Encoder(load(path))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows of bounded size with the ids of each."""
    encode = _encoder(path)
    for batch in ragged.sliced(batches, limit=2 * ragged.SLICE_BYTES):
        yield batch, list(encode(batch.column("text")))


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` of every row of ``docs`` (``doc_id``, ``text``; other columns are ignored, whatever
    their names), with the ids that the tokenizers library gives for the file ``path``.

    No special tokens are put in; the text of an added token is that token. A null or empty text has no
    ids. Rows that repeat an id or a text, or have no id, are rows of the result too; an empty table gives
    none. Texts are encoded whole at any length, a few at a time up to some megabytes, a longer one alone.
    ``path`` must be readable on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for batch, ids in _encoded(batches, path):
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            yield ragged.table(schema, [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))])

    return _input(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of rows ``(doc_id, ids)``: the ids' strings one after the other, added tokens
    among them. Bytes that make no character show as U+FFFD. Null ids, and ids that the vocabulary lacks,
    give nothing."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        bpe = load(path)
        known = range(bpe.width)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):  # a few texts at a time
                part = batch.slice(begin, 64)
                texts = [_text(bpe, [i for i in ids or () if i in known]) for ids in part.column("ids").to_pylist()]
                yield ragged.table(schema, [part.column("doc_id"), texts])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def _text(bpe: Bpe, ids: list[int]) -> str:
    return b"".join(map(bpe.strings.__getitem__, ids)).decode("utf-8", "replace")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded as by :func:`encode`, its ids
    decoded as by :func:`decode`, in one pass. Rows are as in :func:`encode`."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = load(path)
        digits = [str(i) for i in range(bpe.width)]
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch, found in _encoded(batches, path):
            lists = [ids.tolist() for ids in found]
            yield ragged.table(schema, [
                batch.column("doc_id"), list(map(len, lists)),
                [digest(",".join(map(digits.__getitem__, ids))) for ids in lists], [digest(_text(bpe, ids)) for ids in lists]])

    return _input(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
