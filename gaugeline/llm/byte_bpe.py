"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file lists the bytes of each token in the order of its merges. Bytes are written as printable
characters, as the library's byte-level step does, and the merge of each token is found again from
the ranks, so the library gives the ids that the ranks define. Decoding maps ids to their characters
and these back to bytes; a character that was split over tokens comes together again as bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged

_CUT = "\x00"
#: A space before white space or the end, where a text must not be cut; and the character that marks cuts.
_UNSAFE = r" ([\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)|\x00"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The token's bytes after all merges of lower rank than its own."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while True:
        joined = [(ranks.get(a + b, ranks[token]), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(joined, default=(ranks[token], 0))
        if rank >= ranks[token]:
            return parts
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str):
    """The library's tokenizer for the ranks in ``path`` and the characters of each id. Once a process."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, shown = read_ranks(path), ragged.byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            parts = _parts(token, ranks)
            if len(parts) != 2:
                raise ValueError(f"rank {ranks[token]} has no merge of two earlier tokens")
            merges.append((text[parts[0]], text[parts[1]]))
    tokenizer = Tokenizer(models.BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    characters = {r: text[t] for t, r in ranks.items()}
    return tokenizer, characters


class _Encoder:
    """Encodes texts, each distinct segment once. Texts are cut before single spaces and between a word and
    the marks after it: there the pattern always begins a new match, so segments may be encoded apart."""

    def __init__(self, tokenizer, with_offsets: bool = True):
        self.tokenizer, self.known = tokenizer, ragged.Known(tokenizer, with_offsets)

    def __call__(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Ids of each text, and the characters ``[begin, end)`` that each id comes from."""
        column, known = ragged.texts(column), self.known
        unsafe = np.asarray(pc.match_substring_regex(column, _UNSAFE))
        lists = pc.split_pattern(pc.replace_substring(ragged.apart(column, _CUT), " ", f"{_CUT} "), _CUT)
        coded = lists.flatten().dictionary_encode()
        keys, starts = np.asarray(coded.indices), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        segments = ragged.strings(coded.dictionary)
        places = known.places(segments)
        widths = np.fromiter(map(len, segments), np.int64, len(segments))
        for row, direct in enumerate(unsafe):
            if direct:
                whole = self.tokenizer.encode(column[row].as_py(), add_special_tokens=False)
                yield np.array(whole.ids, np.int32), np.array(whole.offsets, np.int32).reshape(-1, 2) if known.with_offsets else None
                continue
            own = keys[starts[row]:starts[row + 1]]
            begins, sizes = known.begins[places[own]], known.sizes[places[own]]
            ids, spans = ragged.take(known.ids, begins, sizes), None
            if known.with_offsets:
                spans = ragged.take(known.offsets, begins, sizes) + np.repeat(np.cumsum(widths[own]) - widths[own], sizes)[:, None]
            yield ids, spans


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, with_offsets: bool) -> _Encoder:
    """Once a process: later tasks of a worker know its segments."""
    return _Encoder(load(path, pattern)[0], with_offsets)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, with_offsets: bool = True) -> DataFrame:
    """``(doc_id, ids, begins, ends)`` of every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Position i of ``begins`` and ``ends`` holds the characters that id i covers; the parts of a split
    character all cover that character. Without offsets both are null. No special tokens. A null or
    empty text has no ids; rows that repeat an id are rows of the result too; an empty table gives none.
    ``path`` must be readable on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])

    def run(batches):
        encoder = _encoder(path, pattern, with_offsets)
        for batch in ragged.sliced(batches, limit=2 * ragged.SLICE_BYTES):
            ids, spans = zip(*encoder(batch.column("text")))
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            lists = lambda flat: pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            none = pa.nulls(len(ids), pa.list_(pa.int32()))
            begins, ends = (lists(np.concatenate([s[:, side] for s in spans]).astype(np.int32)) for side in (0, 1)) if with_offsets else (none, none)
            yield ragged.table(schema, [batch.column("doc_id"), lists(np.concatenate(ids)), begins, ends])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def token_bytes(path: str, pattern: str = public_tokenizers.PATTERN) -> list[bytes]:
    """The bytes of each id, through the reversed byte table."""
    back = {c: b for b, c in enumerate(ragged.byte_characters())}
    characters = load(path, pattern)[1]
    return [bytes(back[c] for c in characters[i]) if i in characters else b"" for i in range(max(characters) + 1)]


def _rows(column: pa.Array) -> list[list[int]]:
    """The ids of each row; a null list is empty."""
    flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _decoding(encoded: DataFrame, schema: pa.Schema, columns: str, row, path: str, pattern: str) -> DataFrame:
    """``row(ids, bytes)`` of each row of ``encoded``, a few rows at a time, for their texts' sake."""

    def run(batches):
        table = token_bytes(path, pattern)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found = [row(ids, b"".join([table[i] for i in ids])) for ids in _rows(part.column("ids"))]
                yield ragged.table(schema, [part.column("doc_id"), *zip(*found)])

    return encoded.select("doc_id", "ids").mapInArrow(run, columns)


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``(doc_id, decoded, text)`` of rows of :func:`encode`: the decoded bytes and the same as text, where
    an incomplete character shows as U+FFFD. Null ids count as none."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary()), ("text", pa.string())])
    return _decoding(encoded, schema, "doc_id long, decoded binary, text string", lambda ids, data: (data, data.decode("utf-8", "replace")), path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded, the ids decoded again."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    digits = [str(i) for i in range(1 << 16)]

    def row(ids, data):
        listed = ",".join([digits[i] if i < 1 << 16 else str(i) for i in ids])
        return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(data).hexdigest()

    encoded = encode(docs, path, pattern, with_offsets=False)
    return _decoding(encoded, schema, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row, path, pattern)
