"""Quality rules on how well a text compresses.

Repetitive text compresses far better than prose, and random characters, encoded bytes or keys hardly at
all. A text is compressed as a whole, which shows repetition at any distance, and in fixed chunks, which
shows a bad stretch in a long good text. Both ratios (compressed to raw bytes) must lie in a band, and
the band of the whole depends on its length, as a longer text compresses better.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged

LEVEL = 3
CHUNK_BYTES = 2048
#: Bytes below which a rest is no chunk of its own but part of the one before.
LEAST_CHUNK = 512

#: Bands of the whole text by length: up to these many bytes (the last without end), least and greatest ratio.
LENGTHS = (128, 256, 512, 1024, 2048, 4096, 8192, 16384, 65536)
LOWEST = (0.70, 0.45, 0.48, 0.46, 0.44, 0.42, 0.395, 0.38, 0.36, 0.33)
HIGHEST = (9.99, 1.05, 0.92, 0.85, 0.80, 0.78, 0.77, 0.76, 0.75, 0.75)
#: The band of a chunk, and the share of a text's bytes that may lie in chunks outside it.
CHUNK_LOWEST, CHUNK_HIGHEST, BAD_SHARE = 0.25, 0.85, 0.30

#: Limits of the base rules: words at least, and percent of words in repeated windows at most.
MIN_WORDS, MAX_REPEATED, WINDOW_WORDS = 20, 30, 8
SYMBOLS = "[#*$%&|<>]"


def ratios(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The whole text's ratio, and the share of its bytes in chunks outside the band."""
    edges = list(range(0, len(data), CHUNK_BYTES))
    if len(edges) > 1 and len(data) - edges[-1] < LEAST_CHUNK:
        edges.pop()
    bad = 0
    if len(data) >= LEAST_CHUNK:
        for begin, end in zip(edges, [*edges[1:], len(data)]):
            ratio = len(compressor.compress(data[begin:end])) / (end - begin)
            if not CHUNK_LOWEST <= ratio <= CHUNK_HIGHEST:
                bad += end - begin
    return len(compressor.compress(data)) / len(data), bad / len(data)


def in_band(size: int, ratio: float) -> bool:
    i = int(np.searchsorted(LENGTHS, size, side="left"))
    return LOWEST[i] <= ratio <= HIGHEST[i]


def _repeated_words(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each text in windows of 8 words that the text has twice or more."""
    values, at = ragged.windows(codes, offsets, WINDOW_WORDS)
    place = np.searchsorted(offsets, at, side="right") - 1
    order = np.lexsort((values, place))
    v, p = values[order], place[order]
    same = (v[1:] == v[:-1]) & (p[1:] == p[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(len(codes) + 1, np.int64)
    begins = at[order[twice]]
    np.add.at(step, begins, 1)
    np.add.at(step, begins + WINDOW_WORDS, -1)
    covered = np.append(0, np.cumsum(np.cumsum(step[:-1]) > 0))
    return covered[offsets[1:]] - covered[offsets[:-1]]


def _repeated_lines(text: str) -> int:
    """``\\n``-split lines that hold a word and equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, ratio double, bad_chunk_share double, kept boolean")


def judge(docs: DataFrame) -> DataFrame:
    """Word counts and verdict of each row of ``docs(doc_id, text)``, see :data:`COLUMNS`.

    ``base_failed`` if there are fewer than 20 words or more than 30 % of them lie in repeated windows of
    8. ``kept`` if not that, the whole text's ratio is in the band of its length, and no more than 30 % of
    its bytes are in chunks outside theirs. A null or empty text has no words, no ratio, and fails the
    base rules. Equal rows are judged alike, each on its own; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                        ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("bad_chunk_share", pa.float64()), ("kept", pa.bool_())])

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in ragged.sliced(batches):
            texts = ragged.texts(batch.column("text"))
            codes, vocabulary, offsets = ragged.words(texts)
            n_words = np.diff(offsets)
            lengths = np.append(0, np.cumsum(np.asarray(pc.utf8_length(vocabulary)).astype(np.int64)[codes]))
            repeated = _repeated_words(codes, offsets)
            symbols = pc.count_substring_regex(texts, SYMBOLS)
            failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)
            strings = ragged.strings(texts)
            found = []
            for text in strings:
                data = text.encode("utf-8", "surrogatepass")
                found.append((*ratios(data, compressor), len(data)) if data else (None, None, 0))
            kept = [not f and r is not None and in_band(size, r) and share <= BAD_SHARE for f, (r, share, size) in zip(failed, found)]
            yield ragged.table(schema, [
                batch.column("doc_id"), n_words, lengths[offsets[1:]] - lengths[offsets[:-1]], symbols.cast(pa.int64()),
                [_repeated_lines(t) for t in strings], repeated, failed, [r for r, _, _ in found], [s for _, s, _ in found], kept])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COLUMNS)
