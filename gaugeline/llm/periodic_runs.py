"""Periodic runs of words: stretches that repeat a phrase several times in a row.

A run is a stretch of words with smallest period q, at least ``exponent * q`` and ``least`` words long,
that neither neighbour extends. Each of its words occurs at least ``exponent`` times in it. So a word that
occurs less often within a segment of a text joins no run there, and splits the segment; the parts are
counted and split again until nothing changes. No run is ever cut, and plain prose falls to pieces at once.

What survives is scanned by lags. A run of period q holds ``exponent`` of the places 0, q, 2q, ... of its
segment, all with the same word, and its words equal those q further on from the first of these places
to the last but one. So a lag looks at one place in q, and all lags together at n log n places of a segment
of n words. Running hashes compare the stretch between such places, and what agrees is compared word by
word and extended to both sides. Lags ascend; places within a run that is already known are passed over,
as there the smallest period is the known one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged

#: Places that lags look at in one step.
_STEP = 1 << 19


def surviving(codes: np.ndarray, offsets: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the segments of all texts in which each word occurs ``exponent`` times or more.

    Text t has the words ``codes[offsets[t]:offsets[t + 1]]``. All segments that changed in the last round
    are counted together; one that loses no word leaves.
    """
    begins, ends = offsets[:-1], offsets[1:]
    kept = []
    while True:
        sizes = ends - begins
        long = sizes >= least
        begins, sizes = begins[long], sizes[long]
        if not len(begins):
            break
        at = ragged.take(np.arange(len(codes)), begins, sizes)
        segment = np.repeat(np.arange(len(begins)), sizes)
        order = np.lexsort((codes[at], segment))
        new = np.ones(len(at), bool)
        new[1:] = (codes[at][order][1:] != codes[at][order][:-1]) | (segment[order][1:] != segment[order][:-1])
        group = np.cumsum(new) - 1
        often = np.empty(len(at), bool)
        often[order] = np.bincount(group)[group] >= exponent
        stable = np.ones(len(begins), bool)
        stable[segment[~often]] = False
        kept.append((begins[stable], begins[stable] + sizes[stable]))
        # The stretches of frequent words in the segments that changed are the next segments.
        often &= ~stable[segment]
        first, last = often.copy(), often.copy()
        first[1:] &= ~often[:-1] | (segment[1:] != segment[:-1])
        last[:-1] &= ~often[1:] | (segment[1:] != segment[:-1])
        begins, ends = at[first], at[last] + 1
    kept.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    begins, ends = (np.concatenate(side) for side in zip(*kept))
    order = np.argsort(begins)
    return begins[order], ends[order]


def _reach(equal, at: int, room: int) -> int:
    """How many of the next ``room`` places from ``at`` are equal; looks at ever more of them at a time."""
    done, step = 0, 64
    while done < room:
        part = equal(at + done, min(step, room - done))
        if not part.all():
            return done + int(part.argmin())
        done += len(part)
        step *= 2
    return room


def _stretch(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """Begin and end of the longest stretch around ``at`` that keeps the period ``lag``."""
    n = len(words) - lag
    right = _reach(lambda i, k: words[i:i + k] == words[i + lag:i + lag + k], at, n - at)
    left = _reach(lambda i, k: (words[at - i - k:at - i] == words[at - i - k + lag:at - i + lag])[::-1], 0, at)
    return at - left, at + right + lag


def _candidates(words: np.ndarray, sums: np.ndarray, powers: np.ndarray, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lags in ascending order, some in each step, and the places from which ``exponent`` places a lag apart
    hold the same word and the stretches between them have the same hash."""
    n = len(words)
    most, low = n // exponent, 1
    while low <= most:
        high = min(most, low + max(_STEP * low // n, 1))
        lags = np.arange(low, high + 1)
        counts = (n - 1) // lags - exponent + 2
        lag = np.repeat(lags, counts)
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(counts) - counts, counts)) * lag
        for j in range(1, exponent):
            same = words[at] == words[at + j * lag]
            lag, at = lag[same], at[same]
        size = (exponent - 2) * lag + 1
        part = lambda begin: sums[begin + size] - sums[begin] * powers[size]
        same = part(at) == part(at + lag)
        yield lag[same], at[same]
        low = high + 1


def scan(words: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of one segment."""
    n, base = len(words), np.uint64(0x9E3779B97F4A7C15)
    mixed = ragged.mix(words.astype(np.uint64) + np.uint64(1))
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]))
    sums = _running(mixed, base)
    known = np.zeros(n, np.int64)  # for each place, the furthest end of a known run that holds it
    found = []
    for lags, places in _candidates(words, sums, powers, exponent):
        edges = np.flatnonzero(np.concatenate([[True], lags[1:] != lags[:-1], [True]])) if len(lags) else np.zeros(1, np.int64)
        for begin, end in zip(edges[:-1], edges[1:]):
            lag, at = int(lags[begin]), places[begin:end]
            at = at[known[at] <= at + (exponent - 1) * lag]
            i = 0
            while i < len(at):
                start, stop = _stretch(words, int(at[i]), lag)
                if stop - start >= max(least, exponent * lag):
                    found.append((start, stop - start, lag))
                    np.maximum(known[start:stop], stop, out=known[start:stop])
                # Later places of the same stretch give the same run.
                i = max(i + 1, int(np.searchsorted(at, stop - lag)))
    return found


def _running(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of all beginnings: ``s[i + 1] = s[i] * base + values[i]`` modulo 2**64."""
    inverse = pow(int(base), -1, 1 << 64)
    n = len(values)
    down = np.cumprod(np.full(n, np.uint64(inverse))) if n else np.zeros(0, np.uint64)
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]))
    return np.concatenate([[np.uint64(0)], np.cumsum(values * down)]) * up


def runs_of(codes: np.ndarray, offsets: np.ndarray, exponent: int, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    found = [[] for _ in range(len(offsets) - 1)]
    begins, ends = surviving(codes, offsets, exponent, least)
    owners = np.searchsorted(offsets, begins, side="right") - 1
    for begin, end, owner in zip(begins.tolist(), ends.tolist(), owners.tolist()):
        _, local = np.unique(codes[begin:end], return_inverse=True)
        shift = begin - int(offsets[owner])
        found[owner] += [(start + shift, length, period) for start, length, period in scan(local, exponent, least)]
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def collapse(docs: DataFrame, exponent: int = 4, least: int = 6) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row of ``docs`` (``doc_id``, ``text``; other columns are
    ignored, whatever their names).

    ``runs`` has ``(start, length, period)`` of each run, counted in words ``[^\\x20\\x09-\\x0D]+`` from 0, by
    start, then period. ``collapsed`` has the words joined by one space, without those that some run holds
    after its first period. A null or empty text has no words, no runs and an empty collapsed text. Rows that
    repeat an id or a text, or have no id, are rows of the result too; an empty table gives none. Texts are
    worked on whole at any length, a few at a time up to some megabytes, a longer one alone; memory is in
    proportion to that. ``exponent`` is 3 or more.
    """
    if exponent < 3:
        raise ValueError("a run repeats its period three times at least")
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("collapsed", pa.string())])

    def run(batches):
        for batch in ragged.sliced(batches):
            codes, vocabulary, offsets = ragged.words(batch.column("text"))
            found = runs_of(codes, offsets, exponent, least)
            kept = np.ones(len(codes), bool)
            for text, runs in enumerate(found):
                for start, length, period in runs:
                    kept[offsets[text] + start + period:offsets[text] + start + length] = False
            places = np.concatenate([[0], np.cumsum(kept)])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), vocabulary.take(pa.array(codes[kept])))
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            edges = pa.array(np.concatenate([[0], np.cumsum([len(runs) for runs in found])]).astype(np.int32))
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type))
            yield ragged.table(schema, [
                batch.column("doc_id"), np.diff(offsets), pa.ListArray.from_arrays(edges, structs),
                pc.binary_join(lists, pa.scalar(" ", vocabulary.type)).cast(pa.string())])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of rows of
    :func:`collapse`: the longest run (ties: smallest start, then period; nulls without one), and digests of
    the list of runs and of the collapsed text."""
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
    first = F.when(F.size("runs") > 0, best)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("best"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with periodic endings in a tenth of the texts, set by a checksum h of the id.

    With g = h // 10, where h % 10 is 0 the n words from the one numbered a = g % n on repeat the first p of
    these, p = 1 + (n - a) // (3 + g % 8), and the words are joined by single spaces. Other texts stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    a = (F.col("g") % F.greatest("n", F.lit(1))).cast("int")
    rows = rows.withColumn("a", a).withColumn("p", F.floor(1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    ending = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    whole = F.concat(F.slice("words", F.lit(1), F.col("a")), ending)
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))
