"""Documents scored by masked pseudo-likelihood.

A small network predicts each word from the words on both sides of it, itself masked. The score of a
document is the sum of the log-probabilities of all its words, each given its neighbours.

A word's probability is that of its class, which the network predicts from its window, times that of the
word within its class, which it predicts from the window too: a binary tree over the words of the class
has an output at each fork, and an output of 0 parts the words by how often they occur. So a step costs
as many outputs as there are classes and forks above the word, and all words sum up to 1. The vocabulary
is the words above a count that follows the size of the corpus; all others fall into buckets by a hash,
and have their share of the bucket by their own counts, which stay a table. Words are counted over the
whole corpus. Training sees every document: in each round all partitions start from the same network, train
on all places of their documents, each document in one of the rounds, and their networks are averaged by words trained on.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.llm.tables import discard, written

VOCABULARY, BUCKETS, CLASSES, SIDE, DIMENSION = 8192, 256, 64, 3, 24
#: Words that occur a so-manieth of the square root of all words are in the vocabulary, VOCABULARY words at least.
LEAST = 40
#: Rounds of training, places of a step, and the step's size.
ROUNDS, BATCH, RATE = 2, 2048, 0.25
#: Places that are scored together, in which words occur again.
MANY = 32 * BATCH
#: Scores up to here have exponentials that a sum over the classes can hold, above and below 0.
SAFE = 60
#: Networks are summed as whole numbers in these units, so that the order of summation does not matter.
UNIT = 2.0**-30
SHARDS = 16


#: Rows of a matrix product at a time: beyond that the linear algebra library would start threads of its own, which
#: wait busily on a machine whose cores all have a task.
ROWS = 128
#: Sums over the classes as a product.
ONES = np.ones((CLASSES, 1), np.float32)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` for many rows and few columns."""
    whole = len(a) // ROWS * ROWS
    out = np.empty((len(a), b.shape[1]), np.float32)
    np.matmul(a[:whole].reshape(-1, ROWS, a.shape[1]), b, out=out[:whole].reshape(-1, ROWS, b.shape[1]))
    np.matmul(a[whole:], b, out=out[whole:])
    return out


def crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` for many rows and few columns."""
    whole = len(a) // ROWS * ROWS
    parts = a[:whole].reshape(-1, ROWS, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, ROWS, b.shape[1])
    return parts.sum(axis=0) + a[whole:].T @ b[whole:]


def class_of(ids: np.ndarray) -> np.ndarray:
    """The most frequent half of the classes' words are classes of their own; the rest share by hash."""
    alone = CLASSES // 2
    shared = alone + (ragged.mix(ids.astype(np.uint64)) % np.uint64(CLASSES - alone)).astype(np.int64)
    return np.where(ids < alone, ids, shared)


@dataclass
class Lexicon:
    """Words by rank; of each id (known words, then buckets) how often it occurs, and once more; and
    ``rest(hash, n)``, a table of how often each other word occurs, by its hash."""

    words: list[str]
    n: np.ndarray
    rest: DataFrame | None = None

    def __post_init__(self):
        own = class_of(np.arange(self.size))
        self.log_share = np.log(self.n / np.bincount(own, self.n, CLASSES)[own]).astype(np.float32)
        self._words = pa.array(self.words, pa.large_string())
        self._plant(own)

    def _plant(self, own: np.ndarray) -> None:
        """The trees: the forks above each id, whether it lies right (1) or left (-1) of each (0: no more
        forks), and of each fork the log odds of its right side by counts. Words of a class follow each
        other by rank and are halved at a fork, which has the number of the first word on its right."""
        order = np.argsort(own, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(self.size)
        upto = np.append(0, np.cumsum(self.n[order]))
        low, high = np.searchsorted(own[order], own), np.searchsorted(own[order], own, side="right")
        self.odds, forks, sides = np.zeros(self.size, np.float32), [], []
        while (parted := high - low > 1).any():
            middle = np.where(parted, (low + high) // 2, 0)
            right = place >= middle
            at = middle[parted]
            self.odds[at] = np.log((upto[high[parted]] - upto[at]) / (upto[at] - upto[low[parted]]))
            forks.append(middle)
            sides.append(np.where(parted, np.where(right, 1, -1), 0))
            low, high = np.where(parted & right, middle, low), np.where(parted & ~right, middle, high)
        shape = (len(forks), self.size)
        self.forks = np.array(forks, np.int32).reshape(shape).T.copy()
        self.sides = np.array(sides, np.int8).reshape(shape).T.copy()
        self.deep = self.sides.any(axis=1)  # of classes with more than one word
        self.classes = own.astype(np.int16)

    def __getstate__(self):
        return {**self.__dict__, "rest": None}  # tasks have no tables

    @property
    def size(self) -> int:
        return len(self.n)

    def coded(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of all words of a column of texts, where each text's begin, and of each code the id and
        the hash of the word."""
        codes, vocabulary, offsets = ragged.words(column)
        hashes = ragged.hashed(vocabulary)
        buckets = self.size - BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        known = np.asarray(pc.fill_null(pc.index_in(vocabulary, value_set=self._words), -1)).astype(np.int64)
        return codes, offsets, np.where(known >= 0, known, buckets), hashes

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a column of texts, and where each text's begin."""
        codes, offsets, ids, _ = self.coded(column)
        return ids[codes] if len(codes) else codes, offsets


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts; each task sends a word once for each slice of its texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        for batch in ragged.sliced(batches, limit=4 * ragged.SLICE_BYTES):
            codes, vocabulary, _ = ragged.words(batch.column("text"))
            yield ragged.table(schema, [vocabulary.cast(pa.string()), np.bincount(codes, minlength=len(vocabulary))])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame) -> Lexicon:
    """The vocabulary and the counts of all words, from all texts. Only the vocabulary and a count for each
    bucket come to the driver.

    In the vocabulary are words that occur a ``LEAST``-th of the square root of all words or more often,
    and ``VOCABULARY`` words at least: it grows with the corpus, but not above ``LEAST`` times that root."""
    counts = written(word_counts(docs), "words", old := [])
    total = counts.agg(F.sum("n")).first()[0] or 0
    size = max(VOCABULARY, counts.where(F.col("n") >= max(1, math.isqrt(total) // LEAST)).count())
    top = counts.orderBy(F.desc("n"), "word").limit(size)
    rows = top.collect()  # at most LEAST times the root of all words, or VOCABULARY
    schema = pa.schema([("hash", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            hashes = ragged.hashed(batch.column("word"))
            yield ragged.table(schema, [hashes.view(np.int64), (hashes % np.uint64(BUCKETS)).astype(np.int32), batch.column("n")])

    known = F.broadcast(docs.sparkSession.createDataFrame([(r["word"],) for r in rows], "word string"))
    rest = written(counts.join(known, "word", "left_anti").mapInArrow(run, "hash long, bucket int, n long"), "rest")
    discard(docs.sparkSession, old)
    n = np.ones(size + BUCKETS)  # each id once more than seen
    n[: len(rows)] += [r["n"] for r in rows]
    for row in rest.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows
        n[size + row["bucket"]] += row["n"]
    return Lexicon([r["word"] for r in rows], n, rest)


class Network:
    """Window embeddings, weighted by place, summed through tanh into the scores of classes and of forks."""

    def __init__(self, flat: np.ndarray, n_ids: int = VOCABULARY + BUCKETS):
        self.n_ids, at = n_ids, 0
        for name, shape in self.shapes(n_ids).items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape).astype(np.float32))
            at += size

    @classmethod
    def start(cls, seed: int = 1, n_ids: int = VOCABULARY + BUCKETS) -> Network:
        rng = np.random.default_rng(seed)
        made = cls(rng.normal(0, 0.1, cls.size(n_ids)), n_ids)
        made.p = np.ones_like(made.p)
        made.b[:], made.c[:], made.v[:] = 0, 0, 0
        return made

    @staticmethod
    def shapes(n_ids: int) -> dict[str, tuple]:
        return {"e": (n_ids + 1, DIMENSION), "p": (2 * SIDE, DIMENSION), "b": (DIMENSION,), "w": (DIMENSION, CLASSES), "c": (CLASSES,), "v": (n_ids, DIMENSION)}

    @classmethod
    def size(cls, n_ids: int) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes(n_ids).values())

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.shapes(self.n_ids)])

    def forward(self, around: np.ndarray):
        """Class scores of windows of ids, whose exponentials neither overflow nor vanish, and what training needs of
        the way there."""
        found = self.e.take(around, axis=0)
        hidden = np.einsum("nkd,kd->nd", found, self.p)
        hidden += self.b
        np.tanh(hidden, out=hidden)
        scores = product(hidden, self.w)
        scores += self.c
        if scores.size and max(scores.max(), -scores.min()) > SAFE:
            scores -= scores.max(axis=1, keepdims=True)
        return scores, hidden, found

    def within(self, hidden: np.ndarray, ids: np.ndarray, lexicon_: Lexicon):
        """Scores of the right side at the forks above each id, the sides it takes, the forks and their weights.
        ``hidden`` has some places of each id."""
        forks = lexicon_.forks.take(ids, axis=0)
        weights = self.v.take(forks, axis=0)
        scores = (weights @ hidden.transpose(0, 2, 1)).transpose(0, 2, 1)
        scores += lexicon_.odds.take(forks)[:, None]
        return scores, lexicon_.sides.take(ids, axis=0)[:, None], forks, weights

    def step(self, around: np.ndarray, ids: np.ndarray, lexicon_: Lexicon, rate: float) -> None:
        slope, hidden, found = self.forward(around)
        n = len(ids)
        np.exp(slope, out=slope)
        slope *= rate / product(slope, ONES)
        slope[np.arange(n), lexicon_.classes.take(ids)] -= rate
        back = product(slope, self.w.T)
        deep = np.flatnonzero(lexicon_.deep.take(ids))
        if len(deep):
            inner = hidden.take(deep, axis=0)
            scores, sides, forks, weights = self.within(inner[:, None], ids.take(deep), lexicon_)
            fork_slope = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - (sides > 0)) * ((sides != 0) * np.float32(rate))
            back[deep] += (fork_slope @ weights)[:, 0]
            _move(self.v, forks, inner, fork_slope[:, 0])
        before = back * (1 - hidden**2)
        self.w -= crossed(hidden, slope) / n * 8
        self.c -= crossed(slope, np.ones((n, 1), np.float32))[:, 0] / n * 8
        place = np.einsum("nkd,nd->kd", found, before) / n
        # embeddings are rare: each moves by its own windows, not by their share of the batch
        _move(self.e, around, before, self.p)
        self.b -= crossed(before, np.ones((n, 1), np.float32))[:, 0] / n
        self.p -= place


def _move(table: np.ndarray, rows: np.ndarray, of_place: np.ndarray, factors: np.ndarray) -> None:
    """Move the rows ``rows[i, j]`` of a table against the sums of their slopes, by the root of how many these are.
    A slope is the vector ``of_place[i]`` times ``factors[i, j]``, or times the vector ``factors[j]``."""
    single = factors.shape == rows.shape
    rows = np.ascontiguousarray(rows.T, np.int64).ravel()
    rows[rows < 0] += len(table)  # EDGE is the last row
    found = np.zeros(len(table), bool)
    found[rows] = True
    moved = np.flatnonzero(found)
    code = np.empty(len(table), np.int64)  # of each row its number among the different ones
    code[moved] = np.arange(len(moved))
    code = code.take(rows)
    # Two dimensions are summed at a time, as the parts of one complex number: half as many sums.
    pairs = np.ascontiguousarray(of_place.view(np.complex64).T)
    sums, factors = np.zeros((len(pairs), len(moved)), np.complex64), np.ascontiguousarray(factors.T)
    slopes = np.empty((len(rows) // len(of_place), len(of_place)), np.complex64)
    for d, (total, pair) in enumerate(zip(sums, pairs)):
        if single:
            np.multiply(pair, factors, out=slopes)
        else:
            slopes.real = factors[2 * d][:, None] * pair.real
            slopes.imag = factors[2 * d + 1][:, None] * pair.imag
        np.add.at(total, code, slopes.ravel())
    sums /= np.sqrt(np.bincount(code, minlength=len(moved))).astype(np.float32)
    table[moved] = table.take(moved, axis=0) - np.ascontiguousarray(sums.T).view(np.float32)


#: The id of places beyond the ends of a text: the last embedding, however many there are.
EDGE = -1
#: From a place to those on both sides of it.
STEPS = np.concatenate([np.arange(-SIDE, 0), np.arange(1, SIDE + 1)])


def apart(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts with SIDE times EDGE on both sides of each text, and where each id lies in them."""
    places = np.arange(len(ids)) + SIDE * (1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)))
    apart_ = np.full(len(ids) + SIDE * len(offsets), EDGE)
    apart_[places] = ids
    return apart_, places


def around(apart_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ids on both sides of places of :func:`apart`, within their text."""
    return apart_.take(places[:, None] + STEPS)


def _trained(docs: DataFrame, lexicon_: Lexicon, network: Network, round_: int, rounds: int) -> Network:
    """One round: the average of the networks that the partitions of ``docs`` train, each on the rows
    whose turn it is: a document is trained on in one of the rounds."""
    schema = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())])
    start = network.flat()
    size = len(start)
    edges = np.linspace(0, size, SHARDS + 1).astype(int)

    def train(batches):
        own, seen, rows = Network(start, lexicon_.size), 0, 0
        for batch in ragged.sliced(batches):
            turn = np.flatnonzero((np.arange(batch.num_rows) + rows) % rounds == round_)
            rows += batch.num_rows
            batch = batch.take(pa.array(turn))
            ids, offsets = lexicon_.ids(batch.column("text"))
            # every place, in an order that follows from the words, so any order of tasks steps alike
            drawn = ragged.mix(ragged.mix(np.arange(len(ids), dtype=np.uint64) + np.uint64(round_ << 40)) + ids.astype(np.uint64))
            apart_, places = apart(ids, offsets)
            places = places[np.argsort(drawn)]
            for begin in range(0, len(places), BATCH):
                chosen = places[begin:begin + BATCH]
                own.step(around(apart_, chosen), apart_.take(chosen), lexicon_, RATE / (1 + round_))
            seen += len(places)
        if seen:
            weights = np.rint(own.flat().astype(np.float64) / UNIT).astype(np.int64) * seen
            yield ragged.table(schema, [np.arange(SHARDS, dtype=np.int32), np.full(SHARDS, seen), [weights[a:b].tobytes() for a, b in zip(edges, edges[1:])]])

    def total(batches):
        low = (1 << 24) - 1
        sums = {}  # of each shard: words, and the high and low parts of the weights, which cannot overflow
        for batch in batches:
            for row in range(batch.num_rows):
                shard, n, weights = (batch.column(i)[row].as_py() for i in range(3))
                values = np.frombuffer(weights, np.int64)
                seen, above, below = sums.get(shard, (0, 0, 0))
                sums[shard] = (seen + n, above + (values >> 24), below + (values & low))
        for shard, (n, above, below) in sums.items():
            yield ragged.table(schema, [[shard], [n], [((above * (low + 1.0) + below) / n).tobytes()]])

    columns = "shard int, n long, weights binary"
    parts = docs.select(F.col("text").cast("string")).mapInArrow(train, columns)
    summed = parts.repartition(SHARDS, "shard").mapInArrow(total, columns)
    rows = {r["shard"]: np.frombuffer(r["weights"], np.float64) * UNIT for r in summed.collect()}  # one network
    return Network(np.concatenate([rows[s] for s in range(SHARDS)]), lexicon_.size) if rows else network


def fit(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Lexicon, Network]:
    """The vocabulary and network of a corpus. Without any words the network is the untrained one."""
    words = lexicon(docs)
    network = Network.start(n_ids=words.size)
    for round_ in range(rounds):
        network = _trained(docs, words, network, round_, rounds)
    return words, network


def pseudo_likelihood(network: Network, lexicon_: Lexicon, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The log-probability of each place's class given the words around it, and of the place's word by
    the word's share of the class in the corpus: :func:`token_logs` with all forks at 0."""
    return _logs(network, lexicon_, ids, offsets, lambda hidden, own: lexicon_.log_share[own])


def token_logs(network: Network, lexicon_: Lexicon, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The log-probability of each place's id given the words around it: that of its class, and at each
    fork within the class that of its side."""
    def within(hidden, every):
        out = np.zeros(len(every), np.float32)
        deep = np.flatnonzero(lexicon_.deep.take(every))
        deep = deep.take(np.argsort(every.take(deep), kind="stable"))
        words, begins, times = np.unique(every.take(deep), return_index=True, return_counts=True)
        # The places of an id share their forks. Each id's are taken by powers of two, so that those of many ids are one product.
        for bit in range(int(times.max(initial=0)).bit_length()):
            some = np.flatnonzero(times >> bit & 1)
            size = 1 << bit
            places = deep.take((begins + (times & size - 1)).take(some)[:, None] + np.arange(size)).reshape(-1, min(size, ROWS))
            own = words.take(some).repeat(len(places) // max(len(some), 1))
            scores, sides = network.within(hidden.take(places, axis=0), own, lexicon_)[:2]
            out[places] -= np.log(1 + np.exp(-np.clip(scores * sides, -80, 80)) * (sides != 0)).sum(axis=2)
        return out

    return _logs(network, lexicon_, ids, offsets, within)


def _logs(network: Network, lexicon_: Lexicon, ids: np.ndarray, offsets: np.ndarray, within: Callable) -> np.ndarray:
    """The log-probability of each place's class, plus ``within`` of the places' hidden values and ids, many places
    at a time."""
    out = np.zeros(len(ids))
    apart_, places = apart(ids, offsets)
    for first in range(0, len(ids), MANY):
        many, inner = slice(first, first + MANY), []
        for begin in range(first, min(first + MANY, len(ids)), BATCH):
            some = slice(begin, min(begin + BATCH, first + MANY))
            own = ids[some]
            scores, hidden, _ = network.forward(around(apart_, places[some]))
            out[some] = scores[np.arange(len(own)), lexicon_.classes.take(own)]
            out[some] -= np.log(product(np.exp(scores, out=scores), ONES)[:, 0])
            inner.append(hidden)
        out[many] += within(np.concatenate(inner), ids[many])
    return out


def score(docs: DataFrame, lexicon_: Lexicon, network: Network) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)`` of each row of ``docs(doc_id, text)``.

    A word outside the vocabulary has its own share of its bucket, from the counts of all words. One that
    the lexicon never saw has that of a word seen once. Null and empty texts have no words, a sum of 0
    and no mean. Equal rows score alike; other columns are ignored; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.float64()), ("hashes", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        for batch in ragged.sliced(batches):
            codes, offsets, of_code, hashes = lexicon_.coded(batch.column("text"))
            ids = of_code[codes] if len(codes) else codes
            logs = token_logs(network, lexicon_, ids, offsets)
            # Words outside the vocabulary: here by the size of their bucket, their own counts follow.
            outside = np.flatnonzero(ids >= lexicon_.size - BUCKETS)
            logs[outside] -= np.log(lexicon_.n[ids[outside]])
            sums = np.append(0, np.cumsum(logs))
            n, total = np.diff(offsets), sums[offsets[1:]] - sums[offsets[:-1]]
            row = np.searchsorted(offsets, outside, side="right") - 1
            found, times = np.unique(row * max(len(hashes), 1) + codes[outside], return_counts=True)
            edges = np.searchsorted(found, np.arange(batch.num_rows + 1) * max(len(hashes), 1)).astype(np.int32)
            own = hashes[found % max(len(hashes), 1)].view(np.int64)
            lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (own, times.astype(np.int32))]
            yield ragged.table(schema, [batch.column("doc_id"), n, total, *lists])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, known double, hashes array<long>, times array<int>")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    words = scored.select("row", F.explode(F.arrays_zip("hashes", "times")).alias("w")).select("row", F.col("w.hashes").alias("hash"), "w.times")
    # The log of 1 is 0, so words seen once need no row. Whole numbers sum up alike in any order.
    counts = lexicon_.rest.where("n > 1").groupBy("hash").agg(F.round(F.log(F.sum("n")) / UNIT).cast("long").alias("units"))
    sums = words.join(counts, "hash").groupBy("row").agg(F.sum(F.col("times") * F.col("units")).alias("units"))
    total = F.col("known") + F.coalesce(F.col("units") * UNIT, F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))
