"""Toxicity by multiple-instance learning.

Labels say that a document is toxic, not where. A document is a bag of sentences; a sentence has a
logistic score of its words, and a document is toxic if any sentence is: noisy-or, ``1 - prod(1 - p)``.
Trained from document labels alone, the sentence scores then point at the offending sentences.

The model is a table of weights for hashed words and word beginnings, fitted on a bounded sample of
labelled documents (``sample`` of each class, the lowest by a hash of doc_id); every document is scored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 2000
#: Hashed features: 2 ** this many weights.
BITS = 18
PREFIXES = (4, 5)
EPOCHS, RATE, PENALTY = 3, 0.3, 6e-4
#: Share of the sample's documents that a feature must occur in, and two at least; steps at least.
LEAST_SHARE, LEAST_STEPS = 0.0015, 250
#: A sentence at or above this score offends.
OFFENDS = 0.5

_BREAK = "\x01"
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¿¡«»…“”„‘’"


def features(vocabulary: pa.Array) -> np.ndarray:
    """Hashed features of each word, lower case and without punctuation around it: the word and its
    beginnings. Column by column; a word without letters or digits has feature 0, which has no weight."""
    bare = pc.utf8_trim(pc.utf8_lower(vocabulary), characters=_PUNCTUATION)
    coded = bare.dictionary_encode()
    own = coded.dictionary
    columns = []
    for i, length in enumerate((0, *PREFIXES)):
        part = pc.utf8_slice_codeunits(own, 0, length) if length else own
        hashes = ragged.hashed(part, i + 1) % np.uint64((1 << BITS) - 1) + np.uint64(1)
        columns.append(np.where(np.asarray(pc.not_equal(part, "")), hashes, 0).astype(np.int64))
    found = np.stack(columns, axis=1) if len(own) else np.zeros((0, len(columns)), np.int64)
    return found[np.asarray(coded.indices)]


def sentences(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Word codes, words by code, the sentence of each code, and the document of each sentence; a sentence
    has each of its words once. A sentence ends with a line or with a word that ends in ``.``, ``!`` or ``?``, closing quotes aside. A text
    without words is one empty sentence."""
    texts = pc.replace_substring(pc.replace_substring(ragged.texts(column), _BREAK, " "), "\n", f" {_BREAK} ")
    codes, vocabulary, offsets = ragged.words(texts)
    ends = np.asarray(pc.match_substring_regex(vocabulary, "(^\x01|[.!?…][\"')»”’]*)$"))[codes] if len(codes) else np.zeros(0, bool)
    ends[offsets[1:][np.diff(offsets) > 0] - 1] = True
    begins = np.append(True, ends[:-1])[: len(codes)]
    sentence = np.cumsum(begins) - 1
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[begins] if len(codes) else np.zeros(0, np.int64)
    once = np.unique(sentence * max(len(vocabulary), 1) + codes)
    return once % max(len(vocabulary), 1), vocabulary, once // max(len(vocabulary), 1), document


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Characters of each sentence of one text, by the rule of :func:`sentences`."""
    spans, begin, end = [], None, 0
    for found in re.finditer("[^\x20\x09-\x0d\x01]+|\n", text):
        begin = found.start() if begin is None else begin
        end = found.end()
        if re.search("(\n|[.!?…][\"')»”’]*)$", found.group()):
            spans.append((begin, end))
            begin = None
    return spans if begin is None else [*spans, (begin, end)]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document scores, sentence scores, and the document of each sentence."""
        codes, vocabulary, sentence, document = sentences(column)
        word = self.weights[features(vocabulary)].sum(axis=1)
        logits = np.bincount(sentence, word[codes], len(document)) + self.bias
        logs = -np.logaddexp(0, logits)  # log(1 - p)
        none = np.bincount(document, logs, len(column))
        return -np.expm1(none), -np.expm1(logs), document


def train(column: pa.Array, toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Fit the model to documents and their labels by noisy-or likelihood, with Adagrad steps."""
    codes, vocabulary, sentence, document = sentences(column)
    found = features(vocabulary)
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    bias, bias_square = -8.0, 1.0
    if not len(document) or not len(toxic):
        return Model(weights.astype(np.float32), bias)
    of_word = document[sentence]
    edges = np.searchsorted(of_word, np.arange(len(column) + 1))
    sentence_edges = np.searchsorted(document, np.arange(len(column) + 1))
    # A feature of few documents tells nothing but these documents: it stays without weight.
    frequent = np.zeros(1 << BITS, np.int32)
    for column_ in found.T:
        frequent += np.bincount(np.unique((of_word << BITS) | column_[codes]) & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.int32)
    frequent = frequent >= max(2, round(LEAST_SHARE * len(column)))
    found = np.where(frequent[found], found, 0)
    rng = np.random.default_rng(seed)
    for _ in range(max(epochs, -(-LEAST_STEPS * 64 // len(column)))):
        order = rng.permutation(len(column))
        for begin in range(0, len(order), 64):
            rows = order[begin:begin + 64]
            n_words, n_sentences = edges[rows + 1] - edges[rows], sentence_edges[rows + 1] - sentence_edges[rows]
            words = ragged.take(np.arange(len(codes)), edges[rows], n_words)
            shift = np.cumsum(n_sentences) - n_sentences - sentence_edges[rows]
            own = sentence[words] + np.repeat(shift, n_words)
            owner = np.repeat(np.arange(len(rows)), n_sentences)
            feats = found[codes[words]]
            logits = np.bincount(own, weights[feats].sum(axis=1), len(owner)) + bias
            p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            any_ = np.clip(-np.expm1(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(rows))), 1e-9, 1)
            # of the negative log-likelihood by each sentence's logit
            slope = p * np.where(toxic[rows], -(1 - any_) / any_, 1.0)[owner]
            flat = feats.ravel()
            used, place = np.unique(flat, return_inverse=True)
            gradient = np.bincount(place, np.repeat(slope[own], feats.shape[1]), len(used)) / len(rows) + PENALTY
            squares[used] += gradient**2
            # Words are evidence for toxicity or none: a toxic word offends among any others.
            weights[used] = np.maximum(weights[used] - RATE * gradient / np.sqrt(squares[used]), 0)
            weights[0] = 0
            step = slope.sum() / len(rows)
            bias_square += step**2
            bias -= RATE * step / np.sqrt(bias_square)
    return Model(weights.astype(np.float32), float(bias))


def held_out(doc_id: Column) -> Column:
    """Documents that labels are never learned from. A null doc_id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled documents of each class. Rows without a doc_id or label,
    and held-out ones, are not used; of labels that differ for one document the highest counts."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    usable = usable.withColumn("h", F.xxhash64("doc_id"))
    chosen = [usable.where(f"toxic {sign} 0").orderBy("h", "doc_id").limit(sample) for sign in (">", "=")]
    chosen = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy("h", "doc_id", "text").select("text", "toxic")  # at most 2 * sample rows
    table = rows.toArrow().combine_chunks()
    column = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    return train(column, np.asarray(table["toxic"]) > 0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted, offending)`` of each row of ``docs(doc_id, text)``.

    ``score`` is the noisy-or of all sentences; ``predicted`` is 1 from 0.5 on; ``offending`` lists the
    sentences that offend by themselves as ``(begin, end, score)`` in characters. Null and empty texts
    have no sentence and score 0. Equal rows score alike; other columns are ignored.
    """
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offending", pa.list_(span))])

    def run(batches):
        for batch in ragged.sliced(batches):
            column = ragged.texts(batch.column("text"))
            scores, own, document = model.scores(column)
            offending = [[] for _ in range(len(column))]
            begins = np.searchsorted(document, np.arange(len(column)))
            for row in np.unique(document[own >= OFFENDS]):
                spans = sentence_spans(column[int(row)].as_py())
                mine = own[begins[row]:begins[row] + len(spans)]
                offending[row] = [{"begin": b, "end": e, "score": float(s)} for (b, e), s in zip(spans, mine) if s >= OFFENDS]
            yield ragged.table(schema, [batch.column("doc_id"), scores, offending])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double, offending array<struct<begin:int,end:int,score:double>>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns, whatever these are named: each row is
    judged by its own text, and null and empty texts stay. One pass without a shuffle."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in ragged.sliced(batches):
            yield batch.filter(pa.array(model.scores(ragged.texts(batch.column(place)))[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
