"""The network's arithmetic against plain loops."""

import math

import numpy as np
import pytest

from gaugeline.llm import pseudo_likelihood as P
from gaugeline.llm.queries import QUERIES
from gaugeline.llm.tables import documents
from tests.llm.test_queries import WORD


@pytest.mark.parametrize("n", [0, 1, 6, 127, 128, 300])
def test_products_in_blocks(n):
    rng = np.random.default_rng(n)
    a, b, w = rng.normal(size=(n, 5)).astype(np.float32), rng.normal(size=(n, 7)).astype(np.float32), rng.normal(size=(5, 7)).astype(np.float32)
    assert np.allclose(P.product(a, w), a @ w, atol=1e-5)
    assert np.allclose(P.crossed(a, b), a.T @ b, atol=1e-4)


@pytest.mark.parametrize("n", [1, 6, 50])
def test_moves_sum_the_slopes_of_a_row(n):
    rng = np.random.default_rng(n)
    rows, places = rng.integers(-1, 9, (n, 2 * P.SIDE)), rng.normal(size=(n, P.DIMENSION)).astype(np.float32)
    for factors in (rng.normal(size=(2 * P.SIDE, P.DIMENSION)), rng.normal(size=rows.shape)):
        factors = factors.astype(np.float32)
        table = rng.normal(size=(10, P.DIMENSION)).astype(np.float32)
        expected, times = table.astype(np.float64).copy(), np.zeros(10)
        sums = np.zeros((10, P.DIMENSION))
        for i in range(n):
            for j in range(2 * P.SIDE):
                sums[rows[i, j]] += places[i] * (factors[i, j] if factors.shape == rows.shape else factors[j])
                times[rows[i, j]] += 1
        for row in range(10):
            if times[row]:
                expected[row] -= sums[row] / math.sqrt(times[row])
        P._move(table, rows, places, factors)
        assert np.allclose(table, expected, atol=1e-4)


def test_scores_of_a_whole_table_recomputed_word_by_word(spark, small):
    """The sums of the query from weights, trees and counts, one word after the other, for every document."""
    docs = documents(spark, small)
    lexicon, network = P.fit(docs)
    found = {r["doc_id"]: r for r in P.score(docs, lexicon, network).collect()}
    texts = {r["doc_id"]: WORD.findall(r["text"] or "") for r in docs.collect()}
    counts = {}
    for words in texts.values():
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    place = {w: i for i, w in enumerate(lexicon.words)}
    outside = {}
    import pyarrow as pa
    from gaugeline.llm import ragged
    listed = sorted(counts)
    for w, h in zip(listed, ragged.hashed(pa.array(listed))):
        if w not in place:
            outside[w] = lexicon.size - P.BUCKETS + int(h % np.uint64(P.BUCKETS))
    e, p, b, w_, c, v = (getattr(network, n).astype(np.float64) for n in "epbwcv")
    owner = P.class_of(np.arange(lexicon.size))

    def log_probability(ids, i):
        hidden = b.copy()
        for k, step in enumerate([*range(-P.SIDE, 0), *range(1, P.SIDE + 1)]):
            hidden += (e[ids[i + step]] if 0 <= i + step < len(ids) else e[-1]) * p[k]
        hidden = np.tanh(hidden)
        scores = hidden @ w_ + c
        total = scores[owner[ids[i]]] - scores.max() - math.log(np.exp(scores - scores.max()).sum())
        for fork, side in zip(lexicon.forks[ids[i]], lexicon.sides[ids[i]]):
            if side:
                total -= math.log1p(math.exp(-side * (hidden @ v[fork] + lexicon.odds[fork])))
        return total

    chosen = sorted(texts, key=lambda d: len(texts[d]))[:150]  # all but the longest, for the plain loop's sake
    for doc_id in chosen:
        words = texts[doc_id]
        ids = [place[w] if w in place else outside[w] for w in words]
        expected = sum(log_probability(ids, i) for i in range(len(ids)))
        expected += sum(math.log(counts[w]) - math.log(lexicon.n[outside[w]]) for w in words if w not in place)
        assert found[doc_id]["n_tokens"] == len(words)
        assert found[doc_id]["log_likelihood"] == pytest.approx(expected, rel=1e-4, abs=1e-3)
    assert set(QUERIES["op3_pseudo_likelihood"](spark, small).columns) == {"doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"}


def test_scores_far_from_0_do_not_overflow():
    """Exponentials are taken of scores as they are, unless one of them is large."""
    n = np.arange(300, 0, -1) + 1.0
    lexicon = P.Lexicon([f"w{i}" for i in range(300 - P.BUCKETS)], n)
    network = P.Network.start(n_ids=lexicon.size)
    ids, offsets = np.arange(80) % 60, np.array([0, 3, 3, 80])
    near = P.token_logs(network, lexicon, ids, offsets)
    network.c += 5000  # the same for all classes
    assert P.token_logs(network, lexicon, ids, offsets) == pytest.approx(near, abs=1e-2)
    network.c[7] -= 300
    assert np.isfinite(P.token_logs(network, lexicon, ids, offsets)).all()


def test_places_of_a_word_scored_together(monkeypatch):
    """Words that occur once, often, and at the edge of the places scored together."""
    rng = np.random.default_rng(3)
    lexicon = P.Lexicon([f"w{i}" for i in range(1000 - P.BUCKETS)], np.arange(1000, 0, -1) + 1.0)
    network = P.Network.start(n_ids=lexicon.size)
    network.v[:] = rng.normal(size=network.v.shape)
    ids = np.concatenate([np.full(37, 100), rng.integers(0, 1000, 300), rng.integers(0, 50, 200)])
    offsets = np.array([0, 0, 37, 400, len(ids), len(ids)])
    monkeypatch.setattr(P, "MANY", 1 << 16)
    whole = P.token_logs(network, lexicon, ids, offsets)
    monkeypatch.setattr(P, "BATCH", 16)
    monkeypatch.setattr(P, "MANY", 48)
    assert P.token_logs(network, lexicon, ids, offsets) == pytest.approx(whole, abs=1e-4)
    apart, places = P.apart(ids, offsets)
    scores, hidden, _ = network.forward(P.around(apart, places))
    for i in range(0, len(ids), 7):
        alone = scores[i, P.class_of(ids[i:i + 1])[0]] - math.log(np.exp(scores[i].astype(float)).sum())
        for fork, side in zip(lexicon.forks[ids[i]], lexicon.sides[ids[i]]):
            if side:
                alone -= math.log1p(math.exp(-side * float(hidden[i] @ network.v[fork] + lexicon.odds[fork])))
        assert whole[i] == pytest.approx(alone, abs=1e-3)


def test_forks_of_a_word_are_read_once_for_many_places(monkeypatch):
    lexicon = P.Lexicon([f"w{i}" for i in range(1000 - P.BUCKETS)], np.arange(1000, 0, -1) + 1.0)
    network, read, within = P.Network.start(n_ids=lexicon.size), [], P.Network.within
    monkeypatch.setattr(P.Network, "within", lambda self, hidden, ids, lexicon_: read.append(len(ids)) or within(self, hidden, ids, lexicon_))
    ids = np.tile(np.arange(40, 60), 64)
    P.token_logs(network, lexicon, ids, np.array([0, 700, len(ids)]))
    assert sum(read) == 20
