"""Periodic runs, the trie of conversation prefixes and heap BPE: brute force, the library, edge rows."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import heap_bpe, periodic_runs, prefix_trie
from gaugeline.llm.queries import QUERIES
from gaugeline.llm.tables import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))
TEXTS = [
    (1, "a b c " * 9), (2, "a b c " * 9), (2, "a b c " * 9), (3, ""), (4, None), (None, "la la la la la la la"), (5, LONG),
    (6, " \n\t "), (7, LONG + " tail end" * 9), (8, "Ünï😀 codé　text\x1c no  break \x00"), (9, "one"), (20, "x" * 40_000),
    (10, "<|endoftext|>a<|endoftext|> b<|endof"),
]
CLASH = ["ids", "n_tokens", "runs", "collapsed", "n_words", "path", "above", "key", "first", "h", "g", "n"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def clashing(df):
    return df.withColumns({name: F.lit("clash") for name in CLASH})


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(TEXTS, "doc_id long, text string"))


def brute_runs(words, exponent=4, least=6):
    found, n = set(), len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            if i > start and size >= max(least, exponent * q):
                if not any(all(words[j] == words[j + p] for j in range(start, start + size - p)) for p in range(1, q)):
                    found.add((start, size, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def run_row(doc_id, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapsed(words, runs)))


def test_periodic_runs_of_all_documents(spark, small):
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    rows = documents(spark, small).collect()
    assert len(found) == len(rows)
    planted = 0
    for r in rows:
        words, h = WORD.findall(r["text"] or ""), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n <= 2500:  # the brute force below takes n * n steps
            assert found[r["doc_id"]] == run_row(r["doc_id"], words)
    assert planted > 5


@pytest.mark.parametrize("exponent, least", [(4, 6), (3, 1), (5, 2), (6, 30)])
def test_runs_match_brute_force(exponent, least):
    rng = random.Random(exponent)
    texts = []
    for _ in range(250):
        kinds, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 80)
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 8:
            period, start = rng.randint(1, 12), rng.randrange(n)
            for i in range(start + period, min(n, start + period * rng.randint(2, 8) + rng.randint(0, period))):
                words[i] = words[i - period]
        texts.append(words)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    codes = np.array([w for t in texts for w in t], np.int64)
    assert periodic_runs.runs_of(codes, offsets, exponent, least) == [brute_runs(t, exponent, least) for t in texts]


def test_very_long_texts_of_few_words():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 150_000:
        before, fibonacci = fibonacci, fibonacci + before
    whole = lambda words: periodic_runs.runs_of(np.array(words, np.int64), np.array([0, len(words)]), 4, 6)[0]
    assert whole([0] * 150_000) == [(0, 150_000, 1)]
    assert whole(list(range(4000)) * 40) == [(0, 160_000, 4000)]
    assert whole(([0, 1] * 6 + [2]) * 9000)[:2] == [(0, 12, 2), (0, 117_000, 13)]
    assert whole(fibonacci) == []  # no factor of it repeats four times
    assert whole([w for i in range(2000) for w in (i + 1, i, i, i)]) == []  # each split makes one more word rare


def test_periodic_runs_of_edge_rows(spark, docs):
    found = periodic_runs.collapse(docs)
    rows = sorted(found.collect(), key=str)
    assert len(rows) == len(TEXTS)
    assert rows == sorted(found.collect(), key=str)
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(r) for r in by_id[1]["runs"]] == [(0, 27, 3)] and by_id[1]["collapsed"] == "a b c"
    assert by_id[None]["collapsed"] == "la" and by_id[3]["collapsed"] == by_id[4]["collapsed"] == by_id[6]["collapsed"] == ""
    assert by_id[5]["collapsed"] == LONG and by_id[7]["collapsed"] == LONG + " tail end"
    digests = {r["doc_id"]: tuple(r) for r in periodic_runs.digests(found).collect()}
    for doc_id, text in TEXTS:
        words = WORD.findall(text or "")
        if len(words) < 100:
            assert digests[doc_id] == run_row(doc_id, words)
    empty = periodic_runs.digests(periodic_runs.collapse(periodic_runs.planted(docs.where("false"))))
    assert empty.count() == 0
    assert periodic_runs.planted(docs).count() == len(TEXTS)
    with pytest.raises(ValueError):
        periodic_runs.collapse(docs, exponent=2)


def brute_trie(convs):
    """Rows of the trie of ``{conv_id: path}`` with paths of whole turn ids."""
    width, nodes, children = prefix_trie.WIDTH, {}, {}
    for conv, path in convs.items():
        for at in range(0, len(path) + 1, width):
            nodes.setdefault(path[:at], []).append(conv)
    for node in nodes:
        if node:
            children.setdefault(node[:-width], []).append(node)
    below = {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves, saved = int(node not in children), (len(nodes[node]) - 1) * int.from_bytes(node[-4:], "big") if node else 0
        for child in children.get(node, []):
            leaves, saved = leaves + below[child][0], saved + below[child][1]
        below[node] = leaves, saved
    return {(min(members), len(node) // width, min(nodes[node[:-width]]) if node else None, len(members), len(children.get(node, [])), *below[node],
             sha(",".join(map(str, sorted(c for c in members if convs[c] == node))))) for node, members in nodes.items()}


def random_paths(rng):
    """Paths over few turns, or turns whose ids differ late, or over enough turns for the wide layouts."""
    lead = rng.choice([b"", bytes(15)])
    turns = [(lead + rng.randbytes(16))[:16] + rng.choice([0, 1, 300]).to_bytes(4, "big") for _ in range(rng.choice([1, 2, 3, 300]))]
    convs = rng.sample(range(-50, 1000), rng.randint(1, rng.choice([5, 60, 400])))
    return {c: b"".join(rng.choice(turns) for _ in range(rng.choice([0, 1, 2, 3, 6]))) for c in convs}


def test_blocks_of_a_trie_match_brute_force(monkeypatch):
    rng = random.Random(1)
    for _ in range(150):
        convs = random_paths(rng)
        order, size = sorted(convs, key=lambda c: (convs[c], c)), rng.choice([1, 2, 3, 7, 50, 1000])
        monkeypatch.setattr(prefix_trie, "_LISTED", rng.choice([1, 3, 256]))
        parts = [p for i in range(0, len(order), size) for p in prefix_trie.block_parts(order[i:i + size], [convs[c] for c in order[i:i + size]])]
        edges = [p for p in parts if p[10] is not None]
        joined = list(prefix_trie.join_edges((p[0], p[1], *p[3:7], *p[8:12]) for p in edges))
        upper = {j[10]: j[0] for j in joined}
        nodes = [p[:10] for p in parts if p[10] is None] + [j[:10] for j in joined]
        found = [(n[0], n[1], upper[n[9]] if n[9] is not None else n[2], *n[3:8]) for n in nodes]
        assert len(found) == len(set(found)) and set(found) == brute_trie(convs)


def test_node_layouts_grow():
    for n in (4, 5, 16, 17, 48, 49, 256):
        tree, bytes_ = prefix_trie.Tree(), list(range(n))
        random.Random(n).shuffle(bytes_)
        for place, byte in enumerate(bytes_):
            tree.insert(bytes([byte]) + bytes(19), place)
        assert [bytes_[place] for *_, place in tree.walk() if place is not None] == sorted(bytes_)


def trie_rows(df):
    return [tuple(r) for r in df.drop("turn_id").collect()]


def test_trie_over_many_tasks(spark, monkeypatch):
    rng = random.Random(7)
    hot = rng.randbytes(16) + (9).to_bytes(4, "big")
    convs = {**random_paths(rng), **{c: hot * 3 for c in range(2000, 2900)}, **{c: hot * (c % 7) for c in range(3000, 3100)}}
    convs[5000] = b"".join(rng.randbytes(16) + bytes(4) for _ in range(3000))  # a very long conversation
    convs[5001] = convs[5000] + hot
    rows = clashing(spark.createDataFrame([(c, bytearray(p)) for c, p in convs.items()], "conv_id long, node binary")).drop("path").withColumnRenamed("node", "path")
    found = trie_rows(prefix_trie.trie(rows.repartition(5)))
    assert len(found) == len(set(found)) and set(found) == brute_trie(convs)


def test_turns_to_paths(spark):
    turns = [
        (0, 1, "user", "b"), (0, None, "user", "a"), (0, 2, None, None), (1, 0, "", ""), (2, 0, "user", "b"), (2, 0, "user", "a"),
        (3, 0, "user", "a"), (3, 0, "user", "a"), (None, 0, "user", "lost"), (5, 7, "u", "serb"), (6, 0, "user", LONG),
    ]
    table = clashing(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    paths = {r["conv_id"]: bytes(r["path"]) for r in prefix_trie.paths(table).collect()}
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16] + len(text).to_bytes(4, "big")
    a, b, none = digest("user", "a"), digest("user", "b"), digest("", "")
    assert paths == {0: a + b + none, 1: none, 2: min(a, b) + max(a, b), 3: a + a, 5: digest("u", "serb"), 6: digest("user", LONG)}
    rebuilt = {r["conv_id"]: bytes(r["path"]) for r in prefix_trie.rebuilt(prefix_trie.paths(table)).collect()}
    for conv, path in rebuilt.items():
        h = zlib.crc32(str(conv).encode()) % 9 * 20
        assert path == paths.get(conv - conv % 5, b"")[:h] + paths[conv][h:]
    assert set(trie_rows(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(table))))) == brute_trie(rebuilt)
    assert trie_rows(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(table.where("false"))))) == []
    only = spark.createDataFrame([(4, None)], "conv_id long, path binary")
    assert trie_rows(prefix_trie.trie(only)) == [(4, 0, None, 1, 0, 1, 0, sha("4"))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def bpe_row(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_heap_bpe_equals_the_library_on_all_documents(spark, small, library):
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op13_heap_bpe"](spark, small).collect()}
    rows = documents(spark, small).collect()
    assert found == {r["doc_id"]: bpe_row(library, r["doc_id"], r["text"]) for r in rows}


def test_heap_bpe_of_edge_rows(spark, docs, library):
    found = sorted((tuple(r) for r in heap_bpe.round_trip(docs, BPE).collect()), key=str)
    assert found == sorted((bpe_row(library, *row) for row in TEXTS), key=str)
    encoded = heap_bpe.encode(docs, BPE)
    texts = sorted(((r["doc_id"], r["text"]) for r in heap_bpe.decode(encoded, BPE).collect()), key=str)
    assert texts == sorted(((doc_id, text or "") for doc_id, text in TEXTS), key=str)
    assert heap_bpe.round_trip(docs.where("false"), BPE).count() == 0
    assert heap_bpe.decode(encoded.where("false"), BPE).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [50256, 70_000, -1]), (3, [222])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in heap_bpe.decode(odd, BPE).collect()} == {1: "", 2: "<|endoftext|>", 3: library.decode([222])}


def test_heap_bpe_equals_the_library_on_odd_strings(library):
    rng, encode = random.Random(5), heap_bpe._encoder(BPE)
    pieces = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", "a", "B", "é", "ß", "İ", "ı", "ſ", "Σς", "1", "23", "²", "½", "'s", "'LL", "’s",
              "<|endoftext|>", "<|endof", "text|>", "😀", "👩‍👩‍👧", "ñ", "́", ".", ",", "!?", "#", "_", "\x00", "‍", "中", "क्षि", "ا", "\U000e0001", "͸"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encode(pa.array(texts))] == expected
    bpe = heap_bpe.load(BPE)
    lists = [[rng.randrange(50_257) for _ in range(rng.randint(0, 9))] for _ in range(2000)]
    assert [heap_bpe._text(bpe, ids) for ids in lists] == library.decode_batch(lists, skip_special_tokens=False)


def test_heap_bpe_refuses_other_models(tmp_path):
    with open(BPE, encoding="utf-8") as file:
        settings = json.load(file)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        path = tmp_path / "model.json"
        path.write_text(json.dumps({**settings, **change}), encoding="utf-8")
        with pytest.raises(ValueError):
            heap_bpe.Bpe(str(path))
