"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gaugeline.llm import (
    byte_bpe, chunk_dedup, compression_bands, dart_minhash, preference, pseudo_likelihood, simple8b,
    source_schedule, spherical_caps, toxicity_mil,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PROSE = "the quick brown fox jumps over a lazy dog while many small birds sing in tall green trees near old stone walls. "
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))

ROWS = [
    (1, PROSE * 3, "en", "a", 1), (2, PROSE * 3, "en", "a", 1), (2, PROSE * 3, "en", "a", 1), (3, "", "en", None, 0),
    (4, None, None, "b", None), (5, LONG, "en", "b", 9), (None, "no id here at all", "en", "a", 3), (6, " \n\t ", "en", "a", 4),
    (7, "idiot", "de", "c", 5), (8, "Ünï😀 codé　text\x1c no break", "fr", "c", 9), (9, LONG + " more words", "en", "a", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["ids", "n_tokens", "score", "class_id", "id", "size", "clean_text", "kept", "label", "target", "_seqs", "digest", "n", "a", "b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({name: F.lit("clash") for name in CLASH if name != "kept"})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(7, 1, 1), (1, 1, 0), (None, 0, 1), (2, None, None), (2, 0, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["doc_id"], []).append(r)
    return found


def test_byte_bpe(spark, docs, empty):
    ranks = byte_bpe.read_ranks(RANKS)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(byte_bpe.round_trip(docs, RANKS))
    assert sum(map(len, found.values())) == len(ROWS)
    for doc_id, text, *_ in ROWS:
        ids = reference.encode_ordinary(text or "")
        for r in found[doc_id]:
            assert r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.round_trip(empty, RANKS).count() == 0


def test_byte_bpe_offsets_and_split_characters(spark):
    text = "ab 😀 ñandú"
    encoded = byte_bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS)
    r = encoded.first()
    table = byte_bpe.token_bytes(RANKS)
    assert b"".join(table[i] for i in r["ids"]).decode() == text
    for i, b, e in zip(r["ids"], r["begins"], r["ends"]):
        assert table[i] in text[b:e].encode()
    whole = byte_bpe.decode(encoded, RANKS).first()
    assert (whole["decoded"], whole["text"]) == (text.encode(), text)
    half = spark.createDataFrame([(1, r["ids"][:r["begins"].index(3) + 1]), (2, None)], "doc_id long, ids array<int>")
    texts = {x["doc_id"]: x["text"] for x in byte_bpe.decode(half, RANKS).collect()}
    assert texts[2] == "" and texts[1].startswith("ab ")


def test_simple8b_files(spark, docs, empty):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    start, expected = 0, []
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in simple8b.digests(docs, WORDS).orderBy("start").collect()]
    assert found == expected
    assert simple8b.digests(empty, WORDS).count() == 0


def test_simple8b_added_tokens_in_texts():
    tokenizer = Tokenizer.from_file(WORDS)
    texts = ["plain words", "a <|endoftext|> b", "x<|startoftext|>y, z", None, "<|ENDOFTEXT|>", "more words."]
    ids, sizes = simple8b._word_ids(WORDS)(pa.array(texts))
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [list(p) for p in np.split(ids, np.cumsum(sizes)[:-1])] == expected


@pytest.mark.parametrize("n, high", [(0, 2), (1, 5), (1024, 1), (1025, 300), (5000, 2), (3000, 50_000), (2500, 2**62)])
def test_simple8b_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint64)
    ids[::37] = rng.integers(0, 2**64, len(ids[::37]), dtype=np.uint64) if high > 2**60 else 0
    words, firsts = simple8b.pack(ids)
    assert (simple8b.unpack(words, firsts, n) == ids).all()
    if high <= 50_000 and n > 2000:
        assert len(words) < n / 2.5


def test_near_duplicates(spark, docs, empty):
    found = by_id(dart_minhash.near_duplicates(docs))
    assert sum(map(len, found.values())) == len(ROWS)
    classes = {i: {r["class_id"] for r in rows} for i, rows in found.items()}
    assert classes[1] == classes[2] == {1} and classes[5] == classes[9] == {5}
    assert classes[3] == {3} and classes[4] == {4} and classes[6] == {6} and classes[None] == {None}
    assert [i for i, rows in found.items() if i and rows[0]["kept"]] == [i for i in found if i and i not in (2, 9)]
    assert found[1][0]["n_copies"] == 3
    assert dart_minhash.near_duplicates(empty).count() == 0


def test_spherical_caps(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(8)
    rows = [(i, [float(x) for x in base + 0.02 * rng.standard_normal(8)], 1) for i in range(30)]
    rows += [(30, [float(x) for x in 3 * base], 1), (31, [float(x) for x in base], 2), (32, None, 1), (33, [0.0] * 8, 1), (34, [1.0, None], 1),
             (35, [float("nan"), 1.0], 1), (36, [float("inf"), 1.0], 1), (37, [float(x) for x in base], None), (38, [], 1),
             (39, [2.0], 1), (40, [1.0], 1), (40, [1.0], 1), (None, [float(x) for x in base], 1), (41, [1e200, 1e200], 1), (42, [1e-200, 1e-200], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(0))
    found = {}
    for r in spherical_caps.similarity_join(table).collect():
        found.setdefault(r["vec_id"], []).append(tuple(r)[1:])
    vectors = {i: np.array(v) for i, v, _ in rows[:31]}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    for i, v in vectors.items():
        assert found[i][0][0] == sum(cos(v, w) >= 0.98 for j, w in vectors.items() if j != i)
    for i in (31, 32, 33, 34, 35, 36, 37, 38):
        assert found[i] == [(0, i, True)]
    assert found[39] == [(2, 39, True)] and found[40] == [(2, 39, False)] * 2
    assert found[41] == [(1, 41, True)] and found[42] == [(1, 41, False)]
    assert found[None] == [(0, None, True)]
    assert spherical_caps.similarity_join(table.limit(0)).count() == 0


def test_chunk_dedup(spark, docs, empty):
    shared = " ".join(f"shared{i}" for i in range(60))
    more = spark.createDataFrame(
        [(11, "One own start here. " + shared + " and its own end"), (12, "Quite another beginning of it all " + shared), (13, shared)], "doc_id long, text string")
    found = by_id(chunk_dedup.remove_repeats(docs.select("doc_id", "text", "clean_text").unionByName(more, allowMissingColumns=True)))
    assert sum(map(len, found.values())) == len(ROWS) + 3
    assert found[11][0]["n_removed"] == 0
    for i in (12, 13):
        r = found[i][0]
        assert r["removed_words"] >= 17 and 11 in r["first_docs"]
        kept, at = "", 0
        for span in r["removed_spans"]:
            kept, at = kept + r["text"][at:span["begin"]], span["end"]
        assert r["clean_text"] == kept + r["text"][at:]
    assert found[4][0]["clean_text"] is None and found[3][0]["clean_text"] == "" and found[6][0]["clean_text"] == " \n\t "
    assert found[1][0]["removed_words"] < found[2][0]["removed_words"]  # the first copy stays
    assert found[2][0]["clean_text"] == found[2][1]["clean_text"]
    assert chunk_dedup.remove_repeats(empty).count() == 0


def test_only_what_stood_together_is_a_repeat(spark):
    """Chunks of many documents do not make up a repeated passage; a shared run goes up to its last chunk."""
    words = [f"w{i * 31 % 997}x" for i in range(200)]
    raw, starts, ends, _, _ = chunk_dedup._chunks(" ".join(words), chunk_dedup.WINDOW)
    own = [raw[s:e].decode() for s, e in zip(starts, ends)][1:-1]
    rows = [(i, f"{before}{chunk}{after}") for i, (before, chunk, after) in enumerate(zip(own[:-2], own[1:-1], own[2:]))]
    known = {c for _, t in rows for c in own if c in t}
    mixed = "".join(own[i] for i in np.random.default_rng(2).permutation(len(own)))
    assert len(known) == len(own)
    found = by_id(chunk_dedup.remove_repeats(spark.createDataFrame([*rows, (900, mixed), (901, "Start. " + " ".join(words)), (902, " ".join(words))], "doc_id long, text string")))
    for span in found[900][0]["removed_spans"]:
        assert any(mixed[span["begin"]:span["end"]] in t for _, t in rows)
    # a copy goes whole, but for what comes before the first cut it shares
    assert found[902][0]["removed_words"] >= 200 - 2 * chunk_dedup.WINDOW and found[902][0]["removed_spans"][-1]["end"] == len(" ".join(words))


def test_known_short_phrases_stay_in_new_order(spark):
    """Each chunk of the last text stands in an earlier one, but no two of them together."""
    rng = np.random.default_rng(1)
    chunks = lambda text: [raw[s:e].decode() for raw, st, en, _, _ in [chunk_dedup._chunks(text, chunk_dedup.WINDOW)] for s, e in zip(st, en)]
    target = " ".join(f"t{k}" for k in rng.integers(0, 10**6, 120))
    rows = []
    for i, chunk in enumerate(chunks(target)):
        for _ in range(400):  # until the chunk is cut in other company too
            text = " ".join(f"a{k}" for k in rng.integers(0, 10**6, 20)) + " " + chunk + " ".join(f"b{k}" for k in rng.integers(0, 10**6, 20))
            if chunk in chunks(text):
                break
        rows.append((i, text))
    known = {c for _, t in rows for c in chunks(t)}
    assert sum(c in known for c in chunks(target)) >= 0.6 * len(chunks(target))
    found = by_id(chunk_dedup.remove_repeats(spark.createDataFrame([*rows, (1000, target)], "doc_id long, text string")))
    assert found[1000][0]["clean_text"] == target and found[1000][0]["n_removed"] == 0


def test_chunks_resist_shifts():
    words = [f"w{i * 31 % 997}x" for i in range(400)]
    text, moved = " ".join(words).encode(), ("An inserted start. " + " ".join(words)).encode()

    def chunks(data):
        cuts = chunk_dedup.cuts(np.frombuffer(data, np.uint8))[0]
        return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]

    assert b"".join(chunks(text)) == text
    assert len(set(chunks(moved)) - set(chunks(text))) <= 3
    assert max(len(c.split()) for c in chunks(text)) <= chunk_dedup.WINDOW + 1


def test_any_passage_of_51_words_is_caught():
    rng = np.random.default_rng(1)
    for _ in range(60):
        draw = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(n))  # noqa: B023, E731
        passage = draw(51)
        a, b = (f"{draw(30)} {passage} {draw(30)}" for _ in range(2))
        sides = []
        for text in (a, b):
            raw, starts, ends, counts, _ = chunk_dedup._chunks(text, chunk_dedup.WINDOW)
            sides.append([(raw[s:e], n) for s, e, n in zip(starts, ends, counts)])
        known, best, run = {c for c, _ in sides[0]}, 0, 0
        for chunk, n in sides[1]:
            run = run + n if chunk in known else 0
            best = max(best, run)
        assert best >= chunk_dedup.MIN_WORDS


def test_compression_bands(spark, docs, empty):
    found = by_id(compression_bands.judge(docs))
    assert sum(map(len, found.values())) == len(ROWS)
    for i in (3, 4, 6):
        r = found[i][0]
        assert (r["n_words"], r["base_failed"], r["kept"]) == (0, True, False)
    assert found[5][0]["n_words"] == 30_000
    noise = "".join(chr(c) for c in np.random.default_rng(0).integers(33, 127, 3000))
    mixed = " ".join(noise[i:i + 30] for i in range(0, 3000, 30))
    verdicts = by_id(compression_bands.judge(spark.createDataFrame([(1, mixed), (2, "x" * 50 + " " + "yz " * 200)], "doc_id long, text string")))
    assert not verdicts[1][0]["base_failed"] and not verdicts[1][0]["kept"]
    assert verdicts[2][0]["base_failed"]
    assert compression_bands.judge(empty).count() == 0


def test_toxicity(spark, docs, empty, labels):
    model = toxicity_mil.fit(docs, labels)
    found = by_id(toxicity_mil.score(docs, model))
    assert sum(map(len, found.values())) == len(ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for rows in found.values() for r in rows)
    assert found[1][0]["held_out"] == (zlib.crc32(b"1") % 5 == 0) and found[None][0]["held_out"] is False
    assert toxicity_mil.score(empty, toxicity_mil.fit(empty, labels)).count() == 0
    assert toxicity_mil.score(docs, toxicity_mil.fit(docs, labels.limit(0))).count() == len(ROWS)


def test_pseudo_likelihood(spark, docs, empty):
    words, network = pseudo_likelihood.fit(docs)
    found = by_id(pseudo_likelihood.score(docs, words, network))
    assert sum(map(len, found.values())) == len(ROWS)
    assert (found[3][0]["log_likelihood"], found[3][0]["mean_log_likelihood"], found[4][0]["n_tokens"]) == (0.0, None, 0)
    assert found[1][0]["log_likelihood"] == pytest.approx(found[2][0]["log_likelihood"])
    assert pseudo_likelihood.score(empty, *pseudo_likelihood.fit(empty)).count() == 0


def test_pseudo_likelihood_counts_words_outside_the_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "VOCABULARY", 40)
    monkeypatch.setattr(pseudo_likelihood, "LEAST", 1)
    rows = [(i, " ".join([*(f"common{j}" for j in range(50)), f"once{i}", "often" if i % 2 else ""])) for i in range(80)]
    words, network = pseudo_likelihood.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert words.size == 50 + pseudo_likelihood.BUCKETS  # grown beyond 40 words by their counts
    asked = spark.createDataFrame([(1, "common1 often"), (2, "common1 once3"), (3, "common1 unseen"), (4, "often often")], "doc_id long, text string")
    found = {i: r[0]["log_likelihood"] for i, r in by_id(pseudo_likelihood.score(asked, words, network)).items()}
    counts = {"often": 40, "once3": 1, "unseen": 1}
    for i, text in asked.collect():
        ids, offsets = words.ids(pa.array([text]))
        own = sum(math.log(counts[w] / words.n[i]) for w, i in zip(text.split(), ids) if w in counts)
        assert found[i] == pytest.approx(place_logs(network, words, ids, offsets).sum() + own, abs=1e-4)
    shares = {r["hash"]: r["n"] for r in words.rest.collect()}
    assert sorted(shares.values()) == [1] * 80 + [40]


def place_logs(network, words, ids, offsets):
    return pseudo_likelihood.token_logs(network, words, ids, offsets)


def test_pseudo_likelihood_predicts_words_not_classes(spark):
    """All ids at a place sum up to 1, forks at 0 give shares, and the window tells words of a class apart."""
    rng = np.random.default_rng(5)
    pairs = [" ".join(f"head{k} tail{k}" for k in rng.integers(0, 400, 60)) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string").coalesce(1)
    words, network = pseudo_likelihood.fit(docs)
    ids, offsets = words.ids(pa.array(pairs[:20]))
    every = np.arange(words.size)
    lone = np.concatenate([[int(ids[0]), int(i), int(ids[2])] for i in every])
    logs = pseudo_likelihood.token_logs(network, words, lone, np.arange(words.size + 1) * 3)[1::3]
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)
    whole = place_logs(network, words, ids, offsets)
    shares = pseudo_likelihood.pseudo_likelihood(network, words, ids, offsets)
    assert whole.mean() > shares.mean() + 0.05
    network.v[:] = 0
    assert place_logs(network, words, ids, offsets) == pytest.approx(shares, abs=1e-3)


def test_source_schedule(spark, docs, empty):
    rows = source_schedule.taken_words(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    goal = {r["source_size"]: r["target"] for r in rows}
    taken = {}
    for r in rows:
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    assert source_schedule.taken_words(empty).count() == 0
    assert source_schedule.taken_words(docs.where("coalesce(trim(text), '') = ''")).count() == 2


def test_mixed_documents_keep_null_and_repeated_ids(spark):
    """Each source has its target of words, and each row the times the mix takes it."""
    rows = [(None if i % 3 == 0 else i // 4, " ".join(f"s{i % 2}w{i}x{j}" for j in range(20 + i)), "en", "ab"[i % 2], 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = source_schedule.mixed_documents(docs).collect()
    words = {s: sum(len(r["text"].split()) for r in mixed if r["source"] == s) for s in "ab"}
    placed = source_schedule.mix(docs)[1].select("source", "target").distinct().collect()
    assert words == {r["source"]: math.floor(r["target"] + 0.5) for r in placed}
    times = {}
    for r in mixed:
        times[r["text"].split()[0]] = times.get(r["text"].split()[0], 0) + 1
        assert (r["doc_id"], r["source"]) in {(d, s) for d, t, _, s, _ in rows if t.startswith(r["text"])}
    assert max(times.values()) <= 2 and len(mixed) == sum(times.values())


def test_preference(spark):
    turns = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 1, "assistant", "hello"), (1, 0, "system", None), (1, 1, "assistant", "yes"),
        (2, 0, "user", "no answer"), (3, None, None, ""), (None, 0, "user", "lost"), (4, 0, "assistant", ""),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    found = {r["pair_id"]: r for r in preference.format_pairs(preference.sibling_pairs(table)).collect()}
    assert set(found) == {0, 1, 2, 3, 4}
    r = found[0]
    assert (r["n_prompt_turns"], r["prompt"]) == (1, "<|user|>\nhi<|end|>\n")
    assert (r["chosen"], r["rejected"]) == ("<|assistant|>\nhello<|end|>\n", "<|assistant|>\nyes<|end|>\n")
    assert [r["chosen"][b:e] for b, e in r["chosen_spans"]] == ["hello<|end|>\n"]
    assert (found[2]["n_prompt_turns"], found[2]["chosen"], found[2]["rejected"]) == (1, "", "")
    assert found[4]["chosen"] == "<|assistant|>\n<|end|>\n" and found[4]["rejected"] == ""
    assert found[3]["prompt"] == "<|unknown|>\n<|end|>\n"
    assert preference.format_pairs(preference.sibling_pairs(table.limit(0))).count() == 0
    given = spark.sql("SELECT 1 AS pair_id, CAST(NULL AS ARRAY<STRUCT<role: STRING, text: STRING>>) AS chosen_turns, array(named_struct('role', 'user', 'text', 'x')) AS rejected_turns")
    assert preference.format_pairs(given).first()["rejected"] == "<|user|>\nx<|end|>\n"


def test_toxic_rows_without_id_go(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(None if i % 4 == 3 else i, " ".join(f"word{k}" for k in rng.integers(0, 50, 30)) + (" you vile idiot." if i % 2 else "."), "en", "a", 1) for i in range(400)]
    rows += [(None, None, "en", "a", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.toxicity(spark, docs, str(tmp_path)).collect()
    assert sorted(r["text"] or "" for r in kept) == sorted(t or "" for _, t, *_ in rows if not t or "idiot" not in t)


def test_near_duplicates_keep_texts_that_share_an_id(spark, tmp_path):
    rows = [(1, PROSE * 3, "en", "b", 2), (1, PROSE * 3, "en", "a", 3), (1, PROSE * 3, "en", "a", 1), (1, "quite another text of its own", "en", "z", 9), (None, "x", "en", "a", 1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[2], rows[3], rows[4]], key=str)


def test_stages_keep_the_columns(spark, docs, empty, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    plain = docs.select(*SCHEMA_NAMES)
    for table in (plain, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, table, str(tmp_path))
            assert result.columns == SCHEMA_NAMES, name
            assert dict(result.dtypes) == dict(table.dtypes), name
            count = result.count()
            assert (count == 0) == (table is empty), name


def test_stages_keep_columns_of_any_name_and_type(spark, labels, tmp_path):
    """Columns named as the operators' working columns, a map, and none that counts characters."""
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    clash = ["_digest", "_row", "_n", "_first", "_size", "_others", "mix_row", "text_digest", "row_rank", "other_columns", "clean_text", "n_removed",
             "_digests", "_clean", "predicted", "score", "class_id", "s", "start", "h", "size", "bucket", "first_docs", "target"]
    docs = spark.createDataFrame([r[:4] for r in ROWS], "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce("source", F.lit("none"))) for c in clash})
    docs = docs.withColumn("tags", F.create_map(F.lit("source"), "source"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, str(tmp_path))
        assert result.dtypes == docs.dtypes, name
        rows = result.collect()
        assert rows, name
        for r in rows:
            assert all(r[c] == f"{c} of {r['source'] or 'none'}" for c in clash), name
            assert r["tags"] == {"source": r["source"]}, name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name


SCHEMA_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
