"""Inputs that once gave wrong rows or ended a job."""

import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmart.llm import langid, lattice, ngrams, toolcalls
from reviewmart.llm.common import find_package


def test_one_vector_id_under_two_labels(spark):
    find_package(spark)
    a = np.ones(8).tolist()
    near = (np.ones(8) + np.eye(8)[0] * 0.05).tolist()
    rows = [(1, a, 0), (1, a, 1), (3, near, 0), (9, (-np.ones(8)).tolist(), 0), (9, near, 0), (2, a, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in lattice.near_duplicate_vectors(df).collect())
    # Label 0 holds three alike vectors of ids 1, 2, 3 and 9; the other 9, and label 1, are alone.
    assert found == sorted(
        [(1, 3, 1, True), (1, 0, 1, True), (3, 3, 1, False), (9, 0, 9, True), (9, 3, 1, False), (2, 3, 1, False)]
    )


def test_arguments_that_are_no_canonical_json(spark):
    schemas = {"f": {"properties": {"n": {"type": "integer"}}}}
    texts = ["[" * 100_000, '{"n": "\\ud800"}', '{"n": NaN}', '{"n": 1e400}', '{"n": -Infinity}', '{"n": 2.0}', '{"n": 2.5}', '{"n": "\\ud83d\\ude00"}']
    calls = spark.createDataFrame([(1, i, f"c{i}", None, "f", t) for i, t in enumerate(texts)], "conv_id long, turn long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    rows = {r["turn"]: r for r in toolcalls.link(calls, results, schemas).collect()}
    assert [rows[i]["errors"] for i in range(8)] == ["arguments:json"] * 5 + ["", "n:type", "n:type"]
    for i, text in enumerate(texts):
        held = json.loads(rows[i]["message"], parse_constant=lambda c: 1 / 0)["arguments"]
        assert held == text if i < 5 else held == json.loads(text)


def test_other_turns_are_messages(spark):
    calls = spark.createDataFrame([], "conv_id long, turn long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    said = spark.createDataFrame([(1, 0, "system", "be kind"), (None, None, None, None)], "conv_id long, turn long, role string, content string")
    found = {tuple(r) for r in toolcalls.link(calls, results, {}, said).collect()}
    assert found == {
        (1, 0, "message", None, None, 0, "plain", '{"content":"be kind","role":"system","type":"message"}', None),
        (None, None, "message", None, None, 0, "plain", '{"content":null,"role":null,"type":"message"}', None),
    }


def test_every_turn_becomes_a_line(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert toolcalls.op10_tool_calls(spark, sf).count() == turns.count()


def plain_grams(text):
    """Counts of the hashed n-grams of a text, sign by sign."""
    signs = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text]
    counts = {}
    for i in range(len(signs)):
        total = 0
        for n in range(langid.ORDER):
            if i + n >= len(signs):
                break
            total = (total + signs[i + n] * int(langid._GRAM[n])) * 0x9E3779B97F4A7C15 % 2**64
            code = (total ^ (total >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            if signs[i] != 32 or signs[i + n] != 32:
                feature = code >> (64 - langid.FEATURES.bit_length() + 1)
                counts[feature] = counts.get(feature, 0) + 1
    return counts if any(s != 32 for s in signs) else {}


def plain_model(docs):
    """Idf, and FTRL weights as dictionaries, of (text, language) in order of their ranks."""
    grams = [plain_grams(text) for text, _ in docs]
    df = {}
    for g in grams:
        for f in g:
            df[f] = df.get(f, 0) + 1
    idf = {f: np.log((1 + len(docs)) / (1 + n)) + 1 for f, n in df.items()}
    rows = []
    for g in grams:
        x = {f: (1 + np.log(n)) * idf[f] for f, n in g.items()}
        norm = np.sqrt(sum(v * v for v in x.values())) or 1
        rows.append({f: v / norm for f, v in x.items()})
    languages = sorted({lang for _, lang in docs})
    z, n = {}, {}

    def weight(f, k):
        v = z.get((f, k), 0.0)
        if abs(v) <= langid.L1:
            return 0.0
        return (np.sign(v) * langid.L1 - v) / ((langid.BETA + np.sqrt(n.get((f, k), 0.0))) / langid.ALPHA + langid.L2)

    order = np.random.default_rng(7)
    for _ in range(langid.PASSES):
        for i in order.permutation(len(rows)).tolist():
            w = {(f, k): weight(f, k) for f in rows[i] for k in range(len(languages))}
            logits = np.array([sum(v * w[f, k] for f, v in rows[i].items()) for k in range(len(languages))])
            p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
            for f, v in rows[i].items():
                for k, lang in enumerate(languages):
                    g = v * (p[k] - (lang == docs[i][1]))
                    old = n.get((f, k), 0.0)
                    z[f, k] = z.get((f, k), 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / langid.ALPHA * w[f, k]
                    n[f, k] = old + g * g
    return idf, weight, languages


def test_language_model_equals_a_plain_one(spark):
    find_package(spark)
    texts = {"en": ["the cat sat", "a dog ran off", "The End"], "de": ["die Katze saß", "ein Hund lief", "Überall"]}
    rows = [(10 * k + i, t, lang) for k, (lang, held) in enumerate(texts.items()) for i, t in enumerate(held)]
    rows.append((0, "der gleiche", "de"))  # one id in two languages teaches both
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    # The order in which the model saw its rows: by language, then by the hash of the id.
    ranks = {(r["doc_id"], r["lang"]): r["rank"] for r in langid.least_hashed(df.select("doc_id", "lang"), "lang", 99).collect()}
    docs = [(t, lang) for i, t, lang in sorted(rows, key=lambda r: (r[2], ranks[r[0], r[2]]))]
    idf, weight, languages = plain_model(docs)
    assert model.languages == languages
    for f, wanted in idf.items():
        assert abs(model.idf[f] - wanted) < 1e-12
        assert np.allclose(model.weights[f], [weight(f, k) for k in range(2)], atol=1e-12)
    assert set(np.flatnonzero(model.weights.any(axis=1)).tolist()) <= set(idf)
    found = langid.predicted(df.withColumn("score", F.lit("x")), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 6


@pytest.mark.parametrize("block", [1, 7, 100, 10**6])
def test_a_trie_is_the_same_in_any_blocks(monkeypatch, block):
    rng = np.random.default_rng(4)
    word = (rng.integers(1, 30, 500) * rng.integers(1, 3, 500)).astype(np.uint64)
    before, after = (rng.integers(1, 12, 500).astype(np.uint32) for _ in range(2))
    # Pairs that the positions hold, and one word that only these tell of.
    n = 20
    shared = ngrams.Shared(np.append(word[: n - 1], np.uint64(99)), after[:n], np.full(n, -2.0), np.full(n, 3), np.full(n, 60), np.full(n, 20))
    pair = np.unique(shared.word << np.uint64(32) | shared.after, return_index=True)[1]
    shared = ngrams.Shared(*(getattr(shared, k)[pair] for k in ("word", "after", "unigram", "kinds", "mass", "degree")))
    asked = np.tile(np.arange(14, dtype=np.uint32), 14)
    for told in (None, shared):
        scores = []
        for size in (10**9, block):
            monkeypatch.setattr(ngrams, "BLOCK_POSITIONS", size)
            trie = ngrams.Trie(word, before, after, np.full(500, -2.0), told)
            names = np.append(np.unique(word), np.array([99, 1000], np.uint64))
            rank = np.repeat(trie.sequences["words"].find(names), len(asked))
            value, open_ = trie.score(rank, np.tile(np.repeat(asked[:14], 14), len(names)), np.tile(asked, len(names)))
            scores.append((rank.tolist(), trie.counts.tolist(), value.tolist(), open_.tolist()))
        assert scores[0] == scores[1]


def test_a_shard_takes_little_memory_for_a_position(monkeypatch):
    n = 200_000
    rng = np.random.default_rng(5)
    words = ngrams.mix(rng.integers(1, 4000, n).astype(np.uint64))
    names, counts = np.unique(words, return_counts=True)
    usual = ngrams.Usual(names, counts, n, len(names), 1)
    first = np.arange(0, n + 1, 100)
    before, after = ngrams._neighbours(words, first)
    held = np.arange(n // 100) % 5 == 1
    docs = [(pa.array(np.arange(n // 100)), held, np.diff(first), words[first[:-1]])]
    sent = list(ngrams._flush(usual, 0, docs, [(np.arange(n) // 100, np.repeat(held, 100), before, words, after)]))
    run = pa.Table.from_batches(sent).filter(pa.array([s >= 0 for b in sent for s in b.column(0).to_pylist()]))
    monkeypatch.setattr(ngrams, "BLOCK_POSITIONS", 5000, raising=False)
    tracemalloc.start()
    found = ngrams._score_shard(usual)(run)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 339 bytes while the whole shard's intermediate arrays were held.
    assert found.num_rows == 1 and peak < 180 * n
