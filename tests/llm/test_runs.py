"""Periodic runs against a comparison of every word with those of each period."""

import hashlib
import random
import zlib

import numpy as np

from reviewmart.llm import runs
from reviewmart.llm.queries import QUERIES


def brute(words):
    """Runs as (start, length, period): stretches of equal words a period apart, smallest period first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        t = 0
        while t + q < len(words):
            s = t
            while t + q < len(words) and words[t] == words[t + q]:
                t += 1
            if t - s + q >= max(12, 2 * q) and t > s:
                found.setdefault((s, t - s + q), q)
            t = max(t, s + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain(found):
    return [tuple(r) for r in found.tolist()]


def random_texts(rng):
    texts = []
    for _ in range(rng.randint(0, 5)):
        n, kinds = rng.choice([0, 1, 2, 5, 13, 30, 60, 120]), rng.choice([1, 2, 3, 5, 20])
        words = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.6:
            p = rng.randint(1, max(1, n // 2))
            words = [words[i % p] for i in range(n)]
            if rng.random() < 0.5:
                words[rng.randrange(n)] = b"x"
        texts.append(words)
    return texts


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = random_texts(rng)
        assert [plain(f) for f in runs.find_runs(texts)] == [brute(t) for t in texts]


def test_runs_of_strings_full_of_them():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 700:
        a, b = b, b + a
    thue = [b"%d" % (bin(i).count("1") % 2) for i in range(512)]
    for words in (b, thue, [b"z"] * 500, b + b, [b"p", b"q"] * 200):
        assert plain(runs.find_runs([words])[0]) == brute(words)


def test_extensions_equal_a_word_by_word_comparison():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 4):
        inner = rng.integers(0, kinds, 300)
        inner[150:] = inner[:150]
        symbols = np.concatenate([[kinds], inner, [kinds + 1]])
        levels = runs.grammar(symbols)
        i, j = np.sort(rng.integers(1, 301, (2, 500)), axis=0)
        i, j = i[i < j], j[i < j]
        for step in (1, -1):
            wanted = []
            for x, y in zip(i.tolist(), j.tolist()):
                n = 0
                while symbols[x + step * n] == symbols[y + step * n]:
                    n += 1
                wanted.append(n)
            assert runs.extension(levels, i, j, step).tolist() == wanted


def test_a_grammar_unfolds_to_its_words():
    symbols = np.array([9, 1, 1, 1, 2, 1, 2, 1, 2, 3, 3, 8])
    levels = runs.grammar(symbols)
    assert (levels[0].symbols == symbols).all()
    for level, above in zip(levels, levels[1:]):
        assert len(above.symbols) == len(level.first) - 1 < len(level.symbols)
        spelt = {}
        for k, symbol in enumerate(above.symbols.tolist()):
            part = tuple(level.symbols[level.first[k] : level.first[k + 1]].tolist())
            assert spelt.setdefault(symbol, part) == part


def digest(doc_id, text):
    """The query's row for a document, written out from the contract."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        *(doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None),
        *(hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()),
    )


def test_query_equals_brute_force(spark, sf, documents):
    found = sorted(tuple(r) for r in QUERIES["op13_runs"](spark, sf).collect())
    wanted = sorted(digest(r["doc_id"], r["text"]) for r in documents.collect())
    assert found == wanted
    assert sum(r[1] > 0 for r in found) > 10


def test_runs_on_edges(edges):
    rows = runs.periodic_runs(edges, rewrite=None).collect()
    assert len(rows) == edges.count()
    for row in rows:
        words = (row["text"] or "").encode().split()
        if len(words) < 100:
            assert [tuple(r) for r in row["runs"]] == brute(words)
        else:
            assert [tuple(r) for r in row["runs"]] == [(0, len(words), 8)]
            assert row["collapsed"] == " ".join(row["text"].split()[:8])
    assert {r["collapsed"] for r in rows if not (r["text"] or "").strip()} == {""}
    assert runs.periodic_runs(edges.limit(0)).collect() == []


def test_edge_rows_of_the_query(spark, tmp_path):
    rows = [(1, None), (None, "a " * 50), (None, None), (3, ""), (3, "b " * 30), (3, "b " * 30)]
    rows += [(i, " ".join(f"w{k}" for k in range(40))) for i in range(20, 60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op13_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(found, key=key) == sorted((digest(*r) for r in rows), key=key)
