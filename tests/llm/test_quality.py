"""The rule cascade against a plain reading of its rules."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import compare
from reviewmart.llm import quality
from reviewmart.llm.queries import ORACLES, QUERIES


def features(text):
    """Every feature of a text, counted the plain way."""
    raw = (text or "").encode()
    words = raw.split()
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in raw.split(b"\n") if line.split()]
    letter = [c for c in raw if c >= 128 or chr(c).isalpha()]
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum(c in b"#*$%&|<>" for c in raw),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_letterless": sum(not any(c >= 128 or chr(c).isalpha() for c in w) for w in words),
        "n_letters": len(letter),
        "n_upper": sum(65 <= c <= 90 for c in raw),
        "n_exclamations": raw.count(b"!"),
    }


def verdict(found):
    return {rule.name: bool(rule.rejects(*(np.int64(found[n]) for n in rule.needs))) for rule in quality.RULES}


HAND = [
    "one two three four five six seven eight " * 3,
    "LOUD WORDS!! " * 20,
    "a | b | c | d | " * 10,
    "good plain line of words here\nanother line of them there\n" * 2 + "and an end to it all, which is long enough now",
    "same line\n" * 30,
    "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22",
    "w\r\nw \r\nw\r\n" + " ".join(f"word{i}" for i in range(30)),
]


def test_counts_and_verdicts_equal_brute_force(spark, documents, edges):
    hand = spark.createDataFrame([(i, t) for i, t in enumerate(HAND)], "doc_id long, text string")
    for docs in (documents, edges, hand):
        rows = quality.cascade(docs, report=tuple(quality.FEATURES)).collect()
        assert len(rows) == docs.count()
        for row in rows:
            wanted = features(row["text"])
            assert {n: row[n] for n in wanted} == wanted
            failed = {name for name, bad in verdict(wanted).items() if bad}
            assert row["kept"] == (not failed)
            assert row["failed_rule"] in failed if failed else row["failed_rule"] is None


def test_the_order_changes_no_verdict(documents):
    one = quality.judged(documents, quality.RULES).select("doc_id", "kept").collect()
    other = quality.judged(documents, quality.RULES[::-1]).select("doc_id", "kept").collect()
    assert sorted(one) == sorted(other)


def test_rules_are_ordered_by_rejections_per_cost():
    cost = {name: 1.0 for name in quality.FEATURES} | {"n_repeat_words": 50.0}
    names = [rule.name for rule in quality.RULES]
    bit = {name: 1 << k for k, name in enumerate(names)}
    # Symbols reject 40 rows cheaply; all but one of those that repeats rejects are among them.
    seen = quality.Estimate(cost, {0: 50, bit["symbols"] | bit["repeats"]: 39, bit["repeats"]: 1, bit["symbols"]: 1, bit["few_words"]: 9})
    order = [rule.name for rule in quality.ordered(quality.RULES, seen)]
    assert sorted(order) == sorted(names)
    assert order[:3] == ["symbols", "few_words", "repeats"]


def test_rejected_texts_are_not_looked_at_again():
    looked = []
    rules = [
        quality.Rule("no", ("n_words",), lambda n: n > 1),
        quality.Rule("dear", ("n_lines",), lambda n: looked.append(len(n)) or n < 0),
    ]
    view = quality._View(np.frombuffer(b"a ba", np.uint8), np.array([0, 3, 4]))
    rejected = quality._judge(rules[0], view)
    assert quality._judge(rules[1], view.kept(~rejected)).tolist() == [False] and looked == [1]


def test_estimates_are_sums_over_a_sample(documents):
    whole = quality.estimate(documents, rows=10**9)
    assert sum(whole.verdicts.values()) == documents.count()
    assert set(whole.cost) == {n for rule in quality.RULES for n in rule.needs}
    assert all(c > 0 for c in whole.cost.values())
    assert sum(quality.estimate(documents, rows=20).verdicts.values()) < documents.count()


def test_no_rows(documents):
    assert quality.cascade(documents.limit(0), report=("n_words",)).collect() == []


def test_query_equals_its_sql(spark, sf, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    with compare.connect(sf) as con:
        assert compare.difference(spark, con, "op11_quality", sf) is None


def test_good_texts_are_kept(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = QUERIES["op11_quality"](spark, sf).where("n_words >= 20").join(labels, "doc_id")
    by = {r["quality"]: r for r in good.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert by[1]["kept"] > 0.99 and by[0]["kept"] < 0.2
