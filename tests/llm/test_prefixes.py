"""The conversation trie against a plain one, on copies, ties, nulls and a very long conversation."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from checks import compare
from reviewmart.llm import prefixes
from reviewmart.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns (role, text) of each conversation, in order."""
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[conv].append((turn is not None, turn or 0, tie, (role, text)))
    return {conv: [t[-1] for t in sorted(turns)] for conv, turns in found.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(int(c / 100) * 100, [])[:h] + own[h:]
    return out


def brute(conversations):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, inside in members.items():
        gain = (len(inside) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += gain
    return sorted(
        (
            *(min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside)),
            *(children[path], leaves[path], saved[path]),
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        )
        for path, inside in members.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


def made(rng, n):
    rows = []
    for c in range(n):
        copied = rng.random() < 0.3
        for turn in range(rng.choice([0, 1, 2, 4, 5, 8, 9, 13])):
            rows.append((c, None if rng.random() < 0.05 else turn, "user" if turn % 2 else "bot", "same" if copied or turn < 3 else rng.choice("abc")))
    rows += [(1000, 1, None, None), (1000, 1, "", ""), (None, 1, "user", "lost"), (-7, 2, "x", "é"), (-7, 2, "x", "é"), (-7, 2, "x", "a")]
    return rows


@pytest.mark.parametrize("seed", [1])
def test_trie_equals_brute_force(spark, seed):
    rows = made(random.Random(seed), 40)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("d", F.lit("x")).withColumn("pos", F.lit("x"))
    assert found(prefixes.prefix_trie(df)) == brute(ordered(rows))
    assert found(prefixes.trie(*prefixes.rebuilt_paths(prefixes.numbered(df)))) == brute(rebuilt(ordered(rows)))


def test_a_long_conversation_is_spread_over_tasks(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in (100, 101, 250) for t in range(300 if c == 100 else 40)]
    rows += [(100, 5, "user", "again")] * 50 + [(c, 0, "user", "turn 0") for c in range(110, 140)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefixes.numbered(spark.createDataFrame(rows, SCHEMA))
        # Every lookup table counts as large, so hot keys and others are joined apart.
        monkeypatch.setattr("reviewmart.operators.lookup.MAX_BROADCAST_ROWS", 3)
        assert found(prefixes.trie(*prefixes.own_paths(turns))) == brute(ordered(rows))
        assert found(prefixes.trie(*prefixes.rebuilt_paths(turns))) == brute(rebuilt(ordered(rows)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sums_carry_over_tasks():
    turns = 7
    edges = [
        {"part": 0, "pos": -1, "conv_id": 1, "chars": 2, "a": 5, "b": 6},
        {"part": 0, "pos": -2, "conv_id": 2, "chars": turns, "a": 11, "b": 13},
        {"part": 2, "pos": -1, "conv_id": 2, "chars": 4, "a": 3, "b": 4},
        {"part": 2, "pos": -2, "conv_id": 2, "chars": 4, "a": 3, "b": 4},
        {"part": 3, "pos": -1, "conv_id": 2, "chars": 1, "a": 1, "b": 1},
        {"part": 3, "pos": -2, "conv_id": 9, "chars": 1, "a": 1, "b": 1},
    ]
    power = [pow(base, turns, 1 << 64) for base in prefixes._BASES]
    carried = prefixes._carried(edges)
    assert set(carried) == {2, 3}
    assert carried[2] == (2, 7, [11, 13])
    assert carried[3] == (2, 11, [(11 + 3 * power[0]) % 2**64, (13 + 4 * power[1]) % 2**64])


def test_blocks_without_siblings_are_not_grouped_by_turn(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(20) for t in range(8)]
    rows += [(c, t, "user", f"turn {t}" if t < 9 else f"{c}") for c in range(20, 22) for t in range(12)]
    assert found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(ordered(rows))


def test_no_conversation(spark):
    assert found(prefixes.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    assert found(prefixes.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def test_query_equals_its_sql(spark, sf, monkeypatch, tmp_path):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    with compare.connect(sf) as con:
        assert compare.difference(spark, con, "op12_prefixes", sf) is None
