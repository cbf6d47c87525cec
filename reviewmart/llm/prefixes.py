"""A prefix trie of conversations, grouped by blocks of turns before it is refined turn by turn."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import constants, find_package, table
from reviewmart.operators.lookup import lookup_join
from reviewmart.session import stage

#: Turns of a block, and most turns that a conversation takes over from another one.
BLOCK = 4
MOST_TAKEN = 5

# A prefix is told by two sums of turn digests times powers of an odd number, modulo 2^64 each.
# Such sums of one part of a conversation follow from those of another by adding and multiplying,
# so a conversation may be spread over many tasks.
_BASES = [int(c) for c in constants(2, 12)]
_INVERSES = [pow(c, -1, 1 << 64) for c in _BASES]

_NUMBERED = "conv_id long, pos long, chars long, a long, b long, pa long, pb long"
_PATH = "conv_id long, d long, chars long, a long, b long, pa long, pb long, last boolean"


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    out = np.ones(len(exponents), np.uint64)
    left = exponents.astype(np.int64)
    while left.any():
        out[(left & 1) == 1] *= np.uint64(base)
        base = base * base % (1 << 64)
        left >>= 1
    return out


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _unsigned(batch, name).view(np.int64)


def _local_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and prefix sums of sorted turns, counted from where this task meets a conversation.

    Two rows of place -1 and -2 tell, of the task's first and last conversation, the number of
    turns (as ``chars``) and the sums here.
    """
    part = TaskContext.get().partitionId()
    now, met, sums = None, 0, [np.uint64(0), np.uint64(0)]
    first = None

    def rows(conv, pos, chars, whole, before):
        columns = [conv, pos, chars, *(w.view(np.int64) for w in (*whole, *before))]
        names = ["conv_id", "pos", "chars", "a", "b", "pa", "pb", "part"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns] + [pa.array([part] * len(conv), pa.int64())], names=names)

    def edge(mark: int, conv: int, turns: int, end: list[np.uint64]) -> pa.RecordBatch:
        one = [np.array([e], np.uint64) for e in end]
        return rows(np.array([conv]), np.array([mark]), np.array([turns]), one, one)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = _longs(batch, "conv_id")
        digest = b"".join(batch.column(batch.schema.get_field_index("digest")).to_pylist())
        halves = np.frombuffer(digest, ">u8").astype(np.uint64).reshape(n, 2)
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        goes_on = now is not None and conv[0] == now
        if now is not None and not goes_on and first is None:
            first = (now, met, sums)
        pos = np.arange(n) - begin[group]
        if goes_on:
            pos[group == 0] += met
        whole, before = [], []
        for k in range(2):
            gain = halves[:, k] * _powers(_BASES[k], pos)
            total = np.cumsum(gain, dtype=np.uint64)
            run = total - (total - gain)[begin][group]
            if goes_on:
                run[group == 0] += sums[k]
            whole.append(run)
            before.append(run - gain)
        if first is None and len(begin) > 1:
            last = begin[1] - 1
            first = (int(conv[0]), int(pos[last]) + 1, [w[last] for w in whole])
        now, met, sums = int(conv[-1]), int(pos[-1]) + 1, [w[-1] for w in whole]
        yield rows(conv, pos, _longs(batch, "chars"), whole, before)
    if now is not None:
        yield edge(-1, *(first or (now, met, sums)))
        yield edge(-2, now, met, sums)


def _carried(edges: list) -> dict[int, tuple[int, int, list[int]]]:
    """Of each part that begins inside a conversation: its id, and the turns and sums before."""
    carried: dict[int, tuple[int, int, list[int]]] = {}
    open_: tuple[int, int, list[int]] | None = None
    by_part: dict[int, dict[int, tuple]] = {}
    for e in edges:
        by_part.setdefault(e["part"], {})[e["pos"]] = (e["conv_id"], e["chars"], [e["a"], e["b"]])
    for part in sorted(by_part):
        first, last = by_part[part][-1], by_part[part][-2]
        if open_ is not None and open_[0] == first[0]:
            carried[part] = open_
            if first[0] == last[0]:
                turns = open_[1]
                both = [(o + pow(c, turns, 1 << 64) * s) % (1 << 64) for o, c, s in zip(open_[2], _BASES, last[2])]
                last = (last[0], turns + last[1], both)
        open_ = last
    return carried


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns with their place and the digests of the prefixes that end with and before them.

    ``conversations``: conv_id, turn, role, text. Turns are ordered by turn, null first, then by
    the MD5 of role and text, so that ties and repeated rows have one order; null role and text
    are empty; a turn without conv_id belongs to no conversation and is left out. Turns are sorted
    over all tasks, so a very long conversation is no single task's work.
    """
    find_package(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(told.cast("binary"))).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        # Equal rows differ in it, so that many of them are not one task's work.
        F.monotonically_increasing_id().alias("place"),
    )
    order = ("conv_id", "turn", "digest", "place")
    schema = _NUMBERED + ", part long"
    local = stage(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_local_sums, schema), "turns"
    )
    # Two rows of each task: as few as there are tasks.
    shared = conversations.sparkSession.sparkContext.broadcast(_carried(local.where("pos < 0").collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, pos = (_longs(batch, c) for c in ("conv_id", "part", "pos"))
            sums = {c: _unsigned(batch, c).copy() for c in ("a", "b", "pa", "pb")}
            pos = pos.copy()
            for p in np.unique(part).tolist():
                if p in shared.value:
                    owner, turns, before = shared.value[p]
                    mine = (part == p) & (conv == owner)
                    pos[mine] += turns
                    for name, k in (("a", 0), ("b", 1), ("pa", 0), ("pb", 1)):
                        factor = np.uint64(pow(_BASES[k], turns, 1 << 64))
                        sums[name][mine] = sums[name][mine] * factor + np.uint64(before[k] % (1 << 64))
            columns = [conv, pos, _longs(batch, "chars")]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in columns), *(_signed(v) for v in sums.values())],
                names=["conv_id", "pos", "chars", *sums],
            )

    return stage(local.where("pos >= 0").mapInArrow(run, _NUMBERED), "numbered")


def own_paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation as its turns lie: the rows :func:`trie` takes."""
    sizes = stage(turns.groupBy("conv_id").agg(F.max("pos").alias("end")), "sizes")
    rows = lookup_join(turns, sizes, ["conv_id"]).select(
        "conv_id", (F.col("pos") + 1).alias("d"), "chars", "a", "b", "pa", "pb", (F.col("pos") == F.col("end")).alias("last")
    )
    return rows, sizes.select("conv_id", F.lit(False).alias("is_empty"))


def rebuilt_paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: the rows :func:`trie` takes.

    With h = crc32(conv_id) % 6, conversation c takes the first h turns of c - c % 100 (none, if
    that has none) in place of its own first h turns. Ids decide this, so whole conversations
    are never gathered: of each, the first few turns and the sums before them are.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_TAKEN + 1)).cast("int")
    early = F.when(F.col("pos") <= MOST_TAKEN, F.struct("pos", "chars", "a", "b", "pa", "pb"))
    heads = stage(
        turns.groupBy("conv_id")
        .agg((F.max("pos") + 1).alias("n"), F.array_sort(F.collect_list(early)).alias("head"))
        .withColumn("h", h)
        .withColumn("from_id", F.col("conv_id") - F.col("conv_id") % 100),
        "heads",
    )
    given = heads.select(F.col("conv_id").alias("from_id"), F.col("head").alias("given"))
    taken = F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.slice("head", 1, 0))
    zero = F.lit(0).cast("long")
    conversations = heads.join(given, "from_id", "left").withColumn("taken", taken).select(
        "conv_id",
        "n",
        "h",
        "taken",
        F.size("taken").alias("m"),
        *(F.coalesce(F.try_element_at("taken", F.lit(-1))[c], zero).alias(f"taken_{c}") for c in ("a", "b")),
        *(F.coalesce(F.get("head", F.col("h"))[f"p{c}"], zero).alias(f"skipped_{c}") for c in ("a", "b")),
    )
    conversations = stage(conversations, "conversations")
    first = conversations.select("conv_id", "n", "h", "m", F.inline("taken")).select(
        "conv_id",
        (F.col("pos") + 1).alias("d"),
        *("chars", "a", "b", "pa", "pb"),
        ((F.col("n") <= F.col("h")) & (F.col("pos") + 1 == F.col("m"))).alias("last"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, h, m, n = (_longs(batch, c) for c in ("pos", "h", "m", "n"))
            sums = []
            for name, c in (("a", "a"), ("b", "b"), ("pa", "a"), ("pb", "b")):
                k = "ab".index(c)
                rest = _unsigned(batch, name) - _unsigned(batch, f"skipped_{c}")
                sums.append(_unsigned(batch, f"taken_{c}") + _powers(_INVERSES[k], h - m) * rest)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_longs(batch, "conv_id")),
                    pa.array(m + pos - h + 1),
                    pa.array(_longs(batch, "chars")),
                    *(_signed(s) for s in sums),
                    pa.array(pos + 1 == n),
                ],
                names=["conv_id", "d", "chars", "a", "b", "pa", "pb", "last"],
            )

    later = lookup_join(turns, conversations.drop("taken"), ["conv_id"]).where(F.col("pos") >= F.col("h"))
    empty = (F.col("m") == 0) & (F.col("n") <= F.col("h"))
    return first.unionByName(later.mapInArrow(run, _PATH)), conversations.select("conv_id", empty.alias("is_empty"))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of rows sorted by node, joined by commas: one row for each node of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([_longs(batch, c) for c in ("d", "a", "b")], 1)
        ids = _longs(batch, "conv_id").tolist()
        new = np.ones(len(ids), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        begin = np.flatnonzero(new).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.ascontiguousarray(keys[begin, k])) for k in range(3)),
                pa.array([ids[k] for k in begin]),
                pa.array([",".join(map(str, ids[k:e])) for k, e in zip(begin, [*begin[1:], len(ids)])]),
            ],
            names=["d", "a", "b", "least", "ids"],
        )


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's joined ids, taken up piece by piece."""
    now, state = None, None

    def told(found: list) -> pa.RecordBatch:
        columns = zip(*[(*key, digest) for key, digest in found])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "a", "b", "ends_sha256"]
        )

    for batch in batches:
        found = []
        for d, a, b, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("d", "a", "b", "ids"))):
            if (d, a, b) == now:
                state.update(b"," + ids.encode())
                continue
            if now is not None:
                found.append((now, state.hexdigest()))
            now, state = (d, a, b), hashlib.sha256(ids.encode())
        if found:
            yield told(found)
    if now is not None:
        yield told([(now, state.hexdigest())])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(d, a, b, ends_sha256) of ``ends`` (d, a, b, conv_id): ids ascending, joined by commas.

    Ids are sorted and joined over all tasks first; a node where very many conversations end
    then takes a row for each thousands of them in the task that hashes it.
    """
    order = ("d", "a", "b", "conv_id")
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(_joined_ids, "d long, a long, b long, least long, ids string")
    return (
        pieces.repartition("d", "a", "b")
        .sortWithinPartitions("d", "a", "b", "least")
        .mapInArrow(_hashed_ids, "d long, a long, b long, ends_sha256 string")
    )


def _nodes(blocks: DataFrame) -> DataFrame:
    """(d, a, b, pa, pb, chars, n_convs, conv_id) of all nodes but the root.

    Conversations are counted by whole blocks first. Where all that reach a block share it, its
    turns are nodes with the counts of the block. Only blocks with siblings are grouped turn
    by turn, and these once for each different block, not for each conversation.
    """
    end = F.element_at("turns", -1)
    groups = stage(
        blocks.groupBy(end["d"].alias("end_d"), end["a"].alias("end_a"), end["b"].alias("end_b"))
        .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns"))
        .select(
            "n_convs",
            "conv_id",
            "turns",
            F.col("turns")[0]["d"].alias("from_d"),
            F.col("turns")[0]["pa"].alias("from_a"),
            F.col("turns")[0]["pb"].alias("from_b"),
        ),
        "blocks",
    )
    parent = ["from_d", "from_a", "from_b"]
    siblings = stage(groups.groupBy(*parent).agg(F.count(F.lit(1)).alias("siblings")), "siblings")
    known = lookup_join(groups, siblings, parent)
    turns = known.select("siblings", "n_convs", "conv_id", F.inline("turns"))
    names = ("d", "a", "b", "pa", "pb", "chars", "n_convs", "conv_id")
    alone = turns.where("siblings = 1").select(*names)
    parted = (
        turns.where("siblings > 1")
        .groupBy("d", "a", "b")
        .agg(
            *(F.any_value(c).alias(c) for c in ("pa", "pb", "chars")),
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
        )
        .select(*names)
    )
    return alone.unionByName(parted)


def _subtree_sums(tree: DataFrame) -> DataFrame:
    """(depth, conv_id, n_leaves, saved_tokens): sums of ``leaf`` and ``saved`` over subtrees.

    ``tree`` is stored: depth, conv_id, parent_conv_id, leaf, saved. After each round a node
    holds the sum over twice as many levels and knows its ancestor twice as far up, so rounds
    grow with the logarithm of the depth.
    """
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    state = tree.select("depth", "conv_id", F.col("parent_conv_id").alias("up"), "leaf", "saved")
    step = 1
    while step <= deepest:
        gains = (
            state.where("up IS NOT NULL")
            .groupBy((F.col("depth") - step).alias("depth"), F.col("up").alias("conv_id"))
            .agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        )
        grown = state.join(gains, ["depth", "conv_id"], "left").select(
            "depth",
            "conv_id",
            "up",
            (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        far = grown.where(F.col("depth") >= 2 * step).withColumn("up_depth", F.col("depth") - step)
        above = state.select(F.col("depth").alias("up_depth"), F.col("conv_id").alias("up"), F.col("up").alias("next"))
        near = grown.where(F.col("depth") < 2 * step).withColumn("up", F.lit(None).cast("long"))
        further = lookup_join(far, above, ["up_depth", "up"]).select(
            "depth", "conv_id", F.col("next").alias("up"), "leaf", "saved"
        )
        state = stage(near.unionByName(further), "sums")
        step *= 2
    return state.select("depth", "conv_id", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def trie(paths: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each different prefix of the conversations, the empty one included.

    ``paths``: conv_id, depth d (from 1), chars of its text, digests a, b of the prefix that ends
    here and pa, pb of the one before, and whether it is the conversation's last turn.
    ``members``: every conv_id once, and whether it has no turn.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256; see the query's contract. Without conversations there is no row.
    """
    find_package(paths.sparkSession)
    block = ((F.col("d") - 1) / BLOCK).cast("long")
    turns = F.array_sort(F.collect_list(F.struct("d", "a", "b", "pa", "pb", "chars", "last")))
    blocks = stage(paths.groupBy("conv_id", block.alias("block")).agg(turns.alias("turns")), "turn-blocks")
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(*(zero.alias(c) for c in ("d", "a", "b", "pa", "pb", "chars")), "n_convs", "conv_id")
    nodes = stage(_nodes(blocks).unionByName(root), "nodes")

    names = nodes.select((F.col("d") + 1).alias("d"), *(F.col(c).alias(f"p{c}") for c in "ab"), F.col("conv_id").alias("parent_conv_id"))
    linked = lookup_join(nodes.where("d > 0"), names, ["d", "pa", "pb"]).unionByName(
        nodes.where("d = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    )
    linked = stage(linked, "linked")
    children = (
        linked.where("d > 0")
        .groupBy((F.col("d") - 1).alias("d"), F.col("parent_conv_id").alias("conv_id"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    last = F.element_at("turns", -1)
    ends = blocks.where(last["last"]).select("conv_id", *(last[c].alias(c) for c in ("d", "a", "b")))
    none = members.where("is_empty").select("conv_id", *(zero.alias(c) for c in ("d", "a", "b")))
    digests = _end_digests(ends.unionByName(none))
    tree = stage(
        linked.join(children, ["d", "conv_id"], "left")
        .join(digests, ["d", "a", "b"], "left")
        .select(
            "conv_id",
            F.col("d").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        ),
        "tree",
    )
    return tree.drop("leaf", "saved").join(_subtree_sums(tree), ["depth", "conv_id"]).select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) as they are; see :func:`trie`."""
    return trie(*own_paths(numbered(conversations)))


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun with turns of another."""
    return trie(*rebuilt_paths(numbered(table(spark, sf_dir, "conversations"))))


# crc32 of the digits of an id, two steps of four bits a byte over the table of its polynomial.
_NIBBLES = "[" + ", ".join(str(n) for n in (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)) + "]"
_STEP = "xor({0} >> 4, " + _NIBBLES + "[({0} & 15) + 1])"
_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce("role", '') AS who, coalesce("text", '') AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce("role", ''))::VARCHAR || ':' || coalesce("role", '') || coalesce("text", ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
      lambda x, y: {_STEP.format("(" + _STEP.format("xor(x, y)") + ")")}, 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT i.conv_id, t.pos AS place, t.who, t.said FROM ids i
  JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 100 AND t.pos < h
  UNION ALL SELECT i.conv_id, t.pos, t.who, t.said FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos >= h),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM rebuilt),
paths AS (
  SELECT conv_id, depth, said, list({{'who': who, 'said': said}}) OVER
    (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, '', [] FROM ids),
named AS (SELECT conv_id, depth, said, path,
    min(conv_id) OVER (PARTITION BY depth, path) AS node, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM paths),
nodes AS (
  SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * any_value(length(said)) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM named GROUP BY node, depth),
up AS (
  SELECT n.node, n.depth, n.saved, m.node AS above, m.depth AS above_depth,
    NOT EXISTS (SELECT 1 FROM named c JOIN named b ON b.conv_id = c.conv_id AND b.depth = c.depth - 1
      WHERE b.node = n.node AND b.depth = n.depth) AS leaf
  FROM nodes n JOIN named m ON m.conv_id = n.node AND m.depth <= n.depth),
sums AS (
  SELECT above AS node, above_depth AS depth, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
    count(*) FILTER (depth = above_depth + 1) AS n_children
  FROM up GROUP BY above, above_depth)
SELECT n.node AS conv_id, n.depth, p.node AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens,
  n.ends_sha256
FROM nodes n JOIN sums s USING (node, depth)
LEFT JOIN named p ON p.conv_id = n.node AND p.depth = n.depth - 1
"""

QUERIES = {"op12_prefixes": op12_prefixes}
ORACLES = {"op12_prefixes": _SQL}
