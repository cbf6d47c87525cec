"""Joins from a big frame to tables with unique keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from reviewmart.session import stage

# A table up to this many narrow rows is broadcast: some 50 MB of keys and values.
MAX_BROADCAST_ROWS = 500_000

# Beyond it, keys that hold more than one in HOT_KEYS rows are still joined by broadcast;
# there are fewer than HOT_KEYS of them.
HOT_KEYS = 100_000


# A task sorts about so many narrow rows, some 100 MB.
TASK_ROWS = 1_000_000

# A table up to this size in memory is broadcast by ``lookup_joins``.
MAX_BROADCAST_BYTES = 64 << 20

# What a row takes in a hash table besides its values.
_ROW_BYTES = 40


def is_small(table: DataFrame, rows: int) -> bool:
    """Whether a stored table has at most ``rows`` rows; parquet answers from its footers."""
    return table.count() <= rows


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Inner join of ``facts`` to a stored lookup table with unique ``keys``.

    A table counted to be small is broadcast and ``facts`` is not shuffled. A larger one
    is shuffled against the facts, except for frequent keys: their rows are broadcast, so
    no reducer receives a hot key and every row is kept.
    """
    limit = MAX_BROADCAST_ROWS if max_broadcast_rows is None else max_broadcast_rows
    if is_small(table, limit):
        return facts.join(F.broadcast(table), keys)
    counts = stage(facts.groupBy(*keys).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") > total / HOT_KEYS).select(*keys)
    hot_table = table.join(F.broadcast(hot), keys, "left_semi")
    cold = facts.join(F.broadcast(hot), keys, "left_anti")
    tasks = math.ceil(total / TASK_ROWS)
    if tasks > int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # Given numbers of partitions are kept, the session's would give each task more to sort.
        cold, table = cold.repartition(tasks, *keys), table.repartition(tasks, *keys)
    return facts.join(F.broadcast(hot_table), keys).unionByName(
        cold.join(table.hint("shuffle_merge"), keys)
    )


def table_bytes(table: DataFrame) -> int:
    """About how much memory a lookup table takes, by one aggregate over all of it."""
    width = F.lit(_ROW_BYTES).cast("long")
    for field in table.schema:
        width = width + F.lit(8)
        if isinstance(field.dataType, StringType | BinaryType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return table.agg(F.sum(width)).first()[0] or 0


def lookup_joins(
    facts: DataFrame,
    lookups: Sequence[tuple[DataFrame, list[str]]],
    max_bytes: int | None = None,
) -> DataFrame:
    """Inner join of ``facts`` to stored lookup tables, each with unique keys of its own.

    Tables measured to be small are broadcast and do not shuffle ``facts``. The others are
    shuffled against them: rows of a key that holds more than one in ``HOT_KEYS`` rows are
    dealt over as many salts as it has such shares, its table row is repeated for each, at
    most twice ``HOT_KEYS`` rows in all. The join reads ``facts`` once; before it, key columns
    alone are counted. Rows with a null or unknown key drop out, repeated rows stay.
    """
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    large = []
    joined = facts
    for table, keys in lookups:
        if table_bytes(table) <= limit:
            joined = joined.join(F.broadcast(table), keys)
        else:
            large.append((table, keys))
    for table, keys in large:
        joined = _salted_join(joined, table, keys, _salts(facts, keys))
    return joined


def _salts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """The hot keys of ``facts`` and the number of salts each is dealt over."""
    known = facts.select(*keys).dropna()
    counts = stage(known.groupBy(*keys).agg(F.count("*").alias("_rows")), "key-counts")
    share = (counts.agg(F.sum("_rows")).first()[0] or 0) / HOT_KEYS
    hot = counts.filter(F.col("_rows") > F.lit(share))
    return hot.select(*keys, F.ceil(F.col("_rows") / F.lit(max(share, 1.0))).alias("_salts"))


def _salted_join(
    facts: DataFrame, table: DataFrame, keys: list[str], salts: DataFrame
) -> DataFrame:
    # The salt follows from the row alone, so a recomputed task deals its rows alike.
    dealt = F.pmod(F.xxhash64(*facts.columns), F.coalesce("_salts", F.lit(1)))
    rows = facts.join(F.broadcast(salts), keys, "left").withColumn("_salt", dealt).drop("_salts")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))
    repeated = (
        table.join(F.broadcast(salts), keys, "left").withColumn("_salt", every).drop("_salts")
    )
    return rows.join(repeated.hint("shuffle_merge"), [*keys, "_salt"]).drop("_salt")
