"""Dimension members: distinct, first-wins, and those a dimension lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from reviewmart.session import stage


def distinct_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct natural keys."""
    return df.select(*keys).distinct()


def first_wins(
    df: DataFrame, keys: list[str], attrs: list[str], order: list[str]
) -> DataFrame:
    """One row per natural key with the attributes and ``order`` of its earliest row.

    The first pass sees every row and must combine before the shuffle in a hash table, so
    its buffers hold numbers only: text attributes and the leading order columns join the
    grouping instead. The second pass picks the winner among those few rows.
    """
    *lead, last = order
    numeric = [a for a in attrs if isinstance(df.schema[a].dataType, NumericType)]
    text = [a for a in attrs if a not in numeric]
    partial = df.groupBy(*keys, *text, *lead).agg(
        F.min(last).alias(last), *[F.min_by(a, last).alias(a) for a in numeric]
    )
    if not text and not lead:
        return partial.select(*keys, *attrs, *order)
    winner = F.min_by(F.struct(*attrs, *order), F.struct(*order)).alias("_first")
    return partial.groupBy(*keys).agg(winner).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in (*attrs, *order)]
    )


def _parts(df: DataFrame, keys: list[str], attrs: list[str], order: list[str]) -> list[str]:
    """What a member's rows are grouped by before the winner is picked; see :func:`first_wins`."""
    text = [a for a in attrs if not isinstance(df.schema[a].dataType, NumericType)]
    return [*keys, *text, *order[:-1]]


def grouped_members(
    df: DataFrame, members: dict[str, tuple[list[str], list[str]]], order: list[str]
) -> DataFrame:
    """The first pass of :func:`first_wins` for several natural keys at once.

    ``members`` maps a name to (keys, attrs). One scan of ``df`` feeds a hash aggregate over
    grouping sets; ``_set`` tells them apart.
    """
    sets = [_parts(df, keys, attrs, order) for keys, attrs in members.values()]
    columns = list(dict.fromkeys(c for one in sets for c in one))
    taken = {c for _, attrs in members.values() for c in attrs} - set(columns)
    return df.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("_set"),
        F.min(order[-1]).alias(order[-1]),
        *[F.min_by(a, order[-1]).alias(a) for a in sorted(taken)],
    )


def first_wins_of_each(
    df: DataFrame, members: dict[str, tuple[list[str], list[str]]], order: list[str]
) -> dict[str, DataFrame]:
    """:func:`first_wins` of several natural keys, with one pass over ``df`` for all of them.

    What the pass leaves, a row for each member and variant of it, is stored once.
    """
    sets = {name: _parts(df, keys, attrs, order) for name, (keys, attrs) in members.items()}
    columns = list(dict.fromkeys(c for one in sets.values() for c in one))
    stored = stage(grouped_members(df, members, order), "members")
    found = {}
    for name, (keys, attrs) in members.items():
        # The first column is the highest bit, and a bit says that the column is not in the set.
        number = sum(1 << k for k, c in enumerate(reversed(columns)) if c not in sets[name])
        found[name] = first_wins(stored.where(F.col("_set") == number), keys, attrs, order)
    return found


def new_members(candidates: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose natural key the dimension does not hold yet."""
    return candidates.join(dim.select(*keys), keys, "left_anti")
