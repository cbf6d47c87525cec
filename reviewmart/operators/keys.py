"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.operators.lookup import is_small
from reviewmart.session import stage

# monotonically_increasing_id() holds the partition above this bit, the position below.
_POSITION_BITS = 33

# Up to this many rows are numbered by one task.
SINGLE_TASK_ROWS = 100_000


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Range-partition and sort rows, so that scan order means ``order``.

    Row-wise steps keep it. Sort before them: choosing the ranges reads the input once
    more, and only the source columns then travel through the shuffle.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def number_rows(df: DataFrame) -> DataFrame:
    """Store rows with ``row_seq``, a number that increases in scan order, with gaps.

    Nothing is shuffled, and the numbers are written out with the rows: a recomputed task
    cannot change them later.
    """
    return stage(df.withColumn("row_seq", F.monotonically_increasing_id()), "numbered")


def dense_keys(numbered: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Add gapless keys in ``row_seq`` order: ``start + 1, start + 2, ...``.

    Per-partition counts become offsets. The offset table has one row per partition that
    wrote the numbered rows, so broadcasting and summing it up is bounded.
    """
    part = F.shiftright("row_seq", _POSITION_BITS)
    position = F.col("row_seq").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.select(part.alias("_part"))
        .groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(key, F.lit(start).cast("long") + F.col("_offset") + position + 1)
        .drop("_part", "_offset")
    )


def key_stored(
    stored: DataFrame,
    order: list[str],
    key: str,
    start: int = 0,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Number the rows of a stored or kept table ``start + 1`` onwards by ``order``."""
    if is_small(stored, single_task_rows):
        rank = F.row_number().over(Window.orderBy(*order))
        return stored.withColumn(key, F.lit(start).cast("long") + rank)
    return dense_keys(number_rows(in_order(stored, order)), key, start).drop("row_seq")


def assign_keys(
    df: DataFrame,
    order: list[str],
    key: str,
    start: int = 0,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Number rows ``start + 1`` onwards by ``order``."""
    return key_stored(stage(df, "unnumbered"), order, key, start, single_task_rows)
