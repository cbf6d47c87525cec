"""Deletes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.operators import lookup
from reviewmart.session import stage, staged_until_done
from reviewmart.sources.warehouse import (
    commit,
    log_end,
    next_change,
    read_parts,
    replace_parts,
)


def without(stored: DataFrame, found: DataFrame) -> DataFrame:
    """The rows left of the parts that hold ``found`` reviews (``review_id, load_id``, stored).

    Few found ids travel to the rows, which stay where they are. Many are joined by shuffle,
    and the rows go back to the order of their parts and ids.
    """
    hit = found.groupBy("load_id").count().filter(F.col("count") > 0)
    # One row for each load at most; as a filter it reaches the partitions of the scan.
    rows = stored.join(F.broadcast(hit.select("load_id")), "load_id", "left_semi")
    if lookup.is_small(found, lookup.MAX_BROADCAST_ROWS):
        return rows.join(F.broadcast(found.select("review_id")), "review_id", "left_anti")
    rest = rows.join(found.select("review_id").hint("shuffle_merge"), "review_id", "left_anti")
    return rest.repartitionByRange("load_id", "review_id").sortWithinPartitions("load_id", "review_id")


def delete_review(
    spark: SparkSession, path: str, ids: DataFrame | list[int], at: datetime
) -> int:
    """Delete reviews by id; returns how many were found. Dimensions stay as they are.

    Only the parts that hold found reviews are written anew. The delete is logged first: one
    that fails has deleted some or none of its reviews, and repeating it deletes the others.
    Null, unknown and repeated ids change nothing.
    """
    end = log_end(spark, path)
    if not end.load_id:
        return 0
    if not isinstance(ids, DataFrame):
        ids = spark.createDataFrame([(i,) for i in ids], "review_id long")
    stored = read_parts(spark, path, "fact_reviews", end.cleared, end.load_id)
    wanted = ids.select(F.col("review_id").cast("long"))
    with staged_until_done(spark):
        found = stage(
            stored.select("review_id", "load_id").join(wanted, "review_id", "left_semi"), "found"
        )
        count = found.count()
        if count:
            held = stored.groupBy("load_id").agg(F.count("*").alias("held"))
            gone = found.groupBy("load_id").agg(F.count("*").alias("gone"))
            parts = gone.join(held, "load_id").select(
                "load_id", (F.col("held") - F.col("gone")).alias("rest")
            )
            parts = stage(parts, "parts")
            load_id = next_change(spark, path, end)
            commit(spark, path, load_id, "delete", at, count, end.last_review_id)
            replace_parts(spark, path, without(stored, found), parts)
    return count


def delete_all_reviews(spark: SparkSession, path: str, at: datetime) -> None:
    """Empty the fact. Dimensions stay, and review ids keep counting up."""
    end = log_end(spark, path)
    if end.load_id:
        commit(spark, path, next_change(spark, path, end), "clear", at, 0, end.last_review_id)
