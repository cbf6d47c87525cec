"""Star load as set operations: dimensions first, then the fact."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.links import source_tag
from reviewmart.operators.enrich import loadable, with_attributes
from reviewmart.operators.keys import dense_keys, key_stored, number_rows
from reviewmart.operators.lookup import lookup_joins
from reviewmart.operators.members import first_wins_of_each, new_members
from reviewmart.operators.resolve import (
    customer_lookup,
    date_parts,
    location_lookup,
    product_lookup,
    resolve_date,
    timestamp,
)
from reviewmart.plans.totals import SourceTotals, Watch
from reviewmart.profiles import Profile
from reviewmart.session import staged_until_done
from reviewmart.sources.warehouse import (
    Star,
    commit,
    log_end,
    next_change,
    read_star,
    write_part,
)

_DATE_KEYS = ["review_year", "review_month", "review_day"]


@dataclass(frozen=True)
class Loaded:
    """Outcome of a load; ``totals`` says what each watched source gave."""

    load_id: int
    rows: int
    star: Star
    totals: tuple[SourceTotals, ...] = ()


def member_candidates(rows: DataFrame, profile: Profile, order: list[str]) -> dict:
    """Per dimension: key column, natural key, and the earliest row of each member.

    All three dimensions come from one pass over the rows.
    """
    product = [c for c in ("category", "brand") if c not in profile.product_keys]
    members = {
        "dim_product": ("product_id", list(profile.product_keys), product),
        "dim_customer": ("customer_id", ["customer_name"], ["age", "gender"]),
        "dim_location": ("location_id", ["country", "city"], []),
    }
    wanted = {table: (natural, attrs) for table, (_, natural, attrs) in members.items()}
    found = first_wins_of_each(rows, wanted, order)
    return {table: (key, natural, found[table]) for table, (key, natural, _) in members.items()}


def date_member(spark: SparkSession, load_ts: datetime) -> DataFrame:
    """The load's day as a one-row dimension candidate."""
    ts = timestamp(load_ts)
    return spark.range(1).select(
        ts.alias("review_date"), *date_parts(ts), F.lit(0).alias("row_seq")
    )


def add_members(
    path: str,
    load_id: int,
    table: str,
    key: str,
    natural: list[str],
    candidates: DataFrame,
    known: DataFrame,
) -> DataFrame:
    """Append the members a dimension lacks; returns the dimension with them."""
    spark = known.sparkSession
    # Kept for the emptiness check, the numbering and the write; recomputed from the stored
    # rows, with the same outcome, if an executor is lost.
    fresh = new_members(candidates, known, natural).persist()
    try:
        if fresh.count() == 0:
            return known
        start = known.agg(F.max(key)).first()[0] or 0
        write_part(key_stored(fresh, ["row_seq"], key, start), path, table, load_id)
    finally:
        fresh.unpersist()
    part = spark.read.schema(known.schema).parquet(f"{path}/{table}/load_id={load_id}")
    return known.unionByName(part)


def fact_rows(
    rows: DataFrame, star: Star, load_ts: datetime, profile: Profile
) -> DataFrame:
    """Resolve the four foreign keys and stamp the load time."""
    lookups = [
        product_lookup(star.dim_product, profile),
        customer_lookup(star.dim_customer),
        location_lookup(star.dim_location),
    ]
    rows = resolve_date(lookup_joins(rows, lookups), star.dim_date, load_ts)
    return rows.withColumn("load_timestamp", timestamp(load_ts))


def load_star(
    enriched: DataFrame,
    path: str,
    load_ts: datetime,
    profile: Profile,
    watch: Watch | None = None,
) -> Loaded:
    """Load enriched reviews: new dimension members, then facts, then the commit.

    ``source`` is the source name (batch) or the finished source link (app). Rows count in
    scan order and are not shuffled; sources sorted by ``in_order`` first give the same
    review ids and the same first-wins members under any partitioning.
    """
    spark = enriched.sparkSession
    end = log_end(spark, path)
    load_id = next_change(spark, path, end)

    link = source_tag("merged", F.col("source")) if profile.is_batch else F.col("source")
    rows = with_attributes(loadable(enriched, profile), profile).withColumn("source_link", link)
    wanted = [
        *("review_text", "sentiment_label", "issue_reason", "ai_recommendation"),
        *("source_link", "age", "gender", "category", "brand", "country", "city"),
        *("customer_name", "product_name"),
    ]
    with staged_until_done(spark):
        numbered = number_rows(rows.select(*wanted))
        before = read_star(spark, path)
        candidates = member_candidates(numbered, profile, ["row_seq"])
        candidates["dim_date"] = ("date_id", _DATE_KEYS, date_member(spark, load_ts))
        after = {
            table: add_members(path, load_id, table, key, natural, found, getattr(before, table))
            for table, (key, natural, found) in candidates.items()
        }
        dims = Star(fact_reviews=before.fact_reviews, **after)
        keyed = dense_keys(numbered, "review_id", end.last_review_id)
        write_part(fact_rows(keyed, dims, load_ts, profile), path, "fact_reviews", load_id)
        count = numbered.count()
    commit(spark, path, load_id, "load", load_ts, count, end.last_review_id + count)
    totals = watch.totals() if watch is not None else ()
    return Loaded(load_id, count, read_star(spark, path), totals)
