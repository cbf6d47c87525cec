"""Integrity reports over a star, and load totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.sources.warehouse import Star

_FOREIGN_KEYS = {
    "product_id": "dim_product",
    "customer_id": "dim_customer",
    "date_id": "dim_date",
    "location_id": "dim_location",
}

# Widths of the warehouse's text columns, in characters.
WIDTHS = {
    "dim_product": {"product_name": 255, "category": 100, "brand": 100},
    "dim_customer": {"customer_name": 255, "gender": 20},
    "dim_location": {"country": 100, "city": 100},
    "fact_reviews": {
        "sentiment_label": 20,
        "issue_reason": 500,
        "ai_recommendation": 500,
        "source_link": 500,
    },
}

_KEYS = {
    "dim_date": (["date_id"], ["review_year", "review_month", "review_day"]),
    "dim_product": (["product_id"], ["product_name", "category"]),
    "dim_customer": (["customer_id"], ["customer_name"]),
    "dim_location": (["location_id"], ["country", "city"]),
    "fact_reviews": (["review_id"],),
}


def fk_orphans(star: Star) -> DataFrame:
    """Per foreign key: values without a dimension row, and the reviews holding them.

    Keys are counted first, so the anti joins see one row per key value.
    """

    def orphans(key: str, table: str) -> DataFrame:
        used = star.fact_reviews.filter(F.col(key).isNotNull()).groupBy(key).count()
        lost = used.join(getattr(star, table).select(key), key, "left_anti")
        return lost.agg(
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("orphan_reviews"),
        ).select(F.lit(key).alias("foreign_key"), "orphan_keys", "orphan_reviews")

    return reduce(DataFrame.unionByName, [orphans(k, t) for k, t in _FOREIGN_KEYS.items()])


def width_violations(star: Star) -> DataFrame:
    """Per text column: values longer than the warehouse allows. One pass per table."""

    def violations(table: str, widths: dict[str, int]) -> DataFrame:
        counts = getattr(star, table).agg(
            *[F.count_if(F.length(c) > n).alias(c) for c, n in widths.items()]
        )
        return counts.unpivot(
            F.lit(table).alias("table_name"), list(widths), "column_name", "violations"
        )

    return reduce(DataFrame.unionByName, [violations(t, w) for t, w in WIDTHS.items()])


def key_duplicates(star: Star) -> DataFrame:
    """Per primary and natural key: how many values occur more than once."""

    def duplicates(table: str, key: list[str]) -> DataFrame:
        repeated = getattr(star, table).groupBy(*key).count().filter(F.col("count") > 1)
        return repeated.agg(F.count("*").alias("duplicates")).select(
            F.lit(table).alias("table_name"), F.lit(", ".join(key)).alias("key"), "duplicates"
        )

    return reduce(
        DataFrame.unionByName, [duplicates(t, k) for t, keys in _KEYS.items() for k in keys]
    )


def load_summary(raw: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows read and loaded per source; both frames carry ``source``."""
    read = raw.groupBy("source").agg(F.count("*").alias("rows_read"))
    kept = loaded.groupBy("source").agg(F.count("*").alias("rows_loaded"))
    return read.join(kept, "source", "left").select(
        "source",
        "rows_read",
        F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded"),
        (F.coalesce("rows_loaded", F.lit(0)) == 0).alias("is_empty"),
    )
