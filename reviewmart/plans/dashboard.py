"""Dashboard queries over a star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.bands import age_group
from reviewmart.functions.links import source_type, source_url
from reviewmart.operators.lookup import lookup_joins
from reviewmart.sources.warehouse import Star


def star_stats(star: Star) -> DataFrame:
    """Sentiment, gender, age, category and reason of each review."""
    fact = star.fact_reviews.select(
        "customer_id", "product_id", "sentiment_label", "issue_reason"
    )
    customers = star.dim_customer.select("customer_id", "gender", "age")
    products = star.dim_product.select("product_id", "category")
    joined = lookup_joins(fact, [(customers, ["customer_id"]), (products, ["product_id"])])
    return joined.select(
        F.col("sentiment_label").alias("Sentiment"),
        F.col("gender").alias("Gender"),
        F.col("age").alias("Age"),
        F.col("category").alias("Category"),
        F.col("issue_reason").alias("Reason"),
    )


def _sums(counted: DataFrame, *by: str) -> DataFrame:
    return counted.groupBy(*by).agg(F.sum("Count").alias("Count"))


def _counted(star: Star, *columns: Column) -> DataFrame:
    """Reviews per value of fact columns; dimensions meet these few rows, not the reviews.

    Every review has its dimension rows (``fk_orphans`` reports where not), so a dimension that
    gives no column is not joined at all.
    """
    return star.fact_reviews.groupBy(*columns).agg(F.count("*").alias("Count"))


def sentiment_counts(star: Star) -> DataFrame:
    """Reviews per sentiment, most frequent first."""
    known = _counted(star, F.col("sentiment_label").alias("Sentiment")).filter(F.col("Sentiment").isNotNull())
    return known.orderBy(F.desc("Count"), "Sentiment")


def gender_sentiment(star: Star) -> DataFrame:
    """Reviews per gender and sentiment."""
    counted = _counted(star, F.col("customer_id"), F.col("sentiment_label").alias("Sentiment"))
    customers = star.dim_customer.select("customer_id", F.col("gender").alias("Gender"))
    return _sums(lookup_joins(counted, [(customers, ["customer_id"])]), "Gender", "Sentiment")


def category_sentiment(star: Star) -> DataFrame:
    """Reviews per product category and sentiment."""
    counted = _counted(star, F.col("product_id"), F.col("sentiment_label").alias("Sentiment"))
    products = star.dim_product.select("product_id", F.col("category").alias("Category"))
    return _sums(lookup_joins(counted, [(products, ["product_id"])]), "Category", "Sentiment")


def reason_sentiment(star: Star) -> DataFrame:
    """Reviews per reason and sentiment."""
    return _counted(star, F.col("issue_reason").alias("Reason"), F.col("sentiment_label").alias("Sentiment"))


def age_group_counts(star: Star) -> DataFrame:
    """Reviews per age band of the stored customer."""
    counted = _counted(star, F.col("customer_id"))
    customers = star.dim_customer.select("customer_id", age_group(F.col("age")).alias("Age Group"))
    return _sums(lookup_joins(counted, [(customers, ["customer_id"])]), "Age Group")


def _located(fact: DataFrame, star: Star) -> DataFrame:
    customers = star.dim_customer.select("customer_id", "gender", "age")
    locations = star.dim_location.select("location_id", "country")
    return lookup_joins(fact, [(customers, ["customer_id"]), (locations, ["location_id"])])


def records(star: Star) -> DataFrame:
    """The records list: one display row per review."""
    return _located(star.fact_reviews, star).select(
        F.col("review_id").alias("ID"),
        F.col("gender").alias("Gender"),
        F.col("age").alias("Age"),
        F.col("review_text").alias("Review"),
        F.col("sentiment_label").alias("Sentiment"),
        F.col("issue_reason").alias("Extracted Reason"),
        F.col("ai_recommendation").alias("AI Action"),
        F.col("country").alias("Country"),
        source_type(F.col("source_link")).alias("Source Type"),
        source_url(F.col("source_link")).alias("Source Link"),
    )


def newest_records(star: Star, n: int = 100) -> DataFrame:
    """The newest ``n`` records by id.

    The n-th id is found on three narrow columns; as a scalar subquery it becomes a pushed
    filter on the wide scan, which then skips all but the last row groups.
    """
    narrow = star.fact_reviews.select("review_id", "customer_id", "location_id")
    newest = _located(narrow, star).select("review_id").orderBy(F.desc("review_id")).limit(n)
    oldest_id = newest.agg(F.min("review_id")).scalar()
    return records(star).filter(F.col("ID") >= oldest_id).orderBy(F.desc("ID")).limit(n)


def source_type_counts(star: Star) -> DataFrame:
    """Reviews per kind of source."""
    return _counted(star, source_type(F.col("source_link")).alias("Source Type"))
