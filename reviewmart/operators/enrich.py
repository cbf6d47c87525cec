"""Sentiment, reason and advice for each review; attributes for each loadable row."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.functions import attributes as A
from reviewmart.functions.hashing import text_bucket
from reviewmart.functions.rules import issue_reason, recommend
from reviewmart.operators.normalize import drop_blank_text
from reviewmart.operators.sentiment import LinearModel, predict_sentiment
from reviewmart.profiles import Profile


def explain_sentiment(df: DataFrame, profile: Profile) -> DataFrame:
    """Add ``issue_reason`` and ``ai_recommendation`` to labelled reviews."""
    return (
        df.withColumn("_lowered", F.lower("review_text"))
        .withColumn(
            "issue_reason", issue_reason(F.col("_lowered"), F.col("sentiment_label"), profile)
        )
        .withColumn("ai_recommendation", recommend(F.col("issue_reason"), profile))
        .drop("_lowered")
    )


def enrich(df: DataFrame, model: LinearModel | PipelineModel, profile: Profile) -> DataFrame:
    """Sentiment, then reason, then advice, in one pass over the rows."""
    return explain_sentiment(predict_sentiment(df, model, profile), profile)


def loadable(df: DataFrame, profile: Profile) -> DataFrame:
    """Rows the load accepts: the batch drops missing text, the app stores ``None`` for null."""
    if profile.is_batch:
        return drop_blank_text(df)
    return df.withColumn("review_text", F.coalesce("review_text", F.lit("None")))


def with_attributes(df: DataFrame, profile: Profile) -> DataFrame:
    """Add the synthetic customer, product and location columns.

    Expects loadable rows with ``review_text`` and ``source``; the batch profile also reads
    ``input_age`` and ``input_category``.
    """
    source, bucket = F.col("source"), F.col("_bucket")
    age, category = (
        (F.col("input_age"), F.col("input_category")) if profile.is_batch else (None, None)
    )
    return (
        # Text is never null here; saying so keeps null checks off the hash in later joins.
        df.withColumn("_bucket", F.coalesce(text_bucket(F.col("review_text")), F.lit(0)))
        .withColumns(
            {
                "age": A.customer_age(bucket, age, profile),
                "gender": A.derived_gender(bucket, source, profile),
                "category": A.product_category(source, category, profile),
                "brand": A.brand(bucket, profile),
                "country": A.country(bucket),
                "city": A.city(bucket),
            }
        )
        .withColumns(
            {
                "customer_name": A.customer_name(F.col("gender"), bucket),
                "product_name": A.product_name(F.col("brand"), bucket),
            }
        )
        .drop("_bucket")
    )
