"""The star in a relational database, over Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.sources.warehouse import COLUMNS, DIMENSIONS, Star


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in COLUMNS[table].items()])


def read_star_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], partitions: int = 64
) -> Star:
    """Read the five star tables; the fact in parallel, by ranges of its review id."""
    bounds = "(SELECT MIN(review_id) AS lo, MAX(review_id) AS hi FROM fact_reviews) bounds"
    low, high = spark.read.jdbc(url, bounds, properties=properties).first()
    fact = spark.read.jdbc(
        url,
        "fact_reviews",
        column="review_id",
        lowerBound=int(low or 0),
        upperBound=int(high or 0) + 1,
        numPartitions=partitions,
        properties=properties,
    )
    dims = {t: _typed(spark.read.jdbc(url, t, properties=properties), t) for t in DIMENSIONS}
    return Star(fact_reviews=_typed(fact, "fact_reviews"), **dims)


def write_star_jdbc(star: Star, url: str, properties: dict[str, str]) -> None:
    """Append a star to existing tables, dimensions first so that foreign keys hold."""
    for table in (*DIMENSIONS, "fact_reviews"):
        _typed(getattr(star, table), table).write.jdbc(
            url, table, mode="append", properties={"batchsize": "10000", **properties}
        )
