"""Natural key to surrogate key, one lookup per dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.operators.lookup import lookup_joins
from reviewmart.profiles import Profile


_Lookup = tuple[DataFrame, list[str]]


def product_lookup(dim: DataFrame, profile: Profile) -> _Lookup:
    """Products by natural key. By name alone, the app profile takes the lowest id."""
    keys = list(profile.product_keys)
    if profile.is_batch:
        return dim.select(*keys, "product_id"), keys
    return dim.groupBy(*keys).agg(F.min("product_id").alias("product_id")), keys


def customer_lookup(dim: DataFrame) -> _Lookup:
    """Customers by name."""
    return dim.select("customer_name", "customer_id"), ["customer_name"]


def location_lookup(dim: DataFrame) -> _Lookup:
    """Locations by country and city."""
    return dim.select("country", "city", "location_id"), ["country", "city"]


def resolve_product(df: DataFrame, dim: DataFrame, profile: Profile) -> DataFrame:
    """Add ``product_id``."""
    return lookup_joins(df, [product_lookup(dim, profile)])


def resolve_customer(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``customer_id`` by customer name."""
    return lookup_joins(df, [customer_lookup(dim)])


def resolve_location(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``location_id`` by country and city."""
    return lookup_joins(df, [location_lookup(dim)])


def date_parts(load_ts: Column) -> list[Column]:
    """Year, month and day columns of a timestamp."""
    return [
        F.year(load_ts).alias("review_year"),
        F.month(load_ts).alias("review_month"),
        F.dayofmonth(load_ts).alias("review_day"),
    ]


def timestamp(load_ts: datetime) -> Column:
    """The load clock as a literal, free of any session time zone."""
    return F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def resolve_date(df: DataFrame, dim: DataFrame, load_ts: datetime) -> DataFrame:
    """Add ``date_id`` of the load's day (not of the review): one value for all rows."""
    today = dim.filter(
        (F.col("review_year") == load_ts.year)
        & (F.col("review_month") == load_ts.month)
        & (F.col("review_day") == load_ts.day)
    )
    return df.withColumn("date_id", today.agg(F.min("date_id")).scalar())
