"""Source normalisation, union, filters and row caps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.text import has_text, to_int
from reviewmart.operators.keys import in_order
from reviewmart.profiles import CLOTHING_SOURCE, DEFAULT_CATEGORY, ECOMMERCE_SOURCE
from reviewmart.sources.csv_records import PLACE


def _unified(
    df: DataFrame, source_ord: int, text: Column, age: Column, category: Column, source: str
) -> DataFrame:
    return df.select(
        F.lit(source_ord).alias("source_ord"),
        F.col("row_id"),
        text.cast("string").alias("review_text"),
        age.alias("input_age"),
        category.cast("string").alias("input_category"),
        F.lit(source).alias("source"),
    )


def normalize_src1(df: DataFrame) -> DataFrame:
    """Product reviews: ``review`` text, no age, one fixed category."""
    return _unified(
        df, 1, F.col("review"), F.lit(None).cast("int"), F.lit(DEFAULT_CATEGORY), ECOMMERCE_SOURCE
    )


def normalize_src2(df: DataFrame) -> DataFrame:
    """Clothing reviews: ``Review Text``, ``Age``, ``Department Name``."""
    return _unified(
        df,
        2,
        F.col("`Review Text`"),
        to_int(F.col("Age")),
        F.col("`Department Name`"),
        CLOTHING_SOURCE,
    )


def in_file_order(df: DataFrame) -> DataFrame:
    """Sort scanned rows by file name and place in the file, and number them so as ``row_id``.

    How a scan packs files and splits into tasks depends on sizes and settings; their names
    and offsets do not. Inside a split the scan's own order holds. Rows come with their
    ``PLACE``, or straight from a file scan, which knows it.
    """
    if not set(PLACE) <= set(df.columns):
        file, start, position = PLACE
        df = df.withColumns(
            {
                file: F.col("_metadata.file_path"),
                start: F.col("_metadata.file_block_start"),
                position: F.monotonically_increasing_id(),
            }
        )
    rows = in_order(df, list(PLACE)).drop(*PLACE)
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources."""
    return reduce(DataFrame.unionByName, sources)


def drop_null_text(df: DataFrame) -> DataFrame:
    """Rows whose text is present; pushed down to each source's scan."""
    return df.filter(F.col("review_text").isNotNull())


def drop_blank_text(df: DataFrame) -> DataFrame:
    """Rows whose text is neither null nor white space only."""
    return df.filter(has_text(F.col("review_text")))


def cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows by key. A top-n report: each task keeps n rows, one merges them."""
    return df.orderBy(*order).limit(n)
