"""The star schema on parquet.

Every table is a folder of ``load_id=N`` parts. A part counts only once its load is listed
in ``loads``, written last: readers see whole loads or nothing, and the next change first
clears what a failed one left. Dimensions only ever grow. Deletes rewrite the parts of the
fact that hold deleted reviews, so reads join nothing. One writer at a time; a read that
runs while a delete replaces its files is to be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmart.session import remove

COLUMNS = {
    "dim_date": {
        "date_id": "long",
        "review_date": "timestamp_ntz",
        "review_year": "int",
        "review_month": "int",
        "review_day": "int",
    },
    "dim_product": {
        "product_id": "long",
        "product_name": "string",
        "category": "string",
        "brand": "string",
    },
    "dim_customer": {
        "customer_id": "long",
        "customer_name": "string",
        "age": "int",
        "gender": "string",
    },
    "dim_location": {"location_id": "long", "country": "string", "city": "string"},
    "fact_reviews": {
        "review_id": "long",
        "product_id": "long",
        "customer_id": "long",
        "date_id": "long",
        "location_id": "long",
        "review_text": "string",
        "sentiment_label": "string",
        "issue_reason": "string",
        "ai_recommendation": "string",
        "source_link": "string",
        "load_timestamp": "timestamp_ntz",
    },
    "loads": {
        "load_id": "long",
        "kind": "string",
        "load_ts": "timestamp_ntz",
        "rows": "long",
        "last_review_id": "long",
    },
}
# Bytes of a row group, some hundred thousand reviews: what one task reads at least.
ROW_GROUP_BYTES = 8 << 20
DIMENSIONS = ("dim_date", "dim_product", "dim_customer", "dim_location")


def _ddl(table: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in COLUMNS[table].items())


@dataclass(frozen=True)
class Star:
    """One consistent view of the warehouse."""

    dim_date: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_location: DataFrame
    fact_reviews: DataFrame


@dataclass(frozen=True)
class LogEnd:
    """Where the load log stands; all zero in an empty warehouse."""

    load_id: int
    last_review_id: int
    cleared: int


def _stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A table folder, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Committed loads, deletes and clears, one small row each."""
    return _stored(spark, f"{path}/loads", _ddl("loads"))


def log_end(spark: SparkSession, path: str) -> LogEnd:
    """Last change and last clear, as one aggregate over the log."""
    cleared = F.when(F.col("kind") == "clear", F.col("load_id"))
    end = read_log(spark, path).agg(
        F.coalesce(F.max("load_id"), F.lit(0)),
        F.coalesce(F.max_by("last_review_id", "load_id"), F.lit(0)),
        F.coalesce(F.max(cleared), F.lit(0)),
    )
    return LogEnd(*end.first())


def read_parts(spark: SparkSession, path: str, table: str, after: int, upto: int) -> DataFrame:
    """A table's parts of the changes ``after`` one and ``upto`` another, with their ``load_id``.

    The range is a partition filter. Every change clears its id first, so no part within the
    log's range is a failed one's.
    """
    stored = _stored(spark, f"{path}/{table}", _ddl(table) + ", load_id long")
    number = F.col("load_id")
    return stored.filter((number > after) & (number <= upto))


def read_star(spark: SparkSession, path: str) -> Star:
    """The warehouse as of its last committed change; empty tables if there is none."""
    end = log_end(spark, path)
    after = dict.fromkeys(DIMENSIONS, 0) | {"fact_reviews": end.cleared}
    return Star(**{t: read_parts(spark, path, t, n, end.load_id).drop("load_id") for t, n in after.items()})


def read_newest(spark: SparkSession, path: str, n: int) -> Star:
    """The warehouse with the parts of the fact that hold its newest ``n`` reviews, or a few more.

    Ids grow from load to load, and the log knows the rows of each. Of the last loads, as many
    are read as hold ``n`` rows even if every deleted review was one of theirs. The log's
    number of deleted reviews may be too high (a delete that failed), never too low.
    """
    end = log_end(spark, path)
    log = read_log(spark, path).filter(F.col("load_id") > end.cleared)
    deleted = F.coalesce(F.sum(F.when(F.col("kind") == "delete", F.col("rows"))).over(Window.partitionBy()), F.lit(0))
    newer = Window.orderBy(F.desc("load_id")).rowsBetween(Window.unboundedPreceding, -1)
    loaded = F.sum(F.when(F.col("kind") == "load", F.col("rows"))).over(newer)
    # One row for each load or delete: a small table in one task.
    first = (
        log.select("load_id", (F.coalesce(loaded, F.lit(0)) < n + deleted).alias("needed"))
        .agg(F.min(F.when(F.col("needed"), F.col("load_id"))))
        .first()[0]
    )
    star = read_star(spark, path)
    if first is None:
        return star
    fact = star.fact_reviews
    if first > end.cleared + 1:
        fact = read_parts(spark, path, "fact_reviews", first - 1, end.load_id).drop("load_id")
    return replace(star, fact_reviews=fact)


def next_change(spark: SparkSession, path: str, end: LogEnd) -> int:
    """The id of the next change, cleared of what a failed one left under it."""
    load_id = end.load_id + 1
    for table in (*DIMENSIONS, "fact_reviews"):
        remove(spark, f"{path}/{table}/load_id={load_id}")
    return load_id


def write_part(df: DataFrame, path: str, table: str, load_id: int) -> None:
    """Write one load's part of a table, replacing what a failed attempt left there."""
    df.select(*COLUMNS[table]).write.mode("overwrite").option(
        "parquet.block.size", ROW_GROUP_BYTES
    ).parquet(f"{path}/{table}/load_id={load_id}")


def replace_parts(spark: SparkSession, path: str, kept: DataFrame, parts: DataFrame) -> None:
    """Replace the ``parts`` of the fact (``load_id``) by the ``kept`` rows of them.

    Parts that keep rows are overwritten in one job, each when the job ends. Those that keep
    none are removed: at most one id for each load comes to the driver.
    """
    folder = f"{path}/fact_reviews"
    kept.select(*COLUMNS["fact_reviews"], "load_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("load_id").parquet(folder)
    for part in parts.filter(F.col("rest") == 0).select("load_id").toLocalIterator():
        remove(spark, f"{folder}/load_id={part.load_id}")


def commit(
    spark: SparkSession,
    path: str,
    load_id: int,
    kind: str,
    load_ts: datetime,
    rows: int,
    last_review_id: int,
) -> None:
    """Publish a finished change."""
    spark.range(1).select(
        F.lit(load_id).cast("long").alias("load_id"),
        F.lit(kind).alias("kind"),
        F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("load_ts"),
        F.lit(rows).cast("long").alias("rows"),
        F.lit(last_review_id).cast("long").alias("last_review_id"),
    ).coalesce(1).write.mode("append").parquet(f"{path}/loads")
