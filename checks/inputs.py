"""Review-shaped inputs derived by Spark from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.links import source_tag
from reviewmart.operators.enrich import enrich
from reviewmart.operators.keys import in_order
from reviewmart.operators.normalize import (
    drop_null_text,
    normalize_src1,
    normalize_src2,
    union_sources,
)
from reviewmart.operators.sentiment import LinearModel
from reviewmart.plans.ingest import append_reviews, ingest_pages
from reviewmart.plans.load import load_star
from reviewmart.profiles import APP, BATCH
from reviewmart.session import staging_path
from reviewmart.sources.warehouse import Star, read_star

LOAD_TS = datetime(2024, 3, 15, 10, 30, 0)
SECOND_TS = datetime(2024, 3, 16, 9, 0, 0)
KEYS = ["source_ord", "row_id"]

PHRASES = (
    "Battery died and the CHARGER is useless",
    "Delivery took twelve weeks, bad",
    "Too tight, terrible fabric",
    "Cheap and flimsy, broken on arrival",
    "The menu and buttons crash, awful",
    "Awful, would not recommend",
    "I love it, great value",
    "Nice and useful",
    "Did not receive it, bad",
    "Worst thing ever, awful",
    "The app is bad",
    "Perfect, simply the best, good",
    "Happy with the profit, bad battery",
    "Terrible Größe, déçu",
)

# Test weights, invented for the check: term, weight, idf.
WEIGHTS = (
    ("useless", -1.5, 2.0),
    ("bad", -1.2, 1.5),
    ("terrible", -2.0, 2.2),
    ("broken", -1.1, 2.1),
    ("awful", -2.1, 1.9),
    ("love", 1.8, 2.0),
    ("great", 1.6, 1.8),
    ("nice", 1.0, 2.3),
    ("best", 1.4, 2.1),
    ("good", 1.2, 1.4),
    ("happy", 1.1, 2.0),
    ("battery", -0.4, 2.4),
    ("not", -0.6, 1.2),
)
BIAS = 0.1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_model(spark: SparkSession) -> LinearModel:
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("term"), F.lit(w).alias("weight"), F.lit(i).alias("idf"))
            for t, w, i in WEIGHTS
        ]
    )
    return LinearModel(spark.range(1).select(F.inline(rows)), BIAS)


def _phrase(index) -> F.Column:
    return F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (index % 14 + 1).cast("int"))


def product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a product review: ``row_id, review``."""
    key = F.col("o_orderkey")
    text = F.concat(_phrase(key), F.lit(" #"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        key.alias("row_id"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "   ").otherwise(text).alias("review"),
    )


def clothing_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a clothing review: ``row_id, Review Text, Age, Department Name``."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    line = table(spark, sf_dir, "lineitem")
    order, item, supplier, number = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    text = F.concat(
        _phrase(order + number),
        F.lit(" "),
        F.col("p_name"),
        F.lit(" #"),
        supplier.cast("string"),
    )
    return line.join(part, item == F.col("p_partkey")).select(
        (((order * 100000 + item) * 10000 + supplier) * 10 + number).alias("row_id"),
        F.when(item % 97 != 0, text).alias("Review Text"),
        F.when(order % 53 != 0, (18 + supplier % 86).cast("int")).alias("Age"),
        F.when(item % 41 != 0, F.col("p_type")).alias("Department Name"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources in the unified staging shape, null texts included."""
    return union_sources(
        normalize_src1(product_reviews(spark, sf_dir)),
        normalize_src2(clothing_reviews(spark, sf_dir)),
    )


def enriched(spark: SparkSession, sf_dir: str, profile=BATCH) -> DataFrame:
    rows = reviews(spark, sf_dir)
    if profile.is_batch:
        rows = drop_null_text(rows)
    return enrich(rows, test_model(spark), profile)


def manual_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn of a conversation as a typed-in review."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return turns.select("conv_id", "turn", F.col("text").alias("review_text"))


def document_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an uploaded row: English ones from datasets, others from CSV files."""
    name = F.concat("source", F.lit(".csv"))
    link = F.when(F.col("lang") == "en", source_tag("dataset", F.col("source"))).otherwise(
        source_tag("csv", name)
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("review_text"), link.alias("source")
    )


def load_batch(spark: SparkSession, sf_dir: str, path: str | None = None) -> Star:
    """A fresh warehouse holding one batch load."""
    path = path or staging_path(spark, "star")
    rows = in_order(drop_null_text(reviews(spark, sf_dir)), KEYS)
    return load_star(enrich(rows, test_model(spark), BATCH), path, LOAD_TS, BATCH).star


def load_manual(spark: SparkSession, sf_dir: str, path: str, load_ts: datetime = LOAD_TS) -> Star:
    """Append every user turn as a manual entry."""
    rows = in_order(manual_reviews(spark, sf_dir), ["conv_id", "turn"])
    return append_reviews(rows, test_model(spark), path, load_ts).star


def load_app(spark: SparkSession, sf_dir: str, path: str | None = None) -> Star:
    """A fresh warehouse holding three app loads: pages, manual entries, uploads."""
    path = path or staging_path(spark, "star")
    model = test_model(spark)
    ingest_pages(in_order(table(spark, sf_dir, "pages"), ["page_id"]), model, path, LOAD_TS)
    load_manual(spark, sf_dir, path)
    rows = in_order(document_uploads(spark, sf_dir), ["doc_id"])
    return load_star(enrich(rows, model, APP), path, SECOND_TS, APP).star


_stars: dict[tuple[str, str, str], str] = {}


def stored_path(spark: SparkSession, sf_dir: str, kind: str = "batch") -> str:
    """Folder of the warehouse dashboards read; loaded once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _stars:
        path = staging_path(spark, f"star-{kind}")
        {"batch": load_batch, "app": load_app}[kind](spark, sf_dir, path)
        _stars[key] = path
    return _stars[key]


def stored_star(spark: SparkSession, sf_dir: str, kind: str = "batch") -> Star:
    return read_star(spark, stored_path(spark, sf_dir, kind))
