"""Ingestion paths, from a source to a committed load."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.links import source_tag
from reviewmart.functions.text import has_text
from reviewmart.operators.enrich import enrich
from reviewmart.operators.normalize import (
    drop_null_text,
    in_file_order,
    normalize_src1,
    normalize_src2,
    union_sources,
)
from reviewmart.operators.sentiment import LinearModel
from reviewmart.plans.load import Loaded, load_star
from reviewmart.plans.totals import Watch
from reviewmart.profiles import APP, BATCH, CLOTHING_SOURCE, ECOMMERCE_SOURCE, MANUAL_SOURCE
from reviewmart.sources.csv_files import dataset_files, list_files, read_files, read_texts
from reviewmart.sources.pages import extract_page_reviews

_Model = LinearModel | PipelineModel


def run_batch(
    spark: SparkSession,
    product_csv: str,
    clothing_csv: str,
    model: _Model,
    star_path: str,
    load_ts: datetime,
    multi_line: bool = True,
) -> Loaded:
    """Both review files through the whole batch pipeline, every row of them, in file order."""
    product, clothing = (
        in_file_order(read_files(spark, path, multi_line)) for path in (product_csv, clothing_csv)
    )
    watch = Watch(refuses=True)
    staged = union_sources(
        watch.rows(normalize_src1(product), ECOMMERCE_SOURCE),
        watch.rows(normalize_src2(clothing), CLOTHING_SOURCE),
    )
    enriched = enrich(drop_null_text(staged), model, BATCH)
    return load_star(enriched, star_path, load_ts, BATCH, watch)


def _ingest(
    reviews: DataFrame, model: _Model, star_path: str, load_ts: datetime, watch: Watch
) -> Loaded:
    return load_star(enrich(reviews, model, APP), star_path, load_ts, APP, watch)


def _ingest_files(
    spark: SparkSession,
    files: list[str],
    tag: Column,
    source: str,
    model: _Model,
    star_path: str,
    load_ts: datetime,
    multi_line: bool,
) -> Loaded:
    watch = Watch(refuses=False)
    texts = watch.rows(in_file_order(read_texts(spark, files, multi_line)), source)
    return _ingest(texts.withColumn("source", tag), model, star_path, load_ts, watch)


def ingest_csv(
    spark: SparkSession,
    path: str,
    name: str,
    model: _Model,
    star_path: str,
    load_ts: datetime,
    multi_line: bool = True,
) -> Loaded:
    """An uploaded CSV with a detected text column; ``name`` is its display name."""
    tag = source_tag("csv", F.lit(name))
    return _ingest_files(spark, list_files(spark, path), tag, name, model, star_path, load_ts, multi_line)


def ingest_dataset(
    spark: SparkSession,
    path: str,
    slug: str,
    model: _Model,
    star_path: str,
    load_ts: datetime,
    pick: str = "all",
    multi_line: bool = True,
) -> Loaded:
    """A downloaded dataset folder, all its CSV files unless asked for the first, tagged with its link."""
    tag = source_tag("dataset", F.lit(slug))
    return _ingest_files(spark, dataset_files(spark, path, pick), tag, slug, model, star_path, load_ts, multi_line)


def ingest_pages(
    pages: DataFrame,
    model: _Model,
    star_path: str,
    load_ts: datetime,
    per_page: int | None = None,
) -> Loaded:
    """Fetched pages (``page_id, url, html``), tagged with their address; all texts of a page unless
    ``per_page`` says how many."""
    watch = Watch(refuses=False)
    found = watch.rows(extract_page_reviews(pages, per_page), "pages")
    tagged = found.withColumn("source", source_tag("page", F.col("url")))
    return _ingest(tagged, model, star_path, load_ts, watch)


def append_reviews(
    reviews: DataFrame, model: _Model, star_path: str, load_ts: datetime
) -> Loaded:
    """Typed-in reviews (``review_text``); blank ones are refused, and counted as such."""
    watch = Watch(refuses=True)
    valid = watch.rows(reviews, MANUAL_SOURCE).filter(has_text(F.col("review_text")))
    return _ingest(valid.withColumn("source", source_tag("manual")), model, star_path, load_ts, watch)
