"""Time the headline queries on whole tables and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores. Each query runs
once into a discarding sink, after one untimed query warms up the JVM. Dashboard queries
read a warehouse loaded beforehand; that load is reported as ``setup``, a fresh one as
``star_load``.
"""

from __future__ import annotations

import json
import os
import time

from checks import inputs
from checks.queries import QUERIES
from reviewmart.session import build_session

HEADLINE = (
    "scan_csv",
    "page_reviews",
    "union_sources",
    "linear_sentiment",
    "linear_sentiment_joined",
    "enrich_reviews",
    "enrich_reviews_app",
    "review_reasons",
    "text_hash_mods",
    "derived_customer",
    "dim_customer_first",
    "dim_product_distinct",
    "assign_keys",
    "resolve_product",
    "star_load",
    "batch_pipeline",
    "star_load_app",
    "star_stats",
    "sentiment_counts",
    "gender_sentiment",
    "category_sentiment",
    "reason_sentiment",
    "age_group_counts",
    "records_top100",
    "source_type_counts",
    "delete_review",
    "fk_orphans",
    "key_duplicates",
    "tfidf_terms",
    "ml_sentiment",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            # The test files are small: cut them so that every core gets a share.
            "spark.sql.files.maxPartitionBytes": "2m",
            "spark.sql.files.openCostInBytes": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "review_reasons", sf_dir)
    start = time.perf_counter()
    for kind in ("batch", "app"):
        inputs.stored_path(spark, sf_dir, kind)
    setup = round(time.perf_counter() - start, 3)
    seconds = {name: run(spark, name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "setup": setup,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
