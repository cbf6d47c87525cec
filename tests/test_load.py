import glob
import os
from datetime import datetime

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks import queries
from reviewmart.operators import quality as Q
from reviewmart.operators.enrich import enrich, loadable, with_attributes
from reviewmart.operators.keys import dense_keys, in_order, number_rows
from reviewmart.operators.members import first_wins, first_wins_of_each, grouped_members
from reviewmart.operators.normalize import drop_null_text
from reviewmart.operators.sentiment import fit_sentiment
from reviewmart.plans import admin, ingest
from reviewmart.plans import dashboard as D
from reviewmart.plans.load import fact_rows, load_star
from reviewmart.plans.totals import SourceTotals
from reviewmart.profiles import APP, BATCH
from reviewmart.session import stage, staging_path
from reviewmart.sources import csv_files
from reviewmart.sources.warehouse import (
    COLUMNS,
    DIMENSIONS,
    Star,
    commit,
    read_newest,
    read_parts,
    read_star,
    write_part,
)

T1, T2 = datetime(2024, 3, 15, 10, 30), datetime(2024, 3, 16, 23, 59, 59)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def sizes(star):
    return {t: getattr(star, t).count() for t in (*DIMENSIONS, "fact_reviews")}


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "row_id int, review_text string")


def append(spark, path, at, *values):
    model = I.test_model(spark)
    df = in_order(texts(spark, *values), ["row_id"])
    return ingest.append_reviews(df, model, path, at)


@pytest.fixture
def path(spark):
    return staging_path(spark, "star")


def test_empty_warehouse(spark, path):
    star = read_star(spark, path)
    assert set(sizes(star).values()) == {0}
    assert D.sentiment_counts(star).collect() == []
    assert admin.delete_review(spark, path, [1], T1) == 0


@pytest.fixture(scope="module")
def batch(spark, sf):
    path = staging_path(spark, "star")
    return path, I.load_batch(spark, sf, path)


def test_load_invariants(spark, sf, batch):
    _, star = batch
    total = I.reviews(spark, sf).filter(F.trim("review_text") != "").count()
    ids = star.fact_reviews.agg(
        F.count("*"), F.min("review_id"), F.max("review_id"), F.countDistinct("review_id")
    ).first()
    assert tuple(ids) == (total, 1, total, total)
    assert all(r.orphan_keys == 0 for r in Q.fk_orphans(star).collect())
    assert all(r.duplicates == 0 for r in Q.key_duplicates(star).collect())
    assert all(r.violations == 0 for r in Q.width_violations(star).collect())


def test_load_does_not_depend_on_partitioning(spark, sf, batch):
    _, star = batch
    raw = drop_null_text(I.reviews(spark, sf)).repartition(13, "review_text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        enriched = enrich(in_order(raw, I.KEYS), I.test_model(spark), BATCH)
        other = load_star(enriched, staging_path(spark, "star"), I.LOAD_TS, BATCH).star
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for table in (*DIMENSIONS, "fact_reviews"):
        assert rows(getattr(star, table)) == rows(getattr(other, table))


def test_reload_adds_facts_but_no_members(spark, sf, path):
    first = sizes(I.load_batch(spark, sf, path))
    second = sizes(I.load_batch(spark, sf, path))
    assert second.pop("fact_reviews") == 2 * first.pop("fact_reviews")
    assert second == first


def test_first_load_fixes_the_customer(spark, path):
    append(spark, path, T1, "good value")
    before = rows(read_star(spark, path).dim_customer)
    source = spark.createDataFrame(
        [(1, 1, "good value", 99, "Tops", "E-Commerce Dataset")],
        "source_ord int, row_id long, review_text string, input_age int, input_category string, "
        "source string",
    )
    star = load_star(enrich(source, I.test_model(spark), BATCH), path, T2, BATCH).star
    assert rows(star.dim_customer) == before
    # The batch looks products up by name and category, so a new one appears.
    assert star.dim_product.count() == 2
    assert rows(star.dim_date, "date_id", "review_day") == [(1, 15), (2, 16)]
    assert rows(star.fact_reviews, "review_id", "date_id", "load_timestamp", "source_link") == [
        (1, 1, T1, "Manual Entry"),
        (2, 2, T2, "Merged Pipeline (E-Commerce Dataset)"),
    ]
    # The app takes the lowest id among the categories of one name.
    third = append(spark, path, T2, "good value").star
    assert rows(third.fact_reviews, "review_id", "product_id")[-1] == (3, 1)


def test_manual_entries_must_hold_text(spark, path):
    loaded = append(spark, path, T1, "bad", " \n", None, "nice")
    assert loaded.rows == 2
    assert rows(loaded.star.fact_reviews, "review_id", "review_text", "sentiment_label") == [
        (1, "bad", "Negative"), (2, "nice", "Positive"),
    ]


def test_uploads_store_missing_text_as_none(spark, path):
    df = texts(spark, "bad", None, " ").withColumn("source", F.lit("Local CSV (a.csv)"))
    enriched = enrich(in_order(df, ["row_id"]), I.test_model(spark), APP)
    star = load_star(enriched, path, T1, APP).star
    assert rows(star.fact_reviews, "review_id", "review_text", "sentiment_label") == [
        (1, "bad", "Negative"), (2, "None", "Neutral"), (3, " ", "Neutral"),
    ]


def test_delete(spark, path):
    append(spark, path, T1, "a1", "b2", "c3")
    assert admin.delete_review(spark, path, [99], T2) == 0
    assert admin.delete_review(spark, path, [2, 99], T2) == 1
    assert admin.delete_review(spark, path, [2], T2) == 0
    star = read_star(spark, path)
    assert rows(star.fact_reviews, "review_id") == [(1,), (3,)]
    assert star.dim_customer.count() == 3
    added = append(spark, path, T2, "d4").star
    assert rows(added.fact_reviews, "review_id") == [(1,), (3,), (4,)]
    assert rows(append(spark, path, T2, "e5").star.fact_reviews, "review_id")[-1] == (5,)


def part_files(path, load_id):
    folder = f"{path}/fact_reviews/load_id={load_id}"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else None


@pytest.mark.parametrize("limit", [500_000, 0])
def test_a_delete_rewrites_only_the_parts_it_hits(spark, path, monkeypatch, limit):
    monkeypatch.setattr("reviewmart.operators.lookup.MAX_BROADCAST_ROWS", limit)
    for texts_of_load in (("a1", "b2", "c3"), ("d4", "e5"), ("f6", "g7"), ("h8",)):
        append(spark, path, T1, *texts_of_load)
    before = {r.review_id: r for r in read_star(spark, path).fact_reviews.collect()}
    files = {n: part_files(path, n) for n in (1, 2, 3, 4)}
    ids = spark.createDataFrame([(2,), (4,), (5,), (5,), (99,), (None,)], "review_id int")
    assert admin.delete_review(spark, path, ids, T2) == 3
    fact = read_star(spark, path).fact_reviews
    # The rows left are as they were, parts without a deleted review are the same files,
    # a part left empty is gone, and reading joins nothing.
    assert fact.columns == list(COLUMNS["fact_reviews"])
    assert {r.review_id: r for r in fact.collect()} == {i: before[i] for i in (1, 3, 6, 7, 8)}
    assert part_files(path, 3) == files[3] and part_files(path, 4) == files[4]
    assert part_files(path, 2) is None and part_files(path, 1) not in (None, files[1])
    assert "Join" not in fact._jdf.queryExecution().optimizedPlan().toString()
    assert not staged_tables(spark)


def test_a_delete_scans_the_parts_it_hits(spark, path):
    for text in ("a1", "b2", "c3"):
        append(spark, path, T1, text)
    stored = read_parts(spark, path, "fact_reviews", 0, 3)
    found = stage(stored.filter("review_id = 2").select("review_id", "load_id"), "star-found")
    kept = admin.without(stored, found)
    assert "dynamicpruning" in kept._jdf.queryExecution().toString()
    assert kept.count() == 0


def test_a_repeated_delete_finishes_a_failed_one(spark, path, monkeypatch):
    append(spark, path, T1, "a1", "b2", "c3")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(admin, "replace_parts", fail)
        with pytest.raises(RuntimeError):
            admin.delete_review(spark, path, [3], T2)
    assert read_star(spark, path).fact_reviews.count() == 3
    assert [r.ID for r in D.newest_records(read_newest(spark, path, 1), 1).collect()] == [3]
    assert admin.delete_review(spark, path, [3], T2) == 1
    assert [r.ID for r in D.newest_records(read_newest(spark, path, 1), 1).collect()] == [2]


def test_delete_all_keeps_members_and_goes_on_counting(spark, path):
    append(spark, path, T1, "a1", "b2")
    admin.delete_review(spark, path, [1], T1)
    admin.delete_all_reviews(spark, path, T2)
    star = read_star(spark, path)
    assert star.fact_reviews.count() == 0 and star.dim_customer.count() == 2
    assert rows(append(spark, path, T2, "c3").star.fact_reviews, "review_id") == [(3,)]


def test_unfinished_load_is_invisible_and_written_over(spark, path):
    star = append(spark, path, T1, "a1").star
    before = sizes(star)
    for table in (*DIMENSIONS, "fact_reviews"):
        write_part(getattr(star, table), path, table, 2)
    assert sizes(read_star(spark, path)) == before
    assert rows(append(spark, path, T1, "b2").star.fact_reviews, "review_id", "review_text") == [
        (1, "a1"), (2, "b2"),
    ]


def test_batch_run_from_csv(spark, sf, batch, path):
    product, clothing = staging_path(spark, "csv"), staging_path(spark, "csv")
    csv_files.write_reviews_csv(I.product_reviews(spark, sf).drop("row_id"), product)
    csv_files.write_reviews_csv(I.clothing_reviews(spark, sf).drop("row_id"), clothing)
    star = ingest.run_batch(spark, product, clothing, I.test_model(spark), path, T1).star
    for query in (D.sentiment_counts, D.gender_sentiment, D.reason_sentiment, D.category_sentiment):
        assert rows(query(star)) == rows(query(batch[1]))


def test_uploaded_csv_and_dataset(spark, path, tmp_path):
    (tmp_path / "b.csv").write_text("id,Feedback\n1,good\n2,\n3,awful\n")
    (tmp_path / "a.csv").write_text('Sentiment,comment\nx,"love, ""great"""\n')
    model = I.test_model(spark)
    ingest.ingest_csv(spark, str(tmp_path / "b.csv"), "b.csv", model, path, T1)
    star = ingest.ingest_dataset(spark, str(tmp_path), "me/set", model, path, T2, "first").star
    assert rows(star.fact_reviews, "review_id", "review_text", "sentiment_label", "source_link") == [
        (1, "good", "Positive", "Local CSV (b.csv)"),
        (2, "None", "Neutral", "Local CSV (b.csv)"),
        (3, "awful", "Negative", "Local CSV (b.csv)"),
        (4, 'love, "great"', "Positive", "https://www.kaggle.com/datasets/me/set"),
    ]
    assert rows(D.source_type_counts(star)) == [("Kaggle Dataset", 1), ("Local CSV", 3)]


def test_newest_records(spark, batch):
    _, star = batch
    total = star.fact_reviews.count()
    newest = D.newest_records(star, 7)
    assert [r.ID for r in newest.collect()] == list(range(total, total - 7, -1))
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(review_id" in plan


def test_dashboard_reads_no_text(spark, batch):
    plan = D.reason_sentiment(batch[1])._jdf.queryExecution().executedPlan().toString()
    assert "review_text" not in plan and "Exchange hashpartitioning" in plan
    assert "SortMergeJoin" not in plan


def test_fact_is_built_without_shuffling_it(spark, sf, batch):
    _, star = batch
    rows = with_attributes(loadable(I.enriched(spark, sf), BATCH), BATCH)
    numbered = number_rows(rows.withColumn("source_link", F.col("source")))
    facts = fact_rows(dense_keys(numbered, "review_id"), star, I.LOAD_TS, BATCH)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    # The only exchange by key is the one that counts rows per partition for the offsets.
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 4 and "NestedLoop" not in plan


def test_quality_reports_find_faults(spark, path):
    star = append(spark, path, T1, "a1", "b2").star
    faulty = Star(
        star.dim_date,
        star.dim_product.filter("product_id > 1").withColumn("brand", F.repeat(F.lit("x"), 101)),
        star.dim_customer.unionAll(star.dim_customer),
        star.dim_location,
        star.fact_reviews.withColumn("source_link", F.repeat(F.lit("é"), 501)),
    )
    orphans = {r.foreign_key: (r.orphan_keys, r.orphan_reviews) for r in Q.fk_orphans(faulty).collect()}
    assert orphans["product_id"] == (1, 1) and orphans["location_id"] == (0, 0)
    wide = {(r.table_name, r.column_name): r.violations for r in Q.width_violations(faulty).collect()}
    assert wide[("dim_product", "brand")] == 1 and wide[("fact_reviews", "source_link")] == 2
    assert wide[("dim_product", "category")] == 0
    twice = {(r.table_name, r.key): r.duplicates for r in Q.key_duplicates(faulty).collect()}
    assert twice[("dim_customer", "customer_id")] == 2 and twice[("fact_reviews", "review_id")] == 0


def test_load_summary_of_an_empty_source(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source string, id int")
    summary = Q.load_summary(raw, raw.filter("id = 1"))
    assert rows(summary) == [("a", 2, 1, False), ("b", 1, 0, True)]


def test_commit_is_the_only_publication(spark, path):
    commit(spark, path, 1, "clear", T1, 0, 41)
    assert rows(append(spark, path, T1, "x1").star.fact_reviews, "review_id") == [(42,)]


def load_split(spark, folders, split):
    """A batch load of large flat files, read in splits of at most ``split`` bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return ingest.run_batch(
            spark, *folders, I.test_model(spark), staging_path(spark, "star"), T1, multi_line=False
        ).star
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_batch_run_does_not_depend_on_file_splits(spark, sf):
    folders = staging_path(spark, "csv"), staging_path(spark, "csv")
    for df, folder in zip((I.product_reviews(spark, sf), I.clothing_reviews(spark, sf)), folders):
        flat = df.select([
            F.regexp_replace(n, "[\r\n]", " ").alias(n) if k == "string" else n for n, k in df.dtypes
        ])
        csv_files.write_reviews_csv(flat.repartition(3).drop("row_id"), folder)
    whole, split = (load_split(spark, folders, n) for n in ("128m", "20k"))
    for table in (*DIMENSIONS, "fact_reviews"):
        assert rows(getattr(whole, table)) == rows(getattr(split, table))


def test_a_load_leaves_no_staging(spark, path):
    before = set(staged_tables(spark))
    append(spark, path, T1, "good", "bad")
    assert set(staged_tables(spark)) == before


def staged_tables(spark):
    folder = os.path.dirname(staging_path(spark, "x"))
    return [n for n in os.listdir(folder) if not n.startswith(("star", "csv"))]


def test_many_loads_are_not_listed_in_the_plan(spark, path):
    append(spark, path, T1, "good")
    for load_id in range(2, 40):
        commit(spark, path, load_id, "load", T1, 0, 1)
    fact = read_star(spark, path).fact_reviews
    assert fact.count() == 1
    assert " IN (" not in fact._jdf.queryExecution().optimizedPlan().toString()


def test_a_failed_load_stays_hidden_behind_a_delete_of_its_id(spark, path):
    star = append(spark, path, T1, "good", "bad").star
    write_part(star.fact_reviews, path, "fact_reviews", 2)
    assert admin.delete_review(spark, path, [1], T2) == 1
    assert rows(read_star(spark, path).fact_reviews, "review_id") == [(2,)]


def test_a_load_tells_what_it_read_and_refused(spark, path, tmp_path):
    loaded = append(spark, path, T1, "bad", " \n", None, "nice")
    assert loaded.totals == (SourceTotals("Manual Entry", 4, 1, 1, 2),)
    (tmp_path / "b.csv").write_text("id,Feedback\n1,good\n2,\n3, \n")
    model = I.test_model(spark)
    upload = ingest.ingest_csv(spark, str(tmp_path / "b.csv"), "b.csv", model, path, T1)
    assert upload.totals == (SourceTotals("b.csv", 3, 1, 1, 3),) and upload.rows == 3


def test_dashboard_counts_before_it_joins(spark, batch):
    for query in (D.gender_sentiment, D.category_sentiment, D.age_group_counts):
        plan = query(batch[1])._jdf.queryExecution().optimizedPlan().toString()
        # The deepest node that is no scan or projection of the fact is an aggregate.
        fact = plan[: plan.index("Relation [review_id")].rstrip().splitlines()
        assert plan.count("Join") == 1 and plan.count("Aggregate") == 2
        assert plan.index("Aggregate") < plan.index("Join") < plan.rindex("Aggregate"), fact
    for query in (D.sentiment_counts, D.reason_sentiment, D.source_type_counts):
        assert "Join" not in query(batch[1])._jdf.queryExecution().optimizedPlan().toString()


def test_members_take_one_pass(spark, sf):
    rows = with_attributes(loadable(drop_null_text(I.reviews(spark, sf)), BATCH), BATCH)
    numbered = number_rows(rows)
    sets = {
        "product": (["product_name", "category"], ["brand"]),
        "customer": (["customer_name"], ["age", "gender"]),
        "location": (["country", "city"], []),
    }
    plan = grouped_members(numbered, sets, ["row_seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan and "SortAggregate" not in plan
    found = first_wins_of_each(numbered, sets, ["row_seq"])
    for name, (keys, attrs) in sets.items():
        one = first_wins(numbered, keys, attrs, ["row_seq"])
        assert found[name].columns == one.columns and rows_of(found[name]) == rows_of(one)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_newest_records_read_the_last_loads_only(spark, path):
    for k in range(4):
        append(spark, path, T1, *(f"text {k} {i}" for i in range(3)))
    newest = D.newest_records(read_newest(spark, path, 4), 4)
    assert [r.ID for r in newest.collect()] == [12, 11, 10, 9]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "load_id#" in plan and "> 2)" in plan
    admin.delete_review(spark, path, [12, 11, 10, 9], T2)
    assert [r.ID for r in D.newest_records(read_newest(spark, path, 4), 4).collect()] == [8, 7, 6, 5]
    admin.delete_all_reviews(spark, path, T2)
    assert D.newest_records(read_newest(spark, path, 4), 4).collect() == []
    append(spark, path, T2, "one more")
    assert [r.ID for r in D.newest_records(read_newest(spark, path, 4), 4).collect()] == [13]


def test_newest_of_an_empty_warehouse(spark, path):
    assert read_newest(spark, path, 5).fact_reviews.count() == 0


def test_a_fitted_model_scores_after_and_inside_an_observed_load(spark, path):
    append(spark, path, T1, "good")
    labelled = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(["awful bad", "good love"] * 4)], "k int, _text string, label int")
    model = fit_sentiment(labelled, "k", min_df=1.0)
    df = in_order(texts(spark, "awful", " ", "love"), ["row_id"])
    loaded = ingest.append_reviews(df, model, path, T1)
    assert loaded.totals == (SourceTotals("Manual Entry", 3, 0, 1, 2),)
    assert rows(loaded.star.fact_reviews, "review_text", "sentiment_label") == [
        ("awful", "Negative"), ("good", "Positive"), ("love", "Positive"),
    ]


def test_parts_have_small_row_groups(spark, path, monkeypatch):
    monkeypatch.setattr("reviewmart.sources.warehouse.ROW_GROUP_BYTES", 20_000)
    rows = spark.range(20_000).select(F.col("id").alias("location_id"), F.md5(F.col("id").cast("string")).alias("country"), F.lit("x").alias("city"))
    write_part(rows.coalesce(1), path, "dim_location", 1)
    found = glob.glob(f"{path}/dim_location/load_id=1/*.parquet")
    assert len(found) == 1 and parquet.ParquetFile(found[0]).num_row_groups > 3


def test_a_copied_warehouse_is_read_in_small_splits(spark, sf, monkeypatch):
    read = []

    def read_star(session, path):
        read.append(session.conf.get("spark.sql.files.maxPartitionBytes"))
        return stored(session, path)

    stored = queries.read_star
    monkeypatch.setattr(queries, "read_star", read_star)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    queries._copied(spark, sf)
    assert read == ["8m"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
