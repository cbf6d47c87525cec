import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from checks import inputs as I
from reviewmart.functions.text import term_counts, tokens
from reviewmart.operators import keys as K
from reviewmart.operators import lookup as L
from reviewmart.operators import normalize as N
from reviewmart.operators import sentiment as S
from reviewmart.operators.enrich import enrich, loadable, with_attributes
from reviewmart.operators.members import first_wins, new_members
from reviewmart.operators.resolve import resolve_product
from reviewmart.profiles import APP, BATCH
from reviewmart.session import stage, staging_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


# --- keys ------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_keys_do_not_depend_on_partitioning(spark, partitions):
    ids = [(i * 7919) % 5003 for i in range(5003)]
    df = spark.createDataFrame([(i % 2, i) for i in ids], "a int, b long").repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = K.assign_keys(df, ["a", "b"], "id", start=10, single_task_rows=0).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted((i % 2, i) for i in ids)
    assert sorted((r.id, r.a, r.b) for r in keyed) == [
        (11 + n, a, b) for n, (a, b) in enumerate(ordered)
    ]


def test_both_key_paths_agree(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("h"))
    assert tuples(K.assign_keys(df, ["h"], "id")) == tuples(
        K.assign_keys(df, ["h"], "id", single_task_rows=10)
    )


def test_scan_order_numbering_does_not_shuffle(spark):
    rows = stage(spark.range(0, 1000, 1, 5).withColumnRenamed("id", "v"), "rows")
    numbered = K.number_rows(rows)
    keyed = K.dense_keys(numbered, "id").orderBy("row_seq").collect()
    assert [r.id for r in keyed] == list(range(1, 1001))
    assert sorted(r.v for r in keyed) == list(range(1000))


# --- lookups ---------------------------------------------------------------------------


def test_large_lookup_splits_hot_keys_and_keeps_every_row(spark, monkeypatch):
    rng = random.Random(5)
    # A third of all rows share one key; some keys are missing from the table or null.
    keys = [0] * 2000 + [rng.randrange(900) for _ in range(4000)] + [None] * 50
    facts = spark.createDataFrame(list(enumerate(keys)), "i long, k long")
    table = stage(spark.range(800).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "t")
    monkeypatch.setattr(L, "HOT_KEYS", 3)
    found = L.lookup_join(facts, table, ["k"], max_broadcast_rows=10)
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert sorted((r.i, r.v) for r in found.collect()) == [
        (i, k * 2) for i, k in enumerate(keys) if k is not None and k < 800
    ]
    small = L.lookup_join(facts, table, ["k"])
    assert "BroadcastHashJoin" in plan_of(small) and "Exchange hash" not in plan_of(small)


def test_large_lookups_read_the_facts_once_and_salt_hot_keys(spark, monkeypatch):
    rng = random.Random(6)
    # A third of all rows share one key of each table; some keys are missing or null.
    names = ["hot"] * 2000 + [f"n{rng.randrange(900)}" for _ in range(4000)] + [None] * 50
    rows = [(i % 5000, k, rng.choice([7, rng.randrange(700)])) for i, k in enumerate(names)]
    rows += rows[:3]
    facts = stage(spark.createDataFrame(rows, "fact_no long, name string, city long"), "facts")
    known = [(n, i) for i, n in enumerate(["hot", *(f"n{j}" for j in range(800))])]
    people = stage(spark.createDataFrame(known, "name string, person long"), "people")
    cities = stage(spark.range(600).select(F.col("id").alias("city"), (F.col("id") * 2).alias("v")), "cities")
    tiny = stage(spark.createDataFrame([("hot", 1.5), ("n1", 2.5)], "name string, extra double"), "tiny")
    ids = dict(known)
    wanted = sorted(
        (i, n, c, ids[n], 2 * c) for i, n, c in rows if n in ids and c is not None and c < 600
    )
    monkeypatch.setattr(L, "HOT_KEYS", 40)
    lookups = [(people, ["name"]), (cities, ["city"])]
    found = L.lookup_joins(facts, lookups, max_bytes=300)
    plan = plan_of(found)
    assert len(re.findall(r"FileScan parquet.*fact_no", plan)) == 1
    assert plan.count("SortMergeJoin") == 2 and "NestedLoop" not in plan and "Cartesian" not in plan
    columns = ["fact_no", "name", "city", "person", "v"]
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == wanted
    # Hot keys: more than a fortieth of the rows; each is dealt over as many salts.
    salts = {r.name: r["_salts"] for r in L._salts(facts, ["name"]).collect()}
    assert set(salts) == {"hot"} and 13 <= salts["hot"] <= 15
    sizes = [r["count"] for r in L._salted_join(
        facts, people, ["name"], L._salts(facts, ["name"])
    ).filter("name = 'hot'").groupBy(F.pmod(F.xxhash64("fact_no", "name", "city"), F.lit(salts["hot"]))).count().collect()]
    assert len(sizes) == salts["hot"] and max(sizes) < 2 * sum(sizes) / len(sizes)
    # Small tables are broadcast, and one large among small ones shuffles the facts once.
    small = plan_of(L.lookup_joins(facts, lookups))
    assert small.count("BroadcastHashJoin") == 2 and "Exchange hash" not in small
    mixed = L.lookup_joins(facts, [(people, ["name"]), (tiny, ["name"])], max_bytes=300)
    assert plan_of(mixed).count("SortMergeJoin") == 1
    assert mixed.count() == sum(n in ("hot", "n1") for _, n, _ in rows)
    empty = L.lookup_joins(facts.limit(0), lookups, max_bytes=0)
    assert empty.count() == 0 and L.lookup_joins(facts, [(people.limit(0), ["name"])]).count() == 0
    assert L.table_bytes(people.limit(0)) == 0 < L.table_bytes(tiny) <= 300


# --- members ---------------------------------------------------------------------------


@pytest.mark.parametrize("order", [["o"], ["s", "o"]])
@pytest.mark.parametrize("attrs", [["age"], ["age", "label"], []])
def test_first_wins_against_brute_force(spark, order, attrs):
    rng = random.Random(7)
    rows = [
        (f"k{rng.randrange(40)}", rng.randrange(90), rng.choice("abc"), rng.randrange(3), o)
        for o in rng.sample(range(10_000), 3000)
    ]
    df = spark.createDataFrame(rows, "k string, age int, label string, s int, o long")
    names = df.columns
    best = {}
    for row in rows:
        r = dict(zip(names, row, strict=True))
        rank = tuple(r[c] for c in order)
        if r["k"] not in best or rank < best[r["k"]][0]:
            best[r["k"]] = (rank, tuple(r[a] for a in attrs))
    found = first_wins(df, ["k"], attrs, order)
    assert tuples(found) == sorted((k, *a, *rank) for k, (rank, a) in best.items())


def test_first_wins_combines_in_hash_tables_before_the_shuffle(spark, sf):
    rows = stage(spark.range(1000).selectExpr("id % 10 AS k", "id % 7 AS age", "id AS o"), "r")
    plan = plan_of(first_wins(rows, ["k"], ["age"], ["o"]))
    assert "SortAggregate" not in plan and "partial_min_by" in plan


def test_derived_keys_bring_no_null_check_over_the_hash(spark, sf):
    rows = with_attributes(I.reviews(spark, sf), BATCH)
    plan = plan_of(resolve_product(rows, I.stored_star(spark, sf).dim_product, BATCH))
    assert "md5" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "md5" in line]


def test_new_members(spark):
    known = spark.createDataFrame([("a",), ("b",)], "k string")
    found = spark.createDataFrame([("b", 1), ("c", 2)], "k string, v int")
    assert tuples(new_members(found, known, ["k"])) == [("c", 2)]


# --- normalisation ---------------------------------------------------------------------


def test_null_filter_reaches_both_scans(spark):
    one, two = staging_path(spark, "one"), staging_path(spark, "two")
    spark.createDataFrame([(1, "a"), (2, None)], "row_id long, review string").write.parquet(one)
    spark.createDataFrame(
        [(1, "b", "31.0", None), (2, None, "x", "Tops")],
        "row_id long, `Review Text` string, Age string, `Department Name` string",
    ).write.parquet(two)
    united = N.drop_null_text(
        N.union_sources(
            N.normalize_src1(spark.read.parquet(one)), N.normalize_src2(spark.read.parquet(two))
        )
    )
    assert [tuple(r) for r in united.orderBy("source_ord").collect()] == [
        (1, 1, "a", None, "General Electronics", "E-Commerce Dataset"),
        (2, 1, "b", 31, None, "Womens Clothing Dataset"),
    ]
    plan = plan_of(united)
    assert "IsNotNull(review)" in plan and "IsNotNull(`Review Text`)" in plan
    assert "Exchange" not in plan


def test_cap_is_a_top_n(spark):
    capped = N.cap(spark.range(1000).withColumnRenamed("id", "row_id"), 3, ["row_id"])
    assert [r[0] for r in capped.collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in plan_of(capped)


# --- sentiment -------------------------------------------------------------------------


def score_by_hand(text, weights, bias):
    tf = Counter(re.findall("[0-9a-z_]{2,}", text.lower()))
    known = {t: n for t, n in tf.items() if t in weights}
    dot = sum(n * weights[t][1] * weights[t][0] for t, n in known.items())
    square = sum((n * weights[t][1]) ** 2 for t, n in known.items())
    return bias + (dot / math.sqrt(square) if square else 0.0)


TEXTS = ["good good bad", "nothing known", "LOVE love, not awful!", "", None, " \n", "no review"]


def test_scores_against_brute_force_on_both_paths(spark):
    weights = {t: (w, i) for t, w, i in I.WEIGHTS} | {"no": (0.5, 1.0), "review": (-0.9, 1.5)}
    table = spark.createDataFrame(
        [(t, w, i) for t, (w, i) in weights.items()], "term string, weight double, idf double"
    )
    model = S.LinearModel(table, 0.05)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, review_text string")
    wanted = [
        score_by_hand(t if t and t.strip() else "No Review", weights, 0.05) for t in TEXTS
    ]
    for limit in (100, 0):
        found = S.linear_scores(df, model, max_local_terms=limit).orderBy("id").collect()
        assert [r.score for r in found] == pytest.approx(wanted)


def test_row_local_scoring_does_not_shuffle(spark):
    rows = stage(spark.createDataFrame(list(enumerate(TEXTS)), "id int, review_text string"), "r")
    assert "Exchange" not in plan_of(enrich(rows, I.test_model(spark), BATCH))


def test_empty_model_scores_its_bias(spark):
    empty = spark.createDataFrame([], "term string, weight double, idf double")
    df = spark.createDataFrame([(1, "good")], "id int, review_text string")
    assert S.linear_scores(df, S.LinearModel(empty, -0.5)).first().score == -0.5


def test_profiles_treat_missing_text_differently(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "so good")], "id int, review_text string")
    df = df.withColumn("source", F.lit("x"))
    model = I.test_model(spark)
    app = loadable(enrich(df, model, APP), APP).orderBy("id").collect()
    assert [(r.review_text, r.sentiment_label, r.issue_reason) for r in app] == [
        ("None", "Neutral", "No Review Provided"),
        ("  ", "Neutral", "Positive User Feedback"),
        ("so good", "Positive", "Positive User Feedback"),
    ]
    assert app[0].ai_recommendation == APP.default_advice
    batch = enrich(df, model, BATCH)
    assert [r.sentiment_label for r in batch.orderBy("id").collect()] == ["Positive"] * 3
    assert [r.id for r in loadable(batch, BATCH).collect()] == [3]


def test_weights_round_trip(spark):
    path = staging_path(spark, "weights")
    S.save_weights(I.test_model(spark), path)
    back = S.load_weights(spark, path)
    assert back.bias == I.BIAS and tuples(back.weights) == sorted(I.WEIGHTS)


def labelled(spark, sf):
    texts = I.table(spark, sf, "documents").select("doc_id", F.col("text").alias("_text"))
    labels = I.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return texts.join(labels, "doc_id")


@pytest.fixture(scope="module")
def fitted(spark, sf):
    rows = labelled(spark, sf)
    return rows, S.fit_sentiment(rows.filter("doc_id % 5 <> 0"), "doc_id")


def test_fit_separates_labels_it_has_not_seen(spark):
    rows = labelled(spark, "/root/testdata/sf0.01")
    model = S.fit_sentiment(rows.filter("doc_id % 5 <> 0"), "doc_id")
    scored = model.transform(rows.filter("doc_id % 5 = 0")).select("label", "_margin")
    assert BinaryClassificationEvaluator(rawPredictionCol="_margin").evaluate(scored) > 0.7


def test_repeated_and_null_keys_change_no_score(spark):
    df = spark.createDataFrame(
        [(1, "good good"), (1, "awful"), (None, "awful"), (1, "good good")],
        "id int, review_text string",
    )
    local = tuples(S.linear_scores(df, I.test_model(spark)).fillna(0, ["id"]))
    joined = tuples(S.linear_scores(df, I.test_model(spark), max_local_terms=0).fillna(0, ["id"]))
    assert [r[:2] for r in joined] == [r[:2] for r in local]
    assert [r[2] for r in joined] == pytest.approx([r[2] for r in local])


def test_exported_weights_score_like_the_pipeline(spark, fitted):
    rows, model = fitted
    path = staging_path(spark, "pipeline")
    model.save(path)
    linear = S.export_weights(spark, S.load_pipeline(path))
    named = rows.withColumnRenamed("_text", "review_text").select("doc_id", "review_text")
    pipeline = S.predict_sentiment(named, model, BATCH)
    assert tuples(S.predict_sentiment(named, linear, BATCH)) == tuples(pipeline)
    margins = {
        r.doc_id: r._margin[1] for r in model.transform(rows).select("doc_id", "_margin").collect()
    }
    scores = {r.doc_id: r.score for r in S.linear_scores(named, linear).collect()}
    assert scores == pytest.approx(margins)


def test_tfidf_against_brute_force_with_a_hot_term(spark, monkeypatch):
    rng = random.Random(3)
    texts = [
        " ".join(["the"] * rng.randrange(1, 4) + [f"w{rng.randrange(60)}" for _ in range(12)])
        for _ in range(120)
    ] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    counts = {i: Counter(t.split()) for i, t in enumerate(texts) if t}
    n = sum(t is not None for t in texts)
    seen = Counter(term for c in counts.values() for term in c)
    wanted = {}
    for i, c in counts.items():
        raw = {t: k * math.log((n + 1) / (seen[t] + 1)) for t, k in c.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        wanted |= {(i, t): v / length for t, v in raw.items()}
    for limit in (1000, 5):
        monkeypatch.setattr(L, "MAX_BROADCAST_ROWS", limit)
        monkeypatch.setattr(L, "HOT_KEYS", 20)
        found = {(r.id, r.term): r.tfidf for r in S.tfidf(df, "id").collect()}
        assert found == pytest.approx(wanted)


def test_tfidf_shuffles_texts_once(spark, sf):
    plan = plan_of(S.tfidf(I.table(spark, sf, "documents"), "doc_id"))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_enriched_counts_match_by_source(spark, sf):
    rows = I.enriched(spark, sf)
    by = defaultdict(int)
    for r in rows.groupBy("source", "sentiment_label").count().collect():
        by[r.source] += r["count"]
    total = N.drop_null_text(I.reviews(spark, sf)).groupBy("source").count().collect()
    assert dict(by) == {r.source: r["count"] for r in total}


def test_terms_are_counted_inside_the_row(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["", None, "x", "Aa aA aa", "hot " * 50_000 + "cold"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for i, found in df.select("id", term_counts(tokens(F.col("text")))).collect():
        wanted = Counter(re.findall("[0-9a-z_]{2,}", (texts[i] or "").lower()))
        assert [tuple(t) for t in found] == sorted(wanted.items())


def exchanged_columns(plan):
    """Columns that go into each shuffle, by the formatted plan."""
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)
    return [set(re.findall(r"(\w+)#", block)) for block in blocks]


def test_no_text_is_shuffled_to_score(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_BROADCAST_ROWS", 3)
    stored = []

    def kept(df, name):
        stored.append(df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        ))
        return stage(df, name)

    monkeypatch.setattr(S, "stage", kept)
    monkeypatch.setattr(L, "stage", kept)
    df = stage(spark.createDataFrame([(i, f"good w{i % 7} text") for i in range(40)], "id long, text string"), "t")
    S.linear_scores(df, I.test_model(spark), text="text", max_local_terms=0)
    columns = [c for plan in stored for c in exchanged_columns(plan)]
    assert columns and not any("text" in c for c in columns)


def test_few_sums_leave_scored_rows_where_they_lie(spark):
    df = stage(spark.createDataFrame(list(enumerate(TEXTS)), "id int, review_text string"), "r")
    plan = plan_of(S.linear_scores(df, I.test_model(spark), max_local_terms=0))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_fit_sums_up_few_partitions(spark, sf, monkeypatch):
    rows = I.table(spark, sf, "documents").join(I.table(spark, sf, "labels"), "doc_id")
    rows = rows.select("doc_id", F.col("text").alias("_text"), F.col("quality").alias("label"))
    seen = []

    def fit(self, df):
        seen.append(df.rdd.getNumPartitions())
        return fitted(self, df)

    fitted = S.LogisticRegression.fit
    monkeypatch.setattr(S.LogisticRegression, "fit", fit)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.fit_sentiment(rows, "doc_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert seen == [S.FIT_PARTITIONS]


@pytest.mark.parametrize("rows", [500_000, 0])
def test_tfidf_deals_texts_over_tasks_by_their_bytes(spark, sf, monkeypatch, rows):
    texts = I.table(spark, sf, "documents").filter("doc_id < 40")
    wanted = tuples(S.tfidf(texts, "doc_id").select("doc_id", "term", "tf"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(S, "TASK_BYTES", size // 29)
    monkeypatch.setattr(L, "MAX_BROADCAST_ROWS", rows)
    monkeypatch.setattr(L, "TASK_ROWS", 100)
    dealt = S.tfidf(texts, "doc_id")
    assert "hashpartitioning(doc_id#" in plan_of(dealt) and ", 30), REPARTITION_BY_NUM" in plan_of(dealt)
    assert tuples(dealt.select("doc_id", "term", "tf")) == wanted
