import hashlib

import pytest
from pyspark.sql import functions as F

from reviewmart.functions import attributes as A
from reviewmart.functions.bands import age_group
from reviewmart.functions.hashing import BUCKETS, md5_fold, text_bucket
from reviewmart.functions.links import source_tag, source_type, source_url
from reviewmart.functions.rules import issue_reason, recommend
from reviewmart.functions.text import has_text, is_blank, strip, to_int, tokens
from reviewmart.profiles import APP, BATCH


def values(spark, expression, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


SPACES = ["", " ", "\t\n", " ", "　  ", "\x1c\x1f", "\x0b\x0c", "\x85", "a", " a ",
          "​", " a b\n\n", "\n \nx\n", "  \n x"]


def test_blank_and_strip_agree_with_python(spark):
    assert values(spark, is_blank, SPACES) == [s.strip() == "" for s in SPACES]
    assert values(spark, strip, SPACES) == [s.strip() for s in SPACES]
    assert values(spark, has_text, [None, " ", "x"]) == [False, False, True]


def test_lower_case_agrees_with_python(spark):
    words = ["CHARGER", "Größe", "İstanbul", "ΟΔΟΣ", "ẞ", "ÉTÉ"]
    assert values(spark, F.lower, words) == [w.lower() for w in words]


def test_tokens(spark):
    assert values(spark, tokens, ["A big_Dog, 42 x!", "", None]) == [["big_dog", "42"], [], None]


def test_to_int(spark):
    texts = ["31", "31.0", "31.9", " 7 ", "x", "", None]
    assert values(spark, to_int, texts) == [31, 31, 31, 7, None, None, None]
    assert values(spark, to_int, [31.9, -2.5, None], "double") == [31, -2, None]


@pytest.mark.parametrize("m", [2, 3, 5, 6, 7, 45, 50, 1000, BUCKETS, 2**30 - 1])
def test_md5_fold_agrees_with_python(spark, m):
    texts = [f"text {i} é{'x' * i}" for i in range(200)] + ["", "None"]
    numbers = [int(hashlib.md5(t.encode()).hexdigest(), 16) for t in texts]
    assert values(spark, lambda c: md5_fold(c, m), texts) == [n % m for n in numbers]


def test_md5_fold_refuses_moduli_it_cannot_hold():
    for m in (0, -1, 2**30):
        with pytest.raises(ValueError):
            md5_fold(None, m)


@pytest.mark.parametrize("m", [2, 3, 5, 6, 7, 45, 50, 1000])
def test_bucket_keeps_every_residue(spark, m):
    texts = [f"review {i}" for i in range(100)]
    residues = values(spark, lambda c: text_bucket(c) % m, texts)
    assert residues == [int(hashlib.md5(t.encode()).hexdigest(), 16) % m for t in texts]


def test_city_belongs_to_its_country(spark):
    rows = spark.range(1000).select(A.country(F.col("id")), A.city(F.col("id"))).distinct()
    pairs = {tuple(r) for r in rows.collect()}
    assert len(pairs) == 15
    assert ("Egypt", "Giza") in pairs and ("Germany", "Giza") not in pairs


def reasons(spark, rows, profile):
    df = spark.createDataFrame(rows, "text string, sentiment string")
    lowered = df.select(F.lower("text").alias("l"), "sentiment")
    return [r[0] for r in lowered.select(
        issue_reason(F.col("l"), F.col("sentiment"), profile)).collect()]


def test_reason_edges(spark):
    rows = [
        (None, "Negative"),
        ("battery arrived broken", "Negative"),
        ("not a profit", "Negative"),
        ("so happy", "Negative"),
        ("the best", "Positive"),
        ("   ", "Neutral"),
        ("I LOVE it", "Positive"),
        ("plain", "Negative"),
        ("battery", None),
    ]
    shared = ["No Review Provided", "Hardware and Power Issues", "Product Sizing and Fit Defect"]
    assert reasons(spark, rows, BATCH) == shared + [
        "Software Interface Bug",
        "High Customer Satisfaction",
        "Positive User Feedback",
        "High Customer Satisfaction",
        "General Product Dissatisfaction",
        "Positive User Feedback",
    ]
    assert reasons(spark, rows, APP) == shared + [
        "General Product Dissatisfaction",
        "Positive User Feedback",
        "Positive User Feedback",
        "High Customer Satisfaction",
        "General Product Dissatisfaction",
        "Positive User Feedback",
    ]


@pytest.mark.parametrize("profile", [BATCH, APP])
def test_every_keyword_finds_its_reason_unless_an_earlier_one_does(spark, profile):
    for sentiment, rules in (
        ("Negative", profile.negative_rules),
        ("Positive", profile.other_rules),
    ):
        cases = [(word, reason) for reason, words in rules for word in words]
        found = reasons(spark, [(f"x {word.upper()}y", sentiment) for word, _ in cases], profile)
        wanted = [
            next(r for r, ws in rules if any(w in word for w in ws)) for word, _ in cases
        ]
        assert found == wanted


def test_recommendations(spark):
    names = [r for r, _ in BATCH.advice] + ["No Review Provided", "other", None]
    for profile in (BATCH, APP):
        found = values(spark, lambda c: recommend(c, profile), names)  # noqa: B023
        assert found == [dict(profile.advice).get(n, profile.default_advice) for n in names]


def test_age_bands(spark):
    ages = [-1, 0, 1, 25, 26, 35, 36, 50, 51, 100, 101, None]
    assert values(spark, age_group, ages, "int") == [
        None, None, "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "50+", "50+", None, None,
    ]


def test_links(spark):
    links = [
        "https://www.kaggle.com/datasets/a/b",
        "https://shop.example/KAGGLE",
        "http://shop.example/1",
        "HTTP://x",
        "Merged Pipeline (E-Commerce Dataset)",
        "Local CSV (Manual.csv)",
        "Manual Entry",
        "manual",
        None,
    ]
    assert values(spark, source_type, links) == [
        "Kaggle Dataset", "Kaggle Dataset", "Web Scraped", "Local CSV", "Local CSV",
        "Manual Entry", "Manual Entry", "Local CSV", "Local CSV",
    ]
    assert values(spark, source_url, links) == links[:3] + [None] * 6
    assert values(spark, lambda c: source_tag("csv", c), ["a.csv"]) == ["Local CSV (a.csv)"]
    assert values(spark, lambda c: source_tag("dataset", c), ["a/b"]) == links[:1]
    with pytest.raises(ValueError):
        source_tag("ftp", None)


def attributes_of(spark, column, profile, rows):
    df = spark.createDataFrame(rows, "b int, source string")
    return [r[0] for r in df.select(column(F.col("b"), F.col("source"), profile)).collect()]


def test_gender_and_category_by_profile(spark):
    rows = [
        (0, "Womens Clothing Dataset"),
        (0, "Local CSV (Womens.csv)"),
        (0, "x"),
        (1, "x"),
        (2, None),
    ]
    assert attributes_of(spark, A.derived_gender, BATCH, rows) == [
        "Female", "Male", "Male", "Female", "Male",
    ]
    assert attributes_of(spark, A.derived_gender, APP, rows) == [
        "Female", "Female", "Male", "Female", "Male",
    ]
    df = spark.createDataFrame(rows, "b int, source string")
    app = df.select(A.product_category(F.col("source"), None, APP))
    assert [r[0] for r in app.collect()] == ["Apparel"] * 2 + ["General Electronics"] * 3
    given = spark.createDataFrame([("Tops",), ("",), (None,)], "c string")
    batch = given.select(A.product_category(None, F.col("c"), BATCH))
    assert [r[0] for r in batch.collect()] == ["Tops"] + ["General Electronics"] * 2
