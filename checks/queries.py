"""The registered queries, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks import oracle as O
from reviewmart.functions.hashing import md5_fold
from reviewmart.functions.links import source_tag
from reviewmart.functions.rules import issue_reason, recommend
from reviewmart.functions.text import contains_any, strip, to_int
from reviewmart.operators import normalize as N
from reviewmart.operators import quality as Q
from reviewmart.operators import resolve as R
from reviewmart.operators import sentiment as S
from reviewmart.operators.enrich import loadable, with_attributes
from reviewmart.operators.keys import assign_keys, in_order
from reviewmart.operators.members import distinct_members, first_wins, new_members
from reviewmart.plans import admin, ingest
from reviewmart.plans import dashboard as D
from reviewmart.plans.load import member_candidates
from reviewmart.profiles import APP, BATCH
from reviewmart.session import staging_path
from reviewmart.sources import csv_files
from reviewmart.sources.pages import extract_page_reviews
from reviewmart.sources.warehouse import COLUMNS, DIMENSIONS, Star, commit, read_newest, read_star, write_part

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULI = (2, 3, 5, 6, 7, 45, 50, 1000)


def register(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


# --- sources ---------------------------------------------------------------------------


@register(_with(O.INPUTS, "SELECT * FROM u"))
def scan_csv(spark, sf_dir):
    """Both review files written as CSV, scanned back and united."""
    product, clothing = staging_path(spark, "csv"), staging_path(spark, "csv")
    csv_files.write_reviews_csv(I.product_reviews(spark, sf_dir), product)
    csv_files.write_reviews_csv(I.clothing_reviews(spark, sf_dir), clothing)
    return N.union_sources(
        N.normalize_src1(
            csv_files.read_reviews_csv(spark, product, "row_id long, review string")
        ),
        N.normalize_src2(
            csv_files.read_reviews_csv(
                spark,
                clothing,
                "row_id long, `Review Text` string, Age string, `Department Name` string",
            )
        ),
    )


@register(
    _with(
        O.INPUTS,
        """(SELECT * FROM src1 ORDER BY row_id LIMIT 250)
        UNION ALL (SELECT * FROM src2 ORDER BY row_id LIMIT 250)""",
    )
)
def source_cap(spark, sf_dir):
    """The first 250 rows of each source: the row cap as a report."""
    return N.union_sources(
        N.cap(N.normalize_src1(I.product_reviews(spark, sf_dir)), 250, ["row_id"]),
        N.cap(N.normalize_src2(I.clothing_reviews(spark, sf_dir)), 250, ["row_id"]),
    )


@register(
    "SELECT doc_id, text AS content, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang FROM documents"
)
def scan_dataset_dir(spark, sf_dir):
    """All documents as a folder of CSV files with differing columns, scanned back whole."""
    path = staging_path(spark, "dataset")
    documents = I.table(spark, sf_dir, "documents").withColumn("content", F.col("text"))
    for k, columns in enumerate((["doc_id", "content"], ["content", "doc_id", "lang"], ["lang", "content", "doc_id"])):
        csv_files.write_reviews_csv(documents.where(F.col("doc_id") % 3 == k).select(*columns), f"{path}/{k}")
    return csv_files.read_dataset_dir(
        spark, f"{path}/*", "all", "doc_id long, content string, lang string"
    )


@register(
    _with(
        O.app_star(
            f"SELECT 1 AS load_nr, doc_id AS k1, 0::BIGINT AS k2, text AS review_text, "
            f"'Local CSV (docs.csv)' AS source, {O.LOAD} AS load_ts FROM documents"
        ),
        "SELECT review_text, sentiment_label, issue_reason, source_link, count(*) AS rows "
        "FROM fact_reviews GROUP BY ALL",
    )
)
def csv_upload(spark, sf_dir):
    """Every document as one uploaded CSV: column found, enriched and loaded."""
    path = staging_path(spark, "csv")
    documents = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("Comment text"))
    csv_files.write_reviews_csv(documents, path)
    star = ingest.ingest_csv(
        spark, path, "docs.csv", I.test_model(spark), staging_path(spark, "star"), I.LOAD_TS
    ).star
    columns = ["review_text", "sentiment_label", "issue_reason", "source_link"]
    return star.fact_reviews.groupBy(*columns).agg(F.count("*").alias("rows"))


@register(
    """SELECT 'documents' AS upload, text AS review_text FROM documents
    UNION ALL SELECT 'conversations', text FROM conversations
    UNION ALL SELECT 'pages', url FROM pages
    UNION ALL SELECT 'lineitem', l_returnflag FROM lineitem"""
)
def detect_text_column(spark, sf_dir):
    """The text column found in four differently shaped uploads."""
    return N.union_sources(
        *[
            csv_files.select_text(I.table(spark, sf_dir, name)).select(
                F.lit(name).alias("upload"), "review_text"
            )
            for name in ("documents", "conversations", "pages", "lineitem")
        ]
    )


@register(_with(O.PAGES, "SELECT * FROM page_reviews"))
def page_reviews(spark, sf_dir):
    """Every review text of every page."""
    return extract_page_reviews(I.table(spark, sf_dir, "pages"))


@register(_with(O.PAGES, "SELECT * FROM page_reviews WHERE pos < 50"))
def page_reviews_top50(spark, sf_dir):
    """The first 50 review texts of every page."""
    return extract_page_reviews(I.table(spark, sf_dir, "pages"), 50)


@register(
    r"""SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY nr) - 1 AS INTEGER) AS pos, review_text
    FROM (SELECT p.page_id, url, turn AS nr,
        regexp_replace("text", '^[\s\x0b\x{A0}]+|[\s\x0b\x{A0}]+$', '', 'g') AS review_text
      FROM pages p JOIN conversations c ON c.conv_id = p.page_id)
    WHERE review_text <> ''"""
)
def page_spans(spark, sf_dir):
    """Pages that show conversations as review spans, between their own paragraphs."""
    text = F.col("text")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    span = F.concat(F.lit('<span class="x" data-hook="review-body"><span>'), text, F.lit("</span></span>"))
    spans = I.table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("page_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", span.alias("span")))), lambda s: s["span"]), "<p>no review of this page, however long it is</p>").alias("spans")
    )
    pages = I.table(spark, sf_dir, "pages").join(spans, "page_id")
    return extract_page_reviews(pages.withColumn("html", F.concat("html", "spans")))


@register(
    _with(O.app_star(O.MANUAL_ROWS), f"SELECT {O.FACT_COLUMNS} FROM fact_reviews")
)
def append_manual(spark, sf_dir):
    """User turns validated, enriched and loaded as manual entries."""
    return I.load_manual(spark, sf_dir, staging_path(spark, "star")).fact_reviews


# --- projections and filters -----------------------------------------------------------


@register(_with(O.INPUTS, "SELECT * FROM src1"))
def normalize_src1(spark, sf_dir):
    return N.normalize_src1(I.product_reviews(spark, sf_dir))


@register(_with(O.INPUTS, "SELECT * FROM src2"))
def normalize_src2(spark, sf_dir):
    return N.normalize_src2(I.clothing_reviews(spark, sf_dir))


@register(_with(O.INPUTS, "SELECT * FROM u"))
def union_sources(spark, sf_dir):
    return I.reviews(spark, sf_dir)


@register(_with(O.INPUTS, "SELECT * FROM u WHERE review_text IS NOT NULL"))
def filter_not_null(spark, sf_dir):
    return N.drop_null_text(I.reviews(spark, sf_dir))


@register(
    _with(
        O.INPUTS,
        f"SELECT * FROM u WHERE review_text IS NOT NULL "
        f"AND NOT regexp_matches(review_text, {O.BLANK})",
    )
)
def filter_blank(spark, sf_dir):
    return N.drop_blank_text(I.reviews(spark, sf_dir))


_ENRICHED = (
    "source_ord, row_id, review_text, sentiment_label, issue_reason, ai_recommendation"
)


@register(_with(O.BATCH_LOADED, f"SELECT {_ENRICHED} FROM enriched"))
def enrich_reviews(spark, sf_dir):
    """Batch profile: sentiment, reason and advice."""
    return I.enriched(spark, sf_dir).select(*_ENRICHED.split(", "))


@register(
    _with(
        f"{O.INPUTS}, {O.enriched('u', O.BATCH_KEYS, APP)}", f"SELECT {_ENRICHED} FROM enriched"
    )
)
def enrich_reviews_app(spark, sf_dir):
    """App profile, null and blank texts included."""
    return I.enriched(spark, sf_dir, APP).select(*_ENRICHED.split(", "))


def _loaded(spark, sf_dir, rows=None) -> DataFrame:
    """Loadable batch rows with attributes, before any scoring."""
    rows = I.reviews(spark, sf_dir) if rows is None else rows
    return with_attributes(loadable(rows, BATCH), BATCH)


_ATTRIBUTED = f"""{O.INPUTS},
loaded AS (SELECT * FROM u WHERE review_text IS NOT NULL
  AND NOT regexp_matches(review_text, {O.BLANK})),
{O.attributes("loaded", BATCH)}"""


@register(_with(_ATTRIBUTED, "SELECT source_ord, row_id, age, category FROM attributed"))
def fill_defaults(spark, sf_dir):
    return _loaded(spark, sf_dir).select("source_ord", "row_id", "age", "category")


@register(
    _with(
        O.INPUTS,
        """SELECT kind, link, count(*) AS rows FROM (
        SELECT 'merged' AS kind, 'Merged Pipeline (' || source || ')' AS link FROM u
        UNION ALL SELECT 'csv', 'Local CSV (' || source || ')' FROM documents
        UNION ALL SELECT 'dataset', 'https://www.kaggle.com/datasets/' || source FROM documents
        UNION ALL SELECT 'page', url FROM pages
        UNION ALL SELECT 'manual', 'Manual Entry' FROM conversations) GROUP BY kind, link""",
    )
)
def source_link(spark, sf_dir):
    """Source tags of all five ingestion paths, counted."""
    documents = I.table(spark, sf_dir, "documents")
    inputs = {
        "merged": (I.reviews(spark, sf_dir), F.col("source")),
        "csv": (documents, F.col("source")),
        "dataset": (documents, F.col("source")),
        "page": (I.table(spark, sf_dir, "pages"), F.col("url")),
        "manual": (I.table(spark, sf_dir, "conversations"), None),
    }
    links = [
        df.select(F.lit(kind).alias("kind"), source_tag(kind, detail).alias("link"))
        for kind, (df, detail) in inputs.items()
    ]
    return N.union_sources(*links).groupBy("kind", "link").agg(F.count("*").alias("rows"))


_PADDED = "chr(9) || ' ' || review_text || chr(160) || chr(10)"


@register(
    _with(
        O.INPUTS,
        rf"""SELECT source_ord, row_id, lower(review_text) AS lowered,
        regexp_replace({_PADDED}, '^[\s\x0b\x{{A0}}]+|[\s\x0b\x{{A0}}]+$', '', 'g') AS stripped,
        CAST(length(review_text) AS INTEGER) AS chars, starts_with(review_text, 'Nice') AS is_nice,
        contains(review_text, 'app') AS has_app,
        regexp_matches(lower(review_text), 'charger|app|best') AS has_any,
        try_cast(trunc(try_cast(substr(review_text, length(review_text), 1) || '.75' AS DOUBLE))
          AS INTEGER) AS last_digit
        FROM u""",
    )
)
def text_functions(spark, sf_dir):
    """Lower-case, strip, length, prefix, substring, keyword and cast functions."""
    text = F.col("review_text")
    padded = F.concat(F.lit("\t "), text, F.lit(" \n"))
    return I.reviews(spark, sf_dir).select(
        "source_ord",
        "row_id",
        F.lower(text).alias("lowered"),
        strip(padded).alias("stripped"),
        F.length(text).alias("chars"),
        text.startswith("Nice").alias("is_nice"),
        text.contains("app").alias("has_app"),
        contains_any(F.lower(text), ("charger", "app", "best")).alias("has_any"),
        to_int(F.concat(F.right(text, F.lit(1)), F.lit(".75"))).alias("last_digit"),
    )


# --- scalar functions and the model ----------------------------------------------------


@register(
    _with(
        O.INPUTS,
        "SELECT source_ord, row_id, "
        + ", ".join(f"CAST({O.hash_sql('review_text')} % {m} AS BIGINT) AS mod_{m}" for m in MODULI)
        + " FROM u WHERE review_text IS NOT NULL UNION ALL SELECT 0, doc_id, "
        + ", ".join(f"CAST({O.hash_sql('text')} % {m} AS BIGINT)" for m in MODULI)
        + " FROM documents",
    )
)
def text_hash_mods(spark, sf_dir):
    """MD5 residues of every review and every document."""
    texts = I.reviews(spark, sf_dir).select("source_ord", "row_id", "review_text")
    documents = I.table(spark, sf_dir, "documents").select(
        F.lit(0).alias("source_ord"),
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("review_text"),
    )
    text = F.col("review_text")
    return N.drop_null_text(N.union_sources(texts, documents)).select(
        "source_ord", "row_id", *[md5_fold(text, m).alias(f"mod_{m}") for m in MODULI]
    )


@register(
    _with(_ATTRIBUTED, "SELECT source_ord, row_id, age, gender, customer_name FROM attributed")
)
def derived_customer(spark, sf_dir):
    return _loaded(spark, sf_dir).select("source_ord", "row_id", "age", "gender", "customer_name")


@register(
    _with(_ATTRIBUTED, "SELECT source_ord, row_id, brand, product_name, category FROM attributed")
)
def derived_product(spark, sf_dir):
    return _loaded(spark, sf_dir).select(
        "source_ord", "row_id", "brand", "product_name", "category"
    )


@register(_with(_ATTRIBUTED, "SELECT source_ord, row_id, country, city FROM attributed"))
def derived_location(spark, sf_dir):
    return _loaded(spark, sf_dir).select("source_ord", "row_id", "country", "city")


@register(
    _with(
        f"uploads AS ({O.UPLOADS}), {O.attributes('uploads', APP)}",
        "SELECT doc_id, age, gender, customer_name, brand, product_name, category, country, city "
        "FROM attributed",
    )
)
def derived_attributes_app(spark, sf_dir):
    """App profile attributes of every document."""
    rows = with_attributes(loadable(I.document_uploads(spark, sf_dir), APP), APP)
    return rows.select(
        *("doc_id", "age", "gender", "customer_name", "brand", "product_name"),
        *("category", "country", "city"),
    )


_MODEL = f"{O.INPUTS}, {O.scored('u', O.BATCH_KEYS)}"


@register(_with(_MODEL, "SELECT source_ord, row_id, round(score, 6) AS score FROM scored"))
def linear_sentiment(spark, sf_dir):
    """Linear TF-IDF scores, scored inside each row."""
    scores = S.linear_scores(I.reviews(spark, sf_dir), I.test_model(spark))
    return scores.select("source_ord", "row_id", F.round("score", 6).alias("score"))


@register(_with(_MODEL, "SELECT source_ord, row_id, round(score, 6) AS score FROM scored"))
def linear_sentiment_joined(spark, sf_dir):
    """The same scores by joining terms to the weight table, as for a huge vocabulary."""
    scores = S.linear_scores(
        I.reviews(spark, sf_dir), I.test_model(spark), max_local_terms=0
    )
    return scores.select("source_ord", "row_id", F.round("score", 6).alias("score"))


@register(
    _with(
        _MODEL,
        f"SELECT source_ord, row_id, {O.label_sql(BATCH)} AS batch_label, "
        f"{O.label_sql(APP)} AS app_label FROM scored",
    )
)
def sentiment_labels(spark, sf_dir):
    """Label decoding under both profiles, missing texts included."""
    scores = S.linear_scores(I.reviews(spark, sf_dir), I.test_model(spark))
    one = F.when(F.col("score") > 0, 1).otherwise(0)
    text = F.col("review_text")
    return scores.select(
        "source_ord",
        "row_id",
        S.decode_label(one, text, BATCH).alias("batch_label"),
        S.decode_label(one, text, APP).alias("app_label"),
    )


_CLASSES = ("Negative", "Positive")


@register(
    _with(
        f"{O.INPUTS}, classes AS (SELECT *, unnest({list(_CLASSES)}) AS sentiment FROM u)",
        f"SELECT source_ord, row_id, sentiment, "
        f"{O.reason_sql('review_text', 'sentiment', BATCH)} AS batch_reason, "
        f"{O.reason_sql('review_text', 'sentiment', APP)} AS app_reason FROM classes",
    ),
    name="issue_reason",
)
def issue_reasons(spark, sf_dir):
    """Reasons of every text under either sentiment and profile, nulls included."""
    rows = I.reviews(spark, sf_dir).select(
        "source_ord",
        "row_id",
        F.explode(F.array(*[F.lit(c) for c in _CLASSES])).alias("sentiment"),
        F.lower("review_text").alias("lowered"),
    )
    lowered, sentiment = F.col("lowered"), F.col("sentiment")
    return rows.select(
        "source_ord",
        "row_id",
        "sentiment",
        issue_reason(lowered, sentiment, BATCH).alias("batch_reason"),
        issue_reason(lowered, sentiment, APP).alias("app_reason"),
    )


@register(
    _with(
        f"{O.INPUTS}, both_ways AS (SELECT review_text, unnest(['Negative', 'Positive']) AS sentiment "
        f"FROM u), reasons AS (SELECT sentiment, {O.reason_sql('review_text', 'sentiment', BATCH)} "
        "AS reason FROM both_ways)",
        f"SELECT sentiment, reason, {O.advice_sql('reason', BATCH)} AS batch_advice, "
        f"{O.advice_sql('reason', APP)} AS app_advice, count(*) AS rows FROM reasons GROUP BY ALL",
    )
)
def recommendations(spark, sf_dir):
    """Advice of both profiles for every reason of every review, were it negative or positive."""
    rows = I.reviews(spark, sf_dir).select(
        F.lower("review_text").alias("lowered"),
        F.explode(F.array(F.lit("Negative"), F.lit("Positive"))).alias("sentiment"),
    )
    reasons = rows.select(
        "sentiment", issue_reason(F.col("lowered"), F.col("sentiment"), BATCH).alias("reason")
    )
    counted = reasons.groupBy("sentiment", "reason").agg(F.count("*").alias("rows"))
    reason = F.col("reason")
    return counted.select(
        "sentiment",
        "reason",
        recommend(reason, BATCH).alias("batch_advice"),
        recommend(reason, APP).alias("app_advice"),
        "rows",
    )


@register(
    """WITH tf AS (
      SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[0-9a-z_]{2,}')) AS term
        FROM documents) GROUP BY ALL),
    idf AS (
      SELECT term, ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1.0)
        / (count(*) + 1.0)) AS idf FROM tf GROUP BY term),
    raw AS (SELECT doc_id, term, tf, tf * idf AS raw FROM tf JOIN idf USING (term)),
    len AS (SELECT doc_id, sqrt(sum(raw * raw)) AS len FROM raw GROUP BY doc_id)
    SELECT doc_id, term, tf, round(CASE WHEN len > 0 THEN raw / len ELSE 0 END, 6) AS tfidf
    FROM raw JOIN len USING (doc_id)"""
)
def tfidf_terms(spark, sf_dir):
    """Unit-length TF-IDF of every term of every document."""
    terms = S.tfidf(I.table(spark, sf_dir, "documents"), "doc_id")
    return terms.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def _labelled(spark, sf_dir) -> DataFrame:
    documents = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("_text"))
    labels = I.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents.join(labels, "doc_id")


@register()
def ml_sentiment(spark, sf_dir):
    """A pipeline fitted on labelled documents, applied to all documents."""
    model = S.fit_sentiment(_labelled(spark, sf_dir), "doc_id")
    texts = I.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("review_text")
    )
    return S.predict_sentiment(texts, model, BATCH).select("doc_id", "sentiment_label")


@register()
def ml_fit_metrics(spark, sf_dir):
    """Rows and area under the ROC curve of a fit, on a held-out fifth of the labels."""
    rows = _labelled(spark, sf_dir)
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = S.fit_sentiment(rows.filter(~held_out), "doc_id")
    scored = model.transform(rows.filter(held_out)).select("label", "_margin")
    auc = BinaryClassificationEvaluator(rawPredictionCol="_margin").evaluate(scored)
    return rows.agg(
        F.count_if(~held_out).alias("train_rows"),
        F.count_if(held_out).alias("test_rows"),
        F.lit(round(auc, 6)).alias("auc"),
    )


@register(
    """
    SELECT count(*) FILTER (d.doc_id % 5 <> 0)::BIGINT AS train_rows,
           count(*) FILTER (d.doc_id % 5 = 0)::BIGINT AS test_rows,
           count(*) FILTER (d.doc_id % 5 = 0 AND l.quality = 1)::BIGINT AS test_positive,
           TRUE AS separates
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    """
)
def ml_fit_held_out(spark, sf_dir):
    """A fit on four fifths of the labels ranks the last fifth: its ROC area exceeds 0.7."""
    rows = _labelled(spark, sf_dir)
    held_out = F.col("doc_id") % 5 == 0
    model = S.fit_sentiment(rows.filter(~held_out), "doc_id")
    scored = model.transform(rows.filter(held_out)).select("label", "_margin")
    auc = BinaryClassificationEvaluator(rawPredictionCol="_margin").evaluate(scored)
    return rows.agg(
        F.count_if(~held_out).alias("train_rows"),
        F.count_if(held_out).alias("test_rows"),
        F.count_if(held_out & (F.col("label") == 1)).alias("test_positive"),
        F.lit(auc > 0.7).alias("separates"),
    )


# --- members, keys and lookups ---------------------------------------------------------


@register(
    _with(
        f"{_ATTRIBUTED}, "
        + O.dimension(
            "attributed", "dim", "customer_id", "customer_name", "age, gender", O.BATCH_KEYS
        ),
        "SELECT customer_name, age, gender FROM dim",
    )
)
def dim_customer_first(spark, sf_dir):
    """Customers with the age and gender of their earliest review."""
    members = first_wins(_loaded(spark, sf_dir), ["customer_name"], ["age", "gender"], I.KEYS)
    return members.select("customer_name", "age", "gender")


@register(_with(_ATTRIBUTED, "SELECT DISTINCT product_name, category FROM attributed"))
def dim_product_distinct(spark, sf_dir):
    return distinct_members(_loaded(spark, sf_dir), ["product_name", "category"])


@register(_with(_ATTRIBUTED, "SELECT DISTINCT country, city FROM attributed"))
def dim_location_distinct(spark, sf_dir):
    return distinct_members(_loaded(spark, sf_dir), ["country", "city"])


@register(
    _with(
        O.INPUTS,
        """SELECT source_ord, row_id, 1000 + row_number() OVER (ORDER BY source_ord, row_id)
        AS review_id FROM u WHERE review_text IS NOT NULL""",
    ),
    name="assign_keys",
)
def assign_keys_dense(spark, sf_dir):
    """Gapless keys over all reviews by the distributed path, continuing from 1000."""
    rows = N.drop_null_text(I.reviews(spark, sf_dir)).select("source_ord", "row_id")
    return assign_keys(rows, I.KEYS, "review_id", start=1000, single_task_rows=0)


def _resolved(select: str) -> str:
    return _with(f"{_ATTRIBUTED}, {O.BATCH_DIMS}", select)


@register(
    _resolved(
        "SELECT source_ord, row_id, product_id FROM attributed "
        "JOIN dim_product USING (product_name, category)"
    )
)
def resolve_product(spark, sf_dir):
    dim = I.stored_star(spark, sf_dir).dim_product
    rows = R.resolve_product(_loaded(spark, sf_dir), dim, BATCH)
    return rows.select("source_ord", "row_id", "product_id")


@register(
    _with(
        f"{_ATTRIBUTED}, {O.BATCH_DIMS}, uploads AS ({O.UPLOADS}), "
        f"{O.attributes('uploads', APP, 'up')}",
        "SELECT doc_id, p.product_id FROM up JOIN (SELECT product_name, "
        "min(product_id) AS product_id FROM dim_product GROUP BY product_name) p "
        "USING (product_name)",
    )
)
def resolve_product_app(spark, sf_dir):
    """By name alone against a dimension that holds several categories per name."""
    dim = I.stored_star(spark, sf_dir).dim_product
    rows = with_attributes(I.document_uploads(spark, sf_dir), APP)
    return R.resolve_product(rows, dim, APP).select("doc_id", "product_id")


@register(
    _resolved(
        "SELECT source_ord, row_id, customer_id FROM attributed "
        "JOIN dim_customer USING (customer_name)"
    )
)
def resolve_customer(spark, sf_dir):
    dim = I.stored_star(spark, sf_dir).dim_customer
    rows = R.resolve_customer(_loaded(spark, sf_dir), dim)
    return rows.select("source_ord", "row_id", "customer_id")


@register(
    _resolved(
        "SELECT source_ord, row_id, location_id FROM attributed "
        "JOIN dim_location USING (country, city)"
    )
)
def resolve_location(spark, sf_dir):
    dim = I.stored_star(spark, sf_dir).dim_location
    rows = R.resolve_location(_loaded(spark, sf_dir), dim)
    return rows.select("source_ord", "row_id", "location_id")


@register(
    _with(
        O.INPUTS,
        "SELECT source_ord, row_id, CAST(1 AS BIGINT) AS date_id FROM u "
        "WHERE review_text IS NOT NULL",
    )
)
def resolve_date(spark, sf_dir):
    dim = I.stored_star(spark, sf_dir).dim_date
    rows = R.resolve_date(N.drop_null_text(I.reviews(spark, sf_dir)), dim, I.LOAD_TS)
    return rows.select("source_ord", "row_id", "date_id")


@register(
    _with(
        f"{_ATTRIBUTED}, {O.BATCH_DIMS}, uploads AS ({O.UPLOADS}), "
        f"{O.attributes('uploads', APP, 'up')}",
        """SELECT 'dim_product' AS dimension, product_name AS member FROM (
          SELECT DISTINCT product_name FROM up ANTI JOIN dim_product USING (product_name))
        UNION ALL SELECT 'dim_customer', customer_name FROM (
          SELECT DISTINCT customer_name FROM up ANTI JOIN dim_customer USING (customer_name))
        UNION ALL SELECT 'dim_location', country || ', ' || city FROM (
          SELECT DISTINCT country, city FROM up ANTI JOIN dim_location USING (country, city))""",
    )
)
def new_dim_members(spark, sf_dir):
    """Members among uploaded documents that the batch warehouse lacks."""
    star = I.stored_star(spark, sf_dir)
    rows = with_attributes(I.document_uploads(spark, sf_dir), APP)
    found = []
    for name, (_, keys, members) in member_candidates(rows, APP, ["doc_id"]).items():
        fresh = new_members(members, getattr(star, name), keys)
        found.append(
            fresh.select(F.lit(name).alias("dimension"), F.concat_ws(", ", *keys).alias("member"))
        )
    return N.union_sources(*found)


# --- load and stored tables ------------------------------------------------------------

_NAMED = (
    "review_id, product_name, category, customer_name, gender, age, country, city, "
    "review_year, review_month, review_day, review_text, sentiment_label, issue_reason, "
    "ai_recommendation, source_link, load_timestamp"
)


def _named(star: Star) -> DataFrame:
    rows = star.fact_reviews
    for key, name in (
        ("product_id", "dim_product"),
        ("customer_id", "dim_customer"),
        ("location_id", "dim_location"),
        ("date_id", "dim_date"),
    ):
        rows = rows.join(getattr(star, name), key)
    return rows.select(*_NAMED.split(", "))


_NAMED_SQL = f"""SELECT {_NAMED} FROM fact_reviews JOIN dim_product USING (product_id)
JOIN dim_customer USING (customer_id) JOIN dim_location USING (location_id)
JOIN dim_date USING (date_id)"""

_APP_DATES = f"""dim_date AS (
  SELECT 1::BIGINT AS date_id, 2024 AS review_year, 3 AS review_month, 15 AS review_day
  UNION ALL SELECT 2, 2024, 3, 16)"""


@register(_with(O.BATCH_STAR, _NAMED_SQL))
def star_load(spark, sf_dir):
    """A whole batch load into an empty warehouse, read back with its dimensions."""
    return _named(I.load_batch(spark, sf_dir))


@register(_with(f"{O.APP_STAR}, {_APP_DATES}", _NAMED_SQL))
def star_load_app(spark, sf_dir):
    """Three app loads one after another: pages, manual entries, uploads."""
    return _named(I.load_app(spark, sf_dir))


def _run_batch(spark, sf_dir):
    """The whole batch run from two CSV files in file order."""
    product, clothing = staging_path(spark, "csv"), staging_path(spark, "csv")
    for rows, path in (
        (I.product_reviews(spark, sf_dir), product),
        (I.clothing_reviews(spark, sf_dir), clothing),
    ):
        csv_files.write_reviews_csv(in_order(rows, ["row_id"]).withColumnRenamed("row_id", "number"), path)
    return ingest.run_batch(
        spark, product, clothing, I.test_model(spark), staging_path(spark, "star"), I.LOAD_TS
    )


@register(_with(O.BATCH_STAR, _NAMED_SQL))
def batch_pipeline(spark, sf_dir):
    """Every stored column and id of a batch run from CSV files."""
    return _named(_run_batch(spark, sf_dir).star)


@register(
    _with(
        O.INPUTS,
        f"""SELECT source, count(*) AS rows_read,
        count(*) FILTER (review_text IS NULL) AS rows_missing,
        count(*) FILTER (regexp_matches(review_text, {O.BLANK})) AS rows_blank,
        count(*) FILTER (NOT regexp_matches(review_text, {O.BLANK})) AS rows_loaded
        FROM (SELECT source, review_text FROM u
          UNION ALL SELECT 'Manual Entry', text FROM conversations WHERE role = 'user')
        GROUP BY source""",
    )
)
def load_totals(spark, sf_dir):
    """Rows read, refused and loaded of each source, counted while a batch and an app load ran."""
    batch = _run_batch(spark, sf_dir)
    rows = in_order(I.manual_reviews(spark, sf_dir), ["conv_id", "turn"])
    manual = ingest.append_reviews(rows, I.test_model(spark), staging_path(spark, "star"), I.LOAD_TS)
    found = [(t.source, t.read, t.missing, t.blank, t.loaded) for t in (*batch.totals, *manual.totals)]
    schema = "source string, rows_read long, rows_missing long, rows_blank long, rows_loaded long"
    return spark.createDataFrame(found, schema)


_UPLOADED = "review_text, sentiment_label, issue_reason, ai_recommendation, source_link"


@register(
    _with(
        O.app_star(
            f"SELECT 1 AS load_nr, doc_id AS k1, 0::BIGINT AS k2, text AS review_text, "
            f"'https://www.kaggle.com/datasets/a/b' AS source, {O.LOAD} AS load_ts FROM documents"
        ),
        f"SELECT {_UPLOADED}, count(*) AS rows FROM fact_reviews GROUP BY ALL",
    )
)
def dataset_upload(spark, sf_dir):
    """Every document as a dataset folder: scanned, detected, enriched and loaded."""
    path = staging_path(spark, "dataset")
    csv_files.write_reviews_csv(I.table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    star = ingest.ingest_dataset(
        spark, path, "a/b", I.test_model(spark), staging_path(spark, "star"), I.LOAD_TS, "all"
    ).star
    columns = _UPLOADED.split(", ")
    return star.fact_reviews.groupBy(*columns).agg(F.count("*").alias("rows"))


@register(_with(O.BATCH_STAR, f"SELECT {O.FACT_COLUMNS} FROM fact_reviews"))
def fact_reviews(spark, sf_dir):
    return I.stored_star(spark, sf_dir).fact_reviews


@register(_with(O.APP_STAR, f"SELECT {O.FACT_COLUMNS} FROM fact_reviews"))
def fact_reviews_app(spark, sf_dir):
    return I.stored_star(spark, sf_dir, "app").fact_reviews


def _dimension(name: str) -> None:
    columns = ", ".join(COLUMNS[name])

    def query(spark, sf_dir):
        return getattr(I.stored_star(spark, sf_dir), name)

    register(_with(O.BATCH_STAR, f"SELECT {columns} FROM {name}"), name)(query)


for _name in DIMENSIONS:
    _dimension(_name)


def _copied(spark, sf_dir) -> str:
    """A copy of the stored warehouse that a query may change, its fact in parts of some reviews."""
    path = staging_path(spark, "star")
    # Writing parts sorts a task's whole rows; small splits, set in a session of their own, fit in memory.
    narrow = spark.newSession()
    narrow.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    star = read_star(narrow, I.stored_path(spark, sf_dir))
    for table in DIMENSIONS:
        write_part(getattr(star, table), path, table, 1)
    parts = star.fact_reviews.withColumn("load_id", F.expr("1 + (review_id - 1) div 25000"))
    parts.write.partitionBy("load_id").parquet(f"{path}/fact_reviews")
    last, rows = star.fact_reviews.agg(F.max("review_id"), F.count("*")).first()
    commit(spark, path, 1 + (last - 1) // 25_000, "load", I.LOAD_TS, rows, last)
    return path


@register(
    _with(
        O.BATCH_STAR,
        "SELECT review_id, customer_id, sentiment_label FROM fact_reviews "
        "WHERE review_id NOT IN (SELECT conv_id FROM conversations)",
    )
)
def delete_review(spark, sf_dir):
    """What is left after deleting the reviews whose ids are conversation ids."""
    path = _copied(spark, sf_dir)
    ids = I.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("review_id"))
    admin.delete_review(spark, path, ids, I.SECOND_TS)
    return read_star(spark, path).fact_reviews.select(
        "review_id", "customer_id", "sentiment_label"
    )


@register(
    _with(
        O.BATCH_STAR,
        f"""SELECT (SELECT count(*) FROM fact_reviews) + row_number() OVER (ORDER BY conv_id, turn)
        AS review_id, text AS review_text FROM conversations
        WHERE role = 'user' AND NOT regexp_matches(text, {O.BLANK})""",
    )
)
def delete_all_reviews(spark, sf_dir):
    """Manual entries loaded after clearing the fact: ids go on, dimensions are kept."""
    path = _copied(spark, sf_dir)
    admin.delete_all_reviews(spark, path, I.SECOND_TS)
    star = I.load_manual(spark, sf_dir, path, I.SECOND_TS)
    return star.fact_reviews.select("review_id", "review_text")


# --- integrity -------------------------------------------------------------------------


@register(
    _with(
        f"{O.BATCH_STAR}, customers AS (SELECT * FROM dim_customer WHERE age <= 100), "
        "products AS (SELECT * FROM dim_product WHERE brand <> 'Sony')",
        " UNION ALL ".join(
            f"SELECT '{key}' AS foreign_key, count(DISTINCT {key}) AS orphan_keys, "
            f"count(*) AS orphan_reviews FROM fact_reviews WHERE {key} NOT IN "
            f"(SELECT {key} FROM {dim})"
            for key, dim in (
                ("product_id", "products"),
                ("customer_id", "customers"),
                ("date_id", "dim_date"),
                ("location_id", "dim_location"),
            )
        ),
    )
)
def fk_orphans(spark, sf_dir):
    """Orphans of a warehouse that lost its oldest customers and one brand."""
    star = I.stored_star(spark, sf_dir)
    damaged = Star(
        star.dim_date,
        star.dim_product.filter(F.col("brand") != "Sony"),
        star.dim_customer.filter(F.col("age") <= 100),
        star.dim_location,
        star.fact_reviews,
    )
    return Q.fk_orphans(damaged)


@register(
    _with(
        O.APP_STAR,
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
            f"CAST(count(*) FILTER (length({c}) > {n}) AS BIGINT) AS violations FROM {name}"
            for name, widths in Q.WIDTHS.items()
            for c, n in widths.items()
        ),
    )
)
def width_violations(spark, sf_dir):
    return Q.width_violations(I.stored_star(spark, sf_dir, "app"))


_BOTH_KEYS = (
    ("dim_date", "date_id"),
    ("dim_date", "review_year, review_month, review_day"),
    ("dim_product", "product_id"),
    ("dim_product", "product_name, category"),
    ("dim_customer", "customer_id"),
    ("dim_customer", "customer_name"),
    ("dim_location", "location_id"),
    ("dim_location", "country, city"),
    ("fact_reviews", "review_id"),
)


@register(
    _with(
        O.BATCH_STAR,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{k}' AS key, count(*) AS duplicates FROM "
            f"(SELECT {k} FROM (SELECT * FROM {t} UNION ALL SELECT * FROM {t}) "
            "GROUP BY ALL HAVING count(*) > 1)"
            for t, k in _BOTH_KEYS
        ),
    )
)
def key_duplicates(spark, sf_dir):
    """Keys that repeat when every table is appended twice."""
    star = I.stored_star(spark, sf_dir)
    twice = {t: getattr(star, t).unionAll(getattr(star, t)) for t in star.__dataclass_fields__}
    return Q.key_duplicates(Star(**twice))


@register(
    _with(
        O.INPUTS,
        f"""SELECT source, count(*) AS rows_read,
        count(*) FILTER (NOT regexp_matches(review_text, {O.BLANK})) AS rows_loaded,
        count(*) FILTER (NOT regexp_matches(review_text, {O.BLANK})) = 0 AS is_empty
        FROM u GROUP BY source""",
    )
)
def load_summary(spark, sf_dir):
    rows = I.reviews(spark, sf_dir)
    return Q.load_summary(rows, N.drop_blank_text(rows))


# --- dashboard -------------------------------------------------------------------------

_STATS = f"{O.BATCH_STAR}, {O.STATS}"


@register(_with(_STATS, "SELECT * FROM stats"))
def star_stats(spark, sf_dir):
    return D.star_stats(I.stored_star(spark, sf_dir))


@register(
    _with(
        _STATS,
        'SELECT "Sentiment", count(*) AS "Count" FROM stats WHERE "Sentiment" IS NOT NULL '
        'GROUP BY "Sentiment"',
    )
)
def sentiment_counts(spark, sf_dir):
    return D.sentiment_counts(I.stored_star(spark, sf_dir))


def _counted(column: str) -> str:
    return _with(
        _STATS, f'SELECT "{column}", "Sentiment", count(*) AS "Count" FROM stats GROUP BY ALL'
    )


@register(_counted("Gender"))
def gender_sentiment(spark, sf_dir):
    return D.gender_sentiment(I.stored_star(spark, sf_dir))


@register(_counted("Category"))
def category_sentiment(spark, sf_dir):
    return D.category_sentiment(I.stored_star(spark, sf_dir))


@register(_counted("Reason"))
def reason_sentiment(spark, sf_dir):
    return D.reason_sentiment(I.stored_star(spark, sf_dir))


@register(
    _with(
        _STATS,
        """SELECT CASE WHEN "Age" <= 0 THEN NULL WHEN "Age" <= 25 THEN '18-25'
        WHEN "Age" <= 35 THEN '26-35' WHEN "Age" <= 50 THEN '36-50'
        WHEN "Age" <= 100 THEN '50+' END AS "Age Group", count(*) AS "Count"
        FROM stats GROUP BY ALL""",
    )
)
def age_group_counts(spark, sf_dir):
    return D.age_group_counts(I.stored_star(spark, sf_dir))


@register(_with(f"{O.APP_STAR}, {O.RECORDS}", "SELECT * FROM records"))
def records_view(spark, sf_dir):
    """Every record of the app warehouse, with links and source types."""
    return D.records(I.stored_star(spark, sf_dir, "app"))


@register(_with(f"{O.BATCH_STAR}, {O.RECORDS}", 'SELECT * FROM records ORDER BY "ID" DESC LIMIT 100'))
def records_top100(spark, sf_dir):
    return D.newest_records(read_newest(spark, I.stored_path(spark, sf_dir), 100))


@register(_with(f"{O.APP_STAR}, {O.RECORDS}", 'SELECT * FROM records ORDER BY "ID" DESC LIMIT 100'))
def records_top100_app(spark, sf_dir):
    """The newest records of a warehouse of three loads; only the last ones are read."""
    return D.newest_records(read_newest(spark, I.stored_path(spark, sf_dir, "app"), 100))


@register(
    _with(
        O.APP_STAR,
        f'SELECT {O.SOURCE_TYPE} AS "Source Type", count(*) AS "Count" FROM fact_reviews '
        "GROUP BY ALL",
    )
)
def source_type_counts(spark, sf_dir):
    return D.source_type_counts(I.stored_star(spark, sf_dir, "app"))


@register(
    _with(
        O.BATCH_LOADED,
        """SELECT issue_reason AS reason, sentiment_label AS sentiment, count(*) AS reviews
        FROM loaded GROUP BY ALL""",
    )
)
def review_reasons(spark, sf_dir):
    """Reviews per reason and sentiment, straight from the sources."""
    rows = N.drop_blank_text(I.enriched(spark, sf_dir))
    return rows.groupBy(
        F.col("issue_reason").alias("reason"), F.col("sentiment_label").alias("sentiment")
    ).agg(F.count("*").alias("reviews"))
