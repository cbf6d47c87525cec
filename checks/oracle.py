"""SQL twins of the registered queries, written independently of the Spark code.

Every query is a chain of common table expressions over the given tables. The hash is a
plain 128-bit modulus and keywords are one pattern per rule, unlike on the Spark side.
"""

from __future__ import annotations

from checks.inputs import BIAS, PHRASES, WEIGHTS
from reviewmart.profiles import APP, BATCH, LOCATIONS, Profile

LOAD = "TIMESTAMP '2024-03-15 10:30:00'"
SECOND = "TIMESTAMP '2024-03-16 09:00:00'"
BLANK = r"'^[\s\x0b]*$'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_PH = ", ".join(f"({i}, {_text(p)})" for i, p in enumerate(PHRASES))
_W = ", ".join(f"({_text(t)}, {w}::DOUBLE, {i}::DOUBLE)" for t, w, i in WEIGHTS)

INPUTS = f"""
ph(k, phrase) AS (VALUES {_PH}),
w(term, weight, idf) AS (VALUES {_W}),
src1 AS (
  SELECT 1 AS source_ord, o_orderkey AS row_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '   '
         ELSE phrase || ' #' || CAST(o_custkey AS VARCHAR) END AS review_text,
    CAST(NULL AS INTEGER) AS input_age, 'General Electronics' AS input_category,
    'E-Commerce Dataset' AS source
  FROM orders JOIN ph ON o_orderkey % 14 = k),
src2 AS (
  SELECT 2 AS source_ord,
    ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber AS row_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE phrase || ' ' || p_name || ' #' || CAST(l_suppkey AS VARCHAR) END AS review_text,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(18 + l_suppkey % 86 AS INTEGER) END
      AS input_age,
    CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE p_type END AS input_category,
    'Womens Clothing Dataset' AS source
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN ph ON (l_orderkey + l_linenumber) % 14 = k),
u AS (SELECT * FROM src1 UNION ALL SELECT * FROM src2)
"""


def scored(rows: str, keys: str, name: str = "scored") -> str:
    """``name``: rows with their linear score."""
    return f"""
{name}_seen AS MATERIALIZED (
  SELECT *, CASE WHEN review_text IS NULL OR regexp_matches(review_text, {BLANK})
                 THEN 'No Review' ELSE review_text END AS seen FROM {rows}),
{name}_tf AS (
  SELECT {keys}, term, count(*) AS tf
  FROM (SELECT {keys}, unnest(regexp_extract_all(lower(seen), '[0-9a-z_]{{2,}}')) AS term
        FROM {name}_seen) GROUP BY ALL),
{name}_sum AS MATERIALIZED (
  SELECT {keys}, sum(tf * idf * weight) AS dot, sum((tf * idf) * (tf * idf)) AS square
  FROM {name}_tf JOIN w USING (term) GROUP BY {keys}),
{name} AS (
  SELECT s.* EXCLUDE (seen), {BIAS} + coalesce(dot / sqrt(square), 0) AS score
  FROM {name}_seen s LEFT JOIN {name}_sum USING ({keys}))
"""


def _rule_cases(lowered: str, rules, default: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({lowered}, '{'|'.join(words)}') THEN {_text(reason)}"
        for reason, words in rules
    )
    return f"CASE {cases} ELSE {_text(default)} END"


def reason_sql(text: str, sentiment: str, profile: Profile) -> str:
    lowered = f"lower({text})"
    return f"""CASE WHEN {text} IS NULL THEN 'No Review Provided'
      WHEN {sentiment} = 'Negative'
      THEN {_rule_cases(lowered, profile.negative_rules, profile.negative_default)}
      ELSE {_rule_cases(lowered, profile.other_rules, profile.other_default)} END"""


def advice_sql(reason: str, profile: Profile) -> str:
    cases = " ".join(f"WHEN {_text(r)} THEN {_text(a)}" for r, a in profile.advice)
    return f"CASE {reason} {cases} ELSE {_text(profile.default_advice)} END"


def label_sql(profile: Profile) -> str:
    label = "CASE WHEN score > 0 THEN 'Positive' ELSE 'Negative' END"
    if profile.is_batch:
        return label
    return (
        f"CASE WHEN review_text IS NULL OR regexp_matches(review_text, {BLANK}) "
        f"THEN 'Neutral' ELSE {label} END"
    )


def enriched(rows: str, keys: str, profile: Profile, name: str = "enriched") -> str:
    """``name``: rows with sentiment, reason and advice."""
    return f"""{scored(rows, keys, f"{name}_scored")},
{name}_labelled AS MATERIALIZED (SELECT *, {label_sql(profile)} AS sentiment_label FROM {name}_scored),
{name}_reasoned AS (
  SELECT *, {reason_sql("review_text", "sentiment_label", profile)} AS issue_reason
  FROM {name}_labelled),
{name} AS (
  SELECT * EXCLUDE (score), {advice_sql("issue_reason", profile)} AS ai_recommendation
  FROM {name}_reasoned)
"""


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def hash_sql(text: str) -> str:
    return f"('0x' || md5({text}))::UHUGEINT"


_COUNTRIES = _list(c for c, _ in LOCATIONS)
_CITIES = "[" + ", ".join(_list(cities) for _, cities in LOCATIONS) + "]"


def attributes(rows: str, profile: Profile, name: str = "attributed") -> str:
    """``name``: rows with customer, product and location attributes."""
    if profile.is_batch:
        female = "source = 'Womens Clothing Dataset'"
        age = "coalesce(input_age, CAST(20 + h % 45 AS INTEGER))"
        category = "coalesce(nullif(input_category, ''), 'General Electronics')"
    else:
        female = "contains(source, 'Womens')"
        age = "CAST(20 + h % 45 AS INTEGER)"
        category = f"CASE WHEN {female} THEN 'Apparel' ELSE 'General Electronics' END"
    return f"""
{name}_hash AS (SELECT *, {hash_sql("review_text")} AS h FROM {rows}),
{name}_base AS (
  SELECT *, {age} AS age,
    CASE WHEN {female} THEN 'Female' WHEN h % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    {category} AS category,
    ({_list(profile.brands)})[CAST(h % {len(profile.brands)} AS INTEGER) + 1] AS brand,
    ({_COUNTRIES})[CAST(h % 5 AS INTEGER) + 1] AS country,
    ({_CITIES})[CAST(h % 5 AS INTEGER) + 1][CAST(h % 3 AS INTEGER) + 1] AS city
  FROM {name}_hash),
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (h),
    'Customer_' || substr(gender, 1, 1) || '_' || CAST(h % 1000 AS VARCHAR) AS customer_name,
    'Product_' || brand || '_' || CAST(h % 50 AS VARCHAR) AS product_name
  FROM {name}_base)
"""


def dimension(rows: str, table: str, key: str, natural: str, attrs: str, order: str) -> str:
    """``table``: first-wins members numbered by first appearance."""
    columns = f"{natural}, {attrs}" if attrs else natural
    return f"""
{table} AS (
  SELECT row_number() OVER (ORDER BY {order}) AS {key}, {columns}
  FROM (SELECT *, row_number() OVER (PARTITION BY {natural} ORDER BY {order}) AS nth FROM {rows})
  WHERE nth = 1)
"""


BATCH_KEYS = "source_ord, row_id"

BATCH_LOADED = f"""{INPUTS},
present AS (SELECT * FROM u WHERE review_text IS NOT NULL),
{enriched("present", BATCH_KEYS, BATCH)},
loaded AS (SELECT * FROM enriched WHERE NOT regexp_matches(review_text, {BLANK})),
{attributes("loaded", BATCH)}
"""

BATCH_DIMS = f"""
{dimension("attributed", "dim_product", "product_id", "product_name, category", "brand", BATCH_KEYS)},
{dimension("attributed", "dim_customer", "customer_id", "customer_name", "age, gender", BATCH_KEYS)},
{dimension("attributed", "dim_location", "location_id", "country, city", "", BATCH_KEYS)},
dim_date AS (SELECT 1::BIGINT AS date_id, {LOAD} AS review_date, 2024 AS review_year,
  3 AS review_month, 15 AS review_day)
"""

BATCH_STAR = f"""{BATCH_LOADED}, {BATCH_DIMS},
fact_reviews AS (
  SELECT row_number() OVER (ORDER BY source_ord, row_id) AS review_id, product_id, customer_id,
    1::BIGINT AS date_id, location_id, review_text, sentiment_label, issue_reason,
    ai_recommendation, 'Merged Pipeline (' || source || ')' AS source_link,
    {LOAD} AS load_timestamp, source_ord, row_id
  FROM attributed a
  JOIN dim_product USING (product_name, category)
  JOIN dim_customer USING (customer_name)
  JOIN dim_location USING (country, city))
"""

FACT_COLUMNS = (
    "review_id, product_id, customer_id, date_id, location_id, review_text, sentiment_label, "
    "issue_reason, ai_recommendation, source_link, load_timestamp"
)

STATS = """
stats AS (
  SELECT sentiment_label AS "Sentiment", c.gender AS "Gender", c.age AS "Age",
    p.category AS "Category", issue_reason AS "Reason"
  FROM fact_reviews f JOIN dim_customer c USING (customer_id) JOIN dim_product p USING (product_id))
"""

SOURCE_TYPE = """CASE WHEN starts_with(source_link, 'http')
  THEN CASE WHEN contains(lower(source_link), 'kaggle') THEN 'Kaggle Dataset'
            ELSE 'Web Scraped' END
  WHEN contains(source_link, 'Manual') THEN 'Manual Entry' ELSE 'Local CSV' END"""

RECORDS = f"""
records AS (
  SELECT review_id AS "ID", c.gender AS "Gender", c.age AS "Age", review_text AS "Review",
    sentiment_label AS "Sentiment", issue_reason AS "Extracted Reason",
    ai_recommendation AS "AI Action", country AS "Country", {SOURCE_TYPE} AS "Source Type",
    CASE WHEN starts_with(source_link, 'http') THEN source_link END AS "Source Link"
  FROM fact_reviews f JOIN dim_customer c USING (customer_id)
  JOIN dim_location l USING (location_id))
"""


def _unescaped(text: str) -> str:
    for name, char in (
        ("&quot;", '"'),
        ("&copy;", "©"),
        ("&middot;", "·"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&nbsp;", "\u00a0"),
        ("&amp;", "&"),
    ):
        text = f"replace({text}, '{name}', '{char}')"
    return text


_EDGES = r"'^[\s\x0b\x{A0}]+|[\s\x0b\x{A0}]+$'"
_PLAIN = _unescaped("regexp_replace(regexp_replace(part, "
                    "'(?is)</(p|article|div|body)\\b.*', ''), '<[^>]*>', '', 'g')")

PAGES = f"""
page_clean AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html,
    '(?s)<!--.*?-->', '', 'g'), '(?is)<script.*?</script>', '', 'g'),
    '(?is)<style.*?</style>', '', 'g') AS html FROM pages),
page_parts AS (
  SELECT page_id, url, unnest(parts[2:]) AS part, unnest(range(1, len(parts))) AS nr
  FROM (SELECT page_id, url, regexp_split_to_array(html, '(?i)<p(\\s[^>]*)?>') AS parts
        FROM page_clean)),
page_texts AS (
  SELECT page_id, url, nr, regexp_replace(plain, {_EDGES}, '', 'g') AS review_text
  FROM (SELECT page_id, url, nr, {_PLAIN} AS plain FROM page_parts)
  WHERE length(plain) > 40),
page_reviews AS (
  SELECT page_id, url,
    CAST(row_number() OVER (PARTITION BY page_id ORDER BY nr) - 1 AS INTEGER) AS pos, review_text
  FROM page_texts WHERE review_text <> '')
"""


def app_star(rows: str) -> str:
    """The star of app loads; ``load_nr, k1, k2`` give the order of ``rows``."""
    order = "load_nr, k1, k2"
    return f"""
ph(k, phrase) AS (VALUES {_PH}),
w(term, weight, idf) AS (VALUES {_W}),
{PAGES},
app_rows AS ({rows}),
{enriched("app_rows", order, APP)},
{attributes("enriched", APP)},
{dimension("attributed", "dim_product", "product_id", "product_name", "category, brand", order)},
{dimension("attributed", "dim_customer", "customer_id", "customer_name", "age, gender", order)},
{dimension("attributed", "dim_location", "location_id", "country, city", "", order)},
fact_reviews AS (
  SELECT row_number() OVER (ORDER BY {order}) AS review_id, product_id, customer_id,
    CASE WHEN load_ts = {LOAD} THEN 1 ELSE 2 END::BIGINT AS date_id, location_id, review_text,
    sentiment_label, issue_reason, ai_recommendation, source AS source_link,
    load_ts AS load_timestamp
  FROM attributed a
  JOIN dim_product USING (product_name)
  JOIN dim_customer USING (customer_name)
  JOIN dim_location USING (country, city))
"""


_PAGE_ROWS = f"""
  SELECT 1 AS load_nr, page_id AS k1, CAST(pos AS BIGINT) AS k2, review_text, url AS source,
    {LOAD} AS load_ts
  FROM page_reviews"""

MANUAL_ROWS = f"""
  SELECT 2 AS load_nr, conv_id AS k1, turn AS k2, text AS review_text, 'Manual Entry' AS source,
    {LOAD} AS load_ts
  FROM conversations WHERE role = 'user' AND NOT regexp_matches(text, {BLANK})"""

UPLOADS = """
  SELECT doc_id, text AS review_text, CASE WHEN lang = 'en'
    THEN 'https://www.kaggle.com/datasets/' || source ELSE 'Local CSV (' || source || '.csv)' END
    AS source
  FROM documents"""

_UPLOAD_ROWS = f"""
  SELECT 3 AS load_nr, doc_id AS k1, 0::BIGINT AS k2, review_text, source, {SECOND} AS load_ts
  FROM ({UPLOADS})"""

# Three app loads in a row: pages, manual entries, uploads.
APP_STAR = app_star(f"{_PAGE_ROWS} UNION ALL {MANUAL_ROWS} UNION ALL {_UPLOAD_ROWS}")
