"""TF-IDF terms, linear sentiment scores and the trainable pipeline."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    Normalizer,
    SQLTransformer,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmart.functions.text import TOKEN_PATTERN, has_text, term_counts, tokens
from reviewmart.operators import lookup
from reviewmart.operators.lookup import is_small, lookup_join
from reviewmart.profiles import (
    BLANK_PLACEHOLDER,
    NEGATIVE,
    NEUTRAL,
    POSITIVE,
    Profile,
)
from reviewmart.session import stage

# A weight table up to this many terms travels with the tasks (a few MB).
MAX_LOCAL_TERMS = 200_000

# The largest vocabulary size that can be asked for: no term is cut by rank.
ALL_TERMS = (1 << 31) - 1

# A task counts the terms of about so many bytes of text; their hash table takes some 20 times as much.
TASK_BYTES = 8 << 20

# In each of some hundred passes of a fit every partition sends a number for each term through a
# shuffle; up to five partitions are summed up in one step.
FIT_PARTITIONS = 5


@dataclass(frozen=True)
class LinearModel:
    """A TF-IDF linear classifier: one row of ``term, weight, idf`` per term, and a bias."""

    weights: DataFrame
    bias: float


def save_weights(model: LinearModel, path: str) -> None:
    """Store a linear model as a parquet weight table."""
    model.weights.select("term", "weight", "idf", F.lit(model.bias).alias("bias")).write.parquet(
        path
    )


def load_weights(spark: SparkSession, path: str) -> LinearModel:
    """Read a linear model back."""
    table = spark.read.schema("term string, weight double, idf double, bias double").parquet(path)
    bias = table.agg(F.first("bias", ignorenulls=True)).first()[0]
    return LinearModel(table.drop("bias"), bias or 0.0)


def load_pipeline(path: str) -> PipelineModel:
    """Read a fitted pipeline back."""
    return PipelineModel.load(path)


def _vocabulary(texts: DataFrame) -> DataFrame:
    """``term, idf`` of every term, from one pass over the texts.

    A text's terms are made distinct in place; the empty term, added to each text, counts
    the texts themselves.
    """
    terms = F.array_append(F.array_distinct(tokens(F.col("_text"))), F.lit(""))
    counted = texts.select(F.explode(terms).alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    )
    stored = stage(counted, "frequencies")
    total = stored.filter(F.col("term") == "").first()
    n = total.df if total else 0
    idf = F.log(F.lit(n + 1.0) / (F.col("df") + 1.0))
    return stored.filter(F.col("term") != "").select("term", idf.alias("idf"))


def _lookup_terms(counts: DataFrame, table: DataFrame) -> DataFrame:
    """Join term counts to a term table; counts joined in two parts are stored first."""
    if not is_small(table, lookup.MAX_BROADCAST_ROWS):
        counts = stage(counts, "counts")
    return lookup_join(counts, table, ["term"])


def tfidf(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """TF-IDF of every term of every text: ``key, term, tf, idf, tfidf`` (unit length).

    ``idf = ln((n + 1) / (df + 1))``. Texts are shuffled once, whole, by ``key``; term
    counts, weights and lengths then stay in that partitioning. The bytes of the texts, measured first,
    say over how many tasks they are dealt, so a task's memory does not grow with them.
    """
    texts = df.select(key, F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    tasks = max(math.ceil(size / TASK_BYTES), df.sparkSession.sparkContext.defaultParallelism)
    counts = (
        texts.repartition(tasks, key)
        .select(key, F.explode(tokens(F.col("_text"))).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )
    raw = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(key)))
    vocabulary = _vocabulary(texts)
    weighed = _lookup_terms(counts, vocabulary)
    if not is_small(vocabulary, lookup.MAX_BROADCAST_ROWS):
        # The join has dealt the counts by term.
        weighed = weighed.repartition(tasks, key)
    return (
        weighed.withColumn("_length", length)
        .withColumn("tfidf", F.when(F.col("_length") > 0, raw / F.col("_length")).otherwise(0.0))
        .select(key, "term", "tf", "idf", "tfidf")
    )


def _literal_array(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _local_scores(df: DataFrame, rows: list, bias: float, text: Column) -> DataFrame:
    """Score each row by itself: terms are found by hash, nothing is shuffled."""
    if not rows:
        return df.withColumn("score", F.lit(bias))
    idf = _literal_array([r.idf for r in rows])
    gain = _literal_array([r.idf * r.weight for r in rows])
    counter = CountVectorizerModel.from_vocabulary(
        [r.term for r in rows], inputCol="_tokens", outputCol="_vector"
    )
    counted = counter.transform(df.withColumn("_tokens", tokens(text)))
    counted = counted.drop("_tokens").withColumn("_tf", F.unwrap_udt("_vector")).drop("_vector")

    def per_term(factors: Column) -> Column:
        return F.zip_with("_tf.indices", "_tf.values", lambda i, tf: tf * F.get(factors, i))

    sums = counted.withColumns(
        {
            "_dot": F.aggregate(per_term(gain), F.lit(0.0), lambda a, b: a + b),
            "_square": F.aggregate(per_term(idf), F.lit(0.0), lambda a, b: a + b * b),
        }
    )
    return sums.withColumn("score", _score(bias)).drop("_tf", "_dot", "_square")


def _joined_scores(df: DataFrame, model: LinearModel, text: Column) -> DataFrame:
    """Score by joining terms to a weight table of any size.

    Rows are stored with a number of their own, so that repeated or null keys mix nothing up;
    only this number and the counts of the row's terms, found in the row, travel to the weights.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "scored")
    terms = rows.select("_row", F.explode(term_counts(tokens(text))).alias("_one")).select(
        "_row", "_one.term", F.col("_one.tf").alias("_tf")
    )
    sums = (
        _lookup_terms(terms, model.weights)
        .groupBy("_row")
        .agg(
            F.sum(F.col("_tf") * F.col("idf") * F.col("weight")).alias("_dot"),
            F.sum((F.col("_tf") * F.col("idf")) ** 2).alias("_square"),
        )
    )
    # Two numbers a row: where they fit, they go to the rows, which then stay where they lie.
    sums = stage(sums, "sums")
    few = is_small(sums, lookup.MAX_BROADCAST_ROWS)
    return (
        rows.join(F.broadcast(sums) if few else sums, "_row", "left")
        .withColumn("score", _score(model.bias))
        .drop("_row", "_dot", "_square")
    )


def _score(bias: float) -> Column:
    unit = F.when(F.col("_square") > 0, F.col("_dot") / F.sqrt("_square")).otherwise(0.0)
    return unit + F.lit(bias)


def scored_text(text: Column) -> Column:
    """The text the model sees: null and blank read as a placeholder."""
    return F.when(has_text(text), text).otherwise(BLANK_PLACEHOLDER)


def linear_scores(
    df: DataFrame,
    model: LinearModel,
    text: str = "review_text",
    max_local_terms: int = MAX_LOCAL_TERMS,
) -> DataFrame:
    """Add ``score``: the linear model's margin over unit-length TF-IDF.

    Each row is scored by itself where the weight table may travel with the tasks, and by a
    join beyond that, with the same scores.
    """
    seen = scored_text(F.col(text))
    rows = model.weights.select("term", "weight", "idf").limit(max_local_terms + 1).collect()
    if len(rows) > max_local_terms:
        return _joined_scores(df, model, seen)
    return _local_scores(df, rows, model.bias, seen)


def decode_label(prediction: Column, text: Column, profile: Profile) -> Column:
    """1 is Positive, anything else Negative; the app profile calls missing text Neutral."""
    label = F.when(prediction == 1, POSITIVE).otherwise(NEGATIVE)
    if profile.is_batch:
        return label
    return F.when(has_text(text), label).otherwise(NEUTRAL)


def predict_sentiment(
    df: DataFrame,
    model: LinearModel | PipelineModel,
    profile: Profile,
    text: str = "review_text",
) -> DataFrame:
    """Add ``sentiment_label`` by a weight table or a fitted pipeline."""
    if isinstance(model, LinearModel):
        scored = linear_scores(df, model, text)
        prediction = F.when(F.col("score") > 0, 1).otherwise(0)
        extra = ["score"]
    else:
        scored = model.transform(df.withColumn("_text", scored_text(F.col(text))))
        prediction = F.col("prediction")
        extra = [c for c in scored.columns if c not in df.columns]
    label = decode_label(prediction, F.col(text), profile)
    return scored.withColumn("sentiment_label", label).drop(*extra)


def fit_sentiment(labelled: DataFrame, key: str, min_df: float = 2.0) -> PipelineModel:
    """Fit TF-IDF and logistic regression on ``_text`` and ``label`` (1 = positive).

    Texts are cut into tokens once, spread evenly by their unique ``key`` and kept, on disk
    where memory ends; the classifier, which reads its rows some hundred times, gets vectors that are
    kept likewise and read in ``FIT_PARTITIONS`` partitions. The vocabulary is every term of at least ``min_df`` rows; it and its
    coefficients reach the driver, so the labelled rows are to be a sample whose terms fit there.
    """
    tokenizer = SQLTransformer(
        statement="SELECT *, regexp_extract_all(lower(coalesce(_text, '')), "
        f"'{TOKEN_PATTERN}', 0) AS _tokens FROM __THIS__"
    )
    counter = CountVectorizer(
        inputCol="_tokens", outputCol="_counts", vocabSize=ALL_TERMS, minDF=min_df
    )
    weigher = IDF(inputCol="_counts", outputCol="_weighted")
    normalizer = Normalizer(inputCol="_weighted", outputCol="_features", p=2.0)
    classifier = LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        rawPredictionCol="_margin",
        probabilityCol="_probability",
        regParam=0.01,
        tol=1e-4,
    )
    cut = tokenizer.transform(labelled.select(key, "_text", "label"))
    rows = cut.select(key, "_tokens", "label").repartition(key).persist()
    vectors = None
    try:
        counted = counter.fit(rows)
        vectors = counted.transform(rows).select("_counts", "label").persist()
        few = vectors.coalesce(FIT_PARTITIONS)
        weighed = weigher.fit(few)
        linear = classifier.fit(normalizer.transform(weighed.transform(few)))
    finally:
        rows.unpersist()
        if vectors is not None:
            vectors.unpersist()
    model = PipelineModel([tokenizer, counted, weighed, normalizer, linear])
    # The summary holds the session, which tasks cannot take once it has observed a load.
    none = labelled.sparkSession._jvm.scala.Option.empty()
    model.stages[-1]._java_obj.setSummary(none)
    return model


def export_weights(spark: SparkSession, model: PipelineModel) -> LinearModel:
    """A fitted pipeline as a weight table; its size is bounded by the vocabulary size."""
    _, counter, idf, _, classifier = model.stages
    rows = zip(
        counter.vocabulary,
        classifier.coefficients.toArray().tolist(),
        idf.idf.toArray().tolist(),
        strict=True,
    )
    weights = spark.createDataFrame(list(rows), "term string, weight double, idf double")
    return LinearModel(weights, float(classifier.intercept))
