"""A training corpus in four stages: toxicity, language, near duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm import langid, minhash, packing, toxicity
from reviewmart.llm.common import table
from reviewmart.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A language is rejected where the text has no letter, or the model is no surer than this.
LEAST_CONFIDENCE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from the labels of kept folds, is below 0.3.

    Scored row by row, so repeated rows and null doc_ids stand on their own text.
    """
    held_out = toxicity.remainder(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.scored(docs, model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model learned and recognises with some confidence."""
    held_out = langid.remainder(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    found = langid.predicted(docs, model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_CONFIDENCE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of least doc_id.

    Rows of one doc_id are one document and stay together; a null doc_id is kept.
    """
    classes = stage(minhash.near_duplicates(docs), "classes")
    dropped = classes.where("NOT kept").select("doc_id").distinct()
    few = dropped.count() <= minhash.BROADCAST_IDS
    return docs.join(F.broadcast(dropped) if few else dropped, "doc_id", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as sequences of at most 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Trained models and tokenizers are not expressible in SQL; tests/llm holds brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
