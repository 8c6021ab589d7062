"""A training corpus in five stages: toxicity, near duplicates, decontamination, secrets, SentencePiece ids.

Each stage gets what its predecessor kept, as documents, and returns documents; the last returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import Scratch, small_or_shuffled, table
from strandline.llm.decontaminate import contaminated
from strandline.llm.ngram_join import near_duplicates
from strandline.llm.secrets import redact
from strandline.llm.sentencepiece_scan import encode
from strandline.llm.toxicity import score, train


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """docs but for the rows whose doc_id is in bad (doc_id). Rows without a doc_id stay."""
    ids = Scratch(docs.sparkSession).save(bad.where("doc_id is not null").select("doc_id").distinct(), "bad")
    return docs.join(small_or_shuffled(ids, ids.count()), "doc_id", "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine finds toxic go. It learns from the labelled documents outside the held-out fold.

    Every row of a doc_id goes if one of them is toxic. Rows without a doc_id stay; so do null and empty texts, unless toxic texts are the
    rule. An empty table stays empty.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return without(docs, score(docs, model).where("predicted = 1"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays.

    Null, empty and blank texts are no one's duplicates and stay, as do rows without a doc_id, and rows that repeat the doc_id that stays.
    An empty table stays empty.
    """
    return without(docs, near_duplicates(docs).where("component_id <> doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts, and rows without a doc_id, stay; an empty table stays empty."""
    return without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by [SECRET]; every document stays, null and empty texts as they are. An empty table stays empty."""
    return redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's ids: doc_id, n_tokens, ids, round_trip. Null and empty texts have none; an empty table gives no rows."""
    return encode(docs)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination), ("secrets", secrets), ("sentencepiece", sentencepiece)]

#: A trained forest and machine, and a tokenizer, have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet, reread as the next one's docs, and deleted once that is written."""
    keep = Scratch(spark)
    docs, was = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = keep.save(stage(spark, docs, sf_dir), name)
        if was is not None:
            keep.drop(was)
        was = docs
    return docs
