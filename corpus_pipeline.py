"""The corpus pipeline: its stages over the documents, each written and read again.

Every stage but the last returns the columns of its input. Null keys, null and empty texts, repeated rows and empty
tables pass through as the operators define; a null, empty or letterless text ends at the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm import jaccard_join, language, packing, quality_rules, secret_scan
from lexigrid.llm.common import table
from lexigrid.llm.queries import tokenizer_file
from lexigrid.plans.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy of the quality rules keeps."""
    return quality_rules.drop_rejected(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found by a model learned from the stage's own input.

    Texts without letters go, and those that the operator flags: of several languages, or of none that was learned.
    """
    found = language.predict(F.col("text"), spark, language.fit_documents(docs))
    judged = docs.select(F.struct("*").alias("row"), found.alias("found"))
    kept = judged.filter(~F.col("found.ambiguous"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1,024 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("language id", languages),
    ("near duplicates", near_duplicates),
    ("secret scan", secrets),
    ("packing", packed),
]
#: Language decisions come from a trained model, near duplicates from iterated joins: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
