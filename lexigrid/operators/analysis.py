"""From documents to tokens, and the vocabulary job for stemming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.stem import stem
from lexigrid.functions.text import tokens
from lexigrid.plans.session import broadcast_checked

PROFILES = ("plain", "porter")


def tokenize(docs: DataFrame, key, text: str = "text") -> DataFrame:
    """One row per document: key columns and the array of tokens."""
    keys = [key] if isinstance(key, str) else list(key)
    return docs.select(*keys, tokens(F.col(text)).alias("tokens"))


def analyze(docs: DataFrame, key="doc_id", text: str = "text", profile: str = "plain") -> DataFrame:
    """One row per token: key columns, ``pos``, ``term``. No shuffle for ``plain``.

    ``posexplode_outer`` keeps the optimizer from adding a size filter below the
    generator, which would analyse every text a second time.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}")
    keys = [key] if isinstance(key, str) else list(key)
    rows = (
        tokenize(docs, keys, text)
        .select(*keys, F.posexplode_outer("tokens").alias("pos", "term"))
        .filter(F.col("term").isNotNull())
    )
    if profile == "plain":
        return rows
    stems = broadcast_checked(stem_vocabulary(rows.select("term").distinct()))
    return rows.withColumnRenamed("term", "token").join(stems, "token").select(*keys, "pos", "term")


def stem_vocabulary(vocabulary: DataFrame, token: str = "term") -> DataFrame:
    """``(token, term)`` for distinct words; the cost follows the vocabulary, not the corpus."""
    return stem(vocabulary.select(F.col(token).alias("token")), "token", "term")
