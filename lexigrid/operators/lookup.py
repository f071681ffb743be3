"""Dictionary and postings lookup for one term or a table of terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.plans.session import broadcast_checked, broadcast_if, is_small, materialize
from lexigrid.sources.index_store import Index, bucket_of


def only_terms(index: Index, terms: Sequence[str]) -> DataFrame:
    """Postings of a few given terms.

    Both the term and its bucket are compared with literals, so the scan opens only
    the directories of those buckets and skips row groups by term.
    """
    buckets = [bucket_of(F.lit(t), index.buckets) for t in terms]
    if not terms:
        return index.postings.filter(F.lit(False))
    return index.postings.filter(F.col("term_bucket").isin(*buckets) & F.col("term").isin(*terms))


def join_documents(index: Index, needed: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of ``needed`` (with ``term`` and ``doc_id``) that have a posting, with the columns asked for.

    If there are many, the postings are shuffled to meet them, but only those of their words.
    """
    needed = needed.withColumn("term_bucket", bucket_of(F.col("term"), index.buckets))
    needed = materialize(needed.filter(F.col("term") > ""), "needed")
    small = is_small(needed)
    postings = index.postings.select("term_bucket", "term", "doc_id", *columns)
    if not small:
        words = needed.select("term_bucket", "term").distinct().filter(F.col("term") > "")
        postings = postings.join(broadcast_checked(words, "needed-words"), ["term_bucket", "term"], "left_semi")
    return postings.join(broadcast_if(small, needed), ["term_bucket", "term", "doc_id"]).drop("term_bucket")


def join_bitmaps(index: Index, wanted: DataFrame, small: bool, columns: Sequence[str] = ("bits",)) -> DataFrame:
    """Rows of ``wanted`` (with ``term``) joined to the ranges of their terms, with the columns asked for."""
    wanted = wanted.withColumn("term_bucket", bucket_of(F.col("term"), index.buckets)).filter(F.col("term") >= "")
    rows = index.bitmaps.select("term_bucket", "term", "rng", *columns)
    return rows.join(broadcast_if(small, wanted), ["term_bucket", "term"]).drop("term_bucket")


def term_id(index: Index, term: str) -> DataFrame:
    """``(term, term_id)`` of one term; empty when unknown."""
    return index.terms.filter(F.col("term") == term).select("term", "term_id")


def term_ids(index: Index, wanted: DataFrame) -> DataFrame:
    """``(term, term_id)`` of a table of terms; unknown terms are absent."""
    wanted = wanted.select("term").distinct()
    return index.terms.join(broadcast_checked(wanted), "term").select("term", "term_id")


def postings_of_term(index: Index, term: str) -> DataFrame:
    return only_terms(index, [term]).select("term", "doc_id", "tf", "positions")


def postings_of_terms(index: Index, wanted: DataFrame) -> DataFrame:
    """Postings of a table of terms; joined on bucket and term."""
    wanted = wanted.select("term").distinct()
    return join_postings(index, wanted, ["doc_id", "tf", "positions"])


def join_postings(index: Index, wanted: DataFrame, columns: Sequence[str], small: bool | None = None) -> DataFrame:
    """Rows of ``wanted`` (with ``term``) joined to the postings columns asked for.

    No term is empty; the comparison marks the wanted side as a filter, upon which a
    broadcast join prunes the scanned buckets at run time.
    """
    wanted = wanted.filter(F.col("term") > "").withColumn("term_bucket", bucket_of(F.col("term"), index.buckets))
    side = broadcast_checked(wanted) if small is None else broadcast_if(small, wanted)
    return (
        index.postings.select("term_bucket", "term", *columns)
        .join(side, ["term_bucket", "term"])
        .drop("term_bucket")
    )


def doc_freq(index: Index, term: str) -> DataFrame:
    """``(term, df)`` of one term, 0 when unknown."""
    df = index.terms.filter(F.col("term") == term).agg(F.coalesce(F.max("df"), F.lit(0)).alias("df"))
    return df.select(F.lit(term).alias("term"), "df")


def doc_freqs(index: Index, wanted: DataFrame) -> DataFrame:
    """``(term, df)`` for every wanted term; unknown terms get 0."""
    wanted = broadcast_checked(wanted.select("term").distinct(), "wanted")
    found = index.terms.join(wanted, "term", "left_semi").select("term", "df")
    return wanted.join(found, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df"))


def nested_postings(postings: DataFrame, docs_per_row: int = 100_000) -> DataFrame:
    """``(term, part, docs)`` with ``docs`` a map of doc_id to ``(tf, positions)``.

    A part covers ``docs_per_row`` consecutive document ids, so no row and no task
    holds the whole list of a frequent term.
    """
    entry: Column = F.struct("doc_id", F.struct("tf", "positions").alias("posting"))
    return postings.groupBy("term", F.floor(F.col("doc_id") / docs_per_row).alias("part")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("docs")
    )


def flatten_postings(nested: DataFrame) -> DataFrame:
    """Back from :func:`nested_postings` to one row per posting."""
    return nested.select("term", F.explode("docs").alias("doc_id", "p")).select(
        "term", "doc_id", "p.tf", "p.positions"
    )
