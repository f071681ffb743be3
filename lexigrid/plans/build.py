"""Index builds: one shot, through blocks, and the stemmed variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.operators import postings as P
from lexigrid.plans.session import PLAIN_TERMS, materialize, spread
from lexigrid.sources import index_store as S


def build_index(
    docs: DataFrame,
    path: str,
    profile: str = "plain",
    buckets: int | None = None,
    input_bytes: int | None = None,
    codec: str = "zstd",
    key: str = "doc_id",
    text: str = "text",
) -> S.Index:
    """Analyse documents and write postings, terms, statistics, documents and rejected rows.

    Texts are analysed once, into a table with a row per posting; dictionary, document list and postings all come from that table. Postings are shuffled once, into their term buckets. The size of the input is measured
    where ``input_bytes`` is not given; it sizes the buckets and tells whether the input is too small to occupy the
    cluster by itself.
    """
    if input_bytes is None:
        input_bytes = S.measured_bytes(docs)
    buckets = buckets or S.buckets_for(input_bytes)
    documents, rejects = analyzed_documents(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), input_bytes)
    postings, terms = P.postings_in(documents), None
    if profile == "porter":
        postings, terms = P.numbered_stems(postings)
    return S.write_index(postings, listed(documents, rejects), path, buckets, profile, codec, rejects=rejects, input_bytes=input_bytes, terms=terms)


def analyzed_documents(docs: DataFrame, input_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)``: a written table of analysed documents, as :func:`lexigrid.operators.postings.posting_rows` gives it, and ``(doc_id, reason)`` of the rows left out.

    Ids are looked at without their texts; only the texts of repeated ids are read twice.
    """
    valid, rejects = P.split_valid(docs)
    valid, repeated = P.split_repeated(valid)
    digest = P.text_digest(F.col("text"))
    documents = materialize(P.posting_rows(spread(valid, "doc_id", input_bytes), "doc_id", "text", digest), "analyzed", **PLAIN_TERMS)
    return documents, rejects.select("doc_id", "reason").unionByName(repeated)


def listed(documents: DataFrame, rejects: DataFrame) -> DataFrame:
    """``(doc_id, has_tokens, digest)`` of analysed documents and of those that were rejected for want of a text."""
    rows = P.documents_in(documents, "digest")
    textless = rejects.filter("reason = 'null text' and doc_id is not null").select(
        "doc_id", F.lit(False).alias("has_tokens"), P.text_digest(F.lit(None).cast("string"))
    )
    if not textless.limit(1).count():
        return rows
    return P.merge_documents(rows.unionByName(textless))


def changed_ranges(index: S.Index, docs: DataFrame, width: int = S.DIGEST_IDS) -> DataFrame:
    """``(first_id, last_id, stored_docs, found_docs)`` of the id ranges in which documents differ from the indexed ones.

    Digests of the stored texts are compared with those of the texts at hand, range by range and in any order, so that a
    changed text shows though no count does; no row: the index is fresh. Rejected rows are left out alike.
    """
    valid, rejects = P.split_valid(docs.select("doc_id", "text"))
    valid, _ = P.split_repeated(valid)
    textless = rejects.filter("reason = 'null text'").select("doc_id", "text").distinct()
    now = valid.select("doc_id", P.text_digest(F.col("text")), F.lit(1).alias("has")).unionByName(
        textless.select("doc_id", P.text_digest(F.col("text")), F.lit(0).alias("has"))
    )
    if textless.limit(1).count():  # an id with a text and without one has the text
        now = now.groupBy("doc_id").agg(F.max_by("digest", "has").alias("digest"))
    now = P.range_digests(now, width).select("rng", F.col("docs").alias("found_docs"), F.col("digest").alias("found"))
    both = P.range_digests(index.digests, width).withColumnRenamed("docs", "stored_docs").join(now, "rng", "full_outer")
    both = both.filter(~F.col("digest").eqNullSafe(F.col("found")) | ~F.col("stored_docs").eqNullSafe(F.col("found_docs")))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select(
        (F.col("rng") * width).alias("first_id"), ((F.col("rng") + 1) * width - 1).alias("last_id"), zero("stored_docs"), zero("found_docs")
    )


def build_from_blocks(
    spark: SparkSession, blocks: str, path: str, buckets: int | None = None, profile: str = "plain", codec: str = "zstd"
) -> S.Index:
    """Merge a folder of partial indexes into one. The blocks say which documents there are."""
    docs = S.read_block_docs(spark, blocks)
    size = S.total_bytes(spark, f"{blocks}/postings")
    merged = P.merge_blocks(S.read_blocks(spark, blocks), docs)
    merged = materialize(merged, "merged", **PLAIN_TERMS)
    rejects = terms = None
    if profile == "porter":
        merged, terms = P.numbered_stems(merged)
    try:
        rejects = S.read_block_rejects(spark, blocks)
    except Exception as e:  # blocks written from rows have no rejects
        if "PATH_NOT_FOUND" not in str(e):
            raise
    universe = P.merge_documents(docs)
    return S.write_index(merged, universe, path, buckets or S.buckets_for(size), profile, codec, rejects=rejects, input_bytes=size, terms=terms)
