"""Adding documents to a stored index without rewriting it.

What is added becomes a level of its own beside the levels that are there: its postings, documents and terms, the
older documents that it replaces, and how many of their rows held each term. Readers leave the replaced rows out and
add frequencies and statistics up, so adding writes as much as is added. Terms keep their ids, and new terms get the
next ones. When the added levels have grown to a share of the first one, all are written anew as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.operators import postings as P
from lexigrid.plans.build import analyzed_documents, listed
from lexigrid.plans.session import broadcast_checked, materialize
from lexigrid.sources import index_store as S

#: Added levels of this share of the first one are merged with it.
COMPACT_AT = 0.5


def add_documents(
    docs: DataFrame,
    path: str,
    codec: str = "zstd",
    key: str = "doc_id",
    text: str = "text",
    compact_at: float | None = COMPACT_AT,
) -> S.Index:
    """Add documents to the index at ``path``; one whose id is known replaces the older one as a whole.

    ``compact_at=None`` never merges levels. One writer at a time: of two that add at once, the one that names its
    version last wins.
    """
    spark = docs.sparkSession
    index = S.read_index(spark, path)
    documents, rejects = analyzed_documents(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    postings, listing = P.postings_in(documents), listed(documents, rejects)
    if index.profile == "porter":
        postings = P.stem_postings(postings)
    level = uuid.uuid4().hex
    to = f"{path}/version-{level}"
    listing.write.option("compression", codec).parquet(f"{to}/docs")
    listing = spark.read.schema(S.DOCS).parquet(f"{to}/docs")

    flags = S.read_flags(spark, path, index)
    known = flags.join(broadcast_checked(listing.select("doc_id"), "added"), "doc_id", "left_semi")
    known.write.parquet(f"{to}/hides")
    hides = spark.read.schema(S.HIDES).parquet(f"{to}/hides")
    replaced = broadcast_checked(hides.select("doc_id"), "replaced")
    less = index.postings.select("term_id", "term", "doc_id").join(replaced, "doc_id", "left_semi")
    less.groupBy("term_id", "term").agg(F.count("*").alias("df")).write.parquet(f"{to}/less")

    counts = materialize(P.document_frequency(postings.select("term")), "added-terms")
    side = broadcast_checked(counts, "added-terms")
    ids = S.all_terms(spark, path, index)
    old = ids.join(side, "term").select("term_id", "term", "df")
    # Few against the dictionary: only terms that are new are ranged and numbered, after the largest known id.
    new = P.term_dictionary(counts.join(broadcast_checked(old.select("term"), "known"), "term", "left_anti"), ids)
    terms = old.unionByName(new.select("term_id", "term", "df"))
    terms.sortWithinPartitions("term").write.option("compression", codec).parquet(f"{to}/terms")
    terms = broadcast_checked(spark.read.schema(S.TERMS_SCHEMA).parquet(f"{to}/terms"), "terms")
    S.write_postings(postings.join(terms, "term"), f"{to}/postings", index.buckets, codec)
    rejects.select(F.col("doc_id").cast("long").alias("doc_id"), "reason").write.parquet(f"{to}/rejects")

    gone, tokened = hides.agg(F.count("*").alias("n")).scalar(), hides.agg(F.count_if("has_tokens").alias("n")).scalar()
    stats = P.stats_of(listing).select(
        (F.col("total_docs") - gone).alias("total_docs"), (F.col("indexed_docs") - tokened).alias("indexed_docs"),
        F.lit(index.buckets).alias("buckets"), F.lit(index.profile).alias("profile"),
    )
    stats.coalesce(1).write.parquet(f"{to}/stats")
    out = S.name_version(spark, path, [*index.levels, level])
    if compact_at is not None:
        sizes = [S.total_bytes(spark, f"{path}/version-{v}/postings") for v in out.levels]
        if sum(sizes[1:]) >= compact_at * sizes[0]:
            return compact(spark, path, codec)
    return out


def compact(spark: SparkSession, path: str, codec: str = "zstd") -> S.Index:
    """Write all levels anew as one; ids are given anew."""
    index = S.read_index(spark, path)
    if len(index.levels) < 2:
        return index
    size = sum(S.total_bytes(spark, f"{path}/version-{v}/postings") for v in index.levels)
    docs = S.read_flags(spark, path, index, digests=True)
    rows = materialize(index.postings.select(*P.POSTINGS_SCHEMA.names), "levels")
    return S.write_index(rows, docs, path, index.buckets, index.profile, codec, rejects=index.rejects, input_bytes=size)
