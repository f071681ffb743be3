"""Document and query-log sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.plans.session import materialize


def read_documents(
    spark: SparkSession,
    path: str,
    sample_size: int | None = None,
    fmt: str = "parquet",
    key: str = "doc_id",
    text: str = "text",
    schema=None,
    **options,
) -> DataFrame:
    """``(doc_id, text)`` from any file format Spark reads.

    ``sample_size`` takes the documents with the smallest ids, whatever gaps the ids have. Each task keeps
    that many ids at most, and the texts are then read for the ids up to the largest of them, a range
    that Parquet and ORC scans skip by. Repeated ids count by row.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    docs = reader.load(path).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs if sample_size is None else sample(docs, sample_size)


def sample(docs: DataFrame, size: int) -> DataFrame:
    """``size`` rows with the smallest ids. Of an id that goes over the size the rows with the least texts are taken."""
    first = docs.select("doc_id").filter("doc_id is not null").orderBy("doc_id").limit(size)
    edge = first.agg(F.max("doc_id").alias("last"), F.count("*").alias("n")).first()
    if edge.last is None:
        return docs.filter(F.lit(False))
    whole = docs.filter(F.col("doc_id") <= edge.last)
    if whole.select("doc_id").limit(size + 1).count() <= size:
        return whole
    below = docs.filter(F.col("doc_id") < edge.last)
    at_edge = docs.filter(F.col("doc_id") == edge.last).orderBy("text").limit(size - below.select("doc_id").count())
    return below.unionByName(at_edge)


CORRUPT = "_broken"


def read_checked(
    spark: SparkSession, path: str, fmt: str = "json", key: str = "doc_id", text: str = "text", **options
) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` of JSON or CSV files, of which lines may be malformed.

    ``documents`` is ``(doc_id, text)`` of the lines that can be read; ``rejects(file, record, reason)`` holds the others
    as they stand: broken syntax, an id that is no number, or a line of CSV with cells too many or too few; the reason says
    whether an id could be read.
    """
    reader = spark.read.format(fmt).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning="false", **options)
    rows = reader.schema(f"`{key}` long, `{text}` string, {CORRUPT} string").load(path)
    rows = rows.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), CORRUPT, F.col("_metadata.file_path").alias("file"))
    broken = F.col(CORRUPT).isNotNull()
    reason = F.when(F.col("doc_id").isNull(), "malformed").otherwise("malformed after the id")
    # Written with all columns: Spark refuses queries of raw files that need the broken lines alone.
    rejects = materialize(rows.filter(broken).select("file", F.col(CORRUPT).alias("record"), reason.alias("reason")), "malformed")
    return rows.filter(~broken).select("doc_id", "text"), rejects


def rejects_by_file(rejects: DataFrame) -> DataFrame:
    """``(file, rejects)``."""
    return rejects.groupBy("file").agg(F.count("*").alias("rejects"))


def read_queries(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of ranked queries: ``(query_id, text)``."""
    return spark.read.format(fmt).schema("query_id string, text string").options(**options).load(path)


def read_literals(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of Boolean queries in disjunctive normal form, one literal a row; ``phrase`` may be NULL."""
    schema = "query_id string, clause_id int, literal_id int, text string, phrase boolean, negated boolean"
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
