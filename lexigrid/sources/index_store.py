"""The stored index: layout, writing, reading, size, freshness.

Layout under one folder: each build writes its own ``version`` folder and, last, a row that names it
in ``versions``. Readers open the latest version named there, so a build that fails changes nothing. A version may
consist of several levels, each a folder of its own: a build, and documents added since (:mod:`lexigrid.plans.levels`).

``postings``  one row per (term, document) with the term's id and document frequency, partitioned
              by ``term_bucket``, sorted by term and document inside each file, Bloom filter on ``term``
``terms``     ``(term_id, term, df)`` sorted by term
``stats``     one row: total_docs, indexed_docs, buckets, profile
``bitmaps``   the documents of frequent terms, and all documents, as bits by id range; clustered like the postings
``docs``      the document ids (what NOT is taken against), whether they have tokens, and digests of their texts
``rejects``   ``(doc_id, reason)`` of the rows left out
``hides``     added levels: ``(doc_id, has_tokens)`` of documents whose rows in older levels no longer count
``less``      added levels: ``(term_id, term, df)``, how many of the rows that are hidden hold a term

Blocks (partial indexes) lie under ``postings``, ``docs`` and ``rejects`` of their folder, each by source and
batch, and carry ``block_id``, the order in which later blocks win.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.operators import bitmaps as BM
from lexigrid.operators import postings as P
from lexigrid.plans.session import PLAIN_TERMS, broadcast_if, drop_path, is_small, join_words, open_files, partition_bytes

CODECS = ("none", "gzip", "zstd", "snappy", "lz4")
# Ids to a range whose texts are compared as one.
DIGEST_IDS = 1024
BUCKET_BYTES = 512 * 1024 * 1024
# Of stored postings, at most to a file of a bucketed table.
TABLE_FILE_BYTES = 16 * 1024 * 1024
MIN_BUCKETS, MAX_BUCKETS = 8, 1 << 18

STORED_POSTINGS = T.StructType(
    [
        *P.POSTINGS_SCHEMA,
        T.StructField("term_id", T.LongType()),
        T.StructField("df", T.LongType()),
        T.StructField("term_bucket", T.IntegerType()),
    ]
)
TERMS_SCHEMA = T.StructType(
    [
        T.StructField("term_id", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("df", T.LongType()),
    ]
)
STATS_SCHEMA = T.StructType(
    [
        T.StructField("total_docs", T.LongType()),
        T.StructField("indexed_docs", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("profile", T.StringType()),
    ]
)
BLOCKS_SCHEMA = T.StructType([*P.POSTINGS_SCHEMA, T.StructField("block_id", T.LongType())])
DOCS = "doc_id long, has_tokens boolean, digest long"
BLOCK_DOCS = f"{DOCS}, block_id long"
BITMAPS = "term string, rng long, bits binary, max_tf int, term_bucket int"
REJECTS = "doc_id long, reason string"
VERSIONS = "version string, written timestamp, levels array<string>"
HIDES = "doc_id long, has_tokens boolean"


@dataclass(frozen=True)
class Index:
    """DataFrames of one index plus the profile its terms were made with."""

    docs: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    buckets: int
    total_docs: int
    profile: str = "plain"
    rejects: DataFrame | None = None
    bitmaps: DataFrame | None = None
    digests: DataFrame | None = None
    levels: tuple[str, ...] = ()

    @property
    def dense_from(self) -> int:
        """The least document frequency of terms that have bitmaps; over several levels none has."""
        return BM.dense_from(self.total_docs) if len(self.levels) < 2 else 1 << 62


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def buckets_for(input_bytes: int) -> int:
    """Number of term buckets for an input size: about half a GB of text each."""
    return max(MIN_BUCKETS, min(MAX_BUCKETS, input_bytes // BUCKET_BYTES))


def _codec(codec: str) -> str:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    return codec


def _order(numbered: bool) -> list[Column]:
    """By term and document. Ids in term order are compared in place of terms, most of them in one number with the document."""
    if not numbered:
        return [F.col("term"), F.col("doc_id")]
    place = F.least(F.greatest(F.col("doc_id"), F.lit(0)), F.lit((1 << 24) - 1))
    return [F.shiftleft("term_id", 24) + place, F.col("term_id"), F.col("doc_id")]


def write_postings(
    postings: DataFrame, path: str, buckets: int, codec: str = "zstd", input_bytes: int | None = None, numbered: bool = False
) -> None:
    """Cluster postings by term bucket and write them, shuffling once.

    The rebalance hint shuffles by bucket; AQE splits a bucket too large for one task (a term in a third of
    all documents) and joins small ones. The plan is the same for every size; ``input_bytes`` only sizes the
    partitions, so that a small index is written by all cores as well. ``numbered``: term ids are in the order of terms.
    """
    kept = [c for c in STORED_POSTINGS.names if c in postings.columns and c != "term_bucket"]
    rows = postings.select(*kept).withColumn("term_bucket", bucket_of(F.col("term"), buckets))
    spark = postings.sparkSession
    with partition_bytes(spark, input_bytes or 0), open_files(spark, buckets) as mixed:
        (
            rows.hint("rebalance", "term_bucket")
            .sortWithinPartitions(*([] if mixed else ["term_bucket"]), *_order(numbered))
            .write.mode("overwrite")
            .option("compression", _codec(codec))
            .option("parquet.bloom.filter.enabled#term", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy("term_bucket")
            .parquet(path)
        )


def write_bitmaps(postings: DataFrame, docs: DataFrame, path: str, buckets: int, total_docs: int, codec: str = "zstd") -> None:
    """Bitmaps of the frequent terms of stored postings, and of all documents."""
    every = docs.select(F.lit(BM.EVERY).alias("term"), "doc_id", F.lit(None).cast("int").alias("tf"))
    frequent = postings.filter(F.col("df") >= BM.dense_from(total_docs)).select("term", "doc_id", "tf")
    rows = BM.bitmaps_of(frequent.unionByName(every), "term", F.max("tf").alias("max_tf")).withColumn("term_bucket", bucket_of(F.col("term"), buckets))
    with partition_bytes(postings.sparkSession, 0):
        (
            rows.hint("rebalance", "term_bucket")
            .sortWithinPartitions("term_bucket", "term", "rng")
            .write.option("compression", _codec(codec))
            .partitionBy("term_bucket")
            .parquet(path)
        )


def write_terms(terms: DataFrame, path: str, codec: str = "zstd") -> None:
    P.term_dictionary(terms.select("term", "df")).sortWithinPartitions("term").write.mode(
        "overwrite"
    ).option("compression", _codec(codec)).parquet(path)


def write_index(
    postings: DataFrame,
    docs: DataFrame,
    path: str,
    buckets: int,
    profile: str = "plain",
    codec: str = "zstd",
    rejects: DataFrame | None = None,
    input_bytes: int | None = None,
    terms: DataFrame | None = None,
) -> Index:
    """Write all tables of an index as a new version, then make it the one that is read.

    ``postings`` is read up to three times and should be a written table; ``docs`` is ``(doc_id, has_tokens, digest)``, once per document. The
    dictionary comes first, so that its ids and document frequencies are written beside the postings: no later
    query joins the two. Postings that have both already come with their dictionary ``terms``. Statistics are counts over ``docs``.
    """
    spark = postings.sparkSession
    version = uuid.uuid4().hex
    to = f"{path}/version-{version}"
    if terms is None:
        write_terms(P.document_frequency(postings.select("term")), f"{to}/terms", codec)
        # The one join of postings and dictionary.
        postings = join_words(postings, spark.read.schema(TERMS_SCHEMA).parquet(f"{to}/terms"))
    else:
        terms = terms.select(*TERMS_SCHEMA.names).repartitionByRange("term").sortWithinPartitions("term")
        terms.write.mode("overwrite").option("compression", _codec(codec)).parquet(f"{to}/terms")
    write_postings(postings, f"{to}/postings", buckets, codec, input_bytes, numbered=True)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "has_tokens", "digest").write.option("compression", codec).parquet(f"{to}/docs")
    if rejects is None:
        rejects = spark.createDataFrame([], REJECTS)
    rejects.select(F.col("doc_id").cast("long").alias("doc_id"), "reason").write.parquet(f"{to}/rejects")
    universe = spark.read.schema(DOCS).parquet(f"{to}/docs")
    stats = P.stats_of(universe).select("*", F.lit(buckets).alias("buckets"), F.lit(profile).alias("profile"))
    stats.coalesce(1).write.parquet(f"{to}/stats")
    total = spark.read.schema(STATS_SCHEMA).parquet(f"{to}/stats").first().total_docs
    stored = spark.read.schema(STORED_POSTINGS).parquet(f"{to}/postings")
    write_bitmaps(stored, universe, f"{to}/bitmaps", buckets, total, codec)
    return name_version(spark, path, [version])


def name_version(spark: SparkSession, path: str, levels: list[str]) -> Index:
    """Make these levels, oldest first, the ones that are read."""
    row = spark.range(1).select(
        F.lit(levels[-1]).alias("version"), F.current_timestamp().alias("written"), F.array(*map(F.lit, levels)).alias("levels")
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    """Open the latest version of a stored index; schemas are fixed, and the profile is the stored one."""
    latest = spark.read.schema(VERSIONS).parquet(f"{path}/versions").orderBy(F.desc("written"), "version").first()
    levels = tuple(latest.levels)
    if len(levels) > 1:
        return _read_levels(spark, path, levels)
    at = f"{path}/version-{latest.version}"
    stats = spark.read.schema(STATS_SCHEMA).parquet(f"{at}/stats")
    one = stats.first()
    return Index(
        docs=spark.read.schema(DOCS).parquet(f"{at}/docs").select("doc_id"),
        postings=spark.read.schema(STORED_POSTINGS).parquet(f"{at}/postings"),
        terms=spark.read.schema(TERMS_SCHEMA).parquet(f"{at}/terms"),
        stats=stats,
        buckets=one.buckets,
        total_docs=one.total_docs,
        profile=one.profile,
        rejects=spark.read.schema(REJECTS).parquet(f"{at}/rejects"),
        bitmaps=spark.read.schema(BITMAPS).parquet(f"{at}/bitmaps"),
        digests=spark.read.schema(DOCS).parquet(f"{at}/docs").select("doc_id", "digest"),
        levels=levels,
    )


def _read_levels(spark: SparkSession, path: str, levels: tuple[str, ...]) -> Index:
    """Several levels as one index: rows that a later level hides are left out, frequencies and statistics added up.

    ``df`` beside the postings counts one level only and reads as NULL; see :func:`weighted_postings`.
    """
    read = lambda v, name, schema: spark.read.schema(schema).parquet(f"{path}/version-{v}/{name}")
    hides = [read(v, "hides", HIDES).select("doc_id") if i else None for i, v in enumerate(levels)]
    hidden: DataFrame | None = None
    postings, docs = [], []
    for i in range(len(levels) - 1, -1, -1):  # newest first; what is hidden grows on the way
        rows, listed = read(levels[i], "postings", STORED_POSTINGS), read(levels[i], "docs", DOCS)
        if hidden is not None:
            side = broadcast_if(is_small(hidden), hidden)
            rows, listed = rows.join(side, "doc_id", "left_anti"), listed.join(side, "doc_id", "left_anti")
        postings.append(rows.withColumn("df", F.lit(None).cast("long")).select(*STORED_POSTINGS.names))
        docs.append(listed)
        if i and hides[i].limit(1).count():
            hidden = hides[i] if hidden is None else hidden.unionByName(hides[i])

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    terms = [read(v, "terms", TERMS_SCHEMA) for v in levels]
    terms += [read(v, "less", TERMS_SCHEMA).withColumn("df", -F.col("df")) for v in levels[1:]]
    stats = union([read(v, "stats", STATS_SCHEMA) for v in levels]).groupBy("buckets", "profile")
    stats = stats.agg(F.sum("total_docs").alias("total_docs"), F.sum("indexed_docs").alias("indexed_docs")).select(*STATS_SCHEMA.names)
    one, listed = stats.first(), union(docs)
    every = BM.bitmaps_of(listed.select(F.lit(BM.EVERY).alias("term"), "doc_id"), "term", F.lit(None).cast("int").alias("max_tf"))
    return Index(
        docs=listed.select("doc_id"),
        postings=union(postings),
        terms=union(terms).groupBy("term_id", "term").agg(F.sum("df").alias("df")).filter("df > 0"),
        stats=stats,
        buckets=one.buckets,
        total_docs=one.total_docs,
        profile=one.profile,
        rejects=union([read(v, "rejects", REJECTS) for v in levels]),
        bitmaps=every.withColumn("term_bucket", bucket_of(F.col("term"), one.buckets)),
        digests=listed.select("doc_id", "digest"),
        levels=levels,
    )


def all_terms(spark: SparkSession, path: str, index: Index) -> DataFrame:
    """``(term_id, term)`` of every term that any level has had, once each."""
    out = None
    for v in index.levels:
        rows = spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/version-{v}/terms").select("term_id", "term")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct() if len(index.levels) > 1 else out


def read_flags(spark: SparkSession, path: str, index: Index, digests: bool = False) -> DataFrame:
    """``(doc_id, has_tokens)``, and digests, of the documents that count: of each the row of its latest level."""
    columns = ["doc_id", "has_tokens", *(["digest"] if digests else [])]
    rows = [spark.read.schema(DOCS).parquet(f"{path}/version-{v}/docs").select(*columns, F.lit(i).alias("level")) for i, v in enumerate(index.levels)]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    if len(rows) == 1:
        return out.drop("level")
    latest = F.max_by(F.struct(*columns[1:]), "level").alias("r")
    return out.groupBy("doc_id").agg(latest).select("doc_id", *[f"r.{c}" for c in columns[1:]])


def weighted_postings(index: Index) -> DataFrame:
    """The postings with the document frequency of their term: as stored, or joined where levels are to be added up."""
    if len(index.levels) < 2:
        return index.postings
    return index.postings.drop("df").join(index.terms.select("term", "df"), "term")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the latest ``keep`` versions of an index, and what failed builds left; how many folders went.

    Not while another build of the same index runs, nor while a query reads an older version.
    """
    named = spark.read.schema(VERSIONS).parquet(f"{path}/versions").orderBy(F.desc("written"), "version").limit(max(1, keep)).collect()
    kept = {f"version-{v}" for r in named for v in r.levels}
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = [f.getPath() for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)]
    gone = [p for p in found if p.getName().startswith("version-") and p.getName() not in kept]
    for p in gone:
        drop_path(spark, p.toString())
    return len(gone)


def load_postings(terms: DataFrame, postings_by_id: DataFrame) -> DataFrame:
    """Dictionary joined to postings that are keyed by ``term_id``, as an external database holds them."""
    return terms.select("term_id", "term").join(postings_by_id, "term_id").drop("term_id")


def postings_by_id(postings: DataFrame) -> DataFrame:
    """The relational form of stored postings: ``(term_id, doc_id, tf, positions)``."""
    return postings.select("term_id", "doc_id", "tf", "positions")


def save_tables(index: Index, prefix: str, codec: str = "zstd", buckets: int | None = None) -> None:
    """Save an index as catalog tables, postings bucketed and sorted by term; :func:`open_tables` searches them."""
    n = buckets or index.buckets
    each = max(1, -(-measured_bytes(index.postings) // (n * TABLE_FILE_BYTES)))
    small = {"terms": index.terms, "docs": index.docs.join(index.digests, "doc_id"), "stats": index.stats, "bitmaps": index.bitmaps}
    for name, df in small.items():
        df.write.mode("overwrite").option("compression", _codec(codec)).saveAsTable(f"{prefix}_{name}")
    (
        index.postings.repartition(n * each, "term")  # as the table is bucketed, so that a task writes a share of one bucket
        .write.mode("overwrite")
        .option("compression", codec)
        .bucketBy(n, "term")
        .sortBy("term", "doc_id")
        .saveAsTable(f"{prefix}_postings")
    )


def open_tables(spark: SparkSession, prefix: str) -> Index:
    """The index that catalog tables hold. A word's lookup reads one bucket of the postings."""
    stats = spark.table(f"{prefix}_stats")
    one = stats.first()
    docs = spark.table(f"{prefix}_docs")
    return Index(
        docs=docs.select("doc_id"), postings=spark.table(f"{prefix}_postings"), terms=spark.table(f"{prefix}_terms"), stats=stats,
        buckets=one.buckets, total_docs=one.total_docs, profile=one.profile, bitmaps=spark.table(f"{prefix}_bitmaps"),
        digests=docs.select("doc_id", "digest"), levels=(prefix,),
    )


def write_jdbc(index: Index, url: str, prefix: str, **options) -> None:
    """Save postings and terms to an external database in batches of 10,000 rows."""
    by_id = postings_by_id(index.postings).withColumn("positions", F.to_json("positions"))
    opts = {"batchsize": 10000, "truncate": "true", **options}
    for name, df in (("terms", index.terms), ("postings", by_id)):
        df.write.format("jdbc").options(url=url, dbtable=f"{prefix}_{name}", **opts).mode("overwrite").save()


def write_block(
    postings: DataFrame,
    docs: DataFrame,
    rejects: DataFrame | None,
    path: str,
    source: str,
    batch: int,
    block_id: int,
    codec: str = "zstd",
) -> None:
    """Write one partial index with its documents ``(doc_id, has_tokens, digest)`` and rejects.

    It lies under its source and batch; writing that batch again replaces it and nothing else.
    """
    at, order = f"source={source}/batch={int(batch)}", F.lit(int(block_id)).cast("long").alias("block_id")
    tables = {
        "postings": postings.select(*P.POSTINGS_SCHEMA.names, order),
        "docs": docs.select(F.col("doc_id").cast("long").alias("doc_id"), "has_tokens", "digest", order),
    }
    if rejects is not None:
        tables["rejects"] = rejects.select(F.col("doc_id").cast("long").alias("doc_id"), "reason")
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", _codec(codec)).parquet(f"{path}/{name}/{at}")


def _folder_name(value: str) -> str:
    """A partition value as it stands in a path."""
    return re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def write_blocks(blocks: DataFrame, path: str, codec: str = "zstd", source: str = "rows", docs: DataFrame | None = None) -> None:
    """Write rows that carry ``block_id``; only the blocks present are replaced.

    ``docs`` lists ``(doc_id, has_tokens, block_id)``; without it the documents that have postings are listed.
    """
    if docs is None:
        docs = blocks.select("doc_id", "block_id").distinct().withColumn("has_tokens", F.lit(True))
    if "digest" not in docs.columns:
        docs = docs.withColumn("digest", F.lit(None).cast("long"))
    # The source is a part of the path: as a partition column, the same in all rows, it would be compared for every two of them.
    write = lambda df, name: (
        df.withColumn("batch", F.col("block_id"))
        .hint("rebalance", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PLAIN_TERMS | {"compression": _codec(codec)})
        .partitionBy("batch")
        .parquet(f"{path}/{name}/source={_folder_name(source)}")
    )
    write(blocks.select(*BLOCKS_SCHEMA.names), "postings")
    # A document is a few bytes and a block a file: by their bytes alone one task would write the files of all blocks.
    with partition_bytes(blocks.sparkSession, 0):
        write(docs.select("doc_id", "has_tokens", "digest", "block_id"), "docs")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The postings of all partial indexes; a filter on ``block_id`` skips row groups."""
    return spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/postings")


def read_block_docs(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, has_tokens, digest, block_id)``: the documents of all partial indexes, those without tokens included."""
    return spark.read.schema(BLOCK_DOCS).parquet(f"{path}/docs")


def read_block_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, reason)`` of the rows that ingest left out."""
    return spark.read.schema(REJECTS).parquet(f"{path}/rejects")


def footprint(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes)`` below a path. Lengths come from the listing; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    )


def total_bytes(spark: SparkSession, path: str) -> int:
    return footprint(spark, path).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first().b


def measured_bytes(docs: DataFrame) -> int:
    """Bytes of the files a DataFrame is read from; 0 if it is read from none. Contents are not read."""
    files = docs.inputFiles()
    return docs.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length").alias("n")).first().n if files else 0


def freshness(index: Index, docs: DataFrame) -> DataFrame:
    """One row: stored and expected document count and whether they agree."""
    expected = docs.agg(F.count("*").alias("n")).scalar()
    return index.stats.select(F.col("total_docs").alias("stored_docs"), expected.alias("expected_docs")).select(
        "*", (F.col("stored_docs") == F.col("expected_docs")).alias("fresh")
    )
