"""Session helpers: scratch tables, size checks, spreading of small inputs."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side is broadcast only when it was counted and lies within both bounds.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_CHARS = 64 * 1024 * 1024
# Spark's default spark.sql.files.maxPartitionBytes.
SPLIT_BYTES = 128 * 1024 * 1024
# Of a partition that AQE makes, at most.
ADVISORY_BYTES = 64 * 1024 * 1024
# Files that a task keeps open at a time, at most.
OPEN_FILES = 64
# For scratch tables in document order: words change from row to row, so a dictionary of them is filled, looked up and given up.
PLAIN_TERMS = {"compression": "zstd", "parquet.enable.dictionary#term": "false"}

_local_roots: dict[str, str] = {}
# Folders of the scratch scopes that are open, by application; the innermost is the last.
_scopes: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str, scoped: bool = True) -> str:
    """A new path for an intermediate table.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Only a local master may do without that setting. Inside a :func:`scratch_scope` it lies in the
    scope's folder, unless ``scoped`` is false.
    """
    inside = _scopes.get(spark.sparkContext.applicationId)
    if inside and scoped:
        return f"{inside[-1]}/{name}-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="lexigrid-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/lexigrid/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store it lies; whether there was one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Own the scratch tables that are made inside, and delete them at the end.

    Results are computed from these tables, so write or collect the answer before the block ends::

        with scratch_scope(spark):
            rank_batch(index, queries).write.parquet(path)
    """
    path = scratch_path(spark, "scope")
    stack = _scopes.setdefault(spark.sparkContext.applicationId, [])
    stack.append(path)
    try:
        yield path
    finally:
        stack.remove(path)
        drop_path(spark, path)


def materialize(df: DataFrame, name: str, **write_options) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: a lineage cut that survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**write_options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, columns: dict, schema: str) -> DataFrame:
    """A small table given as Python lists. It becomes a local relation: no job, known size."""
    return spark.createDataFrame(pa.table(columns), schema)


def small_rows(df: DataFrame) -> int | None:
    """The number of rows if rows and characters are within the bounds, else None.

    Counting stops just past the bound.
    """
    strings = [c for c, t in df.dtypes if t == "string"]
    chars = F.lit(0)
    for c in strings:
        chars = chars + F.coalesce(F.length(c), F.lit(0))
    size = (
        df.select(chars.alias("chars"))
        .limit(BROADCAST_MAX_ROWS + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))
        .first()
    )
    return size.n if size.n <= BROADCAST_MAX_ROWS and size.chars <= BROADCAST_MAX_CHARS else None


def is_small(df: DataFrame) -> bool:
    return small_rows(df) is not None


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Hint a broadcast after a size check; otherwise leave the join to AQE, which splits skew."""
    return F.broadcast(df) if small else df


def broadcast_checked(df: DataFrame, name: str = "side") -> DataFrame:
    """Write a side of unknown size, look at its size, and hint a broadcast if it is small.

    Writing first means that the side is computed once, not once to be counted and
    once to be joined.
    """
    df = materialize(df, name)
    return broadcast_if(is_small(df), df)


def join_words(postings: DataFrame, words: DataFrame, on: str = "term", weight: str = "df") -> DataFrame:
    """Join postings with a table of one row per word, of which ``weight`` is the number of postings.

    Of a table too large to be broadcast the most frequent words are, as many as the bound allows. Only the postings of the
    others are shuffled: by Zipf's law few, and none of a word that is in more than one of so many.
    """
    if is_small(words):
        return postings.join(F.broadcast(words), on)
    edge = _weight_of(words, weight, max(1, BROADCAST_MAX_ROWS))
    often, seldom = words.filter(F.col(weight) > edge), words.filter(F.col(weight) <= edge)
    if not is_small(often):  # words so long that even these are too many characters
        return postings.join(words, on)
    others = postings.join(F.broadcast(often.select(on)), on, "left_anti").join(seldom, on)
    return postings.join(F.broadcast(often), on).unionByName(others)


def _weight_of(words: DataFrame, weight: str, rank: int):
    """The weight of the word at a rank from the heaviest, or the least: from counts by weight, so no task gets the words themselves."""
    sizes = words.groupBy(weight).agg(F.count("*").alias("n"))
    heavier = F.sum("n").over(Window.orderBy(F.desc(weight)))
    ranked = sizes.select(weight, (heavier - F.col("n")).alias("before"))  # weights are few against words
    return ranked.filter(F.col("before") < rank).agg(F.min(weight).alias("n")).first().n


@contextmanager
def open_files(spark: SparkSession, folders: int):
    """Let a task keep a file open for each of a few folders, so that rows need not be ordered by folder before all else."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    usual = spark.conf.get(name, None)
    spark.conf.set(name, str(folders if folders <= OPEN_FILES else 0))
    try:
        yield folders <= OPEN_FILES
    finally:
        spark.conf.set(name, usual) if usual else spark.conf.unset(name)


@contextmanager
def partition_bytes(spark: SparkSession, input_bytes: int):
    """Let AQE cut rebalanced rows into pieces that keep every core busy, of at most its usual size.

    The plan is the same for every size of the input; only the size of its partitions follows.
    """
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(name, None)
    each = input_bytes // (4 * spark.sparkContext.defaultParallelism)
    spark.conf.set(name, str(max(1 << 18, min(ADVISORY_BYTES, each))))
    try:
        yield
    finally:
        spark.conf.set(name, usual) if usual else spark.conf.unset(name)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which a NULL key meets a NULL key; the keys come out once."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def spread(docs: DataFrame, key: str, input_bytes: int | None = None) -> DataFrame:
    """Give a small input one partition per core.

    A file of a few MB is one scan task, whatever the number of cores. Inputs that
    already fill the cluster are left alone, so no shuffle is added at scale.
    """
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if input_bytes is None:
        return docs
    return docs.repartition(cores, key) if input_bytes < cores * SPLIT_BYTES else docs
