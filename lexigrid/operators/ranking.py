"""Ranked retrieval: presence, TF and TF-IDF, for one query or a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.stem import stem
from lexigrid.functions.text import literal_tokens, tokens
from lexigrid.operators import bitmaps as BM
from lexigrid.operators.lookup import join_bitmaps, join_documents, join_postings, only_terms
from lexigrid.plans.session import broadcast_if, is_small, materialize
from lexigrid.sources.index_store import Index, bucket_of

SCHEMES = ("tf", "tfidf")
# Sums of doubles depend on their order in the last bits. Scores are rounded before
# they are compared, so that ties are ties on every run.
DIGITS = 6


def idf(df: Column, total: Column) -> Column:
    """log10(N / df), and 0 unless both are positive."""
    return F.when((df > 0) & (total > 0), F.log10(total / df)).otherwise(0.0)


def _weights(index: Index, scheme: str) -> Column:
    if scheme not in SCHEMES:
        raise ValueError(f"scheme must be one of {SCHEMES}")
    if scheme == "tf":
        return F.lit(1.0)
    return idf(F.col("df"), index.stats.select("total_docs").scalar())


def _score() -> Column:
    return F.round(F.sum(F.col("tf") * F.col("weight")), DIGITS).alias("score")


def rank_presence(index: Index, text: str, k: int = 10) -> DataFrame:
    """``(doc_id, score, rank)``: documents with any query term, lowest ids first, score 1."""
    words = sorted(set(literal_tokens(index.docs.sparkSession, text, index.profile)))
    top = only_terms(index, words).select("doc_id").distinct().orderBy("doc_id").limit(k)
    return _number(top.withColumn("score", F.lit(1.0)), k)


def _number(top: DataFrame, k: int) -> DataFrame:
    """Rank at most ``k`` rows; their count is bounded, so one array holds them."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "doc_id")))
    return top.agg(rows.alias("rows")).select(F.posexplode("rows").alias("i", "r")).select(
        "r.doc_id", (-F.col("r.s")).alias("score"), (F.col("i") + 1).alias("rank")
    )


def rank(index: Index, text: str, k: int = 10, scheme: str = "tfidf") -> DataFrame:
    """``(doc_id, score, rank)`` for one query; repeated and unknown words do not count.

    Ties go to the lower document id. Spark keeps k rows per task and merges them.
    """
    words = sorted(set(literal_tokens(index.docs.sparkSession, text, index.profile)))
    rows = only_terms(index, words)
    if len(index.levels) > 1:  # at most a row per query word
        known = index.terms.filter(F.col("term").isin(*words)).select("term", "df")
        rows = rows.drop("df").join(F.broadcast(known), "term")
    top = (
        rows.select("doc_id", "tf", _weights(index, scheme).alias("weight"))
        .groupBy("doc_id")
        .agg(_score())
        .filter("score > 0")
        .orderBy(F.desc("score"), "doc_id")
        .limit(k)
    )
    return _number(top, k)


def query_bags(queries: DataFrame, key: str = "query_id", text: str = "text", profile: str = "plain") -> DataFrame:
    """``(key, bag)``: sorted distinct terms of each query."""
    bags = queries.select(key, F.array_sort(F.array_distinct(tokens(F.col(text)))).alias("bag"))
    if profile == "porter":
        words = bags.select(key, F.explode_outer("bag").alias("token")).filter("token is not null")
        stems = stem(words.select("token").distinct(), "token", "term")
        bags = words.join(stems, "token").groupBy(key).agg(F.array_sort(F.collect_set("term")).alias("bag"))
    return bags


def _bag_terms(bags: DataFrame, key: str) -> DataFrame:
    """One row per term; the outer explode keeps the texts from being analysed twice."""
    return bags.select(key, F.explode_outer("bag").alias("term")).filter(F.col("term").isNotNull())


# Scores are rounded, so a bound may lie below a threshold by this much and still be met.
SLACK = 10.0 ** (1 - DIGITS)


#: Parts of scores to a task, which holds a sum for each (query, document) among them.
TASK_PARTS = 1_000_000


def _tasks(weighted: DataFrame) -> int:
    """How many tasks sum the parts that a table of ``(leader, term, df)`` makes."""
    parts = weighted.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first().n
    return max(weighted.sparkSession.sparkContext.defaultParallelism, -(-parts // TASK_PARTS))


def _by_document(index: Index, places: DataFrame, weighted: DataFrame, on: list[str], small: bool, tasks: int) -> DataFrame:
    """``(leader, doc_id, tf, weight)`` for the postings at ``places`` of every query in ``weighted``.

    The postings are shuffled by document, once, before they meet the queries. The sum
    per (query, document) then needs no shuffle of its own, so postings times queries never cross the
    network, and each task keeps k rows per query. The number of tasks follows the parts, not the postings: AQE would
    join tasks by what they read, however many queries a posting meets. Where the queries are too many to be broadcast, the
    join with them is left to AQE, which splits a frequent term.
    """
    rows = index.postings.select("term_bucket", "term", "doc_id", "tf", BM.range_of(F.col("doc_id")).alias("rng"))
    places = places.filter(F.col("term") > "").withColumn("term_bucket", bucket_of(F.col("term"), index.buckets))
    met = rows.join(broadcast_if(small, places), ["term_bucket", *on]).drop("term_bucket").repartition(tasks, "doc_id")
    return met.join(broadcast_if(small, weighted), on).select("leader", "doc_id", "tf", "weight")


def _top(parts: DataFrame, k: int) -> DataFrame:
    """``(leader, doc_id, score, rank)`` of the k best documents of every query."""
    best = Window.partitionBy("leader").orderBy(F.desc("score"), "doc_id")
    scored = parts.groupBy("leader", "doc_id").agg(_score()).filter("score > 0")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def score_ranges(index: Index, frequent: DataFrame, rare: DataFrame, k: int, small: bool) -> DataFrame:
    """``(leader, rng, bound, least, open)``: the most that a query's frequent words can add in a range of documents.

    ``least`` is the k-th best score that the query's rare words alone give, so the k-th best of all words is no smaller. A
    document without any rare word scores ``bound`` at most: where that is below ``least``, a range is not
    ``open``, and of the frequent words only the postings of documents with rare words count.
    """
    least = _top(rare, k).groupBy("leader").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    least = least.select("leader", F.when(F.col("n") == k, F.col("least")).otherwise(0.0).alias("least"))
    peaks = join_bitmaps(index, frequent, small, ["max_tf"])
    bounds = peaks.groupBy("leader", "rng").agg(F.sum(F.col("max_tf") * F.col("weight")).alias("bound"))
    rows = bounds.join(broadcast_if(small, least), "leader", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    return rows.withColumn("open", F.col("bound") + SLACK >= F.col("least"))


def rank_batch(
    index: Index,
    queries: DataFrame,
    k: int = 10,
    scheme: str = "tfidf",
    key: str = "query_id",
    text: str = "text",
) -> DataFrame:
    """``(key, doc_id, score, rank)``: top k for every row of a query table in one plan.

    Queries with the same set of terms are scored once, so copies of one query cost
    nothing. The rare words of a query give a first threshold; of its frequent words only the ranges of documents are read
    whole that can reach it (:func:`score_ranges`), and elsewhere only the documents that have a rare word. Scores
    are summed per (query, document), a key without hot spots, and the per-query limit runs before the shuffle by
    query as well as after it. The plan is the same for every number of queries and postings.
    """
    bags = materialize(query_bags(queries, key, text, index.profile), "bags")
    leaders = bags.groupBy("bag").agg(F.min(key).alias("leader"))
    wanted = materialize(_bag_terms(leaders, "leader"), "wanted")
    small = is_small(wanted)
    parts = _all_parts(index, wanted, k, scheme, small)
    # Followers are not bounded by the size check (one bag may have any number of
    # copies), so this join is left to AQE, which splits a leader with many of them.
    followers = bags.join(broadcast_if(small, leaders), "bag").select(key, "leader")
    return followers.join(_top(parts, k), "leader").select(key, "doc_id", "score", "rank")


def _weighted(index: Index, wanted: DataFrame, scheme: str, small: bool) -> DataFrame:
    """``(leader, term, df, weight, frequent)``. A word in all documents has weight 0 and is left out."""
    known = index.terms.select("term", "df").join(broadcast_if(small, wanted), "term")
    rows = known.select("leader", "term", "df", _weights(index, scheme).alias("weight"), (F.col("df") >= index.dense_from).alias("frequent"))
    return rows.filter("weight > 0")


def _all_parts(index: Index, wanted: DataFrame, k: int, scheme: str, small: bool) -> DataFrame:
    """``(leader, doc_id, tf, weight)``: all parts of the scores of documents that can be among the k best."""
    weighted = materialize(_weighted(index, wanted, scheme, small), "weighted")
    scarce = weighted.filter(~F.col("frequent")).drop("frequent")
    frequent = weighted.filter("frequent").drop("frequent")
    rare = _by_document(index, scarce.select("term").distinct(), scarce, ["term"], small, _tasks(scarce))
    if not frequent.limit(1).count():
        return rare
    rare = materialize(rare, "rare-parts")
    ranges = materialize(score_ranges(index, frequent, rare, k, small), "ranges")
    opened = frequent.join(broadcast_if(small, ranges.filter("open").select("leader", "rng")), "leader")
    whole = _by_document(index, opened.select("term", "rng").distinct(), opened, ["term", "rng"], small, _tasks(frequent))
    held = rare.groupBy("leader", "doc_id").agg(_score()).withColumn("rng", BM.range_of(F.col("doc_id")))
    held = held.join(broadcast_if(small, ranges.filter(~F.col("open"))), ["leader", "rng"])
    held = held.filter(F.col("score") + F.col("bound") + SLACK >= F.col("least")).select("leader", "doc_id")
    needed = held.join(broadcast_if(small, frequent), "leader").select("leader", "term", "doc_id", "weight")
    single = join_documents(index, needed, ["tf"]).select("leader", "doc_id", "tf", "weight")
    return rare.unionByName(whole).unionByName(single)


def range_share(index: Index, queries: DataFrame, k: int = 10, scheme: str = "tfidf", key: str = "query_id", text: str = "text") -> DataFrame:
    """``(postings, read)``: postings of the frequent words of a query table, and those in ranges that are read whole."""
    wanted = materialize(_bag_terms(query_bags(queries, key, text, index.profile).withColumnRenamed(key, "leader"), "leader"), "wanted")
    small = is_small(wanted)
    weighted = materialize(_weighted(index, wanted, scheme, small), "weighted")
    scarce, frequent = weighted.filter(~F.col("frequent")).drop("frequent"), weighted.filter("frequent").drop("frequent")
    rare = materialize(_by_document(index, scarce.select("term").distinct(), scarce, ["term"], small, _tasks(scarce)), "rare-parts")
    ranges = score_ranges(index, frequent, rare, k, small).select("leader", "rng", "open")
    sizes = join_bitmaps(index, frequent, small).select("leader", "rng", F.bitmap_count("bits").alias("n")).join(ranges, ["leader", "rng"])
    return sizes.agg(F.sum("n").alias("postings"), F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("read"))


def rank_presence_batch(
    index: Index, queries: DataFrame, k: int = 10, key: str = "query_id", text: str = "text"
) -> DataFrame:
    """Presence ranking for a table of queries: the k lowest ids with any query term.

    A query's k lowest documents are among the k lowest of each of its terms, so every
    term is cut to k rows, before its shuffle, ahead of the join with the queries.
    """
    wanted = materialize(_bag_terms(query_bags(queries, key, text, index.profile), key), "wanted")
    small = is_small(wanted)
    by_term = Window.partitionBy("term").orderBy("doc_id")
    lowest = (
        join_postings(index, wanted.select("term").distinct(), ["doc_id"], small)
        .withColumn("n", F.row_number().over(by_term))
        .filter(F.col("n") <= k)
    )
    by_query = Window.partitionBy(key).orderBy("doc_id")
    return (
        lowest.join(broadcast_if(small, wanted), "term")
        .select(key, "doc_id")
        .distinct()
        .withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select(key, "doc_id", F.lit(1.0).alias("score"), "rank")
    )
