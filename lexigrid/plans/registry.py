"""The registered queries: name -> function of (session, data folder).

Operators that build an index run on the documents. Operators that query one run on
an index that is written once per application and data folder; see :func:`index_of`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.text import tokens
from lexigrid.operators import boolean as B
from lexigrid.operators import lookup as L
from lexigrid.operators import phrase as PH
from lexigrid.operators import postings as P
from lexigrid.operators import ranking as R
from lexigrid.operators import workload as W
from lexigrid.operators.analysis import analyze, stem_vocabulary
from lexigrid.plans.build import build_from_blocks, build_index, changed_ranges
from lexigrid.plans.levels import add_documents
from lexigrid.plans.fixtures import boolean_literals, ranked_queries
from lexigrid.plans.session import PLAIN_TERMS, materialize, scratch_path, spread
from lexigrid.sources import index_store as S
from lexigrid.sources import results as RS
from lexigrid.sources.documents import read_checked, read_documents, read_literals, read_queries, read_table, sample
from lexigrid.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_INDEXES: dict[tuple, tuple[str, S.Index]] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _bytes(spark: SparkSession, sf_dir: str) -> int:
    return S.total_bytes(spark, _path(sf_dir, "documents"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``, spread over the cores when the file is small."""
    docs = read_documents(spark, _path(sf_dir, "documents"))
    return spread(docs, "doc_id", _bytes(spark, sf_dir))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark table as a query table: ``(query_id, text)``."""
    return read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def index_of(spark: SparkSession, sf_dir: str, profile: str = "plain") -> S.Index:
    """The stored index of a data folder, built at first use in an application."""
    return _stored(spark, sf_dir, profile)[1]


def index_path(spark: SparkSession, sf_dir: str, profile: str = "plain") -> str:
    """Where that index lies."""
    return _stored(spark, sf_dir, profile)[0]


def forget_indexes() -> None:
    """Make the next use build anew."""
    _INDEXES.clear()


def _stored(spark: SparkSession, sf_dir: str, profile: str) -> tuple[str, S.Index]:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), profile)
    if key not in _INDEXES:
        path = scratch_path(spark, f"index-{profile}", scoped=False)
        docs = read_documents(spark, _path(sf_dir, "documents"))
        _INDEXES[key] = path, build_index(docs, path, profile, input_bytes=_bytes(spark, sf_dir))
    return _INDEXES[key]


def joined(positions: str = "positions") -> F.Column:
    """Positions as text, for comparison across engines."""
    return F.array_join(F.col(positions).cast("array<string>"), " ").alias("positions")


# Text analysis and index construction: over the documents themselves.


@query
def analyze_tokens(spark, sf_dir):
    return analyze(documents(spark, sf_dir)).select("doc_id", F.col("pos").cast("int").alias("pos"), "term")


@query
def positional_postings(spark, sf_dir):
    return P.positional_postings(documents(spark, sf_dir)).select("term", "doc_id", joined())


@query
def tf_postings(spark, sf_dir):
    return P.tf_postings(documents(spark, sf_dir)).select("term", "doc_id", "tf", joined())


@query
def document_frequency(spark, sf_dir):
    return P.document_frequency(P.term_documents(documents(spark, sf_dir)))


@query
def corpus_stats(spark, sf_dir):
    return P.corpus_stats_from_documents(documents(spark, sf_dir))


@query
def term_dictionary(spark, sf_dir):
    terms = P.document_frequency(P.term_documents(documents(spark, sf_dir)))
    return P.term_dictionary(terms).select("term_id", "term", "df")


@query
def term_dictionary_append(spark, sf_dir):
    """Ids of benchmark words that the documents' dictionary lacks."""
    index = index_of(spark, sf_dir)
    new = P.term_documents(passages(spark, sf_dir), "query_id").select("term").distinct()
    return P.term_dictionary(new, index.terms).select("term_id", "term")


@query
def tfidf_index(spark, sf_dir):
    index = index_of(spark, sf_dir)
    rows = P.tfidf_index(S.weighted_postings(index), index.stats)
    return rows.select("term", "doc_id", "tf", "df", F.round("idf", 6).alias("idf"))


def _reingested(spark, sf_dir) -> str:
    """A folder of blocks of documents, and one later block that re-ingests ids with other texts."""
    order, last = F.floor(F.col("doc_id") / 500).alias("block_id"), F.lit(1_000_000_000).cast("long").alias("block_id")
    again = passages(spark, sf_dir).withColumnRenamed("query_id", "doc_id")
    rows = P.posting_rows(documents(spark, sf_dir), "doc_id", "text", order).unionByName(P.posting_rows(again, "doc_id", "text", last))
    rows = materialize(rows, "analyzed", **PLAIN_TERMS)
    listing = P.documents_in(rows, "block_id")  # of made-up blocks: no digests
    path = scratch_path(spark, "blocks")
    S.write_blocks(P.postings_in(rows, "block_id"), path, docs=listing)
    return path


@query
def merge_blocks(spark, sf_dir):
    blocks = _reingested(spark, sf_dir)
    merged = P.merge_blocks(S.read_blocks(spark, blocks), S.read_block_docs(spark, blocks))
    return merged.select("term", "doc_id", "tf", joined())


@query
def merge_blocks_to_tables(spark, sf_dir):
    """Blocks written and read back, merged, and stored as dictionary and postings."""
    index = build_from_blocks(spark, _reingested(spark, sf_dir), scratch_path(spark, "merged"))
    by_id = S.postings_by_id(index.postings)
    return by_id.select("term_id", "doc_id", "tf", joined())


@query
def merge_blocks_porter(spark, sf_dir):
    """The blocks merged into a stemmed index."""
    index = build_from_blocks(spark, _reingested(spark, sf_dir), scratch_path(spark, "merged-porter"), profile="porter")
    return index.postings.select("term", "doc_id", "tf", joined())


@query
def index_stats(spark, sf_dir):
    """Statistics as they are read from stored indexes: one-shot, stemmed, and merged after a re-ingest."""
    out = None
    stored = {
        "one shot": index_path(spark, sf_dir), "stemmed": index_path(spark, sf_dir, "porter"), "merged": scratch_path(spark, "stats"),
    }
    build_from_blocks(spark, _reingested(spark, sf_dir), stored["merged"])
    for name, path in stored.items():
        row = S.read_index(spark, path).stats.select(F.lit(name).alias("build"), "total_docs", "indexed_docs", "profile")
        out = row if out is None else out.unionByName(row)
    return out


@query
def index_load(spark, sf_dir):
    """Postings with the dictionary's ids and df, as a stored index is opened: one scan of one table."""
    index = S.read_index(spark, index_path(spark, sf_dir))
    return index.postings.select("term_id", "term", "doc_id", "tf", "df")


@query
def rejected_rows(spark, sf_dir):
    """Each document takes the text of the benchmark item of its id; most have none."""
    items = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    mixed = read_table(spark, sf_dir, "documents").select("doc_id").join(items, "doc_id", "left")
    return build_index(mixed, scratch_path(spark, "rejects")).rejects


@query
def rejected_postings(spark, sf_dir):
    """Stored postings of which some lost their positions and others have a wrong tf."""
    rows = index_of(spark, sf_dir).postings
    lost = F.when(F.length("term") != 2, F.col("positions"))
    wrong = F.when(F.col("tf") == 3, 4).otherwise(F.col("tf"))
    broken = rows.select("term", "doc_id", wrong.alias("tf"), lost.alias("positions"))
    return P.rejected_postings(broken).select("term", "doc_id", "reason")


@query
def index_violations(spark, sf_dir):
    """Passages indexed under document ids break both keys; the check must find all."""
    clean = P.tf_postings(documents(spark, sf_dir)).select("term", "doc_id")
    extra = P.tf_postings(passages(spark, sf_dir), "query_id").select("term", F.col("query_id").alias("doc_id"))
    return P.index_violations(index_of(spark, sf_dir).terms, clean.unionByName(extra))


@query
def read_sample(spark, sf_dir):
    """The first 500 documents as the reader's sample option takes them."""
    docs = read_documents(spark, _path(sf_dir, "documents"), sample_size=500)
    return docs.select("doc_id", F.length("text").alias("n_chars"))


@query
def index_freshness(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return S.freshness(index_of(spark, sf_dir), docs)


@query
def index_freshness_stale(spark, sf_dir):
    """Against the documents and the benchmark passages together, the index is stale."""
    docs = read_table(spark, sf_dir, "documents").select("text")
    return S.freshness(index_of(spark, sf_dir), docs.unionByName(passages(spark, sf_dir).select("text")))


@query
def index_changed_ranges(spark, sf_dir):
    """Against its own documents the index is fresh; with one changed text and as many documents, one range is not."""
    index, docs = index_of(spark, sf_dir), read_documents(spark, _path(sf_dir, "documents"))
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 77, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    out = None
    for name, now in (("same", docs), ("changed", changed)):
        rows = changed_ranges(index, now).withColumn("against", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def read_malformed(spark, sf_dir):
    """JSON lines of which those of every 50th document are cut off: what the reader keeps aside."""
    docs = read_documents(spark, _path(sf_dir, "documents"))
    line = F.to_json(F.struct("doc_id", "text"))
    cut = F.when(F.col("doc_id") % 50 == 0, F.substring(line, 1, 12)).otherwise(line)
    path = scratch_path(spark, "malformed")
    docs.select(cut.alias("value")).write.text(path)
    kept, rejects = read_checked(spark, path)
    return kept.select("doc_id", F.length("text").alias("n_chars"), F.lit(None).cast("string").alias("record")).unionByName(
        rejects.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("n_chars"), "record")
    )


@query
def sample_of_repeated_ids(spark, sf_dir):
    """The first 500 rows of documents that hold every id twice, once with its text and once with its language's name."""
    docs = read_table(spark, sf_dir, "documents")
    both = docs.select("doc_id", "text").unionByName(docs.select("doc_id", F.concat(F.lit(" "), F.coalesce("lang", F.lit("none"))).alias("text")))
    return sample(both, 501).select("doc_id", F.length("text").alias("n_chars"))


@query
def catalog_rank(spark, sf_dir):
    """An index saved as catalog tables, opened from them and searched."""
    base = f"lexigrid_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{scratch_path(spark, 'catalog')}'")
    S.save_tables(index_of(spark, sf_dir), f"{base}.idx")
    index = S.open_tables(spark, f"{base}.idx")
    return R.rank_batch(index, passages(spark, sf_dir))


@query
def rank_stored_queries(spark, sf_dir):
    """A ranked workload written as a JSON table and read back by its reader."""
    path = scratch_path(spark, "ranked-queries")
    passages(spark, sf_dir).select(F.col("query_id").cast("string").alias("query_id"), "text").write.json(path)
    return R.rank_batch(index_of(spark, sf_dir), read_queries(spark, path, "json"))


@query
def stored_postings(spark, sf_dir):
    """Postings as they come back from the clustered files."""
    return index_of(spark, sf_dir).postings.select("term", "doc_id", "tf", joined())


@query
def footprint(spark, sf_dir):
    """Per compression option: what is read back, and whether it takes room, and no more than without compression."""
    index = index_of(spark, sf_dir)
    out, plain = None, None
    for codec in ("none", "gzip", "zstd"):
        path = scratch_path(spark, f"codec-{codec}")
        S.write_postings(index.postings, path, index.buckets, codec)
        size = S.total_bytes(spark, path)
        plain = size if plain is None else plain
        row = spark.read.schema(S.STORED_POSTINGS).parquet(path).agg(
            F.count("*").alias("postings"), F.sum("tf").alias("occurrences")
        ).select(
            F.lit(codec).alias("codec"), "postings", "occurrences", F.lit(size > 0).alias("stored"), F.lit(size <= plain).alias("no_larger")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query
def stream_ingest(spark, sf_dir):
    """Two streams of several micro-batches fill one folder of blocks: the documents, and benchmark passages
    under negative ids; the index that the blocks give."""
    return _streamed(spark, sf_dir).postings.select("term", "doc_id", "tf", joined())


def _streamed(spark, sf_dir) -> S.Index:
    blocks = scratch_path(spark, "stream-blocks")
    shifted = passages(spark, sf_dir).select((-F.col("query_id") - 1).alias("doc_id"), "text")
    for name, docs in (("documents", read_documents(spark, _path(sf_dir, "documents"))), ("passages", shifted)):
        source = scratch_path(spark, f"stream-{name}")
        files = spark.sparkContext.defaultParallelism  # to a micro-batch, of which there are three
        docs.repartition(3 * files, "doc_id").write.parquet(source)
        ingest(spark, source, blocks, scratch_path(spark, "stream-state"), files_per_batch=files)
    return build_from_blocks(spark, blocks, scratch_path(spark, "streamed"))


@query
def stream_ingest_not(spark, sf_dir):
    """A complement over the streamed index: documents without tokens belong to it."""
    return (~B.match_term(_streamed(spark, sf_dir), "thth")).documents()


def _levelled(spark, sf_dir) -> S.Index:
    """An index of the documents, to which the benchmark passages are added twice: in place of the documents with their ids,
    and under negative ids."""
    path = scratch_path(spark, "levels")
    build_index(read_documents(spark, _path(sf_dir, "documents")), path, input_bytes=_bytes(spark, sf_dir))
    for doc_id in (F.col("query_id"), -F.col("query_id") - 1):
        added = passages(spark, sf_dir).select(doc_id.alias("doc_id"), "text")
        index = add_documents(added, path, compact_at=None)
    return index


@query
def levels_postings(spark, sf_dir):
    """Postings of an index to which documents were added twice, without rewriting what was there."""
    return _levelled(spark, sf_dir).postings.select("term", "doc_id", "tf", joined())


@query
def levels_rank(spark, sf_dir):
    """Ranking over three levels: frequencies and statistics added up."""
    return R.rank_batch(_levelled(spark, sf_dir), passages(spark, sf_dir))


# Lookup.


@query
def term_id_lookup(spark, sf_dir):
    return L.term_id(index_of(spark, sf_dir), "thth")


@query
def term_ids_lookup(spark, sf_dir):
    index = index_of(spark, sf_dir)
    return L.term_ids(index, analyze(passages(spark, sf_dir), "query_id"))


@query
def postings_lookup(spark, sf_dir):
    return L.postings_of_term(index_of(spark, sf_dir), "thth").select("term", "doc_id", "tf", joined())


@query
def postings_lookup_batch(spark, sf_dir):
    index = index_of(spark, sf_dir)
    return L.postings_of_terms(index, analyze(passages(spark, sf_dir), "query_id")).select(
        "term", "doc_id", "tf", joined()
    )


@query
def df_lookup(spark, sf_dir):
    return L.doc_freq(index_of(spark, sf_dir), "zygote")


@query
def df_lookup_zero_fill(spark, sf_dir):
    """df in the documents of every word of conversations, known or not."""
    talk = read_table(spark, sf_dir, "conversations")
    return L.doc_freqs(index_of(spark, sf_dir), analyze(talk, ["conv_id", "turn"]))


@query
def nested_postings(spark, sf_dir):
    index = index_of(spark, sf_dir)
    chosen = L.only_terms(index, ["thth", "thha", "erin"])
    nested = L.nested_postings(chosen)
    return L.flatten_postings(nested).select("term", "doc_id", "tf", joined())


# Boolean and phrase retrieval.


@query
def bool_term(spark, sf_dir):
    return B.match_term(index_of(spark, sf_dir), "thth").documents()


@query
def bool_and(spark, sf_dir):
    i = index_of(spark, sf_dir)
    return (B.match_term(i, "thth") & B.match_term(i, "thha")).documents()


@query
def bool_and3(spark, sf_dir):
    return B.match_all(index_of(spark, sf_dir), ["thth", "thha", "thble"]).documents()


@query
def bool_or(spark, sf_dir):
    i = index_of(spark, sf_dir)
    return (B.match_term(i, "thth") | B.match_term(i, "erin")).documents()


@query
def bool_any(spark, sf_dir):
    return B.match_any(index_of(spark, sf_dir), ["thth", "erin", "thly"]).documents()


@query
def bool_not(spark, sf_dir):
    return (~B.match_term(index_of(spark, sf_dir), "thth")).documents()


@query
def bool_not_stop_word(spark, sf_dir):
    return (~B.match_term(index_of(spark, sf_dir), "the")).documents()


@query
def bool_and_not(spark, sf_dir):
    i = index_of(spark, sf_dir)
    both = B.match_term(i, "thth") & B.match_term(i, "thha")
    return (both & ~B.match_term(i, "thble")).documents()


@query
def bool_nested(spark, sf_dir):
    i = index_of(spark, sf_dir)
    t = lambda w: B.match_term(i, w)
    left = t("thor") & (t("thly") | t("thing"))
    return (left | ~(t("thth") | B.match_phrase(i, "anea eriner")) & t("erin")).documents()


@query
def phrase_pairwise(spark, sf_dir):
    return B.match_phrase(index_of(spark, sf_dir), "de la de", "pairwise").documents()


@query
def phrase_strict(spark, sf_dir):
    return B.match_phrase(index_of(spark, sf_dir), "de la de", "strict").documents()


def _passage_slots(spark, sf_dir):
    return PH.phrase_slots(passages(spark, sf_dir), "query_id")


@query
def phrase_batch_pairwise(spark, sf_dir):
    """Documents for each benchmark passage, the whole passage taken as a phrase."""
    return PH.match_phrases(index_of(spark, sf_dir), _passage_slots(spark, sf_dir), "query_id", "pairwise")


@query
def phrase_batch_strict(spark, sf_dir):
    return PH.match_phrases(index_of(spark, sf_dir), _passage_slots(spark, sf_dir), "query_id", "strict")


@query
def bool_batch(spark, sf_dir):
    clauses = B.query_clauses(boolean_literals(spark))
    return B.match_batch(index_of(spark, sf_dir), clauses)


def _echo(spark, sf_dir) -> DataFrame:
    """``(query_id, words)``: of every document whose id is divisible by 50, its first two words and the first again."""
    docs = documents(spark, sf_dir).filter("doc_id % 50 = 0")
    words = docs.select(F.col("doc_id").alias("query_id"), tokens(F.col("text")).alias("t")).filter(F.size("t") > 1)
    return words.select("query_id", F.array(F.get("t", F.lit(0)), F.get("t", F.lit(1)), F.get("t", F.lit(0))).alias("words"))


def _echo_slots(spark, sf_dir):
    return PH.phrase_slots(_echo(spark, sf_dir).withColumn("text", F.array_join("words", " ")), "query_id")


@query
def phrase_table_pairwise(spark, sf_dir):
    """Phrases with a repeated word, from a table; pairwise they match more than strictly."""
    return PH.match_phrases(index_of(spark, sf_dir), _echo_slots(spark, sf_dir), "query_id", "pairwise")


@query
def phrase_table_strict(spark, sf_dir):
    return PH.match_phrases(index_of(spark, sf_dir), _echo_slots(spark, sf_dir), "query_id", "strict")


@query
def bool_table(spark, sf_dir):
    """A stored query table with phrases, negations and several clauses, read back by its reader:
    (phrase of the two words AND NOT the first passage's first word) OR both words and 'erin'."""
    words = _echo(spark, sf_dir).select(F.col("query_id").cast("string").alias("query_id"), "words")
    first, second = F.get("words", F.lit(0)), F.get("words", F.lit(1))
    pair = F.concat_ws(" ", first, second)
    literal = lambda c, i, text, phrase, negated: F.struct(
        F.lit(c).alias("clause_id"), F.lit(i).alias("literal_id"), text.alias("text"), F.lit(phrase).alias("phrase"), F.lit(negated).alias("negated")
    )
    rows = [
        literal(0, 0, pair, True, False), literal(0, 1, F.lit("thth"), False, True),
        literal(1, 0, first, False, False), literal(1, 1, second, False, False), literal(1, 2, F.lit("erin"), False, False),
    ]
    path = scratch_path(spark, "query-table")
    words.select("query_id", F.inline(F.array(*rows))).write.parquet(path)
    return B.match_batch(index_of(spark, sf_dir), B.query_clauses(read_literals(spark, path)))


@query
def bool_batch_passages(spark, sf_dir):
    """Documents that hold every word of a benchmark passage, for all passages."""
    words = analyze(passages(spark, sf_dir), "query_id")
    literals = words.select(
        "query_id", F.lit(0).alias("clause_id"), F.col("pos").alias("literal_id"),
        F.col("term").alias("text"), F.lit(False).alias("negated"),
    )
    return B.match_batch(index_of(spark, sf_dir), B.query_clauses(literals))


# Ranked retrieval.


@query
def rank_presence(spark, sf_dir):
    return R.rank_presence(index_of(spark, sf_dir), "thth erin")


@query
def rank_tf(spark, sf_dir):
    return R.rank(index_of(spark, sf_dir), "thth thha", 10, "tf")


@query
def rank_tfidf(spark, sf_dir):
    return R.rank(index_of(spark, sf_dir), "anea eriner thanea", 10, "tfidf")


@query
def rank_workload(spark, sf_dir):
    return R.rank_batch(index_of(spark, sf_dir), ranked_queries(spark))


@query
def rank_presence_batch(spark, sf_dir):
    return R.rank_presence_batch(index_of(spark, sf_dir), passages(spark, sf_dir))


@query
def rank_tf_batch(spark, sf_dir):
    return R.rank_batch(index_of(spark, sf_dir), passages(spark, sf_dir), 10, "tf")


@query
def rank_tfidf_batch(spark, sf_dir):
    return R.rank_batch(index_of(spark, sf_dir), passages(spark, sf_dir))


# Stemmed profile.


@query
def stem_words(spark, sf_dir):
    """Stem of every word of the documents."""
    return stem_vocabulary(index_of(spark, sf_dir).terms)


@query
def stem_postings(spark, sf_dir):
    return index_of(spark, sf_dir, "porter").postings.select("term", "doc_id", "tf", joined())


@query
def bool_porter(spark, sf_dir):
    i = index_of(spark, sf_dir, "porter")
    return (B.match_term(i, "ering") & ~B.match_phrase(i, "anea eriner")).documents()


@query
def bool_porter_phrase(spark, sf_dir):
    """A phrase of stems, over an index that is opened from its files."""
    i = S.read_index(spark, index_path(spark, sf_dir, "porter"))
    return B.match_phrase(i, "anea eriner").documents()


@query
def rank_tfidf_porter(spark, sf_dir):
    return R.rank_batch(index_of(spark, sf_dir, "porter"), passages(spark, sf_dir))


# Workload analytics over the query log (events) and the runs it holds.


def _log(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def _runs(spark, sf_dir, tails=False):
    return W.runs_from_log(_log(spark, sf_dir), tails=tails)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def latency_summary(spark, sf_dir):
    return _rounded(W.latency_summary(_log(spark, sf_dir), ["event_type"]), "avg", "p95", "p99")


@query
def latency_summary_null_keys(spark, sf_dir):
    """Groups with a NULL key keep their percentiles."""
    log = _log(spark, sf_dir).withColumn("kind", F.when(F.col("event_type") != "click", F.col("event_type")))
    return _rounded(W.latency_summary(log, ["kind"]), "avg", "p95", "p99")


@query
def latency_sketches(spark, sf_dir):
    """Sketches per day and event type, stored in two batches and merged without the log; whether their quantiles
    lie within the stated rank error of the log's."""
    log, points, path = _log(spark, sf_dir), {"p95": 0.95, "p99": 0.99}, scratch_path(spark, "sketches")
    odd = F.dayofmonth("ts") % 2 == 1
    for part in (log.filter(odd), log.filter(~odd)):
        W.latency_sketches(part, ["event_type"]).write.mode("append").parquet(path)
    summary = W.sketched_summary(spark.read.parquet(path), ["event_type"], points)
    errors = W.rank_errors(log, ["event_type"], "value", summary, points)
    off = errors.select("event_type", *[(F.col(p) <= W.SKETCH_ERROR).alias(p) for p in points])
    return _rounded(summary.select("event_type", "queries", "avg").join(off, "event_type"), "avg")


@query
def throughput(spark, sf_dir):
    ok = F.col("event_type") != "error"
    return _rounded(W.throughput(_log(spark, sf_dir), ["user_id"], ok=ok), "elapsed", "throughput")


@query
def size_label(spark, sf_dir):
    """Text volume per source and language with a readable label."""
    docs = read_table(spark, sf_dir, "documents")
    volume = docs.groupBy("source", "lang").agg(F.sum("n_chars").alias("bytes"))
    return W.with_size_label(volume)


@query
def run_results(spark, sf_dir):
    return _rounded(_runs(spark, sf_dir, tails=True), "avg", "p95", "p99", "throughput")


@query
def results_csv(spark, sf_dir):
    """Run results written as CSV and read back through coercion."""
    path = scratch_path(spark, "results")
    RS.write_results(_rounded(_runs(spark, sf_dir, tails=True), "avg", "p95", "p99", "throughput"), path)
    return RS.read_results(spark, path)


@query
def append_runs(spark, sf_dir):
    """Runs with metrics and failed runs, which have an error text instead."""
    log = _log(spark, sf_dir)
    good = log.filter("event_type != 'error'").groupBy("event_type", "user_id").agg(F.round(F.avg("value"), 6).alias("avg"))
    failed = log.filter("event_type = 'error'").select("event_type", "user_id", F.col("props").alias("run_error"))
    return W.append_runs(good, failed)


@query
def coerce_numeric(spark, sf_dir):
    """The last piece of ``props`` is a number in some rows and text in others."""
    cell = F.when(F.col("event_type") == "error", F.lit("#NAME?")).otherwise(
        F.regexp_extract("props", "([0-9]+)", 1)
    )
    cells = _log(spark, sf_dir).select("event_id", cell.alias("avg"))
    return RS.drop_incomplete(RS.coerce_numeric(cells, ["avg"]), ["avg"])


@query
def grid_gaps(spark, sf_dir):
    """Configurations without a run, per day and event type."""
    log = _log(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string"))
    return W.grid_gaps(W.tag_runs(log), ["day", "event_type"])


@query
def report_latency_by_mode(spark, sf_dir):
    return _rounded(W.latency_by_mode(_runs(spark, sf_dir)), "taat", "daat")


@query
def report_size_by_store(spark, sf_dir):
    return _rounded(W.size_by_store(_runs(spark, sf_dir)), "size")


@query
def report_skip_delta(spark, sf_dir):
    return _rounded(W.skip_delta(_runs(spark, sf_dir)), "none", "skip_pointers", "delta")


@query
def report_latency_throughput(spark, sf_dir):
    return _rounded(W.latency_vs_throughput(_runs(spark, sf_dir)), "avg", "throughput")


@query
def report_latency_footprint(spark, sf_dir):
    return _rounded(W.latency_vs_footprint(_runs(spark, sf_dir)), "avg")
