"""Index construction: postings, document frequencies, dictionary, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions.stem import stem
from lexigrid.operators.analysis import tokenize
from lexigrid.plans.session import PLAIN_TERMS, broadcast_checked, join_words, materialize

POSTINGS_SCHEMA = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tf", T.IntegerType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
)


def _runs(tokenized: DataFrame) -> DataFrame:
    """Sort each document's tokens by (term, position) and mark where a term starts."""
    keep = [c for c in tokenized.columns if c != "tokens"]
    ordered = tokenized.select(
        *keep,
        F.sort_array(
            F.transform("tokens", lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
        ).alias("ordered"),
    )
    new_term = lambda t, i: (i == 0) | (t["term"] != F.get("ordered", i - 1)["term"])
    return ordered.select(
        *keep,
        "ordered",
        F.array_compact(
            F.transform("ordered", lambda t, i: F.when(new_term(t, i), i))
        ).alias("starts"),
    )


def analyzed(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """``(key, postings)``, and more columns: one row per document with its ``(term, tf, positions)``, sorted by term; empty without tokens.

    A document is one row, so its postings are grouped inside that row and the
    whole step is narrow: nothing is shuffled, however frequent a term is.
    """

    def one(start: Column, run: Column) -> Column:
        length = F.coalesce(F.get("starts", run + 1), F.size("ordered")) - start
        return F.struct(
            F.get("ordered", start)["term"].alias("term"),
            length.alias("tf"),
            F.slice("ordered", start + 1, length)["pos"].alias("positions"),
        )

    rows = _runs(tokenize(docs, [key, *more], text))
    return rows.select(*rows.columns[: 1 + len(more)], F.transform("starts", one).alias("postings"))


def postings_of(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(term, doc_id, tf, positions)`` from analysed documents.

    The outer explode keeps the optimizer from adding a filter that would analyse the texts twice.
    """
    return (
        documents.select(key, F.explode_outer("postings").alias("p"))
        .select("p.term", key, "p.tf", "p.positions")
        .filter(F.col("term").isNotNull())
    )


def posting_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """``(key, more columns, first, term, tf, positions)``: what :func:`analyzed` gives, one row per posting, for tables that are written.

    One row of every document is marked ``first``; a document without tokens has that row alone, with a NULL term. Runs are cut
    after the explode, by generated code, and a table of flat rows is scanned by column; there is no shuffle either.
    """
    rows = _runs(tokenize(docs, [key, *more], text))
    keep = rows.columns[: 1 + len(more)]
    rows = rows.select(*keep, "ordered", "starts", F.posexplode_outer("starts").alias("run", "start"))
    start = F.col("start")
    length = F.coalesce(F.get("starts", F.col("run") + 1), F.size("ordered")) - start
    return rows.select(
        *keep, (F.coalesce("run", F.lit(0)) == 0).alias("first"), F.get("ordered", start)["term"].alias("term"),
        length.alias("tf"), F.slice("ordered", start + 1, length)["pos"].alias("positions"),
    )


def postings_in(rows: DataFrame, *more: str) -> DataFrame:
    """``(term, doc_id, tf, positions)``, and more columns, from :func:`posting_rows`."""
    return rows.filter(F.col("term").isNotNull()).select(*POSTINGS_SCHEMA.names, *more)


def documents_in(rows: DataFrame, *more: str) -> DataFrame:
    """``(doc_id, has_tokens)``, and more columns, from :func:`posting_rows`."""
    return rows.filter("first").select("doc_id", F.col("term").isNotNull().alias("has_tokens"), *more)


def tf_postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(term, doc_id, tf, positions)``, without a shuffle."""
    return postings_of(analyzed(docs, key, text), key)


def positional_postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(term, doc_id, positions)``."""
    return tf_postings(docs, key, text).drop("tf")


def term_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct ``(term, doc_id)`` without tf and positions; narrow, too."""
    return (
        tokenize(docs, key, text)
        .select(F.explode_outer(F.array_distinct("tokens")).alias("term"), key)
        .filter(F.col("term").isNotNull())
    )


def _stemmed(postings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written postings of stems of one word and of stems of several, with ``term_id``, and the dictionary of stems.

    ``df`` of the former, and ``alone`` in the dictionary ``(term_id, term, words, alone)``, is that of the word.
    """
    tokens = document_frequency(postings.select("term")).withColumnRenamed("term", "token")
    stems = materialize(stem(tokens, "token", "term"), "stems")
    words = stems.groupBy("term").agg(F.count("*").alias("words"), F.max("df").alias("alone"))
    known = term_dictionary(words)
    stems = materialize(stems.join(known.drop("alone"), "term"), "stems")
    columns = [*POSTINGS_SCHEMA.names, "term_id"]
    rows = join_words(postings.withColumnRenamed("term", "token"), stems, "token")
    several = F.col("words") > 1
    rows = rows.select(*columns, F.when(~several, F.col("df")).alias("df"), F.when(several, F.col("token")).alias("token"), "words")
    rows = materialize(rows, "stemmed", **PLAIN_TERMS, **{"parquet.enable.dictionary#token": "false"})
    # A number for (term, document) that sorts before both: rows are ordered by comparing it alone, a term's side by side.
    number = F.shiftleft("term_id", 24).bitwiseOR(F.pmod("doc_id", F.lit(1 << 24))).alias("number")
    same = Window.partitionBy("number", "term", "doc_id").orderBy("token")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lists = rows.filter(several).select("*", number).select(
        "term", "doc_id", "term_id", F.sum("tf").over(whole).cast("int").alias("tf"), "positions",
        F.collect_list("positions").over(whole).alias("lists"), F.row_number().over(same).alias("i"),
    )
    positions = F.when(F.size("lists") > 1, F.sort_array(F.flatten("lists"))).otherwise(F.col("positions"))
    merged = lists.filter("i = 1").withColumn("positions", positions).select(*columns)
    return rows.filter("words = 1").drop("token", "words"), materialize(merged, "merged-stems", **PLAIN_TERMS), known


def stem_postings(postings: DataFrame) -> DataFrame:
    """Postings of stems from postings of plain words.

    Stop-word removal and positions come before stemming, so merging the words of
    a stem gives what stemming each token would give. Only the postings of stems with several words are
    shuffled by (term, document), whole and once; a stem of one word is renamed in place. The result is read from
    written tables.
    """
    single, merged, _ = _stemmed(postings)
    return single.select(*POSTINGS_SCHEMA.names).unionByName(merged.select(*POSTINGS_SCHEMA.names))


def numbered_stems(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`stem_postings` with ``term_id`` and ``df``, and the dictionary ``(term_id, term, df)``.

    Stems are known from the vocabulary, so their ids come with the join that stems the words. A stem of one word has that word's
    df; only postings of stems with several words are counted, and joined with these counts.
    """
    single, merged, known = _stemmed(postings)
    counts = materialize(merged.groupBy("term_id").agg(F.count("*").alias("df")), "stem-counts")
    terms = known.join(counts, "term_id", "left").select("term_id", "term", F.coalesce("df", "alone").alias("df"))
    return single.unionByName(join_words(merged, counts, "term_id")), terms


def term_frequency(positions: Column) -> Column:
    """tf from the position list."""
    return F.size(positions)


def document_frequency(term_docs: DataFrame) -> DataFrame:
    """``(term, df)`` from rows that are unique per (term, document)."""
    return term_docs.groupBy("term").agg(F.count("*").alias("df"))


def tfidf_index(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """Stored postings with ``idf = log10(N / df)`` of their term; ``df`` lies beside them, so nothing is joined."""
    total = stats.select("total_docs").scalar()
    return postings.withColumn("idf", F.log10(total / F.col("df")))


def corpus_stats(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """One row: ``total_docs`` (all documents) and ``indexed_docs`` (those with a token)."""
    indexed = postings.agg(F.count_distinct("doc_id").alias("n"))
    return docs.agg(F.count("*").alias("total_docs")).select(
        "total_docs", indexed.scalar().alias("indexed_docs")
    )


def stats_of(docs: DataFrame) -> DataFrame:
    """The same row from ``(doc_id, has_tokens)``; two counts that blocks of different documents add up."""
    return docs.agg(F.count("*").alias("total_docs"), F.count_if("has_tokens").alias("indexed_docs"))


def corpus_stats_from_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same row in one narrow pass over the texts, without a distinct."""
    return tokenize(docs, key, text).agg(
        F.count("*").alias("total_docs"),
        F.count_if(F.size("tokens") > 0).alias("indexed_docs"),
    )


def merge_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, has_tokens, digest)`` once per document, from those of all blocks.

    A merge keeps any block's terms; the digest is that of the latest block's text.
    """
    latest = F.max_by("digest", "block_id") if "block_id" in docs.columns else F.max_by("digest", "has_tokens")
    return docs.groupBy("doc_id").agg(F.max("has_tokens").alias("has_tokens"), latest.alias("digest"))


def text_digest(text: Column) -> Column:
    return F.xxhash64(text).alias("digest")


def range_digests(docs: DataFrame, width: int) -> DataFrame:
    """``(rng, docs, digest)`` per ``width`` consecutive ids, from ``(doc_id, digest)`` in any order."""
    own = F.xxhash64("doc_id", "digest")
    return docs.groupBy(F.floor(F.col("doc_id") / width).alias("rng")).agg(F.count("*").alias("docs"), F.bit_xor(own).alias("digest"))


def merge_blocks(blocks: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """One posting per (term, document) out of partial indexes; the later block wins.

    ``blocks`` has the postings columns and ``block_id``; a block holds a document once. ``docs`` lists the
    ``(doc_id, block_id)`` of all blocks; without it they are taken from the postings. Only documents
    found in several blocks are aggregated. All others pass through, so merging blocks of different
    documents shuffles no postings.
    """
    held = blocks.select("doc_id", "block_id").distinct() if docs is None else docs
    seen = held.groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = broadcast_checked(seen.filter("n > 1").select("doc_id"), "repeated")
    columns = POSTINGS_SCHEMA.names
    single = blocks.join(repeated, "doc_id", "left_anti").select(*columns)
    latest = (
        blocks.join(repeated, "doc_id", "left_semi")
        .groupBy("term", "doc_id")
        .agg(F.max_by(F.struct("tf", "positions"), "block_id").alias("p"))
        .select("term", "doc_id", "p.tf", "p.positions")
    )
    return single.unionByName(latest)


def term_dictionary(terms: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Dense ``term_id`` from 1 in term order for distinct terms; other columns stay.

    Terms are range-partitioned, sorted and written; the id is the number of rows in
    earlier files plus the row's index in its own file. Only one row per file is
    ever brought together. With ``known`` (``term_id, term``) only terms missing
    there get ids, which continue after the largest known one.
    """
    first_id = F.lit(1)
    if known is not None:
        terms = terms.join(known.select("term"), "term", "left_anti")
        first_id = known.agg(F.coalesce(F.max("term_id"), F.lit(0)) + 1).scalar()
    stored = materialize(
        terms.repartitionByRange("term").sortWithinPartitions("term"), "dictionary"
    )
    rows = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = rows.groupBy("file").agg(F.min("term").alias("low"), F.count("*").alias("n"))
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # One row per file, and files are as many as shuffle partitions: a configured bound.
    return rows.join(F.broadcast(offsets), "file").select(
        (F.col("offset") + F.col("row") + first_id).alias("term_id"), *terms.columns
    )


def split_valid(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rejected rows carry a ``reason``."""
    reason = F.when(F.col(key).isNull(), "null id").when(F.col(text).isNull(), "null text")
    marked = docs.withColumn("reason", reason)
    return (
        marked.filter(F.col("reason").isNull()).drop("reason"),
        marked.filter(F.col("reason").isNotNull()),
    )


def split_repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: of the rows of an id the one with the greatest text is kept; ``(doc_id, reason)`` per other row.

    Ids are counted without their texts; only the texts of repeated ids are compared.
    """
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    counts = broadcast_checked(counts, "repeated-ids")
    if not counts.limit(1).count():
        return docs, counts.select("doc_id", F.lit("repeated id").alias("reason"))
    kept = docs.join(counts, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    others = counts.select("doc_id", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))).alias("i"))
    return (
        docs.join(counts, "doc_id", "left_anti").select("doc_id", "text").unionByName(kept),
        others.select("doc_id", F.lit("repeated id").alias("reason")),
    )


def rejected_postings(postings: DataFrame) -> DataFrame:
    """Posting rows that lack a key or positions, or whose tf contradicts them."""
    reason = (
        F.when(F.col("term").isNull() | F.col("doc_id").isNull(), "null key")
        .when(F.col("positions").isNull(), "null positions")
        .when(F.col("tf") != F.size("positions"), "tf differs from positions")
    )
    return postings.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def index_violations(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """Rows ``(violation, term, doc_id)`` for every broken key of an index."""

    def rows(df: DataFrame, name: str, doc: Column) -> DataFrame:
        return df.select(F.lit(name).alias("violation"), "term", doc.cast("long").alias("doc_id"))

    no_doc = F.lit(None)
    # Written once: the postings, and what they are analysed from, are not read twice.
    keys = materialize(postings.groupBy("term", "doc_id").agg(F.count("*").alias("n")), "keys")
    words = terms.groupBy("term").agg(F.count("*").alias("n"))
    used = keys.select("term").distinct()
    return (
        rows(keys.filter("n > 1"), "duplicate posting", F.col("doc_id"))
        .unionByName(rows(words.filter("n > 1 and term is not null"), "duplicate term", no_doc))
        .unionByName(rows(words.filter("term is null"), "null term", no_doc))
        .unionByName(rows(used.join(words, "term", "left_anti"), "posting without term", no_doc))
    )
