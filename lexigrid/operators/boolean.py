"""Boolean retrieval: combinators for single queries, one plan for a table of queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.stem import stem
from lexigrid.functions.text import literal_tokens, tokens
from lexigrid.operators import bitmaps as BM
from lexigrid.operators.bitmaps import documents_of
from lexigrid.operators.lookup import join_bitmaps, join_postings, only_terms
from lexigrid.operators.phrase import match_phrases, match_words
from lexigrid.plans.session import broadcast_if, is_small, materialize
from lexigrid.sources.index_store import Index


@dataclass(frozen=True)
class Match:
    """A set of documents, or the complement of one.

    ``&``, ``|`` and ``~`` combine matches to any depth. NOT only flips a flag; the
    list of all documents is read once, and only if the final answer is a complement.
    """

    index: Index
    ids: DataFrame
    negated: bool = False

    def __invert__(self) -> Match:
        return Match(self.index, self.ids, not self.negated)

    def __and__(self, other: Match) -> Match:
        if self.negated and other.negated:
            return ~(~self | ~other)
        if self.negated:
            return other & self
        how = "left_anti" if other.negated else "left_semi"
        return Match(self.index, self.ids.join(other.ids, "doc_id", how))

    def __or__(self, other: Match) -> Match:
        if self.negated or other.negated:
            return ~(~self & ~other)
        return Match(self.index, self.ids.unionByName(other.ids).distinct())

    def documents(self) -> DataFrame:
        """Distinct ``doc_id``; sort when presenting."""
        if self.negated:
            return self.index.docs.join(self.ids, "doc_id", "left_anti")
        return self.ids

    def any_of(self, *others: Match) -> Match:
        """OR of several matches with one distinct at the end, however many there are."""
        if self.negated or any(o.negated for o in others):
            out = self
            for o in others:
                out = out | o
            return out
        ids = self.ids
        for o in others:
            ids = ids.unionByName(o.ids)
        return Match(self.index, ids.distinct())


def _none(index: Index) -> DataFrame:
    return index.postings.filter(F.lit(False)).select("doc_id")


def match_term(index: Index, text: str) -> Match:
    """Documents with the first token of ``text``; none for a stop word or unknown word."""
    found = literal_tokens(index.docs.sparkSession, text, index.profile)
    if not found:
        return Match(index, _none(index))
    return Match(index, only_terms(index, found[:1]).select("doc_id"))


def match_phrase(index: Index, text: str, mode: str = "pairwise") -> Match:
    """Documents with the phrase; an empty phrase matches nothing."""
    found = literal_tokens(index.docs.sparkSession, text, index.profile)
    if len(found) < 2:
        return match_term(index, text)
    return Match(index, match_words(index, found, mode))


def match_all(index: Index, texts: Sequence[str]) -> Match:
    """AND of several words in one aggregation, whatever their number or order."""
    spark = index.docs.sparkSession
    firsts = [literal_tokens(spark, t, index.profile)[:1] for t in texts]
    if not firsts or not all(firsts):
        return Match(index, _none(index))
    words = sorted({f[0] for f in firsts})
    ids = (
        only_terms(index, words)
        .groupBy("doc_id")
        .agg(F.count_distinct("term").alias("n"))
        .filter(F.col("n") == len(words))
        .select("doc_id")
    )
    return Match(index, ids)


def match_any(index: Index, texts: Sequence[str]) -> Match:
    """OR of several words: one scan, one distinct."""
    spark = index.docs.sparkSession
    words = sorted({w for t in texts for w in literal_tokens(spark, t, index.profile)[:1]})
    return Match(index, only_terms(index, words).select("doc_id").distinct())


def query_clauses(literals: DataFrame, profile: str = "plain") -> DataFrame:
    """Analyse ``(query_id, clause_id, literal_id, text, negated)`` into clause rows.

    A query is an OR of clauses, a clause an AND of literals, a literal a word or a
    phrase, possibly negated. A column ``phrase`` says which; where it is missing or NULL, a text
    of several pieces between white space is a phrase, as in :func:`match_phrase`. A word counts
    with its first token. One row per slot; a literal without tokens keeps one row with a NULL term.
    """
    ids = ["query_id", "clause_id", "literal_id", "negated"]
    is_phrase = F.col("text").rlike(r"(?U)[^\s\x1c-\x1f][\s\x1c-\x1f]+[^\s\x1c-\x1f]")
    if "phrase" in literals.columns:
        is_phrase = F.coalesce("phrase", is_phrase)
    found = literals.select(*ids, is_phrase.alias("phrase"), tokens(F.col("text")).alias("found"))
    words = F.when(F.col("phrase"), F.col("found")).otherwise(F.slice("found", 1, 1))
    rows = found.select(*ids, F.posexplode_outer(words).alias("slot", "term"))
    if profile == "porter":
        rows = stem(rows.withColumnRenamed("term", "token"), "token", "term").drop("token")
    return rows


def _weighted_literals(index: Index, clauses: DataFrame, small: bool) -> DataFrame:
    """Distinct ``(query_id, clause_id, negated, literal, words, df)``.

    ``literal`` is the words joined by a space; ``df`` bounds its number of documents:
    the smallest document frequency of its words, 0 when one is unknown.
    """
    known = index.terms.select("term", "df").join(broadcast_if(small, clauses.select("term")), "term", "left_semi")
    sized = clauses.join(broadcast_if(small, known), "term", "left")
    slot = F.when(F.col("term").isNotNull(), F.struct("slot", "term"))
    # Partitioned by clause once; both aggregations keep that partitioning.
    literals = (
        sized.repartition("query_id", "clause_id")
        .groupBy("query_id", "clause_id", "literal_id", "negated")
        .agg(
            F.sort_array(F.collect_list(slot))["term"].alias("words"),
            F.min(F.coalesce("df", F.lit(0))).alias("df"),
        )
        .withColumn("literal", F.array_join("words", " "))
    )
    return (
        literals.groupBy("query_id", "clause_id")
        .agg(F.collect_set(F.struct("negated", "literal", "words", "df")).alias("literals"))
        .select("query_id", "clause_id", F.inline("literals"))
    )


def match_literals(index: Index, literals: DataFrame, mode: str, small: bool, phrases: bool = True) -> DataFrame:
    """``(literal, doc_id)`` for distinct ``(literal, words)``."""
    one = literals.filter(F.size("words") == 1).select("literal", F.get("words", F.lit(0)).alias("term"))
    words = join_postings(index, one, ["doc_id"], small).select("literal", "doc_id")
    if not phrases:
        return words
    more = literals.filter(F.size("words") > 1).select(
        "literal", F.size("words").alias("n_slots"), F.posexplode("words").alias("slot", "term")
    )
    return words.unionByName(match_phrases(index, more, "literal", mode, small))


def _ways(index: Index, literals: DataFrame) -> DataFrame:
    """Literals with how they and their clause are answered; clauses that can't be met are left out.

    A ``wide`` literal is a word frequent enough to have bitmaps. A clause with a positive literal that is not wide
    starts from the documents of the rarest such one, its ``anchor``; the others have none and are answered by bitmaps.
    ``required`` counts a clause's positive literals.
    """
    wide = (F.size("words") == 1) & (F.col("df") > 0) & (F.col("df") >= index.dense_from)
    positive, whole = ~F.col("negated"), Window.partitionBy("query_id", "clause_id")
    marked = literals.withColumn("wide", wide).select(
        "*", F.count_if(positive).over(whole).alias("required"), F.count_if(positive & (F.col("df") == 0)).over(whole).alias("impossible"),
        F.min(F.when(positive & ~F.col("wide"), F.struct("df", "literal"))).over(whole)["literal"].alias("anchor"),
    )
    return marked.filter("impossible = 0").drop("impossible")


#: Queries of one row of a workload's copies, and literals and queries that are broadcast at a time.
PIECE, SLICE = 1_000, 2_000_000
#: Other positive and negated literals of a clause that are looked up by generated code.
FIRST_MUST, FIRST_NEVER = 3, 1


def _distinct_queries(literals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(leader, query_id, whole)`` of each distinct query, and ``(leader, queries)`` with the ids of its copies.

    ``whole`` lists the clauses, those that bitmaps answer first, then those with the most candidates: ``late`` is whether a clause
    has an ``anchor``, ``must`` and ``never`` are the ids of its other literals, the rarest of ``must`` and the most frequent
    of ``never`` first. Copies come in rows of about ``PIECE``.
    """
    start = ~F.col("negated") & (F.col("literal") == F.col("anchor"))
    other = ~F.col("negated") & F.coalesce(F.col("literal") != F.col("anchor"), F.lit(True))
    listed = lambda which, df: F.sort_array(F.collect_list(F.when(which & F.col("id").isNotNull(), F.struct(df.alias("df"), "id"))))["id"]
    rows = literals.groupBy("query_id", "clause_id").agg(
        F.max("required").alias("required"), F.max(F.when(start, F.struct("df", (F.size("words") > 1).alias("phrase"), "id"))).alias("start"),
        listed(other, F.col("df")).alias("must"), listed(F.col("negated"), -F.col("df")).alias("never"),
    )
    # Without a query or clause id only a clause of one positive literal is answered.
    named = F.col("query_id").isNotNull() & F.col("clause_id").isNotNull()
    rows = rows.filter(named | (F.col("start").isNotNull() & (F.col("required") == 1)))
    clause = F.struct(
        F.col("start").isNotNull().alias("late"), (-F.col("start.df")).alias("rank"), F.col("start.phrase").alias("phrase"),
        F.col("start.id").alias("anchor"), "must", F.when(named, F.col("never")).otherwise(F.slice("never", 1, 0)).alias("never"),
    )
    wholes = materialize(rows.groupBy("query_id").agg(F.sort_array(F.collect_set(clause)).alias("whole")), "queries")
    leaders = wholes.groupBy("whole").agg(F.min("query_id").alias("query_id"), F.count("*").alias("copies"))
    leaders = materialize(leaders.withColumn("leader", F.monotonically_increasing_id()), "leaders")
    piece = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("copies") / PIECE)).alias("piece")
    copies = wholes.join(leaders.select("whole", "leader", "copies"), "whole").groupBy("leader", piece)
    copies = copies.agg(F.collect_list(F.struct("query_id")).alias("queries")).select("leader", "queries")
    return leaders.select("leader", "query_id", "whole"), materialize(copies, "copies")


def match_batch(index: Index, clauses: DataFrame, mode: str = "pairwise") -> DataFrame:
    """``(query_id, doc_id)`` for a whole table of queries in disjunctive normal form.

    Equal queries are answered once, and each distinct literal is looked up once. A clause starts from the documents of its rarest
    literal; the others are looked up in the list of literals that the document holds (:func:`_met`). Clauses of frequent words or
    negations alone are combined as bitmaps, range by range, NOT being the complement inside the range. So literals' documents are
    shuffled once, whatever the number of clauses that mention them, and neither candidates nor results are shuffled or written.
    """
    clauses = materialize(clauses, "clauses")
    # All query-side tables below have at most as many rows and characters as this one.
    small = is_small(clauses)
    literals = materialize(_ways(index, _weighted_literals(index, clauses, small)), "literals")
    names = literals.filter("df > 0").select("literal", "words").distinct()
    names = materialize(names.withColumn("id", F.monotonically_increasing_id()), "names")
    literals = literals.join(broadcast_if(small, names.select("literal", "id")), "literal", "left")
    leaders, copies = _distinct_queries(literals)
    listed = leaders.select("leader", F.posexplode("whole").alias("earlier", "c")).select("leader", "earlier", "c.*")
    quick = (F.col("earlier") == 0) & (F.size("must") <= FIRST_MUST) & (F.size("never") <= FIRST_NEVER)
    listed = materialize(listed.withColumn("quick", quick), "distinct-clauses")
    # What the workload does not use is left out of the plans.
    used = listed.agg(
        F.max("late").alias("anchors"), F.max(~F.col("late")).alias("bits"), F.max(F.col("late") & F.col("quick")).alias("quick"),
        F.max(F.col("late") & ~F.col("quick")).alias("thorough"), F.sum(1 + F.size("must") + F.size("never")).alias("size"),
    ).first()

    # Clauses of bitmaps, under their query's leader.
    own = literals.filter(F.col("anchor").isNull()).join(broadcast_if(small, leaders.select("query_id", "leader")), "query_id")
    own = own.withColumn("query_id", F.col("leader"))
    rare = own.filter("negated and not wide and df > 0").select("id").distinct()
    rare_nots = used.bits and rare.limit(1).count() > 0
    # What a document has to be known to hold: the literals of all clauses of a query with an anchor.
    mixed = leaders.filter(F.exists("whole", lambda c: c["late"])).select(F.explode("whole").alias("c"))
    wanted = mixed.select(F.explode(F.concat(F.array("c.anchor"), "c.must", "c.never")).alias("id")).filter("id is not null").distinct()
    hits = None
    if used.anchors or rare_nots:
        sought = names.join(wanted.unionByName(rare).distinct(), "id", "left_semi").select(F.col("id").alias("literal"), "words")
        sought = materialize(sought, "sought")
        phrases = sought.filter(F.size("words") > 1).limit(1).count() > 0
        hits = match_literals(index, sought, mode, small or is_small(sought), phrases)
        if used.anchors and rare_nots:
            hits = materialize(hits, "hits")

    parts = []
    # Slices of about equal size, each broadcast: any workload fits, and no document's list is shuffled for it.
    slices = 1 + ((used.size or 0) + copies.agg(F.sum(F.size("queries")).alias("n")).first().n if used.size else 0) // SLICE
    cut = lambda rows, i: rows if slices == 1 else rows.filter(F.pmod(F.xxhash64("leader"), F.lit(slices)) == i)
    if used.anchors:
        found = hits.join(broadcast_if(small, wanted.withColumnRenamed("id", "literal")), "literal", "left_semi") if rare_nots else hits
        held = materialize(found.repartition("doc_id").groupBy("doc_id").agg(F.collect_set("literal").alias("held")), "held")
        late = listed.filter("late")
        for i in range(slices):
            parts += [(i, _met(held, cut(late.filter("quick"), i)))] if used.quick else []
            parts += [(i, _met(held, cut(late.filter("not quick"), i), cut(leaders, i)))] if used.thorough else []
    if used.bits or not parts:
        plan = own.select("query_id", "clause_id", "required").distinct()
        found = documents_of(_by_bits(index, plan, own.filter("df > 0"), hits if rare_nots else None, small), "query_id").withColumnRenamed("query_id", "leader")
        parts += [(i, cut(found, i)) for i in range(slices)]
    out = None
    for i, rows in parts:
        rows = rows.join(F.broadcast(cut(copies, i)), "leader").select(F.inline("queries"), "doc_id")
        out = rows if out is None else out.unionByName(rows)
    return out


def _met(held: DataFrame, clauses: DataFrame, leaders: DataFrame | None = None) -> DataFrame:
    """``(leader, doc_id)``: the documents that meet a clause and, given the whole queries, none that is listed before it.

    A document's literals bring the clauses that start from them; the clause's others are looked up in the same list. So a candidate
    is a row that is never moved, and a document comes once for a query, by the first of its clauses that it meets.
    """
    has = lambda literal: F.array_contains(F.col("held"), literal)
    rows = held.select("doc_id", "held", F.explode("held").alias("anchor")).join(F.broadcast(clauses), "anchor")
    for i in range(FIRST_MUST):
        rows = rows.filter(F.get("must", F.lit(i)).isNull() | has(F.get("must", F.lit(i))))
    for i in range(FIRST_NEVER):
        rows = rows.filter(F.get("never", F.lit(i)).isNull() | ~has(F.get("never", F.lit(i))))
    if leaders is not None:
        # These conditions are not generated code, so they read the clause from the second join's side and leave the first join alone.
        whole = lambda c: F.forall(c["must"], has) & ~F.exists(c["never"], has)
        met = lambda c: (c["anchor"].isNull() | has(c["anchor"])) & whole(c)
        rows = rows.join(F.broadcast(leaders.select("leader", "whole")), "leader").filter(whole(F.get("whole", F.col("earlier"))))
        rows = rows.filter(~F.exists(F.slice("whole", F.lit(1), F.col("earlier")), met))
    return rows.select("leader", "doc_id")


def _by_bits(index: Index, plan: DataFrame, literals: DataFrame, hits: DataFrame | None, small: bool) -> DataFrame:
    """``(query_id, rng, bits)`` of clauses of frequent words and negations: AND inside a clause, OR over clauses."""
    clause = ["query_id", "clause_id"]
    wide = literals.filter("wide").select(*clause, "negated", F.col("literal").alias("term"))
    free = plan.filter("required = 0").select(*clause, F.lit(False).alias("negated"), F.lit(BM.EVERY).alias("term"))
    bits = F.when(F.col("negated"), BM.complement(F.col("bits"))).otherwise(F.col("bits")).alias("bits")
    rows = join_bitmaps(index, wide.unionByName(free), small).select(*clause, "rng", (~F.col("negated")).cast("int").alias("held"), bits)
    if hits is not None:
        rare = literals.filter(~F.col("wide")).select(*clause, F.col("id").alias("literal"))  # all negated: a positive one would be an anchor
        found = BM.bitmaps_of(hits.join(broadcast_if(small, rare.select("literal").distinct()), "literal", "left_semi"), "literal")
        rows = rows.unionByName(
            found.join(broadcast_if(small, rare), "literal").select(*clause, "rng", F.lit(0).alias("held"), BM.complement(F.col("bits")).alias("bits"))
        )
    both = rows.groupBy(*clause, "rng").agg(F.bitmap_and_agg("bits").alias("bits"), F.sum("held").alias("held"))
    needed = plan.select(*clause, F.greatest("required", F.lit(1)).alias("required"))
    met = both.join(broadcast_if(small, needed), clause).filter("held = required")
    return met.groupBy("query_id", "rng").agg(F.bitmap_or_agg("bits").alias("bits"))
