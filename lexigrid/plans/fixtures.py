"""Query workloads given as data: a query is an id, its clauses and its ranked form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexigrid.plans.session import local_table

# The benchmark's query set. A query lists its clauses (OR), a clause its
# literals (AND), a leading "-" negates, and a literal with a space is a phrase.
BENCHMARK = {
    "q01": ([["history"]], "history"),
    "q02": ([["science"]], "science"),
    "q03": ([["anarchism"]], "anarchism"),
    "q04": ([["philosophy"]], "philosophy"),
    "q05": ([["thermonuclear astrophysics"]], "thermonuclear astrophysics"),
    "q06": ([["zygote"]], "zygote"),
    "q07": ([["art", "history"]], "art history"),
    "q08": ([["war", "united", "state"]], "war united state"),
    "q09": ([["world", "war"]], "world war"),
    "q10": ([["computer"], ["science"]], "computer science"),
    "q11": ([["language"], ["linguistics"]], "language linguistics"),
    "q13": ([["art", "history"], ["science"]], "art history science"),
    "q14": ([["language", "syntax"], ["language", "grammar"]], "language syntax grammar"),
    "q15": ([["world", "war", "-nuclear"]], "world war nuclear"),
    "q16": ([["albedo effect"]], "albedo effect"),
    "q17": ([["quantum entanglement"]], "quantum entanglement"),
    "q18": ([["theory of relativity"]], "theory of relativity"),
    "q19": ([["political", "philosophy"]], "political philosophy"),
    "q20": ([["ancient", "greek", "mythology"]], "ancient greek mythology"),
}

# The same shapes over words that occur in the test corpus, and the cases that the
# query set leaves out (complements, stop words, repeated words in a phrase).
SHAPES = {
    "s01": ([["thth"]], "thth"),
    "s06": ([["zygote"]], "zygote"),
    "s07": ([["thth", "thha"]], "thth thha"),
    "s08": ([["thth", "thha", "thble"]], "thth thha thble"),
    "s10": ([["thth"], ["erin"]], "thth erin"),
    "s13": ([["thth", "thha"], ["erin"]], "thth thha erin"),
    "s14": ([["thor", "thly"], ["thor", "thing"]], "thor thly thing"),
    "s15": ([["thth", "thha", "-thble"]], "thth thha thble"),
    "s16": ([["anea eriner"]], "anea eriner"),
    "s18": ([["attion thanedble anea"]], "attion thanedble anea"),
    "s20": ([["-thth"]], "the of and"),
    "s21": ([["-the"]], "the"),
    "s22": ([["the"]], "anea eriner thanea"),
    "s23": ([["de la de"]], "de la de"),
    "s24": ([["der die der", "-thth"], ["erin"]], "der die der"),
    "s25": ([["-erin", "-thth"], ["anea", "-de la de"]], "erin erin thth"),
}

WORKLOAD = {**BENCHMARK, **SHAPES}


def ranked_queries(spark: SparkSession, workload=WORKLOAD) -> DataFrame:
    """``(query_id, text)``."""
    columns = {"query_id": list(workload), "text": [text for _, text in workload.values()]}
    return local_table(spark, columns, "query_id string, text string")


def boolean_literals(spark: SparkSession, workload=WORKLOAD) -> DataFrame:
    """``(query_id, clause_id, literal_id, text, negated)``."""
    rows = [
        (q, c, i, literal.lstrip("-"), literal.startswith("-"))
        for q, (clauses, _) in workload.items()
        for c, clause in enumerate(clauses)
        for i, literal in enumerate(clause)
    ]
    names = ("query_id", "clause_id", "literal_id", "text", "negated")
    return local_table(
        spark,
        dict(zip(names, map(list, zip(*rows)))),
        "query_id string, clause_id int, literal_id int, text string, negated boolean",
    )
