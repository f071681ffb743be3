"""Rule bitmask ledger: every quality rule is evaluated once and stored as a bit beside its measurement.

A policy is a version name and a set of rules. Applying one, changing one and asking what a rule
contributes are bit operations on the ledger; no text is read again.

Defined results: a null text has no words, so it fails ``few_words``. Empty and blank texts likewise.
Repeated rows are judged row by row. An empty table gives an empty ledger. Only the key and the text
are read; other columns may have any name. Very long texts are measured whole: a row costs
O(n log n) in its words and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import columns

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rules in bit order. Measurements are compared as whole numbers, so that no rounding decides.
RULE_NAMES = ("few_words", "repeated_windows", "symbols", "repeated_lines", "stuttering", "long_words", "short_words")
BIT = {name: 1 << i for i, name in enumerate(RULE_NAMES)}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": RULE_NAMES,
}
PRODUCTION = "v2"


def mask_of(policy: str) -> int:
    """The bits of a policy."""
    return sum(BIT[r] for r in POLICIES[policy])


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutter)``, all exact.

    Words and windows are compared by 64-bit hashes inside one text. Only texts in which a
    window occurs twice go on to the positions of those windows.
    """
    whole = F.coalesce(F.col("__text"), F.lit(""))
    df = columns(docs, key, text).toDF("__key", "__text")
    df = df.select(
        "__key",
        F.array_remove(F.split(whole, SPACE), "").alias("words"),
        F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(NOT_SPACE)).alias("lines"),
        F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")).alias("n_symbols"),
    )
    df = df.select(
        "__key",
        "n_symbols",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
        F.size("words").alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    # Reading single elements costs nothing that depends on the length; slices inside a lambda would copy the array.
    windows = F.transform("hashed", lambda _, i: F.xxhash64(*[F.get("hashed", i + k) for k in range(WINDOW)]))
    windows = F.slice(windows, 1, F.col("n_words") - WINDOW + 1)
    kept = ["__key", "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    df = df.select(
        *kept,
        F.size(F.filter("hashed", lambda w, i: w == F.get("hashed", i - 1))).alias("n_stutter"),
        F.when(F.col("n_words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    kept.append("n_stutter")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(
        *kept,
        F.when(F.size("windows") > F.size(F.array_distinct("windows")), placed)
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("placed"),
    )

    def twice(p, i):
        before, after = F.get("placed", i - 1)["h"] == p["h"], F.get("placed", i + 1)["h"] == p["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    df = df.select(*kept, F.sort_array(F.transform(F.filter("placed", twice), lambda p: p["i"])).alias("at"))
    covered = F.transform("at", lambda p, i: F.least(F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    repeat = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    long = [F.col(c).cast("long").alias(c) for c in kept[1:]]
    # Always true, but not deterministic to the optimizer: a filter on the ledger must not be moved below these
    # projections, where it would measure the text anew for each step.
    fixed = F.when(F.spark_partition_id() >= 0, repeat.cast("long"))
    return df.select(F.col("__key").alias(key), *long, fixed.alias("n_repeat_words"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The measurements and ``failed``, the bits of the rules that a text fails."""
    n = F.col("n_words")
    fails = {
        "few_words": n < 10,
        "repeated_windows": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 40 * F.col("n_lines"),
        "stuttering": 100 * F.col("n_stutter") > 30 * n,
        "long_words": F.col("word_chars") > 20 * n,
        "short_words": F.col("word_chars") < 2 * n,
    }
    bits = [F.when(fails[r], F.lit(BIT[r])).otherwise(F.lit(0)) for r in RULE_NAMES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, key, text).withColumn("failed", total)


def keeps(failed: Column, policy: str = PRODUCTION) -> Column:
    """Whether a ledger row passes a policy."""
    return failed.bitwiseAND(F.lit(mask_of(policy))) == 0


def ablation(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """``(rule, n_failed, n_only)``: rows that fail a rule, and rows that only this rule of the policy rejects.

    The ledger is first counted by bit pattern, at most 2^rules groups, whatever the number of rows.
    """
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask_of(policy))).alias("m")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in POLICIES[policy]]))
    return (
        patterns.select("m", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def drop_rejected(docs: DataFrame, policy: str = PRODUCTION, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose text passes the policy, with all their columns.

    Rows carry themselves through the ledger as its key, so nothing is joined back.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kept = ledger(row, "row", "text").filter(keeps(F.col("failed"), policy))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
