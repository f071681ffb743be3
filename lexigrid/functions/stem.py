"""Porter's 1980 suffix-stripping algorithm as a chain of DataFrame columns.

Meant for a vocabulary (distinct words), not for every occurrence. One
``withColumn`` per step keeps each step a projection of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published word-form conditions as regular expressions.
# A y counts as a vowel after a consonant and as a consonant elsewhere.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
MEASURE_GT_0 = f"^(?:{CONSONANTS})?{VOWELS}{CONSONANTS}"
MEASURE_EQ_1 = f"^(?:{CONSONANTS})?{VOWELS}{CONSONANTS}(?:{VOWELS})?$"
MEASURE_GT_1 = f"^(?:{CONSONANTS})?{VOWELS}{CONSONANTS}{VOWELS}{CONSONANTS}"
HAS_VOWEL = f"^(?:{CONSONANTS})?[aeiouy]"
SHORT_SYLLABLE = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$"
DOUBLE_CONSONANT = "(?:bb|cc|dd|ff|gg|hh|jj|kk|ll|mm|nn|pp|qq|rr|ss|tt|vv|ww|xx|zz)$"

# Suffix tables of steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _ending(word: Column, suffixes) -> Column:
    """The longest of ``suffixes`` the word ends in, or an empty string."""
    return F.regexp_extract(word, "^.*?(" + "|".join(suffixes) + ")$", 1)


def _without(word: Column, ending: Column) -> Column:
    return F.left(word, F.length(word) - F.length(ending))


def _swap(ending: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*pairs), ending)


def stem(df: DataFrame, token: str, out: str) -> DataFrame:
    """Add column ``out``, the Porter stem of column ``token``."""
    w, e = F.col("_w"), F.col("_e")

    def step(df: DataFrame, value: Column) -> DataFrame:
        return df.withColumn("_w", value)

    df = df.withColumn("_w", F.col(token))
    # Step 1a: plurals.
    df = step(
        df,
        F.when(w.endswith("sses") | w.endswith("ies"), F.expr("left(_w, length(_w) - 2)"))
        .when(w.endswith("ss"), w)
        .when(w.endswith("s"), F.expr("left(_w, length(_w) - 1)"))
        .otherwise(w),
    )
    # Step 1b: -eed, -ed, -ing; a removed ending may call for a repair.
    df = df.withColumn("_e", _ending(w, ["eed", "ed", "ing"])).withColumn("_s", _without(w, e))
    s = F.col("_s")
    df = df.withColumn(
        "_cut", ((e == "ed") | (e == "ing")) & s.rlike(HAS_VOWEL)
    )
    df = step(
        df,
        F.when((e == "eed") & s.rlike(MEASURE_GT_0), F.concat(s, F.lit("ee")))
        .when(F.col("_cut"), s)
        .otherwise(w),
    )
    repaired = (
        F.when(w.rlike("(?:at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike(DOUBLE_CONSONANT) & ~w.rlike("[lsz]$"), F.expr("left(_w, length(_w) - 1)"))
        .when(w.rlike(SHORT_SYLLABLE), F.concat(w, F.lit("e")))
        .otherwise(w)
    )
    df = step(df, F.when(F.col("_cut"), repaired).otherwise(w))
    # Step 1c: final y.
    df = df.withColumn("_s", F.expr("left(_w, length(_w) - 1)"))
    df = step(df, F.when(w.endswith("y") & s.rlike(HAS_VOWEL), F.concat(s, F.lit("i"))).otherwise(w))
    # Steps 2 and 3: suffix tables, measure above 0.
    for table in (STEP_2, STEP_3):
        df = df.withColumn("_e", _ending(w, table)).withColumn("_s", _without(w, e))
        df = step(
            df,
            F.when((e != "") & s.rlike(MEASURE_GT_0), F.concat(s, _swap(e, table))).otherwise(w),
        )
    # Step 4: suffixes dropped, measure above 1; -ion only after s or t.
    df = df.withColumn("_e", _ending(w, STEP_4)).withColumn("_s", _without(w, e))
    allowed = s.rlike(MEASURE_GT_1) & ((e != "ion") | s.rlike("[st]$"))
    df = step(df, F.when((e != "") & allowed, s).otherwise(w))
    # Step 5: final e, then double l.
    df = df.withColumn("_s", F.expr("left(_w, length(_w) - 1)"))
    drop_e = s.rlike(MEASURE_GT_1) | (s.rlike(MEASURE_EQ_1) & ~s.rlike(SHORT_SYLLABLE))
    df = step(df, F.when(w.endswith("e") & drop_e, s).otherwise(w))
    df = step(
        df,
        F.when(w.endswith("ll") & w.rlike(MEASURE_GT_1), F.expr("left(_w, length(_w) - 1)")).otherwise(w),
    )
    return df.withColumn(out, F.when(F.length(token) <= 2, F.col(token)).otherwise(w)).drop(
        "_w", "_e", "_s", "_cut"
    )
