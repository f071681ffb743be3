"""Text analysis as Catalyst expressions: fold, clean, tokenise, drop stop words.

Everything here is a plain Column; nothing runs in Python workers.
"""

from __future__ import annotations

from functools import cache, lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Characters that survive cleaning. (?U) makes \s follow Unicode,
# and \x1c-\x1f are the separators that (?U) leaves out.
DELETED = r"(?U)[^a-z\s\x1c-\x1f]+"
WORD = "[a-z]+"


# Spark's default English stop words without the entries that hold an
# apostrophe, which cleaning makes unreachable.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very s
    t can will just don should now cannot could ought would
    """.split()
)


@cache
def _stop_literals() -> tuple[Column, ...]:
    """The words as literals, made once: each takes a call into the JVM."""
    return tuple(F.lit(w) for w in STOP_WORDS)


def clean(text: Column) -> Column:
    """Lower-case and delete (not blank out) all but a-z and whitespace."""
    return F.regexp_replace(F.lower(text), DELETED, "")


def words(text: Column) -> Column:
    """All words of a text, in order, stop words included.

    After cleaning only letters and whitespace are left, so taking the letter
    runs equals splitting on whitespace and needs no removal of empty strings.
    """
    return F.regexp_extract_all(clean(text), F.lit(WORD), F.lit(0))


def tokens(text: Column) -> Column:
    """Words without stop words; the array index is the token position.

    A NULL text has no tokens. The result is never NULL, which spares plans the
    null checks that would analyse each text a second time below a join or explode.
    """
    kept = F.filter(words(text), lambda w: ~w.isin(*_stop_literals()))
    return F.coalesce(kept, F.array().cast("array<string>"))


@lru_cache(maxsize=4096)
def literal_tokens(spark: SparkSession, text: str, profile: str = "plain") -> tuple[str, ...]:
    """Analyse one query text given as a Python string.

    The expression is the one used for documents. The input is a local one-row
    relation, which the optimizer evaluates itself, so no job starts. The words
    come back as Python values so that filters on them reach the Parquet scan.
    """
    from lexigrid.functions.stem import stem
    from lexigrid.plans.session import local_table

    one = local_table(spark, {"text": [text]}, "text string").select(tokens(F.col("text")).alias("t"))
    if profile == "porter":
        one = stem(one.select(F.posexplode("t").alias("pos", "token")), "token", "term")
        return tuple(r.term for r in sorted(one.collect(), key=lambda r: r.pos))
    return tuple(one.first().t)


def size_label(size: Column) -> Column:
    """Bytes as text with 1024 steps: ``512 Bytes``, ``1.50 KB``, ``2.00 GB``."""
    number = F.round(size_value(size), 2).cast("decimal(20,2)").cast("string")
    whole = size.cast("long").cast("string")
    return F.concat_ws(" ", F.when(size >= 1024.0, number).otherwise(whole), size_unit(size))


def size_value(size: Column) -> Column:
    """The number that goes with :func:`size_unit`."""
    return (
        F.when(size >= 1024.0**3, size / 1024.0**3)
        .when(size >= 1024.0**2, size / 1024.0**2)
        .when(size >= 1024.0, size / 1024.0)
        .otherwise(size.cast("double"))
    )


def size_unit(size: Column) -> Column:
    return (
        F.when(size >= 1024.0**3, "GB")
        .when(size >= 1024.0**2, "MB")
        .when(size >= 1024.0, "KB")
        .otherwise("Bytes")
    )
