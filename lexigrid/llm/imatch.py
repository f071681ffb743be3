"""I-Match document fingerprints, in DataFrame functions only.

Terms are the distinct lower-cased runs of letters and digits. The lexicon holds the terms whose document frequency
lies between ``LOW`` and ``HIGH`` of all documents, a band of inverse document frequency counted over the whole
table. It is split at random into ``SUBSETS`` subsets; for each, a document's terms are sorted and hashed, and the
hashes side by side are its fingerprint. Two fingerprints are alike by the share of equal hashes, where a subset
that neither document has a term of doesn't count.

The lexicon has a proven bound: every one of its terms lies in ``LOW`` of the documents, so there are at most
(mean distinct terms of a document) / LOW of them, whatever the number of documents. It is sent with the plan, as a
table from the low bits of a term's hash to the terms, so a lookup takes constant time and no row is shuffled.

Defined results: a null text is an empty one. A document with fewer than ``LEAST`` terms of the lexicon is
fingerprinted by all its terms. One without any term has an empty fingerprint, alike by 1 to another such one and by 0
to the rest. Repeated rows have equal fingerprints. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import columns
from lexigrid.plans.session import materialize

LOW, HIGH = 0.005, 0.05
SUBSETS, LEAST = 64, 4
#: A guard far above the bound for texts of a thousand distinct terms.
MAX_LEXICON = 1_000_000
NO_TERM = r"[^\p{L}\p{N}]+"
EMPTY = "-"
#: Documents to a bucket of the order, and the most buckets.
PER_BUCKET, MAX_BUCKETS = 2_000, 65_536


def terms(text: Column) -> Column:
    """The distinct terms of a text as 64-bit hashes."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_TERM), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """``(term, df)`` of the terms in the band; the counts cover all documents."""
    counts = docs.select(F.explode(terms(F.col(f"`{text}`"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    return counts.filter(F.col("df").between(max(2, math.ceil(low * n)), max(2, math.floor(high * n))))


def lookup(found: DataFrame) -> tuple[Column, int]:
    """The lexicon as a constant ``array<array<bigint>>``, by the low bits of the terms, and its size, a power of two."""
    got = [r.term for r in found.select("term").limit(MAX_LEXICON + 1).collect()]
    if len(got) > MAX_LEXICON:
        raise ValueError(f"a lexicon of more than {MAX_LEXICON} terms: raise the low end of the band")
    size = 1 << max(4, len(got).bit_length())
    table: list[list[int]] = [[] for _ in range(size)]
    for t in sorted(got):
        table[t & (size - 1)].append(t)
    return F.from_json(F.lit(json.dumps(table)), "array<array<bigint>>"), size


def banded(found: Column, known: Column, size: int) -> Column:
    """The sorted terms that are in the lexicon, or all terms where they are too few."""
    place = lambda h: F.get(known, h.bitwiseAND(F.lit(size - 1)).cast("int"))
    band = F.filter(found, lambda h: F.array_contains(place(h), h))
    return F.sort_array(F.when(F.size(band) >= LEAST, band).otherwise(found))


def subset_hashes(band: str) -> Column:
    """The hashes of the subsets of a column of sorted terms."""
    subset = lambda s: F.filter(F.col(band), lambda h: F.shiftright(h, 40).bitwiseAND(F.lit(SUBSETS - 1)) == s)
    hashed = lambda x: F.when(F.size(x) > 0, F.xxhash64(x))
    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(SUBSETS - 1).cast("long")), lambda s: hashed(subset(s)))


def fingerprint(slots: Column) -> Column:
    """The hashes as a string."""
    return F.array_join(F.transform(slots, lambda h: F.coalesce(F.hex(h), F.lit(EMPTY))), ":")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either has a term of; 1 where neither has any."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), None).otherwise(F.coalesce(x == y, F.lit(False))))
    counted = F.filter(both, lambda x: x.isNotNull())
    return F.when(F.size(counted) == 0, F.lit(1.0)).otherwise(F.size(F.filter(counted, lambda x: x)) / F.size(counted))


def slots(docs: DataFrame, known: Column, size: int, text: str) -> DataFrame:
    """``docs`` with a column ``slots``, the hashes of a text. Step by step, so that no array is computed twice."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(*own, terms(F.col(f"`{text}`")).alias("__terms"))
    df = df.select(*own, banded(F.col("__terms"), known, size).alias("__band"))
    return df.select(*own, subset_hashes("__band").alias("slots"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)`` of every row, by the lexicon of the table."""
    known, size = lookup(lexicon(docs, text))
    df = slots(columns(docs, key, text).toDF("__key", "__text"), known, size, "__text")
    return df.select(F.col("__key").alias(key), fingerprint(F.col("slots")).alias("fingerprint"))


def with_next(
    docs: DataFrame, key: str, order: list[str], carried: list[str], extend: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """``extend(docs)`` with ``next_<c>`` of the row that follows in descending order of key, the first after the last.

    The keys are dealt into buckets of about ``PER_BUCKET`` rows by their quantiles, and a window inside a bucket finds
    the next row. A copy of the first row of each bucket closes the bucket before it, so rows are shuffled once and
    no task sees more than its buckets. The first rows are found before ``extend`` adds its columns, and only they and
    the rows themselves are extended. Null keys come last. Rows with equal keys follow one another by ``order``.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType
    rows = docs.select(F.count("*").alias("n"), F.count(key).alias("keyed")).first()
    count = min(MAX_BUCKETS, max(1, math.ceil(rows.keyed / PER_BUCKET)))
    shares = [i / count for i in range(1, count)]
    edges = sorted(set(docs.approxQuantile(key, shares, 1 / (4 * count)))) if shares and rows.keyed else []
    steps = [1 << i for i in reversed(range(len(edges).bit_length()))]
    if edges:
        cuts, n = F.from_json(F.lit(json.dumps(edges)), "array<double>"), len(edges)
        further = lambda at, s: (at + s <= n) & (F.get(cuts, at + s - 1) <= F.col(key))
        bucket = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(further(at, s), at + s).otherwise(at))
    else:
        bucket = F.lit(0)
    docs = docs.withColumn("bucket", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(bucket)).withColumn("edge", F.lit(False))
    firsts = sorted(docs.groupBy("bucket").agg(F.max(key).alias("first")).collect(), key=lambda r: r.bucket)  # a row per bucket
    if not firsts:
        rows = extend(docs)
        return rows.select(*carried, *[F.lit(None).cast(rows.schema[c].dataType).alias(f"next_{c}") for c in carried]).limit(0)
    closes = [(r.bucket, r["first"], firsts[(i + 1) % len(firsts)].bucket) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(
        closes, T.StructType([T.StructField("b", T.IntegerType()), T.StructField("k", kind), T.StructField("to", T.IntegerType())])
    )
    met = docs.join(F.broadcast(heads), (F.col("bucket") == F.col("b")) & F.col(key).eqNullSafe(F.col("k")))
    # Among rows that share the first key, the first by the order.
    own = [c for c in docs.columns if c not in ("bucket", "edge")]
    struct = F.struct(*order, *[c for c in own if c not in order])
    head = met.groupBy("bucket", "to").agg(F.max(struct).alias("row"))
    # Written: a row per bucket, from a pass over keys and texts alone.
    copies = materialize(head.select(*[F.col("row").getField(c).alias(c) for c in own], F.col("to").alias("bucket"), F.lit(True).alias("edge")), "heads")
    desc = [F.col(c).desc_nulls_last() for c in order]
    w = Window.partitionBy("bucket").orderBy("edge", *desc)
    out = extend(docs).unionByName(extend(copies)).select("edge", *carried, *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return out.filter(~F.col("edge")).drop("edge")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text: its last half replaced by the first half's length of the next document.

    ``(key, n_chars, edited, slots, edited_slots, next_slots)``.
    """
    docs = columns(docs, key, text).toDF("key", "text").withColumn("text", F.coalesce("text", F.lit("")))
    known, size = lookup(lexicon(docs))
    near = with_next(docs, "key", ["key", "text"], ["key", "text", "slots"], lambda df: slots(df, known, size, "text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    changed = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    near = near.select("key", n.cast("long").alias("n_chars"), changed.alias("edited"), "slots", "next_slots")
    out = slots(near.withColumnRenamed("slots", "own_slots"), known, size, "edited")
    return out.select(
        F.col("key").alias(key), "n_chars", "edited", F.col("own_slots").alias("slots"), F.col("slots").alias("edited_slots"), "next_slots"
    )
