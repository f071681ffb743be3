"""Document bitmaps: sets of documents as bits by id range.

A row ``(term, rng, bits, max_tf)`` holds the documents of a term among ``RANGE`` consecutive ids in 4 kB, and the term's
greatest frequency in them. Rows exist for terms in
at least one of ``DENSE`` documents, where bits take less room than ids, and for all documents under the empty
term. AND, OR and NOT of frequent words then meet range by range, and no list of their documents is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids to a bitmap, which is what one of Spark's bitmap aggregates holds.
RANGE = 32_768
#: A term in one of so many documents has bitmaps. At most DENSE times the mean distinct terms of a document are such terms.
DENSE = 16
EVERY = ""


def range_of(doc_id: Column) -> Column:
    return F.floor(doc_id / RANGE)


def place_of(doc_id: Column) -> Column:
    return F.pmod(doc_id, F.lit(RANGE))


def dense_from(total_docs: int) -> int:
    """The least document frequency of terms that have bitmaps."""
    return -(-total_docs // DENSE)


def bitmaps_of(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    """``(key, rng, bits)`` from ``(key, doc_id)``, and more aggregates by range; copies of a row don't matter."""
    placed = rows.select("*", range_of(F.col("doc_id")).alias("rng"), place_of(F.col("doc_id")).alias("place"))
    return placed.groupBy(key, "rng").agg(F.bitmap_construct_agg("place").alias("bits"), *more)


def complement(bits: Column) -> Column:
    """All other places of the range, whether a document has them or not."""
    return F.unhex(F.translate(F.hex(bits), "0123456789ABCDEF", "FEDCBA9876543210"))


def holds(bits: Column, place: Column) -> Column:
    """Whether the bit of a place is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def documents_of(rows: DataFrame, key: str) -> DataFrame:
    """``(key, doc_id)`` back from ``(key, rng, bits)``."""
    digits = rows.select(key, "rng", F.posexplode(F.split(F.hex("bits"), "")).alias("i", "digit")).filter("digit <> '0'")
    table = F.array(*[F.array(*[F.lit(b) for b in range(4) if v >> b & 1]) for v in range(1, 16)])
    set_bits = F.get(table, F.instr(F.lit("123456789ABCDEF"), F.col("digit")) - 1)
    # A byte is written as its upper four bits, then its lower four.
    base = F.col("rng") * RANGE + F.floor(F.col("i") / 2) * 8 + F.when(F.col("i") % 2 == 0, 4).otherwise(0)
    return digits.select(key, base.alias("base"), F.explode(set_bits).alias("bit")).select(key, (F.col("base") + F.col("bit")).alias("doc_id"))
