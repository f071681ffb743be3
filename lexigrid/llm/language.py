"""Language ID by error-correcting output codes.

Each language gets a codeword of bits. One binary n-gram classifier per bit, a naive Bayes log-odds table over
hashed letter trigrams, predicts that bit; the margins are decoded to the codeword with the least weighted
logistic loss. The gap between the best and the second language is taken as a share of the gap that the best one's own
trigrams give, which the counts tell without another pass. Text of one language lies near 1; below ``AMBIGUOUS``, where
texts of several languages, of none that was learned, and the held-out errors lie, it is flagged.

Learning counts the trigrams of all labelled rows where they lie: a task sends one row per language and bucket,
so what is summed has at most languages x ``BUCKETS`` rows, whatever the input. The label set must be small
(``MAX_LANGUAGES``, checked).

Defined results: a null, empty or letterless text is ``und`` with score 0, and is flagged. Without any labelled
text every text is ``und``. Rows with a null label, text or key are not learned from. Ties go to the label that
sorts first. Repeated rows are predicted alike. Very long texts are read whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import broadcast_bytes, ship

BUCKETS = 1 << 14
MAX_LANGUAGES = 500
#: Smoothing of a bucket's count, in occurrences.
PRIOR = 0.5
#: Share of the expected gap below which a prediction is flagged as ambiguous.
AMBIGUOUS = 0.25
#: Steepness of the logistic loss of a mean margin.
STEEPNESS = 4.0
UND = "und"

PREDICTION = "lang_pred string, score double, second string, gap double, ambiguous boolean"
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_BLANK = np.array([chr(i).isalpha() for i in range(128)])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def buckets_of(text: str) -> np.ndarray:
    """The hashed trigrams of a text; ASCII that is no letter counts as a blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    low = points < 128
    points = np.where(low & ~_BLANK[np.where(low, points, 0)], np.uint32(32), points)
    mixed = points[:-2] * _MULT[0] + points[1:-1] * _MULT[1] + points[2:] * _MULT[2]
    mixed ^= mixed >> np.uint32(15)
    return (mixed * _MULT[0]) >> np.uint32(32 - 14)


def codewords(n: int) -> np.ndarray:
    """Rows of +-1: the exhaustive code for up to six classes, beyond it the best of some random codes.

    Any two rows differ in at least half the columns of the exhaustive code.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, dtype=float).T
    width, best, best_gap = int(np.ceil(10 * np.log2(n))), None, -1
    rng = np.random.default_rng(17)
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        if np.abs(code.sum(axis=0)).max() == n:
            continue
        gap = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log-odds that the bit is set
    trust: np.ndarray  # bits: how far the classifier keeps its two sides apart
    expected: np.ndarray | None = None  # languages x languages: the gap to the second in text of the first

    def losses(self, text: str) -> np.ndarray:
        """Weighted logistic loss of each language's codeword."""
        counts = np.bincount(buckets_of(text), minlength=BUCKETS)
        return self.decoded(counts @ self.weights / max(1, counts.sum()))

    def decoded(self, margins: np.ndarray) -> np.ndarray:
        """The loss of each codeword for a mean margin per bit."""
        each = np.logaddexp(0.0, -STEEPNESS * self.code * margins)
        return each @ self.trust

    def predict(self, text: str | None) -> tuple:
        if not self.languages or not has_letter(text):
            return UND, 0.0, None, 0.0, True
        loss = self.losses(text)
        order = np.argsort(loss, kind="stable")
        score = float(1.0 / np.exp(loss[order[0]] - loss).sum())
        if len(order) == 1:
            return self.languages[0], score, None, 1.0, False
        gap = float((loss[order[1]] - loss[order[0]]) / max(1e-9, self.expected[order[0], order[1]]))
        return self.languages[order[0]], score, self.languages[order[1]], gap, gap < AMBIGUOUS


def fit(rows: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Learn from all rows with a label and a text."""
    ship(rows.sparkSession)
    rows = rows.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label"))
    rows = rows.filter("text is not null and label is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang in zip(batch.column(0), batch.column(1)):
                t = t.as_py()
                if has_letter(t):
                    own = counts.setdefault(lang.as_py(), np.zeros(BUCKETS, dtype=np.int64))
                    own += np.bincount(buckets_of(t), minlength=BUCKETS)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])],
                ["label", "bucket", "n"],
            )

    sums = rows.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = sums.limit(MAX_LANGUAGES * BUCKETS + 1).toArrow()
    languages = sorted(set(found.column("label").to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    counts = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[[place[x] for x in found.column("label").to_pylist()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return train(languages, counts)


def train(languages: list[str], counts: np.ndarray) -> Model:
    """One naive Bayes table per bit; a bit's sides weigh their languages equally."""
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, code.shape[1] if languages else 1)), np.ones(code.shape[1]))
    share = (counts + PRIOR) / (counts + PRIOR).sum(axis=1, keepdims=True)
    weights = np.empty((BUCKETS, code.shape[1]))
    for b in range(code.shape[1]):
        on = code[:, b] > 0
        weights[:, b] = np.log(share[on].mean(axis=0)) - np.log(share[~on].mean(axis=0))
    apart = (code * (share @ weights)).min(axis=0)
    trust = np.maximum(apart, 1e-6)
    model = Model(languages, code, weights, trust / trust.sum())
    own = np.array([model.decoded(s @ weights) for s in share])
    model.expected = own - np.diag(own)[:, None]
    return model


def predict(text: Column, spark, model: Model) -> Column:
    """The prediction of a text as a struct column; see ``PREDICTION``."""
    sent = broadcast_bytes(spark, model)

    @F.arrow_udf(PREDICTION)
    def udf(texts: pa.Array) -> pa.Array:
        m = sent.value
        got = list(zip(*[m.predict(t.as_py()) for t in texts])) or [[]] * 5
        kinds = (pa.string(), pa.float64(), pa.string(), pa.float64(), pa.bool_())
        names = ("lang_pred", "score", "second", "gap", "ambiguous")
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(got, kinds)], names)

    return udf.asNondeterministic()(text)  # so that a later filter doesn't make it run twice


def held_out(key: Column) -> Column:
    """Rows kept out of learning: a quarter, by the checksum of the key. A null key is not held out, nor learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame, key: str = "doc_id") -> Model:
    """Fit on the documents that are not held out."""
    return fit(docs.filter(F.col(f"`{key}`").isNotNull() & ~held_out(F.col(f"`{key}`"))))
