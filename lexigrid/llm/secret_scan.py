"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty.

Patterns find assignments, access keys and hexadecimal runs. The novelty test looks at strings in a sensitive
context, a keyword within ``REACH`` characters before them: a compressor is primed with the identifier
dictionary and with the text around the string, other occurrences of the string taken out, and the bytes that
the string adds, less those that a known string of its length adds, are its marginal cost. Known words and identifiers
cost little; a string that costs ``NOVEL`` of its own length or more, mixes letters with digits and does not lie inside pattern spans is reported, whole.
A string is taken to its own end, however long; one of more than ``PART`` characters is also reported if a part of it costs as much.

Defined results: a null text is an empty one and has no spans. Repeated rows are scanned alike. Offsets are code
points of the whole text, ends exclusive. Spans sort by start, then by kind in the order of ``KINDS``. Very long
texts and strings are scanned whole; the context of one string is bounded by ``AROUND`` characters on either side.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import ship

KINDS = ("assign", "access", "hex", "novel")
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so a shorter run can hide no longer one
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SENSITIVE = re.compile(
    r"password|passwd|pwd|passphrase|secret|token|api[_-]?key|auth|bearer|credential|private[_-]?key|access[_-]?key|signature",
    re.IGNORECASE | re.ASCII,
)
SENSITIVE_WORDS = ("passw", "pwd", "passphrase", "secret", "token", "api", "auth", "bearer", "credential", "key", "signature")
LEAST = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
REACH, AROUND, PART, NOVEL = 48, 2048, 512, 0.35
#: Identifiers and words of code that are no secrets; the first part of every dictionary.
IDENTIFIERS = (
    "password username authorization authentication access_token refresh_token client_secret api_key private_key "
    "public_key session_id request response header content-type application/json x-www-form-urlencoded Bearer Basic "
    "config settings environment variable example placeholder changeme your-token-here localhost 127.0.0.1 0123456789 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ return function import export default true false null none"
).encode()


def novelty(text: str, start: int, end: int) -> float:
    """Marginal compressed bytes of a string beyond those of a known one as long, as a share of its own bytes."""
    own = text[start:end]
    around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).replace(own, " ")
    primer = zstandard.ZstdCompressionDict(
        IDENTIFIERS + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    press = zstandard.ZstdCompressor(
        level=19, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    raw = own.encode()
    known = IDENTIFIERS[: len(raw)]  # what the frame and one reference to the dictionary cost
    return (len(press.compress(raw)) - len(press.compress(known))) / len(raw)


def _costly(text: str, start: int, end: int) -> bool:
    """Whether a string is novel as a whole or, if it is long, in a part: a secret can lie in a long run of little novelty."""
    if novelty(text, start, end) >= NOVEL:
        return True
    cuts = list(range(start, end, PART))
    if len(cuts) > 1 and end - cuts[-1] < LEAST:
        cuts.pop()  # what is too short to be measured goes with the part before
    return len(cuts) > 1 and any(novelty(text, a, b) >= NOVEL for a, b in zip(cuts, [*cuts[1:], end]))


def scan(text: str | None) -> list[tuple[int, int, int, str]]:
    """``(start, rank, end, kind)`` of all spans, sorted."""
    if not text:
        return []
    spans = [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if any(w in low for w in SENSITIVE_WORDS):
        spans += _novel(text, spans)
    return sorted(spans)


def _novel(text: str, known: list[tuple]) -> list[tuple[int, int, int, str]]:
    found, done = [], 0
    starts, ends = [], []  # of the known spans, joined where they overlap
    for s, _, e, _ in sorted(known):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for word in SENSITIVE.finditer(text):
        # The end bounds where a string may begin, so that no text is searched twice; the string goes on to its own end.
        for m in CANDIDATE.finditer(text, max(done, word.end()), min(len(text), word.end() + REACH + LEAST)):
            start = m.start()
            done = end = CANDIDATE.match(text, start).end()
            own = text[start:end]
            if not (any(map(str.isdigit, own)) and any(map(str.isalpha, own))):
                continue
            before = bisect_left(starts, end) - 1
            if before >= 0 and starts[before] <= start and ends[before] >= end:
                continue
            if _costly(text, start, end):
                found.append((start, 3, end, "novel"))
    return found


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    spans = scan(text)
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def spans(text: Column) -> Column:
    """The spans of a text, sorted: ``array<struct<start, rank, end, kind>>``."""
    ship()

    @F.arrow_udf(SPANS)
    def udf(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        names = ("start", "rank", "end", "kind")
        return pa.array([[dict(zip(names, s)) for s in scan(t.as_py())] for t in texts], kind)

    return udf.asNondeterministic()(text)


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, spans)`` for every row."""
    return docs.select(F.col(f"`{key}`"), spans(F.col(f"`{text}`")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with their secrets replaced; ``length``, where that column exists, follows the new text."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def udf(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py()) for t in texts], pa.string())

    out = docs.withColumn(text, udf.asNondeterministic()(F.col(f"`{text}`")))
    if length not in docs.columns:
        return out
    return out.withColumn(length, F.char_length(F.col(f"`{text}`")).cast(docs.schema[length].dataType))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
