"""Unigram pieces: vocabulary, Aho-Corasick counting, double-array trie encoding and decoding.

A vocabulary is a ``sentencepiece`` model file; its pieces and scores are read as a unigram language model. A text is
written with a space before it and with every space as U+2581. The best segmentation has the greatest sum of scores. Ties
are the tokenizer's: at each end, the piece with the earliest start wins, since a later one must be better. A character
that no one-character piece matches costs the least score less 10 and is spelled in byte pieces, where there are any.

No piece of such a vocabulary goes on past a U+2581 inside it, except pieces of several of them, and none has a letter
beside a sign; so a text splits before each U+2581 that follows another character and between letters and signs, and
the parts are solved one by one. Other vocabularies split at fewer places or not at all. Parts that come again are
remembered per worker, up to a bound.

Defined results: a null or empty text has no piece and score 0. Repeated rows are treated alike. Very long texts are
solved whole, part by part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexigrid.llm.common import broadcast_bytes, columns, driver_file

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Parts that a worker remembers in each of two generations, and the longest of them in characters.
CACHE, CACHED_LENGTH = 200_000, 64


@dataclass
class Vocabulary:
    """Pieces with scores; ids of bytes; the score of an unknown character."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]  # by byte; empty where the vocabulary has no byte pieces
    unknown: int
    normal: list[int] = field(default_factory=list)

    @classmethod
    def read(cls, model: bytes) -> "Vocabulary":
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        bytes_at = {int(pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        other = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        return cls(
            pieces,
            [sp.get_score(i) for i in range(n)],
            [bytes_at[b] for b in range(256)] if len(bytes_at) == 256 else [],
            sp.unk_id(),
            [i for i in range(n) if not other(i)],
        )

    def parts(self) -> re.Pattern | None:
        """The finest pattern of parts that no piece crosses; none if texts can't be split at all."""
        pieces = [self.pieces[i] for i in self.normal]
        odd = "".join(sorted({c for p in pieces for c in p if c.isalnum() and not (c.isalpha() or c.isdecimal())} | {"_"}))
        words = f"[^\\W{odd}]+|(?:[^\\w{SPACE}]|[{odd}])+"  # numerals and underscores go with the signs
        for run in (words, f"[^{SPACE}]+"):
            pattern = re.compile(f"{SPACE}*(?:{run})|{SPACE}+")
            if all(len(pattern.findall(p)) == 1 for p in pieces):
                return pattern
        return None

    def unknown_score(self) -> float:
        return min(self.scores[i] for i in self.normal) - UNKNOWN_PENALTY


def marked(text: str) -> str:
    """The text as the vocabulary sees it."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Parts:
    """Splits texts and remembers the answers for their parts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pattern = vocabulary.parts()
        self.split = pattern.findall if pattern else lambda t: [t] if t else []
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def solve(self, part: str):
        raise NotImplementedError

    def answers(self, text: str) -> list:
        """The answer for each part of a text."""
        known, out = self.known, []
        for part in self.split(marked(text)):
            got = known.get(part)
            if got is None:
                got = self.older.get(part)
                if got is None:
                    got = self.solve(part)
                if len(part) <= CACHED_LENGTH:
                    if len(known) >= CACHE:
                        self.older, self.known = known, {}
                        known = self.known
                    known[part] = got
            out.append(got)
        return out


class Counter(Parts):
    """Count-only Viterbi: an automaton lists the pieces that end at each place; only score and count are kept."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__(vocabulary)
        self.automaton = ahocorasick.Automaton()
        for i in vocabulary.normal:
            self.automaton.add_word(vocabulary.pieces[i], (len(vocabulary.pieces[i]), vocabulary.scores[i]))
        self.automaton.make_automaton()
        self.unknown_score = vocabulary.unknown_score()

    def solve(self, part: str) -> tuple[int, float]:
        """``(pieces, score)`` of the best segmentation."""
        n = len(part)
        best, count = [None] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        done = 0  # places up to here are final

        def close(place: int) -> None:
            """A place that no one-character piece reaches is reached by the unknown character as well."""
            start = place - 1
            if not single[place]:
                score = best[start] + self.unknown_score
                if best[place] is None or score > best[place]:
                    best[place] = score
                    count[place] = count[start] + (len(part[start].encode()) if self.vocabulary.byte_ids else 1)

        single = [False] * (n + 1)
        for end, (length, value) in self.automaton.iter(part):  # longest first at each end: ties stay with it
            end += 1
            while done < end - 1:
                done += 1
                close(done)
            start = end - length
            score = best[start] + value
            if length == 1:
                single[end] = True
            if best[end] is None or score > best[end]:
                best[end], count[end] = score, count[start] + 1
        while done < n:
            done += 1
            close(done)
        return count[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        got = self.answers(text or "")
        return sum(c for c, _ in got), float(sum(s for _, s in got))


class DoubleArray:
    """A double-array trie over the UTF-8 bytes of pieces: child of state s by byte b is ``base[s] + b + 1``."""

    def __init__(self, words: list[tuple[bytes, int]]):
        children: dict[bytes, list[int]] = {b"": []}
        for w, _ in words:
            for i in range(len(w)):
                head = w[: i + 1]
                if head not in children:
                    children[head] = []
                    children[w[:i]].append(w[i])
        values = dict(words)
        size = 4 * len(children) + 512
        base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        check[0] = 0
        place, free, wide = {b"": 0}, 1, 0  # single children fill gaps from the front, others go behind one another
        for head in sorted(children, key=lambda h: (len(h), -len(children[h]))):
            s = place[head]
            value[s] = values.get(head, -1)
            kids = np.array(sorted(children[head]), dtype=np.int64)
            if not len(kids):
                continue
            if len(kids) == 1:
                while check[free] >= 0 or free <= kids[0]:
                    free += 1
                at = free - int(kids[0]) - 1
            else:
                while (check[wide + kids + 1] >= 0).any():
                    wide += 1
                at = wide
            if max(at, free, wide) + 600 >= len(check):
                grown = len(check)
                base, check = np.append(base, np.zeros(grown, np.int64)), np.append(check, np.full(grown, -1))
                value = np.append(value, np.full(grown, -1))
            base[s] = at
            for b in kids.tolist():
                check[at + b + 1] = s
                place[head + bytes([b])] = at + b + 1
        # Plain lists are quicker to read one by one; a guard of a byte's width lets any child be looked up.
        self.base, self.check, self.value = base.tolist(), [*check.tolist(), *[-1] * 258], value.tolist()

    def prefixes(self, data: bytes, start: int) -> Iterator[tuple[int, int]]:
        """``(end, value)`` of every word that starts at a place, shortest first."""
        base, check, value, s = self.base, self.check, self.value, 0
        for i in range(start, len(data)):
            t = base[s] + data[i] + 1
            if check[t] != s or t == 0:
                return
            s = t
            if value[s] >= 0:
                yield i + 1, value[s]


class Codec(Parts):
    """Unigram encoding by Viterbi over the trie, with byte fallback, and decoding."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.unknown_score = vocabulary.unknown_score()
        self.bytes_of = [p.encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            self.bytes_of[i] = bytes([b])

    @cached_property
    def trie(self) -> DoubleArray:
        """The pieces; built by the first text to encode, so that decoding does without it."""
        return DoubleArray([(self.vocabulary.pieces[i].encode(), i) for i in self.vocabulary.normal])

    def solve(self, part: str) -> bytes:
        """The ids of the best segmentation, as 32-bit integers."""
        data, scores = part.encode("utf-8", "replace"), self.vocabulary.scores
        n, base, check, value, unknown = len(data), self.trie.base, self.trie.check, self.trie.value, self.unknown_score
        best: list[float | None] = [None] * (n + 1)
        back = [(0, -1)] * (n + 1)
        best[0], at = 0.0, 0
        while at < n:
            own, lead = best[at], data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single, s, end = False, 0, at
            while end < n:  # the pieces that start here, shortest first: a walk of ``DoubleArray.prefixes``
                t = base[s] + data[end] + 1
                if check[t] != s or not t:
                    break
                s, end = t, end + 1
                i = value[s]
                if i >= 0:
                    score = own + scores[i]
                    if best[end] is None or score > best[end]:
                        best[end], back[end] = score, (at, i)
                    single = single or end == at + width
            if not single:
                end, score = at + width, own + unknown
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (at, -1)
            at += width
        ids: list[int] = []
        while n:
            start, i = back[n]
            if i >= 0:
                ids.append(i)
            elif self.vocabulary.byte_ids:
                ids.extend(self.vocabulary.byte_ids[b] for b in reversed(data[start:n]))
            else:
                ids.append(self.vocabulary.unknown)
            n = start
        ids.reverse()
        return array("i", ids).tobytes()

    def packed(self, text: str | None) -> bytes:
        """The ids of a text, as 32-bit integers."""
        return b"".join(self.answers(text or ""))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """Bytes joined and space marks turned back; the space that was put before the text is taken off."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        text = data.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_MADE: dict[tuple, Parts] = {}


def _worker(kind: type[Parts], model: bytes) -> Parts:
    """One per worker process, kind and model."""
    known = (kind.__name__, hash(model))
    if known not in _MADE:
        _MADE.clear()
        _MADE[known] = kind(Vocabulary.read(model))
    return _MADE[known]


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, score)`` of every row."""
    sent = broadcast_bytes(docs.sparkSession, driver_file(model_path))
    docs = columns(docs, key, text)
    out = T.StructType([T.StructField(key, docs.schema[0].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker(Counter, sent.value)
        for batch in batches:
            got = [counter.count(t.as_py()) for t in batch.column(1)]
            arrays = [batch.column(0), pa.array([c for c, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return docs.mapInArrow(task, out)


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` of every row."""
    sent = broadcast_bytes(docs.sparkSession, driver_file(model_path))
    docs = columns(docs, key, text)
    out = T.StructType([T.StructField(key, docs.schema[0].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(Codec, sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                rows = [codec.packed(t.as_py()) for t in part.column(1)]
                places = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
                ids = np.frombuffer(b"".join(rows), dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], out.names)

    return docs.mapInArrow(task, out)


def decode(rows: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, ids, text)`` of every row of ids; null ids give an empty text. A U+2581 of the original comes back as a space."""
    sent = broadcast_bytes(rows.sparkSession, driver_file(model_path))
    rows = columns(rows, key, ids)
    out = T.StructType([rows.schema[0], rows.schema[1], T.StructField("text", T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(Codec, sent.value)
        for batch in batches:
            flat, places = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_pylist()
            known = batch.column(1).is_valid().to_pylist()
            texts = [codec.decode(flat[a:b].tolist()) if k else "" for a, b, k in zip(places, places[1:], known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], out.names)

    return rows.mapInArrow(task, out)
