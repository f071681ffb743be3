"""Order-preserving packing: cut the token stream of a partition into windows by dynamic programming.

Documents keep the order in which their partition is read; the stream is cut at document ends, at sentence ends,
and, at a higher price, inside a sentence. A window of L tokens is padded to ``size``, unless L is a power of two.
The recurrence is f(j) = cut(j) + min f(i) + size - (p(j) - p(i)) over the cuts i that lie at most ``size`` tokens
back; f(i) + p(i) sits in a monotone queue, so a cut costs constant time. In each gap between two cuts, one inner
cut is offered as well: where the cheapest window that would be exactly full ends.

A task needs the memory of one segment of ``SEGMENT`` tokens and of the document at hand. What a segment leaves
open, its last window, moves on to the next segment. No row is shuffled. Sequence ids number the windows of a
partition behind the partition's number, so a task that runs again gives the same ids.

Defined results: a null text is an empty one and consists of the closing id alone. Repeated rows and null keys
are packed row by row. An empty table gives no piece. A sentence longer than a window is cut inside.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import broadcast_bytes, columns, driver_file

SIZE = 1024
SEGMENT = 1 << 18
#: Price of a cut in tokens of padding: at a sentence end, and inside a sentence. At a document end it is free.
SENTENCE_CUT, INNER_CUT = 1.0, 8.0
END_ID = 0
#: Chunks between spaces whose ids a worker remembers.
CACHE = 400_000

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ChunkTokenizer:
    """Byte-level BPE of whole texts by a ``tokenizers`` definition, remembering the ids of chunks between spaces.

    The pre-tokenizer never joins characters across a space that stands between two characters that are not white
    space; texts with other spaces are encoded in one go. The merges of a definition whose ids follow its merge
    order run several times faster in ``tiktoken``, with the same ids; any other definition runs in ``tokenizers``.
    """

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.decode())
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.merger = _merger(json.loads(definition))
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # ids whose text starts with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("Ġ")
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if self.merger is not None:
            return [np.array(self.merger.encode_ordinary(t), dtype=self.dtype).tobytes() for t in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _learn(self, new: list[str]) -> None:
        """Remember chunks that follow a space: encoded as one text, in which each starts with its space."""
        if not new:
            return
        ids = np.frombuffer(self._encode([" " + " ".join(new)])[0], dtype=self.dtype)
        at = np.flatnonzero(self.spaced[ids])
        if len(at) != len(new):
            self.later.update(zip(new, self._encode([f" {c}" for c in new])))
            return
        raw, width = ids.tobytes(), self.dtype.itemsize
        edges = [*(at * width).tolist(), len(raw)]
        self.later.update(zip(new, [raw[a:b] for a, b in zip(edges, edges[1:])]))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        if len(self.later) + len(self.first) > CACHE:
            self.first, self.later = {}, {}
        split = [t.split(" ") for t in texts]
        new = set().union(*[c[1:] for c in split]).difference(self.later)
        self._learn([c for c in new if c and not (c[0].isspace() or c[-1].isspace())])
        heads = {c[0] for c in split if len(c) == 1 or c[0] and not c[0][-1].isspace()}.difference(self.first)
        self.first.update(zip(heads, self._encode(list(heads))))
        later, first = self.later, self.first
        for text, chunks in zip(texts, split):
            try:
                raw = first[chunks[0]] + b"".join([later[c] for c in chunks[1:]])
            except KeyError:
                raw = self._encode([text])[0]
            yield np.frombuffer(raw, dtype=self.dtype)

    def sentence_ends(self) -> np.ndarray:
        """Per id, whether its text ends a sentence or a line."""
        ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token[-1] in ".!?" or token.endswith(("Ċ", "。"))
        return ends


# The byte alphabet of byte-level vocabularies and the usual pre-tokenizer pattern.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PLAIN} | {
    chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))
}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _merger(definition: dict):
    """The definition as ranked byte strings, or None where ranks would not give the same ids."""
    import tiktoken

    model, before = definition["model"], definition.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or definition.get("normalizer") or model.get("dropout") or model.get("byte_fallback"):
        return None
    special = {t["content"] for t in definition.get("added_tokens", [])}
    ids = model["vocab"]
    merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or merged and merged[0] != 256:
        return None
    ranks = {bytes(_BYTE_OF[c] for c in t): i for t, i in ids.items() if t not in special}
    return tiktoken.Encoding("bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def windows(cuts: np.ndarray, prices: np.ndarray, size: int = SIZE, inner: float = INNER_CUT) -> list[int]:
    """Where the windows end: the cheapest choice among the ascending ``cuts``, of which the last is taken.

    The stream starts at 0. Inner cuts are added in gaps as the module describes. A window is then split into
    powers of two where these cuts cost less than its padding.
    """
    at, cost, back = [0], [0.0], [-1]  # of each state: its position, its price, the state before it
    queue: deque[int] = deque([0])  # states by position, f + p ascending
    full = 0  # the first state that might end a full window in the gap at hand
    where = {0: 0}
    powers = [1 << k for k in range(5, size.bit_length() - 1)]

    def push(p: int, f: float, b: int) -> None:
        key = f + p
        while queue and cost[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(len(at))
        at.append(p)
        cost.append(f)
        back.append(b)

    for p, price in zip(cuts.tolist(), prices.tolist()):
        while True:
            # The cheapest full window that ends before p. Without it, a long gap could not be crossed.
            best, best_at = None, -1
            last = at[-1]
            while at[full] + size <= last:
                full += 1
            i = full
            while i < len(at) and at[i] + size < p:
                if best is None or cost[i] < best:
                    best, best_at = cost[i], i
                i += 1
            if best is None:
                break
            push(at[best_at] + size, best + inner, best_at)
            if p - at[-1] <= size:
                break
        while at[queue[0]] < p - size:
            queue.popleft()
        b = queue[0]
        f = cost[b] + size - p + at[b]
        for k in powers:
            i = where.get(p - k)
            if i is not None and cost[i] < f:
                f, b = cost[i], i
        where[p] = len(at)
        push(p, f + price, b)
    ends, i = [], len(at) - 1
    while i > 0:
        ends.append(at[i])
        i = back[i]
    out, start = [], 0
    for end in reversed(ends):
        length = end - start
        if size - length > inner * (length.bit_count() - 1):
            for k in reversed(range(length.bit_length())):
                if length >> k & 1:
                    start += 1 << k
                    out.append(start)
        else:
            out.append(end)
        start = end
    return out


class Packer:
    """Packs the documents of one partition; rows of pieces come out as segments are closed."""

    def __init__(self, sentence_ends: np.ndarray, first_id: int, size: int = SIZE):
        self.ends, self.next_id, self.size = sentence_ends, first_id, size
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int, int]] = []  # key, place in the stream, tokens, tokens already out
        self.length = 0

    def add(self, key: object, ids: np.ndarray) -> list[tuple]:
        whole = np.append(ids, ids.dtype.type(END_ID))
        rows: list[tuple] = []
        self.docs.append((key, self.length, len(whole), 0))
        for i in range(0, len(whole), SEGMENT):  # a very long document is cut into several segments
            part = whole[i : i + SEGMENT]
            self.ids.append(part)
            self.length += len(part)
            if self.length >= SEGMENT:
                rows += self.close(i + SEGMENT >= len(whole), False)
        return rows

    def close(self, doc_over: bool, last: bool) -> list[tuple]:
        """Pieces of all windows but the last, which stays open unless the partition is over."""
        if not self.length:
            return []
        stream = np.concatenate(self.ids)
        price = np.full(len(stream) + 1, INNER_CUT)
        inside = np.flatnonzero(self.ends[stream]) + 1
        price[inside] = SENTENCE_CUT
        places = np.array([p + n - done for _, p, n, done in self.docs if p + n - done <= len(stream)], dtype=np.int64)
        price[places] = 0.0
        cuts = np.union1d(np.union1d(inside, places), [len(stream)])
        ends = windows(cuts, price[cuts], self.size)
        keep = 0
        if not last:
            ends.pop()
            keep = len(stream) - (ends[-1] if ends else 0)
        rows = self._pieces(stream, ends)
        taken = len(stream) - keep
        self.ids, self.length = [stream[taken:]] if keep else [], keep
        moved = []
        for key, place, n, done in self.docs:
            if place + n - done > taken:
                out = max(0, taken - place)
                moved.append((key, max(0, place - taken), n, done + out))
        self.docs = moved
        return rows

    def _pieces(self, stream: np.ndarray, ends: list[int]) -> list[tuple]:
        raw = memoryview(stream.astype("<u4").tobytes())
        rows, start, d = [], 0, 0
        for end in ends:
            at = start
            while at < end:
                key, place, n, done = self.docs[d]
                stop = min(end, place + n - done)
                rows.append(
                    (key, done + at - place, stop - at, zlib.crc32(raw[4 * at : 4 * stop]), n, self.next_id, at - start)
                )
                if stop == place + n - done:
                    d += 1
                at = stop
            self.next_id += 1
            start = end
        return rows


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece: ``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
    sent = broadcast_bytes(docs.sparkSession, driver_file(tokenizer_path))
    docs = columns(docs, key, text)
    out = T.StructType([T.StructField(key, docs.schema[0].dataType)])
    for field in PIECES.split(", "):
        out.add(field.split(" ")[0], T.LongType())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _worker_tokenizer(sent)
        packer = Packer(tokenizer.sentence_ends(), TaskContext.get().partitionId() << 33, size)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                keys = part.column(0).to_pylist()
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [r for k, ids in zip(keys, tokenizer.encode(texts)) for r in packer.add(k, ids)]
                if rows:
                    yield _batch(rows, kind, out.names)
        if rows := packer.close(True, True):
            yield _batch(rows, kind, out.names)

    return docs.mapInArrow(task, out)


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    values = list(zip(*rows))
    arrays = [pa.array(values[0], kind)] + [pa.array(v, pa.int64()) for v in values[1:]]
    return pa.RecordBatch.from_arrays(arrays, names)


_TOKENIZERS: dict[int, ChunkTokenizer] = {}


def _worker_tokenizer(sent) -> ChunkTokenizer:
    """One tokenizer per worker process and definition, with its cache."""
    definition = sent.value
    known = hash(definition)
    if known not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[known] = ChunkTokenizer(definition)
    return _TOKENIZERS[known]


def padding(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``(sequences, tokens, padding)`` of packed pieces, by whole-table sums."""
    each = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(size - F.col("n"))
    return each.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padding"))
