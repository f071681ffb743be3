"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles. Sets are embedded as ``SKETCH`` minhash tokens, so that two sets
share a token at a given place with the probability of their Jaccard similarity. A run splits all sets by tokens
sampled for the root path, and splits every bucket that is still larger than ``LEAF`` by tokens sampled for its own
path, to ``DEPTH`` levels. Buckets are then compared by brute force, in blocks where they are large. Runs are
repeated until a pair at the threshold is found with probability ``RECALL`` or more.

What the runs find are loose groups: sketches that agree in ``LOOSE`` of their places. The texts of loose groups, and
only these, are read again; inside a group every pair is compared exactly, once, by products of incidence
matrices, block by block. So links are counted without listing pairs, and classes are the components of exact links.

Words are runs of characters other than ASCII white space, lower-cased; a text of fewer than five words is one
shingle. Words and shingles are compared by 64-bit hashes.

Defined results: a null, empty or blank text has no shingles, no links and a class of its own. Rows with equal sets,
repeated rows and repeated keys included, are one class and link to each other. A class is named by its least
key; null keys count only where a class has no other. Very long texts are hashed whole, in bounded blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import columns, ship
from lexigrid.llm.graph import components
from lexigrid.plans.session import broadcast_checked, materialize

WORDS, THRESHOLD = 5, Fraction(4, 5)
SKETCH, LOOSE = 64, 0.6
LEAF, BLOCK, DEPTH, RECALL = 256, 256, 3, 0.999
#: Tokens sampled per path: one, and a second one for a quarter of the paths, 1 / threshold on average.
SECOND = 4
COLUMNS = 4096  # of an incidence matrix at a time
SHINGLES = 4096  # that count as a row of a block
HASH_BLOCK = 1 << 20  # bytes of text hashed at a time

_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_R, HASH_BLOCK + 1), _powers(pow(_R, -1, 1 << 64), HASH_BLOCK + 1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(29)
_A = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64) * _U(2) + _U(1)
_B = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word, block by block; a word longer than a block goes on in the next, hashed as several."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + HASH_BLOCK)
        if stop < len(data):
            blanks = np.flatnonzero(_BLANK[data[at:stop]])
            stop = at + int(blanks[-1]) + 1 if len(blanks) else stop
        part = data[at:stop]
        blank = np.concatenate([[True], _BLANK[part], [True]])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.concatenate([[_U(0)], np.cumsum((part.astype(np.uint64) + _U(1)) * _UP[: len(part)])])
        out.append(_mix((total[end] - total[start]) * _DOWN[start] + (end - start).astype(np.uint64)))
        at = stop
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = word_hashes(text or "")
    n = max(1, len(words) - WORDS + 1) if len(words) else 0
    h = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(words))):
        h = _mix(h * _U(_R) + words[k : k + n])
    return np.unique(h)


def sketch(found: np.ndarray) -> np.ndarray:
    """Minhash tokens, 32 bits each."""
    low = np.full(SKETCH, 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(found), 1024):
        low = np.minimum(low, ((found[i : i + 1024, None] * _A + _B) >> _U(32)).min(axis=0))
    return low.astype("<u4")


def node_of(found: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame) -> DataFrame:
    """``(key, node, sketch, n_shingles)``, and what follows key and text; node is null where there are no shingles."""
    more = docs.schema.fields[2:]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, tokens, sizes = [], [], []
            for t in batch.column(1):
                found = shingles(t.as_py())
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                tokens.append(sketch(found).tobytes() if len(found) else None)
            found = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(tokens, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(found + batch.columns[2:], out.names)

    out = T.StructType([T.StructField("key", docs.schema[0].dataType), T.StructField("node", T.LongType())])
    out.add("sketch", T.BinaryType()).add("n_shingles", T.LongType())
    for field in more:
        out.add(field)
    return docs.mapInArrow(task, out)


def runs_for(recall: float = RECALL, threshold: Fraction = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a leaf of full depth with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - float(threshold) ** depth))


def _split(df: DataFrame, level: int) -> DataFrame:
    """The children of every ``(path, node, sketch)``: one row per token sampled for the path."""
    place = lambda salt: F.pmod(F.xxhash64("path", F.lit(salt)), F.lit(SKETCH)).cast("int")
    token = lambda at: F.xxhash64("path", at, F.expr("sketch").substr(at * 4 + 1, F.lit(4)))
    second = F.pmod(F.xxhash64("path", F.lit(3 * level + 2)), F.lit(SECOND)) == 0
    paths = F.array(token(place(3 * level)), F.when(second, token(place(3 * level + 1))))
    return df.select("node", "sketch", F.explode(F.array_compact(paths)).alias("path"))


def _shared(df: DataFrame) -> DataFrame:
    """Rows whose path has two nodes or more, with that number. Counted by name first, so the rows join a written table."""
    sizes = materialize(df.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "path-sizes")
    return df.join(sizes, "path")


def leaves(nodes: DataFrame, runs: int) -> DataFrame:
    """``(path, node, sketch, n)``: the buckets of all runs that are small, or as deep as they go."""
    roots = F.explode(F.array(*[F.xxhash64(F.lit(r)) for r in range(runs)])).alias("path")
    level, done = nodes.select("node", "sketch", roots), []
    for depth in range(DEPTH):
        paths = _split(level, depth).select("path", "node")
        shared = materialize(_shared(paths).join(nodes.select("node", "sketch"), "node"), "buckets")
        last = depth + 1 == DEPTH
        done.append(shared if last else shared.filter(F.col("n") <= LEAF))
        level = shared.filter(F.col("n") > LEAF).select("node", "sketch", "path")
        if last or not level.limit(1).count():
            break
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def _paired(df: DataFrame, group: str, size: str, carried: list[str]) -> DataFrame:
    """Rows dealt to pairs of blocks of their group: ``(group, i, j, own block, carried)``, sorted.

    A group of n rows has n / BLOCK blocks, and a row goes to each pair of blocks that its own is part of. Groups of
    one block are not multiplied.
    """
    count = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), count).cast("int")
    df = df.select(F.col(group).alias("g"), count.alias("blocks"), own.alias("own"), *carried)
    df = df.select("g", "own", *carried, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    df = df.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *carried)
    return df.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (g, i, j) of a sorted partition; a group is at most about two blocks."""
    rest: pa.Table | None = None
    for batch in batches:
        whole = pa.Table.from_batches([batch])
        whole = pa.concat_tables([rest, whole]) if rest is not None else whole
        keys = [whole.column(c).to_numpy() for c in ("g", "i", "j")]
        new = np.zeros(whole.num_rows, dtype=bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(edges, edges[1:]):
            yield whole.slice(a, b - a)
        rest = whole.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _mates(near: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each row, the least node of its component in the matrix."""
    label = nodes.copy()
    worst = np.iinfo(np.int64).max
    while True:
        least = np.minimum(label, np.where(near, label[None, :], worst).min(axis=1))
        if (least == label).all():
            return label
        label = least


def _both(near: np.ndarray, group: pa.Table) -> np.ndarray:
    """Only pairs of the block pair at hand: across its blocks, or inside the one block."""
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    if i != j:
        own = group.column("own").to_numpy()
        near &= own[:, None] != own[None, :]
    np.fill_diagonal(near, False)
    return near


def loose_edges(buckets: DataFrame) -> DataFrame:
    """``(a, b)``: nodes whose sketches agree, each tied to the least node of its part of a bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows < 2:
                continue
            nodes = group.column("node").to_numpy()
            tokens = np.frombuffer(b"".join(group.column("sketch").to_pylist()), dtype="<u4").reshape(len(nodes), SKETCH)
            same = np.stack([(tokens == t).sum(axis=1) for t in tokens])
            mates = _mates(_both(same >= LOOSE * SKETCH, group), nodes)
            at = np.flatnonzero(mates != nodes)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(mates[at])], ["a", "b"])

    return _paired(buckets, "path", "n", ["node", "sketch"]).mapInArrow(task, "a long, b long").distinct()


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of incidence matrices of shared shingles."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    rows, column = rows[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((m, m), dtype=np.float32)  # counts stay far below 2^24
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((m, COLUMNS), dtype=np.float32)
        part[rows[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total.astype(np.int64)


def exact_links(members: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``(node, links, mate)`` per node and block pair: the weight of its exact partners, and the least node it leads to."""
    over, under = threshold.numerator, threshold.denominator

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            nodes = group.column("node").to_numpy()
            if len(nodes) < 2:
                continue
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets])
            # common / (a + b - common) >= over / under, in whole numbers
            near = _common(sets) * (over + under) >= over * (size[:, None] + size[None, :])
            near = _both(near, group)
            links = near @ group.column("copies").to_numpy()
            at = np.flatnonzero(links)
            mates = _mates(near, nodes)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[at]), pa.array(links[at]), pa.array(mates[at])], ["node", "links", "mate"]
                )

    dealt = _paired(members, "label", "size", ["node", "copies", "shingles"])
    return dealt.mapInArrow(task, "node long, links long, mate long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per document: ``(key, class_id, n_links)``.

    ``n_links`` counts the other documents whose similarity reaches the threshold, copies included; documents of one
    class are connected by links.
    """
    out = _joined(columns(docs, key, text), key, text, recall).select("key", "class_id", "n_links")
    return out.withColumnRenamed("key", key) if key != "key" else out


def _joined(source: DataFrame, key: str, text: str, recall: float = RECALL, mark: str | None = None) -> DataFrame:
    """One row per row of ``source``: ``(key, class_id, n_links)``.

    With ``mark``, a third column of ``source`` that tells texts apart, also ``(mark, stays)``: whether the row is the
    one its class keeps, the first by key, null keys last, and then by mark. A row without shingles stays.
    """
    ship(source.sparkSession)
    rows = materialize(sketches(source), "sketches")
    named = rows.filter("node is not null")
    first = F.struct(F.col("key").isNull().alias("unnamed"), "key", *[F.col(m).alias("mark") for m in [mark] if m])
    chosen = [F.min(first).alias("first")] if mark else []
    nodes = named.groupBy("node").agg(*chosen, F.min("key").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"), F.max("n_shingles").alias("n_shingles"))
    nodes = materialize(nodes, "nodes")

    edges = materialize(loose_edges(leaves(nodes, runs_for(recall))), "loose-edges")
    loose = materialize(components(edges), "loose")
    # Blocks are bounded by rows and by shingles: long texts make a group larger than its rows say.
    loose = materialize(loose.join(nodes.select("node", "rep", "copies", "n_shingles"), "node"), "loose-nodes")
    size = F.greatest(F.count("*"), F.ceil(F.sum("n_shingles") / SHINGLES))
    sizes = materialize(loose.groupBy("label").agg(size.alias("size")), "loose-sizes")
    members = materialize(loose.join(sizes, "label").drop("n_shingles"), "members")

    wanted = broadcast_checked(members.select("rep").distinct(), "wanted")
    texts = source.join(wanted, F.col(f"`{key}`").eqNullSafe(F.col("rep")), "left_semi").select(F.col(f"`{text}`").alias("text"))
    sets = _sets(texts).join(members.select("node", "label", "size", "copies"), "node")
    sets = materialize(sets.dropDuplicates(["node"]), "sets")
    found = materialize(exact_links(sets), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    exact = components(found.select(F.col("node").alias("a"), F.col("mate").alias("b")))
    carried = ["first"] if mark else []
    known = materialize(nodes.select("node", "rep", "copies", *carried).join(exact, "node", "left").join(links, "node", "left"), "known")
    own = F.coalesce("label", "node")
    reps = known.groupBy(own.alias("label")).agg(F.min("rep").alias("class_id"), *[F.min(c).alias(c) for c in carried])
    reps = materialize(reps, "reps")
    classes = known.select("node", "copies", "links", own.alias("label")).join(reps, "label")
    classes = materialize(classes.select("node", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), *carried), "classes")
    wanted = ["key", "class_id", "n_links"]
    alone = rows.filter("node is null").withColumns({"class_id": F.col("key"), "n_links": F.lit(0).cast("long")})
    out = named.join(classes, "node")
    if mark:
        wanted += ["mark", "stays"]
        alone = alone.withColumns({"mark": F.col(mark), "stays": F.lit(True)})
        stays = F.col("key").eqNullSafe(F.col("first.key")) & (F.col(mark) == F.col("first.mark"))
        out = out.withColumns({"mark": F.col(mark), "stays": stays})
    return out.select(*wanted).union(alone.select(*wanted))


def _sets(texts: DataFrame) -> DataFrame:
    """``(node, shingles)``: the sets themselves, eight bytes a shingle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                found = [shingles(t.as_py()) for t in batch.column(0).slice(i, 256)]
                found = [s for s in found if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                    ["node", "shingles"],
                )

    return texts.mapInArrow(task, "node long, shingles binary")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that another document of their class stands for.

    The document with the least key of a class stays, null keys last; of documents that share that key, the one whose
    text has the least digest. It is told by key and text, so other rows with its key, or with no key, are judged by
    their own class. Rows that repeat both key and text are one document.
    """
    digest = F.md5(F.col(f"`{text}`").cast("binary"))
    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"), digest.alias("__digest"))
    found = _joined(source, key, text, mark="__digest").select(F.col("key").alias("__key"), F.col("mark").alias("__mark"), "stays")
    found = materialize(found, "found")
    gone = broadcast_checked(found.filter("not stays").select("__key", "__mark").distinct(), "gone")
    kept = docs.join(gone, F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (digest == F.col("__mark")), "left_anti")
    twice = found.filter("stays").groupBy("__key", "__mark").agg(F.count("*").alias("n")).filter("n > 1")
    return kept.dropDuplicates([key, text]) if twice.limit(1).count() else kept
