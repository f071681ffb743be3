"""Prefix trie of conversations, built as a burst trie.

A turn's id is a digest of its role and text. A conversation is the list of its turn ids; those of equal lists are one entry
with a count. Containers hold the suffixes of entries under a trie head. A container of more than ``LIMIT`` entries bursts:
the turns that all its entries share become a chain of nodes, and the entries go on to new containers by their next
turn id. Containers that are small enough are spread by their head over shards, sorted, and swept once into nodes; the
totals of their subtrees are then added up along the heads, last burst first.

No row, group or task holds an unbounded conversation. Turns are placed by a range sort in which even equal rows
spread, and lists are cut every ``SEGMENT`` turns. A segment belongs to a trie head of its own, told by the digest of
all turns before it. Where only one entry passes a head, the rest of that entry is a chain that needs no container.
Heads that several entries pass are done from the deepest up, so rounds follow the depth to which *different*
conversations agree, divided by ``SEGMENT``, not the longest conversation. Members of a class of equal conversations are
listed by a range sort in pieces, and their digest is taken piece by piece.

Defined results: rows without ``conv_id`` belong to no conversation and are left out; null roles and texts are empty ones;
a null turn comes first; rows of equal turn are ordered by the digest of role and text, so repeated rows are turns of
their own. An empty table has no nodes, not even a root. Turns are told apart by 128 bits of SHA-256, prefixes by two
64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.llm.common import ship
from lexigrid.plans.session import broadcast_checked, materialize

#: Entries that a container holds at most, turns to a segment, members to a piece of a class.
LIMIT, SEGMENT, PIECE = 2_000, 256, 4_096
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of a digest of role and text; the length keeps the two apart."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def turns_of(df: DataFrame) -> DataFrame:
    """``(conv, turn, id, w)``: one narrow row per turn, without its text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    return rows.filter("conv is not null").select(
        "conv", "turn", turn_id(F.col("role"), F.col("text")).alias("id"),
        F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("w"),
    )


def _lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to runs of at most ``SEGMENT`` turns of one conversation, numbered in their order."""
    part, run = TaskContext.get().partitionId(), 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = np.asarray(b.column("conv"))
        new = np.flatnonzero(np.diff(conv)) + 1
        starts = np.concatenate([np.arange(s, e, SEGMENT) for s, e in zip([0, *new], [*new, len(conv)], strict=True)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(conv[starts]), pa.array(np.full(len(starts), part), pa.int32()),
                pa.array(np.arange(run, run + len(starts)), pa.int64()), _lists(b.column("id"), starts), _lists(b.column("w"), starts),
            ],
            names=["conv", "part", "run", "ids", "ws"],
        )
        run += len(starts)


def runs_of(turns: DataFrame) -> DataFrame:
    """``(conv, at, ids, ws)``: pieces of the conversations, ``at`` the place of their first turn."""
    turns = materialize(turns, "turns").withColumn("salt", F.monotonically_increasing_id())
    order = ["conv", F.col("turn").asc_nulls_first(), "id"]
    placed = turns.repartitionByRange(*order, "salt").sortWithinPartitions(*order).select("conv", "id", "w")
    runs = materialize(placed.mapInArrow(_runs, "conv long, part int, run long, ids array<binary>, ws array<long>"), "runs")
    where = ["conv", "part", "run"]
    sizes = runs.select(*where, F.size("ids").cast("long").alias("n"))
    several = sizes.groupBy("conv").agg(F.count("*").alias("k")).filter("k > 1").select("conv")
    before = Window.partitionBy("conv").orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(several, "conv", "left_semi").withColumn("at", F.sum("n").over(before)).filter("at > 0").select(*where, "at")
    placed = runs.join(broadcast_checked(offsets, "offsets"), where, "left")
    return materialize(placed.select("conv", F.coalesce("at", F.lit(0)).alias("at"), "ids", "ws"), "placed")


def _shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its leader: unsigned crc32 of its number in decimal, modulo 4."""
    return (F.crc32(conv.cast("string")) % 4).cast("int")


def _leader(conv: Column) -> Column:
    return conv - conv % 20


def rebuilt(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(segments, conversations)`` of the rebuilt conversations.

    Conversation c takes the first h turns of conversation c - c % 20 in place of its own first h.
    ``segments(conv, seg, ids, ws)`` are cut every ``SEGMENT`` turns; ``conversations(conv)`` lists all, turnless ones too.
    """
    convs = materialize(runs.select("conv").distinct(), "conversations")
    first = runs.filter((F.col("at") < 3) & (F.col("conv") % 20 == 0)).groupBy("conv").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("at", F.slice("ids", 1, 3).alias("ids"), F.slice("ws", 1, 3).alias("ws")))), 1, 3).alias("p")
    )  # at most three pieces begin before the third turn
    first = first.select(
        F.col("conv").alias("leader"), F.slice(F.flatten("p.ids"), 1, 3).alias("ids"), F.slice(F.flatten("p.ws"), 1, 3).alias("ws")
    )
    conv, h = F.col("conv"), F.col("h")
    plan = convs.select("conv", _leader(conv).alias("leader"), _shared_turns(conv).alias("h")).filter("h > 0")
    plan = plan.join(first, "leader", "left")
    lead = plan.select(
        "conv", "h", F.slice(F.coalesce("ids", F.array().cast("array<binary>")), F.lit(1), h).alias("ids"),
        F.slice(F.coalesce("ws", F.array().cast("array<long>")), F.lit(1), h).alias("ws"),
    )
    lead = materialize(lead, "lead")
    missing = broadcast_checked(lead.filter(F.size("ids") < h).select("conv", (h - F.size("ids")).alias("miss")), "missing")
    skip = F.greatest(F.lit(0).cast("long"), _shared_turns(conv) - F.col("at")).cast("int")
    own = runs.join(missing, "conv", "left").select("conv", "at", "ids", "ws", F.coalesce("miss", F.lit(0)).alias("miss"), skip.alias("skip"))
    own = own.filter(F.size("ids") > F.col("skip")).select(
        "conv", (F.col("at") + F.col("skip") - F.col("miss")).alias("at"),
        F.slice("ids", F.col("skip") + 1, F.size("ids")).alias("ids"), F.slice("ws", F.col("skip") + 1, F.size("ws")).alias("ws"),
    )
    pieces = own.unionByName(lead.filter(F.size("ids") > 0).select("conv", F.lit(0).cast("long").alias("at"), "ids", "ws"))
    seg = lambda place: F.floor(place / SEGMENT)
    cut = pieces.select("*", F.explode(F.sequence(seg(F.col("at")), seg(F.col("at") + F.size("ids") - 1))).alias("seg"))
    low = F.greatest(F.lit(0).cast("long"), F.col("seg") * SEGMENT - F.col("at")).cast("int")
    high = F.least(F.size("ids").cast("long"), (F.col("seg") + 1) * SEGMENT - F.col("at")).cast("int")
    cut = cut.select("conv", "seg", "at", F.slice("ids", low + 1, high - low).alias("ids"), F.slice("ws", low + 1, high - low).alias("ws"))
    whole = cut.groupBy("conv", "seg").agg(F.sort_array(F.collect_list(F.struct("at", "ids", "ws"))).alias("p"))
    return materialize(whole.select("conv", "seg", F.flatten("p.ids").alias("ids"), F.flatten("p.ws").alias("ws")), "segments"), convs


def _hashes(*cols) -> list[Column]:
    """Two 64-bit hashes of the same columns."""
    return [F.xxhash64(F.lit(s), *cols) for s in (17, 4242)]


def _member_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members to pieces of a class: least member, number, and the members in decimal."""
    part, piece = TaskContext.get().partitionId(), 0
    for b in batches:
        if not b.num_rows:
            continue
        q1, q2, n, conv = (np.asarray(b.column(c)) for c in ("q1", "q2", "len", "conv"))
        new = np.flatnonzero((np.diff(q1) != 0) | (np.diff(q2) != 0) | (np.diff(n) != 0)) + 1
        cuts = [(s, min(s + PIECE, e)) for lo, e in zip([0, *new], [*new, len(conv)], strict=True) for s in range(lo, e, PIECE)]
        at = [s for s, _ in cuts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(q1[at]), pa.array(q2[at]), pa.array(n[at]), pa.array(np.full(len(at), part), pa.int32()),
                pa.array(np.arange(piece, piece + len(at))), pa.array(conv[at]), pa.array([e - s for s, e in cuts], pa.int64()),
                pa.array([",".join(map(str, conv[s:e].tolist())) for s, e in cuts]),
            ],
            names=["q1", "q2", "len", "part", "piece", "least", "n", "members"],
        )
        piece += len(at)


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by class and order to one digest per class, taken piece by piece."""
    key, digest = None, None
    out: list[tuple] = []
    for b in batches:
        for q1, q2, n, members in zip(*(b.column(c).to_pylist() for c in ("q1", "q2", "len", "members")), strict=True):
            if (q1, q2, n) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (q1, q2, n), hashlib.sha256()
                digest.update(members.encode())
            else:
                digest.update(b"," + members.encode())
    if key is not None:
        out.append((*key, digest.hexdigest()))
    yield pa.RecordBatch.from_pydict({c: [o[i] for o in out] for i, c in enumerate(("q1", "q2", "len", "sha"))}, schema=_DIGEST)


_DIGEST = pa.schema([("q1", pa.int64()), ("q2", pa.int64()), ("len", pa.int64()), ("sha", pa.string())])


def classes_of(segments: DataFrame, convs: DataFrame) -> DataFrame:
    """``(rep, q1, q2, len, words, cnt, sha)``: equal conversations as one entry, ``sha`` the digest of its members."""
    e1, e2 = _hashes("seg", "ids")
    total = F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + w)
    parts = segments.select("conv", e1.alias("e1"), e2.alias("e2"), F.size("ids").cast("long").alias("n"), total.alias("w"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    known = parts.unionByName(convs.select("conv", *[F.lit(0).cast("long").alias(c) for c in ("e1", "e2", "n", "w")]))
    whole = known.groupBy("conv").agg(
        zero(F.bit_xor("e1")).alias("q1"), zero(F.bit_xor("e2")).alias("q2"), F.sum("n").alias("len"), F.sum("w").alias("words")
    )
    whole = materialize(whole, "whole")
    key = ["q1", "q2", "len"]
    ordered = whole.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").select(*key, "conv")
    pieces = materialize(
        ordered.mapInArrow(_member_pieces, "q1 long, q2 long, len long, part int, piece long, least long, n long, members string"), "pieces"
    )
    found = pieces.groupBy(*key).agg(
        F.min("least").alias("rep"), F.sum("n").alias("cnt"), F.count("*").alias("pieces"), F.sha2(F.max("members"), 256).alias("one")
    )
    found = materialize(found, "classes")
    large = pieces.join(broadcast_checked(found.filter("pieces > 1").select(*key), "large-classes"), key, "left_semi")
    listed = large.repartition(*key).sortWithinPartitions(*key, "part", "piece").select(*key, "members")
    shas = broadcast_checked(listed.mapInArrow(_digest_pieces, "q1 long, q2 long, len long, sha string"), "digests")
    words = whole.select(F.col("conv").alias("rep"), "words")
    return materialize(
        found.join(shas, key, "left").select(*key, "rep", "cnt", F.coalesce("sha", "one").alias("sha")).join(words, "rep"), "entries"
    )


class _Node:
    __slots__ = ("depth", "w", "convs", "least", "children", "leaves", "saved", "sha", "kids")

    def __init__(self, depth: int, w: int):
        self.depth, self.w, self.convs, self.least = depth, w, 0, None
        self.children = self.leaves = self.saved = 0
        self.sha, self.kids = NO_ENDS, []

    def gain(self, convs: int, least: int, leaves: int, saved: int, children: int) -> None:
        self.convs += convs
        self.least = least if self.least is None else min(self.least, least)
        self.leaves, self.saved, self.children = self.leaves + leaves, self.saved + saved, self.children + children


_SWEPT = pa.schema(
    [("lvl", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()), ("up1", pa.int64()), ("up2", pa.int64())]
    + [(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in _NODE_NAMES]
)
_SWEPT_SQL = f"lvl int, c1 long, c2 long, up1 long, up2 long, {NODE}"


def sweep(base: int):
    """Sweep sorted containers, one after another, into nodes and a row of totals (``lvl`` not null) for each.

    A node waits for its parent's least member, so what is held is the path and the children of open nodes: at most
    a container.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        box, path, last = None, [], []

        def close() -> None:
            node = path.pop()
            if not node.children:
                node.leaves = 1
            node.saved += (node.convs - 1) * node.w
            out.extend((None,) * 5 + (*k[:2], node.least, *k[2:]) for k in node.kids)
            path[-1].gain(node.convs, node.least, node.leaves, node.saved, 1)
            path[-1].kids.append((node.least, base + node.depth, node.convs, node.children, node.leaves, node.saved, node.sha))

        def finish() -> None:
            while len(path) > 1:
                close()
            head = path.pop()
            lvl, c1, c2, up1, up2, _, least = box
            out.extend((None,) * 5 + (*k[:2], least, *k[2:]) for k in head.kids)
            out.append((lvl, c1, c2, up1, up2, head.least, None, None, head.convs, head.children, head.leaves, head.saved, None))

        def batch() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _SWEPT, strict=True)], schema=_SWEPT)
            out.clear()
            return done

        for b in batches:
            for lvl, c1, c2, up1, up2, d, pm, ids, ws, convs, least, sha, children, leaves, saved in zip(
                *(b.column(c).to_pylist() for c in _ENTRY), strict=True
            ):
                if box is None or (c1, c2) != box[1:3]:
                    if box is not None:
                        finish()
                    box, last = (lvl, c1, c2, up1, up2, d, pm), ids[:d]
                    path = [_Node(d, 0)]
                same = d
                while same < len(last) and same < len(ids) and last[same] == ids[same]:
                    same += 1
                while path[-1].depth > same:
                    close()
                path.extend(_Node(i + 1, ws[i]) for i in range(same, len(ids)))
                path[-1].gain(convs, least, leaves, saved, children)
                if sha is not None:
                    path[-1].sha = sha
                last = ids
                if len(out) > 10_000:
                    yield batch()
        if box is not None:
            finish()
        if out:
            yield batch()

    return run


_ENTRY = "lvl c1 c2 up1 up2 d pm ids ws convs least sha children leaves saved".split()


def _common(a: Column, b: Column) -> Column:
    """The number of first turns that two lists share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x != y, F.lit(True))), True)
    return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def burst(entries: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(containers, bursts)``: entries in containers of at most ``limit``, and the containers that burst, by round.

    A round costs a count per container; only containers over the limit, whose number is at most the entries divided
    by the limit, are looked at further and their entries moved on.
    """
    key = ["c1", "c2"]
    bursts: list[DataFrame] = []
    while True:
        over = entries.groupBy(*key).agg(F.count("*").alias("size")).filter(F.col("size") > limit)
        over = materialize(over, "oversized")
        if not over.limit(1).count():
            return entries, bursts
        over = broadcast_checked(over.select(*key), "oversized")
        full = entries.join(over, key, "left_semi")
        lists = full.groupBy(*key).agg(
            F.min("ids").alias("lo"), F.max("ids").alias("hi"), F.min(F.struct("ids", "ws", "sha")).alias("first"),
            F.first("lvl").alias("lvl"), F.first("up1").alias("up1"), F.first("up2").alias("up2"), F.first("d").alias("d"),
            F.first("pm").alias("pm"), F.sum("convs").alias("convs"), F.min("least").alias("least"),
        )
        # A list that ends where the others go on is the least of them: a prefix sorts first.
        lists = lists.withColumn("top", _common(F.col("lo"), F.col("hi"))).select(
            *key, "lvl", "up1", "up2", "d", "pm", "convs", "least", "top", F.slice("first.ws", 1, F.col("top")).alias("ws"),
            F.when(F.size("lo") == F.col("top"), F.col("first.sha")).alias("sha"),
        )
        lists = materialize(lists, "bursts")
        bursts.append(lists)
        side = broadcast_checked(lists.select(*key, "top", F.col("least").alias("head")), "burst-heads")
        moved = entries.join(side, key, "left").filter(F.col("top").isNull() | (F.size("ids") > F.col("top")))
        hit = F.col("top").isNotNull()
        n1, n2 = _hashes("c1", "c2", "top", F.get("ids", F.col("top")))
        moved = moved.select(
            F.when(hit, F.lit(len(bursts))).otherwise(F.col("lvl")).alias("lvl"),
            F.when(hit, n1).otherwise(F.col("c1")).alias("c1"), F.when(hit, n2).otherwise(F.col("c2")).alias("c2"),
            F.when(hit, F.col("c1")).otherwise(F.col("up1")).alias("up1"), F.when(hit, F.col("c2")).otherwise(F.col("up2")).alias("up2"),
            F.coalesce("top", "d").alias("d"),
            # The chain's last node is the head; where the chain is empty, the head is the container's own.
            F.when(hit & (F.col("top") > F.col("d")), F.col("head")).otherwise(F.col("pm")).alias("pm"),
            *_ENTRY[7:],
        )
        entries = materialize(moved, "containers")


def _burst_nodes(found: DataFrame, below: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of the chains of burst containers, and their totals, from the totals ``below`` them."""
    rows = found.join(below, ["c1", "c2"])
    rest = lambda i: F.aggregate(  # words of the chain from place i on, as often as they are saved
        F.slice("ws", i + 1, F.size("ws")), F.lit(0).cast("long"), lambda a, w: a + w
    ) * (F.col("convs") - 1) + F.col("saved")
    chain = F.when(F.col("top") > F.col("d"), F.sequence(F.col("d"), F.col("top") - 1)).otherwise(F.array().cast("array<int>"))
    last = F.col("i") == F.col("top") - 1
    nodes = rows.select("*", F.explode(chain).alias("i")).select(
        F.col("least").alias("conv_id"), (F.col("i") + 1 + base).cast("long").alias("depth"),
        F.when(F.col("i") == F.col("d"), F.col("pm")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("convs").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        rest(F.col("i")).alias("saved_tokens"), F.when(last, F.coalesce("sha", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
    )
    long = F.col("top") > F.col("d")
    totals = rows.select(
        "lvl", "c1", "c2", "up1", "up2", F.when(long, 1).otherwise(F.col("children")).cast("long").alias("children"),
        "leaves", F.when(long, rest(F.col("d"))).otherwise(F.col("saved")).alias("saved"),
    )
    return nodes, totals


def grow(entries: DataFrame, seg: int, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """``(nodes, heads)``: the nodes below the heads of one segment, and per head ``(c1, c2, children, leaves, saved)``."""
    base = seg * SEGMENT
    boxes, bursts = burst(entries, limit)
    placed = boxes.select(*_ENTRY).repartition("c1", "c2").sortWithinPartitions("c1", "c2", "ids")
    swept = materialize(placed.mapInArrow(sweep(base), _SWEPT_SQL), "swept")
    nodes = [swept.filter("lvl is null").select(*_NODE_NAMES)]
    totals = swept.filter("lvl is not null").select(
        "lvl", "c1", "c2", "up1", "up2", F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")
    )
    summed = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
    for r in range(len(bursts) - 1, -1, -1):
        below = totals.filter(F.col("lvl") == r + 1).groupBy(F.col("up1").alias("c1"), F.col("up2").alias("c2")).agg(*summed)
        more, own = _burst_nodes(bursts[r], materialize(below, "below"), base)
        nodes.append(more)
        totals = materialize(totals.filter(F.col("lvl") <= r).unionByName(own), "totals")
    return nodes, totals.filter("lvl = 0").select("c1", "c2", "children", "leaves", "saved")


def _deep(rows: DataFrame) -> DataFrame:
    """Segments of entries that fill one segment or more, with the digest of the turns before (p1, p2), after (x1, x2) and the words after."""
    e1, e2 = _hashes("seg", "ids")
    total = F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + w)
    small = rows.select("rep", "seg", e1.alias("e1"), e2.alias("e2"), total.alias("w"))
    upto = Window.partitionBy("rep").orderBy("seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = small.select("rep", "seg", "e1", "e2", *[F.bit_xor(c).over(upto).alias(x) for c, x in (("e1", "x1"), ("e2", "x2"))], F.sum("w").over(upto).alias("done"))
    run = run.select("rep", "seg", F.col("x1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("e2")).alias("p2"), "x1", "x2", "done")
    return materialize(rows.join(run, ["rep", "seg"]).withColumn("tail", F.col("words") - F.col("done")), "deep")


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``NODE`` rows of the prefix trie of all rebuilt conversations."""
    spark = conversations.sparkSession
    ship(spark)
    segments, convs = rebuilt(runs_of(turns_of(conversations)))
    all_convs = convs.agg(F.count("*").alias("n"), F.min("conv").alias("least")).first()
    if not all_convs.n:
        return spark.createDataFrame([], NODE)
    entries = classes_of(segments, convs)
    rows = segments.withColumnRenamed("conv", "rep").join(entries.select("rep", "len", "words", "cnt", "sha"), "rep")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    short = rows.filter(F.col("len") < SEGMENT).select(
        zero.alias("p1"), zero.alias("p2"), "ids", "ws", F.col("cnt").alias("convs"), F.col("rep").alias("least"), "sha",
        zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
    )
    nodes: list[DataFrame] = []
    longest = entries.agg(F.max("len").alias("n")).first().n
    top = short

    def boxed(df: DataFrame, pm: Column) -> DataFrame:
        """Entries in the containers of their heads, ``pm`` the least member of the head."""
        return df.withColumns(
            {"lvl": F.lit(0), "c1": F.col("p1"), "c2": F.col("p2"), "up1": none, "up2": none, "d": F.lit(0), "pm": pm}
        ).select(*_ENTRY)

    if longest >= SEGMENT:
        more, top_deep = _shared_segments(_deep(rows.filter(F.col("len") >= SEGMENT)), boxed, limit)
        nodes += more
        top = short.unionByName(top_deep)
    found, heads = grow(materialize(boxed(top, F.lit(all_convs.least)), "entries"), 0, limit)
    nodes += found
    below = heads.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("children", "leaves", "saved")])
    ends = entries.filter("len = 0").agg(F.coalesce(F.max("sha"), F.lit(NO_ENDS)).alias("sha")).scalar()
    nodes.append(
        below.select(
            F.lit(all_convs.least).cast("long").alias("conv_id"), zero.alias("depth"), none.alias("parent_conv_id"),
            F.lit(all_convs.n).cast("long").alias("n_convs"), F.col("children").alias("n_children"),
            F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.col("saved").alias("saved_tokens"), ends.alias("ends_sha256"),
        )
    )
    out = nodes[0]
    for df in nodes[1:]:
        out = out.unionByName(df)
    return out


def _shared_segments(deep: DataFrame, boxed, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes beyond the first segment, and the first segment's entries with the totals of what follows them."""
    nodes: list[DataFrame] = []
    reached = deep.filter(F.size("ids") == SEGMENT).groupBy((F.col("seg") + 1).alias("seg"), F.col("x1").alias("p1"), F.col("x2").alias("p2"))
    going = F.count_if(F.col("len") > (F.col("seg") + 1) * SEGMENT)
    reached = reached.agg(F.min("rep").alias("pm"), going.alias("going")).filter("going > 0")
    heads = materialize(reached, "heads")
    at = ["seg", "p1", "p2"]
    # One entry passes the head: its turns are a chain.
    alone = deep.join(heads.filter("going = 1"), at)
    i, depth = F.col("i"), F.col("seg") * SEGMENT + F.col("i") + 1
    rest = F.aggregate(F.slice("ws", i + 1, F.size("ws")), F.col("tail"), lambda a, w: a + w)
    chain = alone.select("*", F.posexplode("ws").alias("i", "w"))
    nodes.append(
        chain.select(
            F.col("rep").alias("conv_id"), depth.alias("depth"), F.when(i == 0, F.col("pm")).otherwise(F.col("rep")).alias("parent_conv_id"),
            F.col("cnt").alias("n_convs"), F.when(depth == F.col("len"), 0).otherwise(1).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), F.when(F.col("cnt") == 1, 0).otherwise((F.col("cnt") - 1) * rest).cast("long").alias("saved_tokens"),
            F.when(depth == F.col("len"), F.col("sha")).otherwise(NO_ENDS).alias("ends_sha256"),
        )
    )
    shared = heads.filter("going > 1")
    last = shared.agg(F.coalesce(F.max("seg"), F.lit(0)).alias("n")).first().n
    empty = deep.sparkSession.createDataFrame([], "p1 long, p2 long, children long, leaves long, saved long")
    below, out = empty, None
    for k in range(last, -1, -1):
        here = deep.filter(F.col("seg") == k)
        here = here.join(shared.select(*at, "pm"), at) if k else here.withColumn("pm", F.lit(None).cast("long"))
        ended = F.col("len") <= (k + 1) * SEGMENT
        ways = here.groupBy("p1", "p2", "ids", "pm", "x1", "x2").agg(
            F.first("ws").alias("ws"), F.sum("cnt").alias("convs"), F.min("rep").alias("least"), F.max(F.when(ended, F.col("sha"))).alias("sha"),
            F.count_if(~ended).alias("going"), F.sum((F.col("cnt") - 1) * F.col("tail")).alias("alone_saved"),
        )
        after = below.select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("children").alias("c"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        one, many = F.col("going") == 1, F.col("going") > 1
        ways = ways.join(after, ["x1", "x2"], "left").select(
            "p1", "p2", "pm", "ids", "ws", "convs", "least", "sha",
            F.when(one, 1).when(many, F.col("c")).otherwise(0).cast("long").alias("children"),
            F.when(one, 1).when(many, F.col("l")).otherwise(0).cast("long").alias("leaves"),
            F.when(one, F.col("alone_saved")).when(many, F.col("s")).otherwise(0).cast("long").alias("saved"),
        )
        if k == 0:
            out = ways.drop("pm")
            break
        found, below = grow(materialize(boxed(ways, F.col("pm")), "entries"), k, limit)
        nodes += found
        below = materialize(below.select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), "children", "leaves", "saved"), "head-totals")
    return nodes, out
