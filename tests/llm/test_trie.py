"""The prefix trie of conversations: SQL, brute force, bursts and segments, awkward tables."""

import hashlib
import random
import re
import zlib

import pytest

from lexigrid.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, least int, depth string"


def brute(rows):
    """Nodes by the contract, from ``(conv_id, turn, role, text)``."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        leader = c - (c % 20 if c >= 0 else -(-c % 20))
        seqs[c] = tuple(own.get(leader, [])[:h] + ts[h:])
    nodes, out = {}, set()
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    kids = {k: [] for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    total = {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves = sum(total[x][0] for x in kids[k]) or 1
        total[k] = leaves, (len(nodes[k]) - 1) * words(k) + sum(total[x][1] for x in kids[k])
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(k)))
        parent = min(nodes[k[:-1]]) if k else None
        out.add((min(m), len(k), parent, len(m), len(kids[k]), *total[k], hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(nodes)
    return out


def nodes(spark, rows, limit=prefix_trie.LIMIT):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in prefix_trie.trie(df, limit).collect()]
    assert len(got) == len(set(got))
    return set(got)


def talk(seed, convs, longest, copies=0):
    rng = random.Random(seed)
    seen, rows = [], []
    for c in range(convs):
        s = list(rng.choice(seen)[: rng.randrange(longest)]) if seen and rng.random() < 0.6 else []
        s += [("user" if rng.random() < 0.5 else None, " ".join("ab"[: rng.randrange(3)])) for _ in range(rng.randrange(1, longest))]
        if seen and rng.random() < 0.3:
            s = rng.choice(seen)
        seen.append(s)
        rows += [(c * 3 - 40, t, *x) for t, x in enumerate(s)]
    rows += [(1000 + c, t, "user", "same text") for c in range(copies) for t in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, limit, segment", [(2, 3, 256), (3, 2, 4)])
def test_every_burst_limit_and_segment_gives_the_same_nodes(spark, monkeypatch, seed, limit, segment):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    rows = talk(seed, 60, 14, copies=25)
    assert nodes(spark, rows, limit) == brute(rows)


def test_a_long_conversation_and_its_copy_and_branch(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    rows = [(c, t, "u", f"turn {t}") for c in (20, 40, 60) for t in range(333 if c < 60 else 150)] + [(60, 150, "u", "other")]
    assert nodes(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "a", "tie"), (1, 0, "a", "tie"), (1, 0, "b", "tie"), (None, 0, "user", "lost"),
        (2, 0, "user", ""), (3, 5, "", "x y\tz\n"), (0, 0, "user", "leader"), (0, 0, "user", "leader"), (-7, 1, "ab", "c"), (-8, 1, "a", "bc"),
        (20, 1, "user", "w " * 100_000),
    ]
    assert nodes(spark, rows) == brute(rows)


def test_turnless_conversations_belong_to_the_root(spark):
    lone = [c for c in range(21, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1][:4]
    rows = [(c, 0, "user", "gone") for c in lone]
    got = nodes(spark, rows)
    assert got == brute(rows) and len(got) == 1
    assert nodes(spark, []) == set()
    assert nodes(spark, [(None, 1, "a", "b")]) == set()


def test_a_large_class_is_listed_in_pieces(spark):
    rows = [(c, 0, "u", "same") for c in range(20, 9_020, 20)] + [(c, 0, "u", "same") for c in range(100_000, 400_000, 20)]
    assert nodes(spark, rows) == brute(rows)
