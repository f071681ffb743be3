"""URL filter over a sorted digest array.

A rule is a host with a path, written as one string such as ``example.net/en/``. It fits its host, all subdomains, and
every path that starts with its own. Rules lie in one file: their 64-bit xxhash keys, sorted, then their strings. Workers
map the file into memory, probe it with a vectorised binary search for every (host suffix, path prefix) that a rule of
the list might equal, and confirm hits by the stored string, so a collision of digests can't judge a URL.

The file lies in the folder of ``spark.checkpoint.dir``; where that is no local path, a worker copies it once. Its list is
a bounded parameter, read on the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path, and no rule fits it. The longest rule wins; of
equally long ones that with the longer host, and of equal ones a block. Rows are judged one by one.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.common import shared_fs, ship
from lexigrid.plans.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace"))


class DigestArray:
    """The sorted array of a list, in memory-mapped parts: digests, string places, flags, strings."""

    def __init__(self, path: str, n: int, lengths: tuple[int, ...]):
        self.lengths = lengths  # of the rules' paths
        at = 8 * n
        self.digests = np.memmap(path, np.uint64, "r", 0, n) if n else np.empty(0, np.uint64)
        self.places = np.memmap(path, np.uint64, "r", at, n + 1) if n else np.zeros(1, np.uint64)
        self.blocks = np.memmap(path, np.uint8, "r", at + 8 * (n + 1), n) if n else np.empty(0, np.uint8)
        self.strings = np.memmap(path, np.uint8, "r", at + 8 * (n + 1) + n) if n else np.empty(0, np.uint8)

    @staticmethod
    def pack(rules: dict[str, bool]) -> bytes:
        """The file of a list: rule to whether it blocks."""
        keys = sorted(rules, key=lambda k: (digest(k), k))
        raw = [k.encode() for k in keys]
        places = np.cumsum([0, *map(len, raw)]).astype("<u8")
        digests = np.array([digest(k) for k in keys], dtype="<u8")
        return digests.tobytes() + places.tobytes() + bytes(rules[k] for k in keys) + b"".join(raw)

    def find(self, keys: list[str]) -> np.ndarray:
        """The place of each key in the array, or -1: binary search, then comparison of strings."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.digests) or not keys:
            return out
        wanted = np.fromiter(map(digest, keys), dtype=np.uint64, count=len(keys))
        first, after = np.searchsorted(self.digests, wanted, "left"), np.searchsorted(self.digests, wanted, "right")
        for i in np.flatnonzero(first < after):
            own = keys[i].encode("utf-8", "replace")
            for at in range(first[i], after[i]):
                if self.strings[int(self.places[at]) : int(self.places[at + 1])].tobytes() == own:
                    out[i] = at
        return out

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str, bool] | None]:
        """The winning rule of each URL and whether it blocks."""
        keys, owner, rank = [], [], []
        for u, (host, path) in enumerate(zip(hosts, paths)):
            at = 0
            while host:
                for n in self.lengths:
                    if n <= len(path):
                        keys.append(host[at:] + path[:n])
                        owner.append(u)
                        rank.append((len(host) - at + n, len(host) - at))
                dot = host.find(".", at)
                if dot < 0:
                    break
                at = dot + 1
        best: list[tuple | None] = [None] * len(hosts)
        found = self.find(keys)
        for i in np.flatnonzero(found >= 0):
            if best[owner[i]] is None or rank[i] > best[owner[i]][0]:
                best[owner[i]] = (rank[i], keys[i], bool(self.blocks[found[i]]))
        return [b and b[1:] for b in best]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def store(spark: SparkSession, rules: list[tuple[str, str]]) -> tuple[str, int, tuple[int, ...]]:
    """Write the array of ``(rule, verdict)`` pairs to the shared folder: its path, rules, and their path lengths."""
    flags: dict[str, bool] = {}
    for rule, verdict in rules:
        flags[rule] = flags.get(rule, False) or verdict == BLOCK
    path = scratch_path(spark, "digests")
    fs, inner = shared_fs(path)
    fs.create_dir(os.path.dirname(inner), recursive=True)
    with fs.open_output_stream(inner) as out:
        out.write(DigestArray.pack(flags))
    return path, len(flags), tuple(sorted({len(r) - len(r.partition("/")[0]) for r in flags}))


_OPEN: dict[str, DigestArray] = {}


def _opened(path: str, n: int, lengths: tuple[int, ...]) -> DigestArray:
    if path not in _OPEN:
        fs, inner = shared_fs(path)
        if n and not os.path.exists(inner):
            with fs.open_input_stream(inner) as source, tempfile.NamedTemporaryFile(delete=False) as copy:
                while block := source.read(1 << 20):
                    copy.write(block)
            inner = copy.name
        _OPEN[path] = DigestArray(inner, n, lengths)
    return _OPEN[path]


def winning(spark: SparkSession, host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """``struct<rule, verdict>`` of the rule that wins; both null where none fits."""
    ship(spark)
    stored = store(spark, rules)

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def udf(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = _opened(*stored).longest(hosts.to_pylist(), paths.to_pylist())
        rule = pa.array([f and f[0] for f in found], pa.string())
        verdict = pa.array([f and (BLOCK if f[1] else ALLOW) for f in found], pa.string())
        return pa.StructArray.from_arrays([rule, verdict], ["rule", "verdict"])

    return udf.asNondeterministic()(host, path)


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], listed: list[str], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """``(key, host, path, rule, verdict)``: the rule's verdict, else a block for what ``listed`` covers, else allow."""
    spark = pages.sparkSession
    host, path = parts(F.col(f"`{url}`"))
    df = pages.select(F.col(f"`{key}`").alias("__key"), host.alias("host"), path.alias("path"))
    own = winning(spark, F.col("host"), F.col("path"), rules)
    other = winning(spark, F.col("host"), F.col("path"), [(x, BLOCK) for x in listed])
    df = df.select("__key", "host", "path", own.alias("own"), other.alias("other"))
    return df.select(
        F.col("__key").alias(key), "host", "path", "own.rule", F.coalesce("own.verdict", "other.verdict", F.lit(ALLOW)).alias("verdict")
    )
