"""Analytics over query logs and run results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.text import size_label
from lexigrid.plans.session import broadcast_checked, materialize, null_safe_join
from lexigrid.sources.results import CONFIG

# The settings a benchmark grid is made of.
GRID = {
    "indexing_stage": ("positional", "tf", "tfidf"),
    "datastore": ("pickle", "postgres"),
    "compression": ("none", "zlib"),
    "optimization": ("none", "skip_pointers"),
    "query_processing": ("taat", "daat"),
}

SKETCH_ACCURACY = 10_000
SKETCH_MARGIN = 0.001
# Zones of more rows are cut again, at so many places.
ZONE_ROWS, ZONE_CUTS = 200_000, 64


def _ranks(points: Sequence[float], total: Column) -> list[Column]:
    """The ranks next to the wanted points, from 0."""
    places = [(total - 1) * F.lit(float(p)) for p in points]
    return [f(r).cast("long") for r in places for f in (F.floor, F.ceil)]


def _cut(rows: DataFrame, keys: Sequence[str], shares: Sequence[float], points: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Cut the zones of ``rows(*keys, skip, total, v)`` once more: ``(zoned rows, the zones that hold wanted ranks)``.

    A sketch proposes values at the given shares of each zone. A cut value is a zone of its own, and so are the values
    between two cuts; exact counts then tell where a zone starts. ``skip`` is the number of rows of the group
    before a zone and names it. A NULL ``total`` is counted.
    """
    zone_keys = [*keys, "skip"]
    sketch = rows.groupBy(*zone_keys).agg(
        F.percentile_approx("v", [float(b) for b in shares], SKETCH_ACCURACY).alias("cuts")
    ).withColumn("cuts", F.array_sort(F.array_distinct("cuts")))
    zone = F.lit(0)
    for i in range(len(shares)):
        cut = F.get("cuts", F.lit(i))
        zone = zone + F.when(F.col("v") > cut, 2).when(F.col("v") == cut, 1).otherwise(0)
    zoned = null_safe_join(rows, broadcast_checked(sketch), zone_keys).select(*zone_keys, "total", "v", zone.alias("zone"))
    counts = zoned.groupBy(*zone_keys, "total", "zone").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    mother = Window.partitionBy(*zone_keys)
    before = mother.orderBy("zone").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("total", F.coalesce("total", F.sum("n").over(mother))).withColumn(
        "start", F.col("skip") + F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    inside = F.lit(False)
    for r in _ranks(points, F.col("total")):
        inside = inside | ((r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    return zoned, materialize(counts.filter(inside), "zones")


def rank_zones(
    data: DataFrame, keys: Sequence[str], points: Sequence[float], bound: int = ZONE_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """``(placed, rest)`` for ``data(*keys, v)``: what is left to order, in zones of at most ``bound`` rows.

    ``placed(*keys, total, first, last, v)`` holds single values with the ranks they take; ``rest(*keys, total, skip, v)``
    the rows of the other zones that hold wanted ranks. The first cut keeps about 0.2 % of a group around each
    point, and every further one about 1/64 of a zone; only zones over the bound are cut again, on their own rows.
    """
    keys = list(keys)
    shares = sorted({min(1.0, max(0.0, p + d)) for p in points for d in (-SKETCH_MARGIN, SKETCH_MARGIN)})
    rows = data.select(*keys, F.lit(0).cast("long").alias("skip"), F.lit(None).cast("long").alias("total"), "v")
    placed, rest = [], []
    while rows is not None:
        zoned, near = _cut(rows, keys, shares, points)
        single = F.col("zone") % 2 == 1
        placed.append(
            near.filter(single).select(*keys, "total", F.col("start").alias("first"), (F.col("start") + F.col("n") - 1).alias("last"), "v")
        )
        wide = near.filter(~single).select(*keys, "skip", "zone", F.col("total").alias("of"), "start", "n")
        largest = wide.agg(F.max("n").alias("n")).first().n or 0
        found = null_safe_join(zoned, broadcast_checked(wide), [*keys, "skip", "zone"]).select(
            *keys, F.col("start").alias("skip"), F.col("of").alias("total"), "v", "n"
        )
        rows = None
        if largest > bound:  # written, so that further cuts read these zones and not the log
            found = materialize(found, "zone-rows")
            rows = found.filter(F.col("n") > bound).drop("n")
        rest.append(found.filter(F.col("n") <= bound).drop("n"))
        shares = [(i + 1) / (ZONE_CUTS + 1) for i in range(ZONE_CUTS)]
    return append_runs(*placed), append_runs(*rest)


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], bound: int = ZONE_ROWS
) -> DataFrame:
    """Exact percentiles per group with linear interpolation between neighbours.

    A group is never gathered in one task: it is cut around the wanted ranks, by values that a sketch proposes and by
    exact counts, until no zone has more than ``bound`` rows; only these are ordered. A poor sketch costs a cut
    more, not the answer. A value that most rows share is found by counting alone.
    """
    keys = list(keys)
    data = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    placed, rest = rank_zones(data, keys, sorted(points.values()), bound)
    upto = Window.partitionBy(*keys, "skip").orderBy("v")
    ordered = (
        rest.groupBy(*keys, "skip", "total", "v")
        .agg(F.count("*").alias("n"))
        .withColumn("last", F.col("skip") + F.sum("n").over(upto) - 1)
        .select(*keys, "total", (F.col("last") - F.col("n") + 1).alias("first"), "last", "v")
    )

    def at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("first")) & (r <= F.col("last")), F.col("v")))

    aggs = []
    for name, p in points.items():
        low, high = _ranks([p], F.col("total"))
        share = (F.col("total") - 1) * F.lit(float(p)) - low
        aggs += [at(low).alias(f"_lo_{name}"), at(high).alias(f"_hi_{name}"), F.max(share).alias(f"_w_{name}")]
    found = placed.unionByName(ordered).groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *(
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in points
        ),
    )


# Items that a quantile sketch keeps at its lowest level, as a power of two, and the share of the rows by which the rank of a
# quantile may be off. Merging does not widen it.
SKETCH_K, SKETCH_ERROR = 800, 0.005


def latency_sketches(log: DataFrame, keys: Sequence[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """``(day, *keys, queries, total, sketch)``: a mergeable summary of the latencies of each day and group.

    A row takes a few kB, whatever the number of queries of its day; a new day is appended and the log not kept.
    """
    day = F.to_date(ts).alias("day")
    return (
        log.select(day, *keys, F.col(value).cast("double").alias("v"))
        .groupBy("day", *keys)
        .agg(F.count("v").alias("queries"), F.sum("v").alias("total"), F.kll_sketch_agg_double("v", SKETCH_K).alias("sketch"))
    )


def sketched_summary(sketches: DataFrame, keys: Sequence[str], points: Mapping[str, float]) -> DataFrame:
    """``(*keys, queries, avg, one column per point)`` from stored sketches, merged over days.

    Ranks of the quantiles lie within ``SKETCH_ERROR`` of the wanted ones with 99 % confidence.
    """
    merged = sketches.groupBy(*keys).agg(
        F.sum("queries").alias("queries"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch")
    )
    return merged.select(
        *keys, "queries", (F.col("total") / F.col("queries")).alias("avg"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for n, p in points.items()],
    )


def rank_errors(log: DataFrame, keys: Sequence[str], value: str, summary: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """``(*keys, one column per point)``: how far the summary's quantiles are from the wanted ranks, as a share of the rows.

    0 where the wanted rank falls on a row of the quantile's value. One pass over the log.
    """
    side = broadcast_checked(summary.select(*keys, *[F.col(n).alias(f"_q_{n}") for n in points]))
    rows = null_safe_join(log.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v")), side, list(keys))

    def error(name: str, p: float) -> Column:
        below = F.count_if(F.col("_v") < F.col(f"_q_{name}")) / F.count("*")
        upto = F.count_if(F.col("_v") <= F.col(f"_q_{name}")) / F.count("*")
        return F.greatest(F.lit(0.0), below - p, p - upto).alias(name)

    return rows.groupBy(*keys).agg(*[error(n, p) for n, p in points.items()])


def elapsed_seconds(ts: str) -> Column:
    """Seconds between the first and the last timestamp of a group."""
    span = F.max(ts) - F.min(ts)
    seconds = F.extract(F.lit("DAY"), span) * 86400 + F.extract(F.lit("HOUR"), span) * 3600
    seconds = seconds + F.extract(F.lit("MINUTE"), span) * 60
    return (seconds + F.extract(F.lit("SECOND"), span)).cast("double")


def per_second(count: Column, elapsed: Column) -> Column:
    """count / elapsed, and 0 unless time has passed."""
    return F.when(elapsed > 0, count / elapsed).otherwise(0.0)


def latency_summary(log: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean, p95 and p99 per group."""
    means = log.groupBy(*keys).agg(F.count("*").alias("queries"), F.avg(value).alias("avg"))
    points = percentiles(log, keys, value, {"p95": 0.95, "p99": 0.99})
    return null_safe_join(means, points, list(keys), "left")


def throughput(log: DataFrame, keys: Sequence[str], ts: str = "ts", ok: Column | None = None) -> DataFrame:
    """Rows per elapsed second per group; ``ok`` restricts which rows count."""
    counted = F.count("*") if ok is None else F.count_if(ok)
    return (
        log.groupBy(*keys)
        .agg(counted.alias("queries"), elapsed_seconds(ts).alias("elapsed"))
        .withColumn("throughput", per_second(F.col("queries"), F.col("elapsed")))
    )


def configurations(df: DataFrame) -> DataFrame:
    """Add one row per grid configuration to every row of ``df``."""
    for name, values in GRID.items():
        df = df.withColumn(name, F.explode(F.array(*(F.lit(v) for v in values))))
    return df


def grid_gaps(runs: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Configurations without a result, per batch of runs."""
    done = runs.select(*batch, *CONFIG).distinct()
    expected = configurations(done.select(*batch).distinct())
    return null_safe_join(expected, done, [*batch, *CONFIG], "left_anti")


def append_runs(*logs: DataFrame) -> DataFrame:
    """Union of run logs whose columns differ; missing ones become NULL."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out


def with_size_label(df: DataFrame, size: str = "bytes") -> DataFrame:
    return df.withColumn("label", size_label(F.col(size)))


def _found(runs: DataFrame, column: str) -> list[str]:
    """The grid's values of a setting and those that runs have besides, of which there are few."""
    known = list(GRID[column])
    more = runs.filter(F.col(column).isNotNull() & ~F.col(column).isin(*known)).select(column).distinct()
    return known + sorted(r[0] for r in more.collect())


def latency_by_mode(runs: DataFrame, modes: Sequence[str] | None = None) -> DataFrame:
    """Mean latency by index kind, one column per query mode that is given or found."""
    modes = list(modes or _found(runs, "query_processing"))
    return runs.groupBy("indexing_stage").pivot("query_processing", modes).agg(F.avg("avg"))


def size_by_store(runs: DataFrame) -> DataFrame:
    """Mean size by index kind and store over distinct builds."""
    builds = runs.select("datastore", "compression", "indexing_stage", "size").distinct()
    return builds.groupBy("indexing_stage", "datastore").agg(
        F.count("*").alias("builds"), F.avg("size").alias("size")
    )


def skip_delta(runs: DataFrame, optimizations: Sequence[str] | None = None) -> DataFrame:
    """TAAT mean latency by index kind per optimisation, given or found, and the change by skip pointers."""
    taat = runs.filter(F.col("query_processing") == "taat")
    settings = list(optimizations or _found(taat, "optimization"))
    wide = taat.groupBy("indexing_stage").pivot("optimization", settings).agg(F.avg("avg"))
    return wide.withColumn("delta", F.col("skip_pointers") - F.col("none"))


def latency_vs_throughput(runs: DataFrame) -> DataFrame:
    return runs.select("datastore", "compression", "avg", "throughput", "size")


def latency_vs_footprint(runs: DataFrame) -> DataFrame:
    return runs.select("query_processing", "indexing_stage", "datastore", "avg", "size")


def tag_runs(log: DataFrame) -> DataFrame:
    """Add to each row of an ``events`` log the configuration it ran under.

    The user number, read in mixed radix, names the configuration.
    """
    digit = F.col("user_id")
    config = {}
    for name, values in GRID.items():
        config[name] = F.element_at(F.array(*(F.lit(v) for v in values)), (digit % len(values) + 1).cast("int"))
        digit = F.floor(digit / len(values))
    return log.withColumns(config)


def runs_from_log(log: DataFrame, batch: Sequence[str] = (), tails: bool = True) -> DataFrame:
    """Run results out of a query log: one run per batch and configuration.

    ``value`` is the latency of a row, the length of ``props`` its share of the
    footprint. ``tails=False`` leaves out the percentiles and the passes they need.
    """
    keys = [*batch, *CONFIG]
    tagged = tag_runs(log)
    runs = tagged.groupBy(*keys).agg(
        F.count("*").alias("queries"),
        F.avg("value").alias("avg"),
        F.sum(F.length("props")).cast("double").alias("size"),
        elapsed_seconds("ts").alias("elapsed"),
    )
    rate = per_second(F.col("queries"), F.col("elapsed")).alias("throughput")
    if not tails:
        return runs.select(*keys, "avg", rate, "size")
    points = percentiles(tagged, keys, "value", {"p95": 0.95, "p99": 0.99})
    return null_safe_join(runs, points, keys, "left").select(*keys, "avg", "p95", "p99", rate, "size")
