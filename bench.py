"""Time the headline queries and print one JSON line.

Each query runs once to warm up and once under the clock, into the ``noop`` sink.
The index is built from the documents under the clock, too (``index_build``); queries
that search run on the stored index. Batch queries answer a whole table of queries in
one job, so their time is also given per query.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lexigrid.plans import registry
from lexigrid.plans.fixtures import WORKLOAD
from lexigrid.sources.index_store import total_bytes

QUERIES = (
    "tf_postings document_frequency term_dictionary bool_and bool_nested phrase_strict rank_tfidf "
    "bool_batch rank_workload bool_batch_passages phrase_batch_strict rank_presence_batch "
    "rank_tf_batch rank_tfidf_batch df_lookup_zero_fill merge_blocks stem_words "
    "latency_summary run_results grid_gaps report_latency_by_mode "
    "tfidf_index index_load merge_blocks_to_tables merge_blocks_porter index_violations stream_ingest"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        run()
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    def build() -> None:
        registry.forget_indexes()
        registry.index_of(spark, sf_dir)

    timed("index_build", build)
    queries = registry.registered()
    for name in QUERIES:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    docs = registry.read_table(spark, sf_dir, "documents").count()
    passages = registry.read_table(spark, sf_dir, "benchmark").count()
    per_query = {n: len(WORKLOAD) for n in ("bool_batch", "rank_workload")} | {
        n: passages
        for n in (
            "bool_batch_passages", "phrase_batch_strict", "rank_presence_batch", "rank_tf_batch", "rank_tfidf_batch",
        )
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "docs_per_sec": round(docs / times["index_build"], 1),
                "ms_per_query": {n: round(1000 * times[n] / c, 2) for n, c in per_query.items()},
                "index_bytes": total_bytes(spark, registry.index_path(spark, sf_dir)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
