"""Incremental ingest: new document files become partial indexes."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.operators.postings import postings_in
from lexigrid.plans.build import analyzed_documents, listed
from lexigrid.sources.index_store import write_block


def ingest(
    spark: SparkSession,
    source: str,
    blocks: str,
    checkpoint: str,
    schema="doc_id long, text string",
    files_per_batch: int = 100,
    pattern: str | None = None,
    codec: str = "zstd",
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Index all files that have arrived in ``source`` since the last call.

    Each micro-batch is one block with its documents and rejects. It is named by the stream, whose id the
    checkpoint keeps, and the batch: several streams can share a blocks folder, a batch repeated after a
    failure overwrites its own block, and a stream begun anew adds blocks beside the old ones. Blocks are
    ordered by the time they were written, and the later wins in a merge. Stemming comes with the merge
    (:func:`lexigrid.plans.build.build_from_blocks`).
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    docs = reader.parquet(source).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        documents, rejects = analyzed_documents(batch)
        rows, listing = postings_in(documents), listed(documents, rejects)
        write_block(rows, listing, rejects, blocks, stream, batch_id, time.time_ns() // 1000, codec)

    (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
