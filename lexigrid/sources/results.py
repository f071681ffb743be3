"""Run results as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = ("indexing_stage", "datastore", "compression", "optimization", "query_processing")
METRICS = ("avg", "p95", "p99", "throughput", "size")


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    """Cast to double; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def drop_incomplete(df: DataFrame, required) -> DataFrame:
    """Drop rows with NULL in a required column."""
    return df.na.drop(subset=list(required))


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Read raw text cells, coerce metrics, keep complete rows."""
    schema = ", ".join(f"`{c}` string" for c in (*CONFIG, *METRICS))
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return drop_incomplete(coerce_numeric(raw, METRICS), ("avg", "throughput", "size"))
