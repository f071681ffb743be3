"""Small helpers of the operators: tables, size of the input, files that go to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, as Spark reads it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; others, whatever their names, stay out of the operator's way."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def driver_file(path: str) -> bytes:
    """A bounded parameter file (a vocabulary, a rule list), read once on the driver and sent with the job."""
    with open(path, "rb") as f:
        return f.read()


_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Send this package's source to the workers, once per application.

    Tasks refer to its functions by name; workers need not have it installed or share the driver's folders.
    """
    spark = spark or SparkSession.active()
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "lexigrid_source.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def broadcast_bytes(spark: SparkSession, data: object):
    """Send a bounded object to every worker once."""
    ship(spark)
    return spark.sparkContext.broadcast(data)


def shared_fs(path: str):
    """The file system and inner path of a folder that all executors reach."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
