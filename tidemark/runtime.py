"""What plans of this package need of a session: workers that can import it, written intermediates, numbering."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPOSITORY = str(Path(__file__).resolve().parents[1])

#: Paths written by this process and not yet removed.
_written: list[str] = []


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if REPOSITORY not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (REPOSITORY, *paths) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Only a local master may do without: then it is a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tidemark-checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_written)
    _written.append(path)
    return path


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _written:
        _written.remove(path)


def _remove_written() -> None:
    """At the end of the process: what is still there goes, if the session is still alive."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        for path in list(_written):
            with suppress(Exception):  # the JVM may be gone
                remove_path(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Removes what is written inside, but for the paths that the caller puts in the list."""
    before, keep = set(_written), []
    yield keep
    for path in [x for x in _written if x not in before and x not in keep]:
        remove_path(spark, path)


def numbered(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """rows with a column of consecutive numbers from zero in this order; no task sorts all rows.

    Rows are sorted within ranges and written; a row's number is its place in its range plus the rows
    of the ranges before, of which there is one number each.  Nulls come first.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = ranged.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    held = materialise(held, "numbered")
    before, at = [], 0
    for r in held.groupBy("_range").count().orderBy("_range").collect():  # one row for each shuffle partition
        before.append((r["_range"], at))
        at += r["count"]
    offsets = rows.sparkSession.createDataFrame(before, "_range int, _before long")
    return held.join(F.broadcast(offsets), "_range").select(*rows.columns, (F.col("_before") + F.col("_place")).alias(name))
