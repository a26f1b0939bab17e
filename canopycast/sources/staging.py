"""Staged tables in the shared folder, which outlive the executors that wrote them.

They last until ``release`` is called, which whoever started the session does when its results are written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"
R = TypeVar("R")


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only a local session may fall back to a temporary one."""
    path = spark.conf.get(_DIR, None)
    if path:
        return path
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_DIR} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="canopycast-")
    spark.conf.set(_DIR, path)
    return path


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove(path: str) -> None:
    """Remove a folder below the shared one, if it is there."""
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(path)
    if filesystem.get_file_info(path).type != fs.FileType.NotFound:
        filesystem.delete_dir(path)


def release(spark: SparkSession) -> None:
    """Remove everything this application has staged. DataFrames that read staged tables end with it."""
    remove(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``staged`` whose last reader has run; others stay."""
    for table in tables:
        if path := vars(table).get("staged_at"):
            remove(path)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows once and read them back, so several consumers share one computation."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def together(spark: SparkSession, jobs: list[Callable[[], R]], at_once: int = 8) -> list[R]:
    """Results of functions that run Spark jobs of their own, several at a time, in order."""
    if not jobs:
        return []
    with ThreadPoolExecutor(min(at_once, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def staged_together(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage tables that do not depend on each other as concurrent jobs."""
    spark = next(iter(tables.values())).sparkSession
    return dict(zip(tables, together(spark, [lambda n=name, df=df: staged(df, n) for name, df in tables.items()], len(tables))))
