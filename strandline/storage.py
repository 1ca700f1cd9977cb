"""Intermediate tables below the folder that driver and executors share."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: set[str] = set()
_scopes = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Only a local session (tests, a laptop) may leave it unset: a folder below java.io.tmpdir then
    serves, and the session's settings stay as they are.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{spark.sparkContext._jvm.System.getProperty('java.io.tmpdir')}/strandline-scratch"


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the shared folder; clear_scratch or the end of the driver's process removes it."""
    path = f"{shared_folder(spark)}/strandline/{what}-{uuid.uuid4().hex}"
    _made.add(path)
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.add(path)
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there and the session still lives."""
    _made.discard(path)
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the gateway may be gone at exit; the folder then stays for its owner to clear
        pass


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread makes inside are deleted at the end; what is to stay must have been written elsewhere."""
    mine: set[str] = set()
    _scopes.open = [*getattr(_scopes, "open", []), mine]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        for path in mine:
            remove(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables made so far; DataFrames that still read them can't be used any more."""
    for path in list(_made):
        remove(spark, path)


def written(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """df written to the shared folder and read back, its lineage cut, and the folder."""
    path = scratch_dir(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame, what: str = "table") -> DataFrame:
    """df written to the shared folder and read back, its lineage cut."""
    return written(df, what)[0]
