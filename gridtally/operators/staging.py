"""Intermediate tables that outlive the executor that computed them."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a session within one process that has no such setting gets a folder of
    its own; on a cluster a missing setting is an error, since a machine's own
    disk is not seen by the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="gridtally-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


class _Scopes(threading.local):
    """Open scopes of a thread: two runs in one session do not remove each other's tables."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged within the scope at its end.

    For callers that have written their results by then; a result that is still
    to be computed needs its staged tables.
    """
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, and fixes values that depend on how rows were partitioned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
