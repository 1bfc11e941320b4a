"""Restartable runs: do what is wanted and not there yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import BROADCAST_ROWS
from ..operators.staging import stage
from .writers import gathered

#: Up to so many open tasks, their values are also written into the filter of a scan.
LITERAL_TASKS = 1_000


def task_grid(spark: SparkSession, domains: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the given parameter values."""
    tasks = spark.range(1).select()
    for name, values in domains.items():
        tasks = tasks.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return tasks


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wanted tasks without a result; missing values are equal."""
    there = done.select(*[F.col(k).alias(f"_done_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in keys]
    return wanted.join(there, reduce(lambda a, b: a & b, same), "left_anti")


def preferred_first(tasks: DataFrame, column: str, value) -> DataFrame:
    """Tasks with the preferred value first, the rest in order."""
    return tasks.orderBy(F.col(column) != value, column)


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # a write that broke off leaves no folder, or one without a file
        if (e.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def finished(spark: SparkSession, path: str) -> DataFrame | None:
    """The tasks whose results below ``path`` are complete; None if there are none.

    They are kept in a table of their own beside it, so that a task without any
    row counts too and one that broke off does not.
    """
    return _read_if_there(spark, f"{path}-finished")


def open_tasks(
    spark: SparkSession, wanted: DataFrame, path: str, keys: Sequence[str]
) -> DataFrame | None:
    """Wanted tasks (keys as text) that are not finished; None if all are.

    All wanted tasks are kept with a mark, and the open ones chosen by it: the
    choice is a filter that :func:`restrict` prunes scans by.
    """
    wanted = wanted.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()
    done = finished(spark, path)
    left = wanted if done is None else pending(wanted, done, keys)
    marked = stage(left.withColumn("_open", F.lit(1)), "open-tasks").where(F.col("_open") == 1)
    return None if marked.isEmpty() else marked.select(*keys)


def restrict(df: DataFrame, tasks: DataFrame) -> DataFrame:
    """Rows that belong to one of the tasks, by the keys that ``df`` has.

    Keys are compared in the type they have in ``df`` by plain equality, so that a
    scan of a table partitioned by them reads only the folders of the tasks.  A few
    tasks are also given as literals, which skips files whose names tell the key.
    Missing keys match missing keys, in a pass of their own if any task has one.
    """
    keys = [k for k in tasks.columns if k in df.columns]
    if not keys:
        return df
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # a few tasks tell all in one job
    few = tasks.select(*keys).limit(LITERAL_TASKS + 1).collect()
    if len(few) <= LITERAL_TASKS:
        n, any_nameless = len(few), any(v is None for row in few for v in row)
    else:
        n, any_nameless = tasks.agg(F.count(F.lit(1)), F.max(nameless)).first()

    def belonging(rows: DataFrame, chosen: DataFrame, null_safe: bool) -> DataFrame:
        same = []
        for k in keys:
            task = F.col(f"_task_{k}").try_cast(df.schema[k].dataType)
            same.append(F.col(k).eqNullSafe(task) if null_safe else F.col(k) == task)
        chosen = chosen.select(*[F.col(k).alias(f"_task_{k}") for k in keys])
        chosen = F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen.distinct()
        return rows.join(chosen, reduce(lambda a, b: a & b, same), "left_semi")

    rows = df
    if n <= LITERAL_TASKS:
        for i, k in enumerate(keys):
            rows = rows.where(F.col(k).cast("string").isin(sorted({r[i] for r in few} - {None})))
    named = belonging(rows, tasks.where(~nameless), False)
    if not any_nameless:
        return named
    return named.unionByName(belonging(df.where(nameless), tasks.where(nameless), True))


def write_tasks(
    df: DataFrame,
    tasks: DataFrame,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write the rows of the open tasks, one folder each, and mark the tasks as finished.

    Folders of these tasks that an interrupted run left are replaced; those of
    other tasks stay untouched.
    """
    keys = tasks.columns
    rows = restrict(df, tasks)
    writer = gathered(rows, keys).write.mode("overwrite").format(fmt).partitionBy(*keys)
    writer.option("partitionOverwriteMode", "dynamic").options(**(options or {})).save(path)
    tasks.coalesce(1).write.mode("append").parquet(f"{path}-finished")
