"""Writers and derived tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geoid import code_column


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete ``version=`` folders of a stored table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [status.getPath() for status in files.listStatus(folder)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    names = [p.getName() for p in done]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def newest_version(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete version."""
    found = complete_versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is stored in {path}")
    return f"{path.rstrip('/')}/version={found[-1]}"


def with_file_codes(df: DataFrame, vintage: int, level: str = "blocks") -> DataFrame:
    """Give the area code the column name that files of a vintage use."""
    return df.withColumnRenamed("geoid", code_column(vintage, level))


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together before they are written.

    Avoids a small file per task and folder; adaptive execution cuts folders
    that are too large for one file and joins small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def write_csv(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    null_value: str = "",
    sort_by: Sequence[str] = (),
    sep: str = ",",
    compression: str | None = "gzip",
    mode: str = "overwrite",
) -> None:
    """Partitioned CSV with header.

    ``null_value`` is the spelling of a missing value: empty, or ``NA``.
    """
    df = gathered(df, partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("nullValue", null_value)
        .option("emptyValue", "")
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_counts(counts: DataFrame, path: str, by: Sequence[str]) -> None:
    """Diagnostics as space-separated text, one folder per group."""
    write_csv(counts.select(*by, "year", "n"), path, by, sort_by=["year"], sep=" ", compression=None)


def write_layer(df: DataFrame, folder: str, layer: str, partition_by: Sequence[str] = ()) -> None:
    """A named layer of points or polygons."""
    writer = gathered(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder.rstrip('/')}/{layer}")


def create_table(
    spark: SparkSession,
    name: str,
    query: str,
    args: Mapping | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A stored table from a SQL query with named parameter markers."""
    writer = spark.sql(query, args=dict(args or {})).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)


def import_layers(spark: SparkSession, table: str, layers: Mapping[int, DataFrame]) -> DataFrame:
    """Several block layers as one stored table, partitioned by vintage."""
    for i, vintage in enumerate(sorted(layers)):
        rows = layers[vintage].withColumn("vintage", F.lit(int(vintage)))
        writer = rows.write.mode("overwrite" if i == 0 else "append").format("parquet")
        writer.partitionBy("vintage").saveAsTable(table)
    return spark.table(table)


def export_query(spark: SparkSession, query: str, path: str, args: Mapping | None = None) -> None:
    """The result of a SQL query as CSV."""
    write_csv(spark.sql(query, args=dict(args or {})), path, compression=None)


def drop_tables(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
