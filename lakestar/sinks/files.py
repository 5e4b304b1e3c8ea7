"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    keep_other_partitions: bool = False,
) -> None:
    """Parquet files, one folder per value of `partition_by`.

    Overwriting replaces the whole table, or with `keep_other_partitions` only the folders that
    are written again.

    Rows of one folder are brought together first, or every task would write a small file into
    every folder. The rebalance hint lets the adaptive planner cut a folder that holds a large
    share of all rows into several tasks, which a plain `repartition` would not.
    """
    if partition_by:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    replaced = "dynamic" if keep_other_partitions else "static"
    writer = df.write.mode(mode).option("partitionOverwriteMode", replaced)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header, optionally with every field in quotes."""
    df.write.mode(mode).csv(path, header=True, quoteAll=quote_all, escape='"')


def write_snapshot(df: DataFrame, root: str, number: int) -> None:
    """Snapshot `number` of a keyed table. Writing the same number again replaces it."""
    df.write.mode("overwrite").parquet(f"{root}/snapshot={number}")


def read_snapshot(
    spark: SparkSession, root: str, schema, before: int | None = None
) -> DataFrame | None:
    """The newest finished snapshot (older than `before`), or None when there is none.

    A folder counts as finished once it holds the `_SUCCESS` marker of its write.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/snapshot=*/_SUCCESS"))
    numbers = [int(m.getPath().getParent().getName().split("=")[1]) for m in marks or []]
    numbers = [n for n in numbers if before is None or n < before]
    if not numbers:
        return None
    return spark.read.schema(schema).parquet(f"{root}/snapshot={max(numbers)}")
