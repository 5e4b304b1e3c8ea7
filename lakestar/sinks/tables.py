"""Catalog tables and physical layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestar.operators.joins import SHARE, share_hot_keys
from lakestar.operators.ordering import bounds, with_rank


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """An empty Parquet table unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def recreate_tables(spark: SparkSession, tables: Mapping[str, StructType]) -> None:
    """Drop and create every table of a schema map."""
    for name, schema in tables.items():
        drop_table(spark, name)
        create_table(spark, name, schema)


def append_by_name(df: DataFrame, table: str) -> None:
    """INSERT INTO ... SELECT with columns matched by name, cast to the table's types.

    Columns the frame lacks become null; columns the table lacks are an error.
    """
    schema = df.sparkSession.table(table).schema
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")
    aligned = df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        )
    )
    aligned.write.insertInto(table)


def change_type(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """A column with another type; write the result as the table's next version."""
    return df.withColumn(column, F.col(column).cast(data_type))


def columns_of(df: DataFrame) -> DataFrame:
    """Column names and types of a frame or table, as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def write_for_query(
    df: DataFrame,
    path: str,
    partition_keys: Sequence[str],
    cluster_keys: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """A copy of the data laid out for one lookup: by partition key, then in clustering order.

    Files are cut by range over both, so each file covers a narrow key range (its footer
    statistics let a lookup skip the others) and a key with very many rows spreads over files.
    """
    order = [F.col(c) for c in (*partition_keys, *cluster_keys)]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def lookup(df: DataFrame, key: Mapping[str, object], order: Sequence[str] = ()) -> DataFrame:
    """Rows of one key, in clustering order. Any column may be given, key prefix or not."""
    for column, value in key.items():
        df = df.where(F.col(column) == F.lit(value))
    return df.orderBy(*order) if order else df


def save_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    sort_keys: Sequence[str] = (),
) -> None:
    """A table bucketed by `keys`, for joins on them without a shuffle.

    Rows are gathered by key first (few files per bucket); the adaptive planner splits a hot one.
    """
    gathered = df.hint("rebalance", *(F.col(k) for k in keys))
    writer = gathered.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    (writer.sortBy(*sort_keys) if sort_keys else writer).saveAsTable(table)


def save_colocated(
    fact: DataFrame,
    dimension: DataFrame,
    tables: tuple[str, str],
    key: str,
    buckets: int,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A fact and a dimension as two tables bucketed alike, for `operators.joins.colocated_join`.

    Both are bucketed by `key`, which both have, and by the shares of hot keys, so that a key with a
    third of all rows fills a third of the buckets. A bucket is one sorted file and later one task: choose
    `buckets` by the size of the fact. Files go below `path`, or to the warehouse.
    """
    pair = share_hot_keys(fact, dimension, key, buckets)
    for df, table in zip(pair, tables):
        dealt = df.repartition(buckets, key, SHARE).sortWithinPartitions(key, SHARE)
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key, SHARE).sortBy(key, SHARE)
        (writer.option("path", f"{path}/{table}") if path else writer).saveAsTable(table)
    return fact.sparkSession.table(tables[0]), fact.sparkSession.table(tables[1])


def save_sorted(
    df: DataFrame, table: str, sort_keys: Sequence[str], ties: Sequence[str] = (), path: str | None = None
) -> None:
    """A table whose files each cover a narrow range of `sort_keys`, so scans can skip files.

    `ties` tell rows with equal keys apart, so that a value with many rows fills several files.
    """
    order = [F.col(c) for c in (*sort_keys, *ties)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    _save(ranged, table, path)


def _save(df: DataFrame, table: str, path: str | None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", f"{path}/{table}") if path else writer).saveAsTable(table)


#: Ranges that an interleaved layout tells apart in each column, as a power of two.
BITS = 8


def interleaved(df: DataFrame, columns: Sequence[str], name: str = "_z") -> DataFrame:
    """`df` with a number whose bits are taken in turn from the ranks of `columns`: the first bits of all of
    them, then the second ones, and so on. A rank is one of 2 ** BITS ranges with about as many values each.
    """
    ranked = df
    for i, column in enumerate(columns):
        cuts = bounds(df.select(column).distinct(), [column], 1 << BITS)
        ranked = with_rank(ranked, [column], cuts, 1 << BITS, f"_rank{i}")
    number = F.lit(0).cast("long")
    for bit in reversed(range(BITS)):
        for i in range(len(columns)):
            one = F.shiftright(F.col(f"_rank{i}"), bit).bitwiseAND(F.lit(1))
            number = number * 2 + one
    return ranked.select(*df.columns, number.alias(name))


def save_interleaved(
    df: DataFrame, table: str, columns: Sequence[str], ties: Sequence[str], files: int, path: str | None = None
) -> None:
    """A table in about `files` files, each of which covers a narrow range of every one of `columns`, so that a
    filter on any of them, or on several, skips files.

    `ties` tell rows apart that are equal in `columns`: a hot value fills several files. At most seven columns.
    """
    if not 1 <= len(columns) <= 7:
        raise ValueError("one to seven columns")
    numbered = interleaved(df, columns)
    order = [F.col(c) for c in ("_z", *columns, *ties)]
    ranged = numbered.repartitionByRange(files, *order).sortWithinPartitions(*order)
    _save(ranged.drop("_z"), table, path)
