"""Normal forms: lists to rows, splitting tables, and joining them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.ordering import add_row_numbers, running_sum


def list_to_rows(
    df: DataFrame, column: str, element: str, position: str | None = None
) -> DataFrame:
    """First normal form: one row per list element. Rows with an empty list disappear."""
    kept = [c for c in df.columns if c != column]
    if position:
        return df.select(*kept, F.posexplode(column).alias(position, element))
    return df.select(*kept, F.explode(column).alias(element))


def list_to_numbered_rows(
    df: DataFrame, key: str, column: str, element: str, position: str, row_id: str
) -> DataFrame:
    """(`row_id`, `key`, `position`, `element`): one row per list element, numbered from 1 by key and
    position.

    `key` is unique. Only keys and list lengths are sorted and summed up; the lists move once, to meet
    the number that their first element has, and are neither sorted nor checkpointed.
    """
    sizes = df.select(key, F.size(column).cast("long").alias("_n")).where(F.col("_n") > 0)
    summed = running_sum(sizes, [], [key], "_n", "_upto", ties=[])
    starts = summed.select(F.col(key).alias("_key"), (F.col("_upto") - F.col("_n")).alias("_before"))
    rows = df.select(key, column).join(starts, F.col(key) == F.col("_key"))
    rows = rows.select("_before", key, F.posexplode(column).alias(position, element))
    number = F.col("_before") + F.col(position) + F.lit(1)
    return rows.select(number.alias(row_id), key, position, element)


def split_parent_child(
    df: DataFrame,
    key: str,
    parent_columns: Sequence[str],
    child_id: str,
    child_key: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Second normal form: (parent: one row per key, child: the rest with its own id).

    Child ids follow `child_key` if it tells the child rows apart, else all child columns.
    """
    parent = df.select(key, *parent_columns).distinct()
    child_columns = [c for c in df.columns if c not in parent_columns]
    order, ties = (child_key, []) if child_key else (child_columns, None)
    child = add_row_numbers(df.select(*child_columns), order, child_id, ties=ties)
    return parent, child


def extract_dimension(
    df: DataFrame, columns: Sequence[str], key: str
) -> tuple[DataFrame, DataFrame]:
    """Third normal form: (table with a key instead of `columns`, dimension with that key).

    A row whose `columns` are all null keeps a null key.
    """
    columns = list(columns)
    values = df.select(*columns).distinct().dropna(how="all")
    dimension = add_row_numbers(values, columns, key, ties=[])
    renamed = dimension.select(F.col(key), *(F.col(c).alias(f"_r_{c}") for c in columns))
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    kept = [c for c in df.columns if c not in columns]
    return df.join(renamed, match, "left").select(*kept, key), dimension


def denormalize(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """`fact` with the columns of each (dimension, key) joined in; every fact row is kept."""
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, "left")
    return fact


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows with the same number of copies."""
    columns = a.columns
    if sorted(columns) != sorted(b.columns):
        return False
    sides = a.select(*columns, F.lit(1).alias("_n")).unionByName(
        b.select(*columns, F.lit(-1).alias("_n"))
    )
    uneven = sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return uneven.isEmpty()
