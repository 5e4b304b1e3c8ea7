"""Keys of dimension values that stay the same from run to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.ordering import add_row_numbers
from lakestar.sinks.files import read_snapshot, write_snapshot


def _match(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    match = F.lit(True)
    for c in columns:
        match = match & left[c].eqNullSafe(right[f"_r_{c}"])
    return match


def extend_keys(values: DataFrame, columns: Sequence[str], key: str, known: DataFrame | None = None) -> DataFrame:
    """The key map (`key`, `columns`) after `values` have been seen.

    Values that `known` holds keep their key; new ones get the next numbers, in the order of `columns`. Rows
    that are null in all columns have no key. No job runs before the result is used.
    """
    columns = list(columns)
    found = values.select(*columns).distinct().dropna(how="all")
    if known is None:
        return add_row_numbers(found, columns, key, ties=[])
    renamed = known.select(*(F.col(c).alias(f"_r_{c}") for c in columns))
    fresh = found.join(renamed, _match(found, renamed, columns), "left_anti")
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    numbered = add_row_numbers(fresh, columns, "_nth", ties=[])
    added = numbered.select((F.col("_nth") + last).alias(key), *columns)
    return known.select(F.col(key).cast("long").alias(key), *columns).unionByName(added)


def replace_by_key(df: DataFrame, keys: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """`df` with `key` instead of `columns`; a row that is null in all of them keeps a null key."""
    columns = list(columns)
    renamed = keys.select(key, *(F.col(c).alias(f"_r_{c}") for c in columns))
    rest = [c for c in df.columns if c not in columns]
    return df.join(renamed, _match(df, renamed, columns), "left").select(*rest, key)


def store_keys(
    spark: SparkSession, values: DataFrame, columns: Sequence[str], key: str, root: str, run: int
) -> DataFrame:
    """The key map of run number `run`, built from the newest one of an earlier run below `root`, written
    there and read again. A run that is repeated writes the same map."""
    schema = f"{key} long, " + ", ".join(f"{c} {values.schema[c].dataType.simpleString()}" for c in columns)
    known = read_snapshot(spark, root, schema, before=run)
    write_snapshot(extend_keys(values, columns, key, known), root, run)
    return read_snapshot(spark, root, schema, before=run + 1)
