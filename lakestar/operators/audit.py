"""Checks on finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows_of(stats: DataFrame, pairs: Sequence[tuple[str, str]], label: str, value: str):
    """One wide row of statistics as (label, value) rows."""
    items = F.array(
        *(F.struct(F.lit(name).alias(label), F.col(column).alias(value)) for name, column in pairs)
    )
    return stats.select(F.inline(items))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _union(
        [
            df.agg(F.lit(name).alias("table_name"), F.count("*").alias("num_rows"))
            for name, df in tables.items()
        ]
    )


def key_audit(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and different keys per table; equal numbers mean a unique key."""
    return _union(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("num_rows"),
                F.count_distinct(key).alias("uniq_pk"),
            )
            for name, (df, key) in tables.items()
        ]
    )


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Nulls per table and column.

    Rows and values are counted, which a reader of `session.statistics_session` answers from the footers of
    the files, without reading a page. Footers cannot tell a null list from an empty one, so lists, structs and
    maps are looked at one by one, by reading these columns alone.
    """

    def listed(name: str, counts: DataFrame, columns: Sequence[str]) -> DataFrame:
        rows = _rows_of(counts, [(c, c) for c in columns], "column_name", "num_nulls")
        return rows.select(F.lit(name).alias("table_name"), "column_name", "num_nulls")

    parts = []
    for name, df in tables.items():
        nested = [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]
        plain = [c for c in df.columns if c not in nested]
        if plain:
            counts = df.agg(F.count("*").alias("_rows"), *(F.count(c).alias(c) for c in plain))
            missing = counts.select(*((F.col("_rows") - F.col(c)).alias(c) for c in plain))
            parts.append(listed(name, missing, plain))
        if nested:
            found = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in nested))
            parts.append(listed(name, found, nested))
    return _union(parts)


def each_table(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The same audit of several tables, each row with the name of its table."""
    return _union([df.select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()])


def range_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value per numeric column."""
    parts = {"min": F.min, "max": F.max}
    ends = [f(c).cast("double").alias(f"{k}_{c}") for c in columns for k, f in parts.items()]
    stats = df.agg(*ends)
    items = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"min_{c}").alias("min_value"),
                F.col(f"max_{c}").alias("max_value"),
            )
            for c in columns
        )
    )
    return stats.select(F.inline(items))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, smallest and largest value per column, in one pass."""
    parts = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    stats = df.agg(
        *(f(F.col(c)).cast("double").alias(f"{k}_{c}") for c in columns for k, f in parts.items())
    )
    items = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), *(F.col(f"{k}_{c}").alias(k) for k in parts))
            for c in columns
        )
    )
    return stats.select(F.inline(items))


def domain_audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows violating each rule. As in a CHECK constraint, an unknown result passes."""
    counts = df.agg(*(F.count_if(~rule).alias(name) for name, rule in rules.items()))
    return _rows_of(counts, [(name, name) for name in rules], "rule", "violations")


def reference_audit(
    links: Mapping[str, tuple[DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Per named link (child, child key, parent, parent key): child rows without a parent.

    Child keys are counted before the join, so each key meets the parent table once.
    """

    def orphans(name, child, child_key, parent, parent_key):
        keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_n"))
        known = parent.select(F.col(parent_key).alias("_key"))
        missing = keys.where(F.col("_key").isNotNull()).join(known, "_key", "left_anti")
        return missing.agg(
            F.lit(name).alias("link"), F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")
        )

    return _union([orphans(name, *link) for name, link in links.items()])


def matched(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with all of `columns` filled in."""
    return df.dropna(how="any", subset=list(columns))
