"""Keyed tables: one row per key, inserts, upserts, last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *(c for c in rest if c not in order)]
    row = F.struct(*(F.col(c) for c in ranked))
    chosen = df.groupBy(*keys).agg((F.max(row) if last else F.min(row)).alias("_row"))
    return chosen.select(
        *(F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns)
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. Rows equal in `order` are settled by their other columns.

    An aggregate instead of a window: each task reduces its rows before the shuffle, so a key
    that owns a large share of the rows sends one row per task.
    """
    return _pick(df, keys, order, last=True)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key, settled like `latest_by`."""
    return _pick(df, keys, order, last=False)


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """`target` plus the source rows of new keys; the first write of a key stays."""
    fresh = first_by(source, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """The next snapshot of `target` (one row per key) after writing `source` in `order`.

    A known key takes only its `update` columns, from the last source row. A new key takes its
    other columns from its first source row, as an insert followed by updates would.
    """
    columns = [c for c in target.columns if c not in keys]
    wanted = [*order, *(c for c in source.columns if c not in (*keys, *order))]
    row = F.struct(*(F.col(c) for c in wanted))
    changes = source.groupBy(*keys).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    kept = target.select(*keys, F.struct(*(F.col(c) for c in columns)).alias("_old"))
    merged = kept.join(changes, list(keys), "full_outer")

    def value(column: str):
        if column in update:
            new = F.when(F.col("_last").isNotNull(), F.col("_last")[column])
            return new.otherwise(F.col("_old")[column])
        old = F.when(F.col("_old").isNotNull(), F.col("_old")[column])
        return old.otherwise(F.col("_first")[column])

    return merged.select(
        *(F.col(c) if c in keys else value(c).alias(c) for c in target.columns)
    )
