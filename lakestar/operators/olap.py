"""Cube questions on a fact and its dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """`fact` inner-joined to each (dimension, fact key, dimension key).

    No broadcast hint: the planner broadcasts a dimension whose size allows it, else it shuffles
    and splits hot keys.
    """
    for dimension, fact_key, key in dimensions:
        fact = fact.join(dimension, fact[fact_key] == dimension[key])
    return fact


def revenue_by(
    rows: DataFrame,
    keys: Sequence[str],
    measure: str = "sales_amount",
    where: Mapping[str, Sequence] | None = None,
    top: int | None = None,
    name: str = "revenue",
) -> DataFrame:
    """Sum of `measure` per key combination.

    One value per column in `where` is a slice, several are a dice. Coarser or finer keys roll up
    or drill down. `top` keeps the largest sums; equal sums go by key.
    """
    for column, values in (where or {}).items():
        rows = rows.where(F.col(column).isin(list(values)))
    result = rows.groupBy(*keys).agg(F.sum(measure).alias(name))
    if top is None:
        return result
    return result.orderBy(F.col(name).desc(), *keys).limit(top)


def _finest(rows: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Sums per full key. Coarser sums are made from these, so only they are multiplied per set."""
    return rows.groupBy(*keys).agg(F.sum(measure).alias(measure))


def grouping_sets(
    rows: DataFrame,
    sets: Sequence[Sequence[str]],
    keys: Sequence[str],
    measure: str = "sales_amount",
) -> DataFrame:
    """Sums for several key sets in one pass. `grouping_id` tells a total from a null key."""
    columns = [[F.col(c) for c in one] for one in sets]
    finest = _finest(rows, keys, measure)
    grouped = finest.groupingSets(columns, *(F.col(k) for k in keys))
    return grouped.agg(
        F.sum(measure).alias("revenue"), F.grouping_id().cast("int").alias("grouping_id")
    )


def cube(rows: DataFrame, keys: Sequence[str], measure: str = "sales_amount") -> DataFrame:
    """Sums for every subset of `keys`, in one pass over the rows."""
    return _finest(rows, keys, measure).cube(*keys).agg(
        F.sum(measure).alias("revenue"), F.grouping_id().cast("int").alias("grouping_id")
    )


def cube_by_union(
    rows: DataFrame, first: str, second: str, measure: str = "sales_amount"
) -> DataFrame:
    """The two-key cube as four separate queries, keys as text. Kept for comparison with `cube`."""

    def level(keys: Sequence[str]) -> DataFrame:
        total = F.sum(measure).alias("revenue")
        sums = rows.groupBy(*keys).agg(total) if keys else rows.agg(total)

        def key(column: str) -> Column:
            value = F.col(column) if column in keys else F.lit(None)
            return value.cast("string").alias(column)

        return sums.select(key(first), key(second), "revenue")

    return (
        level([])
        .unionByName(level([second]))
        .unionByName(level([first]))
        .unionByName(level([first, second]))
    )


def average_by(
    rows: DataFrame, key: str, measure: str, name: str, top: int | None = None
) -> DataFrame:
    """Average per key, rounded to two places; `top` keeps the highest, equal ones by key."""
    result = rows.groupBy(key).agg(F.round(F.avg(measure), 2).alias(name))
    return result if top is None else result.orderBy(F.col(name).desc(), key).limit(top)
