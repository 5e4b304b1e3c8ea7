"""Joins that stay balanced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.keyed import first_by

#: Which of a hot key's parts a row belongs to; 0 for other keys.
SHARE = "_share"


def first_match(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    values: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """`left` with `values` of one lookup row per key, so that no row is multiplied.

    Among several lookup rows the smallest in `values` is taken.
    """
    single = first_by(lookup.select(*on, *values).dropna(subset=list(on)), on, values)
    return left.join(single, list(on), how)


def share_hot_keys(
    fact: DataFrame, dimension: DataFrame, key: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Both tables with a column `_share`, by which a hot key fills several buckets.

    A key that holds more than the rows of one bucket has as many shares as it fills buckets. Each of its
    fact rows is dealt to one share, and its dimension rows are repeated for all of them. At most
    `buckets` keys can be hot, so their list is broadcast, and the dimension grows by 2 x `buckets` rows
    per key at most.
    """
    counts = fact.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
    every = fact.agg(F.count("*")).scalar()
    shares = F.ceil(F.col("_n") * buckets / every).cast("int").alias("_shares")
    hot = F.broadcast(counts.where(F.col("_n") * buckets > every).select("_hot", shares))

    def with_shares(df: DataFrame) -> DataFrame:
        joined = df.join(hot, df[key].eqNullSafe(F.col("_hot")), "left")
        return joined.withColumn("_shares", F.coalesce("_shares", F.lit(1))).drop("_hot")

    # Any share will do for a fact row, as the dimension is in all of them.
    dealt = F.pmod(F.monotonically_increasing_id(), F.col("_shares")).cast("int")
    facts = with_shares(fact).withColumn(SHARE, dealt)
    repeated = F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))
    dimensions = with_shares(dimension).withColumn(SHARE, repeated)
    return facts.drop("_shares"), dimensions.drop("_shares")


def colocated_join(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of a pair of tables that `sinks.tables.save_colocated` wrote: bucket meets bucket, without a shuffle.

    `how` is inner, left or left_semi.
    """
    joined = fact.join(dimension.hint("merge"), [key, SHARE], how)
    return joined.drop(SHARE)
