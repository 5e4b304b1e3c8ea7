"""Example rows of a table, the same ones in every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_order(keys: Sequence[str], seed: int = 0) -> Column:
    """The place of a row in the draw: a digest of the seed and its key columns, as text.

    It depends on nothing else, so every engine with MD5 draws the same rows; null counts as no text.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """`n` whole rows, those with the smallest place in the draw.

    Each task keeps its `n` smallest and only these meet: no sort of the table and no shuffle of it. Rows that
    agree in `keys` have the same place and are taken in the order of the keys.
    """
    return df.orderBy(draw_order(keys, seed), *keys).limit(n)


def sample_by(df: DataFrame, groups: Sequence[str], keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """`n` whole rows of every group, drawn like `sample_rows`.

    Tasks keep `n` rows of a group before the shuffle, so a hot group sends `n` rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(draw_order(keys, seed), *keys))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
