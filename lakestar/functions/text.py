"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.operators.ordering import running_sum, written_out


def full_name(first: str, last: str) -> Column:
    """`first last`; null if either is null."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def capitalized(column: str) -> Column:
    """First letter upper case, the others lower."""
    value = F.col(column)
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substring(value, 2, 2**31 - 1)))


def group_concat(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str,
    distinct: bool = False,
    sep: str = ", ",
) -> DataFrame:
    """The values of each group as one text, in value order; nulls are left out.

    The text is one cell, so this is for groups that are small by nature. With `distinct`, copies
    of a value are dropped before the shuffle to the group.
    """
    if distinct:
        df = df.select(*keys, column).distinct()
    text = f"listagg(`{column}`, '{sep}') within group (order by `{column}`)"
    return df.groupBy(*keys).agg(F.expr(text).alias(name))


def paged_concat(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str,
    distinct: bool = False,
    sep: str = ", ",
    page_chars: int = 1 << 16,
    page: str = "page",
) -> DataFrame:
    """The values of each group as pages of text in value order: `keys`, `page` (from 0), `name`; nulls are left
    out. Pages joined by `sep` in their order are the text of `group_concat`.

    A page holds `page_chars` characters and at most one value more, whatever the size of the group. Equal
    values are counted first; running lengths, spread over tasks, tell where a page ends.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    if distinct:
        values = values.withColumn("_n", F.lit(1).cast("long"))
    size = F.length(column) + F.lit(len(sep))
    sized = values.withColumn("_chars", F.col("_n") * size)
    summed = running_sum(sized, keys, [column], "_chars", "_upto", ties=[])
    if distinct:
        copies = summed.withColumn("_copy", F.lit(0).cast("long"))
    else:
        copies = written_out(summed, "_n", "_copy")
    before = F.col("_upto") - F.col("_chars") + F.col("_copy") * size
    paged = copies.select(*keys, F.floor(before / page_chars).cast("long").alias(page), column)
    text = f"listagg(`{column}`, '{sep}') within group (order by `{column}`)"
    return paged.groupBy(*keys, page).agg(F.expr(text).alias(name))


def words(df: DataFrame, column: str, pattern: str = r"\s+") -> DataFrame:
    """One row per word of the whole text, lower-cased, column `word`."""
    split = F.split(F.lower(F.col(column)), pattern)
    return df.select(F.explode(split).alias("word")).where(F.col("word") != "")


def count_values(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """How often each value occurs."""
    return df.groupBy(column).agg(F.count("*").alias(name))
