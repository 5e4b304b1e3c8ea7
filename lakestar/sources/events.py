"""Cleaning of raw event files into one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.sources.files import Paths, read_csv

CONSOLIDATED_COLUMNS = [
    "artist",
    "firstName",
    "gender",
    "itemInSession",
    "lastName",
    "length",
    "level",
    "location",
    "sessionId",
    "song",
    "userId",
]


def not_blank(column: str):
    return F.col(column).isNotNull() & (F.trim(F.col(column)) != "")


def consolidate(df: DataFrame, required: str, columns: Sequence[str]) -> DataFrame:
    """The wanted columns of the rows whose `required` column is filled in."""
    return df.where(not_blank(required)).select(*columns)


def consolidate_event_files(spark: SparkSession, path: Paths) -> DataFrame:
    """All daily event CSV files as one table of song events."""
    return consolidate(read_csv(spark, path, schemas.EVENT_CSV), "artist", CONSOLIDATED_COLUMNS)


def user_id(column: str) -> Column:
    """An id written as text, as a 64-bit number; null if blank. Any other text is an error."""
    text = F.trim(F.col(column))
    return F.when(text != "", text.cast("bigint"))


def with_user_id(log: DataFrame, column: str = "userId") -> DataFrame:
    """Rows of known users, the id as a number. Only signed-out rows, with a blank id, are left out."""
    return log.where(not_blank(column)).withColumn(column, user_id(column))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in any of `columns`."""
    return df.dropna(how="any", subset=list(columns))
