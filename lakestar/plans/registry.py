"""Named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines hand out alike: decimals as double, days as text, local times."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return value.cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return value.cast("timestamp_ntz").alias(field.name)
        return value

    return df.select(*(column(f) for f in df.schema.fields))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with the same question in SQL if there is one."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(spark, sf_dir))

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register
