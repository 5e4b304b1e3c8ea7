"""File sources: JSON, CSV, gzip, text and Parquet, always with a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Paths = str | list[str]


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    recursive: bool = False,
    pattern: str = "*.json",
    mode: str = "FAILFAST",
) -> DataFrame:
    """One JSON object per line. `path` may be a glob; `recursive` walks a whole tree instead.

    Fields are matched by name; absent ones become null. A line that cannot be read is an error; other
    modes would lose it without a word.
    """
    reader = spark.read.schema(schema).option("mode", mode)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.json(path)


def read_json_mapped(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    mapping: Mapping[str, str],
    epoch_millis: Sequence[str] = (),
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON fields placed in named columns: `mapping` is target column -> source field path.

    Targets listed in `epoch_millis` hold milliseconds since 1970 and become timestamps.
    """

    def target(name: str, source: str) -> Column:
        value = F.col(source)
        return (F.timestamp_millis(value) if name in epoch_millis else value).alias(name)

    raw = read_json(spark, path, schema, mode=mode)
    return raw.select(*(target(name, source) for name, source in mapping.items()))


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    header: bool = True,
    sep: str = ",",
    multiline: bool = False,
    mode: str = "FAILFAST",
    **options: str,
) -> DataFrame:
    """Delimited text, plain or gzip (by file suffix). A directory of parts is one table.

    `multiline` accepts line breaks inside quotes, but then a file cannot be split over tasks.
    """
    reader = spark.read.schema(schema).option("mode", mode).option("escape", '"')
    return reader.options(**options).csv(path, header=header, sep=sep, multiLine=multiline)


def read_gzip_file(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partitions: int,
    sep: str = ";",
    header: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """One big gzip file: a single task has to unpack it, so the rows are spread right after."""
    return read_csv(spark, path, schema, header, sep, mode=mode).repartition(partitions)


def read_star_files(
    spark: SparkSession, root: str, tables: Mapping[str, StructType], sep: str = "|"
) -> dict[str, DataFrame]:
    """Header-less delimited folders `root/<table>`, one frame per declared table."""
    return {
        name: read_csv(spark, f"{root}/{name}", schema, header=False, sep=sep)
        for name, schema in tables.items()
    }


def array_literal(column: str) -> Column:
    """The elements of an array written as `{a,b,c}`; quotes around an element are dropped."""
    inner = F.regexp_replace(F.col(column), r"^\{|\}$", "")
    items = F.transform(F.split(inner, ","), lambda item: F.trim(F.regexp_replace(item, '"', "")))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(items)


def read_reviews(spark: SparkSession, path: Paths, schema: StructType) -> DataFrame:
    """Header-less product reviews with the similar products as a real array."""
    raw = read_csv(spark, path, schema, header=False)
    return raw.withColumn("similar_product_ids", array_literal("similar_product_ids"))


def read_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """One row per text line, column `value`."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """Parquet, flat or partitioned. `base_path` keeps partition columns of a subfolder."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    return reader.parquet(path)


def from_rows(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A frame from literal rows."""
    return spark.createDataFrame(list(rows), schema)
