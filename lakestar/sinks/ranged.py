"""Keyed tables as files, in which a write replaces only the key ranges that it touches.

A table is a folder with

- `bounds`: the keys that cut it into ranges, as Parquet, written once;
- `data/write=N/range=K`: the rows of range K as write N left them, N being a name that no other run has;
- `manifest/N.json`: for every range the write that holds its current rows.

A write reads the ranges that its rows fall into, writes their new rows below a folder of its own, and then
puts a manifest beside the older ones, under a name that must not be there yet. So a run that is killed leaves the
last manifest and all that it names untouched, and of two writers at once one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestar.operators.ordering import bounds, with_rank

#: The range of a row, as a folder.
RANGE = "range"


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all finished writes, in order."""
    fs, pattern = _place(spark, f"{root}/manifest/*.json")
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in fs.globStatus(pattern) or [])


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default the newest; None for a table that is not there."""
    known = versions(spark, root)
    if version is None and not known:
        return None
    text = spark.read.text(f"{root}/manifest/{known[-1] if version is None else version}.json", wholetext=True)
    return json.loads(text.first()[0])


def _commit(spark: SparkSession, root: str, content: dict) -> None:
    """Puts a manifest in place at once; an error if another writer has put this number there."""
    fs, draft = _place(spark, f"{root}/manifest/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    target = _place(spark, f"{root}/manifest/{content['version']}.json")[1]
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {content['version']} of {root} has been written meanwhile")


def _with_range(spark: SparkSession, root: str, df: DataFrame, keys: Sequence[str], ranges: int) -> DataFrame:
    """`df` with the range of each row."""
    cuts = spark.read.parquet(f"{root}/bounds").agg(F.sort_array(F.collect_list("key"))).scalar()
    return with_rank(df, keys, cuts, ranges, RANGE)


def _write(
    spark: SparkSession, root: str, df: DataFrame, keys: Sequence[str], ranges: int, version: int
) -> dict[str, str]:
    """Writes rows below a folder of their own, a sorted file or more for each range; returns the ranges with the
    name of that folder."""
    placed = _with_range(spark, root, df, keys, ranges).hint("rebalance", F.col(RANGE))
    name = f"{version}-{uuid.uuid4().hex}"
    path = f"{root}/data/write={name}"
    placed.sortWithinPartitions(RANGE, *keys).write.mode("overwrite").partitionBy(RANGE).parquet(path)
    fs, pattern = _place(spark, f"{path}/{RANGE}=*")
    return {f.getPath().getName().split("=")[1]: name for f in fs.globStatus(pattern) or []}


def write_ranged(
    df: DataFrame, root: str, keys: Sequence[str], ranges: int, batch: int | None = None
) -> None:
    """A new table with one row per key, in about `ranges` key ranges of equal size.

    `batch` is any number that the caller wants to find in the manifest again. The ranges stay as they are cut
    now, so start with rows that stand for what will come.
    """
    spark = df.sparkSession
    if RANGE in df.columns:
        raise ValueError(f"a column must not be named {RANGE}")
    if versions(spark, root):
        raise RuntimeError(f"{root} holds a table")
    cuts = df.agg(F.lit(1)).select(F.explode(bounds(df, keys, ranges)).alias("key"))
    cuts.write.mode("overwrite").parquet(f"{root}/bounds")
    written = _write(spark, root, df, keys, ranges, 0)
    content = {"version": 0, "keys": [*keys], "ranges": ranges, "schema": df.schema.json(), "batch": batch}
    _commit(spark, root, {**content, "writes": written})


def _rows(spark: SparkSession, root: str, content: dict, wanted: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(content["schema"]))
    chosen = [(r, w) for r, w in content["writes"].items() if wanted is None or int(r) in wanted]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/data/write={w}/{RANGE}={r}" for r, w in chosen))


def read_ranged(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The rows of a version, by default the newest; None for a table that is not there."""
    content = manifest(spark, root, version)
    return None if content is None else _rows(spark, root, content)


def merge_ranged(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    batch: int | None = None,
) -> set[int]:
    """Writes the next version and returns the ranges that were written again: those that rows of `source`
    fall into.

    `merge` gets the current rows of these ranges and `source`, and returns their new rows; `keyed.upsert`,
    `keyed.insert_ignore` and the like do this. It may leave keys out but not move them.
    """
    content = manifest(spark, root)
    keys, ranges = content["keys"], content["ranges"]
    # No more rows than the table has ranges.
    placed = _with_range(spark, root, source.select(*keys), keys, ranges)
    touched = {r[0] for r in placed.select(RANGE).distinct().collect()}
    version = content["version"] + 1
    kept = {r: w for r, w in content["writes"].items() if int(r) not in touched}
    if touched:
        merged = merge(_rows(spark, root, content, touched), source)
        columns = StructType.fromJson(json.loads(content["schema"])).names
        written = _write(spark, root, merged.select(*columns), keys, ranges, version)
        if not {int(r) for r in written} <= touched:
            raise ValueError("a merge must not move rows to other key ranges")
        kept |= written
    _commit(spark, root, {**content, "version": version, "batch": batch, "writes": kept})
    return touched


def expire(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Removes all versions but the newest `keep`, and the files that only removed ones name.

    Readers of removed versions fail, so keep as many as queries that are still running may read.
    """
    known = versions(spark, root)
    old, new = known[:-keep], known[-keep:]
    needed = {(r, w) for v in new for r, w in manifest(spark, root, v)["writes"].items()}
    for version in old:
        named = {(r, w) for r, w in manifest(spark, root, version)["writes"].items()} - needed
        for r, w in named:
            fs, folder = _place(spark, f"{root}/data/write={w}/{RANGE}={r}")
            fs.delete(folder, True)
        fs, file = _place(spark, f"{root}/manifest/{version}.json")
        fs.delete(file, False)
