"""Connected components of a graph of links, with union-find in the tasks and stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import staged


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each node with the smallest node it reaches there."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for at in range(0, len(nodes), 1 << 16):
        some = nodes[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], ["a", "b"]
        )


def components(links: DataFrame) -> DataFrame:
    """`id`, `component` for each node of `links` (a, b) that is not the smallest of its component.

    Each task first reduces its links to a forest. Then rounds of large and small stars hang every
    node on smaller ones until nothing changes; the number of rounds is logarithmic. A node with
    very many neighbours is a hot key of a join with one row per key on the other side, which
    adaptive execution splits. Nothing but two sums per round comes to the driver.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    stars = staged(links.mapInArrow(_forests, "a long, b long").distinct(), "forest")

    def digest(df: DataFrame) -> tuple:
        kept = F.xxhash64("a", "b").cast("decimal(20,0)")
        return tuple(df.agg(F.count("*"), F.sum(kept)).first())

    before = digest(stars)
    while before[0]:
        # Large star: neighbours larger than a node hang on the smallest neighbour.
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        # Small star: a node and its smaller neighbours hang on the smallest of them. Large stars
        # point from larger to smaller ids, so `a` is the node and `b` its smaller neighbours.
        large = large.distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        stars = staged(root.select("a", F.col("m").alias("b")).union(small).distinct(), "stars")
        after = digest(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
