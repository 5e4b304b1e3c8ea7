"""Compares physical layouts of the same data: time to load, time per query, gain in percent.

Layouts: row files (CSV), plain Parquet tables, and tables bucketed or sorted by key. Works on
copies below a new scratch folder. Settings as for bench.py.
"""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from bench import seconds
from lakestar.operators import olap
from lakestar.operators import star_benchmark as ssb
from lakestar.operators.activity import latest_level
from lakestar.operators.joins import colocated_join
from lakestar.operators.ordering import add_row_numbers
from lakestar.plans import tables as t
from lakestar.session import build_session
from lakestar.sinks.files import write_csv
from lakestar.sinks.tables import save_colocated, save_sorted

BUCKETS = 16


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def gain(slow: float, fast: float) -> float:
    return round(100 * (slow - fast) / slow, 1)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="lakestar-layouts-")
    spark = build_session(
        "layouts",
        f"local[{cpus}]",
        8,
        spark__driver__memory="16g",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/checkpoint",
        # Else the test tables are small enough to broadcast, and layout would not matter.
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = t.lineorder(spark, folder).drop("order_id")
    part = t.benchmark_part(spark, folder)
    supplier = t.benchmark_supplier(spark, folder)
    schema = lines.schema
    keyed = part.withColumnRenamed("p_partkey", "lo_partkey")

    load = {
        "csv": seconds(lambda: write_csv(lines, f"{scratch}/csv")),
        "plain": seconds(lambda: lines.write.saveAsTable("lines_plain")),
        "bucketed": seconds(
            lambda: save_colocated(lines, keyed, ("lines_dist", "part_dist"), "lo_partkey", BUCKETS)
        ),
        "sorted": seconds(lambda: save_sorted(lines, "lines_sorted", ["lo_orderdate"])),
    }
    part.write.saveAsTable("part_plain")
    csv = spark.read.schema(schema).csv(f"{scratch}/csv", header=True)
    plain, dist, ordered = (spark.table(f"lines_{n}") for n in ("plain", "dist", "sorted"))
    parts, parts_dist = spark.table("part_plain"), spark.table("part_dist")

    def located():
        joined = colocated_join(dist, parts_dist, "lo_partkey")
        return joined.groupBy("lo_orderdate").agg(F.sum(ssb.discount_revenue()))

    def one_dim(table):
        return lambda: ssb.one_dim(table, 1997, 1, 3, 24)

    def monthly(table):
        return table.select(
            F.month("lo_orderdate").alias("month"), "lo_suppkey", "lo_extendedprice"
        )

    events = t.activity(spark, folder).withColumnRenamed("page", "level")
    events = events.select("user_id", "level", "ts", "event_id")
    last = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    orders = t.orders(spark, folder)

    keys = ["month", "lo_suppkey"]
    pairs = {
        "one_dim: csv, parquet": (one_dim(csv), one_dim(plain)),
        "one_dim: plain, sorted by day": (one_dim(plain), one_dim(ordered)),
        "same_dist: plain, bucketed": (lambda: ssb.same_dist(plain, parts), located),
        "star join: shuffled, broadcast": (
            lambda: plain.join(supplier, F.col("lo_suppkey") == F.col("s_suppkey")),
            lambda: plain.join(supplier, F.col("lo_suppkey") == F.col("s_suppkey")),
        ),
        "cube: union, one pass": (
            lambda: olap.cube_by_union(monthly(plain), *keys, "lo_extendedprice"),
            lambda: olap.cube(monthly(plain), keys, "lo_extendedprice"),
        ),
        "latest level: window, aggregate": (
            lambda: events.withColumn("n", F.row_number().over(last)).where("n = 1"),
            lambda: latest_level(events, "user_id", "level", ["ts", "event_id"]),
        ),
        "row numbers: one partition, ranges": (
            lambda: orders.withColumn(
                "n", F.row_number().over(Window.orderBy("payment_date", "order_id"))
            ),
            lambda: add_row_numbers(orders, ["payment_date", "order_id"], "n", ties=[]),
        ),
    }
    queries = {}
    for name, (slow, fast) in pairs.items():
        run(slow()), run(fast())
        a = min(seconds(lambda: run(slow())) for _ in range(3))
        b = min(seconds(lambda: run(fast())) for _ in range(3))
        queries[name] = {"first": round(a, 3), "second": round(b, 3), "gain_percent": gain(a, b)}
    print(json.dumps({"load_sec": {k: round(v, 3) for k, v in load.items()}, "queries": queries}))
    spark.stop()


if __name__ == "__main__":
    main()
