"""Row numbers and running sums against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.operators import ordering
from tests.conftest import rows


@pytest.fixture(autouse=True)
def many_partitions(settings):
    """Small test data must not be merged into one partition."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")


@pytest.fixture
def events(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        user = 1 if rng.random() < 0.5 else rng.randrange(2, 40)
        value = None if rng.random() < 0.05 else rng.randrange(3)
        data.append((user, rng.randrange(400), i, value))
    data += [(None, 5, 9000, 1), (None, 6, 9001, 2)]
    return spark.createDataFrame(data, "user int, ts int, id int, v int").repartition(7)


def test_unique_rows_numbered_as_row_number(events):
    numbered = ordering.add_row_numbers(events, ["ts", "user"], "n", ties=["id"])
    order = Window.orderBy("ts", "user", "id")
    assert rows(numbered, "n", "id") == rows(
        events.select(F.row_number().over(order).alias("n"), "id")
    )


@pytest.mark.parametrize("block", [100_000, 7])
def test_equal_rows_each_get_a_number(events, monkeypatch, block):
    monkeypatch.setattr(ordering, "BLOCK", block)
    pairs = events.select("user", "v")
    numbered = ordering.add_row_numbers(pairs, ["user"], "n", start=0)
    order = Window.orderBy("user", "v")
    assert rows(numbered, "n", "user", "v") == rows(
        pairs.select((F.row_number().over(order) - 1).cast("long").alias("n"), "user", "v")
    )


def test_row_numbers_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert ordering.add_row_numbers(empty, ["a"], "n").count() == 0
    assert ordering.add_row_numbers(empty, ["a", "b"], "n", ties=[]).count() == 0


@pytest.mark.parametrize("peers", [False, True])
@pytest.mark.parametrize("order", [["ts"], ["-ts"], ["-ts", "id"]])
def test_running_sum_is_the_sum_up_to_a_row(events, order, peers):
    plain = ordering.running_sum(events, ["user"], order, "v", "s", peers)
    by_user = {}
    for user, ts, ident, v, s in plain.collect():
        by_user.setdefault(user, []).append((ts, ident, v, s))
    sign = -1 if order[0].startswith("-") else 1

    def key(r):
        return (sign * r[0], r[1]) if len(order) == 2 or not peers else (sign * r[0],)

    for found in by_user.values():
        for row in found:
            upto = [r[2] for r in found if key(r) <= key(row) and r[2] is not None]
            assert row[3] == (sum(upto) if upto else None)


def test_hot_key_is_spread_over_tasks(spark):
    one_key = spark.range(20000).select(
        F.lit("hot").alias("k"), F.col("id").alias("ts"), F.lit(1).alias("v")
    )
    summed = ordering.running_sum(one_key, ["k"], ["ts"], "v", "s")
    assert summed.where("s != ts + 1").count() == 0
    placed = ordering.with_part(one_key, ["k", "-ts"])
    sizes = [r[1] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20000 / 4
    cut = placed.groupBy("_part").agg(F.min("ts"), F.max("ts")).orderBy("_part").collect()
    assert all(after[2] < before[1] for before, after in zip(cut, cut[1:]))


def test_copies_of_one_row_are_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK", 500)
    copies = spark.range(0, 20000, 1, 8).select(F.lit("same").alias("a"))
    numbered = ordering.add_row_numbers(copies, ["a"], "n")
    assert rows(numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [(1, 20000, 20000)]
    sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 20000 * 0.6


def test_place_in_the_source_tells_copies_apart(spark, tmp_path):
    spark.range(0, 6000, 1, 3).select((F.col("id") % 2).alias("a")).write.parquet(str(tmp_path / "t"))
    table = ordering.source_row(spark.read.parquet(str(tmp_path / "t")))
    numbered = ordering.add_row_numbers(table, ["-a"], "n", ties=["_row"])
    assert rows(numbered.groupBy("a").agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [
        (0, 3001, 6000, 3000),
        (1, 1, 3000, 3000),
    ]
    placed = ordering.with_part(table, ["a", "_row"])
    sizes = [r[1] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000


def test_nulls_strings_and_directions(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1.5, 2.5]), i) for i in range(500)]
    df = spark.createDataFrame(data, "s string, x double, i int").repartition(5)
    for order in (["s", "x", "i"], ["-s", "x", "-i"], ["s", "-x", "i"]):
        window = Window.orderBy(*ordering._sort(order))
        expected = df.select(F.row_number().over(window).alias("n"), "i")
        assert rows(ordering.add_row_numbers(df, order, "n", ties=[]), "n", "i") == rows(expected)


def test_no_job_runs_before_an_action(spark, events):
    spark.sparkContext.setJobGroup("planned", "planned")
    numbered = ordering.add_row_numbers(events, ["ts"], "n", ties=["id"])
    summed = ordering.running_sum(events, ["user"], ["ts"], "v", "s")
    numbered._jdf.queryExecution().executedPlan(), summed._jdf.queryExecution().executedPlan()
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("planned")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == []


def test_checkpoint_folder_is_the_configured_one(spark):
    from lakestar.session import ensure_checkpoint_dir

    assert spark.conf.get("spark.checkpoint.dir") in ensure_checkpoint_dir(spark)
