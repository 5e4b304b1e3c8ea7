"""Plans on data in which one key owns a third of the rows and more."""

import itertools

import pytest
from pyspark.sql import functions as F

from lakestar.operators import keyed, rental_reports
from tests.conftest import rows


@pytest.fixture
def lines(spark):
    """60,000 lines, half of them of order 0."""
    ids = spark.range(60_000)
    order = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))
    pad = F.repeat(F.lit("x"), 50).alias("pad")
    return ids.select(order.alias("k"), F.col("id").alias("v"), pad)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_a_join_is_split(spark, lines, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=100_000,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=100_000,
        spark__sql__shuffle__partitions=16,
    )
    orders = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
    joined = lines.repartition(8).join(orders, "k").groupBy("g").agg(F.sum("v").alias("s"))
    assert "skew=true" in plan(joined)


def test_latest_by_reduces_before_the_shuffle(lines):
    latest = keyed.latest_by(lines.drop("pad"), ["k"], ["v"])
    text = plan(latest)
    final = text.split("== Initial Plan ==")[0]
    # Two aggregates around one exchange.
    assert final.count("Exchange hashpartitioning") == 1
    assert "partial_max" in final
    assert rows(latest.where("k = 0")) == [(0, 59_998)]


def test_sales_are_summed_before_they_meet_a_dimension(spark, lines):
    links = spark.range(60_000).selectExpr("id as film_id", "id % 3 as category_id")
    category = spark.range(3).selectExpr("id as category_id", "concat('c', id) as name")
    sales = lines.selectExpr("k as film_id", "cast(v as decimal(18,2)) as amount")
    report = rental_reports.sales_by_category(sales, links, category)
    plan = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    start = next(i for i, line in enumerate(plan) if "Aggregate [film_id" in line)
    below = itertools.takewhile(lambda i: depth[i] > depth[start], range(start + 1, len(plan)))
    # Nothing is joined yet where the sales are summed.
    assert not any("Join" in plan[i] for i in below)
    total = lines.agg(F.sum("v")).first()[0]
    assert int(report.agg(F.sum("total_sales")).first()[0]) == total
