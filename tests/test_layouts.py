"""Tables laid out for joins, filters and small writes; paged texts; samples; keys that stay."""

import glob
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakestar.functions.text import group_concat, paged_concat
from lakestar.operators import audit, keyed, keys, samples
from lakestar.operators.joins import SHARE, colocated_join
from lakestar.session import statistics_session
from lakestar.sinks import ranged, tables
from tests.conftest import rows


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- tables for joins --------------------------------------------------------------------------


def test_hot_key_of_a_colocated_pair_fills_several_tasks(spark, tmp_path):
    key = F.when(F.col("id") % 10 < 3, 7).when(F.col("id") % 10 == 9, None).otherwise(F.col("id") % 1000)
    fact = spark.range(20_000).select(key.alias("k"), F.col("id").alias("v"))
    dimension = spark.range(1000).selectExpr("id as k", "concat('n', id) as name")
    pair = tables.save_colocated(fact, dimension, ("fact_hot", "dim_hot"), "k", 16, str(tmp_path))
    joined = colocated_join(*pair, "k")
    plan = executed(joined.groupBy("name").agg(F.sum("v")))
    below = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below
    assert rows(joined.select("k", "v", "name")) == rows(fact.join(dimension, "k").select("k", "v", "name"))
    hot = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 3 and max(r[1] for r in hot) < 4000
    # Other keys are in the dimension once.
    assert pair[1].groupBy("k").count().where("count > 1").count() == 1
    assert pair[1].agg(F.max(SHARE)).first()[0] == 4
    for name in ("fact_hot", "dim_hot"):
        tables.drop_table(spark, name)


def test_colocated_pair_of_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, v long")
    pair = tables.save_colocated(empty, empty.select("k"), ("fact_e", "dim_e"), "k", 4, str(tmp_path))
    assert colocated_join(*pair, "k").count() == 0
    for name in ("fact_e", "dim_e"):
        tables.drop_table(spark, name)


# --- tables for filters ------------------------------------------------------------------------


@pytest.fixture
def sales(spark):
    """Days and shops without relation to each other; one day has 30 % of the rows."""
    day = F.when(F.col("id") % 10 < 3, 50).otherwise(F.pmod(F.xxhash64("id"), F.lit(365)))
    shop = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(400))
    return spark.range(0, 64_000, 1, 4).select(day.cast("int").alias("day"), shop.cast("int").alias("shop"), "id")


def files_with(folder, condition):
    """How many files hold a value range that a condition on (day, shop) may meet."""
    import pyarrow.parquet as pq

    hit = 0
    files = glob.glob(f"{folder}/*.parquet")
    for file in files:
        ends = pq.read_table(file, columns=["day", "shop"])
        low, high = ({c: f(ends[c].to_pylist()) for c in ("day", "shop")} for f in (min, max))
        hit += condition(low, high)
    return hit, len(files)


def test_interleaved_files_are_skipped_on_each_column(spark, sales, tmp_path):
    tables.save_interleaved(sales, "sales_z", ["day", "shop"], ["id"], 64, str(tmp_path))
    tables.save_sorted(sales, "sales_d", ["day", "shop"], path=str(tmp_path))
    assert rows(spark.table("sales_z")) == rows(sales)
    by_shop, total = files_with(tmp_path / "sales_z", lambda a, b: a["shop"] <= 17 <= b["shop"])
    by_day, _ = files_with(tmp_path / "sales_z", lambda a, b: a["day"] <= 200 <= b["day"])
    both, _ = files_with(tmp_path / "sales_z", lambda a, b: a["shop"] <= 17 <= b["shop"] and a["day"] <= 200 <= b["day"])
    assert total > 40 and by_shop < total / 3 and by_day < total / 3 and both <= 4
    # Sorted by day alone, a shop is nearly everywhere.
    plain, plain_total = files_with(tmp_path / "sales_d", lambda a, b: a["shop"] <= 17 <= b["shop"])
    assert plain > plain_total / 2
    for name in ("sales_z", "sales_d"):
        tables.drop_table(spark, name)


def test_hot_value_fills_several_files(spark, sales, tmp_path, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    tables.save_sorted(sales, "sales_s", ["day"], ["id"], str(tmp_path))
    hot, total = files_with(tmp_path / "sales_s", lambda a, b: a["day"] <= 50 <= b["day"])
    assert total > 2 and hot >= 2
    tables.save_interleaved(sales, "sales_h", ["day", "shop"], ["id"], 32, str(tmp_path))
    assert files_with(tmp_path / "sales_h", lambda a, b: a["day"] <= 50 <= b["day"])[0] > 5
    with pytest.raises(ValueError, match="seven"):
        tables.save_interleaved(sales, "sales_h", [], ["id"], 32)
    for name in ("sales_s", "sales_h"):
        tables.drop_table(spark, name)


# --- tables for small writes -------------------------------------------------------------------


@pytest.fixture
def users(spark):
    return spark.range(0, 2000).selectExpr("id as user", "concat('u', id) as name", "0 as level", "id % 3 as half")


def levels(old, new):
    return keyed.upsert(old, new, ["user"], ["level"], ["level"])


def test_small_write_replaces_the_ranges_it_touches(spark, users, tmp_path):
    root = str(tmp_path / "t")
    assert ranged.read_ranged(spark, root) is None
    ranged.write_ranged(users, root, ["user"], 10)
    with pytest.raises(RuntimeError, match="holds a table"):
        ranged.write_ranged(users, root, ["user"], 10)
    assert rows(ranged.read_ranged(spark, root)) == rows(users)
    before = ranged.manifest(spark, root)
    assert len(before["writes"]) == 10
    some = spark.range(100, 120).selectExpr("id as user", "'x' as name", "5 as level", "id % 3 as half")
    touched = ranged.merge_ranged(spark, root, some, levels, batch=1)
    after = ranged.manifest(spark, root)
    changed = {int(r) for r in after["writes"] if after["writes"][r] != before["writes"].get(r)}
    assert changed == touched and len(touched) <= 2
    expected = sorted((i, f"u{i}", 5 if 100 <= i < 120 else 0, i % 3) for i in range(2000))
    assert sorted(map(tuple, ranged.read_ranged(spark, root).collect())) == expected
    assert rows(ranged.read_ranged(spark, root, 0)) == rows(users)
    # New keys beyond both ends, and no rows at all.
    more = spark.createDataFrame([(-5, "a", 1, 0), (9999, "b", 1, 0)], "user long, name string, level int, half long")
    assert len(ranged.merge_ranged(spark, root, more, levels)) == 2
    assert ranged.merge_ranged(spark, root, more.where("false"), levels) == set()
    assert ranged.read_ranged(spark, root).count() == 2002
    assert ranged.read_ranged(spark, root).dropDuplicates(["user"]).count() == 2002


def test_killed_write_leaves_the_table_as_it_was(spark, users, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    ranged.write_ranged(users, root, ["user"], 4)
    some = users.where("user < 700").withColumn("level", F.lit(9))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(ranged, "_commit", killed)
        ranged.merge_ranged(spark, root, some, levels)
    assert rows(ranged.read_ranged(spark, root)) == rows(users)
    with pytest.raises(Exception, match="broken"):
        ranged.merge_ranged(spark, root, some, lambda old, new: new.withColumn("name", F.raise_error(F.lit("broken"))))
    assert ranged.versions(spark, root) == [0]
    ranged.merge_ranged(spark, root, some, levels)
    assert ranged.read_ranged(spark, root).where("level = 9").count() == 700
    # Another writer was first.
    content = ranged.manifest(spark, root)
    with pytest.raises(RuntimeError, match="meanwhile"):
        ranged._commit(spark, root, content)
    with pytest.raises(ValueError, match="move"):
        ranged.merge_ranged(spark, root, some, lambda old, new: new.withColumn("user", F.col("user") + 1500))


def test_old_versions_expire(spark, users, tmp_path):
    root = str(tmp_path / "t")
    ranged.write_ranged(users, root, ["user"], 4)
    for level in (1, 2, 3):
        some = users.where("user < 10").withColumn("level", F.lit(level))
        ranged.merge_ranged(spark, root, some, levels)
    ranged.expire(spark, root, 2)
    assert ranged.versions(spark, root) == [2, 3]
    assert ranged.read_ranged(spark, root, 2).where("level = 2").count() == 10
    assert ranged.read_ranged(spark, root).where("level = 3").count() == 10
    assert ranged.read_ranged(spark, root).count() == 2000
    assert len(glob.glob(f"{root}/data/write=*/range=0")) == 2


def test_ranged_table_of_two_keys_and_of_nothing(spark, tmp_path):
    schema = "a string, b int, v int"
    df = spark.createDataFrame([(a, b, 1) for a in ("x", "y", None) for b in range(200)], schema)
    ranged.write_ranged(df, str(tmp_path / "t"), ["a", "b"], 6)
    assert rows(ranged.read_ranged(spark, str(tmp_path / "t"))) == rows(df)
    empty = str(tmp_path / "e")
    ranged.write_ranged(df.where("false"), empty, ["a", "b"], 6)
    assert ranged.read_ranged(spark, empty).count() == 0
    ranged.merge_ranged(spark, empty, df, lambda old, new: keyed.insert_ignore(old, new, ["a", "b"]))
    assert ranged.read_ranged(spark, empty).count() == 600
    with pytest.raises(ValueError, match="range"):
        ranged.write_ranged(df.withColumnRenamed("v", "range"), str(tmp_path / "r"), ["a"], 2)


# --- paged texts -------------------------------------------------------------------------------


@pytest.mark.parametrize("distinct", [False, True])
def test_pages_joined_are_the_whole_text(spark, distinct):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), "w" * rng.randint(0, 12) + str(rng.randrange(40))) for _ in range(3000)]
    data += [("hot", "same")] * 2000 + [("a", None), ("null", None)]
    df = spark.createDataFrame(data, "g string, v string").repartition(5)
    paged = paged_concat(df, ["g"], "v", "t", distinct, page_chars=300)
    whole = group_concat(df.where("v is not null"), ["g"], "v", "t", distinct)
    found = {}
    for g, _, text in sorted(map(tuple, paged.collect()), key=lambda r: (str(r[0]), r[1])):
        found.setdefault(g, []).append(text)
        assert len(text) <= 300 + 15
    assert {g: ", ".join(pages) for g, pages in found.items()} == dict(map(tuple, whole.collect()))
    assert (len(found["hot"]) > 30) != distinct


# --- counts from footers -----------------------------------------------------------------------


def test_nulls_are_counted_from_footers(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, None, [1.0]), (None, "b", None), (3, "c", []), (4, None, [None])], "a int, b string, c array<double>"
    )
    df.repartition(2).write.parquet(str(tmp_path / "t"))
    found = audit.null_audit({"t": statistics_session(spark).read.parquet(str(tmp_path / "t"))})
    assert rows(found, "column_name", "num_nulls") == [("a", 1), ("b", 2), ("c", 1)]
    plan = executed(found)
    assert "PushedAggregation: [COUNT(*), COUNT(a), COUNT(b)]" in plan
    # Any other reader gives the same counts.
    assert rows(audit.null_audit({"t": df})) == rows(found)


def test_null_audit_of_the_given_tables_reads_no_long_column(spark):
    from lakestar.plans import QUERIES

    plan = executed(QUERIES["null_audit"](spark, "/root/testdata/sf0.001"))
    scans = [line for line in plan.splitlines() if "PushedAggregation: [COUNT" in line]
    assert len(scans) == 14
    for column in ("text", "html"):
        assert any(f"COUNT({column})" in line for line in scans)
    assert "ReadSchema: struct<text" not in plan and "ReadSchema: struct<html" not in plan


# --- samples and keys --------------------------------------------------------------------------


def test_samples_are_whole_rows_and_always_the_same(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "id % 4 as g", "concat('x', id) as t")
    first = rows(samples.sample_rows(df, ["id"], 10))
    assert first == rows(samples.sample_rows(df.repartition(3), ["id"], 10)) and len(first) == 10
    assert rows(samples.sample_rows(df, ["id"], 10, seed=1)) != first
    assert all(t == f"x{i}" for i, _, t in first)
    grouped = rows(samples.sample_by(df.where("g < 3 or id < 6"), ["g"], ["id"], 5))
    assert [len(list(v)) for _, v in itertools.groupby(sorted(r[1] for r in grouped))] == [5, 5, 5, 1]
    assert samples.sample_rows(df.where("false"), ["id"], 10).count() == 0
    # Tasks keep their share before anything is shuffled.
    assert "TakeOrderedAndProject" in executed(samples.sample_rows(df, ["id"], 10))
    assert "WindowGroupLimit" in executed(samples.sample_by(df, ["g"], ["id"], 5))


def test_known_values_keep_their_keys(spark, tmp_path):
    def values(*found):
        return spark.createDataFrame(found, "city string, zone int")

    first = keys.store_keys(spark, values(("b", 1), ("d", None), ("b", 1), (None, None)), ["city", "zone"], "k", str(tmp_path), 0)
    assert rows(first) == [(1, "b", 1), (2, "d", None)]
    grown = values(("a", 1), ("c", 2), ("d", None), (None, 7))
    expected = [(1, "b", 1), (2, "d", None), (3, None, 7), (4, "a", 1), (5, "c", 2)]
    assert rows(keys.store_keys(spark, grown, ["city", "zone"], "k", str(tmp_path), 1)) == expected
    # The same run once more, after a failure, say.
    second = keys.store_keys(spark, grown, ["city", "zone"], "k", str(tmp_path), 1)
    assert rows(second) == expected
    keyed_rows = keys.replace_by_key(grown.unionByName(values((None, None))), second, ["city", "zone"], "k")
    assert rows(keyed_rows) == [(2,), (3,), (4,), (5,), (None,)]
    assert keys.extend_keys(values(("b", 1)), ["city", "zone"], "k", second.where("false")).count() == 1


def test_key_map_runs_no_job_before_an_action(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    spark.sparkContext.setJobGroup("keys", "keys")
    grown = keys.extend_keys(df, ["v"], "k", keys.extend_keys(df.limit(1), ["v"], "k"))
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("keys")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == [] and grown.count() == 2
