import glob

import pytest

from lakestar import schemas
from lakestar.sinks import files, tables
from tests.conftest import rows


@pytest.fixture
def plays(spark):
    data = [(s, i, f"song{i}", s % 2) for s in range(6) for i in range(4)]
    return spark.createDataFrame(data, "session int, item int, song string, half int")


def test_parquet_modes_and_partitions(spark, plays, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(plays, path, ["half"])
    assert sorted(p.split("/")[-1] for p in glob.glob(path + "/half=*")) == ["half=0", "half=1"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_parquet(plays, path, ["half"])
    one = plays.where("half = 1").limit(1)
    files.write_parquet(one, path, ["half"], mode="overwrite", keep_other_partitions=True)
    back = spark.read.parquet(path)
    assert back.where("half = 0").count() == 12 and back.where("half = 1").count() == 1
    files.write_parquet(one, path, ["half"], mode="overwrite")
    assert spark.read.parquet(path).count() == 1


def test_csv_quoting(spark, plays, tmp_path):
    path = str(tmp_path / "c")
    files.write_csv(plays.where("session = 1").coalesce(1), path, quote_all=True)
    text = open(glob.glob(path + "/part-*.csv")[0]).read().splitlines()
    assert text[0] == '"session","item","song","half"' and text[1].startswith('"1","0","song0"')
    files.write_csv(plays, path)
    assert spark.read.csv(path, header=True).count() == 24


def test_create_append_and_drop(spark, plays):
    tables.drop_table(spark, "users_t")
    tables.create_table(spark, "users_t", schemas.USERS)
    tables.create_table(spark, "users_t", schemas.USERS)
    # Columns come in another order and one is missing.
    columns = "level string, user_id int, first_name string"
    new = spark.createDataFrame([("paid", 7, "Ann")], columns)
    tables.append_by_name(new, "users_t")
    tables.append_by_name(new, "users_t")
    assert rows(spark.table("users_t")) == [(7, "Ann", None, None, "paid")] * 2
    with pytest.raises(ValueError, match="surname"):
        tables.append_by_name(new.withColumnRenamed("first_name", "surname"), "users_t")
    tables.recreate_tables(spark, {"users_t": schemas.USERS})
    assert spark.table("users_t").count() == 0
    tables.drop_table(spark, "users_t")
    assert not spark.catalog.tableExists("users_t")


def test_types_and_introspection(spark, plays):
    changed = tables.change_type(plays, "session", "string")
    assert rows(tables.columns_of(changed)) == [
        ("half", "int"), ("item", "int"), ("session", "string"), ("song", "string"),
    ]


def test_query_first_layout(spark, plays, tmp_path):
    path = str(tmp_path / "by_session")
    tables.write_for_query(plays, path, ["session"], ["item"])
    stored = spark.read.parquet(path)
    found = tables.lookup(stored, {"session": 3}, ["item"]).select("item", "song")
    assert [tuple(r) for r in found.collect()] == [(i, f"song{i}") for i in range(4)]
    assert tables.lookup(stored, {"song": "song2"}).count() == 6
    pushed = "PushedFilters: [IsNotNull(session), EqualTo(session,3)]"
    assert pushed in found._jdf.queryExecution().toString()


def test_bucketed_join_has_no_shuffle(spark, plays, settings):
    settings(spark__sql__autoBroadcastJoinThreshold=-1)
    from lakestar.operators.joins import colocated_join

    names = plays.select("session").distinct().selectExpr("session", "concat('s', session) name")
    fact, dim = tables.save_colocated(plays, names, ("plays_b", "names_b"), "session", 4)
    joined = colocated_join(fact, dim, "session")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    expected = rows(plays.join(names, "session"))
    assert rows(joined) == expected
    assert rows(colocated_join(fact, dim.where("session > 3"), "session", "left_semi")) == rows(plays.where("session > 3"))
    tables.save_sorted(plays, "plays_s", ["item"])
    assert spark.table("plays_s").count() == 24
    for name in ("plays_b", "names_b", "plays_s"):
        tables.drop_table(spark, name)


def test_snapshots(spark, plays, tmp_path):
    root = str(tmp_path / "snap")
    assert files.read_snapshot(spark, root, plays.schema) is None
    files.write_snapshot(plays.limit(1), root, 0)
    files.write_snapshot(plays, root, 1)
    files.write_snapshot(plays, root, 1)
    assert files.read_snapshot(spark, root, plays.schema).count() == 24
    assert files.read_snapshot(spark, root, plays.schema, before=1).count() == 1
    # An unfinished write is not read.
    plays.write.parquet(f"{root}/snapshot=2")
    import os

    os.remove(f"{root}/snapshot=2/_SUCCESS")
    assert files.read_snapshot(spark, root, plays.schema).count() == 24
