import random

import pytest
from pyspark.sql import functions as F

from lakestar.operators import joins, keyed
from tests.conftest import rows

SCHEMA = "user int, name string, level string, ts int"


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, "Ann", "free", 0), (2, "Bob", "paid", 0)], SCHEMA)


@pytest.fixture
def writes(spark):
    data = [
        (1, "Anna", "paid", 5),
        (1, "Anne", "free", 9),
        (3, "Cy", "free", 3),
        (3, "Cyd", "paid", 4),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_insert_ignore_keeps_the_first_write(users, writes):
    after = keyed.insert_ignore(users, writes, ["user"], ["ts"])
    assert rows(after) == [(1, "Ann", "free", 0), (2, "Bob", "paid", 0), (3, "Cy", "free", 3)]
    assert rows(keyed.insert_ignore(after, writes, ["user"], ["ts"])) == rows(after)


def test_upsert_updates_only_the_level(users, writes):
    after = keyed.upsert(users, writes, ["user"], ["level"], ["ts"])
    # User 1 went free, paid, free and ends free; user 3 is new.
    assert rows(after) == [(1, "Ann", "free", 0), (2, "Bob", "paid", 0), (3, "Cy", "paid", 3)]
    assert rows(keyed.upsert(after, writes, ["user"], ["level"], ["ts"])) == rows(after)


def test_upsert_can_write_null(users, spark):
    writes = spark.createDataFrame([(2, "Bob", None, 7)], SCHEMA)
    after = keyed.upsert(users, writes, ["user"], ["level"], ["ts"])
    assert rows(after) == [(1, "Ann", "free", 0), (2, "Bob", None, 0)]


def test_last_write_wins(spark):
    # Two albums stored under one key: the later one stays.
    data = [
        (1, "Ada North", "Low Tide", "Elm Town"),
        (2, "Ada North", "Copper Kettle", "Ash Town"),
        (3, "Bo Field", "Gravel", "Oak Town"),
    ]
    library = spark.createDataFrame(data, "seq int, artist string, album string, city string")
    last = keyed.latest_by(library, ["artist"], ["seq"]).drop("seq")
    assert rows(last) == [
        ("Ada North", "Copper Kettle", "Ash Town"),
        ("Bo Field", "Gravel", "Oak Town"),
    ]


def test_equal_order_is_settled_by_the_other_columns(spark):
    data = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z")]
    df = spark.createDataFrame(data, "k int, ts int, v string")
    for shuffled in (df, df.orderBy(F.desc("v")), df.repartition(3)):
        assert rows(keyed.latest_by(shuffled, ["k"], ["ts"])) == [(1, 5, "b")]
        assert rows(keyed.first_by(shuffled, ["k"], ["ts"])) == [(1, 4, "z")]


def test_first_match_never_multiplies(spark):
    heard = [("x", "a"), ("x", "a"), ("y", "b"), (None, "c")]
    known = [("x", "a", 2), ("x", "a", 1), (None, "c", 3)]
    plays = spark.createDataFrame(heard, "s string, a string")
    songs = spark.createDataFrame(known, "s string, a string, id int")
    found = joins.first_match(plays, songs, ["s", "a"], ["id"])
    # A missing title matches nothing.
    assert rows(found, "s", "id") == [("x", 1), ("x", 1), ("y", None), (None, None)]
    assert joins.first_match(plays, songs, ["s", "a"], ["id"], "inner").count() == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_writes_one_by_one_give_the_same_table(spark, seed):
    rng = random.Random(seed)
    users = {u: (f"n{u}", "free", 0) for u in range(0, 20, 2)}
    writes = [
        (rng.choice([3, rng.randrange(25)]), f"w{i}", rng.choice(["free", "paid", None]), i + 1)
        for i in range(200)
    ]
    updated, ignored, last = dict(users), dict(users), {}
    for user, name, level, ts in writes:
        if user in updated:
            updated[user] = (updated[user][0], level, updated[user][2])
        else:
            updated[user] = (name, level, ts)
        ignored.setdefault(user, (name, level, ts))
        last[user] = (name, level, ts)
    target = spark.createDataFrame([(u, *v) for u, v in users.items()], SCHEMA)
    source = spark.createDataFrame(writes, SCHEMA).orderBy(F.rand(seed))

    def table(state):
        return sorted(((u, *v) for u, v in state.items()), key=repr)

    assert rows(keyed.upsert(target, source, ["user"], ["level"], ["ts"])) == table(updated)
    assert rows(keyed.insert_ignore(target, source, ["user"], ["ts"])) == table(ignored)
    assert rows(keyed.latest_by(source, ["user"], ["ts"])) == table(last)
