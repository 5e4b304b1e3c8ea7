"""Normal forms, cubes, activity, audits, text and SQL functions on literal rows."""

from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lakestar.functions import calendar, text
from lakestar.functions.sql import register_sql_functions
from lakestar.operators import activity, audit, normalize, olap
from lakestar.operators import star_benchmark as ssb
from tests.conftest import rows

ALBUMS = [
    (1, "Copper Kettle", "Ada North", 2003, ["Morning Rails", "Salt And Slate", "Paper Harbour"]),
    (2, "Low Tide", "Ada North", 2007, ["Low Tide", "Lanterns"]),
    (3, "Empty", "Nobody", 2011, []),
]


@pytest.fixture
def library(spark):
    return spark.createDataFrame(
        ALBUMS, "album_id int, album string, artist string, year int, songs array<string>"
    )


def test_three_normal_forms_and_back(library):
    first = normalize.list_to_rows(library, "songs", "song")
    assert first.count() == 5
    parent, child = normalize.split_parent_child(
        first, "album_id", ["album", "artist", "year"], "song_id"
    )
    assert parent.count() == 2 and rows(child, "song_id") == [(i,) for i in range(1, 6)]
    third, artists = normalize.extract_dimension(parent, ["artist"], "artist_id")
    assert rows(artists) == [(1, "Ada North")] and "artist" not in third.columns
    back = normalize.denormalize(child, [(third, "album_id"), (artists, "artist_id")])
    assert normalize.same_rows(back.select(*first.columns), first)
    assert not normalize.same_rows(back.select(*first.columns), first.limit(4))
    assert not normalize.same_rows(first, first.unionByName(first.limit(1)))


def test_null_attribute_survives_extraction(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "id int, a string, b string")
    narrow, dimension = normalize.extract_dimension(df, ["a", "b"], "key")
    assert rows(narrow) == [(1, 1), (2, None)]
    assert normalize.same_rows(
        normalize.denormalize(narrow, [(dimension, "key")]).select("id", "a", "b"), df
    )


def test_sums_per_album(spark):
    lengths = [(1, 100), (1, 90), (2, 75), (2, 60)]
    df = spark.createDataFrame(lengths, "album_id int, length int")
    assert rows(olap.revenue_by(df, ["album_id"], "length", name="total")) == [(1, 190), (2, 135)]


@pytest.fixture
def sales(spark):
    data = [(1, "A", D("1.10")), (1, "B", D("2.20")), (2, "A", D("3.30")), (2, None, D("4.40"))]
    return spark.createDataFrame(data, "month int, country string, sales_amount decimal(5,2)")


def test_cube_forms_agree(sales):
    cube = olap.cube(sales, ["month", "country"])
    sets = olap.grouping_sets(
        sales, [[], ["month"], ["country"], ["month", "country"]], ["month", "country"]
    )
    union = olap.cube_by_union(sales, "month", "country")
    assert rows(cube) == rows(sets)
    as_text = cube.select(F.col("month").cast("string").alias("month"), "country", "revenue")
    assert rows(union) == rows(as_text)
    # The grouping id tells the grand total from the row of the unknown country.
    assert rows(cube.where("month is null and country is null"), "revenue", "grouping_id") == [
        (D("11.00"), 3),
        (D("4.40"), 2),
    ]


def test_slice_dice_top(sales):
    assert rows(olap.revenue_by(sales, ["country"], where={"month": [1]})) == [
        ("A", D("1.10")),
        ("B", D("2.20")),
    ]
    top = olap.revenue_by(sales, ["month"], top=1)
    assert rows(top) == [(2, D("7.70"))]


def test_star_join_and_average(spark, sales):
    months = spark.createDataFrame([(1, "Jan"), (2, "Feb")], "m int, name string")
    joined = olap.star(sales, [(months, "month", "m")])
    assert rows(olap.average_by(joined, "name", "sales_amount", "avg", top=1)) == [
        ("Feb", D("3.85"))
    ]


def test_benchmark_on_integer_days(spark):
    data = [(19970101, D("0.02"), 5, D("100.00")), (19980101, D("0.02"), 5, D("100.00"))]
    columns = "lo_orderdate int, lo_discount decimal(4,2), lo_quantity int"
    orders = spark.createDataFrame(data, f"{columns}, lo_extendedprice decimal(8,2)")
    dated = ssb.with_order_date(orders)
    assert rows(ssb.one_dim(dated, 1997, D("0.01"), D("0.03"), 24)) == [(D("2.0000"),)]


# --- activity ----------------------------------------------------------------------------------


@pytest.fixture
def events(spark):
    pages = ["NextSong", "Home", "NextSong", "NextSong", "Home", "NextSong", "Other"]
    data = [(1, i, p, "A" if i < 4 else "B") for i, p in enumerate(pages)]
    data += [(2, 0, "NextSong", "A"), (2, 0, "Home", None)]
    return spark.createDataFrame(data, "user int, ts int, page string, artist string")


def test_phases_and_average_between(events):
    home, song = F.col("page") == "Home", F.col("page") == "NextSong"
    phases = activity.with_phase(events.where("user = 1"), "user", ["-ts"], home)
    assert rows(phases, "ts", "phase") == [(0, 2), (1, 2), (2, 1), (3, 1), (4, 1), (5, 0), (6, 0)]
    # User 1: 1, 2 and 1 songs. User 2: 1 song.
    mean = activity.average_between(events, "user", ["-ts", "page"], home, song, "songs")
    assert rows(mean) == [(1.25,)]


def test_peers_share_a_phase(events):
    home = F.col("page") == "Home"
    phases = activity.with_phase(events.where("user = 2"), "user", ["-ts"], home, peers=True)
    assert rows(phases, "page", "phase") == [("Home", 1), ("NextSong", 1)]


def test_counts(events):
    assert rows(activity.top_value(events, "artist")) == [("A", 5)]
    assert rows(activity.count_users(events, "user")) == [(2,)]
    assert rows(activity.never_seen(events, events.where("user = 2"), ["page"])) == [("Other",)]
    changers = activity.level_changers(events.dropna(), "user", "artist")
    assert rows(changers) == [(1, 2)]


# --- audits ------------------------------------------------------------------------------------


def test_audits(spark):
    parent = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "id int, name string")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "pid int")
    assert rows(audit.key_audit({"p": (parent, "id")})) == [("p", 3, 2)]
    assert rows(audit.row_counts({"p": parent, "c": child})) == [("c", 4), ("p", 3)]
    assert rows(audit.null_audit({"p": parent, "c": child})) == [
        ("c", "pid", 1),
        ("p", "id", 0),
        ("p", "name", 1),
    ]
    assert rows(audit.reference_audit({"link": (child, "pid", parent, "id")})) == [("link", 2)]
    name = F.col("name")
    rules = {"small": F.col("id") < 2, "named": name.isNotNull(), "x": name == "x"}
    # An unknown comparison passes, as in a CHECK constraint.
    assert rows(audit.domain_audit(parent, rules)) == [("named", 1), ("small", 2), ("x", 1)]
    assert rows(audit.range_audit(parent, ["id"])) == [("id", 1.0, 2.0)]
    found = audit.describe(parent, ["id"]).first()
    assert (found["count"], found["min"], found["max"]) == (3.0, 1.0, 2.0)
    assert round(found["mean"], 4) == 1.6667 and round(found["stddev"], 4) == 0.5774
    assert audit.matched(parent, ["id", "name"]).count() == 2


# --- functions ---------------------------------------------------------------------------------


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2018, 11, 4, 23, 5),)], "t timestamp_ntz")
    t = F.col("t")
    row = df.select(
        calendar.date_key(t).alias("key"),
        calendar.month_of_key(calendar.date_key(t)).alias("month_of"),
        *calendar.time_parts(t),
        calendar.is_weekend(t).alias("weekend"),
    ).first()
    assert tuple(row) == (20181104, 11, 23, 4, 44, 11, 2018, 6, True)


def test_text(spark):
    songs = ["Driftwood", "driftwood", "Driftwood", "All the lamps"]
    df = spark.createDataFrame([(s,) for s in songs], "song string")
    lowered = df.select(F.lower("song").alias("song"))
    assert rows(text.count_values(lowered, "song")) == [("all the lamps", 1), ("driftwood", 3)]
    assert rows(text.count_values(text.words(df, "song"), "word")) == [
        ("all", 1), ("driftwood", 3), ("lamps", 1), ("the", 1),
    ]
    plain = text.group_concat(df.withColumn("g", F.lit(1)), ["g"], "song", "s")
    assert rows(plain) == [(1, "All the lamps, Driftwood, Driftwood, driftwood")]
    once = text.group_concat(df.withColumn("g", F.lit(1)), ["g"], "song", "s", distinct=True)
    assert rows(once) == [(1, "All the lamps, Driftwood, driftwood")]
    people = spark.createDataFrame([("ANN", "LEE"), (None, "X")], "f string, l string")
    assert rows(people.select(text.full_name("f", "l"), text.capitalized("l"))) == [
        ("ANN LEE", "Lee"),
        (None, "X"),
    ]


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT event_hour(1541903636796), month_end(timestamp '2018-02-03 04:05:06'),"
        " day_key(timestamp '2018-11-05 00:00:00'), weekend(timestamp '2018-11-04 00:00:00'),"
        " concat_pair('a', null), concat_pair('a', 'b'), nice_name('SMITH')"
    ).first()
    assert [str(v) for v in row] == ["2", "2018-02-28", "20181105", "True", "a", "a, b", "Smith"]
