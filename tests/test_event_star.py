from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.operators import event_star as es
from tests.conftest import rows

T0 = 1541903636000  # a Sunday, 2018-11-11 02:33:56 UTC


def song(song_id, title, artist_id, name, duration, year=0, location=""):
    return (1, artist_id, None, None, location, name, song_id, title, Decimal(duration), year)


def event(user, ts, page="NextSong", level="free", title=None, artist=None, length=None,
          first="Ann", item=0):
    size = None if length is None else Decimal(length)
    return (artist, "Logged In", first, "F", item, "Lee", size, level, "X", "PUT", page, 1.0, 9,
            title, 200, ts, "agent", user)


@pytest.fixture
def songs(spark):
    data = [
        song("S1", "Setanta", "A1", "Elena", "269.58300"),
        song("S2", "Setanta", "A1", "Elena", "300.00000", 2005, "Dubai"),
        song("S2", "Setanta", "A1", "Elena", "300.00000", 2005, "Dubai"),
        song("S3", "Other", "A2", "Line", "100.00000"),
    ]
    return spark.createDataFrame(data, schemas.SONGS_RAW)


@pytest.fixture
def log(spark):
    data = [
        event("7", T0, title="Setanta", artist="Elena", length="300.00000"),
        event("7", T0 + 1000, level="paid", title="Setanta", artist="Elena", length="269.58300"),
        event("7", T0 + 2000, level="free", title="Unknown", artist="Elena", first="Anne"),
        event("8", T0, title=None, artist=None, item=1),
        event("8", T0, title=None, artist=None, item=1, level="paid"),
        event("8", T0 + 5000, page="Home", level="gold"),
        event("", T0 + 9000, title="Setanta", artist="Nobody"),
    ]
    return spark.createDataFrame(data, schemas.LOG_RAW)


def test_one_row_per_song_and_artist(songs):
    assert rows(es.songs_dim(songs), "song_id", "year") == [("S1", 0), ("S2", 2005), ("S3", 0)]
    assert rows(es.artists_dim(songs), "artist_id", "name") == [("A1", "Elena"), ("A2", "Line")]
    # The two locations of artist A1 stay apart in the variants.
    assert es.artists_variants(songs).count() == 3
    assert rows(es.songs_by_content(songs), "song_id", "title", "duration") == [
        (1, "Other", Decimal("100.00000")),
        (2, "Setanta", Decimal("269.58300")),
        (3, "Setanta", Decimal("300.00000")),
    ]


def test_users_have_their_latest_level_and_name(log):
    users = es.users_dim(log)
    assert users.schema.names == schemas.USERS.names
    assert rows(users) == [(7, "Anne", "Lee", "F", "free"), (8, "Ann", "Lee", "F", "paid")]


def test_time_of_plays_or_of_all_events(songs, log):
    star = es.build_event_star(songs, log)
    assert star["time"].count() == 4
    assert es.build_event_star(songs, log, time_of_plays_only=False)["time"].count() == 5
    first = star["time"].orderBy("start_time").first()
    assert (first.hour, first.day, first.week, first.month, first.year, first.weekday) == (
        2, 11, 45, 11, 2018, 6,
    )


def test_songplays_match_at_most_one_song(songs, log):
    star = es.build_event_star(songs, log)
    fact = star["songplays"]
    assert fact.schema.names == schemas.SONGPLAYS.names
    assert rows(fact.select("songplay_id")) == [(i,) for i in range(1, 7)]
    # By title and artist both songs match; the smaller id is taken.
    assert rows(fact.where("song_id is not null"), "user_id", "song_id") == [(7, "S1"), (7, "S1")]
    by_length = es.build_event_star(songs, log, use_duration=True)["songplays"]
    assert rows(by_length.where("song_id is not null"), "user_id", "song_id") == [
        (7, "S1"),
        (7, "S2"),
    ]
    inner = es.build_event_star(songs, log, match="inner")["songplays"]
    assert inner.count() == 2
    assert rows(fact.where("user_id is null"), "song_id") == [(None,)]


def test_star_is_written_and_read_back(spark, songs, log, tmp_path):
    star = es.build_event_star(songs, log)
    es.write_event_star(star, str(tmp_path))
    es.write_event_star(star, str(tmp_path))
    for name, df in star.items():
        back = spark.read.parquet(f"{tmp_path}/{name}").select(*df.columns)
        assert rows(back) == rows(df)
    plays = spark.read.parquet(f"{tmp_path}/songplays")
    assert rows(plays.select("year", "month").distinct()) == [(2018, 11)]


def test_unsorted_log_gives_the_same_star(songs, log):
    a = es.build_event_star(songs, log)
    b = es.build_event_star(songs, log.orderBy(F.rand(3)))
    for name in a:
        assert rows(a[name]) == rows(b[name])


def test_an_artist_matches_under_each_of_two_names(spark, log):
    data = [
        song("S1", "Setanta", "A1", "Elena", "269.58300"),
        song("S9", "Duet", "A1", "Elena with Bo", "10.00000"),
    ]
    songs = spark.createDataFrame(data, schemas.SONGS_RAW)
    plays = spark.createDataFrame(
        [
            event("1", T0, title="Setanta", artist="Elena", length="269.58300"),
            event("1", T0 + 1, title="Duet", artist="Elena with Bo", length="10.00000"),
        ],
        schemas.LOG_RAW,
    )
    for match in ("left", "inner"):
        fact = es.songplays(plays, songs, match, use_duration=True)
        assert rows(fact, "song_id", "artist_id") == [("S1", "A1"), ("S9", "A1")]


def test_large_ids_stay_and_broken_ids_are_errors(spark):
    large = spark.createDataFrame([event("9000000000", T0), event(" ", T0)], schemas.LOG_RAW)
    assert rows(es.users_dim(large), "user_id") == [(9000000000,)]
    broken = spark.createDataFrame([event("12x", T0)], schemas.LOG_RAW)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        es.users_dim(broken).collect()


def test_a_broken_line_is_an_error(spark, tmp_path):
    from lakestar.sources.files import read_json

    (tmp_path / "a.json").write_text('{"page": "NextSong"}\n{"page": "Next\n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_json(spark, str(tmp_path), schemas.LOG_RAW).collect()
