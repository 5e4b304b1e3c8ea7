"""The event star: songs, artists, users, time and songplays out of raw songs and activity logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.functions import calendar
from lakestar.operators.joins import first_match
from lakestar.operators.keyed import first_by, latest_by
from lakestar.operators.ordering import add_row_numbers
from lakestar.sinks.files import write_parquet
from lakestar.sources.events import user_id, with_user_id

PLAY = "NextSong"


def songs_dim(songs: DataFrame) -> DataFrame:
    """One row per song id."""
    return first_by(songs.select("song_id", "title", "artist_id", "year", "duration"), ["song_id"])


def songs_by_content(songs: DataFrame) -> DataFrame:
    """One row per distinct song content, numbered by title; ignores the source's song ids."""
    columns = ["title", "artist_id", "year", "duration"]
    return add_row_numbers(songs.select(*columns).distinct(), columns, "song_id", ties=[])


def artists_variants(songs: DataFrame) -> DataFrame:
    """Distinct artist rows; an artist with two locations has two rows."""
    return songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    ).distinct()


def artists_dim(songs: DataFrame) -> DataFrame:
    """One row per artist id."""
    return first_by(artists_variants(songs), ["artist_id"])


def plays(log: DataFrame, action: str = PLAY) -> DataFrame:
    """Log rows of one action, with `start_time`."""
    kept = log.where(F.col("page") == action)
    return kept.withColumn("start_time", calendar.from_epoch_millis(F.col("ts")))


def users_dim(log: DataFrame, action: str = PLAY) -> DataFrame:
    """One row per user, with the attributes and level of the latest event."""
    events = with_user_id(log.where(F.col("page") == action)).select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
        "sessionId",
        "itemInSession",
    )
    latest = latest_by(events, ["user_id"], ["ts", "sessionId", "itemInSession"])
    return latest.select("user_id", "first_name", "last_name", "gender", "level")


def time_dim(events: DataFrame, column: str = "start_time") -> DataFrame:
    """One row per distinct time, with its parts. Filter the events first to count plays only."""
    times = events.select(F.col(column).alias("start_time")).distinct()
    return times.select("start_time", *calendar.time_parts(F.col("start_time")))


def song_lookup(songs_raw: DataFrame) -> DataFrame:
    """Song ids and artist ids by title, artist name and duration.

    The name is the one on the song's own row: an artist may appear under several.
    """
    return songs_raw.select(
        F.col("title").alias("song"),
        F.col("artist_name").alias("artist"),
        F.col("duration").alias("length"),
        "song_id",
        "artist_id",
    )


def songplays(
    log: DataFrame,
    songs_raw: DataFrame,
    match: str = "left",
    use_duration: bool = False,
    start: int = 1,
    row_key: str | None = None,
) -> DataFrame:
    """The play fact. Each play meets at most one song, by title and artist (and duration).

    `match="inner"` drops plays without a song. Keys are numbered by start time, then by the other
    columns in their order. `row_key` is a column of `log` that differs from row to row, such as
    `source_row`: with it plays move once to get their number; without it equal plays are counted first.
    """
    on = ["song", "artist", "length"] if use_duration else ["song", "artist"]
    ids = ["song_id", "artist_id"]
    matched = first_match(plays(log), song_lookup(songs_raw), on, ids, how=match)
    fact = matched.select(
        "start_time",
        user_id("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *([row_key] if row_key else []),
    )
    if row_key is None:
        return add_row_numbers(fact, ["start_time"], "songplay_id", start)
    ties = [c for c in fact.columns if c != "start_time"]
    return add_row_numbers(fact, ["start_time"], "songplay_id", start, ties).drop(row_key)


def build_event_star(
    songs_raw: DataFrame,
    log: DataFrame,
    match: str = "left",
    use_duration: bool = False,
    time_of_plays_only: bool = True,
) -> dict[str, DataFrame]:
    """All five tables, dimensions first. Hand in frames that are cheap to read several times."""
    songs = songs_dim(songs_raw)
    artists = artists_dim(songs_raw)
    timed = log.withColumn("start_time", calendar.from_epoch_millis(F.col("ts")))
    if time_of_plays_only:
        timed = timed.where(F.col("page") == PLAY)
    return {
        "songs": songs,
        "artists": artists,
        "users": users_dim(log),
        "time": time_dim(timed),
        "songplays": songplays(log, songs_raw, match, use_duration),
    }


# Folder columns per table. Songs go by year only: a folder per artist would make more folders
# than songs justify.
LAYOUT = {
    "songs": ["year"],
    "artists": [],
    "users": [],
    "time": ["year", "month"],
    "songplays": ["year", "month"],
}


def write_event_star(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Every table as Parquet under `root`, in the layout above."""
    for name, df in tables.items():
        if name == "songplays":
            df = df.withColumn("year", F.year("start_time")).withColumn(
                "month", F.month("start_time")
            )
        write_parquet(df, f"{root}/{name}", LAYOUT[name], mode)
