"""One table per question: copies of the song events laid out for their lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.keyed import latest_by
from lakestar.sinks.tables import lookup, write_for_query


@dataclass(frozen=True)
class QueryTable:
    """Source columns by name, the columns a lookup gives, and the order inside one lookup."""

    columns: dict[str, str]
    partition: tuple[str, ...]
    clustering: tuple[str, ...]

    def rows(self, events: DataFrame) -> DataFrame:
        """One row per full key. Of several writes to a key one stays."""
        picked = events.select(*(F.col(old).alias(new) for old, new in self.columns.items()))
        return latest_by(picked, [*self.partition, *self.clustering], [])


SONG = {"artist": "artist", "song": "song"}
USER = {"firstName": "first_name", "lastName": "last_name"}

QUERY_TABLES = {
    # What was played as a given item of a given session.
    "by_session": QueryTable(
        {"sessionId": "session_id", "itemInSession": "item", **SONG, "length": "length"},
        ("session_id",),
        ("item",),
    ),
    # What a user heard in a session, in the order of the items.
    "by_user_session": QueryTable(
        {"userId": "user_id", "sessionId": "session_id", "itemInSession": "item", **SONG, **USER},
        ("user_id", "session_id"),
        ("item",),
    ),
    # Who has listened to a song.
    "by_song": QueryTable(
        {"song": "song", "userId": "user_id", **USER}, ("song",), ("user_id",)
    ),
}


def write_query_tables(events: DataFrame, root: str) -> None:
    """All query tables from the consolidated events."""
    for name, spec in QUERY_TABLES.items():
        write_for_query(spec.rows(events), f"{root}/{name}", spec.partition, spec.clustering)


def ask(spark: SparkSession, root: str, name: str, **key: object) -> DataFrame:
    """Rows of one key in clustering order."""
    return lookup(spark.read.parquet(f"{root}/{name}"), key, QUERY_TABLES[name].clustering)
