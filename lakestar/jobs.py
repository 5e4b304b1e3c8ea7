"""Whole jobs, from raw files to finished tables. Run with `python -m lakestar.jobs`."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lakestar import schemas
from lakestar.operators.event_star import build_event_star, write_event_star
from lakestar.operators.query_tables import write_query_tables
from lakestar.session import build_session, listed_bytes, partitions_for, written
from lakestar.sinks.files import write_csv
from lakestar.sinks.tables import append_by_name, recreate_tables
from lakestar.sources.events import consolidate_event_files
from lakestar.sources.files import read_json
from lakestar.streaming.levels import follow_logs


def read_raw(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Song metadata and activity logs below `root`."""
    songs = read_json(spark, f"{root}/song_data", schemas.SONGS_RAW, recursive=True)
    log = read_json(spark, f"{root}/log_data", schemas.LOG_RAW, recursive=True)
    return songs, log


def read_once(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """`read_raw`, parsed once whatever the number of tables built from it."""
    songs, log = read_raw(spark, root)
    return written(songs, "songs"), written(log, "log")


def event_lake(spark: SparkSession, source: str, target: str) -> None:
    """Raw files to the star as partitioned Parquet. Plays without a known song are kept."""
    write_event_star(build_event_star(*read_once(spark, source)), target)


def event_warehouse(spark: SparkSession, source: str, database: str) -> None:
    """Raw files to catalog tables. Only plays of known songs; the time table has all events."""
    songs, log = read_once(spark, source)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    recreate_tables(spark, {f"{database}.{n}": s for n, s in schemas.EVENT_STAR.items()})
    star = build_event_star(songs, log, match="inner", time_of_plays_only=False)
    for name, df in star.items():
        append_by_name(df, f"{database}.{name}")


def event_queries(spark: SparkSession, source: str, target: str) -> None:
    """Daily event CSV files to one cleaned file set and the query tables."""
    events = consolidate_event_files(spark, source)
    write_csv(events, f"{target}/events", quote_all=True)
    write_query_tables(events, target)


def event_levels(spark: SparkSession, source: str, target: str) -> None:
    """New log files into the table of user levels."""
    follow_logs(spark, source, f"{target}/levels", f"{target}/progress").awaitTermination()


JOBS = {
    "event-lake": event_lake,
    "event-warehouse": event_warehouse,
    "event-queries": event_queries,
    "event-levels": event_levels,
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("source", help="folder of the raw files")
    parser.add_argument("target", help="output folder, or database for event-warehouse")
    args = parser.parse_args()
    spark = build_session(args.job)
    shuffles = partitions_for(listed_bytes(spark, args.source))
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
    JOBS[args.job](spark, args.source, args.target)


if __name__ == "__main__":
    main()
