"""Daily log files as a stream, keeping a table of each user's latest level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lakestar import schemas
from lakestar.operators.keyed import latest_by
from lakestar.sinks.ranged import expire, manifest, merge_ranged, read_ranged, write_ranged
from lakestar.sources.events import with_user_id

ORDER = ["ts", "sessionId", "itemInSession"]
#: Ranges of users that are written again as one, and versions kept for readers that are still running.
RANGES, VERSIONS = 256, 3


def level_rows(log: DataFrame, action: str = "NextSong") -> DataFrame:
    """Per log row what the level table keeps, including the order columns."""
    return with_user_id(log.where(F.col("page") == action)).select(*schemas.LEVELS.names)


def apply_batch(spark: SparkSession, batch: DataFrame, number: int, root: str) -> None:
    """Merges a batch of log rows into the user table; only ranges of users that it touches are written again.

    The order columns are part of the table, so a late file cannot bring back an older level. The table
    knows its last batch: one that is run again changes nothing.
    """
    rows = latest_by(level_rows(batch), ["userId"], ORDER)
    known = manifest(spark, root)
    if known is None:
        write_ranged(rows, root, ["userId"], RANGES, number)
    elif known["batch"] < number:
        newer = lambda old, new: latest_by(old.unionByName(new), ["userId"], ORDER)
        merge_ranged(spark, root, rows, newer, number)
        expire(spark, root, VERSIONS)


def follow_logs(
    spark: SparkSession, source: str, root: str, checkpoint: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Processes all log files present under `source` and not seen before, then stops."""
    stream = (
        spark.readStream.option("mode", "FAILFAST").schema(schemas.LOG_RAW)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .json(source)
    )
    return (
        stream.writeStream.foreachBatch(
            lambda batch, number: apply_batch(batch.sparkSession, batch, number, root)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_levels(spark: SparkSession, root: str) -> DataFrame | None:
    """The user table after the newest batch."""
    state = read_ranged(spark, root)
    return None if state is None else state.drop(*ORDER)
