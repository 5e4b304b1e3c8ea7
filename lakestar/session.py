"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join whose output is grouped by the join key is still split on a hot key,
    # at the price of one more shuffle for that join only.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Checkpoints of frames that are no longer in use are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def partitions_for(input_bytes: int, per_partition: int = 200 << 20) -> int:
    """Shuffle partitions so that one holds about 200 MB if everything is shuffled.

    Adaptive execution merges what turns out smaller, but cannot raise the number.
    """
    return max(200, -(-input_bytes // per_partition))


def listed_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder, from their listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg({"length": "sum"}).first()[0] or 0


def build_session(
    name: str = "lakestar",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the library's settings. On a cluster leave `master` to spark-submit.

    Further settings are keywords with two underscores for a dot.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark` whose Parquet reader answers counts, smallest and largest values from the files'
    footers, where a whole table is asked for them."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names, or a scratch one in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="lakestar-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder as Parquet and read again, so that several tables built
    from it parse the source once and read only the columns that they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
