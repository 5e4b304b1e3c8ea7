"""What several operators share: words, word hashes, and tables staged in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.session import ensure_checkpoint_dir

#: White space between words, as a Java pattern: exactly what `bytes.split()` splits on.
GAP = r"[\x20\x09-\x0D]+"

GOLDEN, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Odd factors of the words of a shingle, by their place.
FACTORS = [(pow(GOLDEN, i + 1, 1 << 64)) | 1 for i in range(64)]
#: The low bytes of a number, by how many.
LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that `spark.checkpoint.dir` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: cuts lineage, survives lost executors,
    and lets the planner know the true size."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column | str) -> Column:
    """The words of a text as an array, empty for a null or blank text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Rows in a row that hold about `limit` bytes; a larger one stands alone."""
    filled = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(sizes)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


class Words:
    """The words of several texts, found and hashed without a Python object per word.

    `data` holds the texts, a line feed after each; `start` and `end` are the places of the words in
    it, `hash` their 64-bit hashes, and `bound[i]:bound[i + 1]` are the words of text i.
    """

    #: Longer words are hashed one by one.
    LONG = 64

    def __init__(self, texts: Iterable[str | None], lower: bool = False):
        parts = [(t or "").encode() for t in texts]
        data = b"\n".join([*parts, b""])
        self.data = data.lower() if lower else data
        raw = np.frombuffer(self.data + bytes(8), np.uint8)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        blank[len(data) :] = True
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        length = self.end - self.start
        eight = np.ndarray((len(data) + 1,), "<u8", buffer=raw, strides=(1,))
        self.hash = length.astype(np.uint64) * np.uint64(GOLDEN)
        left = np.arange(len(length))
        for at in range(0, self.LONG, 8):
            more = length[left] - at
            chunk = eight[self.start[left] + at] & LOW[np.minimum(more, 8)]
            self.hash[left] = mix(self.hash[left] ^ chunk)
            left = left[more > 8]
            if not len(left):
                break
        for i in left.tolist():
            self.hash[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i] : self.end[i]])
        size = np.array([len(p) + 1 for p in parts], np.int64)
        self.bound = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(size)]))

    def __len__(self) -> int:
        return len(self.start)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold(w: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of `k` words: a multilinear sum with odd factors, then mixed."""
    n = len(w) - k + 1
    if n <= 0:
        return w[:0]
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc += w[i : i + n] * np.uint64(FACTORS[i])
    return mix(acc)


#: Bits of the filter of `having`, in blocks of what one bitmap holds: 1 MB whatever the input.
FILTER_BLOCKS, BLOCK_BITS = 256, 32768


def having(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `df` whose `id` is in `ids` (one column, `id`).

    A filter of fixed size drops most other rows before the shuffle; it goes to every task and is
    1 MB at most, however many ids there are. The join after it settles the rest exactly.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BLOCKS * BLOCK_BITS))
    block, bit = (place / BLOCK_BITS).cast("int"), (place % BLOCK_BITS).cast("int")
    bitmaps = (
        ids.where("id is not null")
        .select(block.alias("block"), bit.cast("long").alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(floor(_bit / 8) as int) + 1, 1)")), 16, 10)
    set_there = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    maybe = (
        df.withColumns({"_block": block, "_bit": bit})
        .join(F.broadcast(bitmaps.withColumnRenamed("block", "_block")), "_block")
        .withColumn("_byte", byte.cast("int"))
        .where(set_there)
        .select(*df.columns)
    )
    return maybe.join(ids, "id", "left_semi")


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows that agree in the first `keys` columns, from a sorted partition."""
    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(k)[a.num_rows - 1].equals(b.column(k)[0]) for k in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not same(held[-1], batch):
            yield pa.Table.from_batches(held)
            held = []
        change = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(at, end - at)])
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)
