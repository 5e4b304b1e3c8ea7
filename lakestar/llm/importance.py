"""Resampling towards a target distribution by importance weights over hashed n-grams.

1. Separator newlines cut the texts into lines. Equal lines are counted, the features of each distinct
   line are worked out once and count as often as the line occurs; n-grams that reach over a line's end
   are added separately, from the texts.
2. A feature's bucket is the CRC-32 of its bytes. The gain of a bucket is the log of how much likelier
   the target holds it than the documents do, with add-one smoothing, in whole thousandths.
3. The weight of a document is the floored mean gain of its features. Gumbel noise from a hash of its id is
   added to it; the highest scores are a sample without replacement in proportion to the weights.

Two things go to every task and their sizes are parameters: counts and gains of `buckets` buckets. Lines
are counted in each task before they are shuffled, so a line that all documents share is a row per task.

Defined results: words are runs of ASCII letters and digits and of all characters beyond ASCII. A null or
empty text has no features, weight 0, and is never drawn for a positive `least`. A row without an id is
counted but has neither score nor rank. Rows that share an id have the noise in common and are drawn one by
one; equal rows have ranks of their own. Scores that tie go to the smaller id. An empty target leaves the
gains to the smoothing; an empty table gives no rows. Further columns of the inputs are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import staged
from lakestar.operators.ordering import add_row_numbers, source_row

#: Words of lower-cased UTF-8.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UINT32 = 1 << 32


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def inside(words: list[bytes], n: int) -> list[bytes]:
    """All runs of 1 to `n` words."""
    found = list(words)
    for k in range(2, n + 1):
        found += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return found


def across(lines: list[list[bytes]], n: int) -> list[bytes]:
    """The runs of up to `n` words that reach over the end of a line."""
    if n < 2:
        return []
    words = [w for line in lines for w in line]
    line_of = [i for i, line in enumerate(lines) for _ in line]
    found = []
    for k in range(2, n + 1):
        starts = (i for i in range(len(words) - k + 1) if line_of[i] != line_of[i + k - 1])
        found += [b" ".join(words[i : i + k]) for i in starts]
    return found


def _buckets(features: list[bytes], buckets: int) -> np.ndarray:
    return np.array([crc32(f) for f in features], np.int64) % buckets


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(`bucket`, `n`): how many features of the one column of texts fall into a bucket."""
    text = F.coalesce(F.col(texts.columns[0]), F.lit(""))
    lines = texts.select(F.explode(F.split(text, "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))

    def counted(pairs: Iterator[tuple[np.ndarray, np.ndarray | None]]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for places, times in pairs:
            # Counts stay far below 2 ** 53 in one batch, so doubles are exact.
            total += np.bincount(places, times, buckets).astype(np.int64)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                found = [inside(words_of(t), n) for t in batch.column(0).to_pylist()]
                times = np.repeat(batch.column(1).to_numpy(), [len(f) for f in found])
                yield _buckets([x for f in found for x in f], buckets), times

        return counted(pairs())

    def of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    yield _buckets(across([words_of(line) for line in (t or "").split("\n")], n), buckets), None

        return counted(pairs())

    kinds = "bucket long, n long"
    parts = lines.mapInArrow(of_lines, kinds)
    if n > 1:
        parts = parts.unionByName(texts.mapInArrow(of_ends, kinds))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int, buckets: int) -> list[int]:
    """The gain of every bucket, from the texts of both sides."""
    known = bucket_counts(docs, n, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    wanted = bucket_counts(target, n, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    every = docs.sparkSession.range(buckets).selectExpr("id as bucket", "0L as s", "0L as t")
    sums = known.unionByName(wanted).unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    all_s, all_t = sums.agg(F.sum("s")).scalar(), sums.agg(F.sum("t")).scalar()
    ratio = ((F.col("t") + 1) * (all_s + buckets).cast("double")) / ((F.col("s") + 1) * (all_t + buckets).cast("double"))
    rows = sums.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).orderBy("bucket").collect()
    return [r["gain"] for r in rows]


def weights(docs: DataFrame, gains: list[int], n: int) -> DataFrame:
    """(`doc_id`, `n_words`, `n_features`, `weight`) of (id, text) rows. A line that occurs again in a batch
    is not worked out again."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)

        def total(features: list[bytes]) -> int:
            return int(gain[_buckets(features, buckets)].sum()) if features else 0

        for batch in batches:
            known: dict[str, tuple[int, int, int]] = {}
            rows = []
            for text in batch.column(1).to_pylist():
                sums = [0, 0, 0]
                lines = (text or "").split("\n")
                for line in lines:
                    if line not in known:
                        words = words_of(line)
                        found = inside(words, n)
                        known[line] = (len(words), len(found), total(found))
                    sums = [a + b for a, b in zip(sums, known[line])]
                if n > 1:
                    found = across([words_of(line) for line in lines], n)
                    sums[1:] = sums[1] + len(found), sums[2] + total(found)
                rows.append((*sums[:2], sums[2] // sums[1] if sums[1] else 0))
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least: int = 20,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """`doc_id`, `n_words`, `n_features`, `weight`, `score`, and `rank` of the rows drawn: the highest scores of
    `percent` percent of the rows with `least` words or more. Rows with a rank are the sample."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    gains = bucket_gains(rows.select("text"), target.select(F.col(target_text).alias("text")), n, buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / UINT32))).cast("long")
    # Written once: the sample is numbered from narrow rows, and texts are read no more.
    scored = staged(weights(rows, gains, n).withColumn("score", F.col("weight") + noise), "importance")
    fits = F.col("score").isNotNull() & (F.col("n_words") >= least)
    drawn = scored.agg(F.floor(percent * F.count_if(fits) / 100)).scalar()
    placed = add_row_numbers(source_row(scored).where(fits), ["-score", "doc_id"], "rank", ties=["_row"])
    ranked = placed.select(*scored.columns, F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
    return ranked.unionByName(scored.where(~fits).withColumn("rank", F.lit(None).cast("long")))
