"""Exact top-k inner products with norm-bucketed retrieval.

Candidates are grouped into buckets by length, and buckets into blocks of bounded size. Queries are
scored against one block of the longest candidates first, which gives each a lower bound of its k-th
best score. With that bound a query needs, in a bucket whose longest vector has length l, a cosine of
at least bound / (|query| * l):

- above 1, the query skips the bucket, before any row moves;
- else each block prunes by length (candidates sorted by length, a prefix can reach the bound) or by
  coordinate (candidates whose direction in the query's largest coordinate lies within the angle that
  the cosine allows), whichever leaves fewer candidates;
- what is left is verified by exact products of integers.

Blocks of queries with alike needs meet blocks of candidates; every block pair is one group of bounded
size, and only the k best of a query per group go on.

Defined results: vectors that are null, empty of numbers (null or non-finite components) or without an
id take no part. Only vectors of the same number of components meet. Several rows with one id: each is
a candidate of other ids, and the smallest vector is the query. Equal scores are ordered by the smaller
id. Scores that do not fit 64 bits are an error. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import staged

#: Rows of a block of candidates and of a block of queries; buckets of lengths at most.
BLOCK, QUERY_BLOCK, BUCKETS = 4096, 1024, 64


def as_integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null, or one is
    not finite."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy().reshape(len(column), dim)


def _products(q: np.ndarray, c: np.ndarray, limit: float) -> np.ndarray:
    """Exact inner products: as doubles while every sum is a whole number below 2^53."""
    if limit < 2**52:
        return np.rint(q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if limit >= 2**62:
        raise OverflowError("inner products beyond 64 bits")
    return q @ c.T


def _best(qid, q, bound, cid, c, k):
    """The k best candidates of each query of a block that may reach the query's bound."""
    ql, cl = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (q, c))
    order = np.argsort(-cl, kind="stable")
    cid, c, cl = cid[order], c[order], cl[order]
    limit = float(ql.max(initial=0) * cl.max(initial=0))
    # By length: a prefix of the candidates is long enough.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where((bound > 0) & (ql > 0), bound / ql, 0) * (1 - 1e-9)
    prefix = np.searchsorted(-cl, -need, "right")
    prefix[need == 0] = len(c)
    # By coordinate: the direction lies within the angle that the block's local cosine allows.
    focus = np.abs(q).argmax(axis=1) if q.shape[1] else np.zeros(len(q), np.int64)
    local = np.clip(np.divide(need, cl[0], out=np.zeros(len(q)), where=cl[0] > 0), 0, 1)
    angle = np.arccos(local)
    unit = np.divide(c, cl[:, None], out=np.zeros(c.shape), where=cl[:, None] > 0)
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(c))
    sorts: dict[int, np.ndarray] = {}
    for f in np.unique(focus[need > 0]).tolist():
        mine = np.flatnonzero((focus == f) & (need > 0))
        sorts[f] = np.argsort(unit[:, f], kind="stable")
        own = np.arccos(np.clip(q[mine, f] / ql[mine], -1, 1))
        values = unit[sorts[f], f]
        low[mine] = np.searchsorted(values, np.cos(np.minimum(own + angle[mine], np.pi)) - 1e-9, "left")
        high[mine] = np.searchsorted(values, np.cos(np.maximum(own - angle[mine], 0)) + 1e-9, "right")
    out = []

    def keep(i, which, scores):
        good = (scores >= bound[i]) & (cid[which] != qid[i])
        which, scores = which[good], scores[good]
        if len(which) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            which, scores = which[scores >= least], scores[scores >= least]
        first = np.lexsort((cid[which], -scores))[:k]
        out.append((np.full(len(first), qid[i]), cid[which][first], scores[first]))

    # Few candidates: one by one. Many: all queries of the block that need them, at once.
    few = (high - low < prefix) & (high - low <= len(c) // 8)
    for i in np.flatnonzero(few).tolist():
        which = np.sort(sorts[int(focus[i])][low[i] : high[i]])
        which = which[which < prefix[i]]
        if len(which):
            keep(i, which, _products(q[i : i + 1], c[which], limit)[0])
    many = np.flatnonzero(~few & (prefix > 0))
    if len(many):
        longest = int(prefix[many].max())
        scores = _products(q[many], c[:longest], limit)
        for row, i in enumerate(many.tolist()):
            keep(i, np.arange(prefix[i]), scores[row, : prefix[i]])
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _scored(k: int):
    def run(table: pa.Table) -> pa.Table:
        found = []
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            part = table.filter(pa.array(dims == dim))
            asks = part.column("asks").to_numpy(zero_copy_only=False)
            ids, vectors = part.column("id").to_numpy(), _vectors(part.column("v"), dim)
            bound = part.column("bound").to_numpy()
            if asks.any() and not asks.all():
                found.append(_best(ids[asks], vectors[asks], bound[asks], ids[~asks], vectors[~asks], k))
        q, c, s = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.table({"query_id": pa.array(q, pa.int64()), "id": pa.array(c, pa.int64()), "score": pa.array(s, pa.int64())})

    return run


#: The bound of a query that has none yet.
NONE = -(1 << 62)


def _meet(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of each group of (part, piece): columns id, dim, v, bound of queries, id, dim, v."""
    columns = ["part", "piece", "id", "dim", "v", "bound", "asks"]
    asked = queries.withColumn("asks", F.lit(True)).select(columns)
    there = candidates.withColumns({"asks": F.lit(False), "bound": F.lit(NONE).cast("long")}).select(columns)
    groups = asked.union(there).groupBy("part", "piece")
    return groups.applyInArrow(_scored(k), "query_id long, id long, score long")


def top_k(vectors: DataFrame, asks: Column, k: int = 5, id: str = "vec_id", vector: str = "v") -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` best other rows of each row where `asks` holds.

    `vector` holds whole numbers (`as_integers`); `asks` is a condition on the columns of `vectors`.
    """
    rows = vectors.select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    rows = rows.where("id is not null and v is not null").withColumns(
        {"dim": F.size("v"), "length": F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))}
    )
    rows = staged(rows, "vectors")
    queries = rows.where("asks").groupBy("id").agg(F.min_by(F.struct("v", "dim", "length"), "v").alias("x"))
    queries = queries.select("id", "x.*")

    # Buckets of lengths, longest first, and the blocks of each: at most BUCKETS rows.
    cuts = rows.agg(F.percentile_approx("length", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    bucket = F.lit(0)
    for cut in cuts:
        bucket = bucket + F.when(F.col("length") < cut, 1).otherwise(0)
    rows = rows.withColumn("bucket", bucket)
    stats = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.max("length").alias("most")).collect()
    blocks = {r["bucket"]: -(-r["n"] // BLOCK) for r in stats}
    if not blocks:
        return _meet(queries.withColumns(dict.fromkeys(["part", "piece", "bound"], F.lit(0).cast("long"))),
                     rows.withColumns(dict.fromkeys(["part", "piece"], F.lit(0).cast("long"))), k).select(
            "query_id", F.lit(1).alias("rank"), F.col("id").alias("vec_id"), "score").limit(0)
    block_of = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col("bucket")]
    first = {b: sum(blocks[x] for x in blocks if x < b) for b in blocks}
    start = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])[F.col("bucket")]
    candidates = rows.withColumn("piece", (start + F.pmod(F.xxhash64("id"), block_of)).cast("long"))

    # A first bound, from one block of the longest bucket.
    parts = -(-queries.count() // QUERY_BLOCK) or 1
    part = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(parts)).cast("long")
    queries = queries.withColumns({"part": part, "bound": F.lit(NONE).cast("long")})
    trial = candidates.where("piece = 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    trial = _meet(queries.withColumn("piece", F.lit(0).cast("long")), trial, k)
    bounds = trial.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(f"n = {int(k)}")
    queries = staged(
        queries.drop("bound").join(bounds.select(F.col("query_id").alias("id"), F.col("least").alias("bound")), "id", "left")
        .withColumn("bound", F.coalesce("bound", F.lit(NONE).cast("long"))),
        "queries",
    )

    # Blocks of queries with alike needs; each goes to the buckets that are long enough for it.
    need = F.when((F.col("bound") > 0) & (F.col("length") > 0), F.col("bound") / F.col("length") * (1 - 1e-9)).otherwise(0.0)
    queries = queries.withColumn("need", need)
    level = F.lit(0)
    for r in sorted(stats, key=lambda r: r["bucket"])[1:]:
        level = level + F.when(F.col("need") <= float(r["most"]), 1).otherwise(0)
    queries = queries.withColumns({"level": level, "part": F.col("part") * (len(stats) + 1) + level})
    ends = {i: sum(blocks[r["bucket"]] for r in sorted(stats, key=lambda r: r["bucket"])[: i + 1]) for i in range(len(stats))}
    end = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])[F.col("level")]
    asked = queries.withColumn("piece", F.explode(F.sequence(F.lit(0), end - 1).cast("array<long>")))
    pairs = asked.select("part", "piece").distinct()
    there = candidates.join(pairs, "piece")
    best = _meet(asked, there, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
