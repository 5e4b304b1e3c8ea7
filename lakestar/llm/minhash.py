"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find.

Words are the runs without white space of the text, A-Z in lower case. A document's set holds its
distinct shingles of five words, or the whole sequence if there are fewer. Two documents are linked
if their sets have a Jaccard similarity of at least `threshold`.

1. One pass over the texts gives each document the size and a 128-bit fingerprint of its set, and
   the keys of its signature's bands. Equal sets form a class, found by an aggregate, so a group
   of copies of any size is one row from here on; its smallest id stands for it.
2. Classes that share a band key form a bucket. Each bucket proposes a star: every member against
   the smallest id. The proposals are verified on the full sets.
3. Verified links are merged by union-find. In buckets that still hold several components, blocks
   of members of different components are compared exactly, without emitting pairs, so a link
   that no star centre saw is found too.

Defined results: a null or blank text has the empty set and is linked with nothing. Rows without
an id take part in no link and have no component. Repeated rows have equal results. Rows that share an id
but not the text are one document for links: what one of its texts is linked with, all are. Ties cannot
matter: components are named by their smallest id. Other columns of the input are ignored.

A pair at similarity s shares no band with probability (1 - s^ROWS)^BANDS: 2e-6 at 0.75.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import GOLDEN, MASK, Words, fold, having, mix, runs, staged
from lakestar.llm.components import components

SHINGLE = 5
BANDS, ROWS = 48, 5
#: Elements whose permutations are held at once: bounds memory for any length of text.
SLICE = 1 << 16


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    full, bound = fold(words.hash, size), words.bound.tolist()
    out = []
    for at, end in zip(bound, bound[1:]):
        if end - at >= size:
            found = np.sort(full[at : end - size + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        else:
            out.append(fold(words.hash[at:end], max(1, end - at)))
    return out


class _Shuffles:
    """A permutation of `m` slots per element, drawn step by step.

    The first steps only note which slots were swapped, as most sets are done by then; a table of
    all slots is laid out for the elements that are left.
    """

    NOTED = 6

    def __init__(self, n: int, m: int):
        self.n, self.m, self.swaps, self.table = n, m, [], None

    def _at(self, index: np.ndarray | int) -> np.ndarray:
        value = np.broadcast_to(np.asarray(index, np.int64), (self.n,))
        found = value
        for where, what in self.swaps:
            found = np.where(where == value, what, found)
        return found

    def draw(self, j: int, k: np.ndarray) -> np.ndarray:
        """The slot at place `k`; the one at place `j` goes there instead."""
        if j < self.NOTED:
            slot, other = self._at(k), self._at(j)
            self.swaps.append((k, other))
            return slot
        rows = np.arange(self.n)
        if self.table is None:
            self.table = np.tile(np.arange(self.m, dtype=np.uint16), (self.n, 1))
            for where, what in self.swaps:
                self.table[rows, where] = what
        slot = self.table[rows, k].astype(np.int64)
        self.table[rows, k] = self.table[:, j]
        return slot

    def keep(self, some: np.ndarray) -> None:
        self.n = np.count_nonzero(some)
        self.swaps = [(where[some], what[some]) for where, what in self.swaps]
        self.table = None if self.table is None else self.table[some]


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of `m` values per set, none of which is empty.

    Each element draws a random permutation of the m slots step by step. Step j gives its j-th slot
    the value j + u, with u in [0, 1). A slot keeps the smallest value, so the values of one element
    have distinct ranks, which lowers the variance. A set is done, early, once each of its slots has
    a value below j + 1: later steps cannot lower any. Values hold j in the high 32 bits and u in
    the low ones.
    """
    table = np.full((len(sets), m), m << 32, np.uint64)
    flat = table.reshape(-1)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for at in range(0, len(elements), SLICE):
        e, d = elements[at : at + SLICE], owners[at : at + SLICE]
        shuffles = _Shuffles(len(e), m)
        for j in range(m):
            x = mix(e + np.uint64((j + 1) * GOLDEN & MASK))
            k = (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64) + j
            value = (x >> np.uint64(32)) | np.uint64(j << 32)
            np.minimum.at(flat, d * m + shuffles.draw(j, k), value)
            low = d[0]
            done = table[low : d[-1] + 1].max(axis=1) < np.uint64((j + 1) << 32)
            keep = ~done[d - low]
            left = np.count_nonzero(keep)
            if not left:
                break
            if left < 0.8 * len(e):
                e, d = e[keep], d[keep]
                shuffles.keep(keep)
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band; the number of the band is part of the key."""
    acc = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(GOLDEN)), (len(table), bands))
    for i in range(rows):
        acc = mix(acc ^ table[:, i::rows][:, :bands])
    return acc


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _batches(batch: pa.RecordBatch, step: int = 2048) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                sets = shingle_sets(batch.column(1).to_pylist())
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                table = superminhash([sets[i] for i in full], bands * rows)
                keys = band_keys(table, bands, rows)
                sketch = iter(mix(table).astype(np.uint8))
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes),
                        pa.array(_signed(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64))),
                        pa.array(_signed(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64))),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(keys.reshape(-1)))),
                        pa.array([next(sketch).tobytes() if n else None for n in sizes], pa.binary()),
                    ],
                    ["id", "n", "f1", "f2", "keys", "sketch"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _batches(whole):
            sets = shingle_sets(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            # Sorted as signed numbers, which is the order that the comparison relies on.
            values = np.concatenate([np.sort(_signed(s)) for s in sets] or [np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["id", "shingles"],
            )


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For (id, text): the size `n` of the set, its fingerprint `f1`, `f2`, the band `keys`, and a
    `sketch` with one byte of each value of the signature."""
    schema = "id long, n long, f1 long, f2 long, keys array<long>, sketch binary"
    return docs.mapInArrow(_signatures(bands, rows), schema)


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Sketches of equal length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _alike(threshold: float):
    """Drops pairs (a, b, sketch of a, sketch of b) that cannot be linked, judged by sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _bytes(batch.column(2)), _bytes(batch.column(3))
                keep = (x == y).sum(axis=1) >= _least(x.shape[1], threshold)
                yield batch.filter(pa.array(keep)).select([0, 1])

    return run


def _least(m: int, threshold: float) -> float:
    """Equal values that two sketches have at least if their sets are similar enough.

    Five standard deviations of independent draws below the mean, and those of this signature
    vary less.
    """
    return m * threshold - 5 * (m * threshold * (1 - threshold)) ** 0.5


def _meet(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of role 0 and role 1 of a group that may be linked: those of different
    components, of similar size, with similar sketches."""
    role, comp, n = (table.column(c).to_numpy() for c in ("role", "comp", "n"))
    x, y = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    if not len(x) or not len(y):
        return x[:0], y[:0]
    sketch = _bytes(table.column("sketch"))
    left, right = [], []
    for i in y.tolist():
        fits = x[(comp[x] != comp[i]) & (np.minimum(n[x], n[i]) >= threshold * np.maximum(n[x], n[i]) - 1e-9)]
        fits = fits[(sketch[fits] == sketch[i]).sum(axis=1) >= _least(sketch.shape[1], threshold)]
        left.append(fits)
        right.append(np.full(len(fits), i))
    return np.concatenate(left), np.concatenate(right)


def _promising(threshold: float):
    """The rows of sorted groups that have a partner they may be linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 3):
            x, y = _meet(table, threshold)
            if len(x):
                yield from table.take(np.union1d(x, y)).combine_chunks().to_batches()

    return run


def _linked(percent: int):
    """The pairs of sorted groups that are linked, verified on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 3):
            x, y = _meet(table, percent / 100)
            ids = table.column("id").to_numpy()
            sets = [s.values.to_numpy() for s in table.column("shingles")]
            found = []
            for i, j in zip(x.tolist(), y.tolist()):
                a, b = sets[i], sets[j]
                at = np.searchsorted(b, a)
                both = np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    found.append((ids[i], ids[j]))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


#: Members of a bucket that are compared with as many others at once.
BLOCK = 256


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 75
) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` for each row of `docs`."""
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sig = staged(signatures(docs), "signatures")
    full = sig.where("n > 0 and id is not null")
    classes = full.groupBy("n", "f1", "f2").agg(F.min("id").alias("id"))
    reps = staged(full.join(classes, ["id", "n", "f1", "f2"], "left_semi").drop("f1", "f2"), "classes")

    # Buckets with two members at least, and the star that each proposes.
    rows = reps.select("id", "n", F.explode("keys").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
    buckets = buckets.where("centre < last").drop("last")
    members = staged(rows.join(buckets, "key"), "members")
    # An id that has several texts stands for several classes, and has a sketch of each.
    sketches = reps.select("id", "n", "sketch").distinct()
    first, second = (sketches.select(F.col("id").alias(i), F.col("sketch").alias(s)) for i, s in (("a", "sa"), ("b", "sb")))
    star = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    star = star.distinct().join(first, "a").join(second, "b")
    star = staged(star.select("a", "b", "sa", "sb").mapInArrow(_alike(percent / 100), "a long, b long"), "star")

    # Full sets of the documents that have a bucket in common with another one.
    near = staged(having(docs, members.select("id").distinct()).distinct(), "near")
    sets = near.mapInArrow(_sets, "id long, shingles array<long>")
    both = star.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    both = both.withColumn("both", F.size(F.array_intersect("x", "y")))
    linked = f"100 * both >= {int(percent)} * (size(x) + size(y) - both)"
    links = staged(both.where(linked).select("a", "b"), "links")

    # Buckets that still hold several components: members outside the centre's component, in
    # blocks, against blocks of all members.
    found = components(links)
    members = members.join(found, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    members = staged(members.select("key", "id", "n", "comp"), "labelled")
    several = members.groupBy("key").agg(
        F.min_by("comp", "id").alias("main"), F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("all")
    )
    several = several.where("least < most").drop("least", "most")
    left = members.join(several, "key").withColumn("minor", F.expr("comp <> main"))
    counts = left.where("minor").groupBy("key").agg(F.count("*").alias("few"))
    left = left.join(counts, "key").join(sketches, ["id", "n"])
    blocks = {"across": F.ceil(F.col("all") / BLOCK), "down": F.ceil(F.col("few") / BLOCK)}
    left = left.withColumns(blocks).withColumns(
        {"i": F.pmod(F.xxhash64("id"), "across"), "j": F.pmod(F.xxhash64(F.lit(1), "id"), "down")}
    )
    columns = ["key", "i", "j", "role", "id", "comp", "n", "sketch"]
    upper = left.withColumns({"j": F.explode(F.expr("sequence(0, down - 1)")), "role": F.lit(0)})
    lower = left.where("minor").withColumns({"i": F.explode(F.expr("sequence(0, across - 1)")), "role": F.lit(1)})
    pieces = upper.select(columns).union(lower.select(columns))
    kinds = "key long, i long, j long, role int, id long, comp long, n long, sketch binary"

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    promising = staged(grouped(pieces).mapInArrow(_promising(percent / 100), kinds), "promising")
    more = grouped(promising.join(sets, "id").select(*columns, "shingles"))
    more = more.mapInArrow(_linked(percent), "a long, b long").distinct()

    # A copy is linked with the document that stands for its class.
    copies = full.join(classes.withColumnRenamed("id", "b"), ["n", "f1", "f2"])
    copies = copies.where("id <> b").select(F.col("id").alias("a"), "b")
    found = components(links.union(more).union(copies))
    out = sig.select("id", "n").join(found, "id", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.expr("doc_id <=> component_id"))
