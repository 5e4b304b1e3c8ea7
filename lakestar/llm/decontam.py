"""Documents that hold benchmark items: SimHash of item-sized windows and exact verification.

Words are the runs without white space, in lower case. A shingle is five consecutive words, or all words
of an item that has fewer. For an item of n words, windows are n consecutive words of a document (fewer at
its end). Two of them are alike if their shingles, weighted by how often each occurs, have a weighted
Jaccard similarity of at least `percent` / 100.

1. One pass over the texts keeps the places of shingles that an item of some size n has; nothing else of a
   text can add to a similarity. A window that is not entered at such a place is no better than the next
   one that is, so windows start there. Windows of size n with too few such places for any item of that
   size are left out.
2. Each window and item gets a 64-bit SimHash: each bit is the majority over the weighted shingles. A window
   slides: along the places of a text, running sums add the shingle that enters and subtract the one that
   leaves, so the work is linear in the places, however long the items are.
3. Fingerprints are cut into `RADIUS` + 1 blocks. Two within the radius agree in one block at least, so
   joining on (size, block, bits) finds all of them. Equal fingerprints are joined once.
4. The pairs are verified exactly, by sliding as well. An item that has a shingle c times shares an occurrence of it
   with a window if the occurrence is in the window and the c-th one before it is not. That holds for a run
   of starts, so the starts of runs less their ends up to a window's start are the size of the intersection.

At a similarity of 0.75 the angle between the weighted shingles makes 11 bits differ on average, with a
deviation of 3; the radius lies four deviations above.

All of it is built-in expressions. The items are joined, not collected; the planner sends them to every
task only if their written size allows it.

Defined results: null or blank texts and items match nothing. Repeated items and repeated rows of one
id count once; of several windows the most similar one is reported, the first of these. Rows without an
id are reported under a null id. Items and texts of any length are taken whole (counters are 32 bits wide).
Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import GAP, staged

SHINGLE, RADIUS, BITS = 5, 23, 64
#: Counters of a fingerprint: 32 bits wide, two to a number. A text has fewer words than they count.
LANES = 32


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), GAP, " ")), " ")


def shingles(found: Column, k: int) -> Column:
    """The hash of each run of `k` words, in order."""
    run = lambda i: F.xxhash64(F.lit(k), *(F.get(found, i + j) for j in range(k)))
    places = F.sequence(F.lit(0), F.size(found) - k)
    return F.when(F.size(found) >= k, F.transform(places, run)).otherwise(F.array().cast("array<long>"))


def lanes(h: Column) -> list[Column]:
    """The bits of a hash as counters that can be summed."""
    bit = lambda i: F.shiftright(h, i).bitwiseAND(F.lit(1))
    return [bit(2 * j) + F.shiftleft(bit(2 * j + 1), 32) for j in range(LANES)]


def majority(sums: list[Column], n: Column) -> Column:
    """The fingerprint: a bit is set if more than half of the `n` summed hashes have it."""
    out = F.lit(0).cast("long")
    for j, lane in enumerate(sums):
        for i in range(2):
            count = F.shiftrightunsigned(lane, 32 * i).bitwiseAND(F.lit(0xFFFFFFFF))
            out = out.bitwiseOR(F.when(count * 2 > n, F.shiftleft(F.lit(1).cast("long"), 2 * j + i)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprinted(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per `key` of (key, h): `fp` and `m`, how many shingles."""
    named = rows.withColumns({f"l{j}": c for j, c in enumerate(lanes(F.col("h")))})
    summed = named.groupBy(*key).agg(F.count("*").alias("m"), *(F.sum(f"l{j}").alias(f"l{j}") for j in range(LANES)))
    return summed.select(*key, "m", majority([F.col(f"l{j}") for j in range(LANES)], F.col("m")).alias("fp"))


def _slid(hits: DataFrame) -> DataFrame:
    """For each of `hits`, the window that starts there: `start`, `m` (its hits), `total` (its shingles) and `fp`."""
    key = ["_row", "n", "k"]
    span = F.col("n") - F.col("k") + 1
    # A hit is in the windows that start from `span` - 1 places before it up to its own place. Doubled places
    # put what enters at a place before the window there, and what leaves after it right behind.
    enters = F.struct((2 * (F.col("pos") - span + 1)).cast("long").alias("at"), F.lit(1).cast("long").alias("sign"))
    leaves = F.struct((2 * F.col("pos") + 1).cast("long").alias("at"), F.lit(-1).cast("long").alias("sign"))
    moves = hits.select("*", F.explode(F.array(enters, leaves)).alias("x")).select(*hits.columns, "x.*").repartition(*key)
    moves = moves.withColumns({f"l{j}": F.col("sign") * c for j, c in enumerate(lanes(F.col("h")))})
    to_here = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The row of the window's own hit has subtracted it already.
    sums = {f"s{j}": F.sum(f"l{j}").over(to_here) - F.col(f"l{j}") for j in range(LANES)}
    slid = moves.withColumns(sums | {"m": F.sum("sign").over(to_here) + 1}).where("sign < 0")
    total = F.least(span, F.col("size") - F.col("k") + 1 - F.col("pos"))
    fp = majority([F.col(f"s{j}") for j in range(LANES)], F.col("m"))
    return slid.select("_row", "doc_id", "n", "k", F.col("pos").alias("start"), total.alias("total"), "m", fp.alias("fp"))


def _shared(pairs: DataFrame, hits: DataFrame, held: DataFrame) -> DataFrame:
    """`pairs` of windows and items with `shared`, the size of the weighted intersection of their shingles."""
    wanted = pairs.select("_row", "_item").distinct().join(held, "_item")
    same = hits.select("_row", "n", "k", "h", "pos").join(wanted, ["_row", "n", "k", "h"])
    # The places of one shingle in one text, in order.
    places = same.groupBy("_row", "_item", "n", "k", "h", "c").agg(F.array_sort(F.collect_list("pos")).alias("ps"))
    placed = F.transform("ps", lambda p, i: F.struct(p.alias("pos"), F.get(F.col("ps"), i - F.col("c")).alias("before")))
    placed = places.select("_row", "_item", "n", "k", F.explode(placed).alias("x")).select("_row", "_item", "n", "k", "x.*")
    first = F.greatest(F.col("before") + 1, F.col("pos") - F.col("n") + F.col("k"))
    run = F.array(F.struct(first.alias("at"), F.lit(1).alias("add")), F.struct((F.col("pos") + 1).alias("at"), F.lit(-1).alias("add")))
    runs = placed.select("_row", "_item", F.explode(run).alias("x")).select("_row", "_item", "x.*")
    asked = pairs.withColumns({"at": F.col("start"), "add": F.lit(0)})
    up_to = Window.partitionBy("_row", "_item").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = asked.unionByName(runs, allowMissingColumns=True).withColumn("shared", F.sum("add").over(up_to))
    return swept.where("start is not null").drop("at", "add")


def _blocks(fp: Column, radius: int) -> Column:
    """The fingerprint in radius + 1 pieces, each with its number."""
    edges = [i * BITS // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(F.lit(b).alias("b"), F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
            for b, (lo, hi) in enumerate(zip(edges, edges[1:]))
        )
    )


def contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", item: str = "item_id", text: str = "text",
    percent: int = 75, radius: int = RADIUS,
) -> DataFrame:
    """`doc_id`, `item_id`, `similarity`, `start` (the window's first word, from 0), `n_words` (the
    item's): a row for each document and item that it holds."""
    items = items.select(F.col(item).alias("item_id"), words(F.col(text)).alias("w")).where("w[0] <> ''")
    items = items.distinct().withColumns({"n": F.size("w"), "k": F.least(F.size("w"), F.lit(SHINGLE)), "_item": F.xxhash64("item_id", "w")})
    per_k = [F.when(F.col("k") == k, shingles(F.col("w"), k)) for k in range(1, SHINGLE + 1)]
    parts = items.select("_item", "item_id", "n", "k", F.explode(F.coalesce(*per_k)).alias("h"))
    parts = staged(parts, "items")
    vocabulary = staged(parts.select("h", "n", "k").distinct(), "vocabulary")
    sizes = sorted(r["k"] for r in vocabulary.select("k").distinct().collect())

    # The only pass over the texts.
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), words(F.col(text)).alias("w"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    hits = None
    for k in sizes or [SHINGLE]:
        some = rows.select("_row", "doc_id", F.size("w").alias("size"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "h"))
        some = some.join(vocabulary.where(F.col("k") == k), "h")
        hits = some if hits is None else hits.unionByName(some)
    hits = staged(hits, "hits")

    enough = f"{100 + int(percent)} * m >= {int(percent)} * (total + n - k + 1)"
    windows = staged(_slid(hits).where(enough).drop("m"), "windows")
    held = parts.groupBy("_item", "n", "k", "h").agg(F.count("*").cast("int").alias("c"))
    known = fingerprinted(parts, ["_item", "item_id", "n"])
    known = staged(known.select("_item", "item_id", "n", F.col("fp").alias("ifp"), F.col("m").alias("im")), "known")

    seen = windows.select("n", "fp").distinct().withColumn("x", F.explode(_blocks(F.col("fp"), radius))).select("n", "fp", "x.*")
    index = known.select("n", "_item", "ifp", F.explode(_blocks(F.col("ifp"), radius)).alias("x")).select("n", "_item", "ifp", "x.*")
    near = seen.join(index, ["n", "b", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
    near = near.select("n", "fp", "_item").distinct()

    pairs = windows.join(near, ["n", "fp"]).join(known.select("_item", "item_id", "im"), "_item")
    pairs = staged(pairs.select("_row", "_item", "doc_id", "item_id", "n", "start", "total", "im"), "pairs")
    alike = _shared(pairs, hits, held).where(f"{100 + int(percent)} * shared >= {int(percent)} * (total + im)")
    alike = alike.withColumn("similarity", F.col("shared") / (F.col("total") + F.col("im") - F.col("shared")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("first"), "n")).alias("x")
    return alike.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "x.similarity", (-F.col("x.first")).cast("long").alias("start"), F.col("x.n").cast("long").alias("n_words")
    )
