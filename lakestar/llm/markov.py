"""A hidden Markov language model: trained by Baum-Welch over all training texts, scored exactly.

1. Texts are cut into tokens: words, then one end. Documents are coded in blocks of a few megabytes, each with
   its own list of distinct tokens. Blocks and lists are written once; the lists of all blocks are counted by a
   shuffle of one row per block and distinct token, so no task or driver holds the vocabulary.
2. A token is emitted in two steps: a state emits a class, the class emits the token. Tokens that occur often
   are spread by hash over `FREQUENT` classes, the others over `RARE` classes, and a class emits its tokens in
   proportion to their counts plus one. So what a state has to know is a table of fixed size, and what
   lies beyond it, the counts of all tokens, is worked out once per document by joining blocks with counts.
   The end has a class of its own, and so have unknown tokens: they are one type, as probable in every state
   as tokens seen once are among all training tokens.
3. Each round of Baum-Welch reads the coded training texts once. Tasks run the scaled forward and backward
   recursions over windows of `WINDOW` tokens and return expected counts per class and state and per pair of
   states; these are added by a shuffle and give the next parameters. Windows inside a text start from the
   stationary distribution; no token is left out.
4. The score is the exact log probability of the whole text, by the scaled forward recursion over all its
   tokens, windows or not, plus what the classes add.

Parameters go to every task: (FREQUENT + RARE + 2) x states numbers, whatever the size of the corpus.

Defined results: a null or empty text is the end alone. Upper case is folded for A to Z only. Rows without an
id are trained on and get a null id; repeated rows count and are returned as often as they occur. Without
training texts every token is unknown. An empty table gives no rows. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import staged

#: Classes of tokens that occur often and of the others; so many tokens count as occurring often.
FREQUENT, RARE, OFTEN = 1 << 16, 1 << 14, 1 << 15
UNKNOWN, END = FREQUENT + RARE, FREQUENT + RARE + 1
#: One row more, of ones, for the steps that fill a window.
CLASSES, FILLED = FREQUENT + RARE + 2, FREQUENT + RARE + 2
#: Bytes of text in a block, tokens in a window, windows that are run together.
BLOCK, WINDOW, TOGETHER = 8 << 20, 64, 4096
#: Tokens by how often they occur: this many steps for each doubling of the count.
STEPS = 16


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i4")


CODED = "block long, doc_id long, held_out boolean, tokens binary, words array<binary>, times array<int>"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, held out, text): a row for each document, with its tokens as places in the list of its block,
    and a row for each block, with that list and how often training texts hold each token. Place 0 is the end."""
    task, block = TaskContext.get().partitionId(), 0
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                        ("tokens", pa.binary()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])
    for batch in batches:
        filled = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy()) // BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            part = batch.slice(start, stop - start)
            places: dict[bytes, int] = {b" ": 0}
            texts = []
            for text in part.column(2).to_pylist():
                found = [places.setdefault(w, len(places)) for w in (text or "").encode().lower().split()]
                texts.append(np.array([*found, 0], np.int32))
            held = part.column(1).to_pylist()
            taught = [t for t, out in zip(texts, held) if not out]
            times = np.bincount(np.concatenate(taught), minlength=len(places)) if taught else np.zeros(len(places), int)
            number = task << 32 | block
            block += 1
            rows = {
                "block": [number] * (len(texts) + 1),
                "doc_id": [*part.column(0).to_pylist(), None],
                "held_out": [*held, None],
                "tokens": [*map(_packed, texts), None],
                "words": [*[None] * len(texts), list(places)],
                "times": [*[None] * len(texts), times],
            }
            yield pa.RecordBatch.from_pydict(rows, schema)


def _counted(blocks: DataFrame) -> DataFrame:
    """(`block`, `place`, `c`, `spread`, `first`): the count of each token of each block's list in all training
    texts, a hash of the token, and one mark per distinct token. A token is in a list once, so no token has more
    than one row a block."""
    listed = blocks.where("words is not null").select("block", F.posexplode(F.arrays_zip("words", "times")).alias("place", "x"))
    same = "partition by x.words"
    return listed.selectExpr(
        "block", "place", f"sum(cast(x.times as long)) over ({same}) as c",
        f"block = min(block) over ({same}) as first", "xxhash64(x.words) as spread",
    )


def _class(least: int) -> Column:
    """The class of a token from its count and hash; tokens with `least` occurrences occur often."""
    often = F.pmod(F.col("spread"), F.lit(FREQUENT))
    other = F.pmod(F.col("spread"), F.lit(RARE)) + FREQUENT
    kind = F.when(F.col("place") == 0, END).when(F.col("c") == 0, UNKNOWN)
    return kind.when(F.col("c") >= least, often).otherwise(other).cast("int")


class Model:
    """Start, transitions and emissions of classes; `emit` has a row per class and a last one of ones."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move = start, move
        self.emit = np.vstack([emit, np.ones(len(start), emit.dtype)]).astype(np.float32)

    def inside(self) -> np.ndarray:
        """The stationary distribution."""
        at = np.full(len(self.start), 1 / len(self.start))
        for _ in range(200):
            at = at @ self.move
        return at / at.sum()

    def expected(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts: of classes by state, of moves between states, and of starts of texts."""
        k = len(self.start)
        emitted, moved, started = np.zeros((CLASSES, k)), np.zeros((k, k)), np.zeros(k)
        sizes = np.array([len(t) for t in texts])
        windows = -(-sizes // WINDOW)
        filled = np.full((windows.sum(), WINDOW), FILLED, np.int32)
        flat = filled.ravel()
        for text, at in zip(texts, np.concatenate([[0], np.cumsum(windows)[:-1]]) * WINDOW):
            flat[at : at + len(text)] = text
        leads = np.zeros(len(filled), bool)
        leads[np.concatenate([[0], np.cumsum(windows)[:-1]])] = True
        move, inside = self.move.astype(np.float32), self.inside()
        for at in range(0, len(filled), TOGETHER):
            part, lead = filled[at : at + TOGETHER].T, leads[at : at + TOGETHER]
            seen = self.emit[part]
            forward, scale = np.empty_like(seen), np.empty(part.shape, np.float32)
            now = np.where(lead[:, None], self.start, inside).astype(np.float32)
            for t in range(WINDOW):
                now = (now if t == 0 else now @ move) * seen[t]
                scale[t] = now.sum(1)
                now /= scale[t][:, None]
                forward[t] = now
            behind = np.ones_like(now)
            real = part != FILLED
            for t in reversed(range(WINDOW)):
                state = forward[t] * behind
                forward[t] = state * real[t][:, None]
                if t:
                    ahead = behind * seen[t] / scale[t][:, None]
                    before = forward[t - 1]
                    moved += (before * real[t][:, None]).T @ ahead * self.move
                    behind = ahead @ move.T
            started += forward[0][lead].sum(0)
            places = part.ravel()
            for s in range(k):
                emitted[:, s] += np.bincount(places, forward[:, :, s].ravel(), CLASSES + 1)[:CLASSES]
        return emitted, moved, started

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """The exact log probability of each sequence of classes: one step a token, over all texts that are long
        enough."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        found, now = np.zeros(len(texts)), np.tile(self.start, (len(texts), 1))
        move, emit = self.move, self.emit.astype(np.float64)
        falling = -sizes[order]
        ends = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        for t in range(sizes.max(initial=0)):
            n = np.searchsorted(falling, -t, side="left")
            now = (now[:n] if t == 0 else now[:n] @ move) * emit[flat[ends[:n] + t]]
            scale = now.sum(1)
            now /= scale[:, None]
            found[order[:n]] += np.log10(scale)
        return found


def _texts(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    return [_unpacked(x) for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def _round(coded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all training texts."""
    k = len(model.start)
    names = [f"s{i}" for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of classes, then of states moved from, then one of starts.
        total = np.zeros((CLASSES + k + 1, k))
        for batch in batches:
            texts = _texts(batch, "classes")
            if texts:
                total += np.vstack([x.reshape(-1, k) for x in model.expected(texts)])
        there = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(there), *(pa.array(total[there, i]) for i in range(k))], ["row", *names])

    parts = coded.where("not held_out").select("classes").mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    sums = parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).collect()
    total = np.zeros((CLASSES + k + 1, k))
    total[[r["row"] for r in sums]] = [r[1:] for r in sums] if sums else np.zeros((0, k))
    return total[:CLASSES], total[CLASSES:-1], total[-1]


def _emissions(counts: np.ndarray, added: np.ndarray, unknown: float) -> np.ndarray:
    """From counts of classes by state. `added` is what adding one to each token adds to a class; states share
    it by size. With one state these are the smoothed counts, but for unknown tokens."""
    share = counts.sum(0) / max(counts.sum(), 1e-300)
    smooth = counts + added[:, None] * share
    smooth[UNKNOWN] = 0
    known = smooth / np.maximum(smooth.sum(0), 1e-300) * (1 - unknown)
    known[UNKNOWN] = unknown if known.any() else 1.0
    return known


def learn(coded: DataFrame, totals: np.ndarray, added: np.ndarray, unknown: float, states: int, rounds: int) -> Model:
    """Baum-Welch from slightly different states that tend to stay."""
    rng = np.random.default_rng(13)
    uneven = totals[:, None] * rng.uniform(0.5, 1.5, (CLASSES, states))
    stay = 0.95 if states > 1 else 1.0
    move = np.full((states, states), (1 - stay) / max(1, states - 1))
    np.fill_diagonal(move, stay)
    model = Model(np.full(states, 1 / states), move, _emissions(uneven, added, unknown))
    for _ in range(rounds if totals.any() else 0):
        emitted, moved, started = _round(coded, model)
        moved, started = moved + 1, started + 1
        model = Model(started / started.sum(), moved / moved.sum(1)[:, None], _emissions(emitted, added, unknown))
    return model


def score_texts(
    docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", states: int = 8, rounds: int = 6
) -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known` (tokens that training texts hold), `train_tokens`, `base_score`
    (by smoothed counts of single tokens) and `score` (by the model) of each row, as log10 probabilities.

    Rows where `held_out` is true are scored but not learned from.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    blocks = staged(rows.mapInArrow(_coded, CODED), "blocks")
    counted = staged(_counted(blocks), "counts")
    once = counted.where("first and c > 0")
    step = F.floor(F.log2("c") * STEPS).cast("int")
    steps = once.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.sum("c").alias("c"), F.min("c").alias("least"),
                                                 F.count_if(F.col("c") == 1).alias("single")).orderBy(F.desc("step")).collect()
    n, v = sum(r["c"] for r in steps), sum(r["v"] for r in steps)
    above = np.cumsum([r["v"] for r in steps])
    least = next((r["least"] for r, upto in reversed(list(zip(steps, above))) if upto <= OFTEN), 1 << 62)
    unknown = min(0.5, max(sum(r["single"] for r in steps) / max(n, 1), 1 / (n + v + 1)))
    sums = once.groupBy(_class(least).alias("class")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    totals, added = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        totals[r["class"]], added[r["class"]] = r["c"], r["v"]
    per_class = totals + added

    def code(key: tuple, texts: pa.Table, tokens: pa.Table) -> pa.Table:
        """The documents of a block with classes instead of tokens, and what does not depend on states."""
        place = tokens["place"].to_numpy()
        c, kind = np.empty(len(place)), np.empty(len(place), np.int32)
        c[place], kind[place] = tokens["c"].to_numpy(), tokens["class"].to_numpy()
        base = np.log10((c + 1) / (n + v + 1))
        share = np.where(c > 0, np.log10((c + 1) / np.maximum(per_class[kind], 1)), 0.0)
        found = [_unpacked(x) for x in texts["tokens"].to_pylist()]
        return pa.table({
            "doc_id": texts["doc_id"],
            "held_out": texts["held_out"],
            "n_tokens": pa.array([len(t) for t in found], pa.int64()),
            "n_known": pa.array([int((c[t] > 0).sum()) for t in found], pa.int64()),
            "base_score": pa.array([float(base[t].sum()) for t in found], pa.float64()),
            "share": pa.array([float(share[t].sum()) for t in found], pa.float64()),
            "classes": pa.array([_packed(kind[t]) for t in found], pa.binary()),
        })

    texts = blocks.where("tokens is not null").select("block", "doc_id", "held_out", "tokens")
    tokens = counted.select("block", "place", "c", _class(least).alias("class"))
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, share double, classes binary"
    coded = staged(texts.groupBy("block").cogroup(tokens.groupBy("block")).applyInArrow(code, kinds), "coded")
    model = learn(coded, totals, added, unknown, states, rounds)

    kept = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.log10(_texts(batch, "classes")) + batch.column("share").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found)], [*kept, "score"])

    scored = coded.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
