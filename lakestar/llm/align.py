"""Alignment of the tokens of two tokenizers over the same bytes.

1. Each text, with a space in front, is encoded by a byte-level BPE (A) and by a piece model with byte
   fallback (B). Documents are taken in blocks of a few megabytes, and places are counted in bytes through the
   block, so a place belongs to one document. `merge_asof` finds, for the start of each token, the other side's
   token that covers it; the union of both directions is all pairs that overlap. Places where tokens of both
   sides end cut the document into groups.
2. A block keeps the distinct pairs of ids with their counts, and each document which of these it holds how
   often. Both are written once. The counts of a pair in all blocks are added by a shuffle with one row per
   block and distinct pair; the highest count of each B id is a table no longer than B's vocabulary.
3. Counts go back to their block, where the sums of each document are made.

A's ids come from the merges of its JSON file. They are looked up by a library that is faster than the file's
own where both are sure to cut a text alike (characters that have been in Unicode for long, no very long
runs of white space); elsewhere by the file's own.

Defined results: a text that is null or empty, or that A or B can't give back byte for byte, has no tokens: zeros
and an empty digest. Strings of special tokens are plain text. Rows are independent but for the counts; repeated
rows count as often as they occur, and rows without an id are kept. An empty table gives no rows. Further columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator
from functools import cached_property
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import staged

#: Bytes of text in a block.
BLOCK = 4 << 20
#: A pair of ids as one number.
SHIFT = 32
#: What either library may cut in its own way: characters added to Unicode lately, long runs of white space.
UNSURE = re.compile(r"[^\x00-֏　-ヿ一-龥가-힣]|\s{1000}")


class Coders:
    """Both tokenizers, as functions from texts to ids, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import sentencepiece

        self.path_a, self.pattern = path_a, pattern
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        # Other bytes are written as the characters from 256 on.
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        #: Whether a smaller id is always an earlier merge, so that ids are ranks.
        self.ranked = [model["vocab"][t] for t in merged] == list(range(256, 256 + len(merged)))
        self.bytes_a = self._listed({i: t for t, i in self.ranks.items()})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        # The text of an id, and what may follow it: a token, the other side, a group.
        self.text_a = [f"{i}{mark}" for mark in ",|" for i in range(len(self.bytes_a))]
        self.text_b = [f"{i}{mark}" for mark in ",;" for i in range(len(self.bytes_b))]

    @staticmethod
    def _listed(tokens: dict[int, bytes]) -> list[bytes]:
        return [tokens.get(i, b"") for i in range(max(tokens) + 1)]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    @cached_property
    def fast(self):
        import tiktoken

        return tiktoken.Encoding("a", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path_a)
        found.encode_special_tokens = True
        return found

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """The ids of both sides, or None where one can't give the text back."""
        if not text:
            return None
        spaced = " " + text
        if self.ranked and not UNSURE.search(spaced):
            a = self.fast.encode_ordinary(spaced)
        else:
            a = self.exact.encode(spaced, add_special_tokens=False).ids
        b = self.pieces.encode(text)
        data = spaced.encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != data or b"".join(map(self.bytes_a.__getitem__, a)) != data:
            return None
        return a, b


def coders(path_a: str, path_b: str, pattern: str) -> Coders:
    """Built once per Python worker."""
    kept = sys.modules.setdefault("lakestar_coders", ModuleType("lakestar_coders")).__dict__
    if (path_a, path_b, pattern) not in kept:
        kept[path_a, path_b, pattern] = Coders(path_a, path_b, pattern)
    return kept[path_a, path_b, pattern]


def overlaps(start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (number of an A token, number of a B token) that overlap, from where tokens start. Both sides
    cover the same places without gaps."""
    a = pd.DataFrame({"at": start_a, "start": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "b": np.arange(len(start_b))})
    covering_b = pd.merge_asof(a[["at", "a"]], b, on="at")
    covering_a = pd.merge_asof(b, a, on="at")
    # Tokens that start together have been found from A's side.
    behind = covering_a["start"].to_numpy() < covering_a["at"].to_numpy()
    pairs_a = np.concatenate([covering_b["a"].to_numpy(), covering_a["a"].to_numpy()[behind]])
    pairs_b = np.concatenate([covering_b["b"].to_numpy(), covering_a["b"].to_numpy()[behind]])
    return pairs_a, pairs_b


def aligned(own: Coders, texts: list[str | None], keep: bool = False) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """For a block of texts: a row for each, and the distinct pairs of ids with their counts. A row tells which of
    these its text holds, and how often."""
    found = [own.ids(t or "") for t in texts]
    filled = [i for i, x in enumerate(found) if x]
    none = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "digest": "", "groups": "" if keep else None,
            "places": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)}
    rows = [dict(none) for _ in texts]
    if not filled:
        return rows, np.zeros(0, np.int64), np.zeros(0, np.int64)
    many_a, many_b = (np.array([len(found[i][side]) for i in filled]) for side in (0, 1))
    ids_a, ids_b = (np.concatenate([np.array(found[i][side], np.int64) for i in filled]) for side in (0, 1))
    del found
    end_a, end_b = np.cumsum(own.size_a[ids_a]), np.cumsum(own.size_b[ids_b])
    start_a, start_b = end_a - own.size_a[ids_a], end_b - own.size_b[ids_b]
    doc_of = np.repeat(np.arange(len(filled)), many_a)
    # Which pairs, by document.
    at_a, at_b = overlaps(start_a, start_b)
    doc, code = doc_of[at_a], ids_a[at_a] << SHIFT | ids_b[at_b]
    pairs, place, counts = np.unique(code, return_inverse=True, return_counts=True)
    held, times = np.unique(doc * len(pairs) + place, return_counts=True)
    cuts = np.searchsorted(held, np.arange(len(filled) + 1) * len(pairs))
    links = np.bincount(doc, minlength=len(filled))
    # Groups, and their text: tokens in order of group, A before B.
    last_a, last_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
    group_a = np.concatenate([[0], np.cumsum(last_a)[:-1]])
    group_b = np.concatenate([[0], np.cumsum(last_b)[:-1]])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    shown = np.concatenate([ids_a + len(own.bytes_a) * last_a, len(own.text_a) + ids_b + len(own.bytes_b) * last_b])[order].tolist()
    text_of = (own.text_a + own.text_b).__getitem__
    ends = np.cumsum(many_a + many_b).tolist()
    groups = np.bincount(doc_of[last_a], minlength=len(filled))
    for j, i in enumerate(filled):
        text = "".join(map(text_of, shown[ends[j - 1] if j else 0 : ends[j]]))[:-1]
        own_places = held[cuts[j] : cuts[j + 1]] - j * len(pairs)
        rows[i] = {"n_a": int(many_a[j]), "n_b": int(many_b[j]), "n_groups": int(groups[j]), "n_links": int(links[j]),
                   "digest": hashlib.sha256(text.encode()).hexdigest(), "groups": text if keep else None,
                   "places": own_places, "times": times[cuts[j] : cuts[j + 1]]}
    return rows, pairs, counts


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(values, prepend=0).astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), "<i4"), dtype=np.int64)


ROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("digest", pa.string()), ("groups", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
ROW_KINDS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, digest string, groups string, "
    "places binary, times binary, pairs array<long>, counts array<long>"
)


def align(
    docs: DataFrame, path_a: str, path_b: str, pattern: str, id: str = "doc_id", text: str = "text", keep_groups: bool = False
) -> DataFrame:
    """`doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256` for each row, and with
    `keep_groups` the groups themselves as `groups`: ids of A and B as text, `a1,a2|b1;a3|b2`.

    `path_a` is a JSON file of byte-level BPE, `path_b` a piece model; every executor has them. `pattern` is how A
    splits a text. `count_sum` adds, over the links of a text, how many links of all texts hold the same ids;
    `n_best` counts the links whose ids are the most frequent ones of their B id.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, block = coders(path_a, path_b, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            filled = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()) // BLOCK
            cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                part = batch.slice(start, stop - start)
                found, pairs, counts = aligned(own, part.column(1).to_pylist(), keep_groups)
                number = task << 32 | block
                block += 1
                # Only lists of places are kept small by what they differ by.
                data = [{**r, "block": number, "doc_id": i, "places": _packed(r["places"]), "times": _packed(r["times"])}
                        for i, r in zip(part.column(0).to_pylist(), found)]
                yield pa.RecordBatch.from_pylist([*data, {"block": number, "pairs": pairs, "counts": counts}], ROW)

    blocks = staged(rows.mapInArrow(run, ROW_KINDS), "aligned")
    listed = blocks.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x"))
    same = "partition by x.pairs"
    counted = listed.selectExpr(
        "block", "place", f"x.pairs & {(1 << SHIFT) - 1} as b", f"sum(x.counts) over ({same}) as c",
        f"block = min(block) over ({same}) as first",
    )
    counted = staged(counted, "pairs")
    # At most as many rows as B has ids.
    best = counted.where("first").groupBy("b").agg(F.max("c").alias("most"))
    judged = counted.join(F.broadcast(best), "b").select("block", "place", "c", (F.col("c") == F.col("most")).alias("best"))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "digest", *(["groups"] if keep_groups else [])]
    texts = blocks.where("places is not null").select("block", *kept, "places", "times")

    def summed(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs["place"].to_numpy()
        c, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        c[place], best[place] = pairs["c"].to_numpy(), pairs["best"].to_numpy()
        held = [(_unpacked(p), _unpacked(t)) for p, t in zip(docs["places"].to_pylist(), docs["times"].to_pylist())]
        n_best = pa.array([int((best[p] * t).sum()) for p, t in held], pa.int64())
        count_sum = pa.array([int((c[p] * t).sum()) for p, t in held], pa.int64())
        return docs.select(kept).append_column("n_best", n_best).append_column("count_sum", count_sum)

    kinds = ", ".join(f"{c} {'string' if c in ('digest', 'groups') else 'long'}" for c in kept) + ", n_best long, count_sum long"
    result = texts.groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(summed, kinds)
    return result.withColumnRenamed("digest", "groups_sha256")
