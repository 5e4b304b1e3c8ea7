"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each match of the split pattern is encoded separately. Its bytes form a linked list; a pair of
neighbours that the vocabulary can merge is queued under the rank of the merged token. The queue
keeps one bucket per rank and two levels of bitmaps over the ranks: find-first-set on the upper and
then on the lower level gives the smallest rank that has a bucket. A bucket holds positions, the
leftmost first; a position whose pair has changed meanwhile is stale and skipped. Every merge queues
two pairs at most, so a match of n bytes takes O(n log n) at worst, however long it is.

Defined results: a null text encodes as an empty one, which has no ids. Text that looks like a
special token is ordinary text. Rows are independent, so repeated rows have equal results.
Other columns of the input are kept.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cached_property
from heapq import heappop, heappush
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import slices

#: A word of the lower bitmap has 2 ** WIDTH bits.
WIDTH = 8
MASK = (1 << WIDTH) - 1
BIT = [1 << i for i in range(1 << WIDTH)]
#: Bytes of text whose new matches share one queue, and bytes whose ids are held at a time.
GROUP, SLICE = 4 << 20, 1 << 20
#: Matches from which a task's memory of them is renewed before the next group, and the characters of the longest one.
REMEMBERED, SHORT = 1 << 17, 64

#: The ids of distinct parts in a row, and the bounds between parts.
Parts = tuple[np.ndarray, np.ndarray]


class Codec:
    """A vocabulary of byte strings with ranks, which are the ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            parts = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in parts}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # White space is what Unicode calls so; the library also counts four control characters.
        space = r"\t\n\v\f\r\x20\x85\xa0  -     　"
        pattern = pattern.replace(r"[^\s", f"[^{space}").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")
        self.find = regex.compile(pattern, regex.V0).findall
        self.gap = re.compile(r" \s").search
        self.known: dict[str, tuple[int, ...]] = {}

    # What only encoding needs is built when it is first asked for.

    @cached_property
    def single(self) -> list[int]:
        return [self.ranks[bytes([b])] for b in range(256)]

    @cached_property
    def first_ids(self) -> np.ndarray:
        return np.array(self.single, np.int64)

    @cached_property
    def merged(self) -> dict[int, int]:
        """The id of every pair of ids that is a token together."""
        return {
            self.ranks[token[:i]] << 32 | self.ranks[token[i:]]: rank
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        }

    @cached_property
    def pairs(self) -> np.ndarray:
        return np.array(sorted(self.merged), np.int64)

    @cached_property
    def pair_ranks(self) -> np.ndarray:
        return np.array([self.merged[p] for p in self.pairs.tolist()], np.int64)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one match."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        merged = self.merged.get
        n = len(piece)
        ids = [*map(self.single.__getitem__, piece), -1]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The queue: a bucket of positions per rank, and two levels of bits over the ranks.
        buckets: dict[int, list[int]] = {}
        lower: dict[int, int] = {}
        upper = 0
        fresh = [(merged(a << 32 | b), i) for i, (a, b) in enumerate(zip(ids, ids[1:n]))]
        while True:
            for rank, i in fresh:
                if rank is None:
                    continue
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    word = rank >> WIDTH
                    if word in lower:
                        lower[word] |= BIT[rank & MASK]
                    else:
                        lower[word] = BIT[rank & MASK]
                        upper |= 1 << word
            if not upper:
                break
            # Find-first-set on either level: the smallest rank, and its leftmost position.
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = word << WIDTH | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                bits &= bits - 1
                if bits:
                    lower[word] = bits
                else:
                    del lower[word]
                    upper &= upper - 1
            left, j = ids[i], after[i]
            fresh = ()
            if left < 0 or j == n or merged(left << 32 | ids[j]) != rank:
                continue  # stale
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                if h >= 0:
                    fresh = ((merged(rank << 32 | ids[k]), i), (merged(ids[h] << 32 | rank), h))
                else:
                    fresh = ((merged(rank << 32 | ids[k]), i),)
            elif h >= 0:
                fresh = ((merged(ids[h] << 32 | rank), h),)
        return tuple([x for x in ids if x >= 0])

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of many matches, by one queue over all of them.

        The matches lie in one linked list with gaps between them. A round takes the smallest rank from
        the bitmaps and merges, in each match, its leftmost position in that bucket; further ones wait
        in the bucket, as a merge may queue a smaller rank first. So each match is merged in the order
        that it would be merged in alone.
        """
        sizes = np.array([len(p) for p in pieces])
        ids = self.first_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        after, before = (np.arange(x, len(ids) + x, dtype=np.int32) for x in (1, -1))
        ends = np.cumsum(sizes)
        after[ends - 1], before[ends - sizes] = -1, -1
        upper, lower, buckets = 0, {}, {}

        def rank_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            key = ids[a] << 32 | ids[b]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

        def push(ranks: np.ndarray, positions: np.ndarray) -> None:
            nonlocal upper
            good = ranks >= 0
            ranks, positions = ranks[good], positions[good]
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for rank, start, stop in zip(ranks[cuts[:-1]].tolist() if len(ranks) else (), cuts, cuts[1:]):
                if rank in buckets:
                    buckets[rank].append(positions[start:stop])
                else:
                    buckets[rank] = [positions[start:stop]]
                    word = rank >> WIDTH
                    lower[word] = lower.get(word, 0) | BIT[rank & MASK]
                    upper |= 1 << word

        first = np.flatnonzero(after >= 0)
        push(rank_of(first, after[first]), first)
        while upper:
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = word << WIDTH | (bits & -bits).bit_length() - 1
            lower[word] = bits = bits & (bits - 1)
            if not bits:
                upper &= upper - 1
            held = buckets.pop(rank)
            i = np.unique(np.concatenate(held)) if len(held) > 1 else np.sort(held[0])
            i = i[(ids[i] >= 0) & (after[i] >= 0)]
            i = i[rank_of(i, after[i]) == rank]  # the others are stale
            if not len(i):
                continue
            lead = np.ones(len(i), bool)
            lead[1:] = owner[i[1:]] != owner[i[:-1]]
            wait, i = i[~lead], i[lead]
            j = after[i]
            k, h = after[j], before[i]
            ids[i], ids[j], after[i] = rank, -1, k
            right, left = k >= 0, h >= 0
            before[k[right]] = i[right]
            a = np.concatenate([i[right], h[left]])
            ranks = rank_of(a, np.concatenate([k[right], i[left]]))
            if len(wait):
                a, ranks = np.concatenate([a, wait]), np.concatenate([ranks, np.full(len(wait), rank)])
            push(ranks, a)
        alive = ids >= 0
        found, counts = ids[alive].tolist(), np.bincount(owner[alive], minlength=len(pieces))
        cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
        return [tuple(found[a:b]) for a, b in zip(cuts, cuts[1:])]

    def odd(self, text: str) -> bool:
        """Whether a space of a text has white space behind it, or ends the text and has some before it."""
        return text[-1:] == " " and text[-2:-1].isspace() or self.gap(text) is not None

    def cut(self, part: str) -> Sequence[str]:
        """The matches in a space and what follows it up to the next one."""
        if part.isalpha():
            return (" " + part,)
        if part[:-1].isalpha():  # what follows letters is a match of its own
            return (" " + part[:-1], part[-1])
        return self.find(" " + part)

    def remember(self, pieces: set[str]) -> None:
        """Encodes matches that are not remembered, together."""
        new = [p for p in pieces if p not in self.known and len(p) <= SHORT]
        whole = [(p, self.ranks.get(p.encode())) for p in new]
        self.known.update((p, (rank,)) for p, rank in whole if rank is not None)
        new = [p for p, rank in whole if rank is None]
        if new:
            self.known.update(zip(new, self.merge_all([p.encode() for p in new])))

    def forget(self) -> None:
        """Drops all remembered matches. Workers outlive their tasks, and other stages use them next."""
        self.known = {}

    def prepare(self, texts: list[str]) -> tuple[list[np.ndarray], Parts]:
        """The texts as numbers of their distinct parts, and the ids of these parts.

        A space before something else than white space starts a match, whatever is left of it, if
        no white space is there. So the parts between single spaces are encoded one by one, each distinct one
        once; a part of letters only is one match, and only other parts are searched for the pattern. The
        first part of a text has no space before it. Texts with other white space around spaces are one part.
        """
        if len(self.known) >= REMEMBERED:
            self.forget()
        # Parts with a space before them are strings, others are tuples.
        number: defaultdict[str | tuple[str], int] = defaultdict()
        number.default_factory = number.__len__
        numbers = []
        for text in texts:
            parts = [text] if self.odd(text) else text.split(" ")
            parts[0] = (parts[0],)
            numbers.append(np.fromiter(map(number.__getitem__, parts), np.int32, len(parts)))
        cuts = [self.cut(part) if type(part) is str else self.find(part[0]) for part in number]
        self.remember(set(chain.from_iterable(cuts)))
        ids, ends, known = array("i"), array("q", [0]), self.known.get
        for found in cuts:
            for piece in found:
                ids.extend(known(piece) or self.merge(piece.encode()))
            ends.append(len(ids))
        return numbers, (np.array(ids, np.int32), np.array(ends, np.int64))

    def encode_all(self, numbers: list[np.ndarray], parts: Parts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several prepared texts in a row, and the bounds between texts."""
        ids, ends = parts
        held = np.concatenate(numbers)
        sizes = np.diff(ends)[held]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(stops[-1]) + np.repeat(ends[held] - stops[:-1], sizes)
        return ids[places], stops[np.concatenate([[0], np.cumsum([len(x) for x in numbers])])]

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return self.encode_all(*self.prepare([text]))[0].tolist()

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and by id where a token starts and how long it is; -1 is no id."""
        places = np.zeros((2, max(self.tokens) + 1), np.int32)
        places[1] = -1
        listed = list(self.tokens.items())
        sizes = np.array([len(t) for _, t in listed])
        ids = [i for i, _ in listed]
        places[0, ids], places[1, ids] = np.cumsum(sizes) - sizes, sizes
        return np.frombuffer(b"".join(t for _, t in listed), np.uint8), places[0], places[1]

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The bytes of several lists of ids, which lie in a row with `bounds` between them."""
        data, start, size = self.flat
        if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or size[ids].min() < 0):
            raise ValueError("an id that is not in the vocabulary")
        sizes = size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        out = np.empty(ends[-1], np.uint8)
        # In steps, as places take more room than bytes.
        step = SLICE
        for at in range(0, len(ids), step):
            part = sizes[at : at + step]
            low, high = ends[at], ends[min(at + step, len(ids))]
            place = np.arange(high - low, dtype=np.int32) + np.repeat((start[ids[at : at + step]] - (ends[at : at + len(part)] - low)).astype(np.int32), part)
            out[low:high] = data[place]
        offsets = pa.array(ends[bounds], pa.int64())
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets.buffers()[1], pa.py_buffer(out)])


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary, built once per Python worker: the code of this module comes with each
    task, so what outlives a task is kept in a module of its own."""
    kept = sys.modules.setdefault("lakestar_codecs", ModuleType("lakestar_codecs")).__dict__
    if (path, pattern) not in kept:
        kept[path, pattern] = Codec(path, pattern)
    return kept[path, pattern]


def _kinds(rows: DataFrame) -> str:
    """The columns of `rows` but the last, each followed by a comma."""
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """`docs` (any columns) with `ids`, an array of int, and if wanted `decoded`, the bytes that these ids decode
    to, worked out from the ids alone by the same worker. `path` is the vocabulary's rank file, which every executor
    has. Columns of `docs` with the names of new ones are left out of the result."""
    added = ["ids", *(["decoded"] if decoded else [])]
    rows = docs.select(*[c for c in docs.columns if c.lower() not in added], F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        try:
            for batch in batches:
                texts, others = batch.column(batch.num_columns - 1), batch.columns[:-1]
                names = [*batch.schema.names[:-1], *added]
                size = pc.binary_length(texts).to_numpy()
                for low, high in slices(size, GROUP):
                    numbers, parts = own.prepare(texts.slice(low, high - low).to_pylist())
                    for start, stop in slices(size[low:high], SLICE):
                        ids, bounds = own.encode_all(numbers[start:stop], parts)
                        columns = [c.slice(low + start, stop - start) for c in others]
                        columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)))
                        if decoded:
                            columns.append(own.decode_all(ids, bounds).cast(pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            own.forget()

    return rows.mapInArrow(run, f"{_kinds(rows)}ids array<int>" + (", decoded binary" if decoded else ""))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """`rows` with `decoded`, the bytes of the ids; null for null. A column of that name is left out."""
    kept = rows.select(*[c for c in rows.columns if c.lower() != "decoded"], F.col(ids).alias("_decoded_from"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            for start, stop in slices(size, SLICE):
                part = lists.slice(start, stop - start)
                bounds = np.concatenate([[0], np.cumsum(size[start:stop])])
                found = own.decode_all(part.flatten().to_numpy(), bounds).cast(pa.binary())
                found = pc.if_else(pc.is_valid(part), found, pa.scalar(None, pa.binary()))
                columns = [c.slice(start, stop - start) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, found], [*batch.schema.names[:-1], "decoded"])

    return kept.mapInArrow(run, f"{_kinds(kept)}decoded binary")
