"""Passages that repeat across documents, found exactly with super-k-mers, and their removal.

A window is 13 consecutive words of one document. A word goes if a window that covers it also starts
in a document with a smaller id; windows are judged on the input.

1. Documents are dealt into chunks of bounded size by their id. In a chunk, consecutive windows with
   the same minimiser (the smallest hash of four consecutive words in the window) travel as one
   packed string. Equal strings of a chunk travel once, with the smallest id that has them, so a
   passage that a third of all documents share is one string per chunk.
2. Strings go to buckets by minimiser; equal windows have equal minimisers and meet there. Buckets that
   would get more than `HEAVY_BYTES` by a count before are dealt window by window, by the hash of the
   whole window, so that a hot minimiser spreads and equal windows still meet. A bucket
   sorts its windows by hash, tells equal from colliding ones by their bytes, and answers each chunk
   with the windows that start in a smaller document elsewhere.
3. The chunk finds its strings again and removes what was answered, and what its own smaller
   documents have.

The shuffle of the texts is shared by the first and the last step.

Defined results: a null text has no words. Rows without an id keep all words and take none from
others. Rows that share an id are no reason to remove words from each other. Other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import LOW, Words, fold, slices

WINDOW, MINIMISER = 13, 4
#: Bytes of text of a chunk, and of packed strings of a bucket, about.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Bytes of texts or strings whose words are held at a time: these take some twenty times as much.
SLICE = 2 << 20
#: Bytes of packed strings from which a bucket is cut.
HEAVY_BYTES = 4 * BUCKET_BYTES


def _windows(words: Words, texts: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of the first texts start, and their minimisers."""
    starts = [np.arange(a, b - window + 1) for a, b in zip(words.bound[:texts].tolist(), words.bound[1:].tolist())]
    starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return starts, _sliding_least(fold(words.hash, MINIMISER), window - MINIMISER + 1)[starts]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str | None]]:
    """The texts of batches of any size, about `SLICE` bytes at a time."""
    for batch in batches:
        texts = batch.column(0)
        for low, high in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), SLICE):
            yield texts.slice(low, high - low).to_pylist()


def _weighed(window: int, buckets: int):
    """The bytes of the distinct strings of each slice of texts, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets)
        for texts in _texts(batches):
            words = Words(texts)
            starts, least = _windows(words, len(texts), window)
            if not len(starts):
                continue
            new = np.ones(len(starts), bool)
            new[1:] = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts)) - 1
            code = fold(words.hash, window)[starts[first]] + (last - first).astype(np.uint64)
            one = np.unique(code, return_index=True)[1]
            size = words.end[starts[last[one]] + window - 1] - words.start[starts[first[one]]]
            total += np.bincount((least[first[one]] % np.uint64(buckets)).astype(np.int64), size, buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some].astype(np.int64))], ["bucket", "bytes"])

    return run


class _Chunk:
    """The words of some documents, their super-k-mers, and the distinct strings of these."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray, window: int, buckets: int, heavy: dict[int, tuple[int, int]]):
        order = np.lexsort((np.arange(len(ids)), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))
        self.ids, texts = ids.take(pa.array(order)), texts.take(pa.array(order))
        self.words = words = Words(texts.to_pylist())
        self.length = words.end - words.start
        # All words with one space after each.
        raw = np.frombuffer(words.data, np.uint8)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        blank[words.end] = False
        self.joined = raw[~blank].copy()
        self.at = np.concatenate([[0], np.cumsum(self.length + 1)])
        self.joined[self.at[1:] - 1] = 32

        known = len(ids) - ids.null_count
        starts, least = _windows(words, known, window)
        bucket = (least % np.uint64(buckets)).astype(np.int64)
        hot = np.isin(bucket, list(heavy)) if heavy else np.zeros(len(starts), bool)
        if hot.any():
            codes = fold(words.hash, window)[starts]
            for b, (base, many) in heavy.items():
                here = hot & (bucket == b)
                bucket[here] = base + (codes[here] % np.uint64(many)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1])
        new |= hot
        new[1:] |= hot[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        #: Of each super-k-mer: its first word, the one after its last, its bucket, its document.
        self.begin, self.stop = starts[first], starts[last] + window if len(first) else starts[first]
        self.bucket = bucket[first]
        doc = np.searchsorted(words.bound, self.begin, "right") - 1
        self.doc = self.ids.fill_null(0).to_numpy()[doc] if len(doc) else doc
        found: dict[bytes, int] = {}
        whole = self.joined.tobytes()
        low, high = self.at[self.begin].tolist(), (self.at[self.stop] - 1).tolist()
        self.entry = np.fromiter(
            (found.setdefault(whole[a:b], len(found)) for a, b in zip(low, high)), np.int64, len(low)
        )
        self.strings = list(found)
        #: The first super-k-mer of each string; documents are in order, so it has the smallest id.
        self.first = np.zeros(len(found), np.int64)
        self.first[self.entry[::-1]] = np.arange(len(low))[::-1]


def _sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each `n` consecutive values."""
    span = 1
    while 2 * span <= n:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[: len(x) - (n - span)], x[n - span :])


def _packed(window: int, buckets: int, heavy: dict[int, tuple[int, int]]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        chunk = _Chunk(table.column("id"), table.column("text"), window, buckets, heavy)
        bucket = chunk.bucket[chunk.first]
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        zip_ = zstandard.ZstdCompressor(level=1)
        groups = [g for g in np.split(order, cuts) if len(g)]
        return pa.table(
            {
                "bucket": pa.array([bucket[g[0]] for g in groups], pa.int64()),
                "chunk": pa.array([key[0].as_py()] * len(groups), pa.int64()),
                "entries": pa.array([g.astype(np.int32).tobytes() for g in groups], pa.binary()),
                "docs": pa.array([chunk.doc[chunk.first[g]].tobytes() for g in groups], pa.binary()),
                "strings": pa.array(
                    [zip_.compress(b"\n".join([chunk.strings[i] for i in g])) for g in groups], pa.binary()
                ),
            }
        )

    return run


def _same_bytes(data: bytes, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes that start at places `x` and `y` of `data` are equal."""
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=data + bytes(8), strides=(1,))
    same = np.ones(len(x), bool)
    left = np.arange(len(x))
    at = 0
    while len(left):
        mask = LOW[np.minimum(size[left] - at, 8)]
        equal = (eight[x[left] + at] & mask) == (eight[y[left] + at] & mask)
        same[left[~equal]] = False
        at += 8
        left = left[equal & (size[left] > at)]
    return same


class _Bucket:
    """The windows of packed strings, in the order of the strings.

    Words are found in about `SLICE` bytes at a time and dropped again. Of each window its hash, its string, its
    place among the words of that, its first byte and its size stay: a string of few windows has many words.
    """

    def __init__(self, packed: list[bytes], window: int):
        unzip = zstandard.ZstdDecompressor()
        parts = [unzip.decompress(x) for x in packed]
        found, byte, line = [], 0, 0
        for low, high in slices(np.array([len(x) + 1 for x in parts]), SLICE):
            words = Words([b"\n".join(parts[low:high]).decode()])
            # A string ends where a line feed follows its last word.
            ends = np.flatnonzero(np.frombuffer(words.data, np.uint8)[words.end] == 10)
            many = np.diff(ends, prepend=-1) - window + 1
            of = np.repeat(np.arange(len(ends)), many)
            place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            starts = place + np.repeat(ends + 1 - many - window + 1, many)
            size = words.end[starts + window - 1] - words.start[starts]
            codes = fold(words.hash, window)[starts]
            found.append((codes, (of + line).astype(np.int32), place.astype(np.int32), words.start[starts] + byte, size.astype(np.int32)))
            byte, line = byte + len(words.data), line + len(ends)
        self.data = b"\n".join([*parts, b""])
        self.codes, self.of, self.place, self.begin, self.size = (np.concatenate(x) for x in zip(*found))


def _answers(window: int):
    """Of a bucket: for each chunk, the runs of windows of its strings that a smaller document has."""

    def run(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_numpy()
        entries = [np.frombuffer(x, np.int32) for x in table.column("entries").to_pylist()]
        owner = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
        entries = np.concatenate(entries)
        docs = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("docs").to_pylist()])
        own = _Bucket(table.column("strings").to_pylist(), window)
        of, begin, size = own.of, own.begin, own.size
        order = np.argsort(own.codes, kind="stable")
        head = np.ones(len(order), bool)
        head[1:] = own.codes[order[1:]] != own.codes[order[:-1]]
        group = np.cumsum(head) - 1
        again = np.flatnonzero(~head)
        lead, other = order[np.flatnonzero(head)][group[again]], order[again]
        differ = (size[lead] != size[other]) | ~_same_bytes(own.data, begin[lead], begin[other], size[other])
        if differ.any():  # equal hashes of different windows: tell all windows of these groups apart
            group = _regroup(own, order, group, np.unique(group[again[differ]]))
            again = np.argsort(group, kind="stable")
            order, group = order[again], group[again]
            head = np.concatenate([[True], np.diff(group) != 0])
        least = np.minimum.reduceat(docs[of[order]], np.flatnonzero(head))
        gone = np.zeros(len(order), bool)
        gone[order] = least[np.cumsum(head) - 1] < docs[of[order]]
        hit = np.flatnonzero(gone)
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])
        first = hit[new]
        last = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        string = of[first]
        out = np.stack([entries[string], own.place[first], own.place[last] + window], 1).astype(np.int32)
        cuts = np.flatnonzero(np.diff(owner[string])) + 1
        parts = [p for p in np.split(np.arange(len(first)), cuts) if len(p)]
        return pa.table(
            {
                "chunk": pa.array([chunks[owner[string[p[0]]]] for p in parts], pa.int64()),
                "spans": pa.array([out[p].tobytes() for p in parts], pa.binary()),
            }
        )

    return run


def _regroup(own: _Bucket, order: np.ndarray, group: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Numbers of groups, where those in `mixed` are split by the bytes of the windows."""
    group, free = group.copy(), int(group[-1]) + 1
    found: dict[tuple[int, bytes], int] = {}
    for i in np.flatnonzero(np.isin(group, mixed)).tolist():
        a = own.begin[order[i]]
        key = (int(group[i]), own.data[a : a + own.size[order[i]]])
        if key not in found:
            found[key], free = free, free + 1
        group[i] = found[key]
    return group


def _removed(window: int, buckets: int, heavy: dict[int, tuple[int, int]]):
    def run(key: tuple, docs: pa.Table, spans: pa.Table) -> pa.Table:
        chunk = _Chunk(docs.column("id"), docs.column("text"), window, buckets, heavy)
        words = chunk.words
        marks = np.zeros(len(words) + 1, np.int64)

        def mark(begin: np.ndarray, stop: np.ndarray) -> None:
            np.add.at(marks, begin, 1)
            np.add.at(marks, stop, -1)

        own = chunk.doc > chunk.doc[chunk.first][chunk.entry] if len(chunk.entry) else np.empty(0, bool)
        mark(chunk.begin[own], chunk.stop[own])
        found = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in spans.column("spans").to_pylist()]
        if found:
            found = np.concatenate(found).astype(np.int64)
            found = found[np.argsort(found[:, 0], kind="stable")]
            low = np.searchsorted(found[:, 0], chunk.entry, "left")
            many = np.searchsorted(found[:, 0], chunk.entry, "right") - low
            begin = np.repeat(chunk.begin, many)
            which = np.arange(len(begin)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            mark(begin + found[which, 1], begin + found[which, 2])
        kept = np.cumsum(marks[:-1]) == 0
        # The bytes of the kept words, one space after each but the last of a document.
        tail = np.zeros(len(words), bool)
        doc = np.searchsorted(words.bound, np.flatnonzero(kept), "right")
        tail[np.flatnonzero(kept)[np.flatnonzero(np.diff(doc, append=-1))]] = True
        take = np.repeat(kept, chunk.length + 1)
        take[chunk.at[1:][tail] - 1] = False
        size = np.concatenate([[0], np.cumsum(np.where(kept, chunk.length + 1 - tail, 0))])[words.bound]
        left = np.concatenate([[0], np.cumsum(kept)])[words.bound]
        total = np.diff(words.bound)
        return pa.table(
            {
                "doc_id": chunk.ids,
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(total - np.diff(left), pa.int64()),
                "kept": pa.StringArray.from_buffers(
                    len(total), pa.py_buffer(size.astype(np.int32)), pa.py_buffer(chunk.joined[take])
                ),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed` and the text `kept` (words joined by one space)."""
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = total // CHUNK_BYTES + 1, 3 * total // BUCKET_BYTES + 12
    chunk = F.pmod(F.xxhash64(F.coalesce("id", F.xxhash64("text"))), F.lit(chunks)).cast("long")
    weighed = docs.where("id is not null").select("text").mapInArrow(_weighed(window, buckets), "bucket long, bytes long")
    weighed = weighed.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > HEAVY_BYTES)
    # At most as many as HEAVY_BYTES fit into the packed strings. Cut into windows, a string is `window` times longer.
    heavy, free = {}, int(buckets)
    for r in sorted(weighed.collect()):
        many = window * r["bytes"] // BUCKET_BYTES + 2
        heavy[r["bucket"]], free = (free, many), free + many
    dealt = docs.withColumn("chunk", chunk)
    packed = dealt.groupBy("chunk").applyInArrow(
        _packed(window, buckets, heavy), "bucket long, chunk long, entries binary, docs binary, strings binary"
    )
    answers = packed.groupBy("bucket").applyInArrow(_answers(window), "chunk long, spans binary")
    return (
        dealt.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_removed(window, buckets, heavy), "doc_id long, n_words long, n_removed long, kept string")
    )
