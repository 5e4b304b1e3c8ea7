"""Toxicity of texts: boosted trees over dense features, with isotonic calibration.

1. A bounded sample of labelled rows is drawn by a hash of the id (`SAMPLE` rows are expected, whatever
   the number of labels), so it and its texts stay small.
2. The lexicon is learned from these: words that toxic documents hold far more often than others.
3. Every whole text gives dense features: densities of the lexicon, plain and behind obfuscation, how
   near it stands to the second person, capitals, punctuation, stretched letters.
4. Boosted trees are fitted on the sample, calibrated by isotonic regression on scores of rows that
   the trees had not seen, and applied to every document.

Labels, language, source and id are no features.

Defined results: a null text is an empty one; empty texts have all features 0 and get a score like any
other. A document with several labels is toxic if one says so. Null labels and labels without a document
teach nothing. Without enough labels of both kinds every score is the share of toxic ones. Repeated rows
have equal results. Rows without an id are scored and not held out. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.boosting import CalibratedTrees
from lakestar.llm.common import slices, staged

#: Labelled rows that are learned from, about; words of the lexicon at most; documents a word is in.
SAMPLE, LEXICON, LEAST_DOCS = 20_000, 400, 4
#: Second person in the languages of the texts.
SECOND = frozenset(
    (
        "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen "
        "deiner ihr euch euer usted ustedes tú ti contigo vosotros vuestro"
    )
    .encode()
    .split()
)
#: Characters that stand for letters.
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
NEAR = 5
#: Bytes of text whose rows leave a task at a time.
SLICE = 1 << 20
FEATURES = [
    "words", "hits", "density", "weight", "strongest", "strong_density", "hidden", "hidden_density", "near_you",
    "you_density", "capitals", "shouted", "exclaims", "punctuation", "stretched", "digits",
]
PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum())
BLANKED = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
ODD = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[0-9@$!|*.\-_]\S)\S{3,40}(?!\S)")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
CAPITAL, DIGIT = re.compile(r"[A-Z]"), re.compile(r"[0-9]")
MARK, EXCLAIM = re.compile(r"[!-/:-@\[-`{-~]"), re.compile(r"!")


def split_words(text: str) -> list[bytes]:
    """Words in lower case; ASCII punctuation separates them."""
    return text.lower().encode().translate(BLANKED).split()


def plain_form(word: str) -> str:
    """A disguised word as letters: lookalikes replaced, signs between letters and stretching gone."""
    letters = re.sub(r"[\W_]+", "", word.lower().translate(LOOKALIKE))
    return re.sub(r"(.)\1\1+", r"\1", letters)


def features(text: str, lexicon: dict[bytes, float]) -> list[float]:
    words = split_words(text)
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    hits = [i for i, w in enumerate(words) if w in lexicon]
    weights = [lexicon[words[i]] for i in hits]
    hidden = [x for x in (plain_form(w).encode() for w in ODD.findall(text)) if x in lexicon]
    near = 0
    if hits:
        near = sum(1 for i in hits if not SECOND.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]))
    you = sum(1 for w in words if w in SECOND)
    return [
        math.log1p(n), float(len(hits)), len(hits) / n, float(sum(weights)), max(weights, default=0.0),
        sum(1 for w in weights if w > 2) / n, float(len(hidden)), len(hidden) / n, near / n, you / n,
        len(CAPITAL.findall(text)) / size, len(SHOUTED.findall(text)) / n, len(EXCLAIM.findall(text)) / size,
        len(MARK.findall(text)) / size, len(STRETCHED.findall(text)) / n, len(DIGIT.findall(text)) / size,
    ]


def with_features(docs: DataFrame, lexicon: dict[bytes, float], within: str | None = None) -> DataFrame:
    """`docs` with the column `_text` replaced by its features. With `within`, the text is that field of the
    column `row`, which stays, so that a text travels once."""
    last = "row" if within else "_text"
    rows = docs.select(*[c for c in docs.columns if c not in ("_text", last)], last)
    kept = rows.schema.fields if within else rows.schema.fields[:-1]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            texts = pc.struct_field(texts, within) if within else texts
            for low, high in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), SLICE):
                found = np.array([features(t.as_py() or "", lexicon) for t in texts.slice(low, high - low)], np.float64)
                columns = [c.slice(low, high - low) for c in batch.columns[: len(kept)]]
                columns += [pa.array(found[:, i]) for i in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[: len(kept)], *FEATURES])

    return rows.mapInArrow(run, f"{kinds}, " + ", ".join(f"{f} double" for f in FEATURES))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each text, disguised ones in plain form too."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set(split_words(text or "")) | {plain_form(w).encode() for w in ODD.findall(text or "")}
            kept = [w.decode() for w in found if 3 <= len(w) <= 40]
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(kept), pa.int32()), pa.array(kept, pa.string())], ["label", "word"])


def learn_lexicon(sample: DataFrame, most: int = LEXICON) -> dict[bytes, float]:
    """Words of (label, text) rows with the log of how much likelier toxic documents hold them."""
    sides = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sides.get(1, 0), sides.get(0, 0)
    counts = sample.select("label", "_text").mapInArrow(_words, "label int, word string").groupBy("word")
    counts = counts.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    ratio = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    counts = counts.where(F.col("a") >= LEAST_DOCS).withColumn("weight", ratio).where("weight > 1")
    best = counts.orderBy(F.desc(F.col("weight") * F.sqrt("a")), "word").limit(most)
    return {r["word"].encode(): r["weight"] for r in best.collect()}


def held_out(id: Column) -> Column:
    """Whether a label is kept for judging: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE, keep: bool = False,
) -> DataFrame:
    """`doc_id`, `held_out`, `score` (0 to 1) and `predicted` (1 from 0.5) for each row of `docs`.

    `sample` is how many labelled rows are learned from, about; labels of held-out rows never are.
    With `keep`, the result has the row itself too, as `row`.
    """
    row = [F.struct("*").alias("row")] if keep else []
    docs = docs.select(*row, F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    known = labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    rate = min(1.0, sample / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) < int(rate * (1 << 30))
    fold = F.pmod(F.xxhash64(F.lit(12), "id"), F.lit(2)).cast("int")
    known = known.where(drawn).withColumn("fold", fold)
    # The sample has a known size, so it may go to every task; of copies of a row one is enough.
    taught = staged(docs.select("id", "_text").join(F.broadcast(known), "id").dropDuplicates(["id"]), "labelled")
    lexicon = learn_lexicon(taught)
    trees = CalibratedTrees(FEATURES).fit(with_features(taught.select("label", "fold", "_text"), lexicon))
    within = text if keep and dict(docs.select("row.*").dtypes).get(text) == "string" else None
    scored = trees.score(with_features(docs, lexicon, within))
    return scored.select(
        *(["row"] if keep else []), F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
