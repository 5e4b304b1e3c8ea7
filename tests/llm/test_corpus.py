"""Token alignment, importance resampling and the hidden Markov model against brute force."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakestar.llm import align, importance, markov
from lakestar.llm.queries import QUERIES, SQL
from tests.conftest import rows
from tests.oracle import _rows, connect

FOLDER = "/root/testdata/sf0.01"
PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = "block long, doc_id long, text string, places string, times string, word string, rank string, score string"


def table(spark, data):
    return spark.createDataFrame([(7, i, t, "a", "b", "c", "d", "e") for i, t in data], ODD).repartition(3)


def test_importance_is_the_same_as_sql(spark):
    df, con = QUERIES["op12_importance_resampling"](spark, FOLDER), connect(FOLDER)
    cursor = con.execute(SQL["op12_importance_resampling"])
    names = [d[0] for d in cursor.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cursor.fetchall())


# --- alignment ---------------------------------------------------------------------------------


def align_brute(data):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(PATH_A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    vocabulary = {i: t for t, i in a_side.get_vocab().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def piece(i):
        p = b_side.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def ends(tokens):
        return list(itertools.accumulate(map(len, tokens)))

    texts, counts = [], collections.Counter()
    for ident, text in data:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        bytes_a, bytes_b = [bytes(byte[c] for c in vocabulary[i]) for i in a], [piece(i) for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            texts.append((ident, [], [], [], [], []))
            continue
        ea, eb = ends(bytes_a), ends(bytes_b)
        links, j = [], 0
        for i in range(len(a)):
            start = ea[i] - len(bytes_a[i])
            while eb[j] <= start:
                j += 1
            k = j
            while k < len(b) and eb[k] - len(bytes_b[k]) < ea[i]:
                links.append((a[i], b[k]))
                k += 1
        counts.update(links)
        texts.append((ident, a, b, ea, eb, links))
    best = {}
    for (_, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    out = []
    for ident, a, b, ea, eb, links in texts:
        cuts = sorted(set(ea) & set(eb))
        groups, low = [], 0
        for cut in cuts:
            sides = (",".join(str(x) for x, e in zip(side, ends_) if low < e <= cut) for side, ends_ in ((a, ea), (b, eb)))
            groups.append("|".join(sides))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((ident, len(a), len(b), len(cuts), len(links), n_best, sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


def sample_texts():
    rng = random.Random(4)
    kinds = ["plain words", "né", "straße", "Привет", "漢字", "🙂", "  ", "\n", "\t", "'ll", "1234", "<|endoftext|>", "<s>", "</s>",
             "\x00", "​", "\x1c", "▁", "ﬁ", "é", "a" * 40, "-—!?", "\U0001faf0"]
    data = [(1, None), (2, ""), (3, " "), (4, "x"), (5, "<|endoftext|>"), (6, " " * 1500 + "y" + "\n" * 1200), (7, "a\tb"), (None, "no id")]
    data += [(8, "same text here"), (8, "same text here"), (9, "same text here")]
    return data + [(100 + i, " ".join(rng.choice(kinds) for _ in range(rng.randint(1, 30)))) for i in range(150)]


@pytest.mark.parametrize("block", [1 << 22, 400])
def test_alignment(spark, monkeypatch, block):
    monkeypatch.setattr(align, "BLOCK", block)
    data = sample_texts()
    found = align.align(table(spark, data), PATH_A, PATH_B, public_tokenizers.PATTERN, keep_groups=True)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found, *columns) == align_brute(data)
    for groups, digest in rows(found, "groups", "groups_sha256"):
        assert digest == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_alignment_of_nothing(spark):
    assert align.align(table(spark, [(1, "a")]).where("false"), PATH_A, PATH_B, public_tokenizers.PATTERN).count() == 0


# --- importance --------------------------------------------------------------------------------


def importance_brute(data, target, n, buckets, percent, least, seed):
    def words(text):
        return importance.WORD.findall((text or "").encode().lower())

    def features(text):
        w = words(text)
        return [zlib.crc32(b" ".join(w[i : i + k])) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s = collections.Counter(b for _, t in data for b in features(t))
    t = collections.Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in data:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(words(text)), len(f), weight, score, None])
    fits = sorted((r for r in out if r[4] is not None and r[1] >= least), key=lambda r: (-r[4], r[0]))
    for rank, row in enumerate(fits[: percent * len(fits) // 100], 1):
        row[5] = rank
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_importance(spark, n):
    rng = random.Random(8)
    vocabulary = [f"{w}{x}" for w in ("Ab", "cd", "É", "9") for x in range(30)]
    gaps = [" ", " ", "\n", "\n\n", "-", ", ", "\r\n"]
    data = [(1, None), (2, ""), (3, "\n\n"), (4, "one"), (None, "ab1 cd2 ab1"), (5, "ab1\ncd2"), (5, "ab1\ncd2"), (6, "x " * 5000)]
    data += [(10 + i, "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(1, 40)))) for i in range(200)]
    data += [(300 + i, "shared line of all\n" + rng.choice(vocabulary)) for i in range(80)]
    target = ["ab1 cd2 ab3\nAB1", None, "É1 É2"]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id long")
    found = importance.resample(table(spark, data), frame, n, 500, 30, 2, 2024)
    assert rows(found, "doc_id", "n_words", "n_features", "weight", "score", "rank") == importance_brute(data, target, n, 500, 30, 2, 2024)


def test_importance_of_nothing(spark):
    frame = spark.createDataFrame([], "text string")
    assert importance.resample(table(spark, [(1, "a")]).where("false"), frame).count() == 0
    assert rows(importance.resample(table(spark, [(1, "a b")]), frame, least=1, percent=100), "doc_id", "rank") == [(1, 1)]


# --- hidden Markov model -----------------------------------------------------------------------


def small_model(states=3, seed=1):
    rng = np.random.default_rng(seed)
    emit = rng.random((markov.CLASSES, states)) * (np.arange(markov.CLASSES)[:, None] < 6)
    move = rng.random((states, states))
    start = rng.random(states)
    return markov.Model(start / start.sum(), move / move.sum(1)[:, None], emit / emit.sum(0))


def paths(model, text):
    """All state sequences with their probabilities."""
    for states in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[states[0]]
        for t, s in enumerate(states):
            p *= float(model.emit[text[t], s]) * (model.move[states[t - 1], s] if t else 1)
        yield states, p


def test_forward_recursion_is_the_sum_over_all_paths():
    model = small_model()
    texts = [np.array(t, np.int32) for t in ([0], [5, 1, 2], [3, 3, 3, 0, 1, 4], [2, 2])]
    expected = [math.log10(sum(p for _, p in paths(model, t))) for t in texts]
    assert np.allclose(model.log10(texts), expected, rtol=1e-6)
    assert len(model.log10([])) == 0


def test_expected_counts_are_those_of_all_paths():
    model = small_model(2, 5)
    texts = [np.array(t, np.int32) for t in ([0], [5, 1, 2, 2], [3, 3, 0, 1, 4])]
    emitted, moved, started = np.zeros((markov.CLASSES, 2)), np.zeros((2, 2)), np.zeros(2)
    for text in texts:
        total = sum(p for _, p in paths(model, text))
        for states, p in paths(model, text):
            started[states[0]] += p / total
            for t, s in enumerate(states):
                emitted[text[t], s] += p / total
                if t:
                    moved[states[t - 1], s] += p / total
    for a, b in zip(model.expected(texts), (emitted, moved, started)):
        assert np.allclose(a, b, atol=1e-4)


def test_long_texts_are_learned_from_whole():
    model = small_model()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 64, 65, 1000)]
    emitted, _, started = model.expected(texts)
    assert np.allclose(emitted[:6].sum(1), np.bincount(np.concatenate(texts)), rtol=1e-4) and np.isclose(started.sum(), 4, rtol=1e-4)


def markov_data():
    rng = random.Random(6)
    sides = [[f"{p}{i}" for i in range(40)] for p in ("u", "V")]
    data = [(1, None), (2, ""), (3, " \t\x0b\n"), (4, "One"), (None, "u1 u2 u3"), (5, "u1 u2"), (5, "u1 u2"), (6, "É é u1\xa0u2")]
    data += [(10 + i, " ".join(rng.choice(sides[i % 2]) for _ in range(rng.randint(1, 200)))) for i in range(300)]
    return data + [(1000, "u1 " * 30000)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_markov_scores(spark, monkeypatch, block):
    monkeypatch.setattr(markov, "BLOCK", block)
    data = markov_data()
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = markov.score_texts(table(spark, data), out, states=2, rounds=8)
    tokens = [(i, [*(t or "").encode().lower().split(), b" "]) for i, t in data]
    c = collections.Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    expected = sorted(((i, held(i), len(t), sum(w in c for w in t), n) for i, t in tokens), key=repr)
    assert rows(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens") == expected
    base = {i: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t) for i, t in tokens}
    scores = [tuple(r) for r in found.select("doc_id", "base_score", "score", "held_out", "n_tokens").collect()]
    assert all(abs(b - base[i]) < 1e-6 * max(1, abs(b)) for i, b, *_ in scores)
    assert all(s <= 0 for _, _, s, *_ in scores)
    # Texts have words of one side each, which two states can tell.
    gained = [(s - b) / m for i, b, s, h, m in scores if h and i is not None and i >= 10 and m > 50]
    assert len(gained) > 10 and min(gained) > 0.2


def test_known_tokens_and_the_unknown_one_add_up_to_one():
    totals, added = np.zeros(markov.CLASSES), np.zeros(markov.CLASSES)
    totals[[0, 5, markov.END]], added[[0, 5, markov.END]] = [10, 4, 3], [2, 1, 1]
    emit = markov._emissions(totals[:, None] * [0.3, 0.7], added, 0.1)
    assert np.allclose(emit.sum(0), 1) and np.allclose(emit[markov.UNKNOWN], 0.1)
    assert np.allclose(emit[0], 0.9 * 12 / 21)


def test_markov_without_rows_or_training(spark):
    frame = table(spark, [(1, "a b"), (2, None)])
    assert markov.score_texts(frame.where("false"), F.lit(False)).count() == 0
    found = markov.score_texts(frame, F.lit(True), rounds=1)
    assert rows(found, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score") == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert all(r[0] <= 0 for r in found.select("score").collect())
