import random

import pytest

KINDS = "doc_id long, text string, id string, key string, ids string, spans string, score string, n string"


def passage(seed, n, words=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: nulls, empty and very long ones, copies, near copies and shared passages."""
    base, shared = passage(1, 120), passage(2, 30)
    rows = [(1, base), (2, base), (3, base.upper()), (4, base.replace("w1", "v1", 3)), (5, None), (6, ""), (7, " \t\n ")]
    rows += [(8, "one two"), (9, "One  two"), (10, "a\x0bb\x0cc"), (None, base), (None, None), (11, passage(3, 20000))]
    rows += [(100 + i, passage(50 + i, 40) + " " + shared + "\n" + passage(90 + i, 20)) for i in range(20)]
    # A chain: neighbours are alike, the ends are not.
    chain = passage(7, 200).split()
    rows += [(200 + i, " ".join(chain[12 * i : 12 * i + 120])) for i in range(6)]
    rows += [(1, base), (8, "one two"), (300, "x " * 50)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts, with further columns whose names operators use themselves."""
    rows = [(i, t, "a", "b", "c", "d", "e", "f") for i, t in texts]
    return spark.createDataFrame(rows, KINDS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], KINDS)
