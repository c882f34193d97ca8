import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of documents that clash with names the operators use inside.
CLASHES = {"node": 1, "key": "k", "comp": 2, "_t": "x", "size": 3, "text_sha256": "y", "_keep_id": 4, "_id": 5, "_gone": 6, "_size": 7, "_copies": 8, "_src": "z", "_h": 9, "_v": 10, "stays": 11, "lost": 12, "d": 13}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and long texts, ties and repeated rows, and clashing extra columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i}" for i in range(30_000))
    texts = ["Hello big World again", "hello big world AGAIN", None, "", "   \n\t", long, long + " end", "one", "ONE", "\u00c9t\u00e9 b\u00f6se \U0001f600", "a\x0bb c"]
    rows = [(i, t, ["en", None, "fr"][i % 3], [None, "s2", "s1"][i % 3], 0) for i, t in enumerate(texts)]
    rows += [rows[0], (None, "null id", "en", "s1", 0), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASHES.items()})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def near(spark):
    """Families of near copies, exact copies, a shared passage and texts of their own."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "x")]
    word = lambda: rng.choice(vocabulary)
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rng.randrange(60, 160))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[rng.randrange(8) :]
            texts.append(" ".join(copy))
    texts += [" ".join([word() for _ in range(80)] + passage) for _ in range(25)]
    texts += rng.choices(texts, k=20) + ["a b", "A  b", "x", "", None]
    return spark.createDataFrame([(i * 3 + 1, t, "en", f"s{i % 4}", 0) for i, t in enumerate(texts)], SCHEMA)
