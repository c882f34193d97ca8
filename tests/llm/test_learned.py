import random

import numpy as np
from pyspark.sql import functions as F

from loomgraph.llm import language, quality

EN = "the of and to in that it was for on with as his they at be this from have or by one had not".split()
FR = "le la les des et que dans pour une est pas sur qui avec son plus par mais cette vous nous ils leur".split()


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices((EN, FR)[i % 2], k=40)), ("en", "fr")[i % 2]) for i in range(n)]


def test_language(spark, none):
    extra = [(900, None, "en"), (901, "123 !", "fr"), (902, "\u4f60\u597d", None), (903, " ".join(EN * 3 + FR * 3), None), (None, "with that", None)]
    docs = spark.createDataFrame(texts(120) + extra, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("x"))
    model = language.fit(docs)
    got = {r["doc_id"]: r for r in language.identify(docs, model, spans=True).collect()}
    assert len(got) == 125 and all(got[i]["lang_pred"] == k for i, _, k in texts(120))
    assert (got[900]["lang_pred"], got[901]["lang_pred"], got[900]["score"]) == ("und", "und", 0.0)
    assert got[902]["lang_pred"] in ("en", "fr") and not got[902]["known"]
    assert [s["lang"] for s in got[903]["spans"]] == ["en", "fr"] and 0.3 < got[903]["score"] < 0.7
    kept = language.keep_known_language(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {900, 901, 902}
    assert language.identify(none, language.fit(none)).count() == 0


def test_only_learned_languages_stay(spark):
    """A word of a learned script doesn't save a text in another, nor do letters that spell nothing."""
    rng = random.Random(4)
    noise = " ".join("".join(rng.choices("bcdfgjkpqvwxyz", k=7)) for _ in range(60))
    cyrillic = "\u043f\u0440\u0438\u0432\u0435\u0442 " * 500
    gone = {800: "\u4f60\u597d" * 2000 + " the", 801: cyrillic + "with http that", 802: noise, 803: noise + " " + " ".join(EN)}
    stay = {810: "the \u4f60\u597d of", 811: " ".join(EN * 4) + " " + noise[:80], 812: " ".join(x for pair in zip(EN, FR) for x in pair)}
    rows = texts(240) + [(i, t, None) for i, t in {**gone, **stay}.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language.keep_known_language(docs).collect()}
    assert kept == {i for i, _, _ in rows} - gone.keys()


def test_labels_are_the_best_path():
    """The test for one language a text gives what a walk of every text gives."""
    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(0, 30, 5)
        s = -rng.random((sizes.sum(), 3)) * rng.choice([1, 8], (sizes.sum(), 1))
        words = language.Words(None, None, None, np.repeat(np.arange(5), sizes), None)
        label, first = language.label_texts(words, s, 5, 6.0)
        for i in range(5):
            own = s[first[i] : first[i + 1]]
            if len(own):
                value = lambda p: own[np.arange(len(p)), p].sum() - 6.0 * (np.diff(p) != 0).sum()  # noqa: E731, B023
                assert abs(value(label[first[i] : first[i + 1]]) - value(language.viterbi(own, 6.0))) < 1e-9


def test_two_runs_pay_together():
    """Two adjacent runs cost one switch: neither gains it alone, both together do."""
    s = np.array([[0, -8, -3.9], [0, -8, -3.9], [-8, 0, -3.9], [-8, 0, -3.9]])
    label, _ = language.label_texts(language.Words(None, None, None, np.zeros(4, int), None), s, 1)
    assert label.tolist() == [0, 0, 1, 1]


def test_quality(spark, none):
    rng = random.Random(3)
    rows, grades = [], []
    for i in range(400):
        g = i % 3
        words = rng.choices(EN + FR, k=30) + ({0: ["vile", "nasty"], 1: ["%%%", "###"] * 4, 2: []}[g])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        grades.append((i, g))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "the vile")], "doc_id long, text string").withColumn("grade", F.lit(9))
    rated = spark.createDataFrame([*grades[:300], (5000, 1), (None, 2), (7, None)], "doc_id long, grade int")
    model = quality.fit(docs, rated)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in quality.rate(docs, model).collect()}
    assert len(got) == 403
    assert np.mean([got[i]["grade_pred"] == g for i, g in grades[300:]]) > 0.9
    assert all(0 <= r["tail_probability"] <= r["clean_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got.values())
    assert quality.rate(none, quality.fit(none, rated.limit(0))).count() == 0
