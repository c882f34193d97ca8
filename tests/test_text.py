import pytest
from pyspark.sql import functions as F

from loomgraph.functions import spans, stats, text


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("t, want", [("a\r\nb\tc|d é", "a b c/d "), ("", ""), ("plain", "plain")])
def test_clean_input(spark, t, want):
    assert one(spark, text.clean_input("t"), t=t) == want


def test_long_words_are_cut_only_when_there_are_any(spark):
    assert one(spark, text.cut_long_words("t"), t="ab, cd") == "ab, cd"
    assert one(spark, text.cut_long_words("t"), t="x" * 60 + ", y") == "x" * 50 + " , y"


@pytest.mark.parametrize("t", ["", "a", "IL-2 (p53)!  x", "a\nb", "..."])
def test_pieces_are_lossless(spark, t):
    assert "".join(one(spark, text.pieces("t"), t=t)) == t
    spans_ = one(spark, text.token_spans("t"), t=t)
    assert all(t[s["start"] : s["end"] + 1] == s["tok"] for s in spans_)


def test_token_spans_of_a_long_text(spark):
    t = "word-7 " * 300
    found = one(spark, text.token_spans("t", 5), t=t)
    assert len(found) == 900 and all(t[s["start"] - 5 : s["end"] - 4] == s["tok"] for s in found)


@pytest.mark.parametrize(
    "t, want",
    [("One. Two? three! Four.", ["One.", " Two?", " three!", " Four."]), ("e.g. this. That", ["e.g. this.", " That"]),
     ("Hi! a", ["Hi!", " a"]), ("Hi!a", ["Hi!a"]), ("Why?", ["Why?"]), ("", [""])],
)
def test_split_sentences(spark, t, want):
    assert one(spark, text.split_sentences("t"), t=t) == want


def test_sentence_spans_merge_lower_case_and_leave_blanks_out(spark):
    got = one(spark, text.sentence_spans("t"), t="Is it? yes. No!  ")
    assert [(s["sent_no"], s["start"], s["end"]) for s in got] == [(1, 0, 11), (2, 12, 15)]


def test_cut_sentence(spark):
    t = " ".join(["w"] * 350)
    parts = one(spark, text.cut_sentence(F.col("t")), t=t)
    assert "".join(parts) == t and [len(p.split()) for p in parts] == [100, 100, 100, 50]
    assert one(spark, text.cut_sentence(F.col("t")), t="short one") == ["short one"]


def test_occurrences(spark):
    got = one(spark, text.occurrences(F.col("t"), F.col("s")), t="ab abc ab.ab", s="ab")
    assert [(o["start"], o["end"]) for o in got] == [(0, 2), (7, 9), (10, 12)]
    assert one(spark, text.occurrences(F.col("t"), F.col("s")), t="xyz", s="ab") == []


def test_keys_and_attributes(spark):
    assert one(spark, text.chemical_key("t"), t="N-(2) Acetyl'X") == "n2acetylx"
    assert one(spark, text.basic_key("t"), t="  A--b , C ") == "a b c"
    assert one(spark, text.variant_attributes("t"), t="tmVar:p|SUB|A|1|B;CorrespondingGene:12;CorrespondingGene:13") == {"tmVar": "p|SUB|A|1|B", "CorrespondingGene": "12"}
    assert one(spark, text.tighten_brackets(F.col("c"), F.col("l")), c="the (x) form", l="the ( x ) form") == "the (x) form"


@pytest.mark.parametrize("tags, want", [("OBIOB", [(1, 2), (4, 4)]), ("IIB", [(2, 2)]), ("BB", [(0, 0), (1, 1)]), ("", []), ("BII", [(0, 2)])])
def test_bio_spans(spark, tags, want):
    row = spark.createDataFrame([(list(tags),)], "t array<string>")
    assert [(s["first"], s["last"]) for s in row.select(spans.bio_spans(F.col("t")).alias("x")).first()["x"]] == want


def test_spans_to_bio_tags_the_first_token_of_a_document_b(spark):
    row = spark.createDataFrame([("aa bb cc dd", [(0, 5), (9, 11)])], "t string, s array<struct<start:int,end:int>>")
    assert row.select(spans.spans_to_bio(text.words_with_spans("t"), F.col("s")).alias("x")).first()["x"] == ["B", "I", "O", "B"]


def test_fisher_is_symmetric_and_known(spark):
    rows = spark.createDataFrame([(3, 1, 1, 3), (10, 2, 3, 265), (1, 0, 0, 9), (5, 5, 5, 5)], "a long, b long, c long, d long")
    c = [F.col(x) for x in "abcd"]
    got = rows.select(stats.fisher_two_sided(*c).alias("p"), stats.fisher_two_sided(c[0], c[2], c[1], c[3]).alias("q")).collect()
    assert [round(r["p"], 6) for r in got][0] == 0.485714 and round(got[2]["p"], 6) == 0.1 and got[3]["p"] == 1
    assert all(abs(r["p"] - r["q"]) < 1e-12 for r in got)
