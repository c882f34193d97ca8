import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.operators import cooccur, evaluate, normalise, tagger
from loomgraph.sources import literature


def test_tagger_windows_and_decoding(spark):
    """A sentence of more pieces than a window is put together again; pieces behind a word's first don't count."""
    title = "Short title with aspirin"
    abstract = " ".join(f"w{i} filler" for i in range(90)) + " ends in glioblastoma multiforme. Next aspirin here."
    docs = cooccur.with_sentences(spark.createDataFrame([("1", title, abstract), ("2", "", "aspirin"), ("3", "Nothing", "")], "pmid string, title string, abstract string"))
    terms = {"aspirin": "chemical", "glioblastoma": "disease"}
    halves = lambda w: [w[:4], w[4:]] if len(w) > 4 else [w]
    for cut, window in ((lambda w: [w], 128), (halves, 16), (halves, 128)):
        found = tagger.tag(docs, ("disease", "chemical"), tagger.dictionary_scorer(("disease", "chemical"), terms), cut, window).collect()
        contents = {r["pmid"]: r["content"] for r in docs.collect()}
        want = {(p, k, m.start(), m.end()) for p, c in contents.items() for w, k in terms.items() for m in __import__("re").finditer(w, c)}
        assert {(r["pmid"], r["entity_type"], r["start"], r["end"]) for r in found} == want and len(want) == 4
        assert all(contents[r["pmid"]][r["start"] : r["end"]] == r["mention"] and r["prob"] == pytest.approx(np.exp(4) / (np.exp(4) + 2)) for r in found)


def test_decoded_spans():
    one = np.eye(3) * 5
    assert [s[:2] for s in tagger.decoded(one[[2, 1, 2, 0, 1, 1, 2]])] == [(1, 2), (4, 4), (5, 6)]
    assert tagger.decoded(np.zeros((0, 3))) == []


def test_nearest_names_by_type(spark, tmp_path):
    """Missing ids are those of the nearest name of the type; tools' ids and found ones stay."""
    names = [("disease", "D1", "lung cancer"), ("disease", "D2", "breast cancer"), ("chemical", "C1", "lung cancers"), ("disease", "D9", "x " * 30)]
    dictionary = spark.createDataFrame([(t, i, 0, n, k) for k, (t, i, n) in enumerate(names)], "entity_type string, id string, name_rank int, name string, line_no int")
    rows = [("1", "disease", "Lung Cancer", None), ("1", "disease", "lung cancerr", None), ("1", "chemical", "lung cancer", None), ("2", "gene", "x", ""), ("2", "disease", "", None), ("3", "food", "bread", None)]
    mentions = spark.createDataFrame(rows, "pmid string, entity_type string, mention string, id string")
    found = {(r["entity_type"], r["mention"]): (r["id"], r["is_neural_normalized"]) for r in normalise.normalise(mentions, dictionary).collect()}
    assert found[("disease", "Lung Cancer")] == ("D1", False) and found[("disease", "lung cancerr")] == ("D1", True)
    assert found[("chemical", "lung cancer")] == ("C1", True) and found[("gene", "x")] == ("", False) and found[("food", "bread")] == (None, False)
    exact = {(r["entity_type"], r["mention"]): r["id"] for r in normalise.normalise(mentions, dictionary, {"disease": ("dictionary",)}).collect()}
    assert exact[("disease", "lung cancerr")] is None and exact[("chemical", "lung cancer")] == "C1"


def test_index_of_cells_finds_most_of_the_nearest(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    names = spark.createDataFrame(rows, "nid long, embedding array<double>")
    asked = names.where("nid % 20 = 0").withColumnRenamed("nid", "qid")
    best = {r["qid"]: r["nid"] for r in normalise.nearest(asked, names).collect()}
    normalise.write_index(names, str(tmp_path / "index"), 6)
    held, centres = normalise.read_index(spark, str(tmp_path / "index"))
    for found in (normalise.nearest(asked, held, probes=4, centres=centres), normalise.nearest(asked, names, cells=6, probes=6)):
        assert np.mean([best[r["qid"]] == r["nid"] for r in found.collect()]) >= 0.9


def test_name_evaluation(spark, tmp_path):
    asked = spark.createDataFrame([(1, 1, 10, "a", "X|Y"), (1, 2, 11, "b", "Z"), (2, 1, 12, "c", "Q")], "query int, mention_no int, qid int, mention string, golden string")
    names = spark.createDataFrame([(1, "Y", "n1"), (2, "Z", "n2"), (3, "W", "n3")], "nid int, cui string, name string")
    sparse = spark.createDataFrame([(10, 1, 0.2), (10, 3, 0.9), (11, 2, 0.5), (12, 3, 0.1)], "qid int, nid int, score double")
    dense = spark.createDataFrame([(10, 1, 0.9), (11, 3, 0.1)], "qid int, nid int, score double")
    scores = evaluate.hybrid_scores(sparse, dense, 1.0)
    assert {(r["qid"], r["nid"]): round(r["score"], 6) for r in scores.collect()}[(10, 1)] == 1.1
    found = evaluate.predictions(asked, evaluate.top_candidates(scores, names, 2))
    assert {k: round(v, 6) for k, v in evaluate.accuracies(found, 2).first().asDict().items()} == {"acc1": 0.5, "acc2": 0.5}
    evaluate.write_predictions(found, str(tmp_path / "p"))
    first = next(r for r in (json.loads(x["value"]) for x in spark.read.text(str(tmp_path / "p")).collect()) if r["query"] == 1)
    assert [m["mention"] for m in first["mentions"]] == ["a", "b"] and first["mentions"][0]["candidates"][0] == {"rank": 1, "name": "n1", "cui": "Y", "label": 1}
    one = lambda f, g, i: spark.range(1).select(f(F.lit(g), F.lit(i)).alias("x")).first()["x"]
    assert one(evaluate.shares_id, "A+B", "B|C") and not one(evaluate.shares_id, "A", "B") and one(evaluate.covers_ids, "A|B", "B+A") and not one(evaluate.covers_ids, "A|C", "A")


def test_span_table_and_metrics(spark, tmp_path):
    ddl = "corpus string, entity_type string, pmid string, start int, end int"
    golds = spark.createDataFrame([("c", "d", "1", 0, 3), ("c", "d", "1", 5, 8)], ddl)
    found = golds.limit(1).withColumn("system", F.lit("s")).unionByName(spark.createDataFrame([("c", "d", "1", 6, 8)], ddl).withColumn("system", F.lit("s")))
    row = evaluate.score_table(golds, found).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.5, 0.5, 0.5)
    evaluate.write_metrics(evaluate.score_table(golds, found).select("f1", "recall"), str(tmp_path / "m"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "m")).collect() if r["value"]] == ["f1 = 0.5", "recall = 0.5"]


def test_more_readers(spark, tmp_path):
    block = "7|t|BRAF V600E found\n7|a|It is\n7\t5\t10\tV600E\tProteinMutation\tp|SUB|V|600|E\n7\t0\t4\tBRAF\tGene\n"
    (tmp_path / "crlf.txt").write_bytes((block + "\n8|t|Two\n8|a|- No text -\n").replace("\n", "\r\n").encode())
    blocks = literature.read_blocks(spark, str(tmp_path / "crlf.txt"))
    assert [r["pmid"] for r in literature.parse_documents(blocks).orderBy("pmid").collect()] == ["7", "8"]
    docs, variants = literature.variants_of_text(spark.createDataFrame([(block + "\n\n" + "9|t|x\n9|a|y",)], "value string"))
    assert docs.count() == 2 and [r["mention"] for r in variants.collect()] == ["V600E"]
    text = literature.text_blocks(spark.createDataFrame([(block,)], "value string"))
    found = json.loads(literature.annotated_json(text).first()["json"])
    assert found["denotations"][1] == {"span": {"begin": 5, "end": 10}, "obj": "ProteinMutation", "id": ["p", "SUB", "V", "600", "E"]}
    assert literature.bio_of_blocks(text).first()["labels"] == ["B", "B", "O", "O", "O"]
    tool = json.dumps([{"sourceid": "5", "text": "a V600E b", "annotations": [{"obj": "Mutation:x", "span": {"begin": 2, "end": 7}}]}])
    assert tuple(literature.tool_json(spark.createDataFrame([(tool,)], "value string")).first()) == ("5", 2, 8, "V600E", "x")
    (tmp_path / "labels.txt").write_text("B\nI\n")
    assert literature.read_labels(spark, str(tmp_path / "labels.txt")) == ["O", "B", "I"] and literature.read_labels(spark) == ["O", "B", "I"]


def test_command_line(spark, tmp_path, monkeypatch):
    from loomgraph import cli

    (tmp_path / "docs.txt").write_text("1|t|Aspirin helps\n1|a|It treats glioma.\n\n2|t|None\n2|a|- No text -\n")
    (tmp_path / "chemicals.txt").write_text("C1||Aspirin|aspirin acid\n")
    (tmp_path / "diseases.txt").write_text("D1||glioma\n")
    sources = [f"chemical={tmp_path}/chemicals.txt", f"disease={tmp_path}/diseases.txt"]
    cli.main(["recognise", f"{tmp_path}/docs.txt", f"{tmp_path}/tagged", *sources])
    cli.main(["normalise", f"{tmp_path}/tagged", f"{tmp_path}/named", *sources, "--nearest"])
    rows = {r["pmid"]: r["entities"] for r in literature.read_documents_json(spark, f"{tmp_path}/named", lines=True).collect()}
    assert {k: [(m["start"], m["end"], m["id"]) for m in v] for k, v in rows["1"].items()} == {"chemical": [(0, 7, "C1")], "disease": [(24, 30, "D1")]}
    (tmp_path / "x.concept").write_text("1||0|3||Disease||gliomas||D1\n1||0|3||Disease||aspirin||C1\n")
    (tmp_path / "names.txt").write_text("D1||glioma\nC1||aspirin\nC2||asbestos\n")
    cli.main(["eval-names", f"{tmp_path}/x.concept", f"{tmp_path}/scores", f"{tmp_path}/names.txt", "-k", "2"])
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/scores/metrics").collect() if r["value"]] == ["acc1 = 1.0", "acc2 = 1.0"]
    (tmp_path / "gold.txt").write_text("1|t|Aspirin helps\n1|a|It\n1\t0\t7\tAspirin\tchemical\tC1\n")
    cli.main(["eval-spans", f"{tmp_path}/gold.txt", f"{tmp_path}/table", f"{tmp_path}/gold.txt"])
    assert spark.read.csv(f"{tmp_path}/table", sep="\t", header=True).first()["f1"] == "1.0"


def test_nearest_by_grams_against_all_pairs(spark, monkeypatch):
    """Every name asks, not one in fifty; equal names, blocks, an id listed twice, a null, and one that shares no gram."""
    import math
    import random
    from collections import Counter

    monkeypatch.setattr(normalise, "BLOCK", 7)
    monkeypatch.setattr(normalise, "CELLS", 60)
    rng = random.Random(2)
    rows = [(i, rng.choice(["ab", "ba", "abba", "cab", "cd", "dab bad", "a", "".join(rng.choices("abcd ", k=5))])) for i in range(120)]
    rows += [(120, "zz"), (121, None), (3, "cab"), (122, "")]
    names = spark.createDataFrame(rows, "nid long, name string")
    tf: dict[int, Counter] = {}
    for i, name in rows:
        grams = [(name or "")[a : a + n] for n in (1, 2) for a in range(len(name or "") - n + 1)]
        if grams:
            tf.setdefault(i, Counter()).update(grams)
    df = Counter(g for t in tf.values() for g in t)
    raw = {i: {g: c * (math.log((1 + len(rows)) / (1 + df[g])) + 1) for g, c in t.items()} for i, t in tf.items()}
    weights = {i: {g: w / math.sqrt(sum(x * x for x in t.values())) for g, w in t.items()} for i, t in raw.items()}
    got = {(r["nid"], r["gram"]): r["weight"] for r in normalise.tfidf(names).collect()}
    assert got == pytest.approx({(i, g): w for i, t in weights.items() for g, w in t.items()})
    want = {}
    for q in weights:
        scores = [(-round(sum(w * weights[v].get(g, 0) for g, w in weights[q].items()), 9), v) for v in weights if v != q]
        want |= {(q, k + 1): v for k, (s, v) in enumerate(sorted(x for x in scores if x[0] < 0)[:4])}
    assert {(r["qid"], r["rank"]): r["nid"] for r in normalise.sparse_nearest(names, 4).collect()} == want
    assert {q for q, _ in want} == set(range(120))


def test_every_name_asks(spark, tmp_path):
    from loomgraph.plans import catalog

    parts = [(i, n, b) for i, (n, b) in enumerate([("old ring", "B1"), ("old ring", "B2"), ("new bolt", "B1"), ("new bolts", "B1"), ("cold ring", "B3")])]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    found = catalog.QUERIES["sparse_candidates"](spark, str(tmp_path)).collect()
    assert {r["qid"] for r in found} == set(range(5)) and {(r["qid"], r["nid"]) for r in found if r["rank"] == 1} == {(0, 1), (1, 0), (2, 3), (3, 2), (4, 0)}
    assert catalog.QUERIES["name_accuracy"](spark, str(tmp_path)).first()["acc1"] == 0.4
    assert not any("% 50" in catalog.ORACLES[q] for q in ("sparse_candidates", "name_accuracy"))


def test_nearest_of_blocks_against_all_pairs(spark, monkeypatch):
    """Copies tie exactly and go by id; nulls, other lengths and groups; no row of a pair is made in Spark."""
    monkeypatch.setattr(normalise, "VECTORS", 16)
    monkeypatch.setattr(normalise, "ROWS", 5)
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=9).tolist() for _ in range(40)]
    rows = [(i, vectors[int(rng.integers(40))], int(i % 3)) for i in range(150)] + [(150, None, 0), (151, [1.0, 2.0], 1), (152, [None] + [1.0] * 8, 2)]
    names = spark.createDataFrame(rows, "nid long, embedding array<double>, label int")
    asked = names.where("nid % 7 = 0 or nid >= 150").withColumnRenamed("nid", "qid")

    def score(x, y):
        if x is None or y is None or len(x) != len(y) or None in x or None in y:
            return None
        total = 0.0
        for a, b in zip(x, y):
            total += a * b
        return total

    for group, limit in ((None, 1 << 14), ("label", 1 << 14), (None, 3)):
        monkeypatch.setattr(normalise, "ASKED", limit)
        want = {}
        for q, x, g in rows:
            if q % 7 == 0 or q >= 150:
                found = [(score(x, y), n) for n, y, h in rows if g == h or not group]
                want |= {(q, r + 1): (n, s) for r, (s, n) in enumerate(sorted(found, key=lambda f: (f[0] is None, -(f[0] or 0), f[1]))[:6])}
        found = normalise.nearest(asked, names, 6, group=group)
        assert {(r["qid"], r["rank"]): (r["nid"], r["score"]) for r in found.collect()} == want
        assert "zip_with" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_tags_stand_where_the_content_has_them(spark, tmp_path):
    """A blank title, a mark that parts sentences, a blank rest of a cut sentence, and a long word that only begins as a term does."""
    from loomgraph.plans import catalog

    long_ = " ".join(["w"] * 100) + " " * 400  # over 100 words, cut after 200 pieces: what is left is blank
    texts = ["   \nThe glioblasto here", "Title\nOne\u0001two glioblasto. Next? glioblasto", "A\u0001b glioblasto\nglioblasto", f"T\n{long_} w w! Then glioblasto", "T\nglioblastomultiformexyz and glioblasto"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    terms = [t for n in range(26) for t in ["glioblasto" if n == 0 else "x" * (5 + n)]]
    spark.createDataFrame([(0, " ".join(terms))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    mentions = catalog.QUERIES["surface_mentions"](spark, str(tmp_path)).where("mention = 'glioblasto'")
    assert mentions.first()["entity_type"] in tagger.MODEL_HEADS
    got = catalog.QUERIES["tagged_mentions"](spark, str(tmp_path))
    rows = lambda d: sorted((r["pmid"], r["start"], r["end"], r["mention"]) for r in d.collect())
    assert rows(got) == rows(mentions) and len(rows(got)) == 7
