"""Collisions, odd columns, deep pages, and the pipeline's stages against plain versions of them."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import CLASHES
from pyspark.sql import functions as F
from test_dedup import brute, lower, union

from loomgraph.llm import components, exact_dedup, html_extract, language, line_dedup, mixing, near_join, packing, url_filter
from loomgraph.llm import kernels as K

DATA = Path("/root/testdata/sf0.001")


def thue_morse(n):
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_patterned_words_and_lines_keep_apart(spark):
    """Words that agree under every polynomial hash modulo 2^64."""
    one, two = thue_morse(10)
    docs = spark.createDataFrame([(1, one), (2, two), (3, one + " x"), (4, two + " x")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_join.near_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    code, size = line_dedup.codes([one, two])
    assert all(len(set(h.tolist())) == 2 for h in line_dedup.identities(code, size, np.zeros(0, np.int64)))


@pytest.mark.parametrize("bits", [1, 6])
def test_sets_that_meet_in_a_node_are_parted(spark, near, bits):
    want = {r["doc_id"]: r["component_id"] for r in near_join.near_components(near).collect()}
    got = {r["doc_id"]: r["component_id"] for r in near_join.near_components(near, node_bits=bits).collect()}
    assert got == want and len(set(want.values())) > 20


def test_line_groups_against_all_pairs(spark):
    """Families of edited lines, long and short, repeated rows, a very long line and nodes that meet."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    bases = [" ".join(word() for _ in range(n)) for n in (3, 5, 8, 12, 13, 14, 30, 60)]
    rows = []
    for i in range(90):
        line = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            line[rng.randrange(len(line))] = rng.choice("xyz")
        rows.append((i, "\n".join(["".join(line), f"own {i} {word()} {word()}", "  " * (i % 2) + "The Same"])))
    rows += [(1000, "ab" * 40_000), (1001, "ab" * 40_000 + "!"), rows[0], (2000, None), (2001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in CLASHES.items()})
    lines = {(i, k): line_dedup.normal(x) for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip()}
    kinds = sorted(set(lines.values()))
    links = [(a, b) for i, a in enumerate(kinds) for b in kinds[:i] if line_dedup.similar(a, b)]
    comp = union(links, kinds)
    first = {}
    for at, line in sorted(lines.items()):
        first.setdefault(comp[line], at)
    want = {at: first[comp[line]] for at, line in lines.items()}
    for bits in (64, 4):
        got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_groups(docs, node_bits=bits).collect()}
        assert len([a for a in want if got[a] != want[a]]) <= len(want) // 100  # banding may miss a pair
    assert line_dedup.line_groups(docs).count() == len(lines) + 3
    assert line_dedup.drop_near_lines(docs).columns == docs.columns


def test_similar_pairs_is_similar():
    rng = random.Random(6)
    lines = ["".join(rng.choices("ab c", k=rng.randrange(1, 140))).strip() or "x" for _ in range(150)]
    lines += [x[:-1] + "z" for x in lines]
    pairs = [(i, j) for i in range(len(lines)) for j in (i, (i + 150) % 300, rng.randrange(300))]
    x, y = map(np.array, zip(*pairs))
    got = line_dedup.similar_pairs(lines, x, y)
    assert got.tolist() == [line_dedup.similar(lines[a], lines[b]) for a, b in pairs]


def test_long_chains_are_one_component(spark):
    n = 3000
    links = spark.range(n).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r["comp"] for r in components.connected(links).collect()} == {0}


def test_clashing_names_stay(spark, odd):
    for kept in (exact_dedup.drop_exact_copies(odd), near_join.drop_near_copies(odd), mixing.mixed_documents(odd), line_dedup.drop_near_lines(odd)):
        assert kept.columns == odd.columns and kept.count() > 0
        assert {k: r[k] for r in kept.limit(1).collect() for k in CLASHES} == CLASHES
    pages = odd.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example.com/en/x").alias("url"), F.col("text").alias("html"), *CLASHES)
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [("block", "example.com/en/")]))
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"] and {r["verdict"] for r in judged.collect()} == {"block"}
    assert html_extract.main_text(pages).count() == pages.count()


def test_hosts_deeper_than_any_rule(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 200 + "example.com/en/x"), (2, "http://" + "a." * 200 + "example.com./en/"), (3, "x://")], "page_id long, url string")
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [("block", "example.com/en/")]))
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {1: "block", 2: "allow", 3: "allow"}


def test_deep_and_odd_pages():
    read = lambda page: html_extract.extract(page, [], set())
    n = 100_000
    assert read("<article>" + "<div>" * n + "hello" + "</div>" * n + "bye</article>") == "hello bye"
    assert read("<article>x " + "<b>" * n + "y" + "</i>" * n + " z</article>") == "x y z"
    deep = "<div>" * 300
    assert read(f"<article>{deep}<p>one</p><nav>menu</nav><p>two{'</div>' * 300}three</article>") == "one two three"
    assert read("<article>" + "<p>word</p>" * 50_000 + "</article>") == " ".join(["word"] * 50_000)


def test_the_host_decides_where_the_article_lies(spark):
    """No article element: a page with more comments than text is read where its host's other pages have theirs."""
    page = "<body><div class=top>{0} Top</div><div class=left>{1}</div><div class=right>{2}</div></body>"
    story = lambda i: f"<p>story {i} " + f"word{i} " * 200 + "</p>"
    rows = [(i, "http://h.com/a", page.format("A", story(i), f"<p>remark {i}</p>")) for i in range(12)]
    rows.append((99, "http://h.com/z", page.format("A", "<p>story 99 short</p>", "<p>remark " + "much " * 300 + "</p>")))
    df = spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()}
    assert got[99] == "story 99 short" and got[3] == "story 3 " + " ".join(["word3"] * 200)
    assert html_extract.extract(rows[-1][2], [], set()) != got[99]
    assert html_extract.main_text(df).count() == 14


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline

    from loomgraph.llm.common import written

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact dedup", "near copies", "mixing", "packing"]
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    extra = [(9001, "\u041f\u0440\u0438\u0432\u0435\u0442 " * 30, "en", "s0", 0), (9002, "1234 5678", None, None, 0), (9003, None, "en", "s1", 0), (9004, "xqzkj wvxq zzkq " * 40, "en", "s2", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    run = {}
    for name in list(stages)[:-1]:
        after = written(stages[name](spark, docs, str(DATA)), "test")
        assert after.columns == docs.columns
        run[name] = (docs, after)
        docs = after
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())

    before, after = run["language"]
    model, stay = language.fit(before), set()
    for r in before.collect():
        words = language.words_of([r["text"] or ""])
        if not len(words.word_at):
            continue
        s = language.likelihoods(words, model)
        label = plain_viterbi(language.word_scores(s))
        letters = Counter()
        for k, n in zip(label, words.letters):
            letters[k] += int(n)
        read = sum(int(n) for n, row in zip(words.letters, s) if row.max() >= -n * (language.BITS * np.log(2) + 1e-3))
        if letters and 2 * read >= sum(letters.values()):
            stay.add(r["doc_id"])
    assert set(ids(after)) == stay and not stay & {9001, 9002, 9003}

    before, after = run["exact dedup"]
    groups = defaultdict(list)
    for r in before.collect():
        groups[lower(r["text"])].append(r["doc_id"])
    assert ids(after) == Counter(min(g) for g in groups.values())

    before, after = run["near copies"]
    assert ids(after) == Counter({i: 1 for i, (_, c) in brute(before, 5, 80).items() if i == c})
    assert ids(after).total() < ids(before).total()

    before, after = run["mixing"]
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before.collect()}
    source = {r["doc_id"]: r["source"] for r in before.collect()}
    times = ids(after)
    assert max(times.values()) <= 2 and set(times) <= set(size)
    target = {r["source"]: r["target"] for r in mixing.mix_sources(before).collect()}
    for s, want in target.items():
        got = sum(n * size[i] for i, n in times.items() if source[i] == s)
        assert abs(got - want) <= 2 * max(size[i] for i in size if source[i] == s), s

    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(str(path(packing.VOCABULARY)))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in stages["packing"](spark, docs, str(DATA)).collect():
        pieces[r["doc_id"]].append((r["piece"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in docs.dropDuplicates(["doc_id"]).collect():
        own = [*whole.encode(r["text"], add_special_tokens=False).ids, 1]
        cut = [own[a : a + 4096] for a in range(0, len(own), 4096)]
        want = [(k, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)]
        assert sorted(pieces[r["doc_id"]]) == sorted(want * times[r["doc_id"]])
    for row in places.values():
        row.sort()
        assert row[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(row, row[1:])) and sum(row[-1]) <= 4096


def test_the_pipeline_hands_texts_to_python_in_small_batches(spark):
    import corpus_pipeline

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = spark.range(0, 60, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 50000) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    largest = lambda: max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect())
    try:
        for stage in (corpus_pipeline.known_language, corpus_pipeline.without_near_copies, corpus_pipeline.packed):
            spark.conf.unset(corpus_pipeline.LIMIT)
            assert largest() > 3 * int(corpus_pipeline.BATCH)
            stage(spark, docs.limit(3), "")
            assert largest() < 2 * int(corpus_pipeline.BATCH)
        spark.conf.set(corpus_pipeline.LIMIT, "1000000")  # a session's own limit stays
        corpus_pipeline.packed(spark, docs.limit(3), "")
        assert spark.conf.get(corpus_pipeline.LIMIT) == "1000000"
    finally:
        spark.conf.unset(corpus_pipeline.LIMIT)


def plain_viterbi(s, switch=language.SWITCH):
    """Every pair of labels of neighbouring words is weighed."""
    total, back = s[0].astype(float), []
    for row in s[1:]:
        step = total[:, None] - switch * (1 - np.eye(len(total)))
        back.append(step.argmax(axis=0))
        total = step.max(axis=0) + row
    path = [int(total.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_a_table_written_by_folder_is_not_sorted(spark):
    """op3_line_dedup writes lines and band keys in one pass."""
    from loomgraph.llm.common import WRITERS, written_at

    df = spark.range(0, 1000, 1, 3).selectExpr("cast(id % 2 AS int) AS kind", "id AS a")
    spark.conf.unset(WRITERS)
    back, _ = written_at(df, "test", "kind")
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    own = [p for p in plans if "loom-test" in p and "InsertIntoHadoopFsRelationCommand" in p][-1]
    assert "Sort" not in own
    assert spark.conf.get(WRITERS, None) is None
    assert sorted(map(tuple, back.select("kind", "a").collect())) == sorted((i % 2, i) for i in range(1000))


def test_lines_that_are_normal_as_they_are():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choices("aB \t\x1c\x85\xa0 ​é\U0001f600\n", k=rng.randrange(30)))
        assert line_dedup._normal_lines(text) == ([line_dedup.normal(x) for x in text.lower().split("\n")] if text else [])
