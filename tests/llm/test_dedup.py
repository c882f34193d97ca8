import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from loomgraph.llm import components, exact_dedup, line_dedup, near_join
from loomgraph.llm import kernels as K


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def ids(rows):
    return sorted(rows, key=repr)


def union(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("keep, bits", [("largest", 128), ("smallest", 128), ("largest", 8)])
def test_exact_groups(spark, odd, near, keep, bits):
    """With 8 bits nearly every hash collides, and the bytes decide."""
    for docs in (odd, near):
        rows = [(r["doc_id"], lower(r["text"])) for r in docs.collect()]
        groups = defaultdict(list)
        for i, t in rows:
            groups[t].append(i)
        best = {t: (max if keep == "largest" else min)((i for i in g if i is not None), default=None) for t, g in groups.items()}
        want = [(i, best[t], len(groups[t]), i == best[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows]
        assert ids(map(tuple, exact_dedup.exact_groups(docs, keep=keep, hash_bits=bits).collect())) == ids(want)


def test_drop_exact_copies(spark, odd, none):
    got = exact_dedup.drop_exact_copies(odd)
    assert got.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(["0", "2", "5", "6", "7", "9", "10", "4", "None"])
    assert exact_dedup.drop_exact_copies(none).count() == 0


def brute(docs, n, percent):
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"]))
        sets[r["doc_id"]] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    names = [i for i in sets if i is not None]
    links = [(a, b) for a in names for b in names if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = union(links, names)
    return {i: (len(sets[i]), comp[i]) for i in names}


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_near_components(spark, near, n, percent):
    want = brute(near, n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_join.near_components(near, n, percent).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 30


def test_near_components_of_odd_rows(spark, odd, none):
    got = near_join.near_components(odd)
    assert got.count() == odd.count()
    named = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect() if r["doc_id"] is not None}
    assert named == brute(odd, 4, 85)
    assert near_join.near_components(none).count() == 0
    kept = near_join.drop_near_copies(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {0, 2, 3, 4, 5, 7, 9, 10, None}


def test_line_groups(spark, none):
    base = "the quick brown fox jumps over the lazy dog and runs away into the woods"
    texts = [base + "\nshort\n\n" + base.upper(), base + " today\nanother line of text altogether, longer", "  short \n" + base.replace("woods", "wood"), None, "", "\n \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = {(i, k): line_dedup.normal(x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip()}
    links = [(a, b) for a in lines for b in lines if a < b and line_dedup.similar(lines[a], lines[b])]
    comp = union(links, list(lines))
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_groups(docs).collect()}
    assert got == comp and len(set(comp.values())) == 3
    kept = {r["doc_id"]: r["text"] for r in line_dedup.drop_near_lines(docs).collect()}
    assert kept[0] == base + "\nshort\n" and kept[1] == texts[1].split("\n")[1] and kept[2] == "" and kept[3] is None
    assert line_dedup.line_groups(none).count() == 0


def test_bitmap_marks_every_place(spark):
    """A value of 0 modulo 2^bits passes like any other."""
    for values in ([0], [0, 1, 32768, 32769, -1], [5 << 26], [3]):
        df = spark.createDataFrame([(v,) for v in values], "h long")
        marks, bits = components.bitmap_of(df, "h")
        assert np.flatnonzero(np.unpackbits(marks)).tolist() == sorted({v % (1 << bits) for v in values})
        assert components.likely(df, "h", df, "h").count() == len(values)


@pytest.mark.parametrize("n", [4, 5])
def test_few_words_alone(spark, n):
    """A table, and so a run of texts, of a single document of fewer words than a shingle."""
    for k in range(1, n + 1):
        texts = [" ".join("abcde"[:k])]
        words, upto = K.word_hashes(np.frombuffer(texts[0].encode() + b" ", np.uint8), np.array([len(texts[0]) + 1]))
        assert len(K.shingles(words, upto, n)[0]) == len(near_join._expected(np.zeros(1 << near_join.WORD_BITS, np.float32), 0.0, words, upto, n)) == 1
    docs = spark.createDataFrame([(7, "two words")], "doc_id long, text string")
    assert [tuple(r) for r in near_join.near_components(docs, n).collect()] == [(7, 1, 7, 1)]


def test_one_changed_character_of_a_short_line(spark):
    """Lines of 30 to 100 characters that differ by one inner character are one group, unlike lines are not."""
    rng = random.Random(9)
    rows = []
    for k, size in enumerate(range(30, 101, 5)):
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=size - 2))
        line = "x" + " ".join(line.split()).ljust(size - 2, "q") + "x"
        rows += [(10 * k, line), (10 * k + 1, line[: size // 2] + "7" + line[size // 2 + 1 :])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_doc_id"], r["group_lines"]) for r in line_dedup.line_groups(docs).collect()}
    assert got == {i: (i - i % 10, 2) for i, _ in rows}


def test_band_keys_are_packed(spark):
    """op3_line_dedup emits a row for many lines' band keys, not one a key, and finds what a plain grouping finds."""
    rng = random.Random(4)
    base = "".join(rng.choices("abcdefgh ", k=120))
    lines = [base[:k] + "z" + base[k + 1 :] for k in range(1, 41)] + ["".join(rng.choices("abcdefgh ", k=90)) + "x" for _ in range(60)]
    docs = spark.createDataFrame([(i, "x" + line) for i, line in enumerate(lines * 2)], "doc_id long, text string").repartition(3)
    bands = line_dedup._emitted(docs, np.zeros(0, np.int64), 64).where("kind = 1")
    plain = defaultdict(dict)
    rows = bands.collect()
    assert 0 < len(rows) < 10
    for r in rows:
        nodes, sizes, keys = (np.frombuffer(r[c], kind) for c, kind in (("nodes", np.int64), ("sizes", np.int32), ("keys", np.uint64)))
        for node, n, own in zip(nodes.tolist(), sizes.tolist(), keys.reshape(len(nodes), -1).view(np.int64).tolist()):
            for key in own:
                plain[key][node] = n
    few = {(x, y) for own in plain.values() if 1 < len(own) <= components.FEW for x in own for y in own if x < y}
    many = {(key, node, n) for key, own in plain.items() if len(own) > components.FEW for node, n in own.items()}
    assert few and many
    for part in (1 << 19, 500):  # in one part, and in many with large keys spread
        found = line_dedup.shared_keys(bands, part=part).collect()
        assert {(r["node"], r["other"]) for r in found if r["other"] is not None} == few
        assert {(r["key"], r["node"], r["n"]) for r in found if r["other"] is None} == many


def test_lines_are_read_at_once_as_one_by_one():
    rng = random.Random(1)
    for _ in range(2000):
        signs = rng.choice(["aB \t\x1c\x85\xa0　é\U0001f600Σİ\n", "aB b\n"])
        texts = [rng.choice([None, "".join(rng.choices(signs, k=rng.randrange(25)))]) for _ in range(rng.randrange(1, 5))]
        want = [(line_dedup.normal(x), i, k) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip()]
        code, size, text, number, data, first, length = line_dedup._coded(texts)
        ends, whole = np.cumsum(size), code.tobytes().decode("utf-32-le")
        assert [(whole[b - n : b], i, k) for b, n, i, k in zip(ends.tolist(), size.tolist(), text.tolist(), number.tolist())] == want
        assert [data.tobytes()[a : a + n].decode() for a, n in zip(first.tolist(), length.tolist())] == [x for x, _, _ in want]
