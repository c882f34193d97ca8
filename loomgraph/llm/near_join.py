"""Jaccard join on word n-grams: rare-first prefixes, then filters, then one verification per pair.

Documents with the same set of n-grams are one node. A node's n-grams are ordered rare
first; the prefix of a set of n is so long that two sets of the wanted similarity must
share an n-gram of both prefixes. Nodes that share one are candidates.

Components need no list of all links. First each node is verified against one hub (of
the hubs of its shared n-grams, the one it shares most with), and the links found are
contracted. Only then are candidates listed, and only those that still lie in
different components, so that a large group of near copies is a star and not all its
pairs. Every candidate between components is verified, so no component is missed.

N-grams are known by 64-bit hashes, nodes by a 64-bit signature of the set and a second
one that confirms it: sets that differ in the second alone get other nodes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import kernels as K
from loomgraph.llm.common import Scratch, written
from loomgraph.llm.components import bitmap_of, cluster

WORDS, PERCENT = 4, 85
#: Hash bits of the table of word counts and of that of n-gram counts.
WORD_BITS, GRAM_BITS = 16, 20
#: N-grams counted together within a task, and sets remembered within one.
WINDOW, SEEN = 1 << 20, 1 << 16
#: 64-bit words of a set's parity sketch; beyond so many n-grams, a set also has one of as many bits as n-grams.
SKETCH, WIDE = 16, 1024


class Rarity:
    """How common words and n-grams are: two tables of fixed size, from all documents."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.log_words = np.log2(np.maximum(words, 1)).astype(np.float32)
        self.total = float(np.log2(max(int(words.sum()), 1)))
        self.grams = grams  # log2 of the count, in bytes

    def level(self, expected: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """A whole number that grows with frequency, and depends on the n-gram alone."""
        seen = self.grams[(grams >> np.uint64(64 - GRAM_BITS)).astype(np.int64)]
        return np.maximum(np.maximum(expected, 0).astype(np.uint8), seen)


def _expected(log_words: np.ndarray, total: float, words: np.ndarray, upto: np.ndarray, n: int) -> np.ndarray:
    """log2 of how often each n-gram would occur if its words were independent, in the order of K.shingles."""
    own = log_words[(words >> np.uint64(64 - WORD_BITS)).astype(np.int64)] - np.float32(total)
    size = np.diff(upto, prepend=0)
    rolled = np.full(len(words), total, np.float32)
    for k in range(min(n, len(words))):
        rolled[: len(words) - k] += own[k:]
    text = np.repeat(np.arange(len(upto)), size)
    inside = np.arange(len(words)) + n <= upto[text]
    short = int(((size > 0) & (size < n)).sum())
    return np.concatenate([rolled[inside], np.zeros(short, np.float32)])


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words, upto, n-grams, text of each, signature of each text's set); column 1 is the text."""
    for start, data, ends in K.runs(batch.column(1)):
        words, upto = K.word_hashes(data, ends)
        grams, owner = K.shingles(words, upto, n)
        yield start, words, upto, grams, owner


def _signatures(values: np.ndarray, owner: np.ndarray, texts: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, signature (of ``bits``) and a second signature of each text's set of distinct values."""
    size = np.bincount(owner, minlength=texts)
    sums = np.zeros((2, texts), np.uint64)
    if len(values):
        some = np.flatnonzero(size)
        start = np.concatenate(([0], np.cumsum(size[some])[:-1]))
        for row, salt in zip(sums, (0x9E37, 0x51ED270B)):
            row[some] = np.add.reduceat(K.mix(values + np.uint64(salt)), start)
    one, two = K.mix(sums[0] + size.astype(np.uint64)), K.mix(sums[1] ^ size.astype(np.uint64))
    return size, (one >> np.uint64(64 - bits)).view(np.int64), two.view(np.int64)


def rarity(docs: DataFrame, n: int, scratch: Scratch) -> Rarity:
    """Counts of words, and of the n-grams that repeat more than their words explain.

    A task counts within windows of n-grams and reports what repeats there, so an
    n-gram that many documents share is found wherever it lies. What reaches the driver
    are two tables of fixed size. They order n-grams; no result depends on them.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_seen = np.zeros(1 << WORD_BITS, np.int64)
        pool: list[tuple[np.ndarray, np.ndarray]] = []
        sets_seen: set[int] = set()
        held = 0

        def repeated() -> pa.RecordBatch:
            grams = np.concatenate([g for g, _ in pool])
            expected = np.concatenate([e for _, e in pool])
            values, at, counts = np.unique(grams, return_index=True, return_counts=True)
            odd = (counts >= 2) & (np.log2(counts) > expected[at] + 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(values[odd].view(np.int64)), pa.array(counts[odd].astype(np.int64))], schema=schema
            )

        for batch in batches:
            for _, words, upto, grams, owner in _sets(batch, n):
                words_seen += np.bincount((words >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=1 << WORD_BITS)
                # The task's own words stand for all: they only tell what chance explains.
                log_words = np.log2(np.maximum(words_seen, 1)).astype(np.float32)
                expected = _expected(log_words, float(np.log2(max(int(words_seen.sum()), 1))), words, upto, n)
                v, o, at = K.distinct(grams, owner)
                e = expected[at]
                _, sids, _ = _signatures(v, o, len(upto))
                fresh = np.zeros(len(upto), bool)
                for i, s in enumerate(sids.tolist()):
                    if s not in sets_seen:
                        fresh[i] = True
                        sets_seen.add(s)
                keep = fresh[o]
                pool.append((v[keep], e[keep]))
                held += int(keep.sum())
                if held >= WINDOW:
                    yield repeated()
                    pool, held, sets_seen = [], 0, set()
        if held:
            yield repeated()
        some = np.flatnonzero(words_seen)
        yield pa.RecordBatch.from_arrays([pa.array(some - (1 << WORD_BITS)), pa.array(words_seen[some])], schema=schema)

    schema = pa.schema([("key", pa.int64()), ("seen", pa.int64())])
    counted = scratch.written(
        docs.select("doc_id", "text").mapInArrow(count, "key long, seen long")
        .groupBy("key").agg(F.sum("seen").alias("seen")), "rarity",
    )
    # Keys just below zero are word buckets (a hash there is one in 2^48); the rest are n-grams.
    in_words = F.col("key").between(-(1 << WORD_BITS), -1)
    words = counted.where(in_words).toArrow()
    words_seen = np.zeros(1 << WORD_BITS, np.int64)
    words_seen[words["key"].to_numpy() + (1 << WORD_BITS)] = words["seen"].to_numpy()
    bucket = F.shiftrightunsigned("key", 64 - GRAM_BITS).cast("int").alias("bucket")
    level = F.least(F.lit(60), F.floor(F.log2(F.max("seen")))).cast("int").alias("level")
    grams = counted.where(~in_words).groupBy(bucket).agg(level).toArrow()
    table = np.zeros(1 << GRAM_BITS, np.uint8)
    table[grams["bucket"].to_numpy()] = grams["level"].to_numpy()
    return Rarity(words_seen, table)


def _prefixes(docs: DataFrame, known: Broadcast, n: int, percent: int, clashing: np.ndarray, bits: int) -> DataFrame:
    """kind 0: a = doc_id, b = node, n = size, its second signature and its sketches; kind 1: a = n-gram, b = node, n = size, pos in the prefix."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "a", "b", "n", "pos", "two", "sketch", "wide"]
        r, seen = known.value, set()
        for batch in batches:
            ids = batch.column(0)
            for start, words, upto, grams, owner in _sets(batch, n):
                level = r.level(_expected(r.log_words, r.total, words, upto, n), grams)
                values, who, at = K.distinct(grams, owner)
                size, one, two = _signatures(values, who, len(upto), bits)
                nodes, texts = K.recoded(one, two, clashing), len(upto)
                none = np.zeros(texts, np.int32)
                columns = [none, ids.slice(start, texts).cast(pa.int64()), pa.array(nodes, mask=size == 0), size.astype(np.int32), none, two]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), K.lists(K.parity(values, who, texts, SKETCH)), _wide(values, size)], names=names)
                fresh = np.zeros(texts, bool)  # copies within a task say the same
                for i, s in enumerate(nodes.tolist()):
                    if s not in seen:
                        fresh[i] = True
                        if len(seen) < SEEN:
                            seen.add(s)
                take = fresh[who]
                values, who, level = values[take], who[take], level[at[take]]
                order = K.by_level(level, who)
                values = values[order]
                first = np.searchsorted(who, np.arange(texts))
                position = np.arange(len(who)) - first[who]
                length = size - (percent * size + 99) // 100 + 1
                inside = np.flatnonzero(position < length[who])
                own = who[inside]
                columns = [np.ones(len(inside), np.int32), values[inside].view(np.int64), nodes[own], size[own].astype(np.int32), position[inside].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(inside), pa.int64()), *[pa.nulls(len(inside), pa.list_(pa.int64()))] * 2], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "kind int, a long, b long, n int, pos int, two long, sketch array<long>, wide array<long>")


def _wide(values: np.ndarray, size: np.ndarray) -> pa.Array:
    """The wide sketches of the sets of more than ``WIDE`` values, null for others."""
    at = np.cumsum(size) - size
    return pa.array([K.wide_parity(values[a : a + n]) if n > WIDE else None for a, n in zip(at, size)], pa.list_(pa.int64()))


def _far_apart(a: Column, b: Column, most: Column) -> Column:
    """Whether wide sketches differ in more than ``most`` bits; of two lengths, the longer one's halves are added first."""
    fold = lambda x: F.zip_with(F.slice(x, 1, F.floor(F.size(x) / 2).cast("int")), F.slice(x, F.floor(F.size(x) / 2).cast("int") + 1, F.size(x)), lambda p, q: p.bitwiseXOR(q))
    one = F.when(F.size(a) > F.size(b), fold(a)).otherwise(a)
    two = F.when(F.size(b) > F.size(a), fold(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(one, two, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, k: s + k)
    return F.coalesce(differ > most, F.lit(False))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The least intersection of sets of n and m that reaches the similarity."""
    return F.ceil((n + m) * percent / F.lit(100.0 + percent) - 1e-9)


def _may_link(n: Column, m: Column, room: Column, percent: int) -> Column:
    """Length (n is the smaller) and position: what lies behind the first common n-gram must still suffice."""
    return (100 * n >= percent * m) & (room >= _needed(n, m, percent))


def _load_sets(docs: DataFrame, wanted: DataFrame, n: int, clashing: np.ndarray, node_bits: int, scratch: Scratch) -> DataFrame:
    """(node, grams as sorted 64-bit little-endian bytes) of the ``wanted`` (doc_id, node) rows, and a few more.

    A bitmap of bounded size over hashed ids skips other rows before anything is hashed;
    what joins the result must name the node.
    """
    marks, bits = bitmap_of(wanted.select(F.xxhash64("doc_id").alias("h")), "h")
    table = scratch.broadcast(marks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(K.marked(table.value, batch.column(0).to_numpy())))
            for start, _, upto, grams, owner in _sets(batch, n):
                values, who, _ = K.distinct(grams, owner)
                size, one, two = _signatures(values, who, len(upto), node_bits)
                cut = np.concatenate(([0], np.cumsum(size)))
                raw = values.astype("<u8")
                blobs = [raw[cut[i] : cut[i + 1]].tobytes() for i in range(len(upto))]
                yield pa.RecordBatch.from_arrays([pa.array(K.recoded(one, two, clashing)), pa.array(blobs, pa.binary())], names=["node", "grams"])

    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)).alias("place")
    return docs.select(place, "text").mapInArrow(run, "node long, grams binary")


def _enough(x: np.ndarray, y: np.ndarray, percent: int, depth: int = 3) -> bool:
    """Whether sorted sets reach the similarity: suffix filter by halving, then the intersection."""
    need = -(-(len(x) + len(y)) * percent // (100 + percent))

    def bound(a: np.ndarray, b: np.ndarray, left: int) -> int:
        if not left or not len(a) or not len(b):
            return min(len(a), len(b))
        h = len(a) // 2
        j = int(np.searchsorted(b, a[h]))
        return bound(a[:h], b[:j], left - 1) + bound(a[h:], b[j:], left - 1)

    if bound(x, y, depth) < need:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (x, y) of ``pairs`` whose ``sets`` are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [
                _enough(np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8"), percent)
                for a, b in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    xs, ys = (sets.select(F.col("node").alias(end), F.col("grams").alias(f"g{end}")) for end in ("x", "y"))
    return pairs.join(xs, "x").join(ys, "y").select("x", "y", "gx", "gy").mapInArrow(run, "x long, y long")


def near_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, node_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id and n_docs of the component for every row of ``docs``.

    Words are runs of bytes other than space and \\t \\n \\v \\f \\r, A-Z lowered. A text of
    fewer words than a shingle has one of all its words; an empty or null text has none
    and links with nothing. Two documents link when 100 |A and B| >= percent |A or B|;
    ``component_id`` is the smallest doc_id reachable by links, a lone row's own.
    Rows repeated with the same id are rows of one document. ``doc_id`` is an integer;
    a null id stays null and is never a component's id unless all are null. Other columns,
    whatever their names, are not read; an empty table gives no rows. ``node_bits`` are those of a node's first
    signature; fewer only make more sets meet that the second one then parts.
    """
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession) as scratch:
        known = docs.sparkSession.sparkContext.broadcast(rarity(docs, words, scratch))  # two tables of fixed size
        clashing, clashes = np.zeros(0, np.int64), True
        while clashes:
            emitted = scratch.written(_prefixes(docs, known, words, percent, clashing, node_bits), "prefixes", "kind")
            rows = emitted.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("node"), "n", "two", "sketch", "wide")
            owners = scratch.written(
                rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("two").alias("two"), F.max("two").alias("other")), "owners"
            )
            # Of n sets about n^2 / 2^65 meet another under their signature: none here, a few in 10^11.
            clashes = owners.where("two <> other").select("node").toArrow()["node"].to_numpy()
            clashing = np.union1d(clashing, clashes)
            clashes = len(clashes) > 0
        known.unpersist()
        sketches = rows.where("node is not null").select("node", "sketch").dropDuplicates(["node"])

        as_long = lambda n, m: 100 * F.least(n, m) >= percent * F.greatest(n, m)
        most_apart = lambda n, m: F.when(as_long(n, m), n + m - 2 * _needed(n, m, percent)).otherwise(-1)
        large = rows.where("wide is not null").select("node", "n", "wide").dropDuplicates(["node"])

        def linked(pairs: DataFrame) -> DataFrame:
            for end in ("x", "y"):
                pairs = pairs.join(large.select(F.col("node").alias(end), F.struct("n", "wide").alias(f"l{end}")), end, "left")
            far = _far_apart(F.col("lx.wide"), F.col("ly.wide"), most_apart(F.col("lx.n"), F.col("ly.n")))
            pairs = scratch.written(pairs.where(~far).select("x", "y"), "fitting")
            named = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
            wanted = scratch.written(owners.select("doc_id", "node").join(named, "node"), "wanted")
            loaded = _load_sets(docs, wanted, words, clashing, node_bits, scratch)
            sets = scratch.written(loaded.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
            links = scratch.written(_verified(pairs, sets, percent), "verified")
            scratch.drop(pairs, wanted, sets)
            return links

        comps = cluster(
            emitted.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"), "n", "pos"),
            lambda nodes: sketches,
            SKETCH,
            linked,
            most_apart,
            lambda n, m, room: _may_link(n, m, room, percent),
        )
        of = rows.select("doc_id", "n", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = of.where("comp is not null").groupBy("comp").agg(
            F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n_docs")
        )
        return written(of.join(least, "comp", "left").select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_docs", F.lit(1)).alias("n_docs"),
        ), "components")


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, all of its columns.

    Documents without words (or null) link with nothing, so all of them stay; rows repeated with the id that
    stays all do. Columns of any name are kept as they are.
    """
    stay = near_components(docs, words, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    named = stay.select(F.struct(F.col("doc_id")).alias("stays")).distinct()
    return docs.join(named, F.struct(docs["doc_id"]) == named["stays"], "left_semi")
