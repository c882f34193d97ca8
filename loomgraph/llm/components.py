"""Connected components: of links, and of candidates that share a key and must be verified."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import kernels as K
from loomgraph.llm.common import Scratch, written

#: Nodes of a key up to which all its pairs are listed at once, and hubs of a larger key in a round.
FEW, HUBS = 8, 8
#: A node's first keys that tell whether two nodes have met under an earlier one.
FIRST = 16
#: Rounds of hubs before the pairs that are left are listed.
ROUNDS = 2


def connected(links: DataFrame, keep: Scratch | None = None) -> DataFrame:
    """``links`` (x, y) as undirected: node and comp, the smallest node reachable, for all nodes with links.

    Each task first unites what its own links join, so few rounds are left. A
    round ties every node's larger neighbours to its smallest (large star), then a
    node and its smaller neighbours to the smallest (small star); rounds go on until nothing
    changes, about log2 of the longest path. A hub is one row of a partial
    aggregation and a skewed join's key, never a list. Every round is a written table;
    the last is let go with ``keep``, if given.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        edges = scratch.written(edges.mapInArrow(_united, "u long, v long"), "links")
        # Sums of hashes tell two edge sets apart without joining them.
        state = lambda: edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")).first()
        now, before = state(), None
        while now != before and now[0]:
            both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = large.where("u <> v").distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))
            )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
            old, edges = edges, scratch.written(small, "links")
            scratch.drop(old)
            now, before = state(), now
        found = edges.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")
        roots = found.select(F.col("comp").alias("node"), "comp").distinct()
        return (keep.written if keep else written)(found.unionByName(roots), "comps")


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as links to the smallest node that they reach among themselves."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(u), top(v)
            up[max(a, b)] = min(a, b)
    pairs = [(x, t) for x in up if (t := top(x)) != x]
    for at in range(0, len(pairs), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs[at : at + 10_000])], names=["u", "v"])


def bitmap_of(df: DataFrame, col: str) -> tuple[np.ndarray, int]:
    """Marks of the values of ``col`` modulo 2^bits, packed, and bits: about 16 places a value, 8 MB at most."""
    bits = int(min(26, max(18, np.ceil(np.log2(16 * max(df.count(), 1))))))
    place = F.pmod(F.col(col), F.lit(1 << bits))
    packed = (
        df.select(place.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("m"))
    )
    return K.bitmap(packed.collect(), bits), bits


def likely(df: DataFrame, col: str, wanted: DataFrame, wanted_col: str, told: str | None = None) -> DataFrame:
    """The rows of ``df`` whose ``col`` is among ``wanted_col``, and a few others that share a place; or all rows, with
    whether they are these in a column ``told``.

    The marks have a bounded size (8 MB), so they are broadcast and this never shuffles; an exact join follows.
    """
    marks, bits = bitmap_of(wanted, wanted_col)
    words = np.packbits(np.unpackbits(marks), bitorder="little").view("<i8").reshape(-1, 64)
    table = pa.table({"at": pa.array(np.arange(len(words))), "words": K.lists(words)})
    held = F.broadcast(df.sparkSession.createDataFrame(table))
    place = F.pmod(F.col(col), F.lit(1 << bits))
    met = df.join(held, F.shiftright(place, 12) == held["at"])
    word = F.get("words", F.shiftright(place, 6).bitwiseAND(63).cast("int"))
    is_marked = F.bit_get(word, place.bitwiseAND(63).cast("int")) == 1
    return met.select(*df.columns, is_marked.alias(told)) if told else met.where(is_marked).select(*df.columns)


def apart(a: Column, b: Column, words: int) -> Column:
    """A lower bound of how many members two sets don't share: the bits in which their parity sketches differ.

    A sketch may have a further word, its kind; of different kinds nothing is known.
    """
    differ = reduce(lambda x, y: x + y, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)])
    return F.when(F.get(a, F.lit(words)).eqNullSafe(F.get(b, F.lit(words))), differ).otherwise(0)


def cluster(
    keys: DataFrame,
    sketched: Callable[[DataFrame], DataFrame],
    words: int,
    verify: Callable[[DataFrame], DataFrame],
    most_apart: Callable[[Column, Column], Column],
    pair_fits: Callable[[Column, Column, Column], Column],
    listed: DataFrame | None = None,
) -> DataFrame:
    """(node, comp) of the components of verified links among nodes that share a key.

    ``keys`` has key, node, n (the set's size) and pos (the key's place among the node's, which
    all nodes order alike). ``sketched`` gives of nodes, or of more, a parity sketch of ``words`` 64-bit words:
    every member of the node's set flips one bit. ``verify`` returns the links among pairs (x, y).
    ``most_apart`` says of two sizes how many members two linked sets may not share (-1 if they can't link).
    ``pair_fits`` says of the smaller and the larger size and of the room (the lesser of n - pos)
    whether two nodes of a key may link. Both only rule out what can't be. With ``listed``, shared keys were found
    already: it has the pairs (x, y) of keys with up to ``FEW`` nodes, and their sizes (n, m); ``keys`` has the rows of larger ones only.

    A key that two rows have is its own pair, seen in the one aggregation over all rows.
    Of keys with up to ``FEW`` nodes all pairs are listed. Each node of larger keys is verified
    with one hub first: of the hubs of its keys, the nodes that have least of their own and
    share most, the one whose sketch is nearest. What links is contracted, round by round. Only then
    are the pairs of a key listed that still lie in different components and
    whose sketches don't rule them out, under the first key that both have. So a large group of near
    copies is a star and not all its pairs, every pair that could join two components is
    verified, and none a second time.
    """
    with Scratch(keys.sparkSession) as scratch:
        if listed is None:
            met = keys.groupBy("key").agg(
                F.count(F.lit(1)).alias("c"), F.min("node").alias("x"), F.max("node").alias("y"),
                F.min("n").alias("n"), F.max("n").alias("m"), F.min(F.col("n") - F.col("pos")).alias("room"),
            )
            met = met.where(F.col("x") != F.col("y")).where((F.col("c") > 2) | pair_fits(F.col("n"), F.col("m"), F.col("room")))
            met = scratch.written(met.select("key", "c", "x", "y", "n", "m"), "shared")
            more = met.where("c > 2").select("key")
            narrow = likely(keys, "key", more, "key").groupBy("key", "node").agg(F.max("n").alias("n"), F.min("pos").alias("pos"))
            narrow = scratch.written(narrow.join(more, "key", "left_semi"), "narrow")
            crowded = scratch.written(narrow.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > FEW), "crowded")

            few = narrow.join(crowded, "key", "left_anti")
            near = scratch.written(
                met.where("c = 2").select("x", "y", "n", "m").unionByName(_near_pairs(few, F.lit(True), pair_fits)).distinct(), "near"
            )
            scratch.drop(met)
            many = scratch.written(narrow.join(crowded, "key"), "many")
            scratch.drop(narrow)
        else:
            near = scratch.written(listed.distinct(), "near")
            narrow = scratch.written(keys.groupBy("key", "node").agg(F.max("n").alias("n"), F.min("pos").alias("pos")), "narrow")
            many = scratch.written(narrow.join(narrow.groupBy("key").agg(F.count(F.lit(1)).alias("c")), "key"), "many")
            scratch.drop(narrow)
        ends = [near.select(F.col(end).alias("node")) for end in ("x", "y")]
        sketches = sketched(ends[0].union(ends[1]).union(many.select("node")).distinct())
        side = lambda end: sketches.select(F.col("node").alias(end), F.col("sketch").alias(f"s{end}"))
        apart_by = apart(F.col("sx"), F.col("sy"), words)
        pairs = near.join(side("x"), "x").join(side("y"), "y").where(apart_by <= most_apart(F.col("n"), F.col("m"))).select("x", "y")

        # A node's rank: how many keys come before its first shared one, and then how many nodes share its keys.
        own = many.groupBy("node").agg(
            F.min("pos").alias("r"), (-F.sum("c")).alias("k"), F.slice(F.sort_array(F.collect_list(F.struct("pos", "key"))), 1, FIRST)["key"].alias("first")
        )
        ranked = many.join(own, "node").join(sketches, "node")
        rows = scratch.written(ranked.select(
            "key", "node", "n", "pos", F.struct("r", "k", "node", "n", "sketch").alias("at"),
            F.slice("first", 1, F.coalesce(F.nullif(F.array_position("first", F.col("key")), F.lit(0)) - 1, F.size("first").cast("long")).cast("int")).alias("before"),
        ), "many")
        scratch.drop(many)
        far = apart(F.col("at.sketch"), F.col("hub.sketch"), words)

        def nearest_hub(rows: DataFrame, turn: int, other: str) -> DataFrame:
            """Each node with the nearest hub of its keys, as pairs (x, y)."""
            salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(HUBS))
            hubs = rows.groupBy("key", salt.alias("salt")).agg(F.min(F.struct("at.*", *rows.columns[4:])).alias("hub")).select("key", "hub")
            met = rows.join(hubs, "key").where(other).where(far <= most_apart(F.col("at.n"), F.col("hub.n")))
            best = F.min(F.struct(far.alias("d"), F.col("hub.r").alias("r"), F.col("hub.k").alias("k"), F.col("hub.node").alias("hub")))
            return _ordered(met.groupBy("node").agg(best.alias("best")).select(F.col("node").alias("x"), F.col("best.hub").alias("y")))

        before = "struct(at.r, at.k, at.node) > struct(hub.r, hub.k, hub.node)"
        stars = nearest_hub(rows.select("key", "node", "n", "at"), 0, before)
        tried = scratch.written(_ordered(pairs).unionByName(stars).distinct(), "pairs")
        scratch.drop(near)
        comps = connected(verify(tried), scratch)

        def open_rows(rows: DataFrame) -> DataFrame:
            """Rows with their components now, of keys whose nodes lie in several."""
            placed = rows.select("key", "node", "n", "at", "pos", "before").join(comps, "node", "left")
            placed = placed.select("key", "node", "n", "at", F.coalesce("comp", "node").alias("comp"), "pos", "before")
            open_ = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            out = scratch.written(placed.join(open_.where("lo <> hi").select("key"), "key"), "open")
            scratch.drop(rows)
            return out

        rows = open_rows(rows)
        for turn in range(1, ROUNDS):
            if rows.isEmpty():
                return written(comps, "comps")
            # Another hub each, in another component.
            again = nearest_hub(rows.select("key", "node", "n", "at", "comp"), turn, "comp <> hub.comp").distinct()
            again = scratch.written(again.join(tried, ["x", "y"], "left_anti"), "stars")
            comps = _widened(comps, verify(again), scratch)
            tried = tried.unionByName(again)
            rows = open_rows(rows)
        unlike = (F.col("a.comp") != F.col("b.comp")) & ~F.arrays_overlap("a.before", "b.before")
        unlike &= apart(F.col("a.at.sketch"), F.col("b.at.sketch"), words) <= most_apart(F.col("a.n"), F.col("b.n"))
        left = _ordered(_near_pairs(rows, unlike, pair_fits)).distinct()
        left = scratch.written(left.join(tried, ["x", "y"], "left_anti"), "pairs")
        return written(comps if left.isEmpty() else _widened(comps, verify(left), scratch), "comps")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))


def _near_pairs(rows: DataFrame, also: Column, pair_fits: Callable) -> DataFrame:
    """(x, y, n, m) of nodes that share a key and may link; n is the smaller size."""
    a, b = rows.alias("a"), rows.alias("b")
    n, m = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    fits = pair_fits(n, m, F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")))
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & fits & also
    return a.join(b, on).select(F.col("a.node").alias("x"), F.col("b.node").alias("y"), n.alias("n"), m.alias("m"))


def _widened(comps: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``comps`` with what ``links`` (x, y) among their nodes join. What they link are components, and few of them."""
    ends = links
    for end in ("x", "y"):
        of = comps.select(F.col("node").alias(end), F.col("comp").alias(f"{end}_comp"))
        ends = ends.join(of, end, "left").withColumn(f"{end}_comp", F.coalesce(f"{end}_comp", end))
    wider = connected(ends.select(F.col("x_comp").alias("x"), F.col("y_comp").alias("y")), scratch)
    of = wider.select(F.col("node").alias("comp"), F.col("comp").alias("wide"))
    old = comps.join(of, "comp", "left").select("node", F.coalesce("wide", "comp").alias("comp"))
    return scratch.written(old.unionByName(wider.join(comps, "node", "left_anti")), "comps")
