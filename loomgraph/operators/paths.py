"""Top-K path queries over a typed, weighted, undirected graph by exact enumeration of bounded hops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Weights count up to this much.
CAP = 80.0
#: Types that make a path worth more, fixed values, and how much each adds.
CORE = ("gene", "chemical", "disease", "mutation", "gene ontology", "celltype")
PER_CORE = 2.5


def graph(edge_rows: DataFrame, node_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, type, name) and edges in both directions with the type of the far end.

    Of edges listed twice the one of the larger weight counts.
    """
    both = edge_rows.select("src", "dst", "weight").unionByName(
        edge_rows.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    once = both.where("src <> dst").groupBy("src", "dst").agg(F.max("weight").alias("weight"))
    types = node_rows.select(F.col("id").alias("dst"), F.col("type").alias("dst_type"), F.col("name").alias("dst_name"))
    return node_rows, once.join(types, "dst", "left")


def enumerate_paths(queries: DataFrame, node_rows: DataFrame, links: DataFrame, max_hop: int = 2, min_hop: int = 1) -> DataFrame:
    """All simple paths of ``queries`` (qid, source, target, node_types) of min_hop to max_hop edges.

    ``target`` and ``node_types`` may be null. Position j of a path has type node_types[j]
    where that is given (the source is not checked). No node before the target has its
    type. A type other than gene occurs once at most. All this is tested in each hop's
    join, so what can't become a path is never carried on.
    """
    first = node_rows.select(F.col("id").alias("source"), F.col("type").alias("_type"), F.col("name").alias("_name"))
    goal = node_rows.select(F.col("id").alias("target"), F.col("type").alias("_goal"))
    front = (
        queries.join(first, "source").join(goal, "target", "left")
        .select("qid", "source", "target", "node_types", "_goal", F.array("source").alias("nodes"), F.array("_type").alias("types"),
                F.array("_name").alias("names"), F.array().cast("array<double>").alias("weights"), F.col("source").alias("_last"))
    )
    done = None
    for hop in range(1, max_hop + 1):
        guided = F.col("node_types").isNull() | (F.size("node_types") <= hop) | (F.get("node_types", F.lit(hop)) == F.col("dst_type"))
        fresh = ~F.array_contains("nodes", F.col("dst"))
        unlike = (F.col("dst_type") == "gene") | ~F.array_contains("types", F.col("dst_type"))
        short = F.col("target").isNull() | (F.col("dst") == F.col("target")) | (F.col("dst_type") != F.col("_goal"))
        on = (F.col("_last") == F.col("src")) & fresh & guided & unlike & short
        front = front.join(links, on).select(
            "qid", "source", "target", "node_types", "_goal",
            F.array_append("nodes", F.col("dst")).alias("nodes"), F.array_append("types", F.col("dst_type")).alias("types"),
            F.array_append("names", F.col("dst_name")).alias("names"), F.array_append("weights", F.col("weight")).alias("weights"),
            F.col("dst").alias("_last"),
        )
        if hop >= min_hop:
            ended = front.where(F.col("target").isNull() | (F.col("_last") == F.col("target")))
            done = ended if done is None else done.unionByName(ended)
        front = front.where(F.col("target").isNull() | (F.col("_last") != F.col("target")))
    return done


def scored(paths: DataFrame, core: tuple[str, ...] = CORE) -> DataFrame:
    """length, cost, semantic_score and combined_score of paths.

    cost is the sum of 1 / capped weight; the combined score is the geometric mean of
    the capped weights plus what the distinct core types add.
    """
    capped = F.transform("weights", lambda w: F.least(w, F.lit(CAP)))
    total = F.aggregate(capped, F.lit(0.0), lambda s, w: s + F.log(w))
    cost = F.aggregate(capped, F.lit(0.0), lambda s, w: s + 1 / w)
    kinds = F.size(F.array_intersect(F.array_distinct("types"), F.array(*map(F.lit, core))))
    return (
        paths.withColumn("length", F.size("weights")).withColumn("cost", cost)
        .withColumn("semantic_score", kinds * PER_CORE)
        .withColumn("combined_score", F.exp(total / F.size("weights")) + F.col("semantic_score"))
    )


def top_paths(queries: DataFrame, node_rows: DataFrame, links: DataFrame, k: int = 10, max_hop: int = 2, min_hop: int = 1) -> DataFrame:
    """The ``k`` best paths of each query: a pool of the max(3 k, 30) cheapest, ranked by combined score, ties by nodes."""
    found = scored(enumerate_paths(queries, node_rows, links, max_hop, min_hop))
    pool = F.row_number().over(Window.partitionBy("qid").orderBy("cost", "nodes"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("combined_score"), "nodes"))
    best = found.withColumn("_pool", pool).where(F.col("_pool") <= max(3 * k, 30)).withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(
        "qid", "rank", "nodes", "length", F.col("types").alias("node_types"), F.col("weights").alias("edge_weights"),
        F.col("names").alias("name"), "cost", "semantic_score", "combined_score",
    )


def subgraph(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct nodes and distinct undirected edges (weights capped) of paths."""
    parts = paths.select(F.explode(F.arrays_zip("nodes", "node_types", "name")).alias("p"))
    ids = parts.select(F.col("p.nodes").alias("id"), F.col("p.node_types").alias("label"), F.col("p.name").alias("name")).distinct()
    steps = F.transform(
        F.sequence(F.lit(1), F.size("edge_weights")),
        lambda i: F.struct(
            F.least(F.get("nodes", i - 1), F.get("nodes", i)).alias("src"), F.greatest(F.get("nodes", i - 1), F.get("nodes", i)).alias("dst"),
            F.least(F.get("edge_weights", i - 1), F.lit(CAP)).alias("weight"),
        ),
    )
    return ids, paths.select(F.explode(steps).alias("e")).select("e.*").distinct()


def ordered_paths(links: DataFrame, node_rows: DataFrame, source: str, target: str, types: list[str], max_hop: int = 4) -> DataFrame:
    """Simple paths whose types stay at or move on in ``types``, by total weight: cheapest first.

    A node of a type that isn't listed can't be passed. cost is the sum of the weights.
    """
    order = F.array(*map(F.lit, types))
    place = lambda c: F.array_position(order, c)  # noqa: E731  0: not listed
    front = node_rows.where((F.col("id") == source) & (place(F.col("type")) > 0)).select(
        F.array("id").alias("nodes"), F.lit(0.0).alias("cost"), F.col("id").alias("_last"), place(F.col("type")).alias("_at")
    )
    done = None
    for _ in range(max_hop):
        onward = (F.col("_last") == F.col("src")) & ~F.array_contains("nodes", F.col("dst")) & (place(F.col("dst_type")) >= F.col("_at"))
        front = front.join(links, onward).select(
            F.array_append("nodes", F.col("dst")).alias("nodes"), (F.col("cost") + F.col("weight")).alias("cost"),
            F.col("dst").alias("_last"), place(F.col("dst_type")).alias("_at"),
        )
        ended = front.where(F.col("_last") == target)
        done = ended if done is None else done.unionByName(ended)
        front = front.where(F.col("_last") != target)
    return done.select("nodes", "cost", (F.size("nodes") - 1).alias("length"))
