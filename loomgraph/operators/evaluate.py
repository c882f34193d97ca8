"""Evaluation of normalised names and of tagged spans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shares_id(golds: Column, ids: Column) -> Column:
    """Whether any id of one composite id (parted by bars or plus signs) is among the other's."""
    part = lambda c: F.split(F.translate(c, "+", "|"), r"\|")
    return F.coalesce(F.arrays_overlap(part(golds), part(ids)), F.lit(False))


def covers_ids(golds: Column, ids: Column) -> Column:
    """Whether every id of ``golds`` stands in ``ids``: the label of a training candidate."""
    return F.coalesce(F.forall(F.split(F.translate(golds, "+", "|"), r"\|"), lambda g: F.contains(ids, g)), F.lit(False))


def hybrid_scores(sparse: DataFrame, dense: DataFrame, weight: float) -> DataFrame:
    """qid, nid, score = weight * sparse + dense over the pairs that have either; what is missing counts 0."""
    both = sparse.select("qid", "nid", (weight * F.col("score")).alias("score")).unionByName(dense.select("qid", "nid", "score"))
    return both.groupBy("qid", "nid").agg(F.sum("score").alias("score"))


def top_candidates(scores: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """qid, rank, nid, cui, name, score of each query's ``k`` best, ties by name id: a partial top-k in each of some shares first."""
    best = lambda group: F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "nid"))), 1, k).alias(group)
    shares = scores.groupBy("qid", F.pmod(F.xxhash64("nid"), F.lit(64)).alias("share")).agg(best("part"))
    rows = shares.select("qid", F.explode("part").alias("c")).groupBy("qid").agg(F.slice(F.sort_array(F.collect_list("c")), 1, k).alias("all"))
    ranked = rows.select("qid", F.posexplode("all").alias("rank", "c")).select("qid", (F.col("rank") + 1).alias("rank"), "c.nid", (-F.col("c.s")).alias("score"))
    return ranked.join(names.select("nid", "cui", "name"), "nid")


def predictions(asked: DataFrame, candidates: DataFrame) -> DataFrame:
    """asked (query, mention_no, qid, mention, golden) with candidates: array of rank, name, cui and label (1: right) by rank."""
    label = shares_id(F.col("golden"), F.col("cui")).cast("int").alias("label")
    rows = asked.join(candidates, "qid", "left").select("query", "mention_no", "mention", "golden", F.struct("rank", "name", "cui", label).alias("c"))
    listed = rows.groupBy("query", "mention_no", "mention", "golden").agg(F.sort_array(F.collect_list(F.when(F.col("c.rank").isNotNull(), F.col("c")))).alias("candidates"))
    return listed


def accuracies(found: DataFrame, most: int) -> DataFrame:
    """One row with acc1 to acc``most``: the share of queries each of whose mentions has a right name that early."""
    first = F.coalesce(F.array_min(F.transform(F.filter("candidates", lambda c: c["label"] == 1), lambda c: c["rank"])), F.lit(most + 1))
    worst = found.groupBy("query").agg(F.max(first).alias("at"))
    return worst.agg(*[F.avg((F.col("at") <= k).cast("int")).alias(f"acc{k}") for k in range(1, most + 1)])


def score_table(golds: DataFrame, found: DataFrame, system: str = "system") -> DataFrame:
    """corpus, system, entity_type with precision, recall and f1 of spans (pmid, start, end), each by its own."""
    keys = ["corpus", "entity_type", "pmid", "start", "end"]
    right = found.select(system, *keys).distinct()
    counts = right.groupBy(system, "corpus", "entity_type").agg(F.count(F.lit(1)).alias("given"))
    hits = right.join(golds.select(*keys).distinct(), keys, "left_semi").groupBy(system, "corpus", "entity_type").agg(F.count(F.lit(1)).alias("hit"))
    wanted = golds.select(*keys).distinct().groupBy("corpus", "entity_type").agg(F.count(F.lit(1)).alias("wanted"))
    both = counts.join(hits, [system, "corpus", "entity_type"], "left").join(wanted, ["corpus", "entity_type"], "left").na.fill(0, ["hit", "wanted"])
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = share(F.col("hit"), F.col("given")), share(F.col("hit"), F.col("wanted"))
    return both.select("corpus", system, "entity_type", p.alias("precision"), r.alias("recall"), share(2 * p * r, p + r).alias("f1"))


def metric_lines(row: dict[str, object]) -> str:
    """Metrics as ``key = value`` lines by key."""
    return "".join(f"{k} = {row[k]}\n" for k in sorted(row))


def write_metrics(df: DataFrame, path: str) -> None:
    """The rows of a small table of metrics as text, one block of lines a row."""
    blocks: Iterable[str] = (metric_lines(r.asDict()) for r in df.collect())
    df.sparkSession.createDataFrame([(b,) for b in blocks], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_predictions(found: DataFrame, path: str) -> None:
    """One JSON object a query: its mentions with the candidates and their labels."""
    mention = F.struct("mention", F.col("golden").alias("golden_cui"), "candidates")
    found.groupBy("query").agg(F.transform(F.sort_array(F.collect_list(F.struct("mention_no", mention.alias("m")))), lambda x: x["m"]).alias("mentions")).write.mode("overwrite").json(path)

