"""Graph files: edge lists, node lists, mention indexes, sentence tables, relation schemas, path queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="src string, dst string, weight double")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", schema="id string, name string")
    return rows.select("id", text.node_type("id").alias("type"), F.coalesce("name", F.lit("")).alias("name"))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="start_in_fulltext int, end_in_fulltext int, sent_id string")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """entity_type, node_id, sent_id, ord: the node's line number, so that order of appearance is kept.

    The number is that of the line in the file; a file of an index is one node a line.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    parts = F.split("line", "\t")
    rows = lines.where("ord > 0 and line <> ''").select("ord", F.get(parts, F.lit(0)).alias("node_id"), F.explode(F.split(F.get(parts, F.lit(1)), ";")).alias("sent_id"))
    return rows.select(text.node_type("node_id").alias("entity_type"), "node_id", "sent_id", "ord").dropDuplicates(["node_id", "sent_id"])


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """Distinct unordered pairs of types with flag 1."""
    rows = spark.read.csv(path, sep="\t", schema="a string, b string, allowed int")
    return rows.where("allowed = 1").select(F.least("a", "b").alias("type_lo"), F.greatest("a", "b").alias("type_hi")).distinct()


def read_path_queries(spark: SparkSession, path: str) -> DataFrame:
    """qid, source, target, node_types from lines ``source|target|type+type``; empty parts are null."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    part = lambda i: F.nullif(F.trim(F.get(F.split("value", r"\|"), F.lit(i))), F.lit(""))
    return rows.select(
        F.xxhash64("value").alias("qid"), part(0).alias("source"), part(1).alias("target"), F.split(part(2), r"\+").alias("node_types")
    )


def write_edges(edges: DataFrame, path: str) -> None:
    edges.select("src", "dst", "weight").write.csv(path, sep="\t", mode="overwrite")


def write_nodes(nodes: DataFrame, path: str) -> None:
    nodes.select("id", "name").write.csv(path, sep="\t", mode="overwrite", emptyValue="")


def write_sentences(sentences: DataFrame, path: str) -> None:
    sentences.select("start_in_fulltext", "end_in_fulltext", "sent_id").write.csv(path, sep="\t", header=True, mode="overwrite")


def index_lines(index: DataFrame, key: str = "sent_id") -> DataFrame:
    """mention_id and its sentence (or document) ids joined by ``;``, as the index file has them."""
    ids = F.array_join(F.array_sort(F.collect_set(key)), ";")
    return index.groupBy(F.col("node_id").alias("mention_id")).agg(ids.alias(f"{key}s"))


def write_index(index: DataFrame, path: str, key: str = "sent_id") -> None:
    index_lines(index, key).write.csv(path, sep="\t", header=True, mode="overwrite")


def write_contingency(rated: DataFrame, path: str) -> None:
    """All tested pairs, unfiltered, 11 columns."""
    columns = ["id1", "entity1_type", "id2", "entity2_type", "a", "b", "c", "d", "pvalue", "adjP", "enrichment_score"]
    rated.select(*columns).write.csv(path, sep="\t", header=True, mode="overwrite")


def write_paths(paths: DataFrame, path: str) -> None:
    """A JSON object per query with its paths in order of rank."""
    per = F.sort_array(F.collect_list(F.struct("rank", *[c for c in paths.columns if c not in ("qid", "rank")])))
    paths.groupBy("qid").agg(per.alias("top_k_paths")).write.json(path, mode="overwrite")
