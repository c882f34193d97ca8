"""Co-occurrence and path queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import stats
from loomgraph.operators import cooccur, paths
from loomgraph.plans import base
from loomgraph.plans.base import sql, table
from loomgraph.plans.catalog import query
from loomgraph.sources import graphs


@query(sql("sents", "SELECT s_start AS start_in_fulltext, s_end AS end_in_fulltext, pmid || '_s' || sent_no AS sent_id FROM sents"))
def sentence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.sentence_table(base.documents(spark, sf_dir))


@query(sql("mentions", "SELECT * FROM mentions"))
def surface_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.mentions(base.documents(spark, sf_dir), base.gazetteer(spark, sf_dir))


@query(sql("idx", "SELECT * FROM idx"))
def mention_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.index(spark, sf_dir)[0]


@query(sql("idx", "SELECT node_id AS mention_id, string_agg(sent_id, ';' ORDER BY sent_id) AS sent_ids FROM idx GROUP BY node_id"))
def mention_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.index_lines(base.index(spark, sf_dir)[0])


@query(sql("mentions", "SELECT DISTINCT entity_type, entity_type || ':' || id AS node_id, pmid FROM mentions"))
def pmid_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.pmid_index(base.mentions(base.documents(spark, sf_dir), base.gazetteer(spark, sf_dir)))


@query(sql("pairs", "SELECT * FROM pairs"))
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.contingency(*base.index(spark, sf_dir))


@query(sql("rated", "SELECT id1, entity1_type, id2, entity2_type, a, b, c, d, round(pvalue, 6) AS pvalue, round(adjP, 6) AS adjP, round(enrichment_score, 6) AS enrichment_score FROM rated"))
def significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = base.rated(spark, sf_dir)
    return r.withColumns({c: F.round(c, 6) for c in ("pvalue", "adjP", "enrichment_score")})


@query(sql("pairs", """
SELECT id1, id2, CASE WHEN a < n THEN round(greatest(-1.0, least(1.0, log2((a / n) / (((a + b) / n) * ((a + c) / n))) / -log2(a / n))), 6) END AS npmi
FROM (SELECT *, a + b + c + d AS n FROM pairs)"""))
def npmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cooccur.contingency(*base.index(spark, sf_dir))
    return t.select("id1", "id2", F.round(stats.npmi(*(F.col(c) for c in "abcd")), 6).alias("npmi"))


@query(sql("edges", "SELECT src, dst, round(weight, 6) AS weight FROM edges"))
def cooccur_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.graph_edges(spark, sf_dir).withColumn("weight", F.round("weight", 6))


@query(sql("edges", """
SELECT id, split_part(id, ':', 1) AS type, CASE WHEN type IN ('gene', 'species') THEN '' WHEN type = 'mutation' THEN substr(id, 10) ELSE coalesce(term, '') END AS name
FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges) LEFT JOIN (SELECT entity_type || ':' || id AS gid, min(term) AS term FROM gaz GROUP BY ALL) ON id = gid"""))
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = base.gazetteer(spark, sf_dir).groupBy("entity_type", "id").agg(F.min("term").alias("name")).withColumn("name_rank", F.lit(0))
    return cooccur.nodes(base.graph_edges(spark, sf_dir), names)


@query(sql("edges", "SELECT id, round(sum(weight), 6) AS strength FROM (SELECT src AS id, weight FROM edges UNION ALL SELECT dst, weight FROM edges) GROUP BY id"))
def node_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.node_strength(base.graph_edges(spark, sf_dir)).withColumn("strength", F.round("strength", 6))


@query(sql("edges", """
SELECT src, dst, round(weight / sqrt(x.s + y.s), 6) AS normalised FROM edges
JOIN (SELECT id, sum(weight) AS s FROM (SELECT src AS id, weight FROM edges UNION ALL SELECT dst, weight FROM edges) GROUP BY id) x ON src = x.id
JOIN (SELECT id, sum(weight) AS s FROM (SELECT src AS id, weight FROM edges UNION ALL SELECT dst, weight FROM edges) GROUP BY id) y ON dst = y.id"""))
def normalised_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.normalised_edges(base.graph_edges(spark, sf_dir)).select("src", "dst", F.round("normalised", 6).alias("normalised"))


# The typed graph of the path queries: parts, suppliers, customers and nations as entities.
_TYPED = """
typed AS (
  SELECT DISTINCT src, dst, weight FROM (
    SELECT 'gene:N' || n_nationkey AS src, 'disease:R' || n_regionkey AS dst, 2.0 + n_nationkey % 7 AS weight FROM nation
    UNION ALL SELECT 'chemical:S' || s_suppkey, 'gene:N' || s_nationkey, 1.0 + (s_suppkey % 97) FROM supplier
    UNION ALL SELECT 'gene:N' || n_nationkey, 'gene:N' || ((n_nationkey * 7 + 3) % 25), 3.0 + n_nationkey % 5 FROM nation WHERE n_nationkey < (n_nationkey * 7 + 3) % 25
  )
), tlinks AS (
  SELECT src, dst, max(weight)::DOUBLE AS weight, split_part(dst, ':', 1) AS dst_type FROM (
    SELECT src, dst, weight FROM typed UNION ALL SELECT dst, src, weight FROM typed) WHERE src <> dst GROUP BY ALL
)"""


def typed_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    name = lambda kind, c: F.concat(F.lit(kind), c.cast("string"))
    key, far = F.col("n_nationkey"), (F.col("n_nationkey") * 7 + 3) % 25
    edges = (
        n.select(name("gene:N", key).alias("src"), name("disease:R", F.col("n_regionkey")).alias("dst"), (2.0 + key % 7).alias("weight"))
        .unionByName(s.select(name("chemical:S", F.col("s_suppkey")).alias("src"), name("gene:N", F.col("s_nationkey")).alias("dst"), (1.0 + F.col("s_suppkey") % 97).alias("weight")))
        .unionByName(n.where(key < far).select(name("gene:N", key).alias("src"), name("gene:N", far).alias("dst"), (3.0 + key % 5).alias("weight")))
    )
    return paths.graph(edges, cooccur.nodes(edges))


_SHOW = "round(cost, 6) AS cost, round(combined_score, 6) AS combined_score"


def _path_sql(source: str, target: str | None, types: list[str] | None, k: int) -> str:
    """Two hops written out, with the filters of a hop's join."""
    kind = source.split(":")[0]
    goal = target.split(":")[0] if target else None

    def hop(n: int, at: str, seen: str, kinds: str) -> str:
        tests = [f"NOT list_contains({seen}, {at}.dst)", f"({at}.dst_type = 'gene' OR NOT list_contains({kinds}, {at}.dst_type))"]
        if types and len(types) > n:
            tests.append(f"{at}.dst_type = '{types[n]}'")
        if target:
            tests.append(f"({at}.dst = '{target}' OR {at}.dst_type <> '{goal}')")
        return " AND ".join(tests)

    end = f"WHERE nodes[-1] = '{target}'" if target else ""
    return f"""WITH {_TYPED.strip()}, h1 AS (
  SELECT ['{source}', x.dst] AS nodes, ['{kind}', x.dst_type] AS types, [x.weight] AS weights FROM tlinks x
  WHERE x.src = '{source}' AND {hop(1, "x", f"['{source}']", f"['{kind}']")}
), h2 AS (
  SELECT list_append(nodes, x.dst) AS nodes, list_append(types, x.dst_type) AS types, list_append(weights, x.weight) AS weights
  FROM h1 JOIN tlinks x ON nodes[-1] = x.src WHERE {hop(2, "x", "nodes", "types")} {f"AND nodes[-1] <> '{target}'" if target else ""}
), found AS (
  SELECT nodes, types, list_sum(list_transform(weights, lambda w: 1 / least(w, 80.0))) AS cost, length(weights) AS length,
    exp(list_sum(list_transform(weights, lambda w: ln(least(w, 80.0)))) / length(weights))
      + 2.5 * length(list_intersect(list_distinct(types), ['gene', 'chemical', 'disease', 'mutation', 'gene ontology', 'celltype'])) AS combined_score
  FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2) {end}
), pool AS (SELECT *, row_number() OVER (ORDER BY round(cost, 9), nodes) AS p FROM found)
SELECT rank, array_to_string(nodes, ' ') AS nodes, length, {_SHOW} FROM (
  SELECT *, row_number() OVER (ORDER BY round(combined_score, 9) DESC, nodes) AS rank FROM pool WHERE p <= {max(3 * k, 30)}
) WHERE rank <= {k}"""


def _paths(spark: SparkSession, sf_dir: str, source: str, target: str | None, types: list[str] | None, k: int) -> DataFrame:
    asked = spark.createDataFrame([(1, source, target, types)], "qid int, source string, target string, node_types array<string>")
    best = paths.top_paths(asked, *typed_graph(spark, sf_dir), k=k)
    return best.select(
        "rank", F.array_join("nodes", " ").alias("nodes"), "length", F.round("cost", 6).alias("cost"), F.round("combined_score", 6).alias("combined_score")
    )


@query(_path_sql("disease:R1", None, None, 10))
def paths_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, "disease:R1", None, None, 10)


@query(_path_sql("gene:N3", "disease:R4", None, 10))
def paths_source_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, "gene:N3", "disease:R4", None, 10)


@query(_path_sql("disease:R0", None, ["disease", "gene", "chemical"], 12))
def paths_type_guided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, "disease:R0", None, ["disease", "gene", "chemical"], 12)


@query(f"""WITH RECURSIVE {_TYPED.strip()}, walk AS (
  SELECT ['disease:R0'] AS nodes, 0.0::DOUBLE AS cost, 1 AS place
  UNION ALL
  SELECT list_append(nodes, dst), cost + weight, list_position(['disease', 'gene', 'chemical'], dst_type)
  FROM walk JOIN tlinks ON nodes[-1] = src
  WHERE length(nodes) <= 3 AND nodes[-1] <> 'chemical:S5' AND NOT list_contains(nodes, dst) AND coalesce(list_position(['disease', 'gene', 'chemical'], dst_type), 0) >= place
)
SELECT array_to_string(nodes, ' ') AS nodes, round(cost, 6) AS cost, length(nodes) - 1 AS length FROM walk WHERE nodes[-1] = 'chemical:S5'""")
def paths_ordered_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, links = typed_graph(spark, sf_dir)
    found = paths.ordered_paths(links, nodes, "disease:R0", "chemical:S5", ["disease", "gene", "chemical"], max_hop=3)
    return found.select(F.array_join("nodes", " ").alias("nodes"), F.round("cost", 6).alias("cost"), "length")


@query()
def path_subgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.createDataFrame([(1, "disease:R1", None, None)], "qid int, source string, target string, node_types array<string>")
    return paths.subgraph(paths.top_paths(asked, *typed_graph(spark, sf_dir)))[1]


@query("""
WITH pair AS (
  SELECT x.l_partkey AS p1, y.l_partkey AS p2, count(DISTINCT x.l_orderkey) AS a FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey
  GROUP BY ALL
)
SELECT p1, p2, a FROM pair WHERE a >= 2""")
def basket_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same self-join on the orders' baskets: pairs of parts in two orders or more."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").where("l_orderkey is not null and l_partkey is not null")
    return cooccur.shared_baskets(rows, "l_orderkey", "l_partkey").where("a >= 2").select(F.col("lo").alias("p1"), F.col("hi").alias("p2"), "a")
