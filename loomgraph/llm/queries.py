"""The queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import exact_dedup, html_extract, language, line_dedup, media, mixing, near_join, packing, quality, url_filter
from loomgraph.llm.common import table

#: Rules of the url query, (verdict, host and path).
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts. Null is empty; of repeated rows each has its row; ties go to the largest id; other columns aren't read."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's language and score. Null or without a letter: und; ties go to the first language by name; nothing but the text is read for it."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line that isn't blank with the line of its group that stays. Null and empty texts have no lines; the smallest (doc_id, line_no) stays."""
    return line_dedup.line_groups(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's expected grade and tail probabilities, learned outside the held-out fold. Null is empty; repeated rows are rated each."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    taught = labels.where(~language.held_out(F.col("doc_id")))
    ratings = taught.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    rated = quality.rate(docs, quality.fit(docs, ratings))
    return rated.withColumn("held_out", language.held_out(F.col("doc_id")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's size and the words that the mix takes of it. Null has size 0; repeated rows count each; ties go by seeded order."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's payload as a WAV file, what is read back and the digest of its peaks. Null is empty; equal texts have equal values."""
    return media.with_media(table(spark, sf_dir, "documents"), digest=True)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece with its place in a sequence. Null is empty: the end id alone; repeated rows have places of their own."""
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's set size and component. Null, empty and blank texts have no set and link with nothing; the smallest id names a component."""
    return near_join.near_components(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's host, path, rule and verdict. Null and urls without :// have empty host and path; the longest rule wins."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's main text by its host's wrapper. Null is empty; repeated rows are read each."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP9_SQL = r"""
WITH rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), j AS (
  SELECT u.*, h || p AS r, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS k
  FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, r AS rule, coalesce(v, 'allow') AS verdict FROM j WHERE k = 1
"""


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, ways.y FROM reach JOIN ways ON reach.r = ways.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, count(*) OVER (PARTITION BY component_id) AS n_docs
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_language": op2_language,
        "op3_line_dedup": op3_line_dedup,
        "op4_quality": op4_quality,
        "op5_mixing": op5_mixing,
        "op6_media": op6_media,
        "op7_packing": op7_packing,
        "op8_ngram_join": op8_ngram_join,
        "op9_url_filter": op9_url_filter,
        "op10_html": op10_html,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op8_ngram_join": OP8_SQL, "op9_url_filter": OP9_SQL}
