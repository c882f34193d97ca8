"""Queries of text functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions import spans, text
from loomgraph.plans.base import PIECES, clean_sql, sql, table
from loomgraph.plans.catalog import query

_CLEAN = clean_sql("coalesce(text, '')")
_PUNCTUATION = "!-/:-@\\[-`{-~"
#: The sentences of c.
_SPLIT = """string_split(regexp_replace(CASE WHEN length(c) < 3 THEN c ELSE regexp_replace(c[:-3], '([?!])', '\\1' || chr(1), 'g') || right(c, 2) END,
      '\\.( [A-Z"''-])', '.' || chr(1) || '\\1', 'g'), chr(1))"""


@query(f"SELECT doc_id, md5({_CLEAN}) AS digest FROM documents")
def clean_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_input(F.coalesce("text", F.lit("")))).alias("digest"))


@query("SELECT doc_id, md5(translate(text, chr(8232) || chr(8201) || chr(160) || chr(8239) || chr(65279), '     ')) AS digest FROM documents")
def normalise_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalise_blanks("text")).alias("digest"))


@query(f"""SELECT doc_id, len(p)::BIGINT AS pieces, len(list_filter(p, lambda t: t <> ' '))::BIGINT AS tokens, array_to_string(p, '') = c AS lossless
FROM (SELECT doc_id, c, regexp_extract_all(c, {PIECES}) AS p FROM (SELECT doc_id, {_CLEAN} AS c FROM documents))""")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.clean_input(F.coalesce("text", F.lit(""))).alias("c"))
    counts = text.let(text.pieces("c"), lambda p: F.struct(
        F.size(p).cast("long").alias("pieces"), F.size(F.filter(p, lambda t: t != " ")).cast("long").alias("tokens"),
        (F.array_join(p, "") == F.col("c")).alias("lossless"),
    ))
    return docs.select("doc_id", counts.alias("x")).select("doc_id", "x.*")


@query(f"""SELECT item_id, tok, (e - length(tok))::INT AS "start", (e - 1)::INT AS "end", CASE WHEN length(tok) > 20 THEN tok[:10] ELSE tok END AS shown FROM (
  SELECT item_id, tok, sum(length(tok)) OVER (PARTITION BY item_id ORDER BY k) AS e FROM (
    SELECT item_id, unnest(p) AS tok, generate_subscripts(p, 1) AS k FROM (SELECT item_id, regexp_extract_all({_CLEAN}, {PIECES}) AS p FROM benchmark)
  )) WHERE tok <> ' '""")
def token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.explode(text.token_spans(text.clean_input(F.coalesce("text", F.lit(""))))).alias("t"))
    return rows.select("item_id", "t.*", text.display_token(F.col("t.tok")).alias("shown"))


@query(f"""SELECT conv_id, turn, part AS sentence, (k - 1)::INT AS pos FROM (
  SELECT conv_id, turn, unnest(p) AS part, generate_subscripts(p, 1) AS k FROM (
    SELECT conv_id, turn, string_split(regexp_replace(CASE WHEN length(c) < 3 THEN c ELSE regexp_replace(c[:-3], '([?!])', '\\1' || chr(1), 'g') || right(c, 2) END,
      '\\.( [A-Z"''-])', '.' || chr(1) || '\\1', 'g'), chr(1)) AS p FROM (SELECT conv_id, turn, {_CLEAN} AS c FROM conversations)))""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = text.clean_input(F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(text.split_sentences(c)).alias("pos", "sentence"))


@query(sql("docs", f"""SELECT pmid, (row_number() OVER (PARTITION BY pmid ORDER BY src, k, j) - 1)::INT AS pos,
  CASE WHEN src = 1 AND k = 1 AND j = 1 THEN ' ' || sentence ELSE sentence END AS sentence
FROM (
  SELECT pmid, src, k, parts, unnest(cuts) AS sentence, generate_subscripts(cuts, 1) AS j, sum(len(cuts)) OVER (PARTITION BY pmid, src) AS all_cuts FROM (
    SELECT *, CASE WHEN whole OR solid <= 100 THEN [part] ELSE list_transform(range(0, cut), lambda i: array_to_string(raw[i * 200 + 1:i * 200 + 200], ''))
      || CASE WHEN trim(array_to_string(raw[cut * 200 + 1:], ''), ' ') = '' THEN [] ELSE [array_to_string(raw[cut * 200 + 1:], '')] END END AS cuts
    FROM (
      SELECT *, list_filter(range(1, (ceil(len(raw) / 200))::BIGINT + 1), lambda i: i = ceil(len(raw) / 200) OR len(list_filter(raw[i * 200 + 1:], lambda t: t <> ' ')) < 100)[1] AS cut
      FROM (
        SELECT *, regexp_extract_all(part, {PIECES}) AS raw, len(list_filter(regexp_extract_all(part, {PIECES}), lambda t: t <> ' ')) AS solid FROM (
          SELECT pmid, src, whole, parts, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM (
            SELECT pmid, src, src = 0 AND len(list_filter(regexp_extract_all(c, {PIECES}), lambda t: t <> ' ')) < 50 AS whole,
              CASE WHEN src = 0 AND len(list_filter(regexp_extract_all(c, {PIECES}), lambda t: t <> ' ')) < 50 THEN [c] ELSE {_SPLIT} END AS parts
            FROM (SELECT pmid, 0 AS src, title AS c FROM docs UNION ALL SELECT pmid, 1, abstract FROM docs WHERE abstract <> '')
          ))))))
WHERE NOT (all_cuts = 1 AND trim(sentence, ' ') = '')"""))
def tagger_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomgraph.plans.base import documents

    return documents(spark, sf_dir).select("pmid", F.posexplode(text.tagger_sentences("title", "abstract")).alias("pos", "sentence"))


@query(f"SELECT p_partkey, regexp_replace(lower(p_type || ' (' || p_name || '), #2'), '[ {_PUNCTUATION}]', '', 'g') AS tight, trim(regexp_replace(lower(p_type || ' (' || p_name || '), #2'), '[\\s{_PUNCTUATION}]+', ' ', 'g')) AS loose FROM part")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_type", F.lit(" ("), "p_name", F.lit("), #2"))
    return table(spark, sf_dir, "part").select("p_partkey", text.chemical_key(name).alias("tight"), text.basic_key(name).alias("loose"))


@query("""SELECT p_partkey, trim(regexp_replace(array_to_string(list_transform(string_split_regex(lower(p_name), '\\s+'),
  lambda t: CASE t WHEN 'blue' THEN 'azure' WHEN 'red' THEN 'crimson' ELSE t END), ' '), '[\\s!-,./:-@\\[-`{-~]+', ' ', 'g')) AS phrase FROM part""")
def clean_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = text.clean_phrase("p_name", typos={"blue": "azure", "red": "crimson"}, ignore="-")
    return table(spark, sf_dir, "part").select("p_partkey", phrase.alias("phrase"))


@query("""SELECT p_partkey, 'p|SUB|' || p_partkey AS id, p_brand AS gene, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS species FROM part""")
def variant_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lit("tmVar:p|SUB|"), F.col("p_partkey").cast("string"), F.lit(";CorrespondingGene:"), F.col("p_brand"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(";CorrespondingSpecies:"), F.col("p_size").cast("string"))).otherwise(F.lit("")),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", text.variant_attributes(raw).alias("a"))
    of = lambda k: F.try_element_at("a", F.lit(k))
    return rows.select("p_partkey", of("tmVar").alias("id"), of("CorrespondingGene").alias("gene"), of("CorrespondingSpecies").alias("species"))


@query("SELECT n_nationkey, unnest([n_name, CASE WHEN right(n_name, 1) = 's' THEN n_name[:-2] ELSE n_name || 's' END]) AS form FROM nation")
def number_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(text.number_variants(F.col("n_name"))).alias("form"))


@query(f"""SELECT item_id, tok, (e - length(tok))::INT AS "start", (e - 1)::INT AS "end" FROM (
  SELECT item_id, tok, sum(length(tok)) OVER (PARTITION BY item_id ORDER BY k) AS e FROM (
    SELECT item_id, unnest(p) AS tok, generate_subscripts(p, 1) AS k FROM (SELECT item_id, regexp_extract_all({_CLEAN}, '\\s+|\\S+') AS p FROM benchmark)
  )) WHERE trim(tok) <> ''""")
def words_with_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = text.clean_input(F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(text.words_with_spans(c)).alias("t")).select("item_id", "t.*")


@query(f"""SELECT conv_id, turn, i::INT AS chunk, array_to_string(list_slice(w, i * 30 + 1, i * 30 + 30), ' ') AS words FROM (
  SELECT conv_id, turn, w, unnest(range(0, ceil(len(w) / 30)::BIGINT)) AS i FROM (SELECT conv_id, turn, regexp_extract_all({_CLEAN}, '[^ ]+') AS w FROM conversations))""")
def word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_extract_all(text.clean_input(F.coalesce("text", F.lit(""))), F.lit("([^ ]+)"), 1)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w")).where(F.size("w") > 0)
    return rows.select("conv_id", "turn", F.posexplode(spans.chunks(F.col("w"), 30)).alias("chunk", "c")).withColumn("words", F.array_join("c", " ")).drop("c")


@query("""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events)
WHERE r <= floor(n * 0.25)""")
def head_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first quarter of each type."""
    w = Window.partitionBy("event_type")
    rows = table(spark, sf_dir, "events").select("event_type", "event_id")
    rows = rows.withColumn("r", F.row_number().over(w.orderBy("event_id"))).withColumn("n", F.count(F.lit(1)).over(w))
    return rows.where(F.col("r") <= F.floor(F.col("n") * 0.25)).select("event_type", "event_id")


@query("""WITH q AS (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate))::DATE, max(o_orderdate)::DATE, INTERVAL 3 MONTH))::DATE AS first FROM orders)
SELECT first, (first + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS last, (SELECT count(*) FROM orders WHERE o_orderdate::DATE BETWEEN first AND first + INTERVAL 3 MONTH - INTERVAL 1 DAY) AS hits FROM q""")
def quarter_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar quarters that cover the dates, with what each holds."""
    from loomgraph.sources.literature import quarter_windows as quarters

    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    hits = dates.groupBy(F.trunc("d", "quarter").alias("first")).agg(F.count(F.lit(1)).alias("hits"))
    windows = quarters(dates.agg(F.min("d").alias("first"), F.max("d").alias("last")))
    return windows.join(hits, "first", "left").select("first", "last", F.coalesce("hits", F.lit(0)).alias("hits"))


@query(sql("docs", "SELECT pmid, pmid || '|t|' || CASE WHEN title = '' THEN '- No text -' ELSE title END || chr(10) || pmid || '|a|' || CASE WHEN abstract = '' THEN '- No text -' ELSE abstract END AS block FROM docs"))
def pubtator_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomgraph.plans.base import documents
    from loomgraph.sources.literature import pubtator_block

    return documents(spark, sf_dir).select("pmid", pubtator_block().alias("block"))


@query(sql("docs", "SELECT pmid, title, abstract FROM docs"))
def pubtator_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomgraph.plans.base import documents
    from loomgraph.sources.literature import parse_documents, pubtator_block

    return parse_documents(documents(spark, sf_dir).select(pubtator_block().alias("value"))).where("error is null").select("pmid", "title", "abstract")
