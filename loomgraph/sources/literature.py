"""Literature formats: search windows, MEDLINE records, PubTator blocks, dictionaries, corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import spans, text

NO_TEXT = ("- No text -", "-NoAbstract-")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """value and file: the blocks between blank lines; the last one needs none behind it."""
    raw = spark.read.option("lineSep", "\n\n").text(path).select("value", F.col("_metadata.file_name").alias("file"))
    # Files with \r\n have no \n\n: such a piece is parted here.
    raw = raw.select(F.explode(F.split("value", "\r\n\r\n")).alias("value"), "file")
    return raw.where(F.trim(F.regexp_replace("value", "[\r\n]", "")) != "")


def _body(line: Column, mark: str) -> Column:
    body = F.regexp_extract(line, rf"(?s)^[^|]*\|{mark}\|(.*)$", 1)
    return F.when(F.trim(body).isin(*NO_TEXT), "").otherwise(body)


def parse_documents(blocks: DataFrame) -> DataFrame:
    """pmid, title, abstract, error of PubTator blocks: ``pmid|t|title`` and ``pmid|a|abstract``.

    More bars belong to the text. A block of another form has an error and no texts; one
    without title and abstract is left out.
    """
    lines = F.split(F.regexp_replace(F.col("value"), r"^\n+|\n+$", ""), "\r?\n")
    rows = blocks.select(F.get(lines, F.lit(0)).alias("t"), F.coalesce(F.get(lines, F.lit(1)), F.lit("")).alias("a"))
    good = F.col("t").rlike(r"^[^|]*\|t\|") & F.col("a").rlike(r"^[^|]*\|a\|")
    same = F.substring_index("t", "|", 1) == F.substring_index("a", "|", 1)
    out = rows.select(
        F.substring_index("t", "|", 1).alias("pmid"), F.when(good & same, _body(F.col("t"), "t")).alias("title"),
        F.when(good & same, _body(F.col("a"), "a")).alias("abstract"),
        F.when(~good, "not a title and an abstract line").when(~same, "ids of title and abstract differ").alias("error"),
    )
    return out.where(F.col("error").isNotNull() | (F.col("title") != "") | (F.col("abstract") != ""))


def parse_annotations(blocks: DataFrame) -> DataFrame:
    """pmid, start, end, mention, subtype, id of the tab rows of PubTator blocks, by start; a missing id is empty."""
    lines = F.slice(F.split(F.col("value"), "\r?\n"), 3, 1 << 30)
    rows = blocks.select(F.explode(F.filter(lines, lambda x: x.contains("\t"))).alias("line")).select(F.split("line", "\t").alias("c"))
    at = lambda i: F.get("c", F.lit(i))
    return rows.where(F.size("c") >= 5).select(
        at(0).alias("pmid"), at(1).cast("int").alias("start"), at(2).cast("int").alias("end"), at(3).alias("mention"),
        at(4).alias("subtype"), F.coalesce(at(5), F.lit("")).alias("id"),
    )


def text_blocks(rows: DataFrame, column: str = "value") -> DataFrame:
    """value: the blocks of strings that hold PubTator text, for the readers of blocks."""
    parts = rows.select(F.explode(F.split(F.col(column), r"(?:\r?\n){2,}")).alias("value"))
    return parts.where(F.trim(F.regexp_replace("value", "[\r\n]", "")) != "")


def variants_of_text(rows: DataFrame, column: str = "value", kinds: tuple[str, ...] = ("ProteinMutation", "DNAMutation", "SNP")) -> tuple[DataFrame, DataFrame]:
    """Documents and the variant mentions of PubTator text in a column: of the three kinds, with six columns."""
    blocks = text_blocks(rows, column)
    found = parse_annotations(blocks).where(F.col("subtype").isin(*kinds) & (F.col("id") != ""))
    return parse_documents(blocks), found


def annotated_json(blocks: DataFrame) -> DataFrame:
    """pmid, json: PubTator blocks with annotations as PubAnnotation: text and denotations with their ids."""
    return pubannotation(parse_documents(blocks).where("error is null"), parse_annotations(blocks).withColumnRenamed("subtype", "entity_type"))


def bio_of_blocks(blocks: DataFrame, entity_type: str | None = None) -> DataFrame:
    """pmid, words (tok, start, end inclusive) and labels of annotated blocks, of one type or all."""
    docs = parse_documents(blocks).where("error is null")
    found = parse_annotations(blocks)
    if entity_type:
        found = found.where(F.col("subtype") == entity_type)
    spans_of = found.groupBy("pmid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    words = docs.join(spans_of, "pmid", "left").select("pmid", text.token_spans(F.concat_ws(" ", "title", "abstract")).alias("words"), "spans")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return words.select("pmid", "words", spans.spans_to_bio(F.col("words"), F.coalesce("spans", none)).alias("labels"))


def tool_json(rows: DataFrame, column: str = "value") -> DataFrame:
    """pmid, start, end, mention and id of a web tagger's JSON: an array of documents with annotations; ``Mutation:`` before an id goes."""
    kind = "array<struct<sourceid:string,text:string,annotations:array<struct<obj:string,span:struct<begin:int,`end`:int>>>>>"
    docs = rows.select(F.explode(F.from_json(column, kind)).alias("d")).select("d.sourceid", "d.text", F.explode("d.annotations").alias("a"))
    begin, end = F.col("a.span.begin"), F.col("a.span.end")
    return docs.select(
        F.col("sourceid").alias("pmid"), begin.alias("start"), (end + 1).alias("end"), F.substr("text", begin + 1, end - begin).alias("mention"),
        F.replace(F.col("a.obj"), F.lit("Mutation:"), F.lit("")).alias("id"),
    )


def read_labels(spark: SparkSession, path: str | None = None) -> list[str]:
    """The labels of a list, one a line, with O first where it is missing; without a list O, B, I."""
    if not path:
        return ["O", "B", "I"]
    found = [r["value"].strip() for r in spark.read.text(path).collect() if r["value"].strip()]
    return found if "O" in found else ["O", *found]


def read_catalogue(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The dictionaries of several entity types as one table."""
    found = [read_dictionary(spark, path, kind) for kind, path in sorted(paths.items())]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def write_pmids(df: DataFrame, path: str) -> None:
    """pmid, and pmcid where there is one, parted by tabs."""
    df.select("pmid", *[c for c in ("pmcid",) if c in df.columns]).write.mode("overwrite").csv(path, sep="\t")


def pubtator_block(title: str = "title", abstract: str = "abstract", pmid: str = "pmid") -> Column:
    filled = lambda c: F.when(F.col(c) == "", NO_TEXT[0]).otherwise(F.col(c))
    return F.concat(F.col(pmid), F.lit("|t|"), filled(title), F.lit("\n"), F.col(pmid), F.lit("|a|"), filled(abstract))


def pubtator_annotated(docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """pmid, block: documents with their mentions as tab rows by start; ids parted by tabs come out with bars."""
    row = F.struct(
        "start", "end", F.concat_ws("\t", "pmid", F.col("start").cast("string"), F.col("end").cast("string"), "mention", "entity_type",
                                    F.translate(F.coalesce("id", F.lit("")), "\t", "|")).alias("line"),
    )
    lines = mentions.groupBy("pmid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["line"]), "\n").alias("rows"))
    return docs.join(lines, "pmid", "left").select("pmid", F.concat_ws("\n", pubtator_block(), "rows").alias("block"))


def write_pubtator(blocks: DataFrame, path: str) -> None:
    blocks.select("block").write.option("lineSep", "\n\n").text(path, compression="none")


def pubannotation(docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """pmid, json: text and denotations sorted by begin and object, with the time in UTC."""
    row = F.struct(
        F.struct(F.col("start").alias("begin"), F.col("end").alias("end")).alias("span"), F.col("entity_type").alias("obj"),
        F.split(F.coalesce("id", F.lit("")), r"\|").alias("id"),
    )
    rows = mentions.groupBy("pmid").agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("b"), F.col("entity_type").alias("o"), row.alias("d")))).alias("d"))
    text_ = F.concat_ws(" ", "title", "abstract")
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "EEE MMM dd HH:mm:ss 'UTC' yyyy")
    joined = docs.join(rows, "pmid", "left")
    return joined.select("pmid", F.to_json(F.struct(
        text_.alias("text"), F.lit("PubMed").alias("sourcedb"), F.col("pmid").alias("sourceid"), stamp.alias("timestamp"),
        F.coalesce(F.transform("d", lambda x: x["d"]), F.array()).alias("denotations"),
    )).alias("json"))


def read_medline(spark: SparkSession, path: str) -> DataFrame:
    """pmid, title, abstract (cleaned) of MEDLINE tagged records; those without both texts are left out."""
    field = lambda tag: F.trim(F.regexp_replace(F.regexp_extract("value", rf"(?ms)^{tag}\s*- (.*?)(?=^[A-Z]{{2,4}}\s*- |\z)", 1), r"\s*\n\s*", " "))
    rows = read_blocks(spark, path).select(field("PMID").alias("pmid"), field("TI").alias("title"), field("AB").alias("abstract"))
    return rows.withColumns({c: text.cut_long_words(text.clean_input(c)) for c in ("title", "abstract")}).where("title <> '' or abstract <> ''")


def read_dictionary(spark: SparkSession, path: str, entity_type: str) -> DataFrame:
    """entity_type, id, name_rank, name, line_no from ``id||name|name`` lines; blank lines don't count.

    A dictionary is one file; line numbers are its own.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).where(F.trim("line") != "")
    parts = F.split("line", r"\|\|", 2)
    rows = lines.select("line_no", F.get(parts, F.lit(0)).alias("id"), F.posexplode(F.split(F.get(parts, F.lit(1)), r"\|")).alias("name_rank", "name"))
    return rows.where(F.col("name").isNotNull()).select(F.lit(entity_type).alias("entity_type"), "id", "name_rank", "name", "line_no")


def read_training_dictionary(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\|\|", 2)
    return spark.read.text(path).where(F.trim("value") != "").select(F.get(parts, F.lit(0)).alias("cui"), F.get(parts, F.lit(1)).alias("name"))


def read_concepts(spark: SparkSession, path: str, composite: bool = False, unlinked: bool = False, repeated: bool = False) -> DataFrame:
    """mention, cui from ``.concept`` lines (fields 4 and 5 of ``||``); composite ids, ``-1`` and repeats only if asked for."""
    parts = F.split("value", r"\|\|")
    rows = spark.read.text(path).select(F.trim(F.get(parts, F.lit(3))).alias("mention"), F.translate(F.trim(F.get(parts, F.lit(4))), "+", "|").alias("cui"))
    rows = rows.where("mention is not null and cui is not null")
    if not composite:
        rows = rows.where(~F.col("cui").contains("|"))
    if not unlinked:
        rows = rows.where("cui <> '-1'")
    return rows if repeated else rows.dropDuplicates(["mention", "cui"])


def read_typos(spark: SparkSession, path: str) -> dict[str, str]:
    """A word list for correct_spelling, bounded by the file; a missing correction is empty."""
    parts = F.split("value", r"\|\|", 2)
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.get(parts, F.lit(0)).alias("k"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("v"))
    return {r["k"]: r["v"] for r in rows.collect()}


def read_conll(spark: SparkSession, path: str) -> DataFrame:
    """words and labels per sentence of token and label lines; a missing label is O, document marks part sentences."""
    lines = lambda c: F.filter(F.split(c, "\r?\n"), lambda x: (F.trim(x) != "") & ~x.startswith("-DOCSTART-"))
    rows = read_blocks(spark, path).select("file", lines(F.col("value")).alias("l")).where(F.size("l") > 0)
    part = lambda x: F.split(F.trim(x), r"\s+")
    return rows.select(
        "file", F.transform("l", lambda x: F.get(part(x), F.lit(0))).alias("words"),
        F.transform("l", lambda x: F.when(F.size(part(x)) > 1, F.element_at(part(x), -1)).otherwise("O")).alias("labels"),
    )


def read_documents_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Tagged documents: pmid, title, abstract and entities, a map of arrays."""
    mention = "start int, end int, mention string, prob double, id string, subtype string, is_neural_normalized boolean"
    schema = f"pmid string, title string, abstract string, entities map<string, array<struct<{mention.replace(' int', ':int').replace(' string', ':string').replace(' double', ':double').replace(' boolean', ':boolean')}>>>"
    return spark.read.option("multiLine", not lines).json(path, schema=schema)


def mention_rows(docs: DataFrame) -> DataFrame:
    """Documents' entities in long form; a probability that is no number is null."""
    rows = docs.select("pmid", F.explode("entities").alias("entity_type", "list")).select("pmid", "entity_type", F.explode("list").alias("m"))
    return rows.select("pmid", "entity_type", "m.*")


def entity_map(mentions: DataFrame) -> DataFrame:
    """pmid, entities: long rows as a map of arrays by start; empty ids are null."""
    more = [c for c in ("subtype", "is_neural_normalized") if c in mentions.columns]
    row = F.struct("start", "end", "mention", "prob", F.nullif("id", F.lit("")).alias("id"), *more)
    lists = mentions.groupBy("pmid", "entity_type").agg(F.array_sort(F.collect_list(row)).alias("l"))
    return lists.groupBy("pmid").agg(F.map_from_entries(F.collect_list(F.struct("entity_type", "l"))).alias("entities"))


def read_pmids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("pmid")).where("pmid <> ''").distinct()


def read_pmc_ids(spark: SparkSession, path: str) -> DataFrame:
    """pmid, pmcid from the mapping file's columns of those names."""
    return spark.read.csv(path, header=True).select(F.col("PMID").alias("pmid"), F.col("PMCID").alias("pmcid")).where("pmid is not null and pmcid is not null")


def with_pmc_ids(pmids: DataFrame, ids: DataFrame) -> DataFrame:
    return pmids.join(ids, "pmid", "left").withColumn("pmcid", F.coalesce("pmcid", F.lit("")))


def year_windows(first: int, hits: int, this_year: int) -> list[tuple[int, int]]:
    """Publication years to ask for at a time: none for up to 10,000 hits, which one question answers; up to 50,000 one
    long window and then pairs of years that overlap by one, beyond that blocks of five years before 2000 and then each year."""
    if hits <= 10_000:
        return []
    if hits <= 50_000:
        return [(first, 1999), *((y, y + 2) for y in range(2000, this_year, 2))]
    return [*((y, y + 4) for y in range(first, 2000, 5)), *((y, y) for y in range(2000, this_year + 1))]


def quarter_windows(range_: DataFrame) -> DataFrame:
    """first, last of the calendar quarters that cover each (first, last) of dates."""
    starts = F.explode(F.sequence(F.trunc("first", "quarter").cast("date"), F.col("last").cast("date"), F.expr("interval 3 months")))
    return range_.select(starts.alias("first")).distinct().withColumn("last", F.date_sub(F.add_months("first", 3), 1))


def batches(pmids: DataFrame, size: int = 500) -> DataFrame:
    """pmid, batch: about ``size`` ids each, by hash, so that a batch is the same on each run and nothing is ranked globally."""
    count = max(1, -(-pmids.count() // size))
    return pmids.withColumn("batch", F.pmod(F.xxhash64("pmid"), F.lit(count)))
