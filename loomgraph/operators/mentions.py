"""Mentions of several taggers merged, spread to every occurrence of their surface, and abbreviations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomgraph.functions import scan, text
from loomgraph.operators.relations import TOOL_TYPES
from loomgraph.sources.tables import stored

#: Mutation kinds that count, and words for humans that a species mention isn't, fixed values.
MUTATIONS = ("ProteinMutation", "DNAMutation", "SNP")
HUMAN_WORDS = (
    "person", "infant", "Child", "people", "participants", "woman", "Girls", "Man", "Peoples", "Men", "Participant", "Patients", "humans",
    "Persons", "mans", "participant", "Infants", "Boys", "Human", "Humans", "Women", "children", "Mans", "child", "Participants", "Girl",
    "Infant", "girl", "patient", "patients", "boys", "men", "infants", "man", "girls", "Children", "Boy", "women", "persons", "human",
    "Woman", "peoples", "Patient", "People", "boy", "Person",
)


def route_subtype(subtype: Column) -> Column:
    """The entity type of a gene tagger's subtype: CellLine and Gene as named, all else species."""
    kind = F.lower(subtype)
    return F.when(kind == "cellline", "cellline").when(kind == "gene", "gene").otherwise("species")


#: Terms up to which a dictionary is sent to every task.
SENT = 10_000


def dictionary_mentions(docs: DataFrame, terms: DataFrame, own: bool = False, sentences: bool = False) -> DataFrame:
    """Every place of a ``term`` in a content between other characters than ASCII letters and digits.

    Gives pmid, start, end (exclusive) and the columns of ``terms``; with ``own`` a term is looked for only in
    the document of its pmid. Places of a term that overlap count each; an empty or null term has none. With ``sentences`` also sent_no
    of the sentence that holds the place whole, null if none does.

    A content is cut into tokens once, in arrays; those whose hash no term's first token has (a table of fixed size) go
    there. A term meets the others by an equi-join on its first token, and only what follows that token is compared.
    """
    keyed = terms.withColumn("tok", F.get(text.pieces("term"), F.lit(0))).select(F.struct(*terms.columns).alias("t"), "tok", *["pmid"] * own)
    shape = terms.agg(F.max(F.size(text.pieces("term"))).alias("most"), F.count(F.lit(1)).alias("n")).first()
    most = shape["most"] or 0

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(scan.first_hashes(rows.column(0).drop_null())))], names=["h"])

    wanted = keyed.select("tok").where("tok <> ''").distinct().mapInArrow(hashed, "h long").distinct().toArrow()["h"].to_numpy()  # 2 ** 22 at most
    table = np.zeros(1 << scan.BITS, bool)
    table[wanted] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(table))
    ahead = most if most > 1 else 0
    columns = ["pmid", "tok", "start"] + ["ahead", "prev"] * (ahead > 0) + ["sent_no", "_from", "_to"] * sentences

    def heads_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(sent.value).astype(bool)
        for rows in batches:
            for at, found in scan.places(rows.column(1), table, ahead, sentences):
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(at)), *found], names=columns)

    kinds = ["tok string", "start int"] + ["ahead string", "prev string"] * (ahead > 0) + ["sent_no int", "_from int", "_to int"] * sentences
    schema = StructType([docs.schema["pmid"], *StructType.fromDDL(", ".join(kinds)).fields])
    heads = docs.select("pmid", "content").mapInArrow(heads_of, schema)
    met = heads.join(keyed if own or shape["n"] > SENT else F.broadcast(keyed), ["tok", *["pmid"] * own])
    if most > 1:
        letter = lambda c: F.coalesce(c.rlike("[0-9A-Za-z]"), F.lit(False))
        behind = F.substr("ahead", F.length("t.term") + 1, F.lit(1))
        met = met.where(F.startswith("ahead", "t.term") & ~letter(behind) & (letter(F.col("tok")) | ~letter(F.col("prev"))))
    end = F.col("start") + F.length("t.term")
    held = [F.when((F.col("_from") <= F.col("start")) & (end <= F.col("_to")), F.col("sent_no")).alias("sent_no")] * sentences
    return met.select("pmid", "start", end.alias("end"), *[f"t.{c}" for c in terms.columns if c != "pmid" or not own], *held)


def propagate_surfaces(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every word-bounded occurrence of each surface, with subtype and id of its first mention by start.

    Mentions of missing text go; a surface that never stands between word borders disappears. The surfaces are written once.
    """
    first = (
        found.where(~F.col("mention").contains("No text")).groupBy("pmid", "mention")
        .agg(F.min_by(F.struct("subtype", "id"), F.struct("start", "end")).alias("s"))
    )
    terms = stored(first.select("pmid", F.col("mention").alias("term"), "s.subtype", "s.id"), "surfaces")
    return dictionary_mentions(docs, terms, own=True).select("pmid", "start", "end", F.col("term").alias("mention"), "subtype", "id")


def merge_annotations(docs: DataFrame, model: DataFrame, genes: DataFrame, variants: DataFrame, tool_docs: DataFrame | None = None) -> DataFrame:
    """Mentions of the model and of both tools, in long form, for the documents of ``docs``.

    A model's ``end`` is inclusive and becomes exclusive, its mention is cut from the content. Gene
    rows are routed by subtype (cell lines lose their id), variant rows count only for the
    known kinds and take the value of ``tmVar`` as id. Documents whose content has another length at a
    tool (``tool_docs``: pmid, content) are dropped with all their mentions.
    """
    base = docs.select("pmid", "content")
    if tool_docs is not None:
        other = tool_docs.select("pmid", F.length("content").alias("_n"))
        base = base.join(other, "pmid", "left").where(F.col("_n").isNull() | (F.col("_n") == F.length("content"))).drop("_n")
    columns = ["pmid", "entity_type", "start", "end", "mention", "prob", "id", "subtype"]
    nothing = F.lit(None).cast("string")
    from_model = base.join(model, "pmid").withColumn("end", F.col("end") + 1).withColumn(
        "mention", F.expr("substring(content, start + 1, end - start)")
    ).withColumn("id", nothing).withColumn("subtype", nothing)
    kind = route_subtype(F.col("subtype"))
    from_genes = genes.join(base.select("pmid"), "pmid", "left_semi").withColumn("entity_type", kind).withColumn(
        "id", F.when(F.col("entity_type") != "cellline", F.nullif("id", F.lit("")))
    ).withColumn("prob", F.lit(None).cast("double"))
    from_variants = variants.where(F.col("subtype").isin(*MUTATIONS)).join(base.select("pmid"), "pmid", "left_semi").withColumn(
        "entity_type", F.lit("mutation")
    ).withColumn("id", F.try_element_at(text.variant_attributes("id"), F.lit("tmVar"))).withColumn("prob", F.lit(None).cast("double"))
    return from_model.select(*columns).unionByName(from_genes.select(*columns)).unionByName(from_variants.select(*columns))


def without_human_words(found: DataFrame) -> DataFrame:
    return found.where(~((F.col("entity_type") == "species") & F.col("mention").isin(*HUMAN_WORDS)))


def define_abbreviations(docs: DataFrame, longest: int = 10) -> DataFrame:
    """pmid, sf, lf: ``long form (SF)`` where the short form's letters occur in order, the first at a word's start.

    For a short form of n characters the long form is the shortest run of words before the
    bracket, of min(n + 5, 2 n) words at most, that matches from the right. The last definition of a short form in a
    document wins. All of it is array and regular expressions, in the JVM.
    """
    bracket = F.regexp_extract_all("content", F.lit(r"([^()]{1,200}\([A-Za-z0-9][A-Za-z0-9-]{1,9}\))"), 1)
    parts = docs.where(F.col("content").contains("(")).select("pmid", F.posexplode(bracket).alias("at", "part"))
    rows = parts.select(
        "pmid", "at", F.regexp_extract("part", r"\(([A-Za-z0-9-]+)\)$", 1).alias("sf"),
        F.trim(F.regexp_replace("part", r"\([A-Za-z0-9-]+\)$", "")).alias("before"),
    ).where((F.length("sf") <= longest) & F.col("sf").rlike("[A-Za-z]") & (F.col("before") != ""))
    letters = F.regexp_extract_all(F.regexp_replace(F.lower("sf"), "[^a-z0-9]", ""), F.lit("(.)"), 1)
    pattern = F.concat(F.lit("(?i)^"), F.array_join(letters, ".*?"), F.lit(".*$"))

    def shortest(words: Column) -> Column:
        most = F.least(F.length("sf") + 5, 2 * F.length("sf"), F.size(words))
        tail = lambda n: F.array_join(F.slice(words, F.size(words) - n + 1, n), " ")
        fits = lambda t: F.regexp_like(t, pattern) & (F.length(t) > F.length("sf")) & ~F.array_contains(F.split(t, " "), F.col("sf"))
        return F.get(F.filter(F.transform(F.sequence(F.lit(1), most), tail), fits), F.lit(0))

    found = rows.withColumn("lf", text.let(F.split("before", r"\s+"), shortest)).where("lf is not null")
    return found.groupBy("pmid", "sf").agg(F.max_by("lf", "at").alias("lf"))


def _overlaps(a: str, b: str) -> Column:
    return (F.col(f"{a}.start") < F.col(f"{b}.end")) & (F.col(f"{b}.start") < F.col(f"{a}.end"))


def spread_abbreviations(docs: DataFrame, found: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """``found`` (pmid, entity_type, start, end, mention, prob, id) with abbreviations of known long forms.

    A long form's type is that of the mention that holds it with least to spare, then of most
    confidence. Each occurrence of the short form (or its plural or singular) becomes a
    mention of that type unless one overlaps it; model mentions that do get the long form's
    confidence and its words. Mentions of other types go where they contain the short form as a word
    or overlap the long form. Every join is on the document, so none is a product.
    """
    content = docs.select("pmid", "content")
    listed = (
        abbreviations.join(content, "pmid").withColumn("lf", text.tighten_brackets(F.col("content"), F.col("lf")))
        .where((F.length("sf") >= 2) & F.col("content").contains(F.col("lf")))
    )
    places = listed.select("pmid", "sf", "lf", F.explode(text.occurrences(F.col("content"), F.col("lf"))).alias("o"))
    places = places.select("pmid", "sf", "lf", F.col("o.start").alias("start"), F.col("o.end").alias("end"))
    has = F.coalesce(F.col("m.id") != "", F.lit(False))
    from loomgraph.operators.normalise import default_confidence

    held = places.alias("p").join(found.alias("m"), "pmid").where("m.start <= p.start AND p.end <= m.end").select(
        "pmid", "sf", "lf", F.col("m.entity_type").alias("type"), F.col("m.id").alias("lf_id"),
        default_confidence(F.col("m.entity_type"), has, F.col("m.prob")).alias("lf_prob"),
        (F.col("m.end") - F.col("m.start") - F.length("lf")).alias("spare"),
    )
    best = Window.partitionBy("pmid", "sf").orderBy("spare", F.desc("lf_prob"), "type")
    status = held.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r", "spare")
    forms = status.withColumn("abbr", F.explode(text.number_variants(F.col("sf")))).where(F.length("abbr") >= 2)
    here = forms.join(content, "pmid").select(
        "pmid", "sf", "abbr", "lf", "type", "lf_id", "lf_prob", F.explode(text.occurrences(F.col("content"), F.col("abbr"))).alias("o")
    ).select("*", F.col("o.start").alias("start"), F.col("o.end").alias("end")).drop("o")

    tool = F.col("type").isin(*TOOL_TYPES)
    same = found.alias("m").join(here.alias("h"), "pmid").where((F.col("m.entity_type") == F.col("h.type")) & _overlaps("m", "h"))
    changed = same.where(~F.col("h.type").isin(*TOOL_TYPES)).groupBy("pmid", F.col("m.entity_type").alias("entity_type"), F.col("m.start").alias("start"), F.col("m.end").alias("end")).agg(
        F.max_by(F.struct("h.lf_prob", "h.abbr", "h.lf"), F.col("h.abbr")).alias("c")
    )
    gone_short = found.alias("m").join(forms.alias("h"), "pmid").where(
        (F.col("m.entity_type") != F.col("h.type")) & (F.size(text.occurrences(F.col("m.mention"), F.col("h.abbr"))) > 0)
    )
    gone_long = found.alias("m").join(places.join(status.select("pmid", "sf", "type"), ["pmid", "sf"]).alias("p"), "pmid").where(
        (F.col("m.entity_type") != F.col("p.type")) & _overlaps("m", "p")
    )
    key = ["pmid", "entity_type", "start", "end"]
    gone = gone_short.select("pmid", "m.entity_type", "m.start", "m.end").unionByName(gone_long.select("pmid", "m.entity_type", "m.start", "m.end")).distinct()
    kept = found.join(gone, key, "left_anti").join(changed, key, "left").select(
        *key, F.when(F.col("c").isNotNull(), F.expr("replace(mention, c.abbr, c.lf)")).otherwise(F.col("mention")).alias("mention"),
        F.coalesce("c.lf_prob", "prob").alias("prob"), "id",
    )
    free = here.join(same.select("pmid", F.col("h.type").alias("type"), F.col("h.start").alias("start"), F.col("h.end").alias("end")).distinct(), ["pmid", "type", "start", "end"], "left_anti")
    added = free.select(
        "pmid", F.col("type").alias("entity_type"), "start", "end", F.when(tool, F.col("abbr")).otherwise(F.col("lf")).alias("mention"),
        F.when(~tool, F.col("lf_prob")).alias("prob"), F.when(tool, F.col("lf_id")).alias("id"),
    ).dropDuplicates(["pmid", "entity_type", "start", "end"])
    return kept.unionByName(added)


def span_scores(gold: DataFrame, predicted: DataFrame, key: list[str]) -> DataFrame:
    """precision, recall and f1 of spans named by ``key``."""
    g, p = gold.select(*key).distinct(), predicted.select(*key).distinct()
    both = g.withColumn("_g", F.lit(1)).join(p.withColumn("_p", F.lit(1)), key, "full")
    n = both.agg(F.count("_g").alias("gold"), F.count("_p").alias("predicted"), F.count(F.expr("CASE WHEN _g = 1 AND _p = 1 THEN 1 END")).alias("right"))
    precision, recall = F.try_divide("right", "predicted"), F.try_divide("right", "gold")
    return n.select("gold", "predicted", "right", precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * F.col("right"), F.col("gold") + F.col("predicted")).alias("f1"))
