"""Command line over files: acquire, recognise, merge, normalise, index, graph, paths and evaluation."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import cooccur, evaluate, mentions, normalise, paths, tagger
from loomgraph.sources import graphs, literature
from loomgraph.sources.tables import stored


def acquire(spark: SparkSession, a: argparse.Namespace) -> None:
    """MEDLINE records to PubTator blocks, of the listed ids only if there is a list."""
    docs = literature.read_medline(spark, a.input)
    if a.pmids:
        docs = docs.join(literature.read_pmids(spark, a.pmids), "pmid", "left_semi")
    literature.write_pubtator(docs.select(literature.pubtator_block().alias("block")), a.output)


def recognise(spark: SparkSession, a: argparse.Namespace) -> None:
    """Mentions of dictionaries' single words (type=path), through the tagger's windows and decoding."""
    docs = cooccur.with_sentences(literature.parse_documents(literature.read_blocks(spark, a.input)).where("error is null").drop("error"))
    names = literature.read_catalogue(spark, _by_type(a.dictionaries)).where(F.size(F.split("name", " ")) == 1)
    terms = {r["name"]: r["entity_type"] for r in names.select("name", "entity_type").distinct().collect()}  # word lists
    heads = tuple(sorted(set(terms.values())))
    found = tagger.tag(docs, heads, tagger.dictionary_scorer(heads, terms), window=a.window).withColumn("id", F.lit(None).cast("string"))
    docs.select("pmid", "title", "abstract").join(literature.entity_map(found), "pmid", "left").write.json(a.output, mode="overwrite")


def _by_type(pairs: list[str]) -> dict[str, str]:
    return {kind: path for kind, _, path in (p.partition("=") for p in pairs)}


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """A model's mentions with gene and variant annotations, and their abbreviations."""
    tagged = literature.read_documents_json(spark, a.input)
    docs = cooccur.with_sentences(tagged.select("pmid", "title", "abstract"))
    genes, variants = (literature.parse_annotations(literature.read_blocks(spark, p)) for p in (a.genes, a.variants))
    found = mentions.merge_annotations(docs, literature.mention_rows(tagged).drop("is_neural_normalized"), genes, variants)
    columns = ["pmid", "entity_type", "start", "end", "mention", "prob", "id"]
    spread = mentions.spread_abbreviations(docs, found.select(*columns), mentions.define_abbreviations(docs))
    docs.select("pmid", "title", "abstract").join(literature.entity_map(spread), "pmid", "left").write.json(a.output, mode="overwrite")


def normalise_mentions(spark: SparkSession, a: argparse.Namespace) -> None:
    """Dictionary ids and overlaps; dictionaries as type=path."""
    tagged = literature.read_documents_json(spark, a.input, lines=True)
    names = literature.read_catalogue(spark, _by_type(a.dictionaries))
    rows = literature.mention_rows(tagged)
    found = normalise.normalise(rows, names) if a.nearest else normalise.exact_ids(rows, names)
    found = normalise.resolve_overlaps(found)
    tagged.select("pmid", "title", "abstract").join(literature.entity_map(found), "pmid", "left").write.json(a.output, mode="overwrite")


def index(spark: SparkSession, a: argparse.Namespace) -> None:
    """Encoded names of dictionaries in cells, to search for the nearest."""
    names = normalise.short_names(literature.read_catalogue(spark, _by_type(a.dictionaries))).withColumn("nid", F.struct("entity_type", "id", "name"))
    normalise.write_index(normalise.embedded(names.select("nid", "entity_type", "name"), "name"), a.output, a.cells)


def evaluate_names(spark: SparkSession, a: argparse.Namespace) -> None:
    """acc@k of concept files against a training dictionary, by sparse, dense or both scores; candidates as JSON."""
    names = literature.read_training_dictionary(spark, a.dictionary).distinct().withColumn("nid", F.xxhash64("cui", "name"))
    asked = literature.read_concepts(spark, a.input).distinct().withColumn("query", F.xxhash64("mention", "cui"))
    parts = F.split("mention", r"\|")  # the mentions of a composite one
    asked = asked.select("query", F.col("cui").alias("golden"), F.posexplode(parts).alias("mention_no", "mention")).withColumn("qid", F.xxhash64("query", "mention_no"))
    both = stored(names.select("nid", "name").unionByName(asked.select(F.col("qid").alias("nid"), F.col("mention").alias("name"))), "names")
    sparse = dense = None
    if a.mode != "dense":
        weights = stored(normalise.tfidf(both), "tfidf")
        side = lambda of, key: weights.join(of.select(F.col(key).alias("nid")).distinct(), "nid", "left_semi")
        sparse = normalise.sparse_scores(side(asked, "qid"), side(names, "nid"))
    if a.mode != "sparse":
        dense = normalise.nearest(normalise.embedded(asked.select("qid", "mention"), "mention"), normalise.embedded(names.select("nid", "name"), "name"), k=20 * a.k)
    scores = evaluate.hybrid_scores(sparse, dense, a.weight) if a.mode == "hybrid" else sparse if a.mode == "sparse" else dense
    found = stored(evaluate.predictions(asked, evaluate.top_candidates(scores, names, a.k)), "predictions")
    evaluate.write_predictions(found, f"{a.output}/predictions")
    evaluate.write_metrics(evaluate.accuracies(found, a.k), f"{a.output}/metrics")


def evaluate_spans(spark: SparkSession, a: argparse.Namespace) -> None:
    """Precision, recall and f1 of annotated PubTator files against gold ones, by type."""
    rows = lambda path: literature.parse_annotations(literature.read_blocks(spark, path)).select(
        F.lit("all").alias("corpus"), F.col("subtype").alias("entity_type"), "pmid", "start", "end"
    )
    table = evaluate.score_table(rows(a.gold), rows(a.input).withColumn("system", F.lit("given")))
    table.coalesce(1).write.mode("overwrite").csv(a.output, header=True, sep="\t")


def graph(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sentence table, mention index, tested pairs, edges and nodes."""
    tagged = literature.read_documents_json(spark, a.input, lines=True)
    docs = cooccur.with_sentences(tagged.select("pmid", "title", "abstract"))
    index = stored(cooccur.mention_index(docs, literature.mention_rows(tagged)), "index")
    rated = stored(cooccur.significance(cooccur.contingency(index, docs.agg(F.sum(F.size("sents")).cast("long").alias("n")))), "pairs")
    edges = cooccur.edges(rated)
    graphs.write_sentences(cooccur.sentence_table(docs), f"{a.output}/sentences")
    graphs.write_index(index, f"{a.output}/index")
    graphs.write_contingency(rated, f"{a.output}/pairs")
    graphs.write_edges(edges, f"{a.output}/edges")
    graphs.write_nodes(cooccur.nodes(edges), f"{a.output}/nodes")


def find_paths(spark: SparkSession, a: argparse.Namespace) -> None:
    """Top-K paths of one query or of a file of queries."""
    nodes, links = paths.graph(graphs.read_edges(spark, f"{a.input}/edges"), graphs.read_nodes(spark, f"{a.input}/nodes"))
    if a.queries:
        asked = graphs.read_path_queries(spark, a.queries)
    else:
        asked = spark.createDataFrame([(1, a.source, a.target, a.types.split("+") if a.types else None)], "qid long, source string, target string, node_types array<string>")
    graphs.write_paths(paths.top_paths(asked, nodes, links, a.k, a.max_hop, a.min_hop), a.output)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loomgraph", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for name, run, options in (
        ("acquire", acquire, ["--pmids"]), ("merge", merge, ["--genes", "--variants"]), ("normalise", normalise_mentions, []),
        ("graph", graph, []), ("paths", find_paths, ["--queries", "--source", "--target", "--types"]),
        ("recognise", recognise, []), ("index", index, []), ("eval-names", evaluate_names, []), ("eval-spans", evaluate_spans, []),
    ):
        p = commands.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        if name != "index":
            p.add_argument("input")
        p.add_argument("output")
        for option in options:
            p.add_argument(option)
        if name in ("normalise", "recognise", "index"):
            p.add_argument("dictionaries", nargs="+")
        if name == "normalise":
            p.add_argument("--nearest", action="store_true")
        if name == "recognise":
            p.add_argument("--window", type=int, default=tagger.WINDOW)
        if name == "index":
            p.add_argument("--cells", type=int, default=64)
        if name == "eval-spans":
            p.add_argument("gold")
        if name == "eval-names":
            p.add_argument("dictionary")
            p.add_argument("--mode", choices=("sparse", "dense", "hybrid"), default="hybrid")
            p.add_argument("--weight", type=float, default=1.0)
            p.add_argument("-k", type=int, default=10)
        if name == "paths":
            for option, value in (("-k", 10), ("--max-hop", 2), ("--min-hop", 1)):
                p.add_argument(option, type=int, default=value)
    args = parser.parse_args(argv)
    args.run(SparkSession.builder.appName("loomgraph").getOrCreate(), args)


if __name__ == "__main__":
    main()
