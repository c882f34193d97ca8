"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import WORD, written

#: Documents in a shard, as planned, and the most shards of one source.
SHARD_DOCS, MOST_SHARDS = 256, 4096


def _apportion(parts: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """Sainte-Lague: give each group's ``seats`` to the highest quotients votes / (2 a + 1).

    For a group of m parts with n seats and shares q of them, a part's result lies in
    [q (1 - m / 2n) - 1/2, q (1 + m / 2n) + 1/2]. Seats below that range are certain;
    only the quotients inside it are listed and ranked, about 3 m rows a group
    whatever the number of seats. Ties go by ``key``.
    """
    total = Window.partitionBy(*group)
    shared = (
        parts.withColumn("_all", F.sum(votes).over(total))
        .withColumn("_m", F.count(F.lit(1)).over(total))
        .withColumn("_q", F.when(F.col("_all") > 0, F.col(votes) * F.col(seats) / F.col("_all")).otherwise(F.lit(0.0)))
        .withColumn("_d", F.when(F.col(seats) > 0, F.col("_m") / (2.0 * F.col(seats))).otherwise(F.lit(0.0)))
        .withColumn("_sure", F.greatest(F.lit(0), F.floor(F.col("_q") * (1 - F.col("_d")) - 0.5) - 1).cast("long"))
        .withColumn("_most", (F.ceil(F.col("_q") * (1 + F.col("_d")) + 0.5) + 1).cast("long"))
    )
    listed = (
        shared.withColumn("_left", F.col(seats) - F.sum("_sure").over(total))
        .where(F.col(votes) > 0)
        .withColumn("_a", F.explode(F.expr("sequence(_sure, _most)")))
        .withColumn("_quotient", F.col(votes) / (2 * F.col("_a") + 1))
        .withColumn("_rank", F.row_number().over(total.orderBy(F.desc("_quotient"), *key, "_a")))
    )
    won = listed.groupBy(*dict.fromkeys([*group, *key])).agg(F.sum((F.col("_rank") <= F.col("_left")).cast("long")).alias("_won"))
    keys = list(dict.fromkeys([*group, *key]))
    won = won.select(*[F.col(c).alias(f"_of_{c}") for c in keys], "_won")
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return shared.join(won, on, "left").select(
        *parts.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("quota")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    most: float = 2.0,
    block_words: int = 64,
    seed: int = 7,
) -> DataFrame:
    """Words to take of each document so that the sources meet their target weights.

    Returns doc_id, size (words), source_size, target (of the source), taken, copies (the
    times that the document's first word is taken: for mixes of whole documents) and
    source. The
    sources in order of code point, null last, weigh ``weights`` in turn and share
    ``budget`` times all words; no target exceeds ``most`` times its source, the rest
    is shared again by weight. Null text has size 0. Repeated rows count each. An
    empty table gives no rows; extra columns are ignored.

    The targets become equal blocks of words, apportioned to sources and then to each
    source's shards (hash of id and size) by Sainte-Lague. A shard is a circle of its
    documents in seeded order; its quota is an arc of whole blocks from a seeded start,
    at most ``most`` times round, so no document is taken more often than that and a
    shard misses its quota by no part of a block. Shards keep about ``SHARD_DOCS``
    documents, so a hot source is many windows, not one; only sources (one row each)
    and shards meet in windows over a whole group.
    """
    sized = written(
        docs.select(
            "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
        ),
        "sized",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    one = Window.partitionBy("_one")
    ranked = (
        sources.withColumn("_one", F.lit(1))
        .withColumn("_i", F.row_number().over(one.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int")))
        .withColumn("_total", F.sum("source_size").over(one) * budget)
        .withColumn("_cap", F.col("source_size") * most)
    )
    # The level at which min(cap, level * weight) sums to the total: in order of cap / weight,
    # a source is full while the level that the sources from it on would get reaches its cap.
    order = one.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        ranked.withColumn("_before", F.coalesce(F.sum("_cap").over(order), F.lit(0.0)))
        .withColumn("_weight", F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(order), F.lit(0.0)))
        .withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_weight"))
        .withColumn("_o", F.row_number().over(one.orderBy(F.col("_cap") / F.col("_w"), "_i")))
        .withColumn("_stop", F.min(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_o"))).over(one))
        .withColumn("_at", F.max(F.when(F.col("_o") == F.col("_stop"), F.col("_level"))).over(one))
        .withColumn("target", F.when(F.col("_o") >= F.col("_stop"), F.col("_at") * F.col("_w")).otherwise(F.col("_cap")))
        .withColumn("_least", F.min(F.when(F.col("target") > 0, F.col("target"))).over(one))
        .withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("_least") / 100))).cast("long"))
        .withColumn("_seats", F.round(F.sum("target").over(one) / F.col("_block")).cast("long"))
    )
    quotas = written(
        _apportion(levelled, ["_one"], ["source"], "target", "_seats")
        .withColumn("_shards", F.least(F.lit(MOST_SHARDS), F.ceil(F.col("_docs") / SHARD_DOCS)).cast("long"))
        .select(F.col("source").alias("_source"), "source_size", "target", "_block", F.col("quota").alias("_seats"), "_shards"),
        "quotas",
    )
    # The quotas are one row per source: joined by their key, split by AQE where a source is hot.
    dealt = sized.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_order", F.xxhash64(F.lit(seed), "doc_id", "size")
    ).withColumn("_shard", F.pmod("_order", F.col("_shards")))
    shards = dealt.groupBy("_source", "_shard").agg(
        F.sum("size").alias("_length"), F.first("_seats").alias("_seats"), F.first("_block").alias("_block")
    )
    arcs = _apportion(shards, ["_source"], ["_source", "_shard"], "_length", "_seats").select(
        F.col("_source").alias("_s"), F.col("_shard").alias("_k"), "_length",
        F.least(F.col("quota") * F.col("_block"), (F.col("_length") * most).cast("long")).alias("_arc"),
        F.when(F.col("_length") > 0, F.pmod(F.xxhash64(F.lit(seed), "_source", "_shard"), F.col("_length"))).otherwise(F.lit(0)).alias("_from"),
    )
    line = Window.partitionBy("_source", "_shard").orderBy("_order", "doc_id", "size")
    placed = dealt.withColumn("_start", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    here = placed.join(arcs, placed["_source"].eqNullSafe(arcs["_s"]) & (placed["_shard"] == arcs["_k"]))
    end = F.col("_from") + F.col("_arc")
    taken = copies = F.lit(0).cast("long")
    for turn in range(int(most) + 1):
        at = F.col("_start") + F.col("_length") * turn
        taken = taken + F.greatest(F.lit(0), F.least(at + F.col("size"), end) - F.greatest(at, F.col("_from")))
        copies = copies + ((at >= F.col("_from")) & (at < end)).cast("long")
    return here.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), copies.alias("copies"), "source"
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes the whole document (0 to 2 times by default).

    Rows of the same id, source and size are taken alike. A null or blank text has no words and is never taken.
    Columns of any name are kept; an empty table gives no rows.
    """
    times = mix_sources(docs, **how).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies")).where("copies > 0")
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    same = docs["doc_id"].eqNullSafe(times["doc_id"]) & docs["source"].eqNullSafe(times["source"]) & (size == times["size"])
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    return docs.join(times, same).select(row, F.explode(F.sequence(F.lit(1).cast("long"), times["copies"]))).select("row.*")
