"""Exact deduplication by a 128-bit content hash, with bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import lower_ascii, written


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    fold_case: bool = True,
    hash_bits: int = 128,
) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows form a group when their texts are the same bytes (after A-Z is lowered, if
    ``fold_case``). A null text counts as the empty text. The row with the smallest
    (or ``keep="largest"``) id stays. Null ids are never chosen unless a group has no
    other; rows repeated with the same id are the same row, so all carry the same
    decision. Other columns of ``docs`` are ignored; an empty table gives no rows.

    Plan: partial aggregation on (hash, text) collapses copies before the shuffle and
    compares whole bytes, so a hot group is one row per task. Only hash, id and count
    then join back to the rows; a hash shared by different texts (a collision) sends
    those rows alone through a join on the text itself. ``hash_bits`` shortens the
    hash so that tests can force collisions.
    """
    pick = F.min if keep == "smallest" else F.max
    raw = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), (lower_ascii(raw) if fold_case else raw).alias("_t"))
    hashed = base.select("_id", "_t", F.unhex(F.sha2("_t", 256)).alias("_sha"))
    key: Column = F.substring("_sha", 1, hash_bits // 8)

    texts = hashed.groupBy(key.alias("_h"), "_t").agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = written(
        texts.groupBy("_h").agg(
            F.count(F.lit(1)).alias("_texts"), F.first("_keep").alias("_keep"), F.first("_n").alias("_n")
        ),
        "exact",
    )
    rows = hashed.select("_id", key.alias("_h"), "_sha")
    out = rows.join(groups.where("_texts = 1"), "_h").select("_id", "_sha", "_keep", "_n")

    collided = groups.where("_texts > 1").select("_h")
    if not collided.isEmpty():
        odd = hashed.withColumn("_h", key).join(collided, "_h", "left_semi")
        apart = odd.groupBy("_h", "_t").agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        out = out.unionByName(odd.join(apart, ["_h", "_t"]).select("_id", "_sha", "_keep", "_n"))
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with the columns of ``docs``, whatever their names.

    A null text counts as empty. Rows repeated with the same id and text collapse to one. An empty table gives no rows.
    """
    decided = written(exact_groups(docs, keep=keep).where("kept").select("doc_id", "text_sha256"), "kept")
    sha = F.sha2(lower_ascii(F.coalesce(docs["text"], F.lit(""))), 256)
    same = docs["doc_id"].eqNullSafe(decided["doc_id"]) & (sha == decided["text_sha256"])
    stay = docs.join(decided, same, "left_semi")
    repeated = decided.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return stay
    one = stay.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("id"), sha.alias("sha"))
    return one.dropDuplicates(["id", "sha"]).select("row.*")
