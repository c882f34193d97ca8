"""Tags, spans and overlaps as Column expressions over arrays."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def bio_spans(tags: Column) -> Column:
    """first and last (token positions from 0) of the spans of a tag array.

    B opens a span and closes one that is open, O closes, I only extends: an I behind
    O is nothing. A span that is open at the end closes there.
    """
    n = F.size(tags)
    # A span ends before the next tag that isn't I.
    stop = lambda i: F.coalesce(
        F.filter(F.sequence(i + 1, n), lambda j: F.coalesce(F.get(tags, j), F.lit("O")) != "I")[0], n
    )
    opens = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(F.get(tags, i), F.lit("O")) == "B")
    return F.transform(opens, lambda i: F.struct(i.alias("first"), (stop(i) - 1).alias("last")))


def spans_to_bio(words: Column, spans: Column) -> Column:
    """A tag per word (start and end inclusive): B for a span's first word inside it, I for its others, else O.

    ``spans`` has start and end (exclusive). A word belongs to the first span that holds it whole.
    """
    def tag(w: Column) -> Column:
        holds = F.filter(spans, lambda s: (w["start"] >= s["start"]) & (w["end"] < s["end"]))
        span = holds[0]
        first = F.array_min(F.transform(F.filter(words, lambda x: (x["start"] >= span["start"]) & (x["end"] < span["end"])), lambda x: x["start"]))
        return F.when(F.size(holds) == 0, F.lit("O")).when(w["start"] == first, F.lit("B")).otherwise(F.lit("I"))

    return F.transform(words, tag)


def disjoint_places(starts: list[int], ends: list[int]) -> list[int]:
    """The places of the spans (half open) that overlap none kept before. The kept ones are held in order, so one of them is compared."""
    kept: list[tuple[int, int]] = []
    out = []
    for i, (start, end) in enumerate(zip(starts, ends)):
        at = bisect_left(kept, (end,))  # those before begin before this one's end; the last of them ends last
        if not at or kept[at - 1][1] <= start:
            insort(kept, (start, end))
            out.append(i)
    return out


def greedy_disjoint(spans: Column) -> Column:
    """Of structs that begin (-prob, -has_id, start, -end) those that overlap none kept before, in that order.

    ``spans`` is sorted (``array_sort``); a span is kept if it overlaps no kept one (half open).
    """

    @F.arrow_udf("array<int>")
    def places(starts: pa.Array, ends: pa.Array) -> pa.Array:
        return pa.array([disjoint_places(s or (), e or ()) for s, e in zip(starts.to_pylist(), ends.to_pylist())], pa.list_(pa.int32()))

    def kept(ordered: Column) -> Column:
        return F.transform(places(F.transform(ordered, lambda s: s["start"]), F.transform(ordered, lambda s: -s["neg_end"])), lambda i: F.get(ordered, i))

    return kept(spans)


def chunks(items: Column, size: int) -> Column:
    """The array in pieces of ``size``; an empty array has none."""
    return F.when(
        F.size(items) > 0,
        F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / F.lit(size)).cast("int") - 1), lambda i: F.slice(items, i * size + 1, size)),
    ).otherwise(F.slice(F.array(items), 1, 0))
