"""Best-two-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import written

MAX_TOKENS, END_ID, VOCABULARY = 4096, 1, "word_bpe_49k.json"
#: Entries of a worker's cache of chunk ids and characters of a cached chunk; beyond these, chunks are encoded each time.
CACHE, CACHED = 400_000, 48
#: Rows that number themselves within one (length, chunk) window, as planned.
CHUNK_ROWS = 2000

_encoders: dict[str, "Encoder"] = {}


class Encoder(dict):
    """Token ids of a text as little-endian bytes, the same as the tokenizer's own.

    The vocabulary's patterns never cross white space, so a text of plain characters
    (ASCII and Latin-1 letters, which neither NFC nor lower-casing composes) is encoded
    chunk by chunk between white space, each distinct chunk once. Any other text, and
    one with a special token's name, goes through the tokenizer whole.
    """

    plain = re.compile(r"[^\x09-\x0d\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]|<\|")
    pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z\xdf-\xf6\xf8-\xff0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces.findall(chunk):
            if not piece.isascii():
                piece = self.bytes.pre_tokenize_str(piece)[0][0]
            ids += [t.id for t in self.model.tokenize(piece)]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHE and len(chunk) <= CACHED:
            self[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if self.plain.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized_pieces(
    docs: DataFrame, vocabulary: str = VOCABULARY, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
    with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of every text: its ids and then ``end_id``, cut only where longer than ``max_tokens``.

    Null text is empty, so its one piece is the end id. ``vocabulary`` is the name of a
    public vocabulary file or a path. ``ids`` is there only ``with_ids``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))
    end = struct.pack("<I", end_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        encode = encoder(path).encode
        step = 4 * max_tokens
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[list] = [[] for _ in schema.names]
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = (encode(text.as_py()) if text.is_valid else b"") + end
                    for n, a in enumerate(range(0, len(ids), step)):
                        cut = ids[a : a + step]
                        values = [key, n, a // 4, len(cut) // 4, zlib.crc32(cut)]
                        if with_ids:
                            values.append(np.frombuffer(cut, "<u4").astype(np.int64))
                        for column, value in zip(rows, values):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return docs.select(id_col, text_col).mapInArrow(run, ddl)


def best_two_fit(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Bins for ``counts[n]`` items of length n, n up to the bin's size: (lengths, how many such bins).

    A bin takes the longest item left, then again and again the longest that fits its
    gap. Then its smallest item gives way to the two items left that together fill the
    widened gap more tightly, if any do. What a bin takes depends only on which lengths
    are left, so the same bin repeats until a length runs out: the work is bounded by
    the number of lengths and not by the number of items.
    """
    left = counts.astype(np.int64).copy()
    size = len(left) - 1
    lengths = np.arange(size + 1)
    bins: list[tuple[list[int], int]] = []

    def longest() -> np.ndarray:
        """For each gap, the longest length left that fits it, or 0."""
        return np.maximum.accumulate(np.where(left > 0, lengths, 0))

    fits = longest()
    while fits[size]:
        bin_, gap = [], size
        while gap and fits[gap]:
            n = int(fits[gap])
            times = min(int(left[n]), gap // n)
            bin_ += [n] * times
            left[n] -= times
            gap -= n * times
            if not left[n]:
                fits = longest()
        small, wide = bin_[-1], gap + bin_[-1]
        if len(bin_) > 1 or gap:
            first = lengths[1 : wide // 2 + 1]
            first = first[left[first] > 0]
            if len(first):
                second = fits[wide - first]
                alone = (second == first) & (left[first] < 2)
                pair = np.where(alone | (second < first), 0, first + second)
                k = int(pair.argmax())
                if pair[k] > small:
                    left[small] += 1
                    bin_[-1:] = [int(second[k]), int(first[k])]
                    left[bin_[-1]] -= 1
                    left[bin_[-2]] -= 1
        used = np.bincount(bin_, minlength=size + 1)
        kinds = np.flatnonzero(used)
        more = int((left[kinds] // used[kinds]).min())
        left -= used * more
        bins.append((bin_, 1 + more))
        fits = longest()
    return bins


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` in sequences of at most ``max_tokens``.

    Only the histogram of lengths (``max_tokens`` rows at most) reaches the driver; the
    packed bins come back as ranges of ranks, a table bounded by the lengths as well.
    Each piece then takes the place of its rank within its length. Ranks are counted in
    two steps, within hashed chunks and over chunks, so that a length which a third of
    all pieces have is many windows. Rows that are equal in all they carry share no
    place: each gets its own.
    """
    spark = pieces.sparkSession
    seen = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in seen:
        counts[row["length"]] = row["n"]
    chunks = int(max(8, min(1 << 16, counts.max() // CHUNK_ROWS + 1)))

    slots, rank, sequence = [], np.zeros(max_tokens + 1, np.int64), 0
    for lengths, times in best_two_fit(counts):
        offset = 0
        for n in lengths:
            slots.append((n, int(rank[n]), int(rank[n]) + times, sequence, offset))
            rank[n] += times
            offset += n
        sequence += times
    place = spark.createDataFrame(slots, "_length long, _from long, _to long, _first long, offset long")

    keyed = pieces.withColumn("_chunk", F.pmod(F.xxhash64(id_col, "piece"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("length", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("length", "_chunk").orderBy(id_col, "piece", "ids_crc32")
    ranked = (
        keyed.withColumn("_k", F.row_number().over(within) - 1)
        .join(starts, ["length", "_chunk"])
        .withColumn("_rank", F.col("_k") + F.col("_before"))
    )
    # place has a row per slot of a distinct bin: bounded by the number of lengths, not by the data.
    at = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return ranked.join(F.broadcast(place), at).select(
        *pieces.columns, (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset"
    )


def packed_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack whole ``docs``: one row per piece with its place."""
    pieces = written(tokenized_pieces(docs, vocabulary, max_tokens, with_ids=with_ids), "pieces")
    return pack(pieces, max_tokens)
