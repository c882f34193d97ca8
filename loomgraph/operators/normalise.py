"""From surfaces to ontology ids: dictionary lookups, nearest names, and overlapping mentions resolved."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from loomgraph.functions import spans, text
from loomgraph.sources.tables import stored

#: Types that keep the id of their tool.
OWN_ID = ("gene", "species", "mutation")


def dictionary_keys(dictionary: DataFrame) -> DataFrame:
    """entity_type, key, id: of a name listed twice the last line (line_no) wins; chemicals by their tight key."""
    key = F.when(F.col("entity_type") == "chemical", text.chemical_key("name")).otherwise(F.col("name"))
    return dictionary.groupBy("entity_type", key.alias("key")).agg(F.max_by("id", "line_no").alias("id"))


def exact_ids(mentions: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``mentions`` with id: of the name as it stands, else in lower case; chemicals by their tight key; else null.

    Types with a tool's own id keep it. Each distinct surface is looked up once.
    """
    keys = dictionary_keys(dictionary)
    asked = mentions.where(~F.col("entity_type").isin(*OWN_ID)).select("entity_type", "mention").distinct()
    chemical = F.col("entity_type") == "chemical"
    asked = asked.withColumn("k1", F.when(chemical, text.chemical_key("mention")).otherwise(F.col("mention")))
    asked = asked.withColumn("k2", F.when(~chemical, F.lower("mention")))
    of = lambda n: keys.select("entity_type", F.col("key").alias(f"k{n}"), F.col("id").alias(f"id{n}"))
    found = asked.join(of(1), ["entity_type", "k1"], "left").join(of(2), ["entity_type", "k2"], "left")
    found = found.select("entity_type", "mention", F.coalesce("id1", "id2").alias("_id"))
    own = F.when(F.col("entity_type").isin(*OWN_ID), F.col("id"))
    return mentions.join(found, ["entity_type", "mention"], "left").withColumn("id", F.coalesce(own, "_id")).drop("_id")


def miss_rate(mentions: DataFrame) -> DataFrame:
    missing = F.avg(F.when(F.col("id").isNull(), 1.0).otherwise(0.0))
    return mentions.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), missing.alias("miss_rate"))


def hashed_ngrams(names: list[str], dim: int = 256, sizes: tuple[int, ...] = (2, 3)) -> np.ndarray:
    """The default encoder: signed counts of hashed character n-grams of the lower-case name, rows of length one."""
    out = np.zeros((len(names), dim))
    for row, name in zip(out, names):
        padded = f" {name.lower()} "
        for n in sizes:
            for i in range(len(padded) - n + 1):
                h = zlib.crc32(padded[i : i + n].encode("utf-8", "replace"))
                row[h % dim] += 1 - 2 * (h >> 31)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embedded(df: DataFrame, name: str, encoder: Callable[[list[str]], np.ndarray] = hashed_ngrams, batch: int = 1024) -> DataFrame:
    """``df`` with ``embedding``: the encoder's vector of the column ``name``, in batches; null is the empty name."""
    at, columns = df.columns.index(name), [*df.columns, "embedding"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, batch):
                part = rows.slice(start, batch)
                vectors = encoder([n or "" for n in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(vectors), pa.list_(pa.float64()))], names=columns)

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("embedding", ArrayType(DoubleType()))]))


def cell_centres(names: DataFrame, cells: int, rows_per_cell: int = 256) -> np.ndarray:
    """k-means centres of a sample of some ``rows_per_cell`` names a cell, by hash: bounded whatever the dictionary's size."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    share = min(1.0, cells * rows_per_cell / max(names.count(), 1))
    drawn = names.where(F.pmod(F.xxhash64("nid"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    model = KMeans(k=cells, seed=1, featuresCol="f").fit(drawn.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("f")))
    return np.array(model.clusterCenters())


def in_cells(df: DataFrame, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """``df`` (with embedding) once for each of the ``probes`` cells whose centres have the highest inner product."""
    sent = df.sparkSession.sparkContext.broadcast(centres)
    at, columns = df.columns.index("embedding"), [*df.columns, "cell"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                vectors = np.array(rows.column(at).to_pylist(), float)
                best = np.argsort(-(vectors @ sent.value.T), axis=1, kind="stable")[:, :probes]
                out = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), best.shape[1])))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(best.ravel().astype(np.int32))], names=columns)

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("cell", IntegerType())]))


#: Vectors of a block, queries that are multiplied at once, and queries up to which their blocks are sent to every task.
VECTORS, ROWS, ASKED = 4096, 512, 16_384


def vector_blocks(rows: DataFrame, id_: str, by: list[str]) -> DataFrame:
    """The columns ``by``, ids, dim and vectors (bytes of doubles) of runs of up to ``VECTORS`` rows equal in ``by`` and in length; dim is -1 where
    a vector or one of its numbers is null."""
    rows = rows.select(id_, F.col("embedding").cast("array<double>").alias("embedding"), *by)
    columns = [*by, "ids", "dim", "vectors"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            dims = np.asarray(lists.value_lengths().fill_null(-1)).copy()
            begins = np.concatenate([[0], np.cumsum(np.maximum(dims, 0))])
            flat = lists.flatten()
            if flat.null_count:
                dims[np.unique(np.searchsorted(begins, np.flatnonzero(np.asarray(flat.is_null())), "right") - 1)] = -1
            values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
            kinds: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(dims.tolist(), *(batch.column(2 + j).to_pylist() for j in range(len(by))))):
                kinds.setdefault(key, []).append(i)
            for (dim, *_), members in kinds.items():
                for at in range(0, len(members), VECTORS):
                    some = np.array(members[at : at + VECTORS])
                    data = values[begins[some][:, None] + np.arange(dim)] if dim > 0 else np.zeros(0)
                    of = [batch.column(2 + j).take(pa.array(some[:1])) for j in range(len(by))]
                    held = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), ids.take(pa.array(some)))
                    yield pa.RecordBatch.from_arrays([*of, held, pa.array([dim], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=columns)

    fields = [rows.schema[c] for c in by]
    held = [StructField("ids", ArrayType(rows.schema[id_].dataType)), StructField("dim", IntegerType()), StructField("vectors", BinaryType())]
    return rows.mapInArrow(run, StructType([*fields, *held]))


def best_of_blocks(q: np.ndarray, v: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row in ``q``, row in ``v`` and score of each query's ``k`` best by score (NaN first), then ``order``.

    A product of matrices finds all that may be among them; their scores are then summed number by number, so equal vectors have
    equal scores and ties are those of the plain sum.
    """
    found: list[list[np.ndarray]] = [[], [], []]
    reach = 1e-14 * (v.shape[1] + 8) * np.sqrt((v * v).sum(axis=1).max())
    for at in range(0, len(q), ROWS):
        some = q[at : at + ROWS]
        near = some @ v.T
        near[np.isnan(near)] = np.inf
        least = np.partition(near, len(v) - k, axis=1)[:, len(v) - k] if k < len(v) else np.full(len(some), -np.inf)
        slack = np.nan_to_num(reach * np.sqrt((some * some).sum(axis=1)), nan=0.0, posinf=0.0)
        rows, cols = np.nonzero(near >= (least - slack)[:, None])
        score = np.zeros(len(rows))
        for j in range(v.shape[1]):
            score += some[rows, j] * v[cols, j]
        best = np.lexsort((order[cols], np.where(np.isnan(score), -np.inf, -score), rows))
        nth = np.arange(len(best)) - np.searchsorted(rows[best], rows[best])
        best = best[nth < k]
        for out, x in zip(found, (rows[best] + at, cols[best], score[best])):
            out.append(x)
    return tuple(map(np.concatenate, found))


def nearest(
    queries: DataFrame, names: DataFrame, k: int = 1, cells: int = 0, probes: int = 2, group: str | None = None, centres: np.ndarray | None = None
) -> DataFrame:
    """The ``k`` names of highest inner product for each query, ties by name id: qid, nid, score, rank.

    ``queries`` has qid, embedding and ``names`` nid, embedding; with ``group``, a column of both, a query
    meets only names of its own. With ``cells`` (or the ``centres`` and the cell column of ``read_index``) the names fall into cells
    around k-means centroids and a query searches its ``probes`` best: an equi-join on the cell. Without,
    each query meets every name of its group (a stated query set), as products of blocks: no row of a pair is made
    but of each query's ``k`` best in a block.
    """
    by = [group] if group else []
    if cells and centres is None:
        centres = cell_centres(names, cells)
        names = in_cells(names, centres)
    if centres is not None:
        queries = in_cells(queries, centres, probes)
        by.append("cell")
    session = names.sparkSession
    if "cell" not in by:
        names = names.repartition(max(int(session.conf.get("spark.sql.shuffle.partitions")), 1))
    n = queries.count()
    asked = vector_blocks(queries.repartition(n // VECTORS + 1), "qid", by).select(*by, *[F.col(c).alias(f"q_{c}") for c in ("ids", "dim", "vectors")])
    listed = vector_blocks(names, "nid", by)
    asked, listed = (F.broadcast(asked), listed) if n <= ASKED else (stored(asked, "asked"), stored(listed, "listed"))
    both = listed.join(asked, by) if by else listed.crossJoin(asked)
    kinds = [queries.schema["qid"].dataType, names.schema["nid"].dataType]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, ids, q_dim, dim, q, v = (batch.column(i)[row] for i in range(6))
                q_ids, ids = q_ids.values, ids.values
                order = np.empty(len(ids), np.int64)
                order[pa.compute.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
                if dim.as_py() >= 0 and dim == q_dim:
                    matrix = lambda x, n: np.frombuffer(x.as_py(), float).reshape(n, dim.as_py())
                    rows, cols, score = best_of_blocks(matrix(q, len(q_ids)), matrix(v, len(ids)), order, k)
                    score = pa.array(score)
                else:  # no score, so the first ids
                    first = np.argsort(order)[:k]
                    rows, cols = np.repeat(np.arange(len(q_ids)), len(first)), np.tile(first, len(q_ids))
                    score = pa.nulls(len(rows), pa.float64())
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(rows)), ids.take(pa.array(cols)), score], names=["qid", "nid", "score"])

    schema = StructType([StructField("qid", kinds[0]), StructField("nid", kinds[1]), StructField("score", DoubleType())])
    scored = both.select("q_ids", "ids", "q_dim", "dim", "q_vectors", "vectors").mapInArrow(run, schema)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "nid")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def write_index(names: DataFrame, path: str, cells: int) -> None:
    """names (nid, embedding and more) with their cells, and the centres: an index that ``read_index`` gives back."""
    centres = cell_centres(names, cells)
    in_cells(names, centres).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/names")
    rows = [(i, c.tolist()) for i, c in enumerate(centres)]
    names.sparkSession.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """The names with their cells and the centres, to search with ``nearest(centres=...)``."""
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # one row a cell
    return spark.read.parquet(f"{path}/names"), np.array([r["centre"] for r in rows])


def short_names(names: DataFrame, most: int = 25) -> DataFrame:
    """Names of up to ``most`` tokens: what an encoder takes whole."""
    return names.where(F.size(text.tokens("name")) <= most)


def missing_id(id_: Column | str) -> Column:
    c = F.col(id_) if isinstance(id_, str) else id_
    return c.isNull() | c.isin("", "undefined", "CUI-less")


def nearest_ids(mentions: DataFrame, names: DataFrame, encoder: Callable[[list[str]], np.ndarray] = hashed_ngrams, cells: int = 0) -> DataFrame:
    """``mentions`` where a missing id is that of the nearest name of its type: id, and is_neural_normalized for these.

    ``names`` has entity_type, id, name. Types that keep their tool's id, and those without names, stay as they are. Each
    distinct surface is encoded and looked up once; of names with equal text the least id counts.
    """
    asked = mentions.where(missing_id("id") & ~F.col("entity_type").isin(*OWN_ID)).select("entity_type", "mention").distinct()
    asked = embedded(asked.withColumn("qid", F.struct("entity_type", "mention")), "mention", encoder)
    listed = short_names(names).groupBy("entity_type", "name").agg(F.min("id").alias("nid"))
    listed = listed.groupBy("entity_type", "nid").agg(F.collect_set("name").alias("names")).select("entity_type", "nid", F.explode("names").alias("name"))
    found = nearest(asked, embedded(listed, "name", encoder), 1, cells, group="entity_type")
    found = found.select(F.col("qid.entity_type").alias("entity_type"), F.col("qid.mention").alias("mention"), F.col("nid").alias("near_id"))
    joined = mentions.join(found, ["entity_type", "mention"], "left")
    fill = missing_id(joined["id"]) & F.col("near_id").isNotNull()
    return joined.select(
        *[F.when(fill, F.col("near_id")).otherwise(joined["id"]).alias("id") if c == "id" else joined[c] for c in mentions.columns if c != "is_neural_normalized"],
        fill.alias("is_neural_normalized"),
    )


#: How a type is normalised: by its tool, or by a dictionary's keys and then by the nearest name.
STEPS: dict[str, tuple[str, ...]] = dict.fromkeys(OWN_ID, ("tool",))


def normalise(mentions: DataFrame, dictionary: DataFrame, steps: dict[str, tuple[str, ...]] | None = None, encoder: Callable[[list[str]], np.ndarray] = hashed_ngrams) -> DataFrame:
    """``mentions`` with ids by the steps of their types: ("tool",), ("dictionary",) or, by default, ("dictionary", "nearest")."""
    plan = STEPS | (steps or {})
    exact = exact_ids(mentions, dictionary)
    only_exact = [t for t, s in plan.items() if "nearest" not in s]
    late = exact.where(~F.col("entity_type").isin(*only_exact)) if only_exact else exact
    rest = exact.where(F.col("entity_type").isin(*only_exact)) if only_exact else None
    found = nearest_ids(late, dictionary.select("entity_type", "id", "name"), encoder)
    return found if rest is None else found.unionByName(rest.withColumn("is_neural_normalized", F.lit(False)).select(*found.columns))


def default_confidence(entity_type: Column, has_id: Column, prob: Column) -> Column:
    """What a mention counts in overlaps: tools' by type and id, models' their own."""
    return (
        F.when(entity_type.isin("mutation", "species"), F.when(has_id, 1.0).otherwise(0.8))
        .when(entity_type == "cellline", 0.95)
        .when(entity_type == "gene", F.when(has_id, 0.95).otherwise(0.8))
        .otherwise(prob)
    )


def resolve_overlaps(mentions: DataFrame) -> DataFrame:
    """Mentions that stay: by confidence, then with an id, then early start, then late end, each unless it overlaps a kept one.

    The fold is over the mentions of one document, all types together, each compared with its neighbours among those kept; ties
    that are left go by type and id. ``prob`` comes out null for tools' types.
    """
    has = F.col("id").isNotNull() & ~F.col("id").isin("", "undefined", "CUI-less")
    sure = default_confidence(F.col("entity_type"), has, F.col("prob"))
    row = F.struct(
        (-sure).alias("neg_prob"), (-has.cast("int")).alias("neg_id"), "start", (-F.col("end")).alias("neg_end"),
        "entity_type", F.coalesce("id", F.lit("")).alias("id"), "mention", "prob",
    )
    ordered = mentions.groupBy("pmid").agg(F.array_sort(F.collect_list(row)).alias("all"))
    kept = ordered.select("pmid", F.explode(spans.greedy_disjoint(F.col("all"))).alias("m"))
    return kept.select(
        "pmid", "m.entity_type", F.nullif(F.col("m.id"), F.lit("")).alias("id"), "m.mention", "m.start", (-F.col("m.neg_end")).alias("end"), "m.prob"
    )


#: Classes of equal names up to which they are sent to every task; classes of a block, and cells of a block's matrix.
SENT, BLOCK, CELLS = 10_000, 512, 1 << 22


def _grams(name: Column, sizes: tuple[int, ...]) -> Column:
    def of(n: int) -> Column:
        at = F.sequence(F.lit(1), F.length(name) - n + 1)
        cut = F.transform(at, lambda i: F.substring(name, i, F.lit(n)))
        return F.when(F.length(name) >= n, cut).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, sizes))


def name_classes(names: DataFrame, sizes: tuple[int, ...] = (1, 2)) -> tuple[DataFrame, DataFrame]:
    """nid and key, what its rows of names are; and of each key its grams with their weights, computed once however often it occurs.

    The second table is written: cid, key, grams (array of gram and weight).
    """
    members = names.groupBy("nid").agg(F.sort_array(F.collect_list("name")).alias("key"))
    classes = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "names")
    grams = F.flatten(F.transform("key", lambda name: _grams(name, sizes)))
    tf = classes.select("key", "m", F.explode(grams).alias("gram")).groupBy("key", "m", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("gram").agg(F.sum("m").alias("df"))
    n = names.agg(F.count(F.lit(1)).alias("n"))
    raw = tf.join(df, "gram").join(F.broadcast(n)).select("key", "gram", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    rows = raw.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.struct("gram", "w")).alias("grams"))
    weights = F.transform("grams", lambda g: F.struct(g["gram"].alias("gram"), (g["w"] / F.col("norm")).alias("weight")))
    return members, stored(rows.select(F.monotonically_increasing_id().alias("cid"), "key", weights.alias("grams")), "classes")


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SENT else table


def tfidf(names: DataFrame, sizes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """nid, gram, weight: character n-grams by tf * (ln((1 + n) / (1 + df)) + 1), rows of length one; of equal names computed once."""
    members, classes = name_classes(names, sizes)
    return members.join(_sent(classes.select("key", "grams")), "key").select("nid", F.explode("grams").alias("g")).select("nid", "g.gram", "g.weight")


def _blocks(classes: DataFrame) -> DataFrame:
    """Rows of up to ``BLOCK`` classes: cids, firsts, sizes, and their grams as codes of a word list with weights."""
    first = classes.schema["first"].dataType
    columns = ["cids", "firsts", "sizes", "vocabulary", "codes", "weights"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                lists = rows.column(2)
                flat = lists.flatten()
                words = pa.compute.dictionary_encode(flat.field("gram"))
                one = [rows.column(0), rows.column(1), lists.value_lengths(), words.dictionary, words.indices, flat.field("weight")]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in one], names=columns)

    kinds = (LongType(), first, IntegerType(), StringType(), IntegerType(), DoubleType())
    return classes.select("cid", "first", "grams").mapInArrow(run, StructType([StructField(c, ArrayType(k)) for c, k in zip(columns, kinds)]))


def _dense(sizes: np.ndarray, codes: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray:
    """The rows of a block as a matrix; grams of code -1 are left out."""
    out = np.zeros((len(sizes), width))
    fine = codes >= 0
    out[np.repeat(np.arange(len(sizes)), sizes)[fine], codes[fine]] = weights[fine]
    return out


def best_classes(classes: DataFrame, k: int) -> DataFrame:
    """qcid, cid, score: of each class (cid, first, grams) the ``k`` classes of highest inner product (to nine digits), then of least
    first; itself too, none that shares no gram.

    Every block meets every block, so time is quadratic in the number of different names, memory that of two blocks.
    """
    blocks = stored(_blocks(classes), "blocks")
    sides = [blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "qv"]
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: c[row].values for n, c in zip(batch.schema.names, batch.columns)}
                number = lambda name: get[name].to_numpy(zero_copy_only=False)
                words = {w: i for i, w in enumerate(get["q_vocabulary"].to_pylist())}
                to_q = np.array([words.get(w, -1) for w in get["v_vocabulary"].to_pylist()], np.int64)
                v_sizes, v_codes, v_weights = number("v_sizes"), to_q[number("v_codes")], number("v_weights")
                firsts = get["v_firsts"].to_pylist()
                order = np.empty(len(firsts), np.int64)
                order[sorted(range(len(firsts)), key=firsts.__getitem__)] = np.arange(len(firsts))
                step = max(1, CELLS // max(len(words), 1))
                q_ends, v_ends = (np.concatenate([[0], np.cumsum(x)]) for x in (number("q_sizes"), v_sizes))
                found: list[list] = [[], [], []]
                for a in range(0, len(q_ends) - 1, step):
                    cut = slice(q_ends[a], q_ends[min(a + step, len(q_ends) - 1)])
                    q = _dense(number("q_sizes")[a : a + step], number("q_codes")[cut], number("q_weights")[cut], len(words))
                    scores = []
                    for c in range(0, len(v_ends) - 1, step):
                        cut = slice(v_ends[c], v_ends[min(c + step, len(v_ends) - 1)])
                        scores.append(q @ _dense(v_sizes[c : c + step], v_codes[cut], v_weights[cut], len(words)).T)
                    score = np.concatenate(scores, axis=1)
                    best = np.lexsort((np.broadcast_to(order, score.shape), -score.round(9)), axis=1)[:, :k]
                    value = np.take_along_axis(score, best, 1).ravel()
                    keep = value > 0
                    found[0].append(np.repeat(number("q_cids")[a : a + step], best.shape[1])[keep])
                    found[1].append(number("v_cids")[best.ravel()][keep])
                    found[2].append(value[keep])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], names=["qcid", "cid", "score"])

    pairs = sides[0].crossJoin(sides[1].repartition(parts)).mapInArrow(run, "qcid long, cid long, score double")
    best = Window.partitionBy("qcid").orderBy(F.desc(F.round("score", 9)), "first")
    return pairs.join(classes.select("cid", "first"), "cid").withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).select("qcid", "cid", "score")


def sparse_nearest(names: DataFrame, k: int, sizes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """qid, rank, nid, score: of every name the ``k`` others of highest inner product (to nine digits), ties by nid, that share a gram with it.

    Equal names have equal scores, so different ones are compared, and of each only the first k + 1 ids can be among anyone's best.
    """
    members, classes = name_classes(names, sizes)
    least = Window.partitionBy("key").orderBy("nid")
    heads = members.withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= k + 1).groupBy("key").agg(F.sort_array(F.collect_list("nid")).alias("nids"))
    classes = stored(classes.join(heads, "key").select("cid", "key", "grams", "nids", F.get("nids", F.lit(0)).alias("first")), "heads")
    found = best_classes(classes, k + 1).join(classes.select("cid", "nids"), "cid").select("qcid", F.explode("nids").alias("nid"), "score")
    place = Window.partitionBy("qcid").orderBy(F.desc(F.round("score", 9)), "nid")
    found = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k + 1)
    lists = found.groupBy("qcid").agg(F.sort_array(F.collect_list(F.struct("rank", "nid", "score"))).alias("best"))
    lists = stored(lists.join(classes.select(F.col("cid").alias("qcid"), "key"), "qcid").select("key", "best"), "best")
    rows = members.join(_sent(lists), "key").select(F.col("nid").alias("qid"), "best")
    others = F.slice(F.filter("best", lambda x: x["nid"] != F.col("qid")), 1, k)
    return rows.select("qid", F.posexplode(others).alias("rank", "c")).select("qid", (F.col("rank") + 1).alias("rank"), "c.nid", "c.score")


def sparse_scores(queries: DataFrame, names: DataFrame) -> DataFrame:
    """qid, nid, score: the inner product of sparse rows, for pairs that share a gram."""
    q = queries.select(F.col("nid").alias("qid"), "gram", F.col("weight").alias("wq"))
    return q.join(names, "gram").groupBy("qid", "nid").agg(F.sum(F.col("wq") * F.col("weight")).alias("score"))


def hybrid_candidates(sparse: Column, dense: Column, k: int, dense_share: float = 0.5) -> Column:
    """The first sparse candidates, then dense ones that aren't among them, ``k`` in all."""
    first = k - int(k * dense_share)
    return F.slice(F.array_distinct(F.concat(F.slice(sparse, 1, first), dense)), 1, k)


def accuracy_at(candidates: DataFrame, k: int) -> DataFrame:
    """The share of queries each of whose mentions has a right one among its first ``k``: cands array<boolean> per (query, mention)."""
    hit = F.exists(F.slice("cands", 1, k), lambda c: c).cast("int")
    return candidates.groupBy("query").agg(F.min(hit).alias("hit")).agg(F.avg("hit").alias(f"acc{k}"))
