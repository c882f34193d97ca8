"""Ordinal quality: cumulative-link regression on graded ratings over hashed text features."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import kernels as K

#: Hash bits of a feature, and the labelled documents learned from (about).
BITS, SAMPLE = 18, 8000
EPOCHS, RATE, DECAY = 25, 0.3, 2e-5
#: Rated documents that a feature must occur in.
LEAST = 4


@dataclass
class Model:
    """P(grade > k) = 1 / (1 + exp(thresholds[k] - weights . x)), thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature number, text number, value) of every distinct feature, by text.

    Each distinct token (run of letters, digits or symbols) counts 1, and so do the
    shares of capitals, digits, symbols and repeated tokens and the length, in tenths.
    """
    hashes, kind, upto = K.token_hashes(data, ends)
    texts = len(upto)
    size = np.diff(upto, prepend=0)
    owner = np.repeat(np.arange(texts), size)
    values, who = K.distinct(hashes, owner)[:2]
    unlike = np.bincount(who, minlength=texts)
    number = [(values >> np.uint64(64 - BITS)).astype(np.int64)]
    text = [who]
    value = [np.ones(len(who))]
    some = np.flatnonzero(size)
    shares = [np.bincount(owner[kind == c], minlength=texts)[some] / size[some] for c in (2, 3, 4)]
    shares.append(1 - unlike[some] / size[some])
    shares.append(np.minimum(np.log2(size[some] + 1) / 16, 1))
    for n, share in enumerate(shares):
        code = K.mix((np.ceil(10 * share).astype(np.uint64) + np.uint64(100 * n + 1)) * K.STEP)
        number.append((code >> np.uint64(64 - BITS)).astype(np.int64))
        text.append(some)
        value.append(np.ones(len(some)))
    number_, text_, value_ = map(np.concatenate, (number, text, value))
    order = np.argsort(text_, kind="stable")
    return number_[order], text_[order], value_[order].astype(np.float32)


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null where quality is null and nothing says toxic."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, sample: int = SAMPLE) -> Model:
    """Learn from about ``sample`` rated documents (doc_id, grade), chosen by hash of the id.

    The features of the sample reach the driver, bounded by ``sample``; the fit is
    stochastic gradient descent with a fixed seed, so reruns agree. Null texts are
    empty; null ids or grades teach nothing. Without ratings all grades are as likely.
    """
    rated = ratings.where("doc_id is not null and grade is not null").select("doc_id", "grade").dropDuplicates(["doc_id"])
    total = max(rated.count(), 1)
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30))
    chosen = (
        docs.select("doc_id", "text").join(F.broadcast(rated.where(draw)), "doc_id")  # bounded by ``sample``
        .select("text", F.col("grade").cast("int"), "doc_id")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, ends in K.runs(batch.column(0)):
                number, text, value = features(data, ends)
                cut = np.searchsorted(text, np.arange(len(ends) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(start, len(ends)), batch.column(1).slice(start, len(ends)), pa.ListArray.from_arrays(cut, pa.array(number.astype(np.int32))),
                     pa.ListArray.from_arrays(cut, pa.array(value))], names=["doc_id", "grade", "number", "value"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = chosen.mapInArrow(run, f"doc_id {kind}, grade int, number array<int>, value array<float>").toArrow()
    rows = rows.take(np.lexsort((rows["grade"].to_numpy(), rows["doc_id"].to_numpy())))
    number, value = rows["number"].combine_chunks(), rows["value"].combine_chunks()
    return _descend(rows["grade"].to_numpy(), np.asarray(number.offsets), number.flatten().to_numpy(), value.flatten().to_numpy(), grades)


def _told(y: np.ndarray, number: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """How much each feature alone tells of the grade: its largest squared log odds over the thresholds,
    less what chance gives it. Features that tell much move fast, the many that tell nothing stay."""
    told = np.zeros(size)
    for k in range(1, len(count)):
        low = np.bincount(number[y < k], minlength=size) + 0.5
        high = np.bincount(number[y >= k], minlength=size) + 0.5
        odds = np.log(low / (count[:k].sum() + 1)) - np.log(high / (count[k:].sum() + 1))
        told = np.maximum(told, np.maximum(np.abs(odds) - 2 * np.sqrt(1 / low + 1 / high) * (low + high > 2), 0))
    return np.minimum(told, 4.0) ** 2 / 4


def _descend(y: np.ndarray, cut: np.ndarray, number: np.ndarray, value: np.ndarray, grades: int) -> Model:
    """AdaGrad on the ordinal likelihood, classes weighted by the root of their rarity."""
    w = np.zeros(1 << BITS)
    seen = np.full(1 << BITS, 1e-2)
    theta = np.linspace(-1.0, 1.0, grades - 1) if grades > 2 else np.zeros(1)
    theta_seen = np.full(grades - 1, 1e-2)
    if not len(y):
        return Model(w.astype(np.float32), np.log((np.arange(grades - 1) + 1) / (grades - 1 - np.arange(grades - 1))))
    # A feature of few rated documents would only learn them by heart.
    value = np.where(np.bincount(number, minlength=len(w))[number] >= LEAST, value, 0)
    told = _told(np.repeat(y, np.diff(cut)), number, np.bincount(y, minlength=grades), len(w))
    value = value * told[number]
    count = np.maximum(np.bincount(y, minlength=grades), 1)
    weight = np.sqrt(count.max() / count)[y]
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            rows = order[at : at + 64]
            size = cut[rows + 1] - cut[rows]
            who = np.repeat(np.arange(len(rows)), size)
            pos = np.repeat(cut[rows] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(who))
            f, v = number[pos], value[pos]
            score = np.bincount(who, w[f] * v, len(rows))
            # P(grade > k) at the thresholds around each row's grade
            full = np.concatenate(([-40.0], theta, [40.0]))
            lo, hi = full[y[rows]], full[y[rows] + 1]
            above, over = 1 / (1 + np.exp(lo - score)), 1 / (1 + np.exp(hi - score))
            p = np.maximum(above - over, 1e-9)
            slope = (above * (1 - above) - over * (1 - over)) / p * weight[rows]
            step = np.bincount(f, slope[who] * v, len(w))
            touched = np.flatnonzero(step)
            g = step[touched] / len(rows) - DECAY * w[touched]
            seen[touched] += g * g
            w[touched] += RATE * g / np.sqrt(seen[touched])
            pull = np.zeros(grades + 1)
            np.add.at(pull, y[rows], -above * (1 - above) / p * weight[rows])
            np.add.at(pull, y[rows] + 1, over * (1 - over) / p * weight[rows])
            t = pull[1:-1] / len(rows)
            theta_seen += t * t
            theta = theta + RATE * t / np.sqrt(theta_seen)
            theta = np.maximum.accumulate(theta + 1e-3 * np.arange(grades - 1))
    return Model((w * told).astype(np.float32), theta)


def rate(docs: DataFrame, model: Model, tail: int | None = None, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of grade ``tail`` or better; the top one by default),
    clean_probability (better than grade 0), grade_pred (the likeliest) and selected (tail at ``least``).

    Every whole text is read; null counts as empty. Only doc_id and text are read.
    """
    table = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^18 weights
    top = len(model.thresholds) if tail is None else tail
    ddl = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, expected_grade double, tail_probability double, "
        "clean_probability double, grade_pred int, selected boolean"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = table.value
        for batch in batches:
            for start, data, ends in K.runs(batch.column(1)):
                number, text, value = features(data, ends)
                score = np.bincount(text, m.weights[number] * value, len(ends))
                above = 1 / (1 + np.exp(np.clip(m.thresholds[None, :] - score[:, None], -40, 40)))
                full = np.concatenate([np.ones((len(ends), 1)), above, np.zeros((len(ends), 1))], axis=1)
                each = full[:, :-1] - full[:, 1:]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(ends)), pa.array(above.sum(axis=1)), pa.array(full[:, top]), pa.array(full[:, 1]),
                     pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(full[:, top] >= least)],
                    names=["doc_id", "expected_grade", "tail_probability", "clean_probability", "grade_pred", "selected"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, ddl)
