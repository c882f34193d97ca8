"""Language identification: script ranges, per-word n-gram scores, Viterbi over words."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash bits of a character n-gram, the labelled documents learned from per language (about),
#: what it costs to switch language between two words, and the most that one word may tell.
BITS, SAMPLE, SWITCH, WORD_CAP = 16, 2000, 12.0, 8.0
#: Letters that go through the arrays at once.
BLOCK = 1 << 18

#: Script ranges, fixed values of the Unicode standard: first and last code point.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower-case letter or 0, and its script number (0: none listed)."""
    lower = np.zeros(sys.maxunicode + 1, np.uint32)
    for i in range(sys.maxunicode + 1):
        if unicodedata.category(chr(i))[0] == "L":
            small = chr(i).lower()
            lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(sys.maxunicode + 1, np.uint8)
    for n, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = n
    return lower, np.where(lower > 0, script, 0).astype(np.uint8)


@dataclass
class Words:
    """The words of a run of texts: hashed n-grams of all letters, and where words and texts begin."""

    grams: np.ndarray
    word_at: np.ndarray  # first gram of each word
    script: np.ndarray  # of each word's first letter
    text_of: np.ndarray  # text number of each word
    letters: np.ndarray  # in each word


def words_of(texts: list[str]) -> Words:
    """A word is a run of letters. Each letter gives two n-grams, of it with one and with two
    letters before and one behind; outside the word counts as a blank."""
    lower, script = _tables()
    joined = "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    low = lower[code]
    at = np.flatnonzero(low)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none)
    c = low.astype(np.uint64)
    before, here, behind = c[at - 1] * (at > 0), c[at], c[np.minimum(at + 1, len(c) - 1)]
    two = c[at - 2] * ((at > 1) & (before > 0))
    mix = np.uint64(0x9E3779B97F4A7C15)
    three = (before * np.uint64(1 << 42) + here * np.uint64(1 << 21) + behind) * mix
    four = (three ^ (two + np.uint64(7))) * mix
    grams = np.empty(2 * len(at), np.int64)
    shift = np.uint64(64 - BITS)
    grams[0::2] = three >> shift
    grams[1::2] = (four >> shift) + np.uint64(1 << BITS)
    first = np.flatnonzero(before == 0)
    return Words(
        grams, 2 * first, script[code[at[first]]], np.searchsorted(ends, at[first], "right"),
        np.diff(np.append(first, len(at))),
    )


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # n-gram by language
    allowed: np.ndarray  # script by language


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that nothing is learned from; null ids are never held out."""
    return F.coalesce(_fold(doc_id) == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the text and label of about ``sample`` documents per language outside the held-out fold.

    The sample is by hash of the id, at a rate per language from its count, so it is the
    same on each run. Counts of n-grams are summed by Spark; what reaches the driver is
    bounded by n-grams times languages. Null labels and null texts teach nothing.
    """
    taught = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in taught.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((2 << BITS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rates = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample / sizes[k])))])
    number = F.create_map(*[x for n, k in enumerate(languages) for x in (F.lit(k), F.lit(n))])
    chosen = taught.where(draw < rates[F.col("lang")]).select(number[F.col("lang")].alias("n"), "text")

    grams = 2 << BITS

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for which, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of([text])
                own = sums.setdefault(which, np.zeros(grams + len(SCRIPTS) + 1, np.int64))
                # each kind of word once a document: a line repeated a thousand times teaches once
                own[:grams] += np.minimum(np.bincount(words.grams, minlength=grams), 20)
                own[grams:] += np.bincount(words.script, minlength=len(SCRIPTS) + 1)
        for which, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), which, np.int32)), pa.array(some.astype(np.int32)), pa.array(own[some])],
                names=["n", "gram", "seen"],
            )

    counted = chosen.mapInArrow(count, "n int, gram int, seen long").groupBy("n", "gram").agg(F.sum("seen").alias("seen"))
    rows = counted.toArrow()
    table = np.zeros((grams + len(SCRIPTS) + 1, len(languages)))
    table[rows["gram"].to_numpy(), rows["n"].to_numpy()] = rows["seen"].to_numpy()
    logp = np.empty((grams, len(languages)), np.float32)
    for half in (slice(0, grams // 2), slice(grams // 2, grams)):
        part = table[half] + 0.3
        logp[half] = 0.5 * np.log(part / part.sum(axis=0))  # two n-grams a letter, half weight each
    scripts = table[grams:]
    return Model(languages, logp, scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1))


def likelihoods(words: Words, model: Model) -> np.ndarray:
    """Per word and language, the log-likelihood; minus infinity where the language's learned text
    doesn't use the word's script."""
    s = np.add.reduceat(model.logp[words.grams], words.word_at, axis=0)
    return np.where(model.allowed[words.script], s, -np.inf)


def word_scores(s: np.ndarray) -> np.ndarray:
    """The ``likelihoods`` below the best candidate's, at most ``WORD_CAP``.

    A word in a script that no language uses tells nothing.
    """
    best = s.max(axis=1, keepdims=True)
    return np.where(np.isfinite(best), np.maximum(s - np.where(np.isfinite(best), best, 0), -WORD_CAP), 0.0)


def viterbi(s: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of the best path through scores (words by languages), ``switch`` lost at each change."""
    n, k = s.shape
    back = np.zeros((n, k), np.int16)
    total = s[0].copy()
    own = np.arange(k)
    for t in range(1, n):
        top = int(total.argmax())
        stay = total >= total[top] - switch
        back[t] = np.where(stay, own, top)
        total = np.where(stay, total, total[top] - switch) + s[t]
    path = np.empty(n, np.int16)
    path[-1] = total.argmax()
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label_texts(words: Words, s: np.ndarray, texts: int, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """The language number of every word, and each text's first word.

    Where no other language beats a text's best one by half of ``switch`` over any run of
    words, the best path can't gain by changing, so it is that one language: k runs of others
    cost k - 1 switches at least (two runs that fill the text one), and one alone that fills
    it gains nothing. All texts are tested for this at once and only the rest walk word by word.
    """
    first = np.searchsorted(words.text_of, np.arange(texts + 1))
    label = np.zeros(len(s), np.int16)
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return label, first
    total = np.add.reduceat(s, first[some], axis=0)
    best = total.argmax(axis=1)
    spread = np.repeat(best, np.diff(first)[some])
    lead = s - np.take_along_axis(s, spread[:, None], axis=1)
    # Running sums of each text lie below those of the text before, so the running
    # minimum starts anew with each text.
    high = np.abs(lead).sum() + 1.0
    number = np.repeat(np.arange(len(some)), np.diff(first)[some])
    sums = np.cumsum(lead, axis=0, dtype=np.float64)
    base = np.zeros_like(total, dtype=np.float64)
    base[1:] = sums[first[some][1:] - 1]
    own = sums - base[number]
    low = np.minimum.accumulate(np.minimum(own - lead, own) - (number * high)[:, None], axis=0) + (number * high)[:, None]
    gain = np.maximum.reduceat((own - low).max(axis=1), first[some])
    label[:] = spread
    for i in np.flatnonzero(gain >= switch / 2 * 0.999):
        a, b = first[some[i]], first[some[i] + 1]
        label[a:b] = viterbi(s[a:b].astype(np.float64), switch)
    return label, first


def _batches(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``BLOCK`` characters."""
    start, size, run = 0, 0, []
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= BLOCK:
            yield start, run
            start, size, run = i + 1, 0, []
    if run:
        yield start, run


def _labelled(texts: list[str], m: Model, switch: float = SWITCH) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words, their labels on the best path, each text's first word, and per text the language number
    of most letters (that behind the last: und), its share of letters, and the share of letters in words
    that some learned language reads.

    A language reads a word of a script that it uses if the word's n-grams are at least as likely under
    it as under no knowledge at all, all hash values being equal.
    """
    words = words_of(texts)
    n, k = len(texts), len(m.languages)
    if not len(words.word_at) or not k:
        return words, np.zeros(len(words.word_at), np.int16), np.zeros(n + 1, np.int64), np.full(n, k), np.zeros(n), np.zeros(n)
    s = likelihoods(words, m)
    label, first = label_texts(words, word_scores(s), n, switch)
    share = np.bincount(words.text_of * k + label, words.letters, n * k).reshape(n, k)
    letters = share.sum(axis=1)
    pred = np.where(letters > 0, share.argmax(axis=1), k)
    score = np.where(letters > 0, share.max(axis=1) / np.maximum(letters, 1), 0.0)
    reads = s.max(axis=1) >= -words.letters * (BITS * np.log(2) + 1e-3)
    return words, label, first, pred, score, np.bincount(words.text_of, words.letters * reads, n) / np.maximum(letters, 1)


def identify(docs: DataFrame, model: Model, switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, known and with ``spans`` the labelled spans of every whole text.

    ``lang_pred`` is the language of most letters on the best path (ties: first by name),
    ``und`` where the text is null or has no letter. ``score`` is that share of letters.
    ``known`` is false for ``und`` and where no word is in a learned language's script.
    A span is (language, first word, words). Only the text is read; other columns,
    whatever their names, are not.
    """
    table = docs.sparkSession.sparkContext.broadcast(model)  # n-grams by languages, whatever the data's size
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, known boolean"
    ddl += ", spans array<struct<lang:string,first:int,words:int>>" * spans
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = table.value
        names = np.array([*m.languages, "und"], object)
        for batch in batches:
            keys = batch.column(0)
            for start, texts in _batches(batch.column(1).to_pylist()):
                n = len(texts)
                words, label, first, pred, score, _ = _labelled(texts, m, switch)
                able = m.allowed[words.script].any(axis=1)
                known = np.bincount(words.text_of, able, n) > 0
                parts = [_spans(label[first[i] : first[i + 1]], m.languages) for i in range(n)] if spans else []
                columns = [keys.slice(start, n), pa.array(names[pred], pa.string()), pa.array(score), pa.array(known)]
                if spans:
                    columns.append(pa.array(parts, schema.field("spans").type))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def _spans(label: np.ndarray, languages: list[str]) -> list[dict]:
    if not len(label):
        return []
    cut = np.append(np.flatnonzero(np.diff(label, prepend=-1)), len(label))
    return [{"lang": languages[label[a]], "first": int(a), "words": int(b - a)} for a, b in zip(cut, cut[1:])]


def keep_known_language(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` in a learned language, as they are.

    Every whole text is labelled as by ``identify``. It goes if it is ``und`` (null, or no
    letter), or if the larger share of its letters lies in words that no learned language
    reads: in other scripts, or less likely under each of them than under no knowledge.
    """
    m = model or fit(docs)
    table = docs.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = table.value
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for start, texts in _batches(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                *_, pred, _, read = _labelled(texts, m)
                keep[start : start + len(texts)] = (pred < len(m.languages)) & (read >= 0.5)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
