"""Tagging of documents by an exchangeable scorer: windows of word pieces, batches, and scores put back to words and spans.

The scorer is what a model is elsewhere: made once per Python worker, it takes windows of
pieces and gives each piece a score per head (entity type) and label. All else is here: sentences and tokens with
their offsets come from the JVM, and spans go back as rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text
from loomgraph.operators.relations import MODEL_TYPES

MODEL_HEADS = tuple(MODEL_TYPES)
#: Label order of scores; sub-tokens of a window and of these the model's own; windows scored at once.
LABELS, WINDOW, SPECIAL, BATCH = ("O", "B", "I"), 128, 2, 32
#: A piece that goes on a word begins with this.
GOES_ON = "##"
_WORD = re.compile("[0-9a-zA-Z]+|[^0-9a-zA-Z ]", re.S)

Scorer = Callable[[list[list[str]]], np.ndarray]


def sentence_words(content: str, sentences: Iterable[str]) -> Iterator[list[tuple[str, int, int]]]:
    """The words (token, start, end inclusive) of each sentence, as they stand in the content.

    Sentences leave out blanks and marks that parted them, so a word's place is that of the content's own token, not the sum of
    what came before.
    """
    tokens = ((m.group(), m.start(), m.end() - 1) for m in _WORD.finditer(content))
    for sentence in sentences:
        words = []
        for word in _WORD.findall(sentence):
            for found in tokens:
                if found[0] == word:
                    words.append(found)
                    break
            else:
                raise ValueError("a sentence isn't part of its content")
        yield words


def windows_of(words: list[str], cut: Callable[[str], list[str]], room: int) -> tuple[list[list[str]], np.ndarray]:
    """A sentence's pieces in windows of ``room``, and the place of each word's first piece among all of them."""
    pieces: list[str] = []
    first = np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        first[i] = len(pieces)
        head, *rest = cut(word) or [word]
        pieces += [head, *(GOES_ON + r for r in rest)]
    return [pieces[a : a + room] for a in range(0, len(pieces), room)], first


def decoded(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """First word, last word and confidence of the spans in one head's scores (words by labels).

    B opens a span and closes one that is open, I goes on, O closes. The confidence is the mean over
    the span's words of the largest softmax value.
    """
    if not len(scores):
        return []
    sure = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
    spans, start = [], None
    for i, label in enumerate([*scores.argmax(axis=1), 0]):
        if start is not None and label != 2:
            spans.append((start, i - 1, float(sure[start:i].mean())))
            start = None
        if label == 1:
            start = i
    return spans


def tag(docs: DataFrame, heads: tuple[str, ...], scorer: Callable[[], Scorer], cut: Callable[[str], list[str]] = lambda w: [w], window: int = WINDOW) -> DataFrame:
    """pmid, entity_type, start, end (exclusive), mention and prob of what ``scorer`` finds in ``docs`` (pmid, title, abstract, content).

    ``scorer()`` is called once in a task and gives a function of up to ``BATCH`` windows: scores (windows, pieces, heads,
    labels), padded at the end. ``cut`` makes the pieces of a word, of which the first one's scores count.
    A sentence of more pieces than a window goes through several and is put together again. Tokens over 20 characters
    are shown to it by their first ten.
    """
    rows = docs.select(F.col("pmid").cast("string").alias("pmid"), "content", text.tagger_sentences("title", "abstract").alias("sentences"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, room = scorer(), window - SPECIAL
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pylist()
                held = [(doc, words) for doc in part for words in sentence_words(doc["content"] or "", doc["sentences"] or ()) if words]
                cuts = [windows_of([t if len(t) <= 20 else t[:10] for t, _, _ in s], cut, room) for _, s in held]
                every = [w for windows, _ in cuts for w in windows]
                scored: list[np.ndarray] = []
                for a in range(0, len(every), BATCH):
                    some = every[a : a + BATCH]
                    scored += [x[: len(w)] for x, w in zip(score(some), some)]
                found: list[list] = [[], [], [], [], [], []]
                used = 0
                for (doc, sentence), (windows, first) in zip(held, cuts):
                    words = np.concatenate(scored[used : used + len(windows)])[first]
                    used += len(windows)
                    for h in np.flatnonzero((words.argmax(axis=2) == 1).any(axis=0)):  # only a B opens a span
                        for a, b, prob in decoded(words[:, h]):
                            start, end = sentence[a][1], sentence[b][2] + 1
                            for column, value in zip(found, (doc["pmid"], heads[h], start, end, doc["content"][start:end], prob)):
                                column.append(value)
                types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names=["pmid", "entity_type", "start", "end", "mention", "prob"])

    return rows.mapInArrow(run, "pmid string, entity_type string, start int, end int, mention string, prob double")


def dictionary_scorer(heads: tuple[str, ...], terms: dict[str, str], weight: float = 4.0) -> Callable[[], Scorer]:
    """A scorer that knows single words: ``terms`` maps a word to its head. A list bounded by its dictionary."""
    number = {h: i for i, h in enumerate(heads)}

    def score(windows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(windows), max(map(len, windows)), len(heads), len(LABELS)))
        out[..., 0] = weight
        for w, window in enumerate(windows):
            for i, piece in enumerate(window):
                word, next_ = piece, i + 1
                while next_ < len(window) and window[next_].startswith(GOES_ON) and len(window[next_]) > len(GOES_ON):
                    word += window[next_][len(GOES_ON) :]
                    next_ += 1
                if (h := number.get(terms.get(word))) is not None:
                    out[w, i, h] = (0, weight, 0)
        return out

    return lambda: score
