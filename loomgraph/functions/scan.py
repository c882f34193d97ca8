"""Tokens and sentences of batches of texts by arrays: what a Python worker does where expressions would take a lambda's call a token."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bits of a table of hashes, and bytes of text that are cut at once.
BITS, PART = 22, 4 << 20
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_STOP, _DOT, _MARK = re.compile(r"(?s)([?!])(?=..)(?!\s*[a-z])", re.A), re.compile(r"\.(?= [A-Z\-\"'])"), "\u0001"


def sentence_bounds(content: str) -> tuple[list[int], list[int]]:
    """Start and end (exclusive) of the sentences that ``text.split_sentences(merge_lower=True)`` gives, outer and only blanks left out."""
    starts, ends, at = [], [], 0
    for part in _DOT.sub("." + _MARK, _STOP.sub("\\1" + _MARK, content)).split(_MARK):
        right = part.rstrip(" ")
        if right:
            starts.append(at + len(right) - len(right.lstrip(" ")))
            ends.append(at + len(right))
        at += len(part)
    return starts, ends


def sentences(contents: pa.Array) -> pa.Array:
    """array<struct<sent_no, start, end>> of each content; null of null."""
    found = [sentence_bounds(c) if c is not None else ((), ()) for c in contents.to_pylist()]
    sizes = np.array([len(s) for s, _ in found], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = lambda side: pa.array(np.fromiter((x for f in found for x in f[side]), np.int32, int(sizes.sum())))
    number = pa.array((np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + 1).astype(np.int32))
    rows = pa.StructArray.from_arrays([number, flat(0), flat(1)], names=["sent_no", "start", "end"])
    mask = pa.array(np.asarray(contents.is_null())) if contents.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), rows, mask=mask)


def parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and rows of runs of texts of some ``PART`` bytes."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PART, "right")) - 1)
        yield at, texts.slice(at, end - at)
        at = end


class Pieces:
    """The pieces (a run of ASCII letters and digits, or any other single character) of an array of texts: bytes from ``starts`` to ``ends``."""

    def __init__(self, texts: pa.Array):
        bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        self.bounds = bounds - bounds[0]
        n = int(self.bounds[-1])
        self.data = np.zeros(n + 8, np.uint8)
        if n:
            self.data[:n] = np.frombuffer(texts.buffers()[2], np.uint8, n, int(bounds[0]))
        bytes_ = self.data[:n]
        word, goes_on = _WORD[bytes_], (bytes_ & 0xC0) == 0x80
        begins = ~goes_on
        begins[1:] &= ~(word[1:] & word[:-1])
        begins[self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]] = True
        self.starts = np.flatnonzero(begins)
        self.ends = np.append(self.starts[1:], n) if len(self.starts) else self.starts
        self.characters = np.concatenate([[0], np.cumsum(~goes_on)]) if goes_on.any() else None

    def hashes(self, of: np.ndarray) -> np.ndarray:
        """A number below 2 ** BITS of each piece in ``of``, from its first eight bytes, its last one and its length."""
        starts, sizes = self.starts[of], self.ends[of] - self.starts[of]
        head = self.data[np.minimum(starts[:, None] + np.arange(8), len(self.data) - 1)]
        head[np.arange(8) >= sizes[:, None]] = 0
        value = np.ascontiguousarray(head).view("<u8").ravel() ^ (sizes.astype(np.uint64) << np.uint64(40)) ^ self.data[self.ends[of] - 1]
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def rows(self, of: np.ndarray) -> np.ndarray:
        """The number of the text that each piece in ``of`` stands in."""
        return np.searchsorted(self.bounds, self.starts[of], "right") - 1

    def offsets(self, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where the pieces begin in their texts, in characters."""
        if self.characters is None:
            return self.starts[of] - self.bounds[rows]
        return self.characters[self.starts[of]] - self.characters[self.bounds[rows]]

    def text(self, first: np.ndarray, last: np.ndarray) -> list[str]:
        """The text from each piece in ``first`` to the one in ``last``."""
        raw = self.data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(self.starts[first].tolist(), self.ends[last].tolist())]


def first_hashes(tokens: pa.Array) -> np.ndarray:
    """The hashes of texts that are one piece each; null and empty ones have none."""
    return np.concatenate([Pieces(t).hashes(np.arange(len(Pieces(t).starts))) for _, t in parts(tokens)] or [np.zeros(0, np.int64)])


def places(contents: pa.Array, table: np.ndarray, ahead: int, sentences_too: bool) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """Rows of ``contents`` with tok, start (with ``ahead``, the token with that many pieces behind it and the piece before; with
    ``sentences_too``, sent_no, start and end of the sentence it begins in) of the pieces whose hash ``table`` has, blanks left out."""
    for at, some in parts(contents):
        p = Pieces(some)
        of = np.flatnonzero(p.data[p.starts] != 32)
        of = of[table[p.hashes(of)]]
        rows = p.rows(of)
        start = p.offsets(of, rows)
        out = [pa.array(p.text(of, of), pa.string()), pa.array(start.astype(np.int32))]
        if ahead:
            until = np.searchsorted(p.starts, p.bounds[rows + 1], "left") - 1
            out.append(pa.array(p.text(of, np.minimum(of + ahead, until)), pa.string()))
            none = p.starts[of] == p.bounds[rows]
            before = np.maximum(of - 1, 0)
            out.append(pa.array(p.text(before, before), pa.string(), mask=none))
        if sentences_too:
            number, begin, end = (np.zeros(len(of), np.int32) for _ in range(3))
            for row, a, b in zip(*_runs(rows)):
                starts, ends = sentence_bounds(some[int(row)].as_py())
                if starts:
                    nth = np.maximum(np.searchsorted(starts, start[a:b], "right") - 1, 0)
                    number[a:b], begin[a:b], end[a:b] = nth + 1, np.array(starts)[nth], np.array(ends)[nth]
            out += [pa.array(x, mask=number == 0) for x in (number, begin, end)]
        yield rows + at, out


def _runs(rows: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    first = np.flatnonzero(np.diff(rows, prepend=-1)) if len(rows) else np.zeros(0, np.int64)
    return rows[first].tolist(), first.tolist(), [*first[1:].tolist(), len(rows)]
