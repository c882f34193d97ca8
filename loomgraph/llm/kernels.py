"""Hashing of words and shingles over whole batches of texts, in arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that go through the arrays at once; a longer text goes alone. Small, so that arrays stay in cache.
BLOCK = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240607))
#: The multiplier of a position.
STEP = np.uint64(0x5851F42D4C957F2D)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64 over all."""
    y = x >> np.uint64(33)
    y ^= x
    y *= np.uint64(0xFF51AFD7ED558CCD)
    y ^= y >> np.uint64(33)
    y *= np.uint64(0xC4CEB9FE1A85EC53)
    y ^= y >> np.uint64(33)
    return y


_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def strings(data: np.ndarray, first: np.ndarray, size: np.ndarray, salts: tuple[int, ...] = (0,)) -> list[np.ndarray]:
    """A 64-bit hash per salt of each string of bytes; ``first`` and ``size`` (1 at least) place them in ``data``.

    Eight bytes at a time are mixed with a key of their place before they are added, so no
    pattern of letters makes two strings' sums agree.
    """
    parts = (size + 7) >> 3
    start = np.cumsum(parts) - parts
    part = np.arange(int(parts.sum())) - np.repeat(start, parts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data),), np.dtype("<u8"), buffer=padded, strides=(1,))
    value = eights[np.repeat(first, parts) + 8 * part] & _MASK[np.minimum(np.repeat(size, parts) - 8 * part, 8)]
    numbers = np.arange(1, int(parts.max()) + 1, dtype=np.uint64)
    out = []
    for salt in salts:
        key = mix(numbers * STEP + np.uint64(salt))
        out.append(mix(np.add.reduceat(mix(value ^ key[part]), start) ^ size.astype(np.uint64)))
    return out


def recoded(one: np.ndarray, two: np.ndarray, clashing: np.ndarray) -> np.ndarray:
    """The ids ``one``; of ``clashing`` ones (sorted), others made of both hashes."""
    if not len(clashing):
        return one
    at = np.minimum(np.searchsorted(clashing, one), len(clashing) - 1)
    return np.where(clashing[at] == one, mix(one.view(np.uint64) * STEP ^ two.view(np.uint64)).view(np.int64), one)


def runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, end of each text's bytes) for runs of about ``BLOCK`` bytes; null is empty.

    Each text's bytes are followed by one blank.
    """
    start, size, run = 0, 0, []

    def out(start: int, run: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
        ends = np.cumsum(np.fromiter(map(len, run), np.int64, len(run)) + 1)
        return start, np.frombuffer(b" ".join(run) + b" ", np.uint8), ends

    for i, text in enumerate(column):
        run.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
        size += len(run[-1])
        if size >= BLOCK:
            yield out(start, run)
            start, size, run = i + 1, 0, []
    if run:
        yield out(start, run)


def word_hashes(data: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (run of bytes other than blanks), and words before each text's end.

    A-Z is lowered first.
    """
    solid = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    a, b = edge[0::2], edge[1::2]
    upto = np.searchsorted(a, ends)
    if not len(a):
        return np.zeros(0, np.uint64), upto
    return strings(_LOWER[data] if lower else data, a, b - a)[0], upto


_CLASS = np.full(256, 3, np.uint8)  # symbols
_CLASS[_SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


def token_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like word_hashes for runs of letters, of digits and of symbols: hash, class (1, 2, 3; 4: letters
    all A-Z, two at least) and tokens before each text's end."""
    kind = _CLASS[data]
    change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    a = change[:-1][kind[change[:-1]] > 0] if len(change) else change
    upto = np.searchsorted(a, ends)
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), upto
    b = change[np.searchsorted(change, a, "right")]
    capitals = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    which = kind[a].copy()
    which[(which == 1) & (capitals[b] - capitals[a] == b - a) & (b - a > 1)] = 4
    return strings(_LOWER[data], a, b - a)[0], which, upto


@cache
def _odd(k: int) -> np.uint64:
    """The multiplier of a shingle's k-th word; not linear in k, so that no two orders of words agree."""
    return mix(np.array([k + 1], np.uint64) * STEP)[0] | np.uint64(1)


def shingles(words: np.ndarray, upto: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash per run of ``n`` words inside a text, and each one's text number.

    A text of fewer words, but any, has one shingle of all its words.
    """
    size = np.diff(upto, prepend=0)
    first = upto - size
    rolled = np.zeros(len(words), np.uint64)
    for k in range(min(n, len(words))):
        rolled[: len(words) - k] += words[k:] * _odd(k)
    text = np.repeat(np.arange(len(upto)), size)
    inside = np.arange(len(words)) + n <= upto[text]
    out, owner = mix(rolled[inside]), text[inside]
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for j, i in enumerate(short):
            w = words[first[i] : upto[i]]
            extra[j] = np.bitwise_xor.reduce(mix(w * np.arange(3, 2 * len(w) + 3, 2, dtype=np.uint64) + _odd(len(w))))
        out, owner = np.concatenate([out, mix(extra)]), np.concatenate([owner, short])
    return out, owner


def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each owner, by owner and then value, and where each was."""
    at = np.argsort(owner, kind="stable") if len(owner) and (owner[1:] < owner[:-1]).any() else np.arange(len(owner))
    o, v = owner[at], values[at]
    cut = np.flatnonzero(np.diff(o, prepend=-1, append=-1)).tolist()
    order = np.empty(len(v), np.int64)
    for a, b in zip(cut, cut[1:]):  # each owner's alone: short sorts stay in cache
        order[a:b] = np.argsort(v[a:b]) + a
    v, at = v[order], at[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return v[new], o[new], at[new]


def by_level(level: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order by owner (sorted already) and then level, else as it is."""
    both = level.astype(np.int64) << 40 | np.arange(len(level))
    cut = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)).tolist()
    for a, b in zip(cut, cut[1:]):
        both[a:b].sort()
    return both & ((1 << 40) - 1)


def parity(values: np.ndarray, owner: np.ndarray, texts: int, words: int = 4) -> np.ndarray:
    """A sketch of each owner's distinct values (sorted by owner), as a row of 64-bit words: every value flips one bit."""
    bits = 64 * words
    bit = (values >> np.uint64(13)).astype(np.int64) & (bits - 1)
    out = np.empty((texts, words), np.int64)
    step = max(1, (1 << 20) // bits)  # texts whose bits are counted at once
    cut = np.searchsorted(owner, np.arange(0, texts + step, step))
    for i, start in enumerate(range(0, texts, step)):
        own, n = slice(cut[i], cut[i + 1]), min(step, texts - start)
        odd = np.bincount((owner[own] - start) * bits + bit[own], minlength=n * bits) & 1
        out[start : start + n] = np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1, bitorder="little").view("<i8")
    return out


def wide_parity(values: np.ndarray) -> np.ndarray:
    """A sketch of one set, of as many bits as the next power of two has, at least 2048."""
    bits = max(2048, 1 << int(len(values) - 1).bit_length())
    odd = np.bincount((values >> np.uint64(13)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def lists(table: np.ndarray) -> pa.ListArray:
    """The rows of a table of 64-bit numbers as lists."""
    n, k = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(table.ravel()))


def marked(marks: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each place is marked in the packed ``marks``."""
    return (marks[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).view(bool)


def bitmap(rows: list, bits: int) -> np.ndarray:
    """Packed marks for 2^bits places from rows (k, m) of Spark's bitmap_construct_agg."""
    marks = np.zeros(1 << bits, bool)
    for row in rows:
        own = np.unpackbits(np.frombuffer(bytes(row["m"]), np.uint8), bitorder="little")
        # Spark counts bucket k's positions from 32768 (k - 1) + 1 on; bucket 0 has only place 0, at position 0.
        marks[np.flatnonzero(own) + ((row["k"] - 1) * len(own) + 1 if row["k"] else 0)] = True
    return np.packbits(marks)
