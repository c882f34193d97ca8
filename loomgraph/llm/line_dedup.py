"""Fuzzy line deduplication: MinHash over character shingles, banding, exact Jaccard, union-find."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import kernels as K
from loomgraph.llm.common import Scratch, in_small_batches, written_at
from loomgraph.llm.components import FEW, bitmap_of, cluster, likely

#: Characters of a shingle, bands, rows of a band, and the similarity in percent. Lines of similarity
#: 0.8 share a band with probability 1 - (1 - 0.8^4)^12 = 0.998; of 0.9, 0.99999.
SHINGLE, BANDS, ROWS, PERCENT = 8, 12, 4, 80
#: Lines of up to SHORT characters are compared by shingles of FINE, the k-th occurrence of one apart from
#: the first: one changed character leaves a similarity of 0.8 from 29 characters on, of 8-shingles from 79 on.
SHORT, FINE = 80, 3
#: Their bands are of longer shingles, which unlike lines don't share by chance: where FINE ones reach 0.8, of
#: FINE_BAND characters 0.6 or more are shared, and a band with probability 1 - (1 - 0.6^3)^24 = 0.997.
FINE_BAND, FINE_BANDS, FINE_ROWS = 6, 24, 3
#: Lines from here on may be similar to one longer than SHORT.
BORDER = int(0.8 * (SHORT + 2 - SHINGLE)) + SHINGLE - 1
#: Characters that go through the arrays at once, lines remembered within a task, words of a line's parity sketch.
BLOCK, SEEN, SKETCH = 1 << 17, 1 << 16, 8
#: Band keys that are sorted at once and that a part holds in the mean, and rows of a key that a task sends to its part: more than
#: keys have whose pairs are all listed there.
PART, ROWS_OF_KEY = 1 << 19, FEW + 1
#: What a line's number adds to its document's hash.
_LINE = 2654435761

_MULTIPLY = K._rng.integers(1, 1 << 63, FINE_BANDS * FINE_ROWS, dtype=np.uint64) | np.uint64(1)
_PLACE = K._rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
#: Band keys are made of 32-bit hashes; of a line from here on distinct ones are counted by 64 bits, as many meet by chance.
EXACT = 1 << 12


def normal(line: str) -> str:
    """What a line is compared by: lower case, white space trimmed and single."""
    return " ".join(line.lower().split())


def codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all lines, none of them empty, and each line's length."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    return code, np.fromiter(map(len, lines), np.int64, len(lines))


def identities(code: np.ndarray, size: np.ndarray, clashing: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """A node of each line, of ``bits``, and a second hash that confirms it; nodes that are ``clashing`` (sorted) are made of both."""
    data = np.frombuffer(code.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
    first = np.cumsum(size) - size
    if len(data) > len(code):  # bytes of each character, and so of each line
        size = np.add.reduceat(1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF), first)
        first = np.cumsum(size) - size
    return named(data, first, size, clashing, bits)


def named(data: np.ndarray, first: np.ndarray, size: np.ndarray, clashing: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``identities`` of the lines whose UTF-8 has ``size`` bytes from ``first`` on in ``data``."""
    one, two = K.strings(data, first, size, (0, 1))
    one, two = (one >> np.uint64(64 - bits)).view(np.int64), two.view(np.int64)
    return K.recoded(one, two, clashing), two


def mix32(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 32 over all."""
    y = x >> np.uint32(16)
    y ^= x
    y *= np.uint32(0x85EBCA6B)
    y ^= y >> np.uint32(13)
    y *= np.uint32(0xC2B2AE35)
    y ^= y >> np.uint32(16)
    return y


def shingle_hashes(code: np.ndarray, size: np.ndarray, width: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The hash (of 64 or 32 bits) of every run of ``width`` characters, and how many each line has; a shorter line is one shingle."""
    kind, mixed = (np.uint64, K.mix) if bits == 64 else (np.uint32, mix32)
    place = _PLACE.astype(kind)
    short = size < width
    if short.any():  # filled up with a character that no line has
        fill = np.where(short, width - size, 0)
        code = np.insert(code, np.repeat(np.cumsum(size), fill), 10)
        size = size + fill
    ends = np.cumsum(size)
    rolled, span = code.astype(kind), 1
    while 2 * span <= width:  # of runs of 1, 2, 4, 8 characters
        rolled[:-span] = rolled[:-span] * place[span] + rolled[span:]
        span *= 2
    if span < width:  # two runs that overlap make one of any other width
        rolled[: span - width] = rolled[: span - width] * place[width + 32] + rolled[width - span :]
    inside = np.ones(len(code), bool)
    for k in range(1, width):
        inside[ends - k] = False
    return mixed(rolled[inside]), size - width + 1


def numbered(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The hashes by line and value, each occurrence within a line made different."""
    line = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, line))
    h, own = hashes[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    at = np.arange(len(h))
    return K.mix(h + (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64) * K.STEP)


def members(code: np.ndarray, size: np.ndarray, fine: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each line's shingles as hashes, and how many: of ``fine`` ones every occurrence is another, of the rest repeats may stay."""
    hashes, count = shingle_hashes(code, size, FINE if fine else SHINGLE)
    return (numbered(hashes, count) if fine else hashes), count


def _sorted_within(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sorts each line's hashes where they are, and marks those that are new in their line."""
    ends, start = np.cumsum(count), 0
    for stop in ends.tolist():  # each line's alone: short sorts stay in cache
        hashes[start:stop].sort()
        start = stop
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    new[ends[:-1]] = True
    return new


def signatures(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct hashes of 32 bits each line has, and its MinHash signature of ``BANDS * ROWS`` values, both by sorting them.

    A line's hashes are dealt to as many bins by their leading bits, and a value is the least of its
    bin (MinHash by one permutation). An empty bin takes the value of the next one that isn't, and its distance.
    """
    lines, bins = len(count), BANDS * ROWS
    low, end = hashes.copy(), np.cumsum(count)
    new = _sorted_within(low, count)
    cell = low >> np.uint32(16)
    cell *= np.uint32(bins)
    cell >>= np.uint32(16)
    cell += np.repeat(np.arange(lines, dtype=np.uint32) * np.uint32(bins), count)
    first = np.flatnonzero(cell[1:] != cell[:-1]) + 1  # repeats lie in one cell
    first = np.concatenate([np.zeros(1, np.int64), first])
    table, full = np.zeros(lines * bins, np.uint64), np.zeros(lines * bins, bool)
    table[cell[first]], full[cell[first]] = K.mix(low[first].astype(np.uint64)), True
    table, full = table.reshape(lines, bins), full.reshape(lines, bins)
    some = np.flatnonzero(~full.all(axis=1))
    if len(some):
        at = np.where(full[some], np.arange(bins), 2 * bins)
        following = np.minimum.accumulate(np.concatenate([at, at + bins], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :bins]
        table[some] = np.take_along_axis(table[some], following % bins, axis=1) + (following - np.arange(bins)).astype(np.uint64) * K.STEP
    return np.add.reduceat(new, end - count, dtype=np.int64), table


def band_keys(signature: np.ndarray, rows: int, family: int) -> np.ndarray:
    """A 64-bit key per line and band of ``rows`` values; those of another family of signatures are other keys."""
    lines, values = signature.shape
    keys = (signature.reshape(lines, values // rows, rows) * _PLACE[8 : 8 + rows]).sum(axis=2, dtype=np.uint64)
    return K.mix(keys + (np.arange(values // rows, dtype=np.uint64) + np.uint64(100 * family)) * K.STEP)


def fine_signatures(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """MinHash signatures of short lines: the least of each line's hashes under many multipliers."""
    hashes, count = shingle_hashes(code, size, FINE_BAND, 32)
    first = np.cumsum(count) - count
    least = np.empty((len(_MULTIPLY), len(count)), np.uint32)
    for row, m in zip(least, _MULTIPLY.astype(np.uint32)):
        np.minimum.reduceat(hashes * m, first, out=row)
    return K.mix(least.astype(np.uint64)).T


def _chunks(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= BLOCK:
            yield start, lines[start : i + 1]
            start, size = i + 1, 0
    if start < len(lines):
        yield start, lines[start:]


def similar(a: str, b: str, percent: int = PERCENT) -> bool:
    """Exact Jaccard similarity: of two short lines' fine shingles with their repeats, else of the sets of shingles."""
    fine = max(len(a), len(b)) <= SHORT
    width = FINE if fine else SHINGLE
    c, d = ([t[i : i + width] for i in range(max(1, len(t) - width + 1))] for t in (a, b))
    if not fine:
        c, d = set(c), set(d)
    both = (Counter(c) & Counter(d)).total() if fine else len(c & d)
    return 100 * both >= percent * (len(c) + len(d) - both)


#: The most pairs that are compared at once.
PAIRS = 1 << 12


def similar_pairs(lines: list[str], x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """``similar`` of lines[x] and lines[y] for many pairs.

    Shingles are counted by 52 bits of their hashes, which can only agree too often; pairs that
    lie near the limit by that count are compared as texts.
    """
    code, size = codes(lines)
    ok = np.zeros(len(x), bool)
    fine = np.maximum(size[x], size[y]) <= SHORT
    for kind in (False, True):
        of = np.flatnonzero(fine == kind)
        if not len(of):
            continue
        used, place = np.unique(np.concatenate([x[of], y[of]]), return_inverse=True)
        take = np.zeros(len(lines), bool)
        take[used] = True
        hashes, count = members(code[np.repeat(take, size)], size[used], kind)
        begin = np.cumsum(count) - count
        left, right = place[: len(of)], place[len(of) :]
        total = count[left] + count[right]
        for a in _runs(total):
            sides = []
            for side in (left[a], right[a]):
                n = count[side]
                pair = np.repeat(np.arange(len(side), dtype=np.uint64), n)
                at = np.arange(len(pair)) + np.repeat(begin[side] - (np.cumsum(n) - n), n)
                own = np.sort(hashes[at] & ~np.uint64(PAIRS - 1) | pair)
                keep = np.ones(len(own), bool)
                keep[1:] = own[1:] != own[:-1]
                sides.append(own[keep])
            pairs = len(left[a])
            sizes = [np.bincount((s & np.uint64(PAIRS - 1)).astype(np.int64), minlength=pairs) for s in sides]
            every = np.sort(np.concatenate(sides))
            common = every[1:][every[1:] == every[:-1]]
            both = np.bincount((common & np.uint64(PAIRS - 1)).astype(np.int64), minlength=pairs)
            margin = 100 * both - percent * (sizes[0] + sizes[1] - both)
            ok[of[a]] = margin >= 0
            for i in np.flatnonzero(np.abs(margin) <= 600):
                j = of[a][i]
                ok[j] = similar(lines[x[j]], lines[y[j]], percent)
    return ok


def _runs(total: np.ndarray) -> Iterator[slice]:
    """Runs of pairs with about ``BLOCK`` shingles, ``PAIRS`` pairs at most."""
    start, size = 0, 0
    for i, n in enumerate(total.tolist()):
        size += n
        if size >= BLOCK or i + 1 - start == PAIRS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(total):
        yield slice(start, len(total))


def _normal_lines(text: str | None) -> list[str]:
    """``normal`` of every line.

    All white space but a blank is unprintable, so most lines are seen to be normal as they are.
    """
    if not text:
        return []
    return [
        line if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " " else " ".join(line.split())
        for line in text.lower().split("\n")
    ]


def _coded(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """The code points of all normalised lines that aren't blank, each line's length, the place of its text in ``texts`` and its number there,
    and bytes of UTF-8 with each line's first and their number.

    Texts are read as arrays at once; those with white space to be taken out go line by line.
    """
    lower = [text.lower() if text else "" for text in texts]
    for again in (False, True):
        whole = "\n".join(lower)
        plain = whole.isascii()
        code = np.frombuffer(whole.encode() if plain else whole.encode("utf-32-le", "surrogatepass"), np.uint8 if plain else np.uint32)
        edge = code == 10
        ends = np.append(np.flatnonzero(edge), len(code))
        text = np.repeat(np.arange(len(lower)), [t.count("\n") + 1 for t in lower])
        if again or not len(code):
            break
        blank = code == 32
        odd = (code < 32) ^ edge
        odd[:-1] |= blank[:-1] & (blank[1:] | edge[1:])
        odd[1:] |= blank[1:] & edge[:-1]
        odd[[0, -1]] |= blank[[0, -1]]
        if not plain:  # all other white space is among these
            odd |= (code == 0x85) | (code == 0xA0) | (code >= 0x1680)
        if not odd.any():
            break
        for i in np.unique(text[np.searchsorted(ends, np.flatnonzero(odd))]).tolist():
            lower[i] = "\n".join(_normal_lines(texts[i]))
    size = np.diff(ends, prepend=-1) - 1
    first = np.searchsorted(text, np.arange(len(lower)))
    number, keep = np.arange(len(text)) - first[text], size > 0
    data = code if plain else np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
    ends = ends if plain else np.append(np.flatnonzero(data == 10), len(data))
    byte = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    return code[~edge].astype(np.uint32), size[keep], text[keep], number[keep], data, byte[keep], (ends - byte)[keep]


def _bytes_of(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The share of ``data`` that holds these lines, and where they are in it."""
    return data[first[0] : first[-1] + size[-1]], first - first[0], size


def _runs_of(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, tuple]]:
    """Code points, lengths, documents and numbers of the lines of the batch (doc_id, text) that aren't blank, and where their
    bytes are, about ``BLOCK`` characters at once."""
    texts, ids = part.column(1).to_pylist(), part.column(0)
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and held < 8 * BLOCK:
            held += len(texts[stop] or "")
            stop += 1
        code, size, text, number, data, byte, length = _coded(texts[at:stop])
        upto = np.cumsum(size)
        if len(size):
            cuts = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(BLOCK, upto[-1], BLOCK)) + 1, [len(size)]])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                yield code[upto[a] - size[a] : upto[b - 1]], size[a:b], ids.take(pa.array(at + text[a:b])), number[a:b], _bytes_of(data, byte[a:b], length[a:b])
        at = stop


def _emitted(docs: DataFrame, clashing: np.ndarray, node_bits: int) -> DataFrame:
    """kind 0: a line's doc_id, line_no, node and second hash; kind 1: of many lines the nodes, their numbers of shingles and
    band keys as arrays of bytes, every line's keys together, and how many keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for code, size, ids, number, places in _runs_of(batch):
                nodes, two = named(*places, clashing, node_bits)
                yield _rows(len(size), kind=np.zeros(len(size), np.int32), doc_id=ids, node=nodes, line_no=number.astype(np.int32), two=two)
                fresh = np.zeros(len(size), bool)  # copies within a task say the same
                for i, node in enumerate(nodes.tolist()):
                    if node not in seen:
                        fresh[i] = True
                        if len(seen) < SEEN:
                            seen.add(node)
                for fine, these in ((False, size >= BORDER), (True, size <= SHORT)):
                    take = fresh & these
                    if not take.any():
                        continue
                    own, length = code[np.repeat(take, size)], size[take]
                    if fine:
                        n, keys = np.maximum(length - FINE + 1, 1), band_keys(fine_signatures(own, length), FINE_ROWS, 1)
                    else:
                        n, signature = signatures(*shingle_hashes(own, length, SHINGLE, 32))
                        ends = np.cumsum(length)
                        for i in np.flatnonzero(length >= EXACT):
                            n[i] = len(np.unique(shingle_hashes(own[ends[i] - length[i] : ends[i]], length[i : i + 1], SHINGLE)[0]))
                        keys = band_keys(signature, ROWS, 0)
                    held = [nodes[take].tobytes(), n.astype(np.int32).tobytes(), keys.tobytes()]
                    yield _rows(1, kind=np.ones(1, np.int32), many=np.array([keys.size]), **{k: pa.array([v], pa.binary()) for k, v in zip(("nodes", "sizes", "keys"), held)})

    return docs.mapInArrow(run, ", ".join(f"{k} {kind}" for k, (kind, _) in _EMITTED.items()))


_EMITTED = {
    "kind": ("int", pa.int32()), "doc_id": ("long", pa.int64()), "node": ("long", pa.int64()), "line_no": ("int", pa.int32()), "two": ("long", pa.int64()),
    "many": ("long", pa.int64()), "nodes": ("binary", pa.binary()), "sizes": ("binary", pa.binary()), "keys": ("binary", pa.binary()),
}


def _rows(count: int, **columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    """A batch of what is emitted; columns that aren't given are null."""
    arrays = [pa.array(columns[k]) if k in columns else pa.nulls(count, kind) for k, (_, kind) in _EMITTED.items()]
    return pa.RecordBatch.from_arrays(arrays, names=[*_EMITTED])


def shared_keys(bands: DataFrame, percent: int = PERCENT, part: int = PART) -> DataFrame:
    """Of the ``bands`` emitted (many, nodes, sizes, keys) what keys of two nodes or more say: key, node, other, n, m.

    A key of up to ``FEW`` nodes is all its pairs node < other that may be similar by their sizes n <= m, any other a row for each of its
    nodes, whose other is null, and which may be given again. Keys go as arrays of bytes to as many parts as their number asks for, by
    their leading bits. Of a key that more lines of a task have, only ``ROWS_OF_KEY`` go there to show it: the key has more
    nodes than ``FEW`` then, and the other rows are spread over parts of their own, so that no key fills one.
    """
    total = bands.agg(F.sum("many")).first()[0] or 0
    parts = max(1, -(-total // part))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("nodes", "sizes", "keys"))):
                nodes, sizes, keys = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, (np.int64, np.int32, np.uint64)))
                bands = len(keys) // len(nodes)
                held.append((keys, np.repeat(nodes, bands), np.repeat(sizes, bands)))
                size += len(keys)
                if size >= part:
                    yield from _dealt(held, parts, part)
                    held, size = [], 0
        if held:
            yield from _dealt(held, parts, part)

    def met(key: tuple, table: pa.Table) -> pa.Table:
        columns = (b"".join(x.as_buffer() for x in table[c]) for c in ("keys", "nodes", "sizes"))
        keys, nodes, sizes = (np.frombuffer(x, kind) for x, kind in zip(columns, (np.uint64, np.int64, np.int32)))
        if key[0].as_py() >= parts:
            return _found(keys, nodes, sizes, np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys, nodes, sizes = _of_several(keys, nodes, sizes)[:3]
        first, count = _groups(keys)
        pairs = [np.zeros((2, 0), np.int64)]
        for c in range(2, FEW + 1):
            pairs.append((first[count == c] + np.array(np.triu_indices(c, 1))[:, :, None]).reshape(2, -1))
        x, y = np.concatenate(pairs, axis=1)
        n, m = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
        fit = _fits(n.astype(np.int64), m.astype(np.int64), percent)
        return _found(keys, nodes, sizes, x[fit], y[fit], np.flatnonzero(np.repeat(count > FEW, count)))

    sent = bands.select("nodes", "sizes", "keys").mapInArrow(spread, "part long, keys binary, nodes binary, sizes binary")
    return sent.groupBy("part").applyInArrow(met, "key long, node long, other long, n int, m int")


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and its length."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return first, np.diff(first, append=len(keys))


def _of_several(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows of keys that several nodes have, by key and node, each once, and where those of all other keys are."""
    own = np.sort(keys)
    twice = own[1:][own[1:] == own[:-1]]
    place = np.uint64((1 << 22) - 1)
    marks = np.zeros(1 << 22, bool)
    marks[(twice & place).view(np.int64)] = True
    met = marks[(keys & place).view(np.int64)]  # they, and a few others
    rest, order = np.flatnonzero(~met), np.flatnonzero(met)
    order = order[np.lexsort((nodes[order], keys[order]))]
    k, v = keys[order], nodes[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
    order = order[new]
    first, count = _groups(keys[order])
    alone = np.repeat(count == 1, count)
    rest, order = np.concatenate([rest, order[alone]]), order[~alone]
    return keys[order], nodes[order], sizes[order], rest


def _dealt(held: list[tuple], parts: int, part: int) -> Iterator[pa.RecordBatch]:
    """Arrays of keys, nodes and sizes as rows for the parts that they belong to."""
    columns = [np.concatenate(x) for x in zip(*held)]
    *shared, rest = _of_several(*columns)
    first, count = _groups(shared[0])
    shown = np.arange(len(shared[0])) - np.repeat(first, count) < ROWS_OF_KEY
    keys, nodes, sizes = (np.concatenate([x[rest], y[shown]]) for x, y in zip(columns, shared))
    to = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts < 1 << 16 else np.int64)
    order = np.argsort(to, kind="stable")
    to = to.astype(np.int64)
    cut = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
    yield _bytes(to[order][cut[:-1]], cut, keys[order], nodes[order], sizes[order])
    keys, nodes, sizes = (x[~shown] for x in shared)
    if len(keys):
        cut = np.append(np.arange(0, len(keys), part >> 3), len(keys))
        yield _bytes(parts + nodes[cut[:-1]] % parts, cut, keys, nodes, sizes)


def _bytes(to: np.ndarray, cut: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each part in ``to`` with the bytes of its share of the columns."""
    arrays = [pa.array(to)]
    for x in columns:
        ends = (cut * x.itemsize).astype(np.int32)
        arrays.append(pa.Array.from_buffers(pa.binary(), len(to), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))]))
    return pa.RecordBatch.from_arrays(arrays, names=["part", "keys", "nodes", "sizes"])


def _found(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, more: np.ndarray | None = None) -> pa.Table:
    """The pairs of the rows x and y, each once, and the rows ``more`` (all by default)."""
    order = np.lexsort((nodes[y], nodes[x]))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (nodes[x[1:]] != nodes[x[:-1]]) | (nodes[y[1:]] != nodes[y[:-1]])
    x, y = x[new], y[new]
    of = (nodes[x], nodes[y], np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y]))
    more = np.arange(len(keys)) if more is None else more
    none = pa.nulls(len(more), pa.int64())
    pairs = [pa.nulls(len(x), pa.int64()), *(pa.array(side, kind) for side, kind in zip(of, (pa.int64(), pa.int64(), pa.int32(), pa.int32())))]
    rows = [pa.array(keys[more].view(np.int64)), pa.array(nodes[more]), none, pa.array(sizes[more], pa.int32()), none.cast(pa.int32())]
    return pa.table({name: pa.chunked_array([a, b]) for name, a, b in zip(("key", "node", "other", "n", "m"), pairs, rows)})


def _fits(n, m, percent: int):
    """Whether lines of n and of m shingles, m not the smaller, may be similar; counts of distinct ones may be one or two too low."""
    return 100 * (n + 2) >= percent * m


def line_groups(docs: DataFrame, percent: int = PERCENT, node_bits: int = 64) -> DataFrame:
    """Every line that isn't blank: doc_id, line_no (from 0), line_key, keep_doc_id, keep_line_no, group_lines, kept.

    Lines are near copies when the Jaccard similarity of their shingles is ``percent`` or more: of two normalised
    lines of up to ``SHORT`` characters of those of 3 characters with their repeats, of others of the sets of
    those of 8 (a shorter line is one shingle). Groups
    are the connected components. The line of the smallest (doc_id, line_no) stays. A null
    or blank text has no lines, an empty table no rows. Rows repeated with the same id count as the same lines
    (each is given, and kept or not, as often). Other columns, whatever their names, are not read.

    Equal normalised lines are one node: a 64-bit hash, confirmed by a second one; lines that differ in the
    second alone get other nodes (``node_bits`` are those of the first; fewer only make more of this). Band keys are cut from whole lines; ``cluster`` verifies the candidates on the lines' characters.
    """
    docs = docs.select("doc_id", "text")
    in_small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        clashing, clashes = np.zeros(0, np.int64), True
        while clashes:
            emitted, path = written_at(_emitted(docs, clashing, node_bits), "lines", "kind")
            scratch.hold(emitted, f"{path}/kind=1")
            lines = emitted.where("kind = 0").select("doc_id", "line_no", "node", "two")
            firsts = F.min(F.struct("doc_id", "line_no")).alias("first")
            owners = scratch.written(
                lines.groupBy("node").agg(
                    F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("line_no", "doc_id"), F.min("line_no")).alias("line_no"),
                    F.min("two").alias("two"), F.max("two").alias("other"), F.count(F.lit(1)).alias("copies"),
                ), "owners"
            )
            # Of n lines about n^2 / 2^65 meet another: none here, a few in 10^11.
            clashes = owners.where("two <> other").select("node").toArrow()["node"].to_numpy()
            clashing = np.union1d(clashing, clashes)
            clashes = len(clashes) > 0
        found = scratch.written(shared_keys(emitted.where("kind = 1"), percent), "shared")
        scratch.drop(emitted)
        texts: list[DataFrame] = []

        def sketched(nodes: DataFrame) -> DataFrame:
            wanted = scratch.written(owners.select("node", "doc_id", "line_no").join(nodes, "node"), "wanted")
            texts.append(scratch.written(_load_lines(docs, wanted, clashing, node_bits, scratch), "line-texts"))
            return texts[0].drop("line")

        comps = cluster(
            found.where("other IS NULL").select("key", "node", "n", F.lit(0).alias("pos")),
            sketched,
            SKETCH,
            lambda pairs: scratch.written(_verified(pairs, texts[0].select("node", "line"), percent), "verified"),
            # Counts of distinct shingles may be one or two too low.
            lambda n, m: F.when(100 * (F.least(n, m) + 2) >= percent * F.greatest(n, m), F.floor((n + m + 4) * (100 - percent) / F.lit(100.0 + percent) + 1e-9)).otherwise(-1),
            lambda n, m, room: _fits(n, m, percent),
            found.where("other IS NOT NULL").select(F.col("node").alias("x"), F.col("other").alias("y"), "n", "m"),
        )
        # Most lines are a group by themselves, and are seen to be by the marks of all others.
        grouped = owners.where("copies > 1").select("node").unionByName(comps.select("node"))
        marked = likely(lines.drop("two"), "node", grouped, "node", "grouped")
        placed = marked.where("grouped").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        groups = placed.groupBy("comp").agg(firsts, F.count(F.lit(1)).alias("group_lines"))
        alone = marked.where("NOT grouped").withColumn("first", F.struct("doc_id", "line_no")).withColumn("group_lines", F.lit(1).cast("long"))
        columns = ["doc_id", "line_no", "node", "first", "group_lines"]
        return placed.join(groups, "comp").select(*columns).unionByName(alone.select(*columns)).select(
            "doc_id", "line_no", F.col("node").alias("line_key"), F.col("first.doc_id").alias("keep_doc_id"),
            F.col("first.line_no").alias("keep_line_no"), "group_lines",
            (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept"),
        )


def _load_lines(docs: DataFrame, wanted: DataFrame, clashing: np.ndarray, node_bits: int, scratch: Scratch) -> DataFrame:
    """(node, line and its parity sketch) of the ``wanted`` (node, doc_id, line_no) rows, each line from its owner document.

    Bitmaps of bounded size over the lines' places and the nodes' low bits let only likely lines be read and
    out of the tasks; the join on node and owner makes it exact.
    """
    low = (1 << 40) - 1
    marks, bits = bitmap_of(wanted, "node")
    of_lines, line_bits = bitmap_of(wanted.select((F.xxhash64("doc_id").bitwiseAND(low) + F.col("line_no").cast("long") * _LINE).alias("h")), "h")
    table = scratch.broadcast((marks, of_lines))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, of_lines = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [text.split("\n") if text else [] for text in part.column(1).to_pylist()]
                count = np.fromiter(map(len, texts), np.int64, len(texts))
                doc = np.repeat(np.arange(len(texts)), count)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                place = (part.column(2).to_numpy()[doc] & low) + number * _LINE
                found = np.flatnonzero(K.marked(of_lines, place & ((1 << line_bits) - 1)))
                lines = [normal(texts[d][k]) for d, k in zip(doc[found].tolist(), number[found].tolist())]
                full = np.flatnonzero(np.fromiter(map(bool, lines), bool, len(lines)))
                ids = part.column(0).take(pa.array(doc[found[full]]))
                for start, chunk in _chunks([line for line in lines if line]):
                    code, size = codes(chunk)
                    nodes, _ = identities(code, size, clashing, node_bits)
                    keep = K.marked(marks, nodes & ((1 << bits) - 1))
                    if not keep.any():
                        continue
                    sketch = np.zeros((len(chunk), SKETCH + 1), np.int64)
                    sketch[:, SKETCH] = size <= SHORT  # what kind of shingles it is of
                    for fine in (False, True):
                        take = keep & ((size <= SHORT) == fine)
                        if take.any():
                            hashes, count = members(code[np.repeat(take, size)], size[take], fine)
                            who = np.repeat(np.arange(len(count)), count)
                            if not fine:
                                new = _sorted_within(hashes, count)
                                hashes, who = hashes[new], who[new]
                            sketch[take, :SKETCH] = K.parity(hashes, who, len(count), SKETCH)
                    out = np.flatnonzero(keep)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(start + out)), pa.array(nodes[out]), pa.array([chunk[i] for i in out], pa.string()),
                         K.lists(sketch[out])], names=["doc_id", "node", "line", "sketch"],
                    )

    found = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("hash")).mapInArrow(run, "doc_id long, node long, line string, sketch array<long>")
    same = (found["node"] == wanted["node"]) & found["doc_id"].eqNullSafe(wanted["doc_id"])
    return found.join(wanted, same, "left_semi").dropDuplicates(["node"]).select("node", "line", "sketch")


def _verified(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS):
                part = batch.slice(at, PAIRS)
                both = pa.concat_arrays([part.column(2), part.column(3)]).dictionary_encode()
                index = both.indices.to_numpy()
                ok = similar_pairs(both.dictionary.to_pylist(), index[: part.num_rows], index[part.num_rows :], percent)
                yield part.select([0, 1]).filter(pa.array(ok))

    one, two = (lines.select(F.col("node").alias(end), F.col("line").alias(f"l{end}")) for end in ("y", "x"))
    return pairs.join(one, "y").join(two, "x").select("x", "y", "lx", "ly").mapInArrow(run, "x long, y long")


def drop_near_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the lines taken out that are near copies of a line that stays; blank lines stay.

    Null and empty texts stay as they are. Rows repeated with the same id lose the same lines. Columns of any
    name are kept as they are.
    """
    groups = line_groups(docs, percent)
    lost = groups.where(~F.col("kept")).groupBy("doc_id").agg(F.collect_set("line_no").alias("numbers"))
    lost = lost.select(F.struct(F.struct("doc_id").alias("of"), "numbers").alias("lost"))
    kept = F.array_join(F.transform(
        F.filter(F.transform(F.split("d.text", "\\n", -1), lambda line, i: F.struct(line.alias("line"), i.alias("i"))),
                 lambda p: ~F.coalesce(F.array_contains("lost.numbers", p["i"]), F.lit(False))),
        lambda p: p["line"],
    ), "\n")
    held = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"))
    return held.join(lost, F.struct("d.doc_id") == F.col("lost.of"), "left").select(
        *[kept.alias("text") if c == "text" else F.col("d")[c].alias(c) for c in docs.columns]
    )
