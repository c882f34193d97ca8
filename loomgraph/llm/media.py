"""Media columns: bytes stored as WAV samples, with spectral-peak fingerprints read back from them."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes to which a payload is padded, the rate written in the file, and the frame of the transform.
PAD, RATE, FRAME, HOP = 64, 8000, 256, 128
#: Frames of the target zone behind a peak, and the peaks that one peak is paired with.
ZONE, FAN = 8, 3
#: Borders of the frequency bands, each giving a frame's strongest bin.
BANDS = (1, 8, 16, 32, 64, 129)


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """The payload as 8-bit mono samples in a WAV file; WAV keeps 8-bit samples as they are."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as r:
        return r.readframes(r.getnframes())


def padded(raw: bytes) -> bytes:
    """``raw`` with bytes 0 up to a positive multiple of ``PAD``."""
    return raw + bytes(max(PAD, -(-len(raw) // PAD) * PAD) - len(raw))


def peaks(samples: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers and frequency bins of the spectral peaks, by frame and then bin.

    A frame's strongest bin in each band counts if it exceeds the frame's mean over all
    bins. Silence is added up to a whole number of hops, one frame at least, so that every
    sample lies in a frame. The short-time transform goes ``block`` frames at a time, so memory is bounded
    however long the samples are.
    """
    x = samples.astype(np.float32) - 128.0
    whole = max(FRAME, -(-len(x) // HOP) * HOP)
    if len(x) < whole:
        x = np.pad(x, (0, whole - len(x)))
    count = 1 + (len(x) - FRAME) // HOP
    window = np.hanning(FRAME).astype(np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    times, bins = [], []
    for at in range(0, count, block):
        power = np.abs(np.fft.rfft(frames[at : at + block] * window, axis=1))
        floor = power.mean(axis=1)
        best = np.stack([power[:, a:b].argmax(axis=1) + a for a, b in zip(BANDS, BANDS[1:])], axis=1)
        strong = np.take_along_axis(power, best, axis=1) > floor[:, None]
        t, band = np.nonzero(strong)
        times.append(t + at)
        bins.append(best[t, band])
    return np.concatenate(times).astype(np.int64), np.concatenate(bins).astype(np.int64)


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time-coded pairs: codes (bin, later bin, frames between) and the frame of each first peak."""
    t, f = peaks(samples)
    codes, at = [], []
    for step in range(1, FAN * len(BANDS)):
        if step >= len(t):
            break
        gap = t[step:] - t[:-step]
        # FAN peaks of later frames: the ones that follow the peaks of the same frame.
        later = np.flatnonzero((gap > 0) & (gap <= ZONE))
        codes.append((f[later] << 12) | (f[later + step] << 4) | gap[later])
        at.append(later)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, first = np.concatenate(codes), np.concatenate(at)
    order = np.lexsort((np.arange(len(code)), first))
    code, first = code[order], first[order]
    start = np.searchsorted(first, first)
    near = np.arange(len(first)) - start < FAN
    return code[near], t[first[near]]


MEDIA_FIELDS = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
    "media_bytes long, media_sha256 string, media binary, codes array<long>, times array<long>"
)


def with_media(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """Each row's text as a WAV column with its fingerprint.

    Null text counts as empty. The payload is the UTF-8 text, padded; the file is read
    back before anything is computed from it. With ``digest`` the media and the arrays
    are left out and ``feature`` names them: the count of pairs and their SHA-256.
    Otherwise ``media``, ``codes`` and ``times`` hold them. Equal texts give equal
    values. Other columns are ignored; an empty table gives no rows.
    """
    head = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, "
    fields = MEDIA_FIELDS.split(", media binary")[0] + ", feature string" if digest else MEDIA_FIELDS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64 if not digest else 1024):
                part = batch.slice(at, 64 if not digest else 1024)
                rows = [one(text) for text in part.column(1)]
                columns = [part.column(0), *(pa.array(c) for c in zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, names=names).cast(schema)

    def one(text: pa.Scalar) -> tuple:
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        stored = to_wav(padded(raw))
        payload = from_wav(stored)
        codes, times = fingerprint(np.frombuffer(payload, np.uint8))
        figures = (
            len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]),
            len(stored), hashlib.sha256(stored).hexdigest(),
        )
        if not digest:
            return (*figures, stored, codes.tolist(), times.tolist())
        packed = np.stack([codes, times], axis=1).astype("<i8").tobytes()
        return (*figures, f"{len(codes)}:{hashlib.sha256(packed).hexdigest()}")

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark_schema = StructType.fromDDL(head + fields)
    schema = to_arrow_schema(spark_schema)
    names = schema.names
    return docs.select(id_col, text_col).mapInArrow(run, spark_schema)
