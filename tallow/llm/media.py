"""Media columns: text bytes as 8-bit WAV samples, their spectrogram, and spectral-peak pair fingerprints.

A text's UTF-8 bytes, filled up with zeros to a positive multiple of 64, become the samples of a mono 8-bit WAV.
The stored form is read back with the wave module; its samples give a short-time Fourier transform whose local
maxima (peaks) are paired with the peaks that follow them. A pair is one code (frequency, frequency, distance in
frames) with the frame of its first peak: the time-coded array that audio fingerprinting matches on.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

RATE, ALIGN = 8000, 64
#: Samples in a frame and from one frame to the next; frames in one block of the transform, which bounds memory.
FRAME, HOP, BLOCK = 256, 128, 2048
#: Peaks kept in a frame (the strongest), frames ahead that a pair may span, partners of each peak.
PEAKS, SPAN, FAN = 3, 8, 4

_WINDOW = np.hanning(FRAME)


def to_wav(payload: bytes) -> bytes:
    """payload as the samples of a mono 8-bit WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


def padded(data: bytes) -> bytes:
    return data + bytes(max(ALIGN, -(-len(data) // ALIGN) * ALIGN) - len(data))


def peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frames and frequency bins of the peaks, in order of frame and bin.

    A peak is above both neighbours in its frame and not below the same bin of the frames beside it; of a
    frame's peaks the PEAKS strongest count, the lower bin first where they tie.
    """
    x = np.frombuffer(samples, np.uint8)
    n = max(1, -(-(len(x) - FRAME) // HOP) + 1)
    x = np.concatenate([x, np.full((n - 1) * HOP + FRAME - len(x), 128, np.uint8)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    at, bins = [], []
    for first in range(0, n, BLOCK):
        lo, hi = max(0, first - 1), min(n, first + BLOCK + 1)
        # double precision, rounded, so that equal spectra compare as equal wherever they stand
        power = np.round(np.abs(np.fft.rfft((frames[lo:hi] - 128.0) * _WINDOW, axis=1)), 2)
        mid = power[:, 1:-1]
        top = (mid > power[:, :-2]) & (mid > power[:, 2:])
        top[1:] &= mid[1:] >= mid[:-1]
        top[:-1] &= mid[:-1] >= mid[1:]
        kept = slice(first - lo, first - lo + min(BLOCK, n - first))
        strength = np.where(top[kept], mid[kept], 0.0)
        best = np.argsort(-strength, axis=1, kind="stable")[:, :PEAKS]
        best.sort(axis=1)
        there = np.take_along_axis(strength, best, axis=1) > 0
        f, k = np.nonzero(there)
        at.append(f + first)
        bins.append(best[f, k] + 1)
    return np.concatenate(at), np.concatenate(bins)


def pairs(at: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time and code of each pair: a peak with each of the FAN next ones up to SPAN frames later."""
    times, codes = [], []
    for step in range(1, FAN + 1):
        if len(at) <= step:
            break
        gap = at[step:] - at[:-step]
        near = gap <= SPAN
        times.append(at[:-step][near])
        codes.append(((bins[:-step] << 16) | (bins[step:] << 8) | gap)[near])
    if not times:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order], c[order]


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, n_frames long, pair_times array<int>, pair_codes array<int>"
)


def _media(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo in range(0, len(ids), 256):
            rows = []
            for doc, text in zip(ids[lo : lo + 256].to_pylist(), texts[lo : lo + 256], strict=True):
                data = text.as_buffer().to_pybytes()
                stored = to_wav(padded(data))
                back = from_wav(stored)
                t, c = pairs(*peaks(back))
                digest = hashlib.sha256(back).hexdigest()
                frames = max(1, -(-(len(back) - FRAME) // HOP) + 1)
                rows.append((doc, len(data), len(back), digest, zlib.crc32(back[-ALIGN:]), len(stored), hashlib.sha256(stored).hexdigest(), frames, t.astype(np.int32), c.astype(np.int32)))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()] + [pa.list_(pa.int32())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds, strict=True)], names)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, sizes and digests of payload and stored form, n_frames, pair_times, pair_codes.

    A null text counts as empty and gives 64 zero bytes. Equal texts give equal values; repeated rows and null
    identifiers are kept. An empty table gives an empty result; other columns of docs are ignored.
    Memory: one block of frames at a time, whatever the text's length.
    """
    return shared.map_arrow(docs.select(F.col(id_col).cast("long"), shared.text_of(text_col).cast("binary")), _media, SCHEMA)


def op3_media_columns(spark, sf_dir):
    """The fingerprint itself, and as one string: number of pairs, then the SHA-256 of its time:code list."""
    listed = F.array_join(F.zip_with("pair_times", "pair_codes", lambda t, c: F.concat(t, F.lit(":"), c)), " ")
    feature = F.concat(F.size("pair_codes").cast("string"), F.lit(":"), F.sha2(listed, 256))
    return media_columns(shared.table(spark, sf_dir, "documents")).withColumn("feature", feature)
