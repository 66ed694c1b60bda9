"""Media columns: texts as 8-bit WAV samples, read back, and spectral-peak pairs.

The UTF-8 bytes of a text, padded with blanks to a positive multiple of 192, are
written as 8-bit mono samples by the wave module; that is the stored column.
The stored bytes are read back; a short-time Fourier transform (Hann frames of
192 samples, hop 96, the offset of the samples taken off) gives magnitudes. A
peak is a cell above its four neighbours in time and frequency (of equal ones
the first counts); the PEAKS strongest of each frame stay. Each peak is paired
with the next FAN_OUT peaks of later frames, at most REACH frames on. A
fingerprint is a time-coded entry: frame of the first peak, its bin, the
second's bin, frames between, all in full.

Defined cases: null is the empty text, which is 192 blanks; a null id is kept;
other columns are ignored; equal texts give equal values, as every number depends
on one text only.
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

from ..shipping import ship
from . import _text as X

BLOCK = 192
HOP = 96
RATE = 8000
PEAKS = 3  # of one frame
FAN_OUT = 3  # pairs begun by one peak
REACH = 32  # frames between the peaks of a pair, at most
_WINDOW = np.hanning(BLOCK)
_CHUNK = 4096  # frames transformed at once


def pad(data: bytes) -> bytes:
    return data + b" " * (-len(data) % BLOCK or BLOCK * (not data))


def encode(payload: bytes) -> bytes:
    """The payload as a WAV file of 8-bit mono samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def decode(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def magnitudes(samples: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Frames [first, last) by frequency bins; bins 0 and 1, which hold the window's share of the offset, are zero."""
    x = np.frombuffer(samples, np.uint8).astype(np.float64) - 128.0
    frames = np.lib.stride_tricks.sliding_window_view(x, BLOCK)[::HOP][first:last]
    power = np.abs(np.fft.rfft(frames * _WINDOW, axis=1)).astype(np.float32)
    power[:, :2] = 0
    return power


def spectral_peaks(samples: bytes) -> np.ndarray:
    """(frame, bin) of the peaks, by frame and bin; long texts are transformed in parts that overlap by a frame."""
    n = (len(samples) - BLOCK) // HOP + 1
    found = []
    for a in range(0, n, _CHUNK):
        before, after = min(a, 1), min(n - min(n, a + _CHUNK), 1)
        power = magnitudes(samples, a - before, min(n, a + _CHUNK) + after)
        edged = np.pad(power, 1, constant_values=-1.0)
        up, down, left, right = edged[:-2, 1:-1], edged[2:, 1:-1], edged[1:-1, :-2], edged[1:-1, 2:]
        peak = (power > 0) & (power > up) & (power >= down) & (power > left) & (power >= right)
        power = np.where(peak, power, 0)[before : len(power) - after]
        strong = np.argsort(-power, axis=1, kind="stable")[:, :PEAKS]
        frame, which = np.nonzero(np.take_along_axis(power, strong, 1))
        found.append(np.stack([frame + a, strong[frame, which]], 1))
    peaks = np.concatenate(found)
    return peaks[np.lexsort((peaks[:, 1], peaks[:, 0]))]


def fingerprints(peaks: np.ndarray, fan_out: int = FAN_OUT, reach: int = REACH) -> np.ndarray:
    """(frame, first bin, second bin, frames between) of each peak and the next peaks of later frames, by frame and bin."""
    frame = peaks[:, 0]
    later = np.searchsorted(frame, frame, side="right")
    rows = []
    for step in range(fan_out):
        j = later + step
        i = np.flatnonzero(j < len(peaks))
        i = i[frame[j[i]] - frame[i] <= reach]
        rows.append(np.stack([frame[i], peaks[i, 1], peaks[j[i], 1], frame[j[i]] - frame[i], i, np.full(len(i), step)], 1))
    found = np.concatenate(rows)
    return found[np.lexsort((found[:, 5], found[:, 4])), :4]


def pair_codes(prints: np.ndarray) -> np.ndarray:
    """First bin << 40 | second bin << 32 | frames between."""
    return prints[:, 1] << 40 | prints[:, 2] << 32 | prints[:, 3]


def _stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in X.slices(batches, "text"):
        data = X.text_bytes(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t) for t in data], pa.int64()), pa.array([encode(pad(t)) for t in data], pa.binary())],
            names=["doc_id", "n_bytes", "media"],
        )


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in X.slices(batches, "media"):
        payloads = [decode(m) for m in batch.column("media").to_pylist()]
        prints = [fingerprints(spectral_peaks(p)) for p in payloads]
        cuts = np.cumsum([0] + [len(p) for p in prints])
        every = np.concatenate(prints)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "n_bytes", "media")),
                pa.array([len(p) for p in payloads], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                X.list_array(every[:, 0].astype(np.int32), cuts, pa.int32()),
                X.list_array(pair_codes(every), cuts, pa.int64()),
            ],
            names=["doc_id", "n_bytes", "media", "payload_bytes", "payload_sha256", "tail_crc32", "times", "pairs"],
        )


def media_columns(docs: DataFrame) -> DataFrame:
    """The WAV bytes of every text, digests of what is read back from them, and fingerprints as arrays times and pairs.

    pairs holds pair_codes, by place with times.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = rows.mapInArrow(_stored_rows, "doc_id long, n_bytes long, media binary")
    return stored.mapInArrow(
        _feature_rows,
        "doc_id long, n_bytes long, media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, times array<int>, pairs array<long>",
    )


def media_digest(docs: DataFrame) -> DataFrame:
    """One row per document with the digests of its media column; feature is a hash of the fingerprint arrays."""
    return media_columns(docs).select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        "payload_sha256",
        "tail_crc32",
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.size("times"), F.hex(F.xxhash64("times", "pairs"))).alias("feature"),
    )
