"""Media columns (operator 4): texts' bytes as 8-bit WAV, and spectral-peak pair fingerprints.

A payload of bytes is stored as the samples of a one-channel 8-bit WAV by the wave module, in a table of media in the
shared folder. Reading that table takes the samples back, transforms overlapping windows to the frequency domain, takes in each band of each window the strongest bin that
no neighbouring window exceeds as a peak, and pairs each peak with the others of its window and of the next ones: code (both bins and the distance) and
time of each pair are stored as two arrays, in a table of features beside it. Every step works on one payload at a time, so equal texts have equal values.
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

from loomspark.llm.scratch import written

#: Payload granule and window, hop, bands of a window, windows that a peak looks ahead, and windows in one transform.
GRANULE = WINDOW = 576
HOP = 288
BANDS = 4
AHEAD = 3
AT_ONCE = 1024
RATE = 8000
#: Bytes of media in one output batch.
BATCH = 8 << 20
_HANN = np.hanning(WINDOW).astype(np.float32)


def payload_of(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % GRANULE if text else GRANULE)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def spectral_peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strongest bin and its magnitude, windows by bands. The constant part of a window is left out."""
    n = (len(samples) - WINDOW) // HOP + 1
    width = (WINDOW // 2) // BANDS
    bins, mags = np.empty((n, BANDS), np.int32), np.empty((n, BANDS), np.float32)
    for at in range(0, n, AT_ONCE):
        m = min(AT_ONCE, n - at)
        part = samples[at * HOP : (at + m - 1) * HOP + WINDOW].astype(np.float32) - np.float32(128)
        frames = np.lib.stride_tricks.sliding_window_view(part, WINDOW)[::HOP] * _HANN
        spectrum = np.abs(np.fft.rfft(frames, axis=1))[:, 1 : 1 + width * BANDS].reshape(m, BANDS, width)
        best = spectrum.argmax(axis=2)
        mags[at : at + m] = np.take_along_axis(spectrum, best[:, :, None], 2)[:, :, 0]
        bins[at : at + m] = best + 1 + width * np.arange(BANDS)
    return bins, mags


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, times) of the peak pairs, by time of the first peak, then distance, then bins."""
    bins, mags = spectral_peaks(samples)
    peak = np.ones(mags.shape, bool)
    peak[1:] &= mags[1:] >= mags[:-1]
    peak[:-1] &= mags[:-1] >= mags[1:]
    codes, times = [], []
    for step in range(min(AHEAD, len(bins) - 1) + 1):
        both = peak[: len(peak) - step, :, None] & peak[step:, None, :]
        if not step:
            both &= np.arange(BANDS)[:, None] < np.arange(BANDS)
        t, i, j = np.nonzero(both)
        codes.append(bins[t, i] | (bins[t + step, j] << 9) | (step << 18))
        times.append(t)
    c, t = np.concatenate(codes).astype(np.int32), np.concatenate(times).astype(np.int32)
    order = np.lexsort((c, t))
    return c[order], t[order]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, media, held = [], [], [], 0
        for doc, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary()), strict=True):
            raw = text.as_py() or b""
            ids.append(doc.as_py())
            sizes.append(len(raw))
            media.append(to_wav(payload_of(raw)))
            held += len(media[-1])
            if held >= BATCH:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())],
                    ["doc_id", "n_bytes", "media"],
                )
                ids, sizes, media, held = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())],
                ["doc_id", "n_bytes", "media"],
            )


def store_media(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text (null: empty) as the bytes of a WAV file. One row per row, other columns are
    left out; an empty table gives an empty result. A row without doc_id, one that repeats an id or a text, and a text of
    any length each have a file of their own."""
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _store, "doc_id bigint, n_bytes bigint, media binary"
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 1000):
            piece, rows = batch.slice(at, 1000), []
            for media in piece.column("media").to_pylist():
                payload = from_wav(media)
                codes, times = fingerprint(np.frombuffer(payload, np.uint8))
                rows.append(
                    (
                        len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media),
                        hashlib.sha256(media).hexdigest(), codes, times,
                    )
                )
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("n_bytes"), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4]), pa.array(cols[5], pa.list_(pa.int32())), pa.array(cols[6], pa.list_(pa.int32()))],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "codes", "times"],
            )


def media_features(media: DataFrame) -> DataFrame:
    """Features of stored media (doc_id, n_bytes, media): digests of what is read back, and the pair fingerprint."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        _features,
        "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, "
        "media_bytes bigint, media_sha256 string, codes array<int>, times array<int>",
    )


def op4_media(spark, sf_dir: str) -> DataFrame:
    """Every text stored as WAV, read back and fingerprinted; `feature` digests the time-coded pairs as they are stored."""
    media = written(store_media(spark.read.parquet(f"{sf_dir}/documents.parquet")), "media", "zstd")
    found = written(media_features(media), "features", "zstd")
    pairs = F.array_join(F.zip_with("codes", "times", lambda c, t: F.concat_ws("@", c, t)), ",")
    return found.select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        "payload_sha256",
        "tail_crc32",
        "media_bytes",
        "media_sha256",
        F.concat_ws(":", F.size("codes"), F.sha2(pairs, 256)).alias("feature"),
    )
