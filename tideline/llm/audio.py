"""Media columns: bytes as 8-bit PCM, polyphase resampling, log-mel patches as fixed-shape Arrow tensors, energy spans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches

RATE, UP, DOWN = 16_000, 3, 4  # 16 kHz in, 12 kHz after resampling
TAPS = 16  # of each polyphase branch
WINDOW_S, HOP_S, FFT, MELS, PATCH = 0.025, 0.010, 512, 24, 64
ON_DB, OFF_DB = 1.0, 0.0  # above a recording's median frame energy
BLOCK = 4096  # frames computed at once, whatever the length of a recording
HEADER = 44


def _le(value: Column, n: int) -> Column:
    """Little-endian bytes of a number."""
    byte = lambda k: F.unhex(F.lpad(F.hex(F.shiftright(value.cast("long"), 8 * k).bitwiseAND(F.lit(255))), 2, "0"))
    return F.concat(*[byte(k) for k in range(n)])


def with_wav(df: DataFrame, payload: str, media: str = "media", rate: int = RATE) -> DataFrame:
    """Add a column holding the binary payload losslessly as a mono 8-bit PCM WAV file (a sample is a byte).

    A null payload gives a null file; an odd number of samples gets the format's pad byte, which `samples` leaves out.
    """
    n = F.octet_length(payload)
    text = lambda s: F.lit(s).cast("binary")
    head = [text("RIFF"), _le(n + n % 2 + 36, 4), text("WAVEfmt "), _le(F.lit(16), 4), _le(F.lit(1), 2), _le(F.lit(1), 2), _le(F.lit(rate), 4), _le(F.lit(rate), 4), _le(F.lit(1), 2), _le(F.lit(8), 2), text("data"), _le(n, 4)]
    return df.withColumn(media, F.concat(*head, F.col(payload), F.when(n % 2 == 1, F.unhex(F.lit("00"))).otherwise(text(""))))


def samples(media: Column) -> Column:
    """The sample bytes of a file written by `with_wav`, by the length in its header."""
    n = sum((F.conv(F.hex(F.substring(media, 41 + k, 1)), 16, 10).cast("int") * (1 << 8 * k) for k in range(4)), F.lit(0))
    return F.substring(media, F.lit(HEADER + 1), n)


@lru_cache(maxsize=1)
def _filters() -> np.ndarray:
    """Windowed-sinc low-pass, one row of taps for each phase."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(UP, DOWN)) * np.hamming(n) * (UP / max(UP, DOWN))
    return h.reshape(TAPS, UP).T[:, ::-1].astype(np.float32).copy()


@lru_cache(maxsize=1)
def _mel() -> np.ndarray:
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60.0), mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * rate / FFT
    lo, mid, hi = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.maximum(0, np.minimum((f - lo) / (mid - lo), (hi - f) / (hi - mid))).T.astype(np.float32)


def resample(x: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Outputs start..stop of the polyphase resampler over the whole signal x (zero outside it): only needed taps run."""
    out = np.zeros(stop - start, np.float32)
    for r in range(UP):
        first = start + (r - start) % UP
        n = len(range(first, stop, UP))
        if not n:
            continue
        at, phase = divmod(first * DOWN, UP)
        lo, hi = at - TAPS + 1, at + (n - 1) * DOWN + 1
        part = np.zeros(hi - lo, np.float32)
        a, b = max(lo, 0), min(hi, len(x))
        if a < b:
            part[a - lo : b - lo] = x[a:b]
        acc = np.zeros(n, np.float32)
        for k, w in enumerate(_filters()[phase]):
            acc += w * part[k : k + (n - 1) * DOWN + 1 : DOWN]
        out[first - start :: UP] = acc
    return out


def log_mel(x: np.ndarray) -> np.ndarray:
    """Overlapped log-mel filterbank (frames x MELS) of a signal of samples in -1..1; at least one frame."""
    rate = RATE * UP // DOWN
    win, hop = int(WINDOW_S * rate), int(HOP_S * rate)
    total = -(-len(x) * UP // DOWN)
    frames = max(1, 1 + -(-(total - win) // hop))
    taper, out = np.hanning(win).astype(np.float32), np.empty((frames, MELS), np.float32)
    for f in range(0, frames, BLOCK):
        g = min(f + BLOCK, frames)
        y = resample(x, f * hop, (g - 1) * hop + win)
        view = np.lib.stride_tricks.sliding_window_view(y, win)[::hop]
        spectrum = np.fft.rfft(view * taper, FFT, axis=1)
        out[f:g] = np.log(np.square(spectrum.real) @ _mel() + np.square(spectrum.imag) @ _mel() + 1e-6)
    return out


def segments(energy_db: np.ndarray) -> list[tuple[int, int]]:
    """Hysteresis: a span opens at a frame ON_DB above the median and closes before one below OFF_DB above it."""
    e = energy_db - np.median(energy_db)
    mark = np.where(e >= ON_DB, 1, np.where(e < OFF_DB, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(e)), -1))
    on = np.where(last >= 0, mark[last] == 1, False)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], on.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


TENSOR = pa.fixed_shape_tensor(pa.float32(), [PATCH, MELS], dim_names=["frame", "mel"])
_SCHEMA = pa.schema([("log_mel", TENSOR), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())])


def tensor_bytes(mel: np.ndarray) -> bytes:
    """Arrow IPC stream of the frames in patches of a fixed shape (the last one padded with zeros) with time spans."""
    n = len(mel)
    patches = -(-n // PATCH)
    full = np.zeros((patches * PATCH, MELS), np.float32)
    full[:n] = mel
    storage = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), PATCH * MELS)
    first = np.arange(patches) * PATCH
    last = np.minimum(first + PATCH, n)
    cols = [pa.ExtensionArray.from_storage(TENSOR, storage), pa.array(first * HOP_S), pa.array((last - 1) * HOP_S + WINDOW_S), pa.array((last - first).astype(np.int32))]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _SCHEMA) as w:
        w.write_batch(pa.RecordBatch.from_arrays(cols, schema=_SCHEMA))
    return sink.getvalue().to_pybytes()


def audio_features(media: DataFrame, id_col: str, media_col: str = "media") -> DataFrame:
    """(id, media, tensors binary, segments array<struct<start_s, end_s>>) for files written by `with_wav`.

    `tensors` is an Arrow stream whose `log_mel` column has the fixed-shape tensor type. A null file gives null
    features; an empty one a single frame of silence. Repeated rows stay repeated, an empty table gives an empty
    result; a file's features depend on its bytes alone. Memory is bounded by the longest file, in blocks of BLOCK frames.
    """
    small_batches(media.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
        for b in batches:
            tensors, spans = [], []
            for wav in b.column(1):
                raw = wav.as_buffer()
                if raw is None:
                    tensors.append(None), spans.append(None)
                    continue
                n = int(np.frombuffer(raw, "<u4", 1, 40)[0])
                x = (np.frombuffer(raw, np.uint8, n, HEADER).astype(np.float32) - 128) / 128
                mel = log_mel(x)
                tensors.append(tensor_bytes(mel))
                db = 10 / np.log(10) * np.log(np.exp(mel).sum(axis=1, dtype=np.float64))
                spans.append([(round(s * HOP_S, 3), round((e - 1) * HOP_S + WINDOW_S, 3)) for s, e in segments(db)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tensors, pa.binary()), pa.array([s and [{"start_s": x, "end_s": y} for x, y in s] if s is not None else None for s in spans], span)], ["id", "media", "tensors", "segments"])

    rows = media.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, media binary, tensors binary, segments array<struct<start_s:double,end_s:double>>")
