"""Signal operators over arrays of samples, and kernels for what arrays can't express."""

from __future__ import annotations

import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators.intervals import merge_spans

FRAME_S = 0.02
CLIPPED = 0.999


def decibel(power: Column) -> Column:
    return 10 * F.log10(F.greatest(power, F.lit(1e-12)))


def mean_square(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x) / F.size(samples)


def peak(samples: Column) -> Column:
    return F.array_max(F.transform(samples, F.abs)).cast("double")


def frame_powers(samples: Column, hop: Column) -> Column:
    """Mean squares of whole frames of ``hop`` samples."""
    n = F.floor(F.size(samples) / hop).cast("int")
    frames = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    return F.when(n > 0, F.transform(frames, lambda k: mean_square(F.slice(samples, k * hop + 1, hop)))).otherwise(F.array().cast("array<double>"))


def percentile_of(values: Column, share: float) -> Column:
    """Linear between the two nearest ranks of an array of doubles."""
    s = F.array_sort(values)
    at = (F.size(values) - 1) * share
    low = F.floor(at).cast("int")
    a, b = F.try_element_at(s, low + 1), F.coalesce(F.try_element_at(s, low + 2), F.try_element_at(s, low + 1))
    return a + (b - a) * (at - low)


def signal_metrics(clips: DataFrame, rate: Column) -> DataFrame:
    """``clips`` (samples) with rms_dbfs, peak_dbfs, clip_ratio, snr_est_db; null for empty clips."""
    hop = F.greatest(F.lit(1), F.floor(rate * FRAME_S)).cast("int")
    c = clips.withColumn("_p", frame_powers(F.col("samples"), hop))
    snr = F.least(F.lit(100.0), decibel(percentile_of(F.col("_p"), 0.9)) - decibel(percentile_of(F.col("_p"), 0.1)))
    some = F.size("samples") > 0
    return c.withColumns(
        {
            "rms_dbfs": F.when(some, decibel(mean_square(F.col("samples")))),
            "peak_dbfs": F.when(some, 20 * F.log10(F.greatest(peak(F.col("samples")), F.lit(1e-6)))),
            "clip_ratio": F.when(some, F.size(F.filter("samples", lambda x: F.abs(x) >= CLIPPED)) / F.size("samples")),
            "snr_est_db": F.when(some, F.when(F.size("_p") >= 10, snr).otherwise(0.0)),
        }
    ).drop("_p")


def energy_vad(clips: DataFrame, keys: list[str], rate: int, frame_ms: float = 30.0, margin_db: float = 12.0, floor: float = 0.1, absolute_db: float = -55.0, min_speech: float = 0.25, min_silence: float = 0.3) -> DataFrame:
    """Spans in seconds whose frames are louder than the quiet ones by a margin."""
    hop = max(1, int(rate * frame_ms / 1000))
    c = clips.select(*keys, frame_powers(F.col("samples"), F.lit(hop)).alias("p")).where(F.size("p") > 0)
    c = c.withColumn("db", F.transform("p", lambda x: 10 * F.log10(x + 1e-12))).withColumn("limit", F.greatest(percentile_of(F.col("db"), floor) + margin_db, F.lit(absolute_db)))
    frames = c.select(*keys, "limit", F.posexplode("db").alias("k", "level")).where(F.col("level") > F.col("limit"))
    spans = frames.select(*keys, (F.col("k") * hop / rate).alias("start"), ((F.col("k") + 1) * hop / rate).alias("end"))
    touching = merge_spans(spans, keys, 1e-9)
    return merge_spans(touching, keys, min_silence).where(F.col("end") - F.col("start") >= min_speech)


def to_mono(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def fit_length(samples: Column, length: int) -> Column:
    """Cut or padded with zeros."""
    return F.slice(F.concat(samples, F.transform(F.array_repeat(F.lit(0.0), length), lambda x: x)), 1, length)


def apply_fade(samples: Column, rate: int, fade_ms: float) -> Column:
    """Linear ramps at both ends, of half the clip at most."""
    n = F.least(F.lit(int(rate * fade_ms / 1000)), F.floor(F.size(samples) / 2)).cast("int")
    step = F.try_divide(F.lit(1.0), n - 1)

    def gain(i: Column) -> Column:
        edge = F.least(i, F.size(samples) - 1 - i)
        return F.when(edge < n, F.coalesce(edge * step, F.lit(0.0))).otherwise(1.0)

    return F.transform(samples, lambda x, i: x * gain(i))


def normalize(samples: Column, mode: str, target_db: float) -> Column:
    """Scaled to a peak or an RMS level, the peak under -1 dBFS; near silence and mode none stay."""
    if mode == "none":
        return samples
    if mode not in ("peak", "rms"):
        raise ValueError(f"no such mode: {mode}")
    level = peak(samples) if mode == "peak" else F.sqrt(mean_square(samples))
    gain = 10 ** (target_db / 20) / level
    limited = F.least(gain, 10 ** (-1 / 20) / peak(samples))
    return F.when(F.coalesce(level, F.lit(0.0)) < 1e-6, samples).otherwise(F.transform(samples, lambda x: x * limited))


# -- kernels -----------------------------------------------------------------------------


def resample(x: np.ndarray, rate: int, to: int, zeros: int = 16) -> np.ndarray:
    """Windowed-sinc resampling to ``round(len * to / rate)`` samples."""
    if rate == to or not len(x):
        return np.asarray(x, np.float32)
    n = round(len(x) * to / rate)
    cutoff = min(1.0, to / rate)
    half = int(np.ceil(zeros / cutoff))
    at = np.arange(n) * (rate / to)
    left = np.floor(at).astype(int)[:, None] + np.arange(-half + 1, half + 1)
    t = at[:, None] - left
    taps = cutoff * np.sinc(cutoff * t) * np.where(np.abs(t) < half, 0.5 + 0.5 * np.cos(np.pi * t / half), 0)
    inside = (left >= 0) & (left < len(x))
    return (taps * np.where(inside, np.asarray(x)[np.clip(left, 0, len(x) - 1)], 0)).sum(1).astype(np.float32)


def crossfaded(chunks: list[np.ndarray], edges: list[int], overlap: int, total: int) -> np.ndarray:
    """Chunks read with ``overlap`` beyond their core edges, joined by linear crossfades and cut to [-1, 1]."""
    out, weight = np.zeros(total), np.zeros(total)
    for k, y in enumerate(chunks):
        a, b = max(0, edges[k] - overlap), min(total, edges[k + 1] + overlap)
        gain = np.ones(b - a)
        if k:
            m = min(2 * overlap, b - a)
            gain[:m] = np.linspace(0.0, 1.0, m)
        if k < len(chunks) - 1:
            m = min(2 * overlap, b - a)
            gain[len(gain) - m :] = 1 - np.linspace(0.0, 1.0, m)
        out[a:b] += gain * np.asarray(y)[: b - a]
        weight[a:b] += gain
    return np.clip(out / np.where(weight > 0, weight, 1), -1, 1)


def ctc_align(log_probs: np.ndarray, tokens: list[int], blank: int) -> list[int] | None:
    """Frame at which each token is emitted on the best path (staying emits a blank); none if they don't fit."""
    frames, count = len(log_probs), len(tokens)
    if not 0 < count <= frames:
        return None
    score = np.full(count + 1, -np.inf)
    score[0] = 0.0
    moved = np.zeros((frames, count + 1), bool)
    for t, row in enumerate(log_probs):
        stay = score + row[blank]
        step = np.append(-np.inf, score[:-1] + row[tokens])
        moved[t] = step > stay
        score = np.where(moved[t], step, stay)
    if not np.isfinite(score[count]):
        return None
    out, j = [], count
    for t in range(frames - 1, -1, -1):
        if j and moved[t, j]:
            out.append(t)
            j -= 1
    return out[::-1] if j == 0 else None


def align_tokens(rows: DataFrame, blank: int) -> DataFrame:
    """``rows`` (id, emissions array<array<double>>, tokens array<int>) with frames, in Arrow batches."""

    @F.pandas_udf("array<int>")
    def frames(emissions: pd.Series, tokens: pd.Series) -> pd.Series:
        return pd.Series([ctc_align(np.array(e.tolist()), list(t), blank) for e, t in zip(emissions, tokens, strict=True)])

    return rows.withColumn("frames", frames("emissions", "tokens"))


def read_wav(path: str, start: float = 0.0, end: float | None = None) -> tuple[np.ndarray, int]:
    """Mono float samples of a 16-bit PCM file between two times, and the rate."""
    with wave.open(path, "rb") as f:
        if f.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM is read")
        rate, total = f.getframerate(), f.getnframes()
        a = min(max(round(start * rate), 0), total)
        b = total if end is None else min(max(round(end * rate), a), total)
        f.setpos(a)
        x = np.frombuffer(f.readframes(b - a), "<i2").reshape(-1, f.getnchannels())
        return (x.mean(1) / 32768).astype(np.float32), rate


def write_wav(path: str, samples: np.ndarray, rate: int) -> None:
    with wave.open(path, "wb") as f:
        f.setnchannels(1), f.setsampwidth(2), f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).round().astype("<i2").tobytes())
