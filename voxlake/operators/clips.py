"""Clip-level operators: export jobs, windows for embedding and scoring, speech prefixes, time gaps."""

from __future__ import annotations

import os
import uuid
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators import signal
from voxlake.operators.segments import window_starts


def shape(x: np.ndarray, rate: int, fade_ms: float = 10.0, mode: str = "peak", target_db: float = -1.0) -> np.ndarray:
    """A clip faded at both ends and scaled: the array form of apply_fade and normalize."""
    x = np.array(x, np.float32)
    n = min(int(rate * fade_ms / 1000), len(x) // 2)
    if n > 0:
        ramp = np.linspace(0, 1, n, dtype=np.float32)
        x[:n] *= ramp
        x[len(x) - n :] *= ramp[::-1]
    level = 0.0 if mode == "none" or not len(x) else float(np.abs(x).max() if mode == "peak" else np.sqrt(np.mean(x**2)))
    if level >= 1e-6:
        x *= min(10 ** (target_db / 20) / level, 10 ** (-1 / 20) / float(np.abs(x).max()))
    return x


def export_clips(jobs: DataFrame, out: str, rate: int = 24000, fade_ms: float = 10.0, mode: str = "peak", target_db: float = -1.0, partitions: int | None = None) -> DataFrame:
    """Write a WAV file for each job (media, start, end, path): path, seconds, error. ``out`` is a mounted folder that tasks share.

    Files are written aside and renamed, so that a task that runs again leaves whole files; existing ones are replaced.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for j in pdf.itertuples(index=False):
                try:
                    x, sr = signal.read_wav(j.media, j.start, j.end)
                    y = shape(signal.resample(x, sr, rate), rate, fade_ms, mode, target_db)
                    to = os.path.join(out, j.path)
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    aside = f"{to}.{uuid.uuid4().hex}"
                    signal.write_wav(aside, y, rate)
                    os.replace(aside, to)
                    rows.append((j.path, len(y) / rate, None))
                except Exception as e:  # one clip's failure isn't another's
                    rows.append((j.path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "seconds", "error"])

    jobs = jobs.select("media", "start", "end", "path").dropDuplicates(["path"])
    return (jobs.repartition(partitions, "path") if partitions else jobs).mapInPandas(run, "path string, seconds double, error string")


def clip_windows(clips: DataFrame, rate: int, window_s: float, hop_s: float, least_rms: float | None = None) -> DataFrame:
    """``clips`` (samples) cut to windows: window (number), at (seconds), samples; silent ones go if ``least_rms`` is given."""
    window, hop = int(window_s * rate), int(hop_s * rate)
    starts = window_starts(F.size("samples").cast("long"), window, hop)
    out = clips.withColumn("_all", F.col("samples")).select(*[c for c in clips.columns if c != "samples"], "_all", F.posexplode(starts).alias("window", "_a"))
    out = out.withColumn("samples", F.slice("_all", (F.col("_a") + 1).cast("int"), window)).withColumn("at", F.col("_a") / rate).drop("_all", "_a")
    return out if least_rms is None else out.where(F.sqrt(signal.mean_square(F.col("samples"))) >= least_rms)


def window_metrics(rows: DataFrame, keys: list[str], mean: list[str], highest: list[str], least_s: float = 1.0) -> DataFrame:
    """Metrics of windows (seconds, ...) by clip: means or maxima; windows under ``least_s`` count only if a clip has no other."""
    longest = F.max("seconds").over(Window.partitionBy(*keys))
    used = rows.withColumn("_l", longest).where((F.col("seconds") >= least_s) | (F.col("_l") < least_s))
    return used.groupBy(*keys).agg(*(F.avg(c).alias(c) for c in mean), *(F.max(c).alias(c) for c in highest))


def speech_prefix(spans: DataFrame, keys: list[str], seconds: float) -> DataFrame:
    """The first ``seconds`` of speech of each key: its spans, the last one cut."""
    w = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("end") - F.col("start")).over(w), F.lit(0.0))
    s = spans.withColumn("_b", before).where(F.col("_b") < seconds)
    return s.withColumn("end", F.least("end", F.col("start") + seconds - F.col("_b"))).drop("_b")


def fill_times(words: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Words that lack a start or an end get the gap between their neighbours: from the end of the word before, filled or
    not (0 at the beginning), to the next known start; of several in a row the first gets the gap, the others lie empty at its end."""
    w = Window.partitionBy(*keys).orderBy(order)
    upto, before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    timed = F.col("start").isNotNull() & F.col("end").isNotNull()
    zero = F.lit(0).cast(words.schema["end"].dataType)
    w1 = words.withColumns({"_timed": timed, "_base": F.coalesce(F.last(F.when(timed, F.col("end")), True).over(before), zero), "_next": F.when(~timed, F.first("start", True).over(after))})
    w1 = w1.withColumn("_stretch", F.count(F.when(F.col("_timed"), 1)).over(upto))
    s = Window.partitionBy(*keys, "_stretch").orderBy(order)
    start = F.greatest("_base", F.max("_next").over(s.rowsBetween(Window.unboundedPreceding, -1)))
    end = F.greatest("_base", F.max("_next").over(s.rowsBetween(Window.unboundedPreceding, 0)))
    filled = w1.withColumns({"_s": F.when(F.col("_timed"), F.col("start")).otherwise(start), "_e": F.when(F.col("_timed"), F.col("end")).otherwise(end)})
    return filled.withColumns({"start": F.col("_s"), "end": F.col("_e")}).drop("_s", "_e", "_timed", "_base", "_next", "_stretch")


def _cores(total: int, rate: int, chunk_s: float, overlap_s: float) -> tuple[list[int], int]:
    """Edges of the chunks' cores, and the overlap, in samples."""
    chunk, overlap = max(1, int(chunk_s * rate)), max(0, int(overlap_s * rate))
    if chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than twice the overlap")
    edges = [*range(0, total, chunk), total] if total else [0, 0]
    if len(edges) > 2 and edges[-1] - edges[-2] <= 2 * overlap:
        del edges[-2]
    return edges, overlap


def process_file(source: str, target: str, work: Callable[[np.ndarray, int], np.ndarray], chunk_s: float, overlap_s: float) -> None:
    """``process_chunked`` from file to file: no more than a chunk and the fading end of the one before are held, however long
    the recording. The target is written aside and renamed."""
    with wave.open(source, "rb") as f:
        rate, total = f.getframerate(), f.getnframes()
    edges, overlap = _cores(total, rate, chunk_s, overlap_s)
    aside, fading = f"{target}.{uuid.uuid4().hex}", np.zeros(0, np.float32)
    with wave.open(aside, "wb") as out:
        out.setnchannels(1), out.setsampwidth(2), out.setframerate(rate)
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            lo, hi = max(0, a - overlap), min(total, b + overlap)
            x, _ = signal.read_wav(source, lo / rate, hi / rate)
            y = np.asarray(work(x, rate), np.float32)
            y = np.pad(y, (0, max(0, hi - lo - len(y))))[: hi - lo]
            rising = np.linspace(0, 1, len(fading), dtype=np.float32)
            y[: len(fading)] = fading * (1 - rising) + y[: len(fading)] * rising
            done = len(y) if k + 2 == len(edges) else b - overlap - lo
            out.writeframes((np.clip(y[:done], -1, 1) * 32767).round().astype("<i2").tobytes())
            fading = y[done:]
    os.replace(aside, target)


def process_chunked(samples: np.ndarray, rate: int, chunk_s: float, overlap_s: float, work: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray:
    """``work`` over overlapping chunks, crossfaded: what a task does with one recording too long to work on at once."""
    total = len(samples)
    edges, overlap = _cores(total, rate, chunk_s, overlap_s)
    parts = []
    for a, b in zip(edges, edges[1:], strict=False):
        lo, hi = max(0, a - overlap), min(total, b + overlap)
        y = np.asarray(work(samples[lo:hi], rate), np.float32)
        parts.append(np.pad(y, (0, max(0, hi - lo - len(y))))[: hi - lo])
    return signal.crossfaded(parts, edges, overlap, total)
