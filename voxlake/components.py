"""Pluggable components: registration, creation with checked parameters, and Arrow-batched use in DataFrames.

Models load once per task, on first use, in the worker that runs it.
"""

from __future__ import annotations

import importlib
import importlib.metadata
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any, ClassVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.keys import stable_hash

KINDS = ("enhancer", "vad", "diarizer", "transcriber", "aligner", "embedder", "scorer")
_registered: dict[tuple[str, str], type | str] = {}


class Component:
    """Parameters are a dataclass ``Params``; ``load`` and ``unload`` bracket use; ``identity`` goes into fingerprints."""

    version: ClassVar[int] = 1

    @dataclass(frozen=True)
    class Params:
        pass

    def __init__(self, params: Any = None):
        self.params = params or self.Params()

    def load(self) -> None:
        pass

    def unload(self) -> None:
        pass

    def identity(self) -> str:
        return stable_hash([type(self).__name__, self.version, vars(self.params)])


def register(kind: str, name: str, target: type | str) -> None:
    """Add a component: a class, or "module:class", imported on first use. Names in use aren't replaced."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}; kinds are {', '.join(KINDS)}")
    _registered.setdefault((kind, name), target)


def plugins(group: str = "voxlake.components") -> None:
    """Register what installed packages offer under entry points named kind.name."""
    for e in importlib.metadata.entry_points(group=group):
        kind, _, name = e.name.partition(".")
        register(kind, name, e.value)


def resolve(kind: str, name: str) -> type:
    if (kind, name) not in _registered:
        plugins()
    target = _registered.get((kind, name))
    if target is None:
        raise KeyError(f"no {kind} named {name}; there are {sorted(n for k, n in _registered if k == kind)}")
    if isinstance(target, str):
        module, _, cls = target.partition(":")
        try:
            target = getattr(importlib.import_module(module), cls)
        except ImportError as e:
            raise ImportError(f"{kind} {name} needs a package that isn't installed: {e}") from e
        _registered[kind, name] = target
    return target


def create(kind: str, name: str, **params: Any) -> Component:
    """An instance; parameters it doesn't know are refused."""
    cls = resolve(kind, name)
    known = {f.name for f in fields(cls.Params)}
    if unknown := params.keys() - known:
        raise TypeError(f"{kind} {name} has no parameter {', '.join(sorted(unknown))}; it has {sorted(known)}")
    return cls(cls.Params(**params))


def _each(kind: str, name: str, params: dict, method: str) -> Callable:
    def run(batches):
        c = create(kind, name, **params)
        c.load()
        try:
            for samples, rate in batches:
                yield pd.Series([getattr(c, method)(np.asarray(x, np.float32), int(r)) for x, r in zip(samples, rate, strict=True)])
        finally:
            c.unload()

    return run


def score(samples: Column, rate: Column, name: str, **params: Any) -> Column:
    """Metrics of a clip by a scorer, as a map."""
    return F.pandas_udf(_each("scorer", name, params, "score"), "map<string,double>", F.PandasUDFType.SCALAR_ITER)(samples, rate)


def embed(samples: Column, rate: Column, name: str, **params: Any) -> Column:
    return F.pandas_udf(_each("embedder", name, params, "embed"), "array<float>", F.PandasUDFType.SCALAR_ITER)(samples, rate)


def _updated(old: Column, new: Column) -> Column:
    """Both maps, the new values where both have a key."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def score_all(clips: DataFrame, scorers: list[tuple[str, dict]]) -> DataFrame:
    """``clips`` (samples, rate) with the metrics of all scorers, a later one's in place of an earlier one's, to five places."""
    found = [f"_metrics{k}" for k in range(len(scorers))]
    scored = clips
    for column, (name, params) in zip(found, scorers, strict=True):
        scored = scored.withColumn(column, score(F.col("samples"), F.col("rate"), name, **params))
    out = F.create_map().cast("map<string,double>")
    for column in found:
        out = _updated(out, F.col(column))
    return scored.withColumn("metrics", F.transform_values(out, lambda _, v: F.round(v, 5))).drop(*found)


def route(hint: Column, detected: Column, default: str, routes: dict[str, str]) -> Column:
    """The backend for a language: that of the hint, else of the detected language, else the default; exact code before its base."""

    def of(lang: Column) -> Column:
        table = F.create_map(*(F.lit(x) for kv in routes.items() for x in kv)) if routes else F.create_map().cast("map<string,string>")
        return F.coalesce(F.try_element_at(table, lang), F.try_element_at(table, F.split_part(lang, F.lit("-"), F.lit(1))))

    return F.coalesce(F.when(hint.isNotNull(), of(hint)), F.when(hint.isNull(), of(detected)), F.lit(default))


def spans(clips: DataFrame, kind: str, name: str, keys: list[str], **params: Any) -> DataFrame:
    """Spans that a vad (``detect``: start, end) or a diarizer (``diarize``: start, end, speaker) finds in each clip (keys, samples, rate)."""
    method, extra = {"vad": ("detect", ""), "diarizer": ("diarize", ", speaker string")}[kind]
    schema = ", ".join(f"{k} {clips.schema[k].dataType.simpleString()}" for k in keys) + ", start double, end double" + extra
    width = 3 if extra else 2

    def run(batches):
        c = create(kind, name, **params)
        c.load()
        try:
            for pdf in batches:
                rows = []
                for row in pdf.to_dict("records"):
                    for found in getattr(c, method)(np.asarray(row["samples"], np.float32), int(row["rate"])):
                        rows.append((*(row[k] for k in keys), *tuple(found)[:width]))
                yield pd.DataFrame(rows, columns=[*keys, "start", "end", "speaker"][: len(keys) + width])
        finally:
            c.unload()

    return clips.select(*keys, "samples", "rate").mapInPandas(run, schema)


def transcribed(clips: DataFrame, name: str, keys: list[str], **params: Any) -> DataFrame:
    """Segments (keys, language, start, end, text, words) that a transcriber (``transcribe``: language and segments, each start, end, text and
    timed words) hears in each clip (keys, samples, rate, language as a hint or null)."""
    schema = ", ".join(f"{k} {clips.schema[k].dataType.simpleString()}" for k in keys) + ", language string, start double, end double, text string, words array<struct<text:string,start:double,end:double,prob:double>>"

    def run(batches):
        c = create("transcriber", name, **params)
        c.load()
        try:
            for pdf in batches:
                rows = []
                for row in pdf.to_dict("records"):
                    language, found = c.transcribe(np.asarray(row["samples"], np.float32), int(row["rate"]), row["language"])
                    rows += [(*(row[k] for k in keys), language, *segment) for segment in found]
                yield pd.DataFrame(rows, columns=[*keys, "language", "start", "end", "text", "words"])
        finally:
            c.unload()

    return clips.select(*keys, "samples", "rate", "language").mapInPandas(run, schema)


def aligned(clips: DataFrame, segments: DataFrame, name: str, keys: list[str], **params: Any) -> DataFrame:
    """Words (keys, text, start, end, prob) that an aligner (``align``: words of segments) places in each clip. segments: keys, start, end, text, language."""
    kind = lambda f, k: f.schema[k].dataType.simpleString()
    schema = ", ".join(f"{k} {kind(clips, k)}" for k in keys) + ", text string, start double, end double, prob double"
    spoken = segments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("segments"), F.min("language").alias("language"))

    def run(batches):
        c = create("aligner", name, **params)
        c.load()
        try:
            for pdf in batches:
                rows = []
                for row in pdf.to_dict("records"):
                    given = [(s["start"], s["end"], s["text"]) for s in row["segments"]]
                    rows += [(*(row[k] for k in keys), *w) for w in c.align(given, np.asarray(row["samples"], np.float32), int(row["rate"]), row["language"])]
                yield pd.DataFrame(rows, columns=[*keys, "text", "start", "end", "prob"])
        finally:
            c.unload()

    return clips.select(*keys, "samples", "rate").join(spoken, keys).mapInPandas(run, schema)


def processed(samples: Column, rate: Column, name: str, **params: Any) -> Column:
    """Samples after an enhancer (``process``), of the same length."""

    def run(batches):
        c = create("enhancer", name, **params)
        c.load()
        try:
            for xs, rates in batches:
                out = []
                for x, r in zip(xs, rates, strict=True):
                    y = np.asarray(c.process(np.asarray(x, np.float32), int(r)), np.float32)
                    out.append(np.pad(y, (0, max(0, len(x) - len(y))))[: len(x)])
                yield pd.Series(out)
        finally:
            c.unload()

    return F.pandas_udf(run, "array<float>", F.PandasUDFType.SCALAR_ITER)(samples, rate)


class LevelScorer(Component):
    """RMS level of a clip in dBFS: a scorer that needs no model."""

    def score(self, samples: np.ndarray, rate: int) -> dict[str, float]:
        return {"level_db": float(10 * np.log10(max(float(np.mean(samples**2)), 1e-12)))} if len(samples) else {}


register("scorer", "level", LevelScorer)
