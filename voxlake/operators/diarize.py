"""Diarization by clustering: speech to windows, windows to vectors, vectors to voices, voices to turns."""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from voxlake import components
from voxlake.operators import segments as sg
from voxlake.operators import vectors as vc


def cluster_windows(windows: DataFrame, keys: list[str], threshold: float, speakers: int | None = None) -> DataFrame:
    """``windows`` (keys, start, embedding, ...) with ``label``: clusters of each key's windows, cut at a distance or to a number. The windows of one recording are one group."""
    schema = StructType([*windows.schema.fields, StructField("label", IntegerType())])
    names = [f.name for f in schema]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start", kind="stable")
        return pdf.assign(label=vc.agglomerate(np.stack(pdf["embedding"].to_list()), threshold, clusters=speakers).astype(np.int32))[names]

    return windows.groupBy(*keys).applyInPandas(run, schema)


def fold_clusters(rows: DataFrame, keys: list[str], least: float, vector: str = "embedding") -> DataFrame:
    """``rows`` (keys, label, seconds, vector) with labels of under ``least`` seconds replaced, row by row, by the most similar of the
    key's larger ones (ties: the smallest label); keys without a larger one stay as they are."""
    unit = rows.withColumn("_u", vc.l2norm(F.col(vector)))
    large = rows.groupBy(*keys, "label").agg(F.sum("seconds").alias("_s")).where(F.col("_s") >= least).drop("_s")
    centers = vc.weighted_centroids(unit.join(large, [*keys, "label"], "left_semi").select(*keys, "label", F.col("_u").alias("vector"), F.lit(1.0).alias("weight")), [*keys, "label"])
    held = centers.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("label", "centroid"))).alias("_c"))  # voices of one recording
    sims = F.transform("_c", lambda c: F.struct(vc.dot(F.col("_u"), c["centroid"]).alias("sim"), c["label"].alias("label")))
    kind = rows.schema["label"].dataType.simpleString()
    first = F.struct(F.lit(float("-inf")).alias("sim"), F.lit(None).cast(kind).alias("label"))
    best = F.aggregate(sims, first, lambda b, x: F.when(x["sim"] > b["sim"], x).otherwise(b))["label"]
    is_large = F.exists("_c", lambda c: c["label"] == F.col("label"))
    out = unit.join(held, keys, "left")
    return out.withColumn("label", F.when(F.col("_c").isNull() | is_large, F.col("label")).otherwise(best)).drop("_u", "_c")


def windows_to_voices(windows: DataFrame, keys: list[str], threshold: float, speakers: int | None = None, least: float = 1.5, smoothing: int = 3) -> DataFrame:
    """Turns (keys, speaker, start, end) of embedded windows (keys, region, start, end, seconds, embedding): clustered, small
    clusters folded, labels smoothed within regions and numbered by their first turn."""
    labelled = fold_clusters(cluster_windows(windows, keys, threshold, speakers), keys, least).drop("embedding")
    smooth = sg.mode_filter(labelled, [*keys, "region"], "start", "label", smoothing).drop("label").withColumnRenamed("smooth", "label")
    placed = smooth.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy("start", "end")))
    numbered = sg.first_seen_labels(placed, keys, "_at", "label").withColumn("label", F.format_string("SPEAKER_%02d", F.col("number").cast("int"))).drop("number", "_at")
    return sg.windows_to_turns(numbered, keys, "region").withColumnRenamed("label", "speaker")


def diarize(clips: DataFrame, keys: list[str], vad: tuple[str, dict[str, Any]], embedder: tuple[str, dict[str, Any]], window: float = 1.5, step: float = 0.75, **how: Any) -> DataFrame:
    """Turns of recordings (keys, samples, rate) by a vad and an embedder, named with their parameters."""
    speech = components.spans(clips, "vad", vad[0], keys, **vad[1]).withColumn("region", F.col("start"))
    windows = sg.window_spans(speech, window, step)
    at = (F.col("start") * F.col("rate")).cast("int")
    cut = windows.join(clips.select(*keys, "samples", "rate"), keys).withColumn("samples", F.slice("samples", at + 1, F.greatest(F.lit(0), (F.col("end") * F.col("rate")).cast("int") - at)))
    vectors = cut.withColumn("embedding", components.embed(F.col("samples"), F.col("rate"), embedder[0], **embedder[1]))
    return windows_to_voices(vectors.select(*keys, "region", "start", "end", F.lit(step).alias("seconds"), "embedding"), keys, **how)
