"""Streams of new segments: idempotent merges per batch, and pauses as session windows. Extensions of the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.publish import merge_rows
from voxlake.plans.manifest import Versions


def merge_stream(segments: DataFrame, target: Versions, checkpoint: str):
    """Each batch replaces the rows of its sources in the published table. A batch that runs again gives the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        at = target.current()
        out = merge_rows(target.read(at), batch, batch) if at else batch
        target.publish(out, at)

    return segments.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def pause_sessions(words: DataFrame, keys: list[str], at: str, max_pause: str, late: str) -> DataFrame:
    """Words grouped until a pause: start, end and number of each session; words later than ``late`` are left out."""
    timed = words.withWatermark(at, late)
    out = timed.groupBy(*keys, F.session_window(at, max_pause).alias("w")).agg(F.count("*").alias("n_words"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_words")


def windowed_totals(rows: DataFrame, keys: list[str], at: str, window: str, late: str) -> DataFrame:
    """Rows and summed duration by key in tumbling windows of event time."""
    w = F.window(at, window)
    return rows.withWatermark(at, late).groupBy(*keys, w.alias("w")).agg(F.count("*").alias("n"), F.sum("duration").alias("duration")).select(*keys, F.col("w.start").alias("start"), "n", "duration")
