"""Interval algebra: merging, overlap, coverage and interval joins.

Spans are rows with key columns and ``start``, ``end`` in any one numeric type. Joins on overlap are
equi-joins on the keys and a time bin: each side is dealt to the bins it touches and a pair counts
only in the first bin both share, so that no pair repeats and a hot source spreads over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _islands(spans: DataFrame, keys: list[str], max_gap: float, carry: list[Column]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start") - reach > max_gap), 1).otherwise(0)
    marked = spans.withColumn("_new", new)
    marked = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), *carry).drop("_island")


def merge_spans(spans: DataFrame, keys: list[str], max_gap: float = 0, bin_width: float | None = None) -> DataFrame:
    """Union of the spans of each key; spans at most ``max_gap`` apart join, empty ones go.

    With ``bin_width`` spans are first merged within bins of their start, so that a key with many
    spans is worked on by many tasks and the second pass sees few rows; the result is the same.
    """
    spans = spans.where("end > start").select(*keys, "start", "end")
    if bin_width:
        binned = spans.withColumn("_bin", F.floor(F.col("start") / bin_width))
        spans = _islands(binned, [*keys, "_bin"], max_gap, []).drop("_bin")
    return _islands(spans, keys, max_gap, [])


def overlap_regions(turns: DataFrame, keys: list[str], speaker: str = "speaker", bin_width: float | None = None) -> DataFrame:
    """Regions in which two or more different speakers talk: a sweep over merged turns, which are merged by bins first if a width is given."""
    merged = merge_spans(turns, [*keys, speaker], bin_width=bin_width)
    edges = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d"))))
    steps = merged.select(*keys, edges.alias("_x")).groupBy(*keys, F.col("_x.at").alias("at")).agg(F.sum("_x.d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("at")
    active = steps.withColumn("n", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("at").over(order))
    return merge_spans(active.where("n >= 2 AND next IS NOT NULL").select(*keys, F.col("at").alias("start"), F.col("next").alias("end")), keys, bin_width=bin_width)


def _bins(start: Column, end: Column, width: float) -> Column:
    return F.sequence(F.floor(start / width), F.greatest(F.floor(start / width), F.floor(end / width)))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], bin_width: float, closed: bool = False) -> DataFrame:
    """Pairs of rows of equal keys whose spans overlap (or, if ``closed``, touch). Columns of ``right`` other than
    the keys must not clash; its span is ``r_start``, ``r_end``, that of ``left`` ``start``, ``end``."""
    first = F.floor(F.greatest(F.col("start"), F.col("r_start")) / bin_width)
    a = left.withColumn("_bin", F.explode(_bins(F.col("start"), F.col("end"), bin_width)))
    b = right.withColumn("_bin", F.explode(_bins(F.col("r_start"), F.col("r_end"), bin_width)))
    meets = (F.col("r_start") <= F.col("end")) & (F.col("start") <= F.col("r_end")) if closed else (F.col("r_start") < F.col("end")) & (F.col("start") < F.col("r_end"))
    return a.join(b, [*keys, "_bin"]).where(meets & (F.col("_bin") == first)).drop("_bin")


def overlap_length() -> Column:
    return F.least("end", "r_end") - F.greatest("start", "r_start")


def coverage(items: DataFrame, spans: DataFrame, keys: list[str], id_cols: list[str], bin_width: float) -> DataFrame:
    """``items`` with ``covered``: how much of each the merged spans cover; 0 for empty items."""
    merged = merge_spans(spans, keys, bin_width=bin_width).withColumnsRenamed({"start": "r_start", "end": "r_end"})
    pairs = overlap_join(items.select(*keys, *id_cols, "start", "end"), merged, keys, bin_width)
    covered = pairs.groupBy(*keys, *id_cols).agg(F.sum(overlap_length()).alias("covered"))
    zero = F.col("end") - F.col("end")  # of the spans' type
    return items.join(covered, [*keys, *id_cols], "left").withColumn("covered", F.when(F.col("end") > F.col("start"), F.coalesce("covered", zero)).otherwise(zero))


def coverage_ratio() -> Column:
    return F.when(F.col("end") > F.col("start"), F.col("covered") / (F.col("end") - F.col("start"))).otherwise(0.0)


def intersecting(items: DataFrame, spans: DataFrame, keys: list[str], id_cols: list[str], bin_width: float) -> DataFrame:
    """First start and last end of the merged spans that each item overlaps."""
    merged = merge_spans(spans, keys, bin_width=bin_width).withColumnsRenamed({"start": "r_start", "end": "r_end"})
    pairs = overlap_join(items.select(*keys, *id_cols, "start", "end"), merged, keys, bin_width)
    return pairs.groupBy(*keys, *id_cols).agg(F.min("r_start").alias("hit_start"), F.max("r_end").alias("hit_end"))


def refine_words(words: DataFrame, speech: DataFrame, keys: list[str], id_cols: list[str], bin_width: float, least: float) -> DataFrame:
    """Words shrunk to the speech they overlap, unless less than ``least`` would stay."""
    hits = intersecting(words, speech, keys, id_cols, bin_width)
    joined = words.join(hits, [*keys, *id_cols], "left")
    start, end = F.greatest("start", "hit_start"), F.least("end", "hit_end")
    ok = F.col("hit_start").isNotNull() & (end - start >= least)
    return joined.withColumn("_start", F.when(ok, start).otherwise(F.col("start"))).withColumn("end", F.when(ok, end).otherwise(F.col("end"))).withColumn("start", F.col("_start")).drop("_start", "hit_start", "hit_end")


def assign_speakers(words: DataFrame, turns: DataFrame, keys: list[str], id_cols: list[str], bin_width: float, max_distance: float, least: float) -> DataFrame:
    """``words`` with the speaker whose turns overlap each most (ties: the greater label), else that of the nearest
    turn within ``max_distance`` (ties: the first turn), else null. Turns: keys, start, end, speaker, ord."""
    w = words.withColumn("end", F.greatest("end", F.col("start") + least)).select(*keys, *id_cols, "start", "end")
    t = turns.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), "speaker", F.col("ord").alias("turn_ord"))
    shared = overlap_join(w, t, keys, bin_width).groupBy(*keys, *id_cols, "speaker").agg(F.sum(overlap_length()).alias("n"))
    best = shared.groupBy(*keys, *id_cols).agg(F.max_by("speaker", F.struct("n", "speaker")).alias("by_overlap"))
    rest = w.join(best, [*keys, *id_cols], "left_anti")
    wide = rest.withColumns({"start": F.col("start") - max_distance, "end": F.col("end") + max_distance})
    near = overlap_join(wide, t, keys, bin_width, closed=True)
    away = F.greatest(F.col("r_start") - (F.col("end") - max_distance), F.col("start") + max_distance - F.col("r_end"))
    near = near.withColumn("away", away).where(F.col("away") <= max_distance).groupBy(*keys, *id_cols).agg(F.min_by("speaker", F.struct("away", "turn_ord")).alias("by_distance"))
    out = words.join(best, [*keys, *id_cols], "left").join(near, [*keys, *id_cols], "left")
    return out.withColumn("speaker", F.coalesce("by_overlap", "by_distance")).drop("by_overlap", "by_distance")


def other_speaker_time(items: DataFrame, turns: DataFrame, keys: list[str], id_cols: list[str], bin_width: float, margin: float = 0) -> DataFrame:
    """``items`` (with speaker) and ``other_time``: time that turns of other speakers take in the span less ``margin`` at either end; turns aren't merged."""
    inner = items.select(*keys, *id_cols, "speaker", (F.col("start") + margin).alias("start"), (F.col("end") - margin).alias("end")).where("end > start")
    t = turns.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("speaker").alias("other"))
    time = overlap_join(inner, t, keys, bin_width).where("other <> speaker").groupBy(*keys, *id_cols).agg(F.sum(overlap_length()).alias("other_time"))
    return items.join(time, [*keys, *id_cols], "left").withColumn("other_time", F.coalesce("other_time", F.col("end") - F.col("end")))


def other_speaker_breaks(words: DataFrame, turns: DataFrame, keys: list[str], order: list[str], bin_width: float, least: float) -> DataFrame:
    """Words (keys, order columns) before which an untranscribed other speaker talks for at least ``least``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    gaps = words.withColumns({"_end": F.lag("end").over(w), "_speaker": F.lag("speaker").over(w)})
    gaps = gaps.where((F.col("speaker") == F.col("_speaker")) & (F.col("start") - F.col("_end") >= least))
    gaps = gaps.select(*keys, *order, "speaker", F.col("_end").alias("g_start"), F.col("start").alias("g_end"))
    ids = [c for c in order if c not in ("start", "end")]
    spans = gaps.select(*keys, *ids, "speaker", F.col("g_start").alias("start"), F.col("g_end").alias("end"))
    return other_speaker_time(spans, turns, keys, ids, bin_width).where(F.col("other_time") >= least).select(*keys, *ids)


def weighted_means(items: DataFrame, parts: DataFrame, keys: list[str], id_cols: list[str], values: list[str], bin_width: float) -> DataFrame:
    """Means of ``values`` of the overlapping parts, weighted by the overlap; nulls are left out."""
    p = parts.withColumnsRenamed({"start": "r_start", "end": "r_end"})
    pairs = overlap_join(items.select(*keys, *id_cols, "start", "end"), p, keys, bin_width).withColumn("_n", overlap_length().cast("double"))
    return pairs.groupBy(*keys, *id_cols).agg(*(F.try_divide(F.sum(F.col(v) * F.col("_n")), F.sum(F.when(F.col(v).isNotNull(), F.col("_n")))).alias(v) for v in values))


def cut_spans(spans: DataFrame, keys: list[str], max_length: float, bin_width: float | None = None) -> DataFrame:
    """Merged spans, those longer than ``max_length`` cut into equal pieces."""
    n = F.when(F.col("end") - F.col("start") > max_length, F.floor((F.col("end") - F.col("start")) / max_length) + 1).otherwise(1)
    cut = merge_spans(spans, keys, bin_width=bin_width).withColumn("_n", n.cast("int")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    step = (F.col("end") - F.col("start")) / F.col("_n")
    return cut.select(*keys, (F.col("start") + F.col("_i") * step).alias("start"), F.when(F.col("_i") == F.col("_n") - 1, F.col("end")).otherwise(F.col("start") + (F.col("_i") + 1) * step).alias("end"))


def group_spans(spans: DataFrame, keys: list[str], max_length: float, max_gap: float) -> DataFrame:
    """Chunks of at most ``max_length``: consecutive pieces are packed while they fit and gaps are at most ``max_gap``.

    Packing is a fold over the pieces of a run; runs end at larger gaps, so that a fold sees only what lies between two of them.
    """
    pieces = cut_spans(spans, keys, max_length)
    order = Window.partitionBy(*keys).orderBy("start", "end")
    new = F.coalesce((F.col("start") - F.lag("end").over(order) > max_gap).cast("int"), F.lit(1))
    runs = pieces.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*keys, "_run").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_p"))
    kind = f"array<struct<start:{pieces.schema['start'].dataType.simpleString()},end:{pieces.schema['end'].dataType.simpleString()}>>"

    def pack(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (p["end"] - F.try_element_at(done, F.lit(-1))["start"] <= max_length)
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), p["end"].alias("end"))))
        return F.when(fits, joined).otherwise(F.concat(done, F.array(p)))

    packed = F.aggregate("_p", F.array().cast(kind), pack)
    return runs.select(*keys, F.explode(packed).alias("c")).select(*keys, "c.start", "c.end")
