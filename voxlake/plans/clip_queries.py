"""Clip, routing, incremental and sink operators as queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake import components
from voxlake.operators import clips
from voxlake.operators import intervals as iv
from voxlake.plans import fixtures as fx
from voxlake.plans import manifest as mf
from voxlake.plans.interval_queries import K
from voxlake.plans.vector_queries import _CLIPS, _MS, _tones
from voxlake.sources import sinks

_ROUTES = {"en": "fast", "de-AT": "alpine", "fr": "latin"}


def x7_speech_prefix(spark: SparkSession, d: str) -> DataFrame:
    out = clips.speech_prefix(iv.merge_spans(fx.turns(spark, d), K), K, 30_000_000_000)
    return out.select("source_id", F.col("start").alias("s"), F.col("end").cast("long").alias("e"))


def x9_routes(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.read(spark, d, "documents").select("doc_id", "lang")
    hint = F.when(F.col("doc_id") % 5 == 0, F.lit("de-AT")).when(F.col("doc_id") % 7 == 0, F.lit("en-GB"))
    return docs.select("doc_id", components.route(hint, F.col("lang"), "base", _ROUTES).alias("backend"))


def x12_fill_times(spark: SparkSession, d: str) -> DataFrame:
    w = fx.words(spark, d)
    w = w.withColumn("start", F.when(F.col("ord") % 5 > 1, F.col("start"))).withColumn("end", F.when(F.col("ord") % 5 % 4 > 1, F.col("end")))
    return clips.fill_times(w, K, "ord").select("source_id", "ord", F.col("start").alias("s"), F.col("end").alias("e"))


def x15_clip_windows(spark: SparkSession, d: str) -> DataFrame:
    out = clips.clip_windows(_tones(spark), 1000, 0.1, 0.05, 0.3)
    return out.select("clip_id", F.col("window").cast("long").alias("window_no"), F.round("at", 3).alias("start_s"), F.size("samples").cast("long").alias("n"))


def x16_window_metrics(spark: SparkSession, d: str) -> DataFrame:
    e = fx.read(spark, d, "events").select(F.col("user_id").alias("clip_id"), (F.col("value") / 10).alias("seconds"), (F.col("event_id") % 100 / 100.0).alias("speech"), (F.col("event_id") % 37 / 37.0).alias("music"))
    out = clips.window_metrics(e, ["clip_id"], ["speech"], ["music"])
    return out.select("clip_id", F.round("speech", 6).alias("speech"), F.round("music", 6).alias("music"))


def i1_pending(spark: SparkSession, d: str) -> DataFrame:
    c = fx.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("source_id"), F.col("c_custkey").alias("k"))
    status, print_ = F.when(F.col("k") % 4 == 0, "failed").otherwise("done"), F.when(F.col("k") % 5 == 0, "old").otherwise("new")
    m = c.select("source_id", F.lit("vad").alias("stage"), status.alias("status"), print_.alias("fingerprint"))
    return mf.pending(c.select("source_id"), m, "vad", "new", c.where("k % 7 <> 0").select("source_id"))


def k3_shard_rows(spark: SparkSession, d: str) -> DataFrame:
    p = fx.read(spark, d, "pages").select("page_id", "url")
    rows = p.select(
        (F.col("page_id") % 9).cast("string").alias("source_id"), F.col("page_id").alias("utt_id"), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("/local").alias("uri"), F.when(F.col("page_id") % 3 == 0, "").otherwise("t").alias("text"),
        F.create_map(F.lit("b"), F.col("page_id").cast("double"), F.lit("a"), F.lit(0.5)).alias("metrics"), F.array(F.struct(F.lit("w").alias("text"), F.lit(1.5).alias("start"))).alias("words"),
    )
    return sinks.shard_rows(rows)


QUERIES = {
    "x7_speech_prefix": x7_speech_prefix,
    "x9_routes": x9_routes,
    "x12_fill_times": x12_fill_times,
    "x15_clip_windows": x15_clip_windows,
    "x16_window_metrics": x16_window_metrics,
    "i1_i2_pending": i1_pending,
    "k3_shard_rows": k3_shard_rows,
}
SQL = {
    "x7_speech_prefix": f"""WITH {fx.TURNS}, t0 AS (SELECT source_id, 0 AS g, s, e FROM turns), {fx.merge_sql('t0', 'm')},
b AS (SELECT *, coalesce(sum(e - s) OVER (PARTITION BY source_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM m)
SELECT source_id, s, least(e, s + 30000000000 - b) AS e FROM b WHERE b < 30000000000""",
    "x9_routes": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'alpine' WHEN doc_id % 7 = 0 THEN 'fast' WHEN lang = 'en' THEN 'fast' WHEN lang = 'fr' THEN 'latin' ELSE 'base' END AS backend FROM documents""",
    # word by word, as the rule says: the end before, filled or not, and the next known start
    "x12_fill_times": f"""WITH RECURSIVE {fx.WORDS}, w AS (SELECT source_id, ord, CASE WHEN ord % 5 > 1 THEN s END AS s, CASE WHEN ord % 5 % 4 > 1 THEN e END AS e FROM words),
n AS (SELECT source_id, ord, s, e, s IS NULL OR e IS NULL AS gap, first_value(s IGNORE NULLS) OVER (v ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS f, row_number() OVER v AS k FROM w WINDOW v AS (PARTITION BY source_id ORDER BY ord)),
walk AS (
  SELECT source_id, ord, k, CASE WHEN gap THEN 0 ELSE s END AS s, CASE WHEN gap THEN greatest(0, coalesce(f, 0)) ELSE e END AS e FROM n WHERE k = 1
  UNION ALL SELECT n.source_id, n.ord, n.k, CASE WHEN n.gap THEN p.e ELSE n.s END, CASE WHEN n.gap THEN greatest(p.e, coalesce(n.f, p.e)) ELSE n.e END FROM walk p JOIN n ON n.source_id = p.source_id AND n.k = p.k + 1
) SELECT source_id, ord, s, e FROM walk""",
    "x15_clip_windows": f"""WITH {_CLIPS}, w AS (SELECT clip_id, k AS window_no, x[k * 50 + 1:k * 50 + 100] AS x FROM c, range(15) t(k))
SELECT clip_id, window_no, round(window_no * 0.05::DOUBLE, 3) AS start_s, len(x)::BIGINT AS n FROM w WHERE sqrt({_MS.format('x')}) >= 0.3""",
    "x16_window_metrics": """WITH e AS (SELECT user_id AS clip_id, value / 10 AS sec, (event_id % 100) / 100::DOUBLE AS speech, (event_id % 37) / 37::DOUBLE AS music, max(value / 10) OVER (PARTITION BY user_id) AS l FROM events)
SELECT clip_id, round(avg(speech), 6) AS speech, round(max(music), 6) AS music FROM e WHERE sec >= 1 OR l < 1 GROUP BY 1""",
    "i1_i2_pending": "SELECT c_custkey::VARCHAR AS source_id FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0",
    "k3_shard_rows": """SELECT (page_id % 9)::VARCHAR AS source_id, page_id AS utt_id, CASE WHEN page_id % 2 = 0 THEN url END AS source_url, CASE WHEN page_id % 3 <> 0 THEN 't' END AS text,
  '{"a":0.5,"b":' || page_id || '.0}' AS metrics, '[{"text":"w","start":1.5}]' AS words FROM pages""",
}
