"""Interval operators as queries over derived turns and words, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators import intervals as iv
from voxlake.plans import fixtures as fx
from voxlake.plans.fixtures import HOUR

K = ["source_id"]
BIN, WORD_BIN = HOUR, 60_000_000


def w1_merge_spans(spark: SparkSession, d: str) -> DataFrame:
    return iv.merge_spans(fx.turns(spark, d), K, 60_000_000, 24 * HOUR).select("source_id", F.col("start").alias("s"), F.col("end").alias("e"))


def w2_overlap_regions(spark: SparkSession, d: str) -> DataFrame:
    return iv.overlap_regions(fx.turns(spark, d), K, bin_width=24 * BIN).select("source_id", F.col("start").alias("s"), F.col("end").alias("e"))


def w3_group_spans(spark: SparkSession, d: str) -> DataFrame:
    return iv.group_spans(fx.turns(spark, d), K, 3600e6, 600e6).select("source_id", F.round("start").cast("long").alias("s"), F.round("end").cast("long").alias("e"))


def w3_cut_spans(spark: SparkSession, d: str) -> DataFrame:
    out = iv.cut_spans(fx.turns(spark, d), K, 3_600_000_000, 24 * BIN)
    return out.select("source_id", F.round("start").cast("long").alias("s"), F.round("end").cast("long").alias("e"))


def j2_coverage(spark: SparkSession, d: str) -> DataFrame:
    out = iv.coverage(fx.turns(spark, d), fx.speech(spark, d), K, ["ord"], BIN)
    return out.select("ord", "source_id", "covered", F.round(iv.coverage_ratio(), 6).alias("ratio"))


def j4_intersecting(spark: SparkSession, d: str) -> DataFrame:
    return iv.intersecting(fx.turns(spark, d), fx.speech(spark, d), K, ["ord"], BIN)


def _spoken(spark: SparkSession, d: str) -> DataFrame:
    return fx.word_turns(spark, d).where("speaker <> 'system'").select("source_id", "start", "end")


def j5_refine_words(spark: SparkSession, d: str) -> DataFrame:
    out = iv.refine_words(fx.words(spark, d), _spoken(spark, d), K, ["ord"], WORD_BIN, 20_000)
    return out.select("source_id", "ord", F.col("start").alias("s"), F.col("end").alias("e"))


def j1_assign_speakers(spark: SparkSession, d: str) -> DataFrame:
    return iv.assign_speakers(fx.words(spark, d), fx.word_turns(spark, d), K, ["ord"], WORD_BIN, 300_000, 10_000).select("source_id", "ord", "speaker")


def j6_overlapped_words(spark: SparkSession, d: str) -> DataFrame:
    w = fx.words(spark, d).withColumn("end", F.greatest("end", F.col("start") + 10_000))
    out = iv.coverage(w, iv.overlap_regions(fx.word_turns(spark, d), K, bin_width=WORD_BIN), K, ["ord"], WORD_BIN)
    return out.select("source_id", "ord", (iv.coverage_ratio() >= 0.3).alias("overlapped"))


def j7_other_speaker_time(spark: SparkSession, d: str) -> DataFrame:
    out = iv.other_speaker_time(fx.turns(spark, d), fx.turns(spark, d), K, ["ord"], BIN, 500_000)
    return out.select("ord", "source_id", F.col("other_time").alias("other_us"))


def j8_speaker_breaks(spark: SparkSession, d: str) -> DataFrame:
    w = fx.words(spark, d).withColumn("speaker", F.col("role"))
    guests = w.where("ord % 3 = 0").select("source_id", F.lit("guest").alias("speaker"), F.col("end").alias("start"), (F.col("end") + 100_000 + F.col("ord") % 5 * 150_000).alias("end"), "ord")
    return iv.other_speaker_breaks(w, fx.word_turns(spark, d).unionByName(guests), K, ["ord"], WORD_BIN, 300_000)


def j9_weighted_means(spark: SparkSession, d: str) -> DataFrame:
    parts = fx.turns(spark, d).where("speaker = 'view'").select("source_id", "start", "end", F.when(F.col("ord") % 7 != 0, (F.col("ord") % 100) / 100.0).alias("avg_logprob"), (F.col("ord") % 9 / 10.0).alias("no_speech_prob"))
    out = iv.weighted_means(fx.turns(spark, d), parts, K, ["ord"], ["avg_logprob", "no_speech_prob"], BIN)
    return out.select("ord", "source_id", F.round("avg_logprob", 5).alias("avg_logprob"), F.round("no_speech_prob", 5).alias("no_speech_prob"))


QUERIES = {
    "w1_merge_spans": w1_merge_spans,
    "w2_overlap_regions": w2_overlap_regions,
    "w3_cut_spans": w3_cut_spans,
    "w3_group_spans": w3_group_spans,
    "j1_assign_speakers": j1_assign_speakers,
    "j2_j3_coverage": j2_coverage,
    "j4_intersecting": j4_intersecting,
    "j5_refine_words": j5_refine_words,
    "j6_overlapped_words": j6_overlapped_words,
    "j7_other_speaker_time": j7_other_speaker_time,
    "j8_speaker_breaks": j8_speaker_breaks,
    "j9_weighted_means": j9_weighted_means,
}

_W = f"WITH {fx.TURNS}"
_ALL = "tall AS (SELECT source_id, 0 AS g, s, e FROM turns)"
_WORDS = f"WITH {fx.WORDS}, {fx.WORD_TURNS}"
_SPOKEN = "sp0 AS (SELECT source_id, 0 AS g, s, e FROM wturns WHERE speaker <> 'system'), " + fx.merge_sql("sp0", "sp")
SQL = {
    "w1_merge_spans": f"{_W}, {_ALL}, {fx.merge_sql('tall', 'm', 60_000_000)} SELECT source_id, s, e FROM m",
    "w2_overlap_regions": f"{_W}, {fx.OVERLAPS} SELECT source_id, s, e FROM regions",
    "w3_cut_spans": f"""{_W}, {_ALL}, {fx.merge_sql('tall', 'm')}, c AS (SELECT *, CASE WHEN e - s > 3600000000 THEN (e - s) // 3600000000 + 1 ELSE 1 END AS n FROM m)
SELECT source_id, round(s + i * ((e - s) / n))::BIGINT AS s, CASE WHEN i = n - 1 THEN e ELSE round(s + (i + 1) * ((e - s) / n))::BIGINT END AS e FROM (SELECT *, unnest(range(n)) AS i FROM c)""",
    # piece by piece: a chunk goes on while the gap is short and the whole still fits
    "w3_group_spans": f"""WITH RECURSIVE {fx.TURNS}, {_ALL}, {fx.merge_sql('tall', 'm')}, c AS (SELECT *, CASE WHEN e - s > 3600000000 THEN (e - s) // 3600000000 + 1 ELSE 1 END AS n FROM m),
p AS (SELECT source_id, s + i * ((e - s) / n) AS s, CASE WHEN i = n - 1 THEN e::DOUBLE ELSE s + (i + 1) * ((e - s) / n) END AS e FROM (SELECT *, unnest(range(n)) AS i FROM c)),
o AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY s, e) AS k FROM p),
walk AS (
  SELECT source_id, k, s, e, s AS opened, 1 AS chunk FROM o WHERE k = 1
  UNION ALL SELECT o.source_id, o.k, o.s, o.e, CASE WHEN o.s - w.e <= 600000000 AND o.e - w.opened <= 3600000000 THEN w.opened ELSE o.s END, CASE WHEN o.s - w.e <= 600000000 AND o.e - w.opened <= 3600000000 THEN w.chunk ELSE w.chunk + 1 END
  FROM walk w JOIN o ON o.source_id = w.source_id AND o.k = w.k + 1
) SELECT source_id, round(min(s))::BIGINT AS s, round(max(e))::BIGINT AS e FROM walk GROUP BY source_id, chunk""",
    "j2_j3_coverage": f"""{_W}, {fx.SPEECH}, c AS (
  SELECT t.ord, t.source_id, t.s, t.e, coalesce(sum(least(t.e, p.e) - greatest(t.s, p.s)) FILTER (p.s IS NOT NULL), 0)::BIGINT AS covered
  FROM turns t LEFT JOIN speech p ON t.source_id = p.source_id AND p.s < t.e AND t.s < p.e GROUP BY ALL)
SELECT ord, source_id, covered, CASE WHEN e > s THEN round(covered / (e - s), 6) ELSE 0 END AS ratio FROM c""",
    "j4_intersecting": f"""{_W}, {fx.SPEECH} SELECT t.source_id, t.ord, min(p.s) AS hit_start, max(p.e) AS hit_end
FROM turns t JOIN speech p ON t.source_id = p.source_id AND p.s < t.e AND t.s < p.e GROUP BY ALL""",
    "j5_refine_words": f"""{_WORDS}, {_SPOKEN}, h AS (
  SELECT w.source_id, w.ord, w.s, w.e, greatest(w.s, min(p.s)) AS a, least(w.e, max(p.e)) AS b, count(p.s) AS n
  FROM words w LEFT JOIN sp p ON w.source_id = p.source_id AND p.s < w.e AND w.s < p.e GROUP BY w.source_id, w.ord, w.s, w.e)
SELECT source_id, ord, CASE WHEN n > 0 AND b - a >= 20000 THEN a ELSE s END AS s, CASE WHEN n > 0 AND b - a >= 20000 THEN b ELSE e END AS e FROM h""",
    "j1_assign_speakers": f"""{_WORDS}, w AS (SELECT source_id, ord, s, greatest(e, s + 10000) AS e FROM words),
o AS (SELECT w.source_id, w.ord, t.speaker, sum(least(w.e, t.e) - greatest(w.s, t.s)) AS n FROM w JOIN wturns t ON w.source_id = t.source_id AND t.s < w.e AND w.s < t.e GROUP BY ALL),
b AS (SELECT source_id, ord, speaker FROM o QUALIFY row_number() OVER (PARTITION BY source_id, ord ORDER BY n DESC, speaker DESC) = 1),
r AS (SELECT w.source_id, w.ord, t.speaker FROM w JOIN wturns t ON w.source_id = t.source_id ANTI JOIN b ON b.source_id = w.source_id AND b.ord = w.ord
  WHERE greatest(t.s - w.e, w.s - t.e) <= 300000 QUALIFY row_number() OVER (PARTITION BY w.source_id, w.ord ORDER BY greatest(t.s - w.e, w.s - t.e), t.ord) = 1)
SELECT w.source_id, w.ord, coalesce(b.speaker, r.speaker) AS speaker FROM w LEFT JOIN b USING (source_id, ord) LEFT JOIN r USING (source_id, ord)""",
    "j6_overlapped_words": f"""{_WORDS}, turns AS (SELECT * FROM wturns), {fx.OVERLAPS}, w AS (SELECT source_id, ord, s, greatest(e, s + 10000) AS e FROM words),
c AS (SELECT w.source_id, w.ord, w.s, w.e, coalesce(sum(least(w.e, p.e) - greatest(w.s, p.s)) FILTER (p.s IS NOT NULL), 0) AS n FROM w LEFT JOIN regions p ON w.source_id = p.source_id AND p.s < w.e AND w.s < p.e GROUP BY ALL)
SELECT source_id, ord, n / (e - s) >= 0.3 AS overlapped FROM c""",
    "j7_other_speaker_time": f"""{_W} SELECT t.ord, t.source_id, coalesce(sum(CASE WHEN t.e - 500000 > t.s + 500000 THEN greatest(0, least(t.e - 500000, o.e) - greatest(t.s + 500000, o.s)) END) FILTER (o.s IS NOT NULL), 0)::BIGINT AS other_us
FROM turns t LEFT JOIN turns o ON t.source_id = o.source_id AND t.speaker <> o.speaker AND o.s < t.e - 500000 AND t.s + 500000 < o.e GROUP BY ALL""",
    "j8_speaker_breaks": f"""{_WORDS}, g AS (SELECT source_id, ord, role, lag(e) OVER w AS a, s AS b, lag(role) OVER w AS before FROM words WINDOW w AS (PARTITION BY source_id ORDER BY ord)),
tt AS (SELECT source_id, speaker, s, e FROM wturns UNION ALL SELECT source_id, 'guest', e, e + 100000 + ord % 5 * 150000 FROM words WHERE ord % 3 = 0)
SELECT g.source_id, g.ord FROM g JOIN tt t ON g.source_id = t.source_id AND t.speaker <> g.role AND t.s < g.b AND g.a < t.e
WHERE g.role = g.before AND g.b - g.a >= 300000 GROUP BY g.source_id, g.ord HAVING sum(least(g.b, t.e) - greatest(g.a, t.s)) >= 300000""",
    "j9_weighted_means": f"""{_W}, p AS (SELECT source_id, s, e, CASE WHEN ord % 7 <> 0 THEN (ord % 100) / 100.0::DOUBLE END AS a, (ord % 9) / 10.0::DOUBLE AS b FROM turns WHERE speaker = 'view'),
x AS (SELECT t.ord, t.source_id, p.a, p.b, (least(t.e, p.e) - greatest(t.s, p.s))::DOUBLE AS n FROM turns t JOIN p ON t.source_id = p.source_id AND p.s < t.e AND t.s < p.e)
SELECT ord, source_id, round(sum(a * n) / sum(n) FILTER (a IS NOT NULL), 5) AS avg_logprob, round(sum(b * n) / sum(n), 5) AS no_speech_prob FROM x GROUP BY ALL""",
}
