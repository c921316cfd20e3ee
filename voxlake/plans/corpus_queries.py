"""Rules, summaries, publishing and reference selection as queries over derived utterances, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions import text as tx
from voxlake.operators import publish, rules, summary
from voxlake.operators.intervals import merge_spans
from voxlake.operators.references import assign_references
from voxlake.plans.fixtures import SPEECH, TURNS, read, speech, turns
from voxlake.plans.stored import stored
from voxlake.plans.text_queries import SQL as TEXT_SQL

RULES = (
    rules.Rule("quality", min=0.5, on_missing="drop"),
    rules.Rule("toxic", max=0.5),
    rules.Rule("repetition_ratio", max=0.2),
    rules.Rule("chars_per_sec", min=4.0, max=12.8),
)
ALLOWED = ["en", "de", "fr"]


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """Documents as segments with a map of metrics; duration in seconds of 15 characters."""
    t = F.col("text")
    docs = read(spark, d, "documents").select("doc_id", "source", "lang", "text")
    labels = read(spark, d, "labels").select("doc_id", "quality", "toxic")
    seconds = F.length(t) / 15.0
    measures = docs.select("doc_id", "source", "lang", seconds.alias("duration"), F.round(tx.repetition_ratio(t), 6).alias("rep"), F.round(tx.per_second(tx.spoken_char_count(t), seconds), 5).alias("cps"))
    metrics = F.create_map(F.lit("quality"), F.col("quality").cast("double"), F.lit("toxic"), F.col("toxic").cast("double"), F.lit("repetition_ratio"), F.col("rep"), F.lit("chars_per_sec"), F.col("cps"))
    return measures.join(labels, "doc_id", "left").select("doc_id", "source", "lang", "duration", metrics.alias("metrics"))


def f1_first_failure(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d).select("doc_id", rules.first_failure(rules.of_map(F.col("metrics")), RULES).alias("reason"))


def _reasons(spark: SparkSession, d: str) -> DataFrame:
    s = _segments(spark, d)
    failure = rules.first_failure(rules.of_map(F.col("metrics")), RULES)
    reason = rules.drop_reason(
        language_ok=rules.language_allowed(F.col("lang"), ALLOWED), has_embedding=F.col("doc_id") % 31 != 0, speaker_known=F.col("doc_id") % 29 != 0, duration=F.col("duration"), least=15.0, most=300.0, failure=failure
    )
    return s.select("doc_id", reason.alias("reason"))


def f3_f5_drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _reasons(spark, d)


def a4_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.count_reasons(_reasons(spark, d))


def f8_metric_columns(spark: SparkSession, d: str) -> DataFrame:
    """The metric map as columns, one for each key."""
    s = stored(_segments(spark, d).select("doc_id", "metrics"))  # read for the keys and for the columns
    keys = sorted(r.k for r in s.select(F.explode(F.map_keys("metrics")).alias("k")).distinct().collect())
    return s.select("doc_id", *(F.try_element_at("metrics", F.lit(k)).alias(k) for k in keys))


def _utterances(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("utt_id"), c.alias("speaker_id"), F.when(c % 4 == 0, F.concat(F.lit("name"), c.cast("string"))).alias("speaker_name"), F.when(c % 10 == 0, "test").otherwise("train").alias("split"),
        F.concat(F.lit("show"), (c % 5).cast("string"), F.lit("-ep"), (k % 12).cast("string")).alias("source_id"), ((F.round(F.col("o_totalprice") * 100).cast("long") % 3000) / 100).alias("duration"),
        F.when(k % 3 != 0, F.concat(F.lit("r"), (k % 40).cast("string"))).alias("ref_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("language"),
    )


_UTT = """u AS (SELECT o_orderkey AS utt_id, o_custkey AS speaker_id, CASE WHEN o_custkey % 4 = 0 THEN 'name' || o_custkey END AS speaker_name, CASE WHEN o_custkey % 10 = 0 THEN 'test' ELSE 'train' END AS split,
  'show' || (o_custkey % 5) || '-ep' || (o_orderkey % 12) AS source_id, (round(o_totalprice * 100)::BIGINT % 3000) / 100::DOUBLE AS duration, CASE WHEN o_orderkey % 3 <> 0 THEN 'r' || (o_orderkey % 40) END AS ref_id,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS language FROM orders)"""


def a1_speaker_rows(spark: SparkSession, d: str) -> DataFrame:
    return summary.speaker_rows(_utterances(spark, d), ["utt_id"])


def a2_totals(spark: SparkSession, d: str) -> DataFrame:
    return summary.totals(_utterances(spark, d))


def a2_groups(spark: SparkSession, d: str) -> DataFrame:
    return summary.by_group(_utterances(spark, d))


def f9_test_speakers(spark: SparkSession, d: str) -> DataFrame:
    return summary.choose_test_speakers(_utterances(spark, d).select("speaker_id"), 0.1, 13)


def a11_deltas(spark: SparkSession, d: str) -> DataFrame:
    u = _utterances(spark, d)
    return summary.deltas(u.where("utt_id % 5 <> 0"), u)


def a5_stage_counts(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    outcome = F.element_at(F.array(*(F.lit(x) for x in ("done", "cached", "failed", "blocked"))), (F.col("o_orderkey") % 4).cast("int") + 1)
    return summary.stage_counts(o.select(F.col("o_orderpriority").alias("stage"), outcome.alias("outcome")))


def a6_stage_status(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("source_id"))
    stages = spark.createDataFrame([("fetch",), ("segment",), ("score",)], "stage string")
    done = c.select("source_id", F.lit("fetch").alias("stage"), F.when(F.col("source_id") % 7 == 0, "failed").otherwise("done").alias("status"))
    more = c.where("source_id % 2 = 0").select("source_id", F.lit("segment").alias("stage"), F.lit("done").alias("status"))
    return summary.stage_status(c, stages, done.unionByName(more))


def _slices(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Published rows, local rows, locally built sources (among them one without rows)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = read(spark, d, "orders").select(k.alias("utt_id"), c.alias("speaker_id"), (c % 50).alias("source_id"), F.concat(F.lit("clips/"), k.cast("string")).alias("audio_path"), F.when(k % 3 != 0, F.concat(F.lit("refs/"), (k % 40).cast("string"))).alias("ref_audio_path"))
    built = spark.range(0, 20).select(F.col("id").alias("source_id"))
    local = o.where("source_id < 20 AND source_id <> 7 AND utt_id % 4 <> 0").withColumn("origin", F.lit("local"))
    return o.where("source_id >= 10").withColumn("origin", F.lit("remote")), local, built


_SLICES = """o AS (SELECT o_orderkey AS utt_id, o_custkey AS speaker_id, o_custkey % 50 AS source_id, 'clips/' || o_orderkey AS audio_path, CASE WHEN o_orderkey % 3 <> 0 THEN 'refs/' || (o_orderkey % 40) END AS ref_audio_path FROM orders),
l AS (SELECT *, 'local' AS origin FROM o WHERE source_id < 20 AND source_id <> 7 AND utt_id % 4 <> 0), r AS (SELECT *, 'remote' AS origin FROM o WHERE source_id >= 10),
m AS (SELECT * FROM r WHERE source_id >= 20 UNION ALL SELECT * FROM l)"""


def j15_merge_rows(spark: SparkSession, d: str) -> DataFrame:
    remote, local, built = _slices(spark, d)
    return publish.merge_rows(remote, local, built).select("source_id", "utt_id", "speaker_id", "audio_path", "ref_audio_path", "origin")


def o4_referenced_files(spark: SparkSession, d: str) -> DataFrame:
    return publish.referenced_files(j15_merge_rows(spark, d))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    remote, local, _ = _slices(spark, d)
    paths = lambda rows, salt: publish.referenced_files(rows).withColumn("sha1", F.sha1(F.concat(F.col("path"), F.lit(salt), F.when(F.crc32("path") % 5 == 0, F.lit(salt)).otherwise(F.lit("")))))
    same = lambda rows, salt: paths(rows, salt).withColumn("sha1", F.when(F.length("path") % 2 == 0, F.sha1("path")).otherwise(F.col("sha1")))
    return publish.plan_paths(o4_referenced_files(spark, d), same(local, "l"), same(remote, "r"))


def j16_plan_paths(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).select("path", "action")


def o6_upload_batches(spark: SparkSession, d: str) -> DataFrame:
    return publish.upload_batches(_plan(spark, d).where("action = 'upload'").select("path"), 100)


def j17_lineage_breaks(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("speaker_id"), F.concat(F.lit("s"), (F.col("c_custkey") % 9).cast("string"), F.lit(":A")).alias("member"))
    local = c.where("speaker_id % 17 <> 0").withColumn("member", F.when(F.col("speaker_id") % 5 == 0, F.lit("x:B")).otherwise(F.col("member")))
    return publish.lineage_breaks(c, local, spark.createDataFrame([("s1",), ("s2",)], "source_id string"))


def _pool(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = read(spark, d, "orders").select(k.alias("segment_id"), (c % 200).alias("speaker_id"), F.when(c % 200 < 20, F.lit(0)).otherwise(k % 6).alias("source_id"), (k * 37 % 5000).alias("start"), (k * 37 % 5000 + 3 + k % 40).alias("end"), F.when(k % 11 != 0, F.round(F.col("o_totalprice") * 100).cast("long")).alias("m"))
    pool = o.where("end - start BETWEEN 4 AND 12").select(F.concat(F.lit("r"), F.col("segment_id").cast("string")).alias("ref_id"), F.col("segment_id").alias("parent_id"), "speaker_id", "source_id", "start", "end", "m")
    return o.where("end - start > 12"), pool


def j13_assign_references(spark: SparkSession, d: str) -> DataFrame:
    targets, pool = _pool(spark, d)
    return assign_references(targets, pool, [F.col("m").desc_nulls_last(), F.col("ref_id").asc()], 5)


def o1_o2_top_references(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    _, pool = _pool(spark, d)
    n = F.row_number().over(Window.partitionBy("speaker_id").orderBy(F.col("m").desc_nulls_last(), "ref_id"))
    return pool.withColumn("place", n).where("place <= 5").select("speaker_id", "ref_id", "place")


_POOL = """o AS (SELECT o_orderkey AS segment_id, o_custkey % 200 AS speaker_id, CASE WHEN o_custkey % 200 < 20 THEN 0 ELSE o_orderkey % 6 END AS source_id, o_orderkey * 37 % 5000 AS s, o_orderkey * 37 % 5000 + 3 + o_orderkey % 40 AS e,
  CASE WHEN o_orderkey % 11 <> 0 THEN round(o_totalprice * 100)::BIGINT END AS m FROM orders),
t AS (SELECT * FROM o WHERE e - s > 12), p AS (SELECT 'r' || segment_id AS ref_id, segment_id AS parent_id, speaker_id, source_id, s, e, m FROM o WHERE e - s BETWEEN 4 AND 12)"""


def a7_a8_source_stats(spark: SparkSession, d: str) -> DataFrame:
    return summary.source_stats(turns(spark, d), merge_spans(speech(spark, d), ["source_id"])).withColumnRenamed("speech_time", "speech_us")


def a10_build_report(spark: SparkSession, d: str) -> DataFrame:
    u = _utterances(spark, d)
    return summary.build_report(u, u.where("speaker_id % 3 = 0 AND source_id LIKE 'show1%'"))


def o3_utterance_batches(spark: SparkSession, d: str) -> DataFrame:
    """Utterances in order of speaker and id, with the path of their clip."""
    u = _utterances(spark, d).select("speaker_id", "utt_id").orderBy("speaker_id", "utt_id")
    return u.withColumn("audio_path", F.concat(F.lit("wavs/"), F.lpad(F.col("speaker_id").cast("string"), 5, "0"), F.lit("/"), F.col("utt_id").cast("string"), F.lit(".wav")))


QUERIES = {
    "a7_a8_source_stats": a7_a8_source_stats,
    "a10_build_report": a10_build_report,
    "o3_utterance_paths": o3_utterance_batches,
    "f1_first_failure": f1_first_failure,
    "f3_f4_f5_drop_reasons": f3_f5_drop_reasons,
    "f8_metric_columns": f8_metric_columns,
    "f9_test_speakers": f9_test_speakers,
    "a1_speaker_rows": a1_speaker_rows,
    "a2_totals": a2_totals,
    "a2_groups": a2_groups,
    "a4_reason_counts": a4_reason_counts,
    "a5_stage_counts": a5_stage_counts,
    "a6_stage_status": a6_stage_status,
    "a11_deltas": a11_deltas,
    "j13_j14_assign_references": j13_assign_references,
    "o1_o2_top_references": o1_o2_top_references,
    "j15_merge_rows": j15_merge_rows,
    "j16_o5_plan_paths": j16_plan_paths,
    "j17_lineage_breaks": j17_lineage_breaks,
    "o4_referenced_files": o4_referenced_files,
    "o6_upload_batches": o6_upload_batches,
}

_SEG = f"""tm AS ({TEXT_SQL['t4_t6_t10_text_measures']}), seg AS (SELECT d.doc_id, d.lang, length(d.text) / 15.0::DOUBLE AS duration, tm.repetition_ratio, tm.chars_per_sec, l.quality::DOUBLE AS quality, l.toxic::DOUBLE AS toxic
  FROM documents d JOIN tm USING (doc_id) LEFT JOIN labels l USING (doc_id)),
f AS (SELECT *, CASE WHEN quality IS NULL THEN 'missing_quality' WHEN quality < 0.5 THEN 'quality_below_0.5' WHEN toxic > 0.5 THEN 'toxic_above_0.5' WHEN repetition_ratio > 0.2 THEN 'repetition_ratio_above_0.2'
  WHEN chars_per_sec < 4 THEN 'chars_per_sec_below_4' WHEN chars_per_sec > 12.8 THEN 'chars_per_sec_above_12.8' END AS failure FROM seg),
c AS (SELECT *, CASE WHEN lang IS NULL OR lang NOT IN ('en', 'de', 'fr') THEN 'language_not_allowed' WHEN doc_id % 31 = 0 THEN 'no_embedding' WHEN doc_id % 29 = 0 THEN 'speaker_insufficient_audio'
  WHEN duration < 15 THEN 'shorter_than_target (reference pool only)' WHEN duration > 300 THEN 'longer_than_target' WHEN failure IS NOT NULL THEN 'filter:' || failure END AS reason FROM f)"""
_HEX = ", ".join(f"('0x' || substr(sha1(segment_id::VARCHAR), {1 + 4 * i}, 4))::BIGINT" for i in range(10))
SQL = {
    "a7_a8_source_stats": f"""WITH {TURNS}, {SPEECH}, v AS (SELECT source_id, count(DISTINCT speaker)::BIGINT AS num_speakers, count(*)::BIGINT AS num_turns FROM turns GROUP BY 1),
p AS (SELECT source_id, count(*)::BIGINT AS num_spans, sum(e - s)::BIGINT AS speech_us FROM speech GROUP BY 1) SELECT * FROM v FULL JOIN p USING (source_id)""",
    "a10_build_report": f"""WITH {_UTT}, g AS (SELECT * FROM u WHERE speaker_id % 3 = 0 AND source_id LIKE 'show1%')
SELECT count(DISTINCT speaker_id)::BIGINT AS total_speakers, count(*)::BIGINT AS total_utterances, round(sum(duration) / 3600, 3) AS total_hours, (SELECT count(DISTINCT source_id)::BIGINT FROM u) AS num_sources FROM g""",
    "o3_utterance_paths": f"WITH {_UTT} SELECT speaker_id, utt_id, 'wavs/' || lpad(speaker_id::VARCHAR, 5, '0') || '/' || utt_id || '.wav' AS audio_path FROM u",
    "f1_first_failure": f"WITH {_SEG} SELECT doc_id, failure AS reason FROM f",
    "f3_f4_f5_drop_reasons": f"WITH {_SEG} SELECT doc_id, reason FROM c",
    "f8_metric_columns": f"WITH {_SEG} SELECT doc_id, chars_per_sec, quality, repetition_ratio, toxic FROM seg",
    "a4_reason_counts": f"WITH {_SEG} SELECT reason, count(*)::BIGINT AS n FROM c WHERE reason IS NOT NULL GROUP BY 1",
    "f9_test_speakers": f"WITH {_UTT}, s AS (SELECT DISTINCT speaker_id FROM u), n AS (SELECT count(*) AS n FROM s) SELECT speaker_id FROM s, n QUALIFY row_number() OVER (ORDER BY sha1('13:' || speaker_id)) <= least(n - 1, greatest(1, round_even(n * 0.1, 0)))",
    "a2_totals": f"WITH {_UTT} SELECT count(DISTINCT speaker_id)::BIGINT AS total_speakers, count(*)::BIGINT AS total_utterances, round(sum(duration) / 3600, 3) AS total_hours, count(DISTINCT source_id)::BIGINT AS num_sources FROM u",
    "a2_groups": f"""WITH {_UTT}, s AS (SELECT *, regexp_replace(source_id, '-ep[0-9]+$', '') AS series FROM u)
SELECT CASE WHEN grouping(split) = 0 THEN 'split' WHEN grouping(series) = 0 THEN 'series' ELSE 'language' END AS kind, CASE WHEN grouping(split) = 0 THEN split WHEN grouping(series) = 0 THEN series ELSE language END AS name,
  count(*)::BIGINT AS utterances, round(sum(duration) / 3600, 3) AS hours, count(DISTINCT source_id)::BIGINT AS sources, count(DISTINCT speaker_id)::BIGINT AS speakers FROM s GROUP BY GROUPING SETS ((split), (series), (language))""",
    "a5_stage_counts": "SELECT o_orderpriority AS stage, " + ", ".join(f"count(*) FILTER (o_orderkey % 4 = {i})::BIGINT AS {n}" for i, n in enumerate(("done", "cached", "failed", "blocked"))) + " FROM orders GROUP BY 1",
    "a6_stage_status": """WITH g AS (SELECT c_custkey AS k, unnest(['fetch', 'segment', 'score']) AS stage FROM customer),
s AS (SELECT stage, CASE WHEN stage = 'fetch' THEN CASE WHEN k % 7 = 0 THEN 'failed' ELSE 'done' END WHEN stage = 'segment' AND k % 2 = 0 THEN 'done' ELSE 'pending' END AS st FROM g)
SELECT stage, count(*) FILTER (st = 'done')::BIGINT AS done, count(*) FILTER (st = 'failed')::BIGINT AS failed, count(*) FILTER (st = 'pending')::BIGINT AS pending FROM s GROUP BY 1""",
    "a11_deltas": f"""WITH {_UTT} SELECT regexp_replace(source_id, '-ep[0-9]+$', '') AS series, round(sum(duration) / 3600, 3) AS hours, round((sum(duration) - coalesce(sum(duration) FILTER (utt_id % 5 <> 0), 0)) / 3600, 3) AS hours_added FROM u GROUP BY 1""",
    "j13_j14_assign_references": f"""WITH {_POOL}, v AS (SELECT t.segment_id, p.ref_id, p.m, p.source_id <> t.source_id AS other, max(p.source_id <> t.source_id) OVER (PARTITION BY t.segment_id) AS any_other
  FROM t JOIN p USING (speaker_id) WHERE p.parent_id <> t.segment_id AND NOT (p.source_id = t.source_id AND p.s < t.e AND t.s < p.e)),
k AS (SELECT segment_id, ref_id, row_number() OVER (PARTITION BY segment_id ORDER BY m DESC NULLS LAST, ref_id) AS n FROM v WHERE other = any_other QUALIFY n <= 5),
h AS (SELECT *, count(*) OVER (PARTITION BY segment_id) AS c FROM k)
SELECT segment_id, ref_id FROM h WHERE n - 1 = list_reduce([0::BIGINT, {_HEX}], lambda a, d: (a * 65536 + d) % c)""",
    "o1_o2_top_references": f"WITH {_POOL} SELECT speaker_id, ref_id, row_number() OVER (PARTITION BY speaker_id ORDER BY m DESC NULLS LAST, ref_id)::INT AS place FROM p QUALIFY place <= 5",
    "j15_merge_rows": f"WITH {_SLICES} SELECT source_id, utt_id, speaker_id, audio_path, ref_audio_path, origin FROM m",
    "o4_referenced_files": f"WITH {_SLICES} SELECT audio_path AS path FROM m UNION SELECT ref_audio_path FROM m WHERE ref_audio_path IS NOT NULL",
    "j16_o5_plan_paths": f"""WITH {_SLICES}, need AS (SELECT audio_path AS path FROM m UNION SELECT ref_audio_path FROM m WHERE ref_audio_path IS NOT NULL),
lp AS (SELECT audio_path AS path FROM l UNION SELECT ref_audio_path FROM l WHERE ref_audio_path IS NOT NULL), rp AS (SELECT audio_path AS path FROM r UNION SELECT ref_audio_path FROM r WHERE ref_audio_path IS NOT NULL),
a AS (SELECT path FROM need UNION SELECT path FROM lp UNION SELECT path FROM rp),
x AS (SELECT path, path IN (SELECT path FROM need) AS n, path IN (SELECT path FROM lp) AS l, path IN (SELECT path FROM rp) AS r FROM a)
SELECT path, CASE WHEN n AND NOT l AND NOT r THEN 'missing' WHEN n AND l AND (NOT r OR length(path) % 2 = 1) THEN 'upload' WHEN n THEN 'keep' ELSE 'delete' END AS action FROM x WHERE n OR r""",
    "o6_upload_batches": f"""WITH {_SLICES}, lp AS (SELECT audio_path AS path FROM l UNION SELECT ref_audio_path FROM l WHERE ref_audio_path IS NOT NULL), rp AS (SELECT audio_path AS path FROM r UNION SELECT ref_audio_path FROM r WHERE ref_audio_path IS NOT NULL),
need AS (SELECT audio_path AS path FROM m UNION SELECT ref_audio_path FROM m WHERE ref_audio_path IS NOT NULL),
up AS (SELECT path FROM lp WHERE path IN (SELECT path FROM need) AND (path NOT IN (SELECT path FROM rp) OR length(path) % 2 = 1))
SELECT path, (row_number() OVER (ORDER BY path) - 1) // 100 AS batch FROM up""",
    "j17_lineage_breaks": "SELECT DISTINCT c_custkey AS speaker_id FROM customer WHERE c_custkey % 17 = 0 OR (c_custkey % 9 NOT IN (1, 2) AND c_custkey % 5 = 0)",
}
SQL["a1_speaker_rows"] = f"""WITH {_UTT}, f AS (SELECT speaker_id, speaker_name, split FROM u QUALIFY row_number() OVER (PARTITION BY speaker_id ORDER BY utt_id) = 1)
SELECT u.speaker_id, f.speaker_name, f.split, count(*)::BIGINT AS num_utterances, round(sum(duration), 2) AS total_duration_s, count(DISTINCT source_id)::BIGINT AS num_sources,
  count(DISTINCT ref_id)::BIGINT AS num_references, array_to_string(list_sort(list(DISTINCT source_id)), ';') AS sources FROM u JOIN f ON u.speaker_id = f.speaker_id GROUP BY u.speaker_id, f.speaker_name, f.split"""
