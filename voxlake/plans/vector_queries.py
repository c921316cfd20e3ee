"""Vector, identity and signal operators as queries, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators import diarize, identity
from voxlake.operators import signal as sig
from voxlake.operators import vectors as vc
from voxlake.plans.fixtures import read
from voxlake.plans.stored import stored


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings with planted structure: their label's component is raised by three."""
    e = read(spark, d, "embeddings").select("vec_id", "embedding", F.col("label").alias("axis"))
    v = F.transform("embedding", lambda x, i: x.cast("double") + F.when(i == F.col("axis"), 3.0).otherwise(0.0))
    return e.select(F.col("vec_id").alias("segment_id"), (F.col("vec_id") % 10).alias("source_id"), F.concat(F.lit("S"), F.col("axis").cast("string")).alias("label"), (1 + F.col("vec_id") % 7).cast("double").alias("duration"), v.alias("embedding"))


_V = "v AS (SELECT vec_id, vec_id % 10 AS source_id, 'S' || label AS label, (1 + vec_id % 7)::DOUBLE AS duration, list_transform(embedding, lambda x, i: x::DOUBLE + CASE WHEN i = label + 1 THEN 3.0 ELSE 0 END) AS e FROM embeddings)"
_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"


def v1_v2_cosine(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    n = vc.l2norm(F.col("embedding"))
    first = F.array_repeat(F.lit(0.125), 64)
    return v.select("segment_id", F.round(vc.dot(n, first), 6).alias("sim"), F.round(F.sqrt(vc.dot(F.col("embedding"), F.col("embedding"))), 6).alias("norm"))


def v6_centroids(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d).withColumns({"vector": F.col("embedding"), "weight": F.col("duration")})
    out = vc.weighted_centroids(v, ["label"])
    return out.select("label", F.posexplode("centroid").alias("i", "x"), "weight").select("label", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"), "weight")


def v3_v4_local_speakers(spark: SparkSession, d: str) -> DataFrame:
    _, speakers = vc.local_speakers(_vectors(spark, d), 0.45, 20.0)
    return speakers.select("source_id", "label", F.round("duration", 3).alias("duration"), "kept", F.round(F.col("centroid")[0], 6).alias("x0"))


def v5_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Global clusters of local speakers."""
    _, speakers = vc.local_speakers(_vectors(spark, d), 0.45, 5.0)
    known = speakers.where("kept").select("source_id", "label", identity.member_key(F.col("source_id"), F.col("label")).alias("node"), "centroid")
    known = stored(known)
    return known.join(identity.cluster_speakers(known, 0.45), "node").select("source_id", "label", "cluster")


def j18_nearest_anchor(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    anchors = v.groupBy("label").agg(F.min_by("embedding", "segment_id").alias("e")).select(F.col("label").alias("anchor"), vc.l2norm(F.col("e")).alias("centroid"))
    out = vc.nearest(v.select("segment_id", vc.l2norm(F.col("embedding")).alias("vector")), anchors, "anchor")
    return out.select("segment_id", "anchor", F.round("similarity", 6).alias("similarity"))


def _intruders(v: DataFrame) -> DataFrame:
    cents = vc.weighted_centroids(v.withColumns({"vector": F.col("embedding"), "weight": F.col("duration")}), ["source_id", "label"]).withColumn("person", F.when(F.col("label").isin("S0", "S1"), F.lit(0)).otherwise(F.expr("int(substr(label, 2))")))
    windows = v.select((F.col("segment_id") % 40).alias("segment_id"), "source_id", "label", F.col("segment_id").alias("window"), vc.l2norm(F.col("embedding")).alias("vector"))
    return vc.intruder_stats(windows, cents, 0.1, 0.75)


def v12_v13_intruders(spark: SparkSession, d: str) -> DataFrame:
    """Every embedding of every source."""
    return _intruders(_vectors(spark, d))


def v15_fold_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Labels of little speech in a source go to the most similar of its others."""
    rows = _vectors(spark, d).withColumnRenamed("duration", "seconds")
    return diarize.fold_clusters(rows, ["source_id"], 18.0).select("segment_id", "source_id", "label")


def _tones(spark: SparkSession) -> DataFrame:
    """Clips of 0.8 s at 1 kHz: bursts of a tone in quiet."""
    clip = spark.range(0, 40).withColumnRenamed("id", "clip_id")
    loud = lambda i: F.when(F.floor(i / (100 + F.col("clip_id"))) % 2 == 0, 0.8 + F.col("clip_id") / 100.0).otherwise(0.001)
    return clip.withColumn("samples", F.transform(F.sequence(F.lit(0), F.lit(799)), lambda i: (loud(i) * ((i % 4) - 1.5) / 1.5).cast("double")))


_CLIPS = "c AS (SELECT i AS clip_id, list_transform(range(800), lambda k: (CASE WHEN (k // (100 + i)) % 2 = 0 THEN 0.8::DOUBLE + i / 100.0::DOUBLE ELSE 0.001::DOUBLE END) * ((k % 4) - 1.5::DOUBLE) / 1.5::DOUBLE) AS x FROM range(40) t(i))"


def x1_signal_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = sig.signal_metrics(_tones(spark), F.lit(1000))
    return out.select("clip_id", *(F.round(c, 5).alias(c) for c in ("rms_dbfs", "peak_dbfs", "clip_ratio", "snr_est_db")))


def x2_energy_vad(spark: SparkSession, d: str) -> DataFrame:
    out = sig.energy_vad(_tones(spark), ["clip_id"], 1000, min_speech=0.05, min_silence=0.02)
    return out.select("clip_id", F.round("start", 4).alias("s"), F.round("end", 4).alias("e"))


def x24_x27_shaping(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("samples")
    mono = sig.to_mono(s, F.reverse(s))
    shaped = {"mono": mono, "fit": sig.fit_length(s, 1000), "fade": sig.apply_fade(s, 1000, 50.0), "peak": sig.normalize(s, "peak", -3.0), "rms": sig.normalize(s, "rms", -10.0)}
    return _tones(spark).select("clip_id", *(F.round(sig.mean_square(v), 6).alias(k) for k, v in shaped.items()))


QUERIES = {
    "v1_v2_cosine": v1_v2_cosine,
    "v3_v4_local_speakers": v3_v4_local_speakers,
    "v5_clusters": v5_clusters,
    "v6_centroids": v6_centroids,
    "j18_nearest_anchor": j18_nearest_anchor,
    "v12_v13_intruders": v12_v13_intruders,
    "v15_fold_clusters": v15_fold_clusters,
    "x1_signal_metrics": x1_signal_metrics,
    "x2_energy_vad": x2_energy_vad,
    "x24_x27_shaping": x24_x27_shaping,
}
_UNIT = "list_transform(e, lambda x: x / greatest(sqrt(" + _DOT.format("e", "e") + "), 1e-12))"
_MS = "list_sum(list_transform({0}, lambda y: y * y)) / len({0})"


def _robust(purity: float = 0.45) -> str:
    """Common table expressions up to c3: centroids of sources and labels from the weighted medoid, re-estimated three times."""
    near = f"{_DOT.format('u.x', 'c.c')} >= {purity}"
    sums = "SELECT source_id, label, list(y ORDER BY i) AS e FROM (SELECT source_id, label, i, sum(w * y) AS y FROM ({}) GROUP BY ALL) GROUP BY ALL"
    parts = [
        f"u AS (SELECT vec_id, source_id, label, duration AS w, {_UNIT} AS x FROM v)",
        f"s0 AS ({sums.format('SELECT source_id, label, w, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM u')})",
        f"c0 AS (SELECT u.source_id, u.label, u.x AS c FROM u JOIN s0 USING (source_id, label) QUALIFY row_number() OVER (PARTITION BY u.source_id, u.label ORDER BY {_DOT.format('u.x', 's0.e')} DESC, vec_id) = 1)",
    ]
    for k in range(3):
        rows = f"SELECT u.source_id, u.label, u.w, unnest(u.x) AS y, generate_subscripts(u.x, 1) AS i FROM u JOIN c{k} c USING (source_id, label) WHERE {near}"
        parts.append(f"c{k + 1} AS (SELECT source_id, label, {_UNIT} AS c FROM ({sums.format(rows)}))")
    return ", ".join(parts)


SQL = {
    "v3_v4_local_speakers": f"""WITH {_V}, {_robust()}, d AS (SELECT u.source_id, u.label, any_value(c.c[1]) AS x0, sum(u.w) FILTER ({_DOT.format('u.x', 'c.c')} >= 0.45) AS duration FROM u JOIN c3 c USING (source_id, label) GROUP BY ALL)
SELECT source_id, label, round(coalesce(duration, 0), 3) AS duration, coalesce(duration, 0) >= 20 AS kept, round(x0, 6) AS x0 FROM d""",
    "x2_energy_vad": f"""WITH {_CLIPS}, f AS (SELECT clip_id, list_transform(range(26), lambda k: 10 * log10({_MS.format('x[k * 30 + 1:k * 30 + 30]')} + 1e-12)) AS db FROM c),
l AS (SELECT clip_id, db, list_sort(db) AS o FROM f), t AS (SELECT clip_id, unnest(db) AS level, generate_subscripts(db, 1) - 1 AS k, greatest(o[3] + (o[4] - o[3]) * 0.5::DOUBLE + 12, -55) AS lim FROM l),
a AS (SELECT clip_id, k, k - row_number() OVER (PARTITION BY clip_id ORDER BY k) AS g FROM t WHERE level > lim)
SELECT clip_id, round(min(k) * 30 / 1000::DOUBLE, 4) AS s, round((max(k) + 1) * 30 / 1000::DOUBLE, 4) AS e FROM a GROUP BY clip_id, g HAVING (max(k) + 1 - min(k)) * 30 >= 50""",
    "v1_v2_cosine": f"WITH {_V} SELECT vec_id AS segment_id, round({_DOT.format('e', 'list_transform(e, lambda x: 0.125::DOUBLE)')} / sqrt({_DOT.format('e', 'e')}), 6) AS sim, round(sqrt({_DOT.format('e', 'e')}), 6) AS norm FROM v",
    "v6_centroids": f"""WITH {_V}, p AS (SELECT label, duration AS w, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS i FROM v), s AS (SELECT label, i, sum(x * w) AS x FROM p GROUP BY ALL), w AS (SELECT label, sum(duration) AS weight FROM v GROUP BY 1)
SELECT label, i, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x, weight FROM s JOIN w USING (label)""",
    "j18_nearest_anchor": f"""WITH {_V}, a AS (SELECT label AS anchor, {_UNIT} AS c FROM (SELECT label, e FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1)),
u AS (SELECT vec_id, {_UNIT} AS x FROM v), s AS (SELECT vec_id, anchor, {_DOT.format('x', 'c')} AS sim FROM u, a)
SELECT vec_id AS segment_id, anchor, round(sim, 6) AS similarity FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, anchor) = 1""",
    "v12_v13_intruders": f"""WITH {_V}, p AS (SELECT source_id, label, duration AS w, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
s AS (SELECT source_id, label, i, sum(x * w) AS x FROM p GROUP BY ALL), c AS (SELECT source_id, label, list(x ORDER BY i) AS e FROM s GROUP BY ALL),
k AS (SELECT source_id, label, CASE WHEN label IN ('S0', 'S1') THEN 0 ELSE substr(label, 2)::INT END AS person, {_UNIT} AS c FROM c),
u AS (SELECT vec_id, vec_id % 40 AS segment_id, source_id, label, {_UNIT} AS x FROM v),
m AS (SELECT u.vec_id, u.segment_id, max({_DOT.format('u.x', 'k.c')}) FILTER (k.label = u.label) - max({_DOT.format('u.x', 'k.c')}) FILTER (k.label <> u.label AND k.person <> o.person) AS m
  FROM u JOIN k o ON o.source_id = u.source_id AND o.label = u.label JOIN k ON k.source_id = u.source_id GROUP BY ALL)
SELECT segment_id, round(count(*) FILTER (m < -0.1) * 0.75::DOUBLE, 3) AS intruder_s, round(coalesce(min(m), 1), 5) AS speaker_margin_min FROM m GROUP BY 1""",
    "v15_fold_clusters": f"""WITH {_V}, t AS (SELECT source_id, label FROM v GROUP BY ALL HAVING sum(duration) >= 18),
u AS (SELECT vec_id, source_id, label, {_UNIT} AS x FROM v), p AS (SELECT u.source_id, u.label, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM u JOIN t USING (source_id, label)),
m AS (SELECT source_id, label, i, avg(y) AS y FROM p GROUP BY ALL), c0 AS (SELECT source_id, label, list(y ORDER BY i) AS e FROM m GROUP BY ALL), c AS (SELECT source_id, label AS big, {_UNIT} AS c FROM c0),
n AS (SELECT u.vec_id, max_by(c.big, {_DOT.format('u.x', 'c.c')}) AS big FROM u JOIN c USING (source_id) GROUP BY 1)
SELECT u.vec_id AS segment_id, u.source_id, CASE WHEN t.label IS NOT NULL OR n.big IS NULL THEN u.label ELSE n.big END AS label FROM u LEFT JOIN t USING (source_id, label) LEFT JOIN n ON n.vec_id = u.vec_id""",
    "x1_signal_metrics": f"""WITH {_CLIPS}, f AS (SELECT clip_id, x, list_sort(list_transform(range(40), lambda k: {_MS.format('x[k * 20 + 1:k * 20 + 20]')})) AS p FROM c)
SELECT clip_id, round(10 * log10(greatest({_MS.format('x')}, 1e-12)), 5) AS rms_dbfs, round(20 * log10(greatest(list_max(list_transform(x, lambda y: abs(y))), 1e-6)), 5) AS peak_dbfs,
  round(len(list_filter(x, lambda y: abs(y) >= 0.999)) / len(x), 5) AS clip_ratio,
  round(least(100, 10 * log10(greatest(p[36] + (p[37] - p[36]) * (39 * 0.9::DOUBLE - 35), 1e-12)) - 10 * log10(greatest(p[4] + (p[5] - p[4]) * (39 * 0.1::DOUBLE - 3), 1e-12))), 5) AS snr_est_db FROM f""",
    "x24_x27_shaping": f"""WITH {_CLIPS}, g AS (SELECT clip_id, x, list_max(list_transform(x, lambda y: abs(y))) AS pk, sqrt({_MS.format('x')}) AS rms FROM c)
SELECT clip_id, round(list_sum(list_transform(list_zip(x, list_reverse(x)), lambda p: pow((p[1] + p[2]) / 2, 2))) / 800, 6) AS mono, round(list_sum(list_transform(x, lambda y: y * y)) / 1000, 6) AS fit,
  round(list_sum(list_transform(list_zip(x, range(800)), lambda p: pow(p[1] * CASE WHEN least(p[2], 799 - p[2]) < 50 THEN least(p[2], 799 - p[2]) / 49::DOUBLE ELSE 1 END, 2))) / 800, 6) AS fade,
  round(pow(rms * least(pow(10, -3 / 20::DOUBLE) / pk, pow(10, -1 / 20::DOUBLE) / pk), 2), 6) AS peak, round(pow(rms * least(pow(10, -10 / 20::DOUBLE) / rms, pow(10, -1 / 20::DOUBLE) / pk), 2), 6) AS rms FROM g""",
}
