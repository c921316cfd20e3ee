"""Text, key and source operators as queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions import keys as ky
from voxlake.functions import text as tx
from voxlake.plans.fixtures import read
from voxlake.sources import resolve as rs

_CODES = ("English", "hin", " EN_us ", "hinglish", "bangla", "fr-CA", "de", "zh_Hant", "", "Odia", "ja")


def _codes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.concat(F.element_at(F.array(*(F.lit(c) for c in _CODES)), (F.col("doc_id") % len(_CODES)).cast("int") + 1)).alias("code"), "lang")


def t1_t2_t9_languages(spark: SparkSession, d: str) -> DataFrame:
    c = _codes(read(spark, d, "documents").select("doc_id", "lang"))
    return c.select(
        "doc_id", tx.normalize_language(F.col("code")).alias("language"), tx.normalize_language(F.col("lang")).alias("doc_language"),
        F.array_join(tx.container_language_tags(F.col("code")), ",").alias("tags"), tx.with_leading_space(F.lit("  word "), F.col("code")).alias("token"),
    )


def t4_t6_t10_text_measures(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    seconds = F.length(t) / 15.0
    return read(spark, d, "documents").select(
        "doc_id", tx.spoken_char_count(t).alias("spoken_chars"), F.size(tx.tokenize(t)).cast("long").alias("n_tokens"), F.round(tx.repetition_ratio(t), 6).alias("repetition_ratio"),
        F.round(tx.per_second(tx.spoken_char_count(t), seconds), 5).alias("chars_per_sec"),
    )


def t7_t8_w18_endings(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    x = F.col("line")
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), tx.ends_sentence(x).alias("sentence"), tx.ends_clause(x).alias("clause"), tx.is_cased(x).alias("cased"), tx.starts_lowercase(x).alias("lower"))


def f9_f10_t15_keys(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select("page_id", "url")
    return p.select("page_id", ky.shard_of(F.col("url"), 7).alias("shard"), ky.slugify(F.col("url")).alias("slug"), ky.public_uri(F.col("url")).alias("public"), ky.public_uri(F.concat(F.lit("/data/in/"), F.col("page_id").cast("string"), F.lit(".mkv"))).alias("local"), ky.source_of(F.concat(F.col("url"), F.lit(":S1"))).alias("source"), ky.shard_path(F.col("page_id")).alias("path"))


_URLS = (
    "https://www.youtube.com/watch?v=abcdefghijk&t=3", "https://youtu.be/abcdefghijk", "https://m.youtube.com/shorts/abcdefghij_", "https://www.youtube.com/playlist?list=PL1",
    "https://www.youtube.com/@channel", "https://www.youtube.com/watch?list=PL2", "http://example.org/a.mp3", "/data/film.mkv", "ftp://x.org/y",
)


def s5_s8_urls(spark: SparkSession, d: str) -> DataFrame:
    u = read(spark, d, "pages").select("url")
    u = u.union(spark.createDataFrame([(x,) for x in _URLS], "url string"))
    c = F.col("url")
    return u.select("url", rs.is_url(c).alias("is_url"), rs.youtube_video_id(c).alias("video"), rs.looks_like_playlist(c).alias("playlist"), rs.url_source_id(c).alias("source_id"), rs.canonical_url(c).alias("canonical"))


def s1_resolve(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select(F.col("page_id").alias("pos"), F.when(F.col("page_id") % 10 == 0, F.lit(_URLS[1])).otherwise(F.col("url")).alias("uri"), F.when(F.col("page_id") % 3 == 0, F.lit("English")).alias("language"))
    return rs.resolve(p, "hin")


def a3_series(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "source")
    s = F.concat(F.col("source"), F.element_at(F.array(*(F.lit(x) for x in ("-ep01-3fa2c1d9e0", "-s01e07-0123456789", "-s01-e02", "_12", "", "-Episode 3"))), (F.col("doc_id") % 6).cast("int") + 1))
    s = F.when(F.col("doc_id") % 17 == 0, F.lit("yt-abc")).when(F.col("doc_id") % 19 == 0, F.lit("url-abc")).otherwise(s)
    return docs.select("doc_id", s.alias("source_id")).withColumn("series", ky.series_of(F.col("source_id")))


def s15_s16_streams(spark: SparkSession, d: str) -> DataFrame:
    """Streams of a probe per page, and the one chosen."""
    p = read(spark, d, "pages").select(F.col("page_id").cast("string").alias("source_id"), (F.col("page_id") % 4).cast("int").alias("k"))
    stream = '{"codec_type":"audio","codec_name":"%s","channels":%s,"sample_rate":"48000","tags":{"LANGUAGE":"%s","title":"%s"},"disposition":{"default":%s,"comment":%s}}'
    probes = [
        [("aac", 2, "jpn", "Main", 1, 0), ("ac3", 6, "eng", "Dub", 0, 0)],
        [("aac", 2, "eng", "Commentary", 1, 0), ("aac", 2, "jpn", "", 0, 0)],
        [("aac", 2, "eng", "x", 0, 1)],
        [("aac", 2, "fre", "a", 0, 0), ("aac", 6, "fre", "b", 0, 0), ("aac", 6, "fre", "c", 1, 0)],
    ]
    texts = ['{"streams":[{"codec_type":"video"},' + ",".join(stream % s for s in probe) + "]}" for probe in probes]
    probe = F.element_at(F.array(*(F.lit(t) for t in texts)), F.col("k") + 1)
    streams = rs.audio_streams(p.select("source_id", probe.alias("probe")))
    return rs.select_streams(streams).select("source_id", F.col("index").cast("long").alias("stream"), "language", "title", F.col("channels").cast("long").alias("channels"))


QUERIES = {
    "t1_t2_t9_languages": t1_t2_t9_languages,
    "t4_t6_t10_text_measures": t4_t6_t10_text_measures,
    "t7_t8_w18_endings": t7_t8_w18_endings,
    "f6_f10_t13_t16_keys": f9_f10_t15_keys,
    "s5_s8_urls": s5_s8_urls,
    "s1_resolve": s1_resolve,
    "s15_s16_streams": s15_s16_streams,
    "a3_series": a3_series,
}


def q(s: str) -> str:
    return s.replace("'", "''")


def _language_sql(c: str) -> str:
    x = f"replace(lower(trim({c})), '_', '-')"
    whens = " ".join(f"WHEN {x} IN ({', '.join(repr(n) for n in names)}) THEN '{k}'" for k, names in tx.LANGUAGE_NAMES.items())
    return f"(CASE WHEN coalesce({c}, '') = '' THEN NULL {whens} ELSE {x} END)"


_TAG = "CASE b " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tx.STREAM_TAGS.items()) + " END"
_ALL_CODES = "[" + ", ".join(f"'{c}'" for c in _CODES) + "]"
_TOKENS = r"list_filter(list_transform(regexp_split_to_array(text, '\s+'), lambda w: lower(regexp_replace(w, '[^\p{L}\p{M}\p{N}]', '', 'g'))), lambda w: w <> '')"
_CLOSE = q("[\"'”’)\\]»]")


def _ends(x: str, marks: str) -> str:
    return rf"regexp_matches(regexp_replace(regexp_replace({x}, '\s+$', ''), '{_CLOSE}+$', ''), '[{q(marks)}]$')"


def _mod_sql(k: str, n: str) -> str:
    parts = ", ".join(f"('0x' || substr(sha1({k}), {1 + 4 * i}, 4))::BIGINT" for i in range(10))
    return f"list_reduce([0::BIGINT, {parts}], lambda a, d: (a * 65536 + d) % ({n}))"


_SLUG = "regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_HOST = r"regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\.', ''), '^m\.', '')"
_PATH = r"regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_VIDEO = rf"""(CASE WHEN {_HOST} = 'youtu.be' THEN nullif(regexp_extract(url, '^[a-z]+://[^/]*/+([A-Za-z0-9_-]{{11}})(?:[/?#]|$)', 1), '')
  WHEN {_HOST} = 'youtube.com' OR {_HOST} LIKE '%.youtube.com' THEN CASE WHEN {_PATH} = '/watch' THEN nullif(regexp_extract(url, '[?&]v=([A-Za-z0-9_-]{{11}})(?:[&#]|$)', 1), '')
  WHEN regexp_matches({_PATH}, '^/(shorts|live|embed)/') THEN nullif(regexp_extract({_PATH}, '^/[a-z]+/([A-Za-z0-9_-]{{11}})(?:/|$)', 1), '') END END)"""
_URL_ID = f"""CASE WHEN {_VIDEO} IS NOT NULL THEN 'yt-' || {_VIDEO} ELSE 'url-' || substr(sha1('"' || url || '"'), 1, 12) END"""
_CANON = f"CASE WHEN {_VIDEO} IS NOT NULL THEN 'https://www.youtube.com/watch?v=' || {_VIDEO} ELSE url END"
_EP = r"(?i)[-_ ](s\d+[-_ ]?e\d+|ep?\d+|episode[-_ ]?\d+|\d{1,4})$"
SQL = {
    "t1_t2_t9_languages": f"""WITH c AS (SELECT doc_id, {_ALL_CODES}[doc_id % {len(_CODES)} + 1] AS code, lang FROM documents),
l AS (SELECT doc_id, code, {_language_sql('code')} AS language, {_language_sql('lang')} AS doc_language FROM c), b AS (SELECT *, split_part(language, '-', 1) AS b FROM l)
SELECT doc_id, language, doc_language, CASE WHEN coalesce(language, '') = '' THEN '' ELSE array_to_string(list_sort(list_distinct([language, b, {_TAG}])), ',') END AS tags,
  CASE WHEN coalesce(b, '') IN ({', '.join(repr(x) for x in tx.UNSPACED_LANGUAGES)}) THEN 'word' ELSE ' word' END AS token FROM b""",
    "t4_t6_t10_text_measures": rf"""WITH t AS (SELECT doc_id, text, {_TOKENS} AS w, length(regexp_replace(text, '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g')) AS n FROM documents),
g AS (SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i:i + 2], ' ')) AS grams FROM t)
SELECT doc_id, n::BIGINT AS spoken_chars, len(w)::BIGINT AS n_tokens, CASE WHEN len(w) < 4 THEN 0.0 ELSE round(1 - len(list_distinct(grams)) / len(grams), 6) END AS repetition_ratio,
  round(n / nullif(length(text) / 15.0::DOUBLE, 0), 5) AS chars_per_sec FROM g""",
    "t7_t8_w18_endings": rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)
SELECT doc_id, line_no::BIGINT AS line_no, {_ends('line', tx.SENTENCE_END)} AS sentence, {_ends('line', tx.CLAUSE_END)} AS clause,
  regexp_matches(line, '\p{{Lu}}') AS cased, regexp_matches(regexp_extract(line, '\p{{L}}'), '^[\p{{Ll}}ªº]') AS lower FROM l""",
    "f6_f10_t13_t16_keys": f"""SELECT page_id, {_mod_sql('url', '7')} AS shard, regexp_replace(substr({_SLUG}, 1, 40), '^-+|-+$', '', 'g') AS slug,
  CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE list_last(string_split(url, '/')) END AS public, page_id::VARCHAR || '.mkv' AS local, url AS source, 'data/' || page_id::VARCHAR || '.parquet' AS path FROM pages""",
    "s5_s8_urls": f"""WITH u AS (SELECT url FROM pages UNION ALL SELECT unnest([{', '.join(repr(x) for x in _URLS)}]))
SELECT url, regexp_matches(url, '^https?://') AS is_url, {_VIDEO} AS video,
  {_HOST} LIKE '%youtube.com%' AND ({_PATH} = '/playlist' OR regexp_matches({_PATH}, '^/(@|channel/|c/|user/)') OR (regexp_matches(url, '[?&]list=') AND {_VIDEO} IS NULL)) AS playlist,
  {_URL_ID} AS source_id, {_CANON} AS canonical FROM u""",
    "s1_resolve": f"""WITH p AS (SELECT page_id AS pos, CASE WHEN page_id % 10 = 0 THEN '{_URLS[1]}' ELSE url END AS url, CASE WHEN page_id % 3 = 0 THEN 'en' ELSE 'hi' END AS language FROM pages)
SELECT {_URL_ID} AS source_id, {_CANON} AS uri, 'url' AS kind, language FROM p QUALIFY row_number() OVER (PARTITION BY {_URL_ID} ORDER BY pos) = 1""",
    "s15_s16_streams": """SELECT page_id::VARCHAR AS source_id, CASE page_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 2 END::BIGINT AS stream,
  CASE page_id % 4 WHEN 0 THEN 'eng' WHEN 1 THEN 'jpn' WHEN 2 THEN 'eng' ELSE 'fre' END AS language, CASE page_id % 4 WHEN 0 THEN 'Dub' WHEN 2 THEN 'x' WHEN 3 THEN 'c' END AS title,
  CASE page_id % 4 WHEN 0 THEN 6 WHEN 3 THEN 6 ELSE 2 END::BIGINT AS channels FROM pages""",
    "a3_series": rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'yt-abc' WHEN doc_id % 19 = 0 THEN 'url-abc'
  ELSE source || ['-ep01-3fa2c1d9e0', '-s01e07-0123456789', '-s01-e02', '_12', '', '-Episode 3'][doc_id % 6 + 1] END AS source_id FROM documents)
SELECT doc_id, source_id, CASE WHEN source_id LIKE 'yt-%' THEN 'youtube' WHEN source_id LIKE 'url-%' THEN 'url'
  ELSE coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(source_id, '-[0-9a-f]{{10}}$', ''), '{_EP}', ''), '{_EP}', ''), ''), source_id) END AS series FROM d""",
}
