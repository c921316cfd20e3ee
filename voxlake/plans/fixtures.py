"""Speech-like inputs derived from the base tables, in Spark and in SQL. Times are whole microseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, speaker, start, end, ord from events."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return e.select(
        (F.col("user_id") % 20).alias("source_id"), F.col("event_type").alias("speaker"), start.alias("start"),
        (start + F.round(F.col("value") * 100).cast("long") * 600000).alias("end"), F.col("event_id").alias("ord"),
    )


TURNS = """turns AS (
  SELECT user_id % 20 AS source_id, event_type AS speaker, epoch_us(ts) AS s, epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 600000 AS e, event_id AS ord FROM events
)"""

#: Merged spans of a relation src(source_id, g, s, e); g is a further key.
MERGE = """{out} AS (
  SELECT source_id, g, min(s) AS s, max(e) AS e FROM (
    SELECT *, sum(n) OVER (PARTITION BY source_id, g ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (
      SELECT source_id, g, s, e, CASE WHEN s - max(e) OVER (PARTITION BY source_id, g ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS n
      FROM {src} WHERE e > s)) GROUP BY source_id, g, k
)"""


def merge_sql(src: str, out: str, gap: int = 0) -> str:
    return MERGE.format(src=src, out=out, gap=gap)


SPEECH = "speech0 AS (SELECT source_id, 0 AS g, s, e FROM turns WHERE speaker IN ('view', 'purchase')), " + merge_sql("speech0", "speech")
BY_SPEAKER = "tg AS (SELECT source_id, speaker AS g, s, e FROM turns), " + merge_sql("tg", "merged")
OVERLAPS = (
    BY_SPEAKER
    + """, steps AS (SELECT source_id, at_ AS at_, sum(d) AS d FROM (SELECT source_id, s AS at_, 1 AS d FROM merged UNION ALL SELECT source_id, e, -1 FROM merged) GROUP BY source_id, at_),
active AS (SELECT source_id, at_ AS s, lead(at_) OVER w AS e, sum(d) OVER (w ROWS UNBOUNDED PRECEDING) AS n FROM steps WINDOW w AS (PARTITION BY source_id ORDER BY at_)),
o0 AS (SELECT source_id, 0 AS g, s, e FROM active WHERE n >= 2 AND e IS NOT NULL), """
    + merge_sql("o0", "regions")
)


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).where(F.col("speaker").isin("view", "purchase")).select("source_id", "start", "end")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, ord, text, start, end, turn, role: tokens of conversations, half a second apart."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    w = c.select(F.col("conv_id").alias("source_id"), "turn", "role", F.posexplode(F.split("text", " ")).alias("pos", "text")).where("text <> ''")
    order = Window.partitionBy("source_id").orderBy("turn", "role", "pos", "text")
    w = w.withColumn("ord", F.row_number().over(order).cast("long") - 1)
    start = F.col("ord") * 500000 + F.pmod(F.col("ord") * 7919 + F.col("source_id"), F.lit(11)) * 130000
    return w.select("source_id", "ord", "text", start.alias("start"), (start + 200000 + F.length("text").cast("long") * 40000).alias("end"), "turn", "role")


WORDS = """words AS (
  SELECT source_id, ord, text, ord * 500000 + ((ord * 7919 + source_id) % 11) * 130000 AS s, ord * 500000 + ((ord * 7919 + source_id) % 11) * 130000 + 200000 + length(text) * 40000 AS e, turn, role
  FROM (SELECT source_id, turn, role, text, row_number() OVER (PARTITION BY source_id ORDER BY turn, role, pos, text) - 1 AS ord
    FROM (SELECT conv_id AS source_id, turn, role, unnest(string_split(text, ' ')) AS text, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM conversations) WHERE text <> '')
)"""


def word_turns(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Turns of the dialogues, a little off the words: source_id, speaker, start, end, ord. ``of``: the words, where they are at hand."""
    w = (words(spark, sf_dir) if of is None else of).where("turn IS NOT NULL AND role IS NOT NULL")
    t = w.groupBy("source_id", "turn", "role").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    shift = F.pmod(F.col("turn") * 31 + F.col("source_id"), F.lit(5)) * 150000 - 300000
    return t.select("source_id", F.col("role").alias("speaker"), (F.col("a") + shift).alias("start"), (F.col("b") + shift).alias("end"), F.col("turn").alias("ord"))


WORD_TURNS = """wturns AS (
  SELECT source_id, role AS speaker, min(s) + ((turn * 31 + source_id) % 5) * 150000 - 300000 AS s, max(e) + ((turn * 31 + source_id) % 5) * 150000 - 300000 AS e, turn AS ord
  FROM words WHERE turn IS NOT NULL AND role IS NOT NULL GROUP BY source_id, turn, role
)"""
