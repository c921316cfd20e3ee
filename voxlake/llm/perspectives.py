"""Chat formatting: a dialogue rendered from the perspective of each of its participants.

For every participant the dialogue is written with that speaker as assistant and the others as named
users; system turns stay system turns and no participant. The mask lists the character spans that
the assistant speaks, end mark included: what a trainer computes the loss over.

A dialogue is rendered as a whole. Only one of more than ``PART_BYTES``, which one row and one task
should not hold, comes as parts 0, 1, ... whose texts in a row are the rendering of the whole; masks
count from the beginning of their part. Its turns are put in order by ranges over many tasks, so that
a dialogue of any length, with any number of equal turn numbers, is gathered nowhere.

Marks within a text or a name are escaped (``<|`` as ``<\\|``, ``<\\`` as ``<\\\\``), so that no turn can
open or close another; ``unescape`` restores a text. Line ends in a name become spaces.

Defined cases: a null text is an empty turn; a null speaker is the user "unknown"; a null turn number
sorts first; equal rows and turns with equal numbers all stay, ordered by speaker and digest of the
text; a dialogue of system turns only has no participant and gives no row; a null conversation id is
a dialogue of its own, other than that of an empty id; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch

PART_BYTES = 1 << 20
TURN_BYTES = 64  # of the marks of a turn
RANGE_BYTES = 32 << 20
START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return text.replace("<\\|", "<|").replace("<\\\\", "<\\")


def head(speaker: Column, participant: Column) -> Column:
    """How a turn opens, seen by a participant."""
    return (
        F.when(speaker == SYSTEM, F.lit(f"{START}system\n"))
        .when(speaker == participant, F.lit(f"{START}assistant\n"))
        .otherwise(F.concat(F.lit(f"{START}user name="), F.translate(escaped(speaker), "\r\n", "  "), F.lit("\n")))
    )


def _in_parts(turns: DataFrame, part_bytes: int) -> DataFrame:
    """``turns`` (conv_id, t, size) with the part of each: 0, but for dialogues longer than a part."""
    scratch = Scratch(turns.sparkSession, "dialogues")
    long = scratch.save(turns.groupBy("conv_id").agg(F.sum("size").alias("total")).where(F.col("total") > part_bytes).withColumnRenamed("conv_id", "long_id"), "long")
    whole = long.agg(F.sum("total")).first()[0]
    if not whole:
        return turns.withColumn("part", F.lit(0).cast("long"))
    of_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    order = ["conv_id", "t.dated", "t.turn", "t.speaker", "t.digest"]
    dealt = turns.join(long, of_long, "left_semi").withColumn("salt", F.monotonically_increasing_id())  # tells equal turns apart
    dealt = dealt.repartitionByRange(math.ceil(whole / RANGE_BYTES), *order, "salt").sortWithinPartitions(*order, "salt").drop("salt")
    dealt = scratch.save(dealt.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("range", F.shiftright("at", 33))
    ranges = dealt.groupBy("conv_id", "range").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("conv_id").alias("r_id"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ranges, F.col("conv_id").eqNullSafe(F.col("r_id")) & (F.col("range") == F.col("r")))
    placed = placed.select("conv_id", "t", "size", F.floor((F.col("base") + F.col("inside")) / part_bytes).cast("long").alias("part"))
    return turns.join(long, of_long, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(placed)


def rotate_perspectives(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """conv_id, part, participant, n_turns, n_own_turns, text, mask (array of start, end) for each
    participant. ``turns``: conv_id, turn, role, text."""
    text = F.coalesce("text", F.lit(""))
    t = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("speaker"), F.md5(text).alias("digest"), escaped(text).alias("text")
        ).alias("t"),
        (F.octet_length(text) + TURN_BYTES).cast("long").alias("size"),
    )
    parts = _in_parts(t, part_bytes).groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    speakers = t.select(F.col("conv_id").alias("s_id"), F.col("t.speaker").alias("participant")).where(F.col("participant") != SYSTEM).distinct()
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("s_id")))
    rendered = F.transform(
        "ts",
        lambda x: F.struct(
            F.concat(head(x["speaker"], F.col("participant")), x["text"], F.lit(END)).alias("s"),
            F.length(head(x["speaker"], F.col("participant"))).alias("skip"),
            (x["speaker"] == F.col("participant")).alias("own"),
        ),
    )
    seen = seen.withColumn("ps", rendered)
    spans = F.aggregate(
        "ps",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["s"])).alias("at"),
            F.when(p["own"], F.concat(a["mask"], F.array(F.struct((a["at"] + p["skip"]).alias("start"), (a["at"] + F.length(p["s"])).alias("end"))))).otherwise(a["mask"]).alias("mask"),
        ),
    )
    return seen.select(
        "conv_id",
        "part",
        "participant",
        F.size("ps").cast("long").alias("n_turns"),
        F.size(F.filter("ps", lambda p: p["own"])).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("ps", lambda p: p["s"]), "").alias("text"),
        spans["mask"].alias("mask"),
    )


def op10_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from the perspective of each participant; the mask as start-end;..."""
    out = rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return out.withColumn("mask", F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ";"))


_ESCAPED = r"replace(replace(%s, '<\', '<\\'), '<|', '<\|')"
OP10_SQL = f"""
WITH t0 AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS raw FROM conversations
), t AS (
  SELECT conv_id, turn, speaker, md5(raw) AS digest, {_ESCAPED % 'raw'} AS text,
    coalesce(sum(strlen(raw) + {TURN_BYTES}) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, md5(raw) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // {PART_BYTES} AS part
  FROM t0
), p AS (SELECT DISTINCT conv_id AS pc, speaker AS participant FROM t WHERE speaker <> '{SYSTEM}'),
m AS (
  SELECT *, CASE WHEN speaker = '{SYSTEM}' THEN '{START}system' WHEN speaker = participant THEN '{START}assistant'
    ELSE '{START}user name=' || replace(replace({_ESCAPED % 'speaker'}, chr(13), ' '), chr(10), ' ') END || chr(10) AS head
  FROM t JOIN p ON conv_id IS NOT DISTINCT FROM pc
), s AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS body, row_number() OVER (PARTITION BY conv_id, part, participant ORDER BY turn NULLS FIRST, speaker, digest) AS k FROM m
), o AS (SELECT *, sum(length(body)) OVER (PARTITION BY conv_id, part, participant ORDER BY k) AS upto FROM s)
SELECT conv_id, part, participant, count(*)::BIGINT AS n_turns, count(*) FILTER (speaker = participant)::BIGINT AS n_own_turns,
  string_agg(body, '' ORDER BY k) AS text,
  coalesce(string_agg((upto - length(body) + length(head))::BIGINT::VARCHAR || '-' || upto::BIGINT::VARCHAR, ';' ORDER BY k) FILTER (speaker = participant), '') AS mask
FROM o GROUP BY conv_id, part, participant
"""
