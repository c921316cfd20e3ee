"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators import intervals, rules, summary
from voxlake.plans import build_queries, clip_queries, corpus_queries, interval_queries, segment_queries, text_queries, vector_queries
from voxlake.plans import fixtures as fx

MODULES = (text_queries, interval_queries, corpus_queries, segment_queries, vector_queries, clip_queries, build_queries)

_RULES = (rules.Rule("duration", min=3.0, max=1800.0), rules.Rule("overlap_ratio", max=0.9))


def speaker_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers of the turns that pass the rules: turns, overlap regions, coverage, rules, summary."""
    turns = fx.turns(spark, sf_dir)
    regions = intervals.overlap_regions(turns, ["source_id"])
    covered = intervals.coverage(turns, regions, ["source_id"], ["ord"], fx.HOUR)
    metrics = {"duration": (F.col("end") - F.col("start")) / 1e6, "overlap_ratio": intervals.coverage_ratio()}
    good = covered.where(rules.first_failure(metrics, _RULES).isNull())
    rows = good.select(
        F.col("speaker").alias("speaker_id"), F.lit(None).cast("string").alias("speaker_name"), F.lit("train").alias("split"), ((F.col("end") - F.col("start")) / 1e6).alias("duration"),
        F.col("source_id").cast("string").alias("source_id"), F.lit(None).cast("string").alias("ref_id"), "ord",
    )
    return summary.speaker_rows(rows, ["ord"])


SPEAKER_OVERVIEW_SQL = f"""WITH {fx.TURNS}, {fx.OVERLAPS}, c AS (
  SELECT t.*, coalesce(sum(least(t.e, p.e) - greatest(t.s, p.s)) FILTER (p.s IS NOT NULL), 0) AS covered FROM turns t LEFT JOIN regions p ON t.source_id = p.source_id AND p.s < t.e AND t.s < p.e GROUP BY ALL
), g AS (SELECT * FROM c WHERE (e - s) / 1e6 BETWEEN 3 AND 1800 AND (CASE WHEN e > s THEN covered / (e - s) ELSE 0 END) <= 0.9)
SELECT speaker AS speaker_id, NULL::VARCHAR AS speaker_name, 'train' AS split, count(*)::BIGINT AS num_utterances, round(sum((e - s) / 1e6), 2) AS total_duration_s, count(DISTINCT source_id)::BIGINT AS num_sources,
  0::BIGINT AS num_references, array_to_string(list_sort(list(DISTINCT source_id::VARCHAR)), ';') AS sources FROM g GROUP BY 1"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {"speaker_overview": speaker_overview}
    for m in MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out = {"speaker_overview": SPEAKER_OVERVIEW_SQL}
    for m in MODULES:
        out |= m.SQL
    return out


QUERIES, SQL = {"speaker_overview": speaker_overview}, {"speaker_overview": SPEAKER_OVERVIEW_SQL}
