"""Incremental publishing: merges, path plans, lineage checks, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions.keys import source_of
from voxlake.operators.ranks import ranked


def merge_rows(remote: DataFrame, local: DataFrame, local_sources: DataFrame) -> DataFrame:
    """Local rows in place of all published rows of the locally built sources (source_id), even of those that have none left."""
    return remote.join(local_sources.select("source_id").distinct(), "source_id", "left_anti").unionByName(local, allowMissingColumns=True)


def referenced_files(rows: DataFrame) -> DataFrame:
    """Distinct paths of clips and references."""
    paths = rows.select(F.explode(F.array("audio_path", "ref_audio_path")).alias("path"))
    return paths.where("path IS NOT NULL AND path <> ''").distinct()


def plan_paths(needed: DataFrame, local: DataFrame, remote: DataFrame) -> DataFrame:
    """path, action, sha1: missing, upload, keep or delete. needed: path; local, remote: path, sha1."""
    plan = needed.select("path", F.lit(True).alias("needed")).join(local.select("path", F.col("sha1").alias("l")), "path", "full").join(remote.select("path", F.col("sha1").alias("r")), "path", "full")
    wanted, have, there = F.coalesce("needed", F.lit(False)), F.col("l").isNotNull(), F.col("r").isNotNull()
    action = (
        F.when(wanted & ~have & ~there, "missing").when(wanted & have & ~F.col("l").eqNullSafe(F.col("r")), "upload").when(wanted, "keep").when(there, "delete")
    )
    return plan.withColumn("action", action).where(F.col("action").isNotNull()).select("path", "action", F.when(wanted, F.coalesce("l", "r")).alias("sha1"))


def check_plan(plan: DataFrame) -> DataFrame:
    """The plan, once no path is missing."""
    missing = plan.where("action = 'missing'").agg(F.count("*").alias("n"), F.min("path").alias("p")).first()
    if missing.n:
        raise ValueError(f"{missing.n} referenced files exist neither locally nor remotely, the first is {missing.p}")
    return plan


def lineage_breaks(remote: DataFrame, local: DataFrame, local_sources: DataFrame) -> DataFrame:
    """Published speakers that the local registry lost, or of which it lost members of other sources. Registries: speaker_id, member."""
    foreign = remote.withColumn("source_id", source_of(F.col("member"))).join(local_sources.select("source_id").distinct(), "source_id", "left_anti")
    lost = foreign.join(local, ["speaker_id", "member"], "left_anti").select("speaker_id")
    gone = remote.select("speaker_id").distinct().join(local.select("speaker_id").distinct(), "speaker_id", "left_anti")
    return lost.union(gone).distinct()


def check_lineage(remote: DataFrame, local: DataFrame, local_sources: DataFrame, remote_next_id: int = 0, local_next_id: int = 0) -> None:
    bad = lineage_breaks(remote, local, local_sources).orderBy("speaker_id").first()
    if bad or local_next_id < remote_next_id:
        raise ValueError(f"the local registry was not built on the published one (speaker {bad.speaker_id if bad else '?'})")


def upload_batches(paths: DataFrame, size: int) -> DataFrame:
    """Paths with their batch, in path order."""
    return ranked(paths, "path", "_rank").select("path", F.floor(F.col("_rank") / size).alias("batch"))
