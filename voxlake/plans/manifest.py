"""Incremental runs: fingerprints, the stage manifest, pending work, failures by source, versioned publishing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions.keys import stable_hash

HISTORY = "version int, published_at timestamp, sources array<string>, hours_added double, total_hours double"
MANIFEST = "source_id string, stage string, status string, fingerprint string, error string, finished_at timestamp"


def fingerprints(stages: Mapping[str, tuple[list[str], object]]) -> dict[str, str]:
    """A fingerprint per stage from its own identity and those of the stages it needs. stages: name -> (needs, identity), in order."""
    out: dict[str, str] = {}
    for name, (needs, identity) in stages.items():
        out[name] = stable_hash([name, identity, [out[n] for n in needs]])
    return out


def downstream(stages: Mapping[str, tuple[list[str], object]], names: set[str]) -> set[str]:
    """The named stages and all that need them; unknown names are ignored."""
    found = names & stages.keys()
    for name, (needs, _) in stages.items():
        if found & set(needs):
            found = found | {name}
    return found


def pending(sources: DataFrame, manifest: DataFrame, stage: str, fingerprint: str, outputs: DataFrame | None = None) -> DataFrame:
    """Sources whose stage isn't done under this fingerprint, or (given ``outputs``) whose output is gone."""
    done = manifest.where((F.col("stage") == stage) & (F.col("status") == "done") & (F.col("fingerprint") == fingerprint)).select("source_id").distinct()
    if outputs is not None:
        done = done.join(outputs.select("source_id").distinct(), "source_id", "left_semi")
    return sources.join(done, "source_id", "left_anti")


def blocked(sources: DataFrame, manifest: DataFrame, needs: list[str]) -> DataFrame:
    """Sources for which a needed stage isn't done."""
    ok = manifest.where(F.col("stage").isin(needs) & (F.col("status") == "done")).groupBy("source_id").agg(F.countDistinct("stage").alias("n")).where(F.col("n") == len(needs))
    return sources.join(ok.select("source_id"), "source_id", "left_anti") if needs else sources.limit(0)


def invalidate(manifest: DataFrame, stages: set[str]) -> DataFrame:
    return manifest.where(~F.col("stage").isin(*stages)) if stages else manifest


def isolate(items: DataFrame, work: Callable[[dict], dict], schema: str) -> DataFrame:
    """``work`` on each row, a failure kept as text in ``error`` instead of ending the run: all columns of schema, and error."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    out.append({**dict.fromkeys(names), **{k: row[k] for k in names if k in row}, **work(row), "error": None})
                except Exception as e:  # one source's failure isn't another's
                    out.append({**dict.fromkeys(names), **{k: row[k] for k in names if k in row}, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*names, "error"])

    return items.mapInPandas(run, f"{schema}, error string")


class Versions:
    """A table published in versions below a folder; a version takes its place only if nobody took it since the last was read.

    That rests on a rename that is atomic and fails if the target is there, as in HDFS and local file systems; object
    stores without such a rename need one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> int:
        """The newest version that was completed, 0 if there is none."""
        if not self._fs.exists(self._path(self.root)):
            return 0
        names = [x.getPath().getName() for x in self._fs.listStatus(self._path(self.root))]
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v{version or self.current()}")

    def publish(self, df: DataFrame, based_on: int) -> int:
        """Write the next version aside and rename it into place; fails if another writer was first."""
        aside = f"{self.root}/_new-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        to = f"{self.root}/v{based_on + 1}"
        if self.current() != based_on or self._fs.exists(self._path(to)) or not self._fs.rename(self._path(aside), self._path(to)):
            self._fs.delete(self._path(aside), True)
            raise RuntimeError(f"version {based_on} is no longer the newest")
        return based_on + 1

    def record(self, version: int, sources: list[str], hours_added: float, total_hours: float) -> None:
        """A line of history for a version."""
        row = [(version, sorted(sources), hours_added, total_hours)]
        self.spark.createDataFrame(row, HISTORY.replace("published_at timestamp, ", "")).withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/_history")

    def history(self) -> DataFrame:
        """What was published when, the newest last."""
        path = f"{self.root}/_history"
        rows = self.spark.read.schema(HISTORY).parquet(path) if self._fs.exists(self._path(path)) else self.spark.createDataFrame([], HISTORY)
        return rows.orderBy("version")
