"""The stages of a source, run over many sources: what is done is left alone, a failure stays with its source."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.plans import manifest as mf


@dataclass(frozen=True)
class Stage:
    """``work`` makes of a source's row, with the columns of the stages it needs, the columns of ``schema`` (one row per source). ``setup`` runs once, on the driver, before any source."""

    name: str
    work: Callable[[dict], dict]
    schema: str
    needs: tuple[str, ...] = ()
    identity: object = 1
    setup: Callable[[], None] | None = None


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _there(spark, path) else spark.createDataFrame([], schema)


def latest(manifest: DataFrame) -> DataFrame:
    """The newest row of each source and stage."""
    order = Window.partitionBy("source_id", "stage").orderBy(F.col("finished_at").desc(), "status")
    return manifest.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return latest(_read(spark, f"{folder}/manifest", mf.MANIFEST))


def shard_of(sources: DataFrame, shard: int, of: int) -> DataFrame:
    """The sources of one of ``of`` workers."""
    return sources.where(F.pmod(F.crc32(F.col("source_id")), F.lit(of)) == shard)


def run_stages(spark: SparkSession, sources: DataFrame, stages: Iterable[Stage], folder: str, until: str | None = None, force: Iterable[str] = (), shard: tuple[int, int] | None = None) -> DataFrame:
    """Run the stages, in the order given, over ``sources`` (source_id, ...): stage, outcome (done, cached, failed, blocked), n.

    Outputs are tables by stage below ``folder``, a folder for each source; the manifest beside them is appended to after each
    stage, so that a run that was stopped goes on where it stood.
    """
    stages = list(stages)
    if until is not None:
        stages = stages[: [s.name for s in stages].index(until) + 1]
    graph = {s.name: (list(s.needs), s.identity) for s in stages}
    prints, forced = mf.fingerprints(graph), mf.downstream(graph, set(force))
    schemas = {s.name: s.schema for s in stages}
    todo = shard_of(sources, *shard) if shard else sources
    counts = []
    for s in stages:
        state = read_manifest(spark, folder)
        state = mf.invalidate(state, forced & {s.name})
        output = f"{folder}/{s.name}"
        have = _read(spark, output, f"source_id string, {s.schema}")
        pending = mf.pending(todo, state, s.name, prints[s.name], have)
        stuck = mf.blocked(pending, state, list(s.needs))
        ready = pending.join(stuck.select("source_id"), "source_id", "left_anti") if s.needs else pending
        for n in s.needs:
            ready = ready.join(_read(spark, f"{folder}/{n}", f"source_id string, {schemas[n]}"), "source_id")
        n_stuck, n_todo = stuck.count(), todo.count()  # before the outputs they are read from change
        outcome = f"{folder}/_run/{s.name}"
        try:
            if s.setup:
                s.setup()
            ran = mf.isolate(ready, s.work, f"source_id string, {s.schema}")
        except Exception as e:  # nothing of this stage can run; stages that don't need it still do
            ran = _failed(ready, s.schema, f"{type(e).__name__}: {e}")
        ran.write.mode("overwrite").parquet(outcome)
        ran = spark.read.parquet(outcome)
        ran.where("error IS NULL").drop("error").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(output)
        rows = ran.select("source_id", F.lit(s.name).alias("stage"), F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"), F.lit(prints[s.name]).alias("fingerprint"), "error", F.current_timestamp().alias("finished_at"))
        tally = {r.status: r.n for r in rows.groupBy("status").agg(F.count("*").alias("n")).collect()}
        rows.write.mode("append").parquet(f"{folder}/manifest")
        tally |= {"blocked": n_stuck, "cached": n_todo - n_stuck - sum(tally.values())}
        counts += [(s.name, k, int(tally.get(k, 0))) for k in ("done", "cached", "failed", "blocked")]
    return spark.createDataFrame(counts, "stage string, outcome string, n long")


def _failed(ready: DataFrame, schema: str, message: str) -> DataFrame:
    names = [c.strip().split()[0] for c in schema.split(",")]
    empty = ready.sparkSession.createDataFrame([], schema)
    return ready.select(F.col("source_id"), *(F.lit(None).cast(empty.schema[n].dataType).alias(n) for n in names), F.lit(message).alias("error"))
