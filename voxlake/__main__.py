"""Command line: init, process, build, run, push, status, hub-status, components, doctor.

A work folder holds Parquet tables: segments, scores, embeddings, windows (optional), manifest, registry (versions).
Exit codes: 0, 1 when stages failed, 2 for wrong settings.
"""

from __future__ import annotations

import argparse
import importlib
import importlib.util
import shutil
import sys
from dataclasses import asdict

from pyspark.sql import functions as F

from voxlake.plans import build as bd


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("voxlake").getOrCreate()


def _settings(args: argparse.Namespace) -> bd.Settings:
    import yaml

    given: dict = {}
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            given = yaml.safe_load(f) or {}
    return bd.configure(bd.configure(bd.Settings(), given), bd.overrides(args.set))


def _init(args) -> int:
    import yaml

    with open(args.path, "x", encoding="utf-8") as f:
        yaml.safe_dump(_plain(asdict(bd.Settings())), f, sort_keys=False)
    return 0


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def _build(args) -> int:
    from voxlake.operators import identity
    from voxlake.plans.manifest import Versions

    settings = _settings(args)
    spark = _session()
    state = Versions(spark, f"{args.work}/registry")
    at = state.current()
    registry = identity.registry_of(state.read(at)) if at else identity.empty_registry(spark)
    read = lambda n: spark.read.parquet(f"{args.work}/{n}")
    built = bd.build_dataset(read("segments"), read("scores"), read("embeddings"), read("windows") if args.windows else None, registry, settings)
    built.rows.write.mode("overwrite").parquet(f"{args.work}/utterances")
    state.publish(built.registry, at)
    built.reasons.show(100, False)
    return 0


def _push(args) -> int:
    from voxlake.operators.publish import merge_rows
    from voxlake.operators.summary import totals
    from voxlake.plans.manifest import Versions

    spark = _session()
    local = spark.read.parquet(f"{args.work}/utterances")
    built = spark.read.parquet(f"{args.work}/segments").select("source_id").distinct()
    target = Versions(spark, args.to)
    at = target.current()
    before = target.read(at) if at else None
    merged = merge_rows(before, local, built) if at else local
    totals(merged).show()
    if not args.dry_run:
        hours = [float(x.agg(F.sum("duration")).first()[0] or 0) / 3600 if x is not None else 0.0 for x in (merged, before)]
        version = target.publish(merged, at)
        target.record(version, [str(r.source_id) for r in built.collect()], round(hours[0] - hours[1], 3), round(hours[0], 3))
        print("published version", version)
    return 0


def _hub_status(args) -> int:
    from voxlake.operators.summary import by_group, totals
    from voxlake.plans.manifest import Versions

    target = Versions(_session(), args.to)
    if not target.current():
        raise ValueError(f"nothing is published at {args.to}")
    rows = target.read()
    totals(rows).show()
    by_group(rows).where("kind = 'series'").orderBy("name").show(1000, False)
    target.history().show(1000, False)
    return 0


def _stages(name: str):
    """The stages that a module offers, as module:name."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute or "STAGES")


def _process(args) -> int:
    from voxlake.plans.runner import run_stages
    from voxlake.sources.files import resolve_inputs

    spark = _session()
    shard = tuple(int(x) for x in args.shard.split("/")) if args.shard else None
    sources = resolve_inputs(spark, args.inputs, args.language)
    counts = run_stages(spark, sources, _stages(args.stages), args.work, args.until, args.force, shard)
    counts.groupBy("stage").pivot("outcome").sum("n").orderBy("stage").show(100, False)
    return int(bool(counts.where("outcome = 'failed'").agg(F.sum("n")).first()[0]))


def _run(args) -> int:
    return _process(args) or _build(args)


def _status(args) -> int:
    from voxlake.operators.summary import stage_status

    m = _session().read.parquet(f"{args.work}/manifest")
    counts = stage_status(m.select("source_id").distinct(), m.select("stage").distinct(), m.select("source_id", "stage", "status"))
    counts.orderBy("stage").show(100, False)
    if args.errors:
        m.where("status = 'failed'").select("source_id", "stage", "error").show(1000, False)
    return int(bool(counts.agg(F.sum("failed")).first()[0]))


def _components(args) -> int:
    from voxlake import components

    components.plugins()
    for kind, name in sorted(components._registered):
        print(f"{kind}.{name}")
    return 0


def _doctor(args) -> int:
    for module in ("pyspark", "pyarrow", "pandas", "numpy", "yaml", "zstandard", "xxhash"):
        print(f"{module}: {'found' if importlib.util.find_spec(module) else 'missing'}")
    for tool in ("java", "ffmpeg"):
        print(f"{tool}: {shutil.which(tool) or 'missing'}")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="voxlake")
    sub = p.add_subparsers(required=True)

    def command(name: str, run, *options: tuple) -> None:
        c = sub.add_parser(name)
        for flags, kind in options:
            c.add_argument(*flags, **kind)
        c.set_defaults(run=run)

    work = (("work",), {})
    command("init", _init, (("path",), {}))
    command("build", _build, work, (("--config",), {}), (("--set",), {"action": "append", "default": []}), (("--windows",), {"action": "store_true"}))
    inputs = [work, (("inputs",), {"nargs": "+"}), (("--stages",), {"required": True}), (("--language",), {}), (("--until",), {}), (("--force",), {"action": "append", "default": []}), (("--shard",), {})]
    building = [(("--config",), {}), (("--set",), {"action": "append", "default": []}), (("--windows",), {"action": "store_true"})]
    command("process", _process, *inputs)
    command("run", _run, *inputs, *building)
    command("hub-status", _hub_status, (("to",), {}))
    command("push", _push, work, (("to",), {}), (("--dry-run",), {"action": "store_true"}))
    command("status", _status, work, (("--errors",), {"action": "store_true"}))
    command("components", _components)
    command("doctor", _doctor)
    args = p.parse_args(argv)
    try:
        return args.run(args)
    except (ValueError, TypeError, FileNotFoundError, ImportError, AttributeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
