"""Sinks: CSV, JSON lines, Parquet shards by source, the dataset document and its card."""

from __future__ import annotations

import csv
import io
import json
import re
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SECRET = re.compile(r"token|secret|password|api_key|cookies", re.IGNORECASE)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Rows with a header; null is empty, quotes are doubled."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def shard_rows(rows: DataFrame) -> DataFrame:
    """Publish form: metrics and words as JSON, web addresses only, empty texts as null. rows: source_id, uri, metrics, words, ..."""
    entries = F.array_sort(F.map_entries("metrics"))
    out = rows.withColumn("metrics", F.to_json(F.map_from_entries(entries))).withColumn("words", F.to_json("words"))
    out = out.withColumn("source_url", F.when(F.col("uri").rlike("^https?://"), F.col("uri"))).drop("uri")
    texts = [f.name for f in out.schema if f.dataType.simpleString() == "string" and f.name not in ("metrics", "words")]
    return out.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder of zstd Parquet for each source; only the sources in ``rows`` are replaced."""
    rows.repartition("source_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("source_id").parquet(path)


def csv_bytes(rows: list[dict], columns: list[str]) -> bytes:
    """Rows of a small table (a summary) as CSV with a header; null is empty."""
    out = io.StringIO()
    writer = csv.DictWriter(out, columns, extrasaction="ignore", lineterminator="\n")
    writer.writeheader()
    writer.writerows({k: "" if v is None else v for k, v in r.items()} for r in rows)
    return out.getvalue().encode()


def jsonl_bytes(rows: list[dict]) -> bytes:
    return "".join(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows).encode()


def write_embeddings(rows: DataFrame, path: str) -> None:
    """segment_id and its vector in single precision, a folder for each source; only the sources in ``rows`` are replaced."""
    out = rows.select("source_id", "segment_id", F.col("embedding").cast("array<float>").alias("embedding"))
    out.repartition("source_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(path)


def redacted(value: object) -> object:
    """A configuration without anything that looks like a secret."""
    value = asdict(value) if is_dataclass(value) and not isinstance(value, type) else value
    if isinstance(value, dict):
        return {k: "***" if _SECRET.search(str(k)) and v else redacted(v) for k, v in value.items()}
    return [redacted(v) for v in value] if isinstance(value, (list, tuple)) else value


def dataset_document(totals: DataFrame, groups: DataFrame, reasons: DataFrame, config: object) -> str:
    """The dataset's figures, drop reasons and configuration as JSON; all inputs are aggregates."""
    body = totals.first().asDict()
    for kind in ("split", "series", "language"):
        rows = [r.asDict() for r in groups.where(F.col("kind") == kind).orderBy(F.desc("hours"), "name").collect()]
        body[kind] = {str(r.pop("name")): {k: v for k, v in r.items() if k != "kind"} for r in rows}
    body["dropped"] = {r.reason: r.n for r in reasons.orderBy("reason").collect()}
    body["config"] = redacted(config)
    return json.dumps(body, indent=2, default=str)


def _table(title: str, groups: dict[str, dict], columns: tuple[str, ...] = ("hours", "utterances", "speakers", "sources")) -> list[str]:
    head = [f"## By {title}", "", f"| {title} | {' | '.join(columns)} |", "| --- |" + " ---: |" * len(columns)]
    return [*head, *(f"| {k} | {' | '.join(str(v.get(c, '')) for c in columns)} |" for k, v in groups.items()), ""]


def card(name: str, document: str, license_id: str = "other", history: list[dict] | None = None) -> str:
    """A Markdown report of a dataset document: front matter, totals, splits, series, languages, what was dropped and why, what was pushed when."""
    d = json.loads(document)
    languages = "".join(f"\n- {k}" for k in d["language"])
    lines = ["---", f"license: {license_id}", f"language:{languages}", "task_categories:\n- text-to-speech\n- automatic-speech-recognition", "---", "", f"# {name}", ""]
    lines += [f"{d['total_utterances']} utterances of {d['total_speakers']} speakers, {d['total_hours']} hours from {d['num_sources']} sources.", ""]
    for kind in ("split", "series", "language"):
        lines += _table(kind, d[kind])
    if d.get("dropped"):
        lines += ["## Dropped", "", "| reason | segments |", "| --- | ---: |", *(f"| {k} | {v} |" for k, v in d["dropped"].items()), ""]
    if history:
        lines += ["## History", "", *(f"- {h['published_at']}: {h['hours_added']:+.2f} h, {h['total_hours']:.2f} h in all" for h in history), ""]
    return "\n".join(lines).rstrip() + "\n"
