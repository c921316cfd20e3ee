"""Media steps around external programs: commands as Column expressions, run per file with failures kept as text."""

from __future__ import annotations

import os
import subprocess
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_center(channels: Column, layout: Column) -> Column:
    """Whether a surround layout has a front-centre channel; layouts that aren't named count if they have three channels."""
    name = F.lower(F.coalesce(layout, F.lit("")))
    return (channels >= 3) & ((name == "") | name.rlike(r"^(5\.1|6\.1|7\.1|3\.)"))


def extract_command(source: Column, target: Column, stream: Column, rate: int, mode: str, channels: Column, layout: Column) -> Column:
    """Arguments that extract one audio stream to 16-bit FLAC: stereo, mono, or the centre channel where there is one."""
    text = lambda *xs: [x if isinstance(x, Column) else F.lit(x) for x in xs]
    opening = F.array(*text("ffmpeg", "-nostdin", "-hide_banner", "-loglevel", "error", "-y", "-i", source, "-map", F.concat(F.lit("0:a:"), stream.cast("string")), "-vn", "-sn", "-dn"))
    mono, stereo, center = (F.array(*text(*xs)) for xs in (("-ac", "1"), ("-ac", "2"), ("-af", "pan=mono|c0=c2", "-ac", "1")))
    if mode not in ("stereo", "mono", "center"):
        raise ValueError(f"no such mode: {mode}")
    mix = {"stereo": stereo, "mono": mono}.get(mode)
    mix = F.when(has_center(channels, layout), center).otherwise(mono) if mix is None else mix
    return F.concat(opening, mix, F.array(*text("-ar", str(rate), "-c:a", "flac", "-sample_fmt", "s16", target)))


def run_commands(jobs: DataFrame) -> DataFrame:
    """Run ``command`` (its last argument is the target) for each job: target, error. Targets are written aside and renamed, so
    that a task that runs again leaves whole files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for command in pdf["command"]:
                *args, target = list(command)
                stem, dot, kind = target.rpartition(".")
                aside = f"{stem}.{uuid.uuid4().hex}.{kind}" if dot else f"{target}.{uuid.uuid4().hex}"
                try:
                    done = subprocess.run([*args, aside], capture_output=True, text=True, check=False)
                    if done.returncode:
                        raise RuntimeError(done.stderr.strip()[-500:] or f"exit code {done.returncode}")
                    os.replace(aside, target)
                    rows.append((target, None))
                except Exception as e:  # one file's failure isn't another's
                    rows.append((target, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["target", "error"])

    return jobs.select("command").mapInPandas(run, "target string, error string")
