"""Commands, table components and enhancers, with fakes in place of models."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from voxlake import components
from voxlake.sources import media


class HalfVad(components.Component):
    def detect(self, samples, rate):
        return [(0.0, len(samples) / rate / 2)]


class TwoVoices(components.Component):
    def diarize(self, samples, rate):
        half = len(samples) / rate / 2
        return [(0.0, half, "A"), (half, 2 * half, "B")]


class Gain(components.Component):
    @dataclass(frozen=True)
    class Params:
        by: float = 2.0

    def process(self, samples, rate):
        return np.append(samples * self.params.by, 9.0)


def test_commands(spark, tmp_path):
    s = spark.createDataFrame([("a", 0, 6, "5.1(side)"), ("b", 1, 2, "stereo"), ("c", 2, 3, None)], "src string, idx int, channels int, layout string")
    cmd = media.extract_command(F.col("src"), F.lit("/o.flac"), F.col("idx"), 44100, "center", F.col("channels"), F.col("layout"))
    got = {r.src: r.c for r in s.select("src", cmd.alias("c")).collect()}
    assert "pan=mono|c0=c2" in got["a"] and "pan=mono|c0=c2" not in got["b"] and "pan=mono|c0=c2" in got["c"] and got["b"][got["b"].index("-map") + 1] == "0:a:1"
    (tmp_path / "x").write_text("hello")
    jobs = spark.createDataFrame([(["cp", str(tmp_path / "x"), str(tmp_path / "y.txt")],), (["cp", "/no/such", str(tmp_path / "z.txt")],)], "command array<string>")
    out = {r.target.rsplit("/", 1)[1]: r.error for r in media.run_commands(jobs).collect()}
    assert out["y.txt"] is None and out["z.txt"].startswith("RuntimeError") and sorted(p.name for p in tmp_path.iterdir()) == ["x", "y.txt"]


def test_fakes(spark, monkeypatch):
    for kind, name, cls in (("vad", "half", HalfVad), ("diarizer", "two", TwoVoices), ("enhancer", "gain", Gain)):
        components.register(kind, name, cls)
    # workers import this module by name; fakes travel by value instead
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(components)
    clips = spark.createDataFrame([("k", [0.5] * 8, 4)], "id string, samples array<double>, rate int")
    assert [(r.id, r.start, r.end) for r in components.spans(clips, "vad", "half", ["id"]).collect()] == [("k", 0, 1)]
    assert [(r.start, r.end, r.speaker) for r in components.spans(clips, "diarizer", "two", ["id"]).orderBy("start").collect()] == [(0, 1, "A"), (1, 2, "B")]
    assert clips.select(components.processed(F.col("samples"), F.col("rate"), "gain", by=0.5).alias("x")).first().x == [0.25] * 8
    cloudpickle.unregister_pickle_by_value(components)
    cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
