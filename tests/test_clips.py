"""Clips, windows, registry tables and the command line."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.__main__ import main
from voxlake.operators import clips, signal, vectors


def test_export(spark, tmp_path):
    t = np.arange(32000) / 16000
    signal.write_wav(str(tmp_path / "film.wav"), 0.3 * np.sin(2 * np.pi * 300 * t), 16000)
    jobs = spark.createDataFrame([(str(tmp_path / "film.wav"), 0.5, 1.5, "wavs/a.wav"), (str(tmp_path / "film.wav"), 0.5, 1.5, "wavs/a.wav"), ("/no/such", 0.0, 1.0, "wavs/b.wav")], "media string, start double, end double, path string")
    out = {r.path: r for r in clips.export_clips(jobs, str(tmp_path / "out"), 24000, partitions=2).collect()}
    assert out["wavs/a.wav"].seconds == pytest.approx(1.0, abs=1e-3) and out["wavs/b.wav"].error.startswith("FileNotFoundError")
    x, rate = signal.read_wav(str(tmp_path / "out/wavs/a.wav"))
    assert rate == 24000 and abs(np.abs(x).max() - 10 ** (-1 / 20)) < 0.02 and abs(x[0]) < 1e-3
    assert [p.name for p in (tmp_path / "out/wavs").iterdir()] == ["a.wav"]


def test_array_and_column_forms_agree(spark):
    x = [0.1 * k for k in range(-5, 6)]
    clip = F.array(*(F.lit(v) for v in x))
    for mode, db in (("peak", -3.0), ("rms", -20.0), ("none", 0.0)):
        got = spark.range(1).select(signal.normalize(signal.apply_fade(clip, 1000, 3.0), mode, db).alias("x")).first().x
        assert np.allclose(got, clips.shape(np.array(x), 1000, 3.0, mode, db), atol=1e-6)


def test_windows(spark):
    df = spark.createDataFrame([("a", [1.0] * 10 + [0.0] * 10), ("b", [0.5] * 3)], "id string, samples array<double>")
    got = [(r.id, r.window, r.at, len(r.samples)) for r in clips.clip_windows(df, 10, 0.5, 0.5, 0.01).collect()]
    assert sorted(got) == [("a", 0, 0.0, 5), ("a", 1, 0.5, 5), ("b", 0, 0.0, 3)]
    rows = spark.createDataFrame([("a", 10.0, 0.2, 0.1), ("a", 0.5, 0.9, 0.9), ("b", 0.4, 0.6, 0.3)], "id string, seconds double, speech double, music double")
    assert {r.id: (r.speech, r.music) for r in clips.window_metrics(rows, ["id"], ["speech"], ["music"]).collect()} == {"a": (0.2, 0.1), "b": (0.6, 0.3)}


def test_prefix_and_gaps(spark):
    s = spark.createDataFrame([("a", 0.0, 20.0), ("a", 30.0, 50.0), ("a", 60.0, 70.0)], "id string, start double, end double")
    assert sorted((r.start, r.end) for r in clips.speech_prefix(s, ["id"], 30.0).collect()) == [(0, 20), (30, 40)]
    w = spark.createDataFrame([("a", 0, 0.0, 1.0), ("a", 1, None, None), ("a", 2, 2.0, 3.0), ("a", 3, None, None)], "id string, ord long, start double, end double")
    assert [(r.start, r.end) for r in clips.fill_times(w, ["id"], "ord").orderBy("ord").collect()] == [(0, 1), (1, 2), (2, 3), (3, 3)]


def test_chunked_work_keeps_a_signal():
    rng = np.random.default_rng(0)
    for n in (0, 10, 4000, 4070, 12345):
        x = rng.uniform(-1, 1, n).astype(np.float32)
        assert np.allclose(clips.process_chunked(x, 1000, 1.0, 0.04, lambda y, _: y), x, atol=1e-6)
    with pytest.raises(ValueError):
        clips.process_chunked(np.zeros(9), 10, 1.0, 0.5, lambda y, _: y)


def test_command_line(spark, tmp_path, capsys):
    assert main(["init", str(tmp_path / "c.yaml")]) == 0 and "cluster_threshold" in (tmp_path / "c.yaml").read_text()
    assert main(["components"]) == 0 and "scorer.level" in capsys.readouterr().out
    assert main(["doctor"]) == 0
    m = spark.createDataFrame([("a", "fetch", "done"), ("b", "fetch", "failed")], "source_id string, stage string, status string").withColumn("error", F.lit("e"))
    m.write.parquet(str(tmp_path / "manifest"))
    assert main(["status", str(tmp_path), "--errors"]) == 1
    assert main(["build", str(tmp_path), "--set", "nope.x=1"]) == 2
    u = spark.createDataFrame([("s1", "1", 1, 3.0), ("s2", "2", 2, 4.0)], "source_id string, utt_id string, speaker_id long, duration double")
    u.write.parquet(str(tmp_path / "utterances"))
    u.select("source_id").write.parquet(str(tmp_path / "segments"))
    assert main(["push", str(tmp_path), str(tmp_path / "pub"), "--dry-run"]) == 0 and not (tmp_path / "pub").exists()
    assert main(["push", str(tmp_path), str(tmp_path / "pub")]) == 0 and spark.read.parquet(str(tmp_path / "pub/v1")).count() == 2
