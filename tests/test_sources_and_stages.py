"""Files, stages, diarization, alignment and published history, with small files and fakes."""

import hashlib
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake import components
from voxlake.operators import alignment, clips, diarize, signal, summary
from voxlake.plans import runner
from voxlake.plans.manifest import Versions
from voxlake.sources import files, resolve, sinks


class Loud(components.Component):
    """Speech is what is loud; the vector of a clip is its level in two parts."""

    def detect(self, samples, rate):
        on = np.concatenate(([0], (np.abs(samples) > 0.01).astype(int), [0]))
        return [(a / rate, b / rate) for a, b in zip(np.flatnonzero(np.diff(on) > 0), np.flatnonzero(np.diff(on) < 0), strict=True)]

    def embed(self, samples, rate):
        return [float(np.mean(samples > 0.5)), float(np.mean(samples <= 0.5))]

    def transcribe(self, samples, rate, language):
        return language or "en", [(0.0, len(samples) / rate, "ab", [{"text": " ab", "start": 0.0, "end": 0.5, "prob": 0.9}])]

    def align(self, segments, samples, rate, language):
        return [(t, a, b, 1.0) for a, b, t in segments]


@pytest.fixture
def fakes(monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(components, "_registered", {})  # it travels to the workers, where other tests' fakes are unknown
    for kind in ("vad", "embedder", "transcriber", "aligner"):
        components.register(kind, "loud", Loud)
    modules = (sys.modules[__name__], components)
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    yield
    for m in modules:
        cloudpickle.unregister_pickle_by_value(m)


def test_mixed_inputs(spark, tmp_path):
    a, b = tmp_path / "One Film.mkv", tmp_path / "sub" / "two.wav"
    b.parent.mkdir()
    a.write_bytes(b"x" * 100), b.write_bytes(b"y" * 100)
    (tmp_path / "sub" / "notes.txt").write_text("no media"), (tmp_path / "sub" / ".hidden.wav").write_bytes(b"z")
    (tmp_path / "list.txt").write_text("# inputs\nOne Film.mkv hi\nhttps://youtu.be/abcdefghijk de\n")
    got = {r.source_id: r for r in files.resolve_inputs(spark, [str(tmp_path / "list.txt"), str(tmp_path / "sub"), str(a), "https://example.org/x.mp3"], "en").collect()}
    print_a = hashlib.sha1(b"100" + b"x" * 100).hexdigest()[:10]
    print_b = hashlib.sha1(b"100" + b"y" * 100).hexdigest()[:10]
    assert {k: (r.kind, r.language) for k, r in got.items() if not k.startswith("url-")} == {f"one-film-{print_a}": ("local", "hi"), f"two-{print_b}": ("local", "en"), "yt-abcdefghijk": ("url", "de")}
    assert len(got) == 4 and list(got) == sorted(got)
    with pytest.raises(FileNotFoundError):
        files.resolve_inputs(spark, [str(tmp_path / "nowhere.mkv")])


def test_fingerprints_read_head_and_tail(spark, tmp_path):
    part = 4 << 20
    rng = np.random.default_rng(0)
    for size in (10, part, 2 * part, 2 * part + 1, 3 * part + 5):
        data = rng.bytes(size)
        (tmp_path / "f").write_bytes(data)
        want = hashlib.sha1(str(size).encode() + data[:part] + (data[-part:] if size > 2 * part else b"")).hexdigest()
        assert files.file_fingerprint(str(tmp_path / "f")) == want
    paths = spark.createDataFrame([(str(tmp_path / "f"),)], "path string")
    assert files.content_hashes(paths).first().sha1 == hashlib.sha1(data).hexdigest()
    row = spark.read.format("binaryFile").load(str(tmp_path / "f")).select(resolve.fingerprint(F.col("content"), F.col("length")).alias("x")).first()
    assert row.x == want


def test_audio_info_and_chunked_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.uniform(-0.5, 0.5, 8000 * 5 + 123).astype(np.float32)
    src, dst = str(tmp_path / "a.wav"), str(tmp_path / "b.wav")
    signal.write_wav(src, x, 8000)
    clips.process_file(src, dst, lambda y, rate: y * 0.5, 1.0, 0.1)
    got, rate = signal.read_wav(dst)
    plain, _ = signal.read_wav(src)
    assert rate == 8000 and len(got) == len(x) and np.abs(got - plain * 0.5).max() < 1e-3
    whole = clips.process_chunked(plain, 8000, 1.0, 0.1, lambda y, rate: np.cumsum(y).astype(np.float32) / 100)
    clips.process_file(src, dst, lambda y, rate: np.cumsum(y).astype(np.float32) / 100, 1.0, 0.1)
    assert np.abs(signal.read_wav(dst)[0] - whole).max() < 1e-3
    with pytest.raises(ValueError):
        clips.process_file(src, dst, lambda y, rate: y, 0.2, 0.1)
    info = {r.path: r for r in files.audio_info(spark.createDataFrame([(src,), (str(tmp_path / "none.wav"),)], "path string")).collect()}
    assert (info[src].rate, info[src].channels, info[src].frames, info[src].error) == (8000, 1, len(x), None)
    assert info[str(tmp_path / "none.wav")].error.startswith("FileNotFoundError")


def test_playlists_keep_their_order():
    lists = {"p": [{"url": "a"}, {"url": "q", "entries": [{"url": "b"}, {"entries": [{"url": "c"}]}]}, {"url": "d"}, {"url": None}]}
    assert files.expand_playlist("p", lists.__getitem__) == ["a", "b", "c", "d"]


def test_a_given_stream_is_taken(spark):
    rows = [("s", 0, "eng", 2), ("s", 1, "fra", 6), ("t", 0, "eng", 2)]
    s = spark.createDataFrame(rows, "source_id string, index int, language string, channels int")
    s = s.withColumns({"title": F.lit(None).cast("string"), "is_default": F.lit(False), "is_commentary": F.lit(False), "is_audio_description": F.lit(False)})
    assert resolve.select_streams(s.where("source_id = 's'"), index=1).first().language == "fra"
    with pytest.raises(Exception, match="no audio stream 1 in t"):
        resolve.select_streams(s, index=1).collect()


def test_stages_go_on_where_they_stood(spark, tmp_path):
    sources = spark.createDataFrame([(f"s{i}",) for i in range(6)], "source_id string")

    def half(row):
        if row["source_id"] == "s3":
            raise ValueError("broken")
        return {"x": int(row["source_id"][1:]) * 2}

    def late():
        raise RuntimeError("no licence")

    stages = [runner.Stage("half", half, "x long"), runner.Stage("sum", lambda r: {"y": r["x"] + 1}, "y long", ("half",)), runner.Stage("never", lambda r: {"z": 1}, "z long", setup=late)]
    run = lambda s=stages, **k: {(r.stage, r.outcome): r.n for r in runner.run_stages(spark, sources, s, str(tmp_path), **k).collect() if r.n}
    assert run() == {("half", "done"): 5, ("half", "failed"): 1, ("sum", "done"): 5, ("sum", "blocked"): 1, ("never", "failed"): 6}
    assert {r.source_id: r.y for r in spark.read.parquet(f"{tmp_path}/sum").collect()} == {f"s{i}": 2 * i + 1 for i in range(6) if i != 3}
    errors = {r.source_id: r.error for r in runner.read_manifest(spark, str(tmp_path)).where("stage = 'half' AND status = 'failed'").collect()}
    assert errors == {"s3": "ValueError: broken"}
    mended = [runner.Stage("half", lambda r: {"x": 7}, "x long"), stages[1]]
    assert run(mended) == {("half", "done"): 1, ("half", "cached"): 5, ("sum", "done"): 1, ("sum", "cached"): 5}
    assert run(mended, force=["half"], until="half") == {("half", "done"): 6}
    assert run(mended, shard=(0, 2)).keys() == {("half", "cached"), ("sum", "cached")}
    changed = [mended[0], runner.Stage("sum", lambda r: {"y": 0}, "y long", ("half",), identity=2)]
    assert run(changed) == {("half", "cached"): 6, ("sum", "done"): 6}
    seen = files.catalogue(sources, {"half": spark.read.parquet(f"{tmp_path}/half"), "sum": spark.read.parquet(f"{tmp_path}/sum").where("source_id < 's2'")}).collect()
    assert [(r.source_id, r.half, r["sum"]) for r in seen] == [(f"s{i}", True, i < 2) for i in range(6)]


def test_artifacts_are_made_again(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.ensure(spark, f"{tmp_path}/t", make).count() == 3
    assert len(made) == 1


def brute_fold(rows, least):
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-12)
    total = {}
    for label, s, _ in rows:
        total[label] = total.get(label, 0) + s
    large = sorted(k for k, v in total.items() if v >= least)
    if not large:
        return [r[0] for r in rows]
    centers = [unit(np.mean([unit(v) for label, _, v in rows if label == k], axis=0)) for k in large]
    return [label if label in large else large[int(np.argmax([unit(v) @ c for c in centers]))] for label, _, v in rows]


def test_small_clusters_are_folded(spark):
    rng = np.random.default_rng(3)
    rows = [(s, i, int(rng.integers(0, 5)), 0.75, rng.normal(size=6).tolist()) for s in ("a", "b") for i in range(30)] + [("c", 0, 0, 0.75, [1.0] * 6)]
    out = diarize.fold_clusters(spark.createDataFrame(rows, "source_id string, i int, label int, seconds double, embedding array<double>"), ["source_id"], 5.0).collect()
    for s in "abc":
        mine = [r for r in rows if r[0] == s]
        assert [r.label for r in sorted((r for r in out if r.source_id == s), key=lambda r: r.i)] == brute_fold([r[2:] for r in mine], 5.0)


def test_diarization(spark, fakes):
    x = np.concatenate([np.full(4000, 0.9), np.zeros(500), np.full(4000, 0.2), np.zeros(500), np.full(3000, 0.9)]).tolist()
    recordings = spark.createDataFrame([("r", x, 1000)], "source_id string, samples array<double>, rate int")
    turns = diarize.diarize(recordings, ["source_id"], ("loud", {}), ("loud", {}), threshold=0.3, least=1.0).orderBy("start").collect()
    assert [(r.speaker, round(r.start, 2), round(r.end, 2)) for r in turns] == [("SPEAKER_00", 0.0, 4.0), ("SPEAKER_01", 4.5, 8.5), ("SPEAKER_00", 9.0, 12.0)]


def test_transcribers_and_aligners(spark, fakes):
    recordings = spark.createDataFrame([("r", [0.5] * 100, 100, None), ("q", [0.5] * 50, 100, "de")], "id string, samples array<double>, rate int, language string")
    segments = components.transcribed(recordings, "loud", ["id"])
    assert {(r.id, r.language, r.end, r.words[0].text) for r in segments.collect()} == {("r", "en", 1.0, " ab"), ("q", "de", 0.5, " ab")}
    assert {(r.id, r.text, r.end) for r in components.aligned(recordings, segments, "loud", ["id"]).collect()} == {("r", "ab", 1.0), ("q", "ab", 0.5)}


def test_alignment_widens_once():
    symbols = {"a": 1, "b": 2, "c": 3}
    spoken = {12: 1, 14: 2, 30: 3, 31: 1}  # frame of 0.1 s: symbol

    def emissions(a, b):
        out = np.full((round((b - a) * 10), 5), np.log(0.01))
        for k in range(len(out)):
            out[k, spoken.get(round(a * 10) + k, 0)] = np.log(0.9)
        return out

    segments = [(1.0, 2.0, "ab 7"), (2.9, 3.0, "ca"), (3.2, 3.25, "abcabcabcabcabcabcabcabcabc")]
    words, failed = alignment.align_segments(segments, 4.0, emissions, symbols.get, 0, 4, "en", pad=0.0)
    assert [(w, a, b) for w, a, b, _ in words] == [(" ab", 1.2, 1.5), (" ca", 3.0, 3.2)] and failed == 1
    assert words[0][3] == pytest.approx(0.9) and alignment.align_segments([(0.0, 4.0, "ab")], 4.0, emissions, symbols.get, 0, None, "ja")[0][0][0] == "ab"


def test_anchors(spark, fakes, tmp_path):
    for name, level in (("ann", 0.9), ("bob", 0.2)):
        (tmp_path / name).mkdir()
        for k in range(2):
            signal.write_wav(str(tmp_path / name / f"{k}.wav"), np.full(100, level), 100)
    (tmp_path / "empty").mkdir()
    found = files.load_anchors(spark, str(tmp_path), "loud")
    assert {k: v.round(6).tolist() for k, v in found.items()} == {"ann": [1.0, 0.0], "bob": [0.0, 1.0]}


def test_history_and_small_sinks(spark, tmp_path):
    target = Versions(spark, f"file://{tmp_path}/hub")
    assert target.history().isEmpty()
    for v, hours in ((1, 2.0), (2, 0.5)):
        target.publish(spark.range(v), v - 1)
        target.record(v, ["b", "a"], hours, 2.0 + (v - 1) * 0.5)
    assert [(r.version, r.sources, r.hours_added, r.total_hours) for r in target.history().collect()] == [(1, ["a", "b"], 2.0, 2.0), (2, ["a", "b"], 0.5, 2.5)]
    assert target.current() == 2 and target.read().count() == 2
    rows = [{"a": 'x "y"', "b": None}, {"a": "p,q", "b": 2, "c": 3}]
    assert sinks.csv_bytes(rows, ["a", "b"]) == b'a,b\n"x ""y""",\n"p,q",2\n'
    assert sinks.jsonl_bytes([{"a": "é", "b": None}]) == '{"a": "é", "b": null}\n'.encode()
    e = spark.createDataFrame([("s", "u", [1.0, 2.0])], "source_id string, segment_id string, embedding array<double>")
    sinks.write_embeddings(e, f"{tmp_path}/emb")
    back = spark.read.parquet(f"{tmp_path}/emb")
    assert dict(back.dtypes)["embedding"] == "array<float>" and back.first().embedding == [1.0, 2.0]


def test_hash_thresholds_match_a_sort(spark):
    hashes = sorted(hashlib.sha1(str(i).encode()).hexdigest() for i in range(500))
    frame = spark.createDataFrame([(h,) for h in hashes], "h string")
    for wanted in (1, 77, 499):
        end = summary.hash_threshold(frame, wanted, digits=1)
        assert sum(h < end for h in hashes) == wanted
