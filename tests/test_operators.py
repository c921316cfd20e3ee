"""Operators on small hand-worked cases and against brute force."""

import hashlib
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxlake import components
from voxlake.functions import keys, text
from voxlake.operators import intervals, publish, rules, segments, signal, summary, vectors
from voxlake.operators.marks import Marks, mark
from voxlake.operators.references import assign_references
from voxlake.plans.manifest import MANIFEST, Versions, blocked, downstream, fingerprints, invalidate, isolate, pending
from voxlake.sources import resolve, sinks
from voxlake.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def spans(spark, rows, schema="source_id long, start double, end double"):
    return spark.createDataFrame(rows, schema)


def times(df):
    return sorted((r.start, r.end) for r in df.collect())


# -- text ----------------------------------------------------------------------------------


def test_text_measures(spark):
    assert one(spark, text.spoken_char_count(F.lit("नमस्ते दुनिया"))) == 12
    assert one(spark, text.repetition_ratio(F.lit("a b a b a b a b"), 2)) == pytest.approx(1 - 2 / 7)
    assert one(spark, text.repetition_ratio(F.lit("a b c"))) == 0
    assert one(spark, text.ends_sentence(F.lit('He said "yes."  '))) is True
    assert one(spark, text.ends_sentence(F.lit('yes. "'))) is False
    assert one(spark, text.ends_sentence(F.lit("ठीक है।"))) is True
    assert one(spark, text.ends_clause(F.lit("well,"))) is True
    assert one(spark, text.normalize_language(F.lit(" English"))) == "en"
    assert one(spark, text.container_language_tags(F.lit("fr_CA"))) == ["fr", "fr-ca", "fre"]
    assert one(spark, text.with_leading_space(F.lit("語"), F.lit("ja"))) == "語"
    assert one(spark, text.starts_lowercase(F.lit("“and"))) is True
    assert one(spark, text.tokenize(F.lit("Ça va, l'été!"))) == ["ça", "va", "lété"]


def test_keys(spark):
    import hashlib

    for n in (1, 7, 1000, 2**31):
        assert one(spark, keys.sha1_modulo(F.lit("abc"), F.lit(n))) == int(hashlib.sha1(b"abc").hexdigest(), 16) % n
    assert one(spark, keys.slugify(F.lit("  Films & Co. (2020) " + "x" * 60))) == "films-co-2020-" + "x" * 26
    assert one(spark, keys.series_of(F.lit("drama-ep01-3fa2c1d9e0"))) == "drama"
    assert one(spark, keys.source_of(F.lit("a:b:S1"))) == "a:b"
    assert keys.stable_hash({"b": 1, "a": 2}) == keys.stable_hash({"a": 2, "b": 1})


# -- intervals -----------------------------------------------------------------------------


def test_merging_overlaps_and_coverage_match_counting(spark):
    """Whole seconds, so that a set of seconds says what is covered, by whom."""
    rng = random.Random(4)
    turns = [(k, a := rng.randrange(80), a + rng.randrange(0, 9), rng.choice("XYZ")) for k in (1, 2) for _ in range(25)]
    t = spark.createDataFrame(turns, "source_id long, start long, end long, speaker string")
    seconds = lambda k, who: {x for s, a, b, w in turns if s == k and w in who for x in range(a, b)}

    def islands(found):
        found = sorted(found)
        starts = [x for i, x in enumerate(found) if i == 0 or found[i - 1] != x - 1]
        return [(x, next(y for y in range(x, 200) if y not in found)) for x in starts]

    for width in (None, 7, 1000):
        merged, shared = (f.collect() for f in (intervals.merge_spans(t, ["source_id"], bin_width=width), intervals.overlap_regions(t, ["source_id"], bin_width=width)))
        for k in (1, 2):
            assert sorted((r.start, r.end) for r in merged if r.source_id == k) == islands(seconds(k, "XYZ"))
            by = [seconds(k, w) for w in "XYZ"]
            assert sorted((r.start, r.end) for r in shared if r.source_id == k) == islands({x for x in range(100) if sum(x in s for s in by) > 1})
    items = spark.createDataFrame([(k, n, a := rng.randrange(80), a + n % 4) for k in (1, 2) for n in range(12)], "source_id long, id long, start long, end long")
    for r in intervals.coverage(items, t, ["source_id"], ["id"], 5).collect():
        assert r.covered == len(seconds(r.source_id, "XYZ") & set(range(r.start, r.end)))


def test_bins_change_nothing(spark):
    rng = random.Random(1)
    a = [(i % 3, i, x := rng.uniform(0, 100), x + rng.uniform(0, 9)) for i in range(300)]
    left = spark.createDataFrame(a, "source_id long, id long, start double, end double")
    right = spark.createDataFrame([(s, i, x, y) for s, i, x, y in a[::2]], "source_id long, other long, r_start double, r_end double")
    want = {(i, j) for s, i, x, y in a for t, j, u, v in a[::2] if s == t and u < y and x < v}
    for width in (0.7, 10.0, 1000.0):
        got = [(r.id, r.other) for r in intervals.overlap_join(left, right, ["source_id"], width).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_chunks_fit_and_leave_no_speech_out(spark):
    rng = random.Random(7)
    at, rows = 0.0, []
    for _ in range(60):
        at += rng.choice((0.2, 0.8, 3.0))
        rows.append((1, at, at := at + rng.uniform(0.5, 40)))
    s = spans(spark, rows)
    got, pieces = (times(f(s)) for f in (lambda x: intervals.group_spans(x, ["source_id"], 12, 1), lambda x: intervals.cut_spans(x, ["source_id"], 12)))
    assert all(b - a <= 12 + 1e-9 for a, b in got) and sum(b - a for a, b in pieces) == pytest.approx(sum(b - a for _, a, b in rows))
    of = [next(i for i, (a, b) in enumerate(got) if a <= x and y <= b) for x, y in pieces]
    assert of == sorted(of) and set(of) == set(range(len(got)))
    # no chunk could have taken the first piece of the next
    for i in range(len(got) - 1):
        first = pieces[of.index(i + 1)]
        assert first[1] - got[i][0] > 12 or first[0] - got[i][1] > 1


def test_ties_of_speakers(spark):
    w = spark.createDataFrame([(1, 0, 1.0, 2.0), (1, 1, 5.0, 5.0), (1, 2, 9.0, 9.5)], "source_id long, ord long, start double, end double")
    t = spark.createDataFrame([(1, "A", 0.0, 1.5, 0), (1, "B", 1.5, 3.0, 1), (1, "C", 5.2, 6.0, 2)], "source_id long, speaker string, start double, end double, ord long")
    got = {r.ord: r.speaker for r in intervals.assign_speakers(w, t, ["source_id"], ["ord"], 4.0, 0.3, 0.01).collect()}
    assert got == {0: "B", 1: "C", 2: None}


# -- rules, summaries, publishing ------------------------------------------------------------


def test_first_failure_and_cascade(spark):
    r = (rules.Rule("a", min=1, max=2.5), rules.Rule("b", max=0, on_missing="drop"))
    rows = [({"a": 0.5, "b": 0.0},), ({"a": 3.0, "b": 9.0},), ({"a": float("nan")},), ({"a": 1.0, "b": 0.0},)]
    got = [x.r for x in spark.createDataFrame(rows, "m map<string,double>").select(rules.first_failure(rules.of_map(F.col("m")), r).alias("r")).collect()]
    assert got == ["a_below_1", "a_above_2.5", "missing_b", None]
    assert one(spark, rules.language_allowed(F.lit("en-US"), ["en"])) and not one(spark, rules.language_allowed(F.lit(None).cast("string"), ["en"]))
    assert len(rules.TARGET_RULES) == 11 and len(rules.REFERENCE_RULES) == 10


def test_test_speakers(spark):
    s = spark.range(100).withColumnRenamed("id", "speaker_id")
    assert summary.choose_test_speakers(s, 0.1, 7).count() == 10
    assert summary.choose_test_speakers(s.limit(1), 0.5, 7).isEmpty() and summary.choose_test_speakers(s, 0, 7).isEmpty()


def test_plans_and_lineage(spark):
    f = lambda rows: spark.createDataFrame(rows, "path string, sha1 string")
    plan = publish.plan_paths(f([("a", ""), ("b", ""), ("c", ""), ("d", "")]).select("path"), f([("a", "1"), ("b", "2")]), f([("b", "2"), ("c", "3"), ("x", "9")]))
    assert {r.path: r.action for r in plan.collect()} == {"a": "upload", "b": "keep", "c": "keep", "d": "missing", "x": "delete"}
    with pytest.raises(ValueError, match="first is d"):
        publish.check_plan(plan)
    reg = lambda rows: spark.createDataFrame(rows, "speaker_id long, member string")
    mine = spark.createDataFrame([("s1",)], "source_id string")
    remote = reg([(1, "s1:A"), (1, "s2:A"), (2, "s3:B")])
    publish.check_lineage(remote, reg([(1, "s2:A"), (2, "s3:B")]), mine)
    with pytest.raises(ValueError):
        publish.check_lineage(remote, reg([(1, "s2:A")]), mine)
    with pytest.raises(ValueError):
        publish.check_lineage(remote, remote, mine, 5, 4)


def test_references_never_leak(spark):
    pool = spark.createDataFrame([("r1", 1, 7, "a", 0.0, 5.0, 9.0), ("r2", 2, 7, "a", 4.0, 9.0, 8.0), ("r3", 3, 7, "b", 0.0, 5.0, 1.0)], "ref_id string, parent_id long, speaker_id long, source_id string, start double, end double, m double")
    t = spark.createDataFrame([(1, 7, "a", 0.0, 5.0), (9, 7, "c", 0.0, 1.0), (8, 6, "c", 0.0, 1.0)], "segment_id long, speaker_id long, source_id string, start double, end double")
    order = [F.col("m").desc_nulls_last(), F.col("ref_id").asc()]
    assert {r.segment_id: r.ref_id for r in assign_references(t, pool, order, 1).collect()} == {1: "r3", 9: "r1"}
    alone = pool.where("ref_id <> 'r3'")
    assert {r.segment_id for r in assign_references(t, alone, order, 1).collect()} == {9}


@pytest.mark.parametrize("prefer", [True, False])
def test_references_match_brute_force(spark, prefer):
    """Speakers with one source and with several, references that overlap many targets."""
    rng = random.Random(17)
    pool = [(f"r{i}", i, rng.choice((1, 1, 1, 2)), "abc"[rng.randrange(3)] if i % 4 == 0 else "a", x := rng.uniform(0, 60), x + rng.uniform(0.5, 30), rng.random()) for i in range(60)]
    pool = [(r, p, who, s if who == 2 else "a", a, b, m) for r, p, who, s, a, b, m in pool]
    targets = [(i, rng.choice((1, 2)), rng.choice("aad"), x := rng.uniform(0, 60), x + rng.uniform(0.5, 30)) for i in range(20, 100)]
    got = {
        r.segment_id: r.ref_id
        for r in assign_references(
            spark.createDataFrame(targets, "segment_id long, speaker_id long, source_id string, start double, end double"),
            spark.createDataFrame(pool, "ref_id string, parent_id long, speaker_id long, source_id string, start double, end double, m double"), [F.col("m").desc(), F.col("ref_id").asc()], 3, prefer,
        ).collect()
    }
    want = {}
    for i, who, source, a, b in targets:
        valid = [(-m, r, s) for r, p, w, s, x, y, m in pool if w == who and p != i and not (s == source and x < b and a < y)]
        elsewhere = [v for v in valid if v[2] != source]
        best = sorted(elsewhere if prefer and elsewhere else valid)[:3]
        if best:
            want[i] = best[int(hashlib.sha1(str(i).encode()).hexdigest(), 16) % len(best)][1]
    assert got == want and len(want) > 30


# -- segments ------------------------------------------------------------------------------


def kernel(rows, turns, total=1000.0, **limits):
    w = pd.DataFrame(rows, columns=["text", "start", "end", "speaker"])
    w = w.assign(kind="word", overlapped=False, break_before=False)
    return segments.Kernel(w, pd.DataFrame(turns, columns=["speaker", "start", "end"]), total, segments.Limits(**limits))


def test_long_runs_are_split_at_sentences():
    k = kernel([(f" w{i}" + ("." if i == 19 else ""), float(i), i + 0.9, "A") for i in range(40)], [("A", 0.0, 40.0)])
    pieces = k.split(np.arange(40))
    assert pieces[0][-1] == 19 and all(k.end[p[-1]] - k.start[p[0]] <= 30 for p in pieces) and np.concatenate(pieces).tolist() == list(range(40))


def test_changes_move_to_the_sentence_end():
    rows = [(" rain", 5.0, 5.2, "K"), (" stops.", 5.2, 5.6, "K"), (" Then", 5.6, 5.9, "K"), (" we", 6.0, 6.2, "L"), (" walk", 6.2, 6.5, "L")]
    k = kernel(rows, [("K", 4.0, 5.95), ("L", 5.95, 7.0)])
    k.move_changes()
    assert k.speaker == ["K", "K", "L", "L", "L"]
    far = kernel([(" rain.", 1.0, 1.2, "K"), (" and", 1.5, 2.2, "K"), (" so", 2.2, 2.5, "L")], [("K", 0.0, 2.2), ("L", 2.2, 3.0)])
    far.move_changes()  # the sentence ends before the zone
    assert far.speaker == ["K", "K", "L"]


def test_moves_stay_between_neighbouring_changes():
    for seed in range(200):
        rng, at, rows = random.Random(seed), 0.0, []
        for _ in range(30):
            who = rng.choice(["K", "L", "M", None]) if not rows or rng.random() < 0.3 else rows[-1][3]
            at += rng.choice((0.0, 0.1, 0.7))
            rows.append((rng.choice((" a", " b.", " c,")), at, at := at + 0.2, who))
        turns = sorted((rng.choice("KLM"), x := rng.uniform(0, at), x + rng.uniform(0.2, 3)) for _ in range(6))
        k = kernel(rows, turns)
        before = list(k.speaker)
        k.move_changes()
        named = lambda x: [s is None for s in x]
        assert named(k.speaker) == named(before)  # words without a speaker keep none, and give none
        for i, s in enumerate(k.speaker):  # a word goes to a speaker whose stretch touched its own
            if s != before[i]:
                lo, hi = i, i
                while lo and before[lo - 1] == before[i]:
                    lo -= 1
                while hi + 1 < len(before) and before[hi + 1] == before[i]:
                    hi += 1
                assert s in k.speaker[max(0, lo - 1) : hi + 2]


def test_pads_stay_off_other_speakers():
    rows = [(f" a{i}", i * 0.5, i * 0.5 + 0.5, "A") for i in range(8)] + [(f" b{i}", 4.1 + i * 0.5, 4.6 + i * 0.5, "B") for i in range(8)]
    out = kernel(rows, [("A", 0.0, 4.0), ("B", 4.1, 8.1)], 9.0).segments()
    assert [s[0] for s in out] == ["A", "B"] and out[0][2] <= 4.1 and out[1][1] >= 4.0


def test_fragments_are_trimmed():
    texts = [" end", " of.", " A", " whole", " sentence.", " and", " more"]
    rows = [(t, i * 1.0, i + 0.8, "A") for i, t in enumerate(texts)]
    k = kernel([(" before", -2.0, -1.0, "B"), *rows, (" after", 7.0, 7.5, "B")], [("A", 0.0, 7.0)])
    piece, start, end = k.trim(np.arange(1, 8))
    assert [k.text[i] for i in piece] == [" A", " whole", " sentence."] and start and end


def test_events_lengthen_runs_but_never_open_them(spark):
    w = pd.DataFrame({"text": [" [x]", " hi", " [laugh]", " ho"], "start": [0.0, 1.0, 2.0, 3.4], "end": [0.5, 1.5, 3.0, 4.0], "speaker": "A", "kind": ["event", "word", "event", "word"], "overlapped": False, "break_before": False})
    k = segments.Kernel(w, pd.DataFrame(columns=["speaker", "start", "end"]), 9.0, segments.Limits(max_pause=0.6))
    assert [r[1].tolist() for r in k.runs()] == [[1, 2, 3]]


def test_excerpts(spark):
    words = [(f" w{i}" + ("." if i in (4, 9) else ""), i * 1.0, i + 0.8, "word") for i in range(15)]
    s = spark.createDataFrame([(1, 0.0, 15.0, True, words), (2, 0.0, 15.0, False, words)], "segment_id long, start double, end double, clean_start boolean, words array<struct<text:string,start:double,end:double,kind:string>>")
    got = {r.segment_id: (r.ref_start, r.ref_end) for r in segments.derive_excerpts(s, 4.0, 12.0).collect()}
    assert got == {1: (0.0, 9.92), 2: (4.88, 9.92)}


# -- vectors -------------------------------------------------------------------------------


def brute_linkage(x, threshold, linkage):
    e = vectors.unit_rows(x)
    d = 1 - e @ e.T
    groups = [[i] for i in range(len(x))]
    reduce = {"average": np.mean, "single": np.min, "complete": np.max}[linkage]
    while len(groups) > 1:
        best = min(((float(reduce(d[np.ix_(a, b)])), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        if best[0] > threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("linkage", ["average", "single", "complete"])
def test_agglomeration_matches_brute_force(linkage):
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 12, 25):
        x = rng.normal(size=(n, 5))
        labels = vectors.agglomerate(x, 0.5, linkage)
        got = {frozenset(np.flatnonzero(labels == k).tolist()) for k in set(labels.tolist())}
        assert got == (brute_linkage(x, 0.5, linkage) if n else set())
    assert len(set(vectors.agglomerate(rng.normal(size=(9, 4)), 0, linkage, clusters=3).tolist())) == 3


def test_medoid_resists_an_outlier():
    x = np.array([[1, 0.02], [1, -0.02], [1, 0], [0, 1.0]])
    center, sims = vectors.robust_centroid(x, np.array([3, 3, 3, 5.0]), 0.5)
    assert center[0] > 0.99 and sims[3] < 0.1


# -- signal --------------------------------------------------------------------------------


def test_signal_kernels(tmp_path):
    t = np.arange(44100) / 44100
    tone = np.sin(2 * np.pi * 440 * t).astype(np.float32) * 0.5
    low = signal.resample(tone, 44100, 24000)
    assert len(low) == 24000 and np.abs(low[200:-200] - 0.5 * np.sin(2 * np.pi * 440 * np.arange(24000) / 24000)[200:-200]).max() < 0.01
    signal.write_wav(str(tmp_path / "a.wav"), low, 24000)
    back, rate = signal.read_wav(str(tmp_path / "a.wav"), 0.25, 0.5)
    assert rate == 24000 and len(back) == 6000 and np.abs(back - low[6000:12000]).max() < 1e-3
    x = np.random.default_rng(0).uniform(-1, 1, 1050)
    edges = [0, 500, 1050]
    chunks = [x[max(0, a - 40) : min(1050, b + 40)] for a, b in zip(edges, edges[1:], strict=False)]
    assert np.allclose(signal.crossfaded(chunks, edges, 40, 1050), x)


def test_ctc_alignment():
    logs = np.full((8, 4), -8.0)
    for frame, token in enumerate([0, 1, 0, 0, 2, 3, 0, 0]):
        logs[frame, token] = -0.01
    assert signal.ctc_align(logs, [1, 2, 3], 0) == [1, 4, 5]
    assert signal.ctc_align(logs[:2], [1, 2, 3], 0) is None and signal.ctc_align(logs, [], 0) is None


def test_shaping(spark):
    clip = F.array(*(F.lit(float(x)) for x in (0.5, -0.5, 0.25, 0.0)))
    assert one(spark, signal.fit_length(clip, 6)) == [0.5, -0.5, 0.25, 0, 0, 0] and one(spark, signal.fit_length(clip, 2)) == [0.5, -0.5]
    assert max(map(abs, one(spark, signal.normalize(clip, "peak", 0.0)))) == pytest.approx(10 ** (-1 / 20))
    assert one(spark, signal.apply_fade(clip, 1000, 2)) == [0.0, -0.5, 0.25, 0.0]
    assert one(spark, signal.normalize(F.array(F.lit(0.0)), "rms", -3)) == [0.0]
    with pytest.raises(ValueError):
        signal.normalize(clip, "loud", 0)


# -- sources, sinks, manifest, components, streams ---------------------------------------------


def test_manifests_and_media(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# comment\nhttps://youtu.be/abcdefghijk hi\nclips/one.mp4\nmy file.mkv\n\n")
    rows = [(r.uri, r.language) for r in resolve.read_manifest(spark, str(tmp_path / "list.txt")).orderBy("pos").collect()]
    assert rows == [("https://youtu.be/abcdefghijk", "hi"), (f"{tmp_path}/clips/one.mp4", None), (f"{tmp_path}/my file.mkv", None)]
    (tmp_path / "m").mkdir()
    for n in ("a.MP4", ".b.mp4", "c.txt", "d.wav"):
        (tmp_path / "m" / n).write_bytes(b"x")
    assert {r.path.rsplit("/", 1)[1] for r in resolve.scan_media(spark, str(tmp_path / "m")).collect()} == {"a.MP4", "d.wav"}
    assert one(spark, resolve.youtube_video_id(F.lit("https://notyoutube.com/watch?v=abcdefghijk"))) is None
    assert one(spark, resolve.local_source_id(F.lit("/x/My Film.mkv"), F.lit("0123456789abcdef"))) == "my-film-0123456789"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "https://x", "", {"b": 1.0, "a": 2.0}, [("w", 0.0)]), ("s2", "/p", 'q"t', {}, [])], "source_id string, uri string, text string, metrics map<string,double>, words array<struct<text:string,start:double>>")
    out = sinks.shard_rows(rows)
    sinks.write_shards(out, f"{tmp_path}/shards")
    sinks.write_shards(out.where("source_id = 's1'").withColumn("text", F.lit("new")), f"{tmp_path}/shards")
    got = {r.source_id: r for r in spark.read.parquet(f"{tmp_path}/shards").collect()}
    assert got["s1"].text == "new" and got["s1"].metrics == '{"a":2.0,"b":1.0}' and got["s2"].source_url is None and got["s2"].text == 'q"t'
    sinks.write_csv(rows, f"{tmp_path}/csv", ["source_id", "text"])
    assert {tuple(r) for r in spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").collect()} == {("s1", None), ("s2", 'q"t')}
    sinks.write_jsonl(rows.select("source_id", F.lit(None).cast("string").alias("n")), f"{tmp_path}/jsonl")
    assert all("n" in json.loads(r.value) for r in spark.read.text(f"{tmp_path}/jsonl").collect())
    assert sinks.redacted({"hub": {"token": "abc", "name": "n"}, "k": [{"hf_token": "x"}]}) == {"hub": {"token": "***", "name": "n"}, "k": [{"hf_token": "***"}]}


def test_dataset_document(spark):
    rows = spark.createDataFrame([(1, "a", "train", "show-ep1", 3600.0, "en"), (2, "b", "test", "yt-x", 1800.0, None)], "speaker_id long, utt_id string, split string, source_id string, duration double, language string")
    reasons = spark.createDataFrame([("no_reference", 3)], "reason string, n long")
    doc = sinks.dataset_document(summary.totals(rows), summary.by_group(rows), reasons, {"token": "t"})
    assert json.loads(doc)["series"]["show"]["hours"] == 1 and '"***"' in doc and "1.5 hours" in sinks.card("x", doc)


def test_incremental_runs(spark, tmp_path):
    stages = {"fetch": ([], 1), "vad": (["fetch"], 1), "score": (["vad"], 1), "other": (["fetch"], 1)}
    a, b = fingerprints(stages), fingerprints({**stages, "vad": (["fetch"], 2)})
    assert {k for k in a if a[k] != b[k]} == {"vad", "score"} == downstream(stages, {"vad", "unknown"})
    src = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "source_id string")
    done = spark.createDataFrame([("s1", "fetch", "done", a["fetch"], None, None), ("s2", "fetch", "done", "old", None, None), ("s3", "fetch", "failed", a["fetch"], "e", None)], MANIFEST)
    assert {r[0] for r in pending(src, done, "fetch", a["fetch"]).collect()} == {"s2", "s3"}
    assert pending(src, done, "fetch", a["fetch"], src.where("source_id = 's2'")).count() == 3
    assert {r[0] for r in blocked(src, done, ["fetch"]).collect()} == {"s3"} and invalidate(done, {"fetch"}).isEmpty()

    def work(row):
        if row["source_id"] == "s2":
            raise ValueError("bad")
        return {"n": 1}

    assert {r.source_id: r.error for r in isolate(src, work, "source_id string, n long").collect()} == {"s1": None, "s2": "ValueError: bad", "s3": None}
    v = Versions(spark, f"file://{tmp_path}/v")
    assert v.publish(src, 0) == 1 and v.publish(src.limit(1), 1) == 2 and v.read().count() == 1 and v.read(1).count() == 3
    with pytest.raises(RuntimeError):
        v.publish(src, 1)


def test_components(spark):
    with pytest.raises(TypeError):
        components.create("scorer", "level", nope=1)
    with pytest.raises(KeyError):
        components.resolve("vad", "nope")
    with pytest.raises(ValueError):
        components.register("nope", "x", components.LevelScorer)
    components.register("embedder", "absent", "not_installed_package:Model")
    with pytest.raises(ImportError):
        components.resolve("embedder", "absent")
    clips = spark.createDataFrame([([0.5, -0.5], 8000), ([], 8000)], "samples array<double>, rate int")
    got = [r.metrics for r in components.score_all(clips, [("level", {})]).collect()]
    assert got == [{"level_db": round(10 * math.log10(0.25), 5)}, {}]
    route = lambda h, d: one(spark, components.route(F.lit(h).cast("string"), F.lit(d).cast("string"), "base", {"en": "fast", "hi-en": "mix"}))
    assert [route("hi-en", None), route("en-US", "hi"), route(None, "en"), route(None, "de")] == ["mix", "fast", "fast", "base"]


def test_streams(spark, tmp_path):
    schema = "source_id string, utt_id string, n long"
    source, target = tmp_path / "in", Versions(spark, f"file://{tmp_path}/out")
    for k, rows in enumerate(([("a", "1", 1), ("b", "1", 1)], [("a", "2", 2)])):
        spark.createDataFrame(rows, schema).write.mode("append").json(str(source))
        q = incremental.merge_stream(spark.readStream.schema(schema).json(str(source)), target, f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        assert target.current() == k + 1
    assert {tuple(r) for r in target.read().collect()} == {("a", "2", 2), ("b", "1", 1)}
    words = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:00:09")], "source_id string, at string").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(r.n_words for r in incremental.pause_sessions(words, ["source_id"], "at", "2 seconds", "1 minute").collect()) == [1, 2]


def test_missing_word_times_raise(spark):
    s = spark.createDataFrame([("a",), ("b",)], "source_id string")
    w = spark.createDataFrame([("a", 0.0), ("b", None)], "source_id string, start double")
    assert summary.require_words(s.where("source_id = 'a'"), w).count() == 1
    with pytest.raises(Exception, match="no word times in b"):
        summary.require_words(s, w).collect()


def test_segments_of_batches(spark):
    """Segments don't depend on where batches end, and the kernel runs once for segments and their words."""
    words = [(s, k, f" w{k}" + ("." if k % 9 == 8 else ""), k * 0.5, k * 0.5 + 0.4, "event" if k % 7 == 3 else "word", None if k % 5 == 0 else 0.5, None if k % 31 == 30 else "AB"[k // 20 % 2], False, False) for s in (1, 2, 3, 4) for k in range(30 * s)]
    w = spark.createDataFrame(words, "source_id long, ord long, text string, start double, end double, kind string, prob double, speaker string, overlapped boolean, break_before boolean")
    t = spark.createDataFrame([(s, "AB"[k % 2], k * 10.0, k * 10.0 + 9.9, k) for s in (1, 2, 3, 5) for k in range(6)], "source_id long, speaker string, start double, end double, ord long")
    totals = spark.createDataFrame([(s, 100.0) for s in (1, 2, 3, 6)], "source_id long, total double")
    built = segments.build_segments(w, t, totals, segments.Limits(min_duration=1.0, max_duration=6.0, preferred_min=3.0))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Pandas" not in plan and "Join" not in plan
    got = sorted(built.collect(), key=lambda r: r.segment_id)
    assert {r.source_id for r in got} == {1, 2, 3}  # source 4 has no length
    for r in got:
        assert [x.ord for x in r.words] == r.ords and r.num_words == sum(x.kind == "word" for x in r.words) and r.text == "".join(x.text for x in r.words if x.kind == "word").strip()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(built.collect(), key=lambda r: r.segment_id) == got
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_marks_match_interval_joins(spark):
    """Speakers, overlap and breaks found source by source are those of the joins: ties, nearest turns, equal and empty turns, none at all."""
    rng, words, turns, by = random.Random(3), [], [], Marks(per_second=100, least=1, max_distance=30, share=0.3, gap=30)
    for source in range(12):
        at = 0
        for k in range(60):
            at += rng.choice((0, 0, 10, 20, 30, 60, 90))
            words.append((source, k, f" w{k}" + rng.choice(("", "", ".")), at, at + rng.choice((0, 10, 20, 50)), rng.choice(("word", "word", "event")), 0.5))
            at += rng.choice((0, 10, 20))
        for k in range(source * 2):
            a = rng.randrange(0, at, 10)
            turns.append((source, rng.choice("ABCé"), a, a + rng.choice((0, 10, 50, 300)), None if k == 3 else k))
    w = spark.createDataFrame(words, "source_id long, ord long, text string, start long, end long, kind string, prob double").cache()
    t = spark.createDataFrame(turns, "source_id long, speaker string, start long, end long, ord long").cache()
    key, ids = ["source_id"], ["ord"]
    named = intervals.assign_speakers(w, t, key, ids, 400, 30, 1).cache()
    floor = named.withColumn("end", F.greatest("end", F.col("start") + 1))
    covered = intervals.coverage(floor, intervals.overlap_regions(t, key), key, ids, 400).select("source_id", "ord", (intervals.coverage_ratio() >= 0.3).alias("overlapped"))
    breaks = intervals.other_speaker_breaks(named, t, key, ids, 400, 30).withColumn("break_before", F.lit(True))
    marked = named.join(covered, [*key, *ids]).join(breaks, [*key, *ids], "left").withColumn("break_before", F.coalesce("break_before", F.lit(False))).cache()
    want = marked.orderBy("source_id", "ord").collect()
    got = []
    for source in range(12):
        of = sorted((x for x in turns if x[0] == source), key=lambda x: -1 if x[4] is None else x[4])
        start, end = (np.array([x[k] for x in words if x[0] == source], np.int64) for k in (3, 4))
        got += zip(*(list(x) for x in mark(start, end, (np.array([x[2] for x in of], np.int64), np.array([x[3] for x in of], np.int64), [x[1] for x in of]), by)), strict=True)
    assert got == [(r.speaker, r.overlapped, r.break_before) for r in want]
    assert {s for s, _, _ in got} == {None, *"ABCé"} and 9 < sum(o for _, o, _ in got) and 9 < sum(b for _, _, b in got)
    limits = segments.Limits(min_duration=0.2, max_duration=3.0, preferred_min=1.5)
    seconds = lambda df: df.withColumns({c: F.col(c) / 100 for c in ("start", "end")})
    joined = segments.build_segments(seconds(marked), seconds(t), seconds(w).groupBy("source_id").agg((F.max("end") + 1).alias("total")), limits)
    inline = segments.build_segments(w, t, None, limits, by)
    rows = [sorted(map(repr, df.collect())) for df in (inline, joined)]
    assert rows[0] == rows[1] and len(rows[0]) > 30 and "Join" not in inline._jdf.queryExecution().executedPlan().toString()


def test_work_on_a_run_grows_with_its_words():
    """A run of one speaker is cut as by looking at all of its rest each time, but looks no further than a piece reaches."""
    rng, n = random.Random(5), 3000
    starts = np.cumsum([rng.choice((0.1, 0.4, 0.9)) for _ in range(n)])
    k = kernel([(" w" + rng.choice(("", "", ",", ".")), a, a + rng.choice((0.1, 0.5, 3.0, 40.0 if rng.random() < 0.02 else 0.2)), "A") for a in starts.tolist()], [("A", 0.0, 4000.0)])
    run, want, at = np.arange(n), [], 0
    natural = 3.0 * k.sentence[:-1] + 1.0 * k.clause[:-1] + 2.0 * np.minimum(np.maximum(k.start[1:] - k.end[:-1], 0.0), 1.0)
    while at < n:
        if k.end[-1] - k.start[at] <= 30:
            want.append(run[at:].tolist())
            break
        length = k.end[at:-1] - k.start[at]
        fits = np.logical_and.accumulate(length <= 30)
        score = np.where(fits, natural[at:] + 2.0 * (length >= 15) + length / 30, -np.inf)
        cut = at + 1 + (int(np.argmax(score)) if fits.any() else 0)
        want.append(run[at:cut].tolist())
        at = cut

    class Seen(np.ndarray):
        taken = 0

        def __getitem__(self, i):
            out = super().__getitem__(i)
            Seen.taken += np.size(out) if isinstance(i, slice) else 0
            return out

    k.end = k.end.view(Seen)
    assert [p.tolist() for p in k.split(run)] == want and len(want) > 50 and Seen.taken < 20 * n


def test_local_speakers_of_batches(spark):
    """Every label of a source, also none, is one group whatever the batches; its kernel runs once for both results."""
    rows = [(s * 100 + k, s, None if s == 2 and k % 2 else "AB"[k % 2], 1.0 + k, [float(k % 2), 1.0 - k % 2, 0.01 * (k % 5)]) for s in range(4) for k in range(8 * s)]
    df = spark.createDataFrame(rows, "segment_id long, source_id long, label string, duration double, embedding array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        sims, speakers = vectors.local_speakers(df, 0.45, 20.0)
        sims, speakers = {r.segment_id: r.speaker_similarity for r in sims.collect()}, {(r.source_id, r.label): r for r in speakers.collect()}
        plan = vectors.local_speakers(df, 0.45, 20.0)[1]._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in plan and "Arrow" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = {(s, lab) for _, s, lab, *_ in rows}
    assert set(speakers) == groups and len(sims) == len(rows)
    for s, lab in groups:
        own = [r for r in rows if r[1:3] == (s, lab)]
        center, near = vectors.robust_centroid(np.array([r[4] for r in own], np.float32), [r[3] for r in own], 0.45)
        assert speakers[s, lab].centroid == pytest.approx(center) and speakers[s, lab].duration == sum(r[3] for r in own) and speakers[s, lab].kept == (speakers[s, lab].duration >= 20)
        assert [sims[r[0]] for r in own] == pytest.approx(near.round(5))


def test_references_past_what_overlaps(spark, monkeypatch):
    """Targets that overlap the best hundred references of their speaker find the next ones, and only those look that far."""
    from voxlake.operators import references

    pool = [(f"r{i:04d}", -i, 1, "a", 10.0, 11.0, 1000.0 - i) if i < 100 else (f"r{i:04d}", -i, 1, "a", 50.0 + i, 51.0 + i, 1000.0 - i) for i in range(400)]
    targets = [(1, 1, "a", 10.5, 12.0)] + [(i, 1, "a", 20.0, 21.0) for i in range(2, 400)]
    sizes, keep = [], references.stored
    monkeypatch.setattr(references, "stored", lambda df: (out := keep(df), sizes.append((df.columns, out.count())))[0])
    got = references.assign_references(
        spark.createDataFrame(targets, "segment_id long, speaker_id long, source_id string, start double, end double"),
        spark.createDataFrame(pool, "ref_id string, parent_id long, speaker_id long, source_id string, start double, end double, m double"), [F.col("m").desc(), F.col("ref_id").asc()], 3,
    ).collect()
    chosen = {r.segment_id: r.ref_id for r in got}
    assert len(chosen) == 399 and chosen[1] in {"r0100", "r0101", "r0102"} and {v for k, v in chosen.items() if k > 1} == {"r0000", "r0001", "r0002"}
    assert [n for columns, n in sizes if "_size" in columns] == [399, 1, 1, 0]  # targets that look: at 6, 48 and 384 places


def test_metric_columns_measure_once(spark, monkeypatch):
    """The metrics are computed once for their keys and columns; words of a text are those of its parts."""
    from voxlake.plans import corpus_queries as cq

    kept, keep = [], cq.stored
    monkeypatch.setattr(cq, "stored", lambda df: kept.append(df.columns) or keep(df))
    plan = cq.f8_metric_columns(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert kept == [["doc_id", "metrics"]] and "regexp_replace" not in plan
    odd = ["ΟΔΟΣ. ΣΑΣ-Σ", " a b C\u0085d​e ", "x́y_z", "--", "", "İI ß\tk", "a.Σ b", "\x1c1\x1f2"]
    old = lambda t: F.filter(F.transform(F.split(t, r"(?U)\s+"), lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{M}\p{N}]", ""))), lambda w: w != "")
    for r in spark.createDataFrame([(t,) for t in odd], "t string").select(text.tokenize(F.col("t")).alias("new"), old(F.col("t")).alias("old")).collect():
        assert r.new == r.old
