"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxlake.llm import components, decontamination, fixity, licenses, line_rules, mixing, neardup, ngram_lm, perspectives, registry, sharding, toxicity
from voxlake.llm.common import Scratch, WordHashes, words_of
from voxlake.llm.elias_fano import EliasFano, pack, unpack

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="test tables aren't there")


def words(rng, n, vocabulary=500):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# -- Elias-Fano ----------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=300), st.lists(st.integers(0, 2**62), max_size=50))
def test_elias_fano_round_trip(values, asked):
    v = np.unique(np.array(values, np.uint64))
    e = EliasFano.from_arrays(*unpack(np.frombuffer(pack(EliasFano.of(v).arrays()), np.uint8)))
    if len(v):
        assert (e.get(np.arange(len(v))) == v).all()
    q = np.array([*asked, *v.tolist()], np.uint64)
    place, same = e.successor(q)
    assert (place == np.searchsorted(v, q)).all() and (same == np.isin(q, v)).all()


def test_elias_fano_dense_runs():
    v = np.concatenate([np.arange(5000, dtype=np.uint64), np.arange(10, dtype=np.uint64) * np.uint64(10**15) + np.uint64(10**16)])
    place, same = EliasFano.of(v).successor(v)
    assert same.all() and (place == np.arange(len(v))).all()


# -- near duplicates -----------------------------------------------------------------------


def brute_components(texts, n, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(zip(*(w[k:] for k in range(n)), strict=False)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    label = {i: i for i in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, n, percent):
    """Groups with copies at all distances, one large, so that stars, small buckets and blocks all have work."""
    monkeypatch.setattr(neardup, "BLOCK", 32)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 2000)
    rng = random.Random(n)
    texts = {}
    for group, size in enumerate((150, 12, 12, 6)):
        base = words(rng, 120)
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 6, 8))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(w) + ("" if group else " tail")
    for _ in range(40):
        texts[len(texts)] = " ".join(words(rng, rng.randrange(0, 30)))
    want, sizes = brute_components(texts, n, percent)
    out = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), n, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert {r["doc_id"]: r["n_shingles"] for r in out} == sizes


@pytest.mark.parametrize("turned", [False, True])
def test_rows_that_share_an_id_lose_no_link(spark, turned):
    rng = random.Random(21)
    a, b, c = ([*words(rng, 60)] for _ in range(3))
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join([*a[:-1], "x"])), (9, " ".join([*b[:-1], "y"])), (3, " ".join(c)), (11, " ".join([*c[:-1], "z"])), (11, "alone " * 3 + "again")]
    out = neardup.near_duplicates(spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").coalesce(1), 3, 85).collect()
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(5, 5), (7, 5), (9, 5), (3, 3), (11, 3)}


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    limit = neardup.most_differing_bits(0.85)
    near = far = 0
    for _ in range(100):
        base = rng.integers(0, 2**63, 400, dtype=np.uint64)
        for share, keep in ((0.08, True), (0.6, False)):
            other = base.copy()
            other[: int(400 * share)] = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            a, b = (neardup.odd_sketch(neardup.min_hashes(np.unique(x))) for x in (base, other))
            passed = int(np.bitwise_count(a ^ b).sum()) <= limit
            near += passed and keep
            far += passed and not keep
    assert near == 100 and far <= 5


def test_block_links_are_exact():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**62, 300))
    rows = [(i, i, np.unique(np.concatenate([base[i * 3 :], rng.integers(0, 2**62, i * 2)]))) for i in range(30)]
    got = {(a, b) for a, b in neardup.block_links(rows[:10], rows[10:], 85)}
    want = {(a, b) for a, _, x in rows[:10] for b, _, y in rows[10:] if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))}
    assert got == want and want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(1000, 1001)], "a long, b long")
    out = {r["node"]: r["label"] for r in components.connected_components(links, Scratch(spark, "cc"), "t").collect()}
    assert {out[i] for i in range(1, 201)} == {1} and out[1001] == 1000


# -- mixing and sharding -------------------------------------------------------------------


def test_targets_stop_at_twice_the_source():
    t = mixing.source_targets({"a": 10, "b": 1000, "c": 500, None: 200})
    assert t["a"] == 20 and math.isclose(sum(t.values()), 1.5 * 1710)
    assert all(t[s] <= 2 * n + 1e-9 for s, n in {"a": 10, "b": 1000, "c": 500, None: 200}.items())


def test_mix_comes_near_its_targets_and_repeats(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("aaab") if i % 9 else None, " ".join(words(rng, rng.choice((5, 20, 40, 3000 if i % 50 == 0 else 80))))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    runs = []
    for parts in (1, 5):
        keyed = mixing.keyed_documents(docs.repartition(parts))
        runs.append(sorted((r["doc_id"], r["copies"]) for r in mixing.copies_taken(keyed, mixing.plan_mix(keyed)).collect()))
    assert runs[0] == runs[1]
    size = {i: len(t.split()) for i, _, t in rows}
    total = collections.Counter()
    for i, s, t in rows:
        total[s] += len(t.split())
    taken = collections.Counter()
    for i, copies in runs[0]:
        taken[rows[i][1]] += copies * size[i]
    for s, goal in mixing.source_targets(dict(total)).items():
        assert abs(taken[s] - goal) <= 0.01 * goal
    assert mixing.mix_documents(docs).count() == sum(c for _, c in runs[0])


def test_shards_are_even_and_the_map_is_versioned(spark, tmp_path):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, "x" * rng.choice((10, 100, 1000, 8000))) for i in range(4000)], "doc_id long, text string")
    path = f"file://{tmp_path}/map"
    out, slots = sharding.shard_records(docs, 24, map_path=path)
    sizes = [r["n"] for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 0.02 * max(sizes)
    slot_bytes, _ = sharding.slot_totals(out.select("virtual_slot", "size"))
    bigger = sharding.grow(slots, slot_bytes)
    assert all(a == b or b == 24 for a, b in zip(slots.shards, bigger.shards, strict=True)) and 24 in bigger.shards
    slot_bytes[7] += 500_000
    again = sharding.rebalance(bigger, slot_bytes)
    load = collections.Counter()
    for s, d in enumerate(again.shards):
        load[d] += slot_bytes[s]
    assert max(load.values()) <= max(slot_bytes[7] + 10_000, 1.05 * sum(slot_bytes) / 25)
    fewer = sharding.rebalance(again, slot_bytes, 20)
    assert max(fewer.shards) < 20 and fewer.version == 4
    for m in (bigger, again):
        m.save(spark, path)
    assert sharding.load_map(spark, path).shards == again.shards and sharding.load_map(spark, path, 1).shards == slots.shards


def test_a_grown_corpus_moves_few_slots(spark, tmp_path):
    rng = random.Random(15)
    rows = [(i, "x" * rng.choice((10, 100, 1000))) for i in range(6000)]
    path = f"file://{tmp_path}/map"
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    first = {r["doc_id"]: r["shard"] for r in sharding.shard_records(frame(rows), 8, map_path=path)[0].collect()}
    again, slots = sharding.shard_records(frame(rows), 8, map_path=path)
    assert slots.version == 1 and {r["doc_id"]: r["shard"] for r in again.collect()} == first
    grown, slots = sharding.shard_records(frame(rows + [(6000 + i, "y" * 3000) for i in range(60)]), 9, map_path=path)
    after = {r["doc_id"]: r["shard"] for r in grown.collect()}
    assert slots.version == 2 and 8 in after.values() and sum(after[i] != s for i, s in first.items()) < 0.25 * len(first)


@needs_data
def test_op5_matches_brute_force(spark):
    """Every column but the choice of shards, which the law binds: sizes near equal, places gapless, equal slots together."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = registry.queries()["op5_virtual_slots"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    load, places, home = collections.Counter(), collections.defaultdict(list), {}
    for r in out:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        assert home.setdefault(r["virtual_slot"], r["shard"]) == r["shard"] and 0 <= r["virtual_slot"] < sharding.N_SLOTS
    assert set(load) <= set(range(24)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    # longest-first placement of the slots by brute force reaches no better balance
    slot_bytes = collections.Counter()
    for r in out:
        slot_bytes[r["virtual_slot"]] += r["size"]
    bins = [0] * 24
    for n in sorted(slot_bytes.values(), reverse=True):
        bins[bins.index(min(bins))] += n
    assert sorted(load[s] for s in range(24)) == sorted(bins)


# -- decontamination -----------------------------------------------------------------------


def brute_alignment(item, text):
    best, row = 0, [0] * (len(text) + 1)
    for a in item:
        new = [0]
        for j, b in enumerate(text, 1):
            new.append(max(0, row[j - 1] + (decontamination.MATCH if a == b else decontamination.MISMATCH), row[j] - decontamination.GAP, new[-1] - decontamination.GAP))
        row = new
        best = max(best, *row)
    return best


def test_alignment_matches_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        assert decontamination.align(np.array(a), np.array(b))[0] == brute_alignment(a, b)


def test_exact_and_edited_leaks_are_found(spark):
    rng = random.Random(4)
    common = words(rng, 6)
    items = {i: words(rng, 30, 50_000) + common for i in range(12)}
    rows, want = [], set()
    for i in range(400):
        w = words(rng, 150, 50_000) + common
        if i < 120:
            item = list(items[i % 12])
            for _ in range(0 if i < 60 else 6):
                k = rng.randrange(len(item))
                item[k : k + 1] = rng.choice(([], [f"e{k}"], [f"e{k}", f"f{k}"]))
            at = rng.randrange(len(w))
            w[at:at] = item
            want.add((i, i % 12))
        rows.append((i, " ".join(w).title()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    for block in (1 << 20, 400):  # one block, and several
        found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_contamination(docs, bench, block_bytes=block).collect()}
        assert found == want


@pytest.mark.parametrize("edit", ["every4", "every3", "random", "inserted", "left out"])
def test_seeds_lose_no_alignment(edit):
    """Whatever full Smith-Waterman accepts is found, at edits that leave few words in a row."""
    rng = random.Random(edit)
    found = accepted = 0
    for size in (8, 14, 30, 60):
        for _ in range(25):
            item = words(rng, size, 5000)
            text = {
                "every4": lambda i: [w if k % 4 else f"e{k}" for k, w in enumerate(i)],
                "every3": lambda i: [w if k % 3 else f"e{k}" for k, w in enumerate(i)],
                "random": lambda i: [w if rng.random() > 0.28 else f"e{k}" for k, w in enumerate(i)],
                "inserted": lambda i: [x for k, w in enumerate(i) for x in ((w, f"i{k}") if k % 3 == 2 else (w,))],
                "left out": lambda i: [w for k, w in enumerate(i) if k % 4 != 3],
            }[edit](item)
            text = words(rng, 70) + text + words(rng, 70)
            hashes = WordHashes()
            block = decontamination.Block([(0, " ".join(item))])
            w = hashes.of(words_of(" ".join(text)))
            if brute_alignment(block.words[0].tolist(), w.tolist()) >= decontamination.least_score(block.words[0], 0.5):
                accepted += 1
                found += bool(decontamination.matches(block, w, 0.5))
    assert accepted >= 50 and found >= 0.9 * accepted
    assert edit == "random" or found == accepted


def test_short_items_and_passages_of_long_ones(spark):
    rng = random.Random(16)
    long = words(rng, 400, 50_000)
    rows = [(0, words(rng, 40) + long[100:130] + words(rng, 40)), (1, words(rng, 40) + long[100:115]), (2, [*words(rng, 5), "alpha", "beta", *words(rng, 5)]), (3, ["beta", "alpha"])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    items = spark.createDataFrame([(0, " ".join(long)), (1, "Alpha beta"), (2, "gamma")], "item_id long, text string")
    for size in (1 << 20, 1000):
        assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_contamination(docs, items, block_bytes=size).collect()} == {(0, 0), (2, 1)}
        assert {r["doc_id"] for r in decontamination.remove_contaminated(docs, items, block_bytes=size).collect()} == {1, 3}


@needs_data
def test_op1_matches_brute_force(spark):
    """Every document against every item by full alignment, without seeds."""
    hashes = WordHashes()
    items = {r["item_id"]: hashes.of(words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: hashes.of(words_of(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, w in items.items() if len(t) and decontamination.align(w, t)[0] >= decontamination.least_score(w, 0.5)}
    got = {(r["doc_id"], r["item_id"]) for r in registry.queries()["op1_seeded_alignment"](spark, SF).collect()}
    assert got == want and want


# -- language model ------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**62), max_size=50), max_size=4))
def test_blocks_round_trip(arrays):
    out = ngram_lm.decode(ngram_lm.encode(*(np.array(a, np.int64) for a in arrays)))
    assert [x.tolist() for x in out] == arrays


def exact_scores(train, texts, dirichlet=ngram_lm.DIRICHLET):
    """n_tokens, n_known, base and score of each text by plain counting."""
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    c, b, t3 = collections.Counter(), collections.Counter(), collections.Counter()
    for t in train:
        w = tokens(t)
        c.update(w)
        b.update(zip([b"", *w], w, strict=False))
        t3.update(zip([b"", *w], w, w[1:], strict=False))
    n, v, (k, m) = sum(c.values()), len(c), dirichlet
    out = []
    for t in texts:
        w = tokens(t)
        p1 = [(c[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        p2 = [(b[h, x] + k * p) / (c[h] + k) for h, x, p in zip([b"", *w], w, p1, strict=False)]
        p3 = [(t3[g, h, x] + m * p) / (b[g, h] + m) for g, h, x, p in zip([b"", *w], w, w[1:], p2[1:], strict=False)]
        out.append((len(w), sum(c[x] > 0 for x in w), sum(map(math.log10, p1)), sum(map(math.log10, p2[:1] + p3))))
    return out


@pytest.mark.parametrize("segment", [10**6, 500])  # and with many segments, contexts of their own, and batches
def test_scores_match_brute_force(spark, monkeypatch, segment):
    if segment == 500:
        for name in ("SEGMENT_TOKENS", "WORD_SEGMENT_TOKENS", "BATCH_TOKENS"):
            monkeypatch.setattr(ngram_lm, name, segment)
    rng = random.Random(6)
    texts = [" ".join(x for w in words(rng, rng.randrange(0, 60), 200) for x in ((w, "the", "end") if rng.random() < 0.3 else (w,))).upper() for _ in range(300)]
    train, held = texts[:250], [*texts[250:], "never seen words", "", None]
    rows = [(i, True, t) for i, t in enumerate(train)] + [(1000 + i, False, t) for i, t in enumerate(held)]
    out, model = ngram_lm.train_and_score(spark.createDataFrame(rows, "doc_id long, train boolean, text string"), Scratch(spark, "lm-test"))
    got = {r["doc_id"]: r for r in out.collect()}
    want = dict(zip((r[0] for r in rows), exact_scores(train, [r[2] for r in rows]), strict=True))
    assert got.keys() == want.keys()
    for i, (n, known, base, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known) and math.isclose(r["base_score"], base, rel_tol=1e-12)
        assert abs(r["score"] - score) <= 0.5 * ngram_lm.LOWEST / ngram_lm.CODES * n + 1e-9
    if segment == 500:
        assert model.bigrams.hot and model.trigrams.hot and len(model.trigrams.segments) > 20
    later = ngram_lm.score_documents(spark.createDataFrame([(r[0], r[2]) for r in rows[200:]], "doc_id long, text string"), model, Scratch(spark, "lm-later"))
    assert {r["doc_id"]: r for r in later.collect()} == {i: r for i, r in got.items() if i >= 200}


@needs_data
def test_op9_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    want = dict(zip(texts, exact_scores([t for i, t in texts.items() if i not in held], texts.values()), strict=True))
    out = registry.queries()["op9_elias_fano_lm"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        n, known, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (r["doc_id"] in held, n, known)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and abs(r["score"] - score) <= 0.024 * n


# -- toxicity ------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    rng = random.Random(9)
    insults = ("idiot", "moron", "worthless", "pathetic", "scumbag")
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        w = words(rng, rng.randrange(10, 120), 3000)
        for _ in range(max(2, len(w) // 12) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    out = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    assert sum(out[i]["predicted"] == labels[i][2] for i in held) >= 0.95 * len(held)
    assert all((out[i]["score"] >= 0.5) == (out[i]["predicted"] == 1) for i in out)


# -- fixity, licences, quality ---------------------------------------------------------------


def test_corruption_is_located(spark):
    rng = random.Random(12)
    rows = {f"r{i}": (f"{i:064x}", 100 + i % 7, 1 + (i % 50 == 0)) for i in range(3000)}
    other = dict(rows)
    for i in (5, 701):
        other[f"r{i}"] = ("f" * 64, rows[f"r{i}"][1] + i % 2, 1)
    del other["r700"], other["r2999"]
    other["r100"] = (*rows["r100"][:2], 1)  # one of two copies
    other["new"] = ("e" * 64, 77, 1)
    records = [(r, k, int(k[1:]) if k != "new" else -1, n, d) for r, part in (("a", rows), ("b", other)) for k, (d, n, copies) in part.items() for _ in range(copies)]
    rng.shuffle(records)
    leaves = Scratch(spark, "fx").save(fixity.lay_out(spark.createDataFrame(records, "replica string, record_id string, page_id long, length long, digest string"), 8), "leaves")
    place = {r["record_id"]: r for r in leaves.where("replica = 'a'").collect()}
    for file in range(8):  # ranges follow one another without gaps
        at = 0
        for r in sorted((r for r in place.values() if r["file"] == file), key=lambda r: r["lo"]):
            assert r["lo"] == at
            at = r["hi"]
    archive = fixity.Archive(leaves, Scratch(spark, "fx"))
    found = {r["record_id"]: r for r in archive.mismatches("a", "b").collect()}
    assert {k: r["status"] for k, r in found.items()} == {"r5": "changed", "r701": "changed", "r700": "lost", "r2999": "lost", "r100": "lost", "new": "extra"}
    assert all((r["offset_from"], r["offset_to"]) == (place[k]["lo"], place[k]["hi"]) for k, r in found.items() if k != "new")
    assert found["r100"]["lost_copies"] == 1 and archive.root("a") != archive.root("b")
    assert archive.mismatches("a", "a", "same").isEmpty()
    # a lost record changes the nodes on its path and no others, although later offsets move
    for k, level in enumerate(archive.levels[: archive.digits]):
        d = [{(r["scope"], r["node"]): r["digest"] for r in level.where(F.col("replica") == x).collect()} for x in "ab"]
        assert 0 < sum(d[0].get(n) != d[1].get(n) for n in d[0].keys() | d[1].keys()) <= 6


def test_equivalent_licences_share_a_digest(spark):
    mit = licenses.KNOWN[0][1]
    rows = [(1, mit), (2, "Copyright (c) 2020 Ann\n\n" + mit.replace("sublicense", "Sublicence").replace(",", " ,").upper()), (3, mit + " and more"), (4, "prose\nReleased  under the MIT licence!\nmore prose")]
    out = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i]["license_id"] for i in (1, 2, 3, 4)] == ["MIT", "MIT", None, None]
    assert out[4]["notices"] == ["MIT"] and out[3]["notices"] == []
    own = spark.createDataFrame([("X-1", "prose of one's own")], "license_id string, text string")
    assert licenses.scan_licenses(spark.createDataFrame([(1, "Prose of one's, own.")], "doc_id long, text string"), own).first()["license_id"] == "X-1"


def test_boilerplate_documents_are_rejected(spark):
    rng = random.Random(1)
    menu = "home about contact terms privacy login search help news and weather"
    rows = [(i, "h", f"{menu}\n" + " ".join(words(rng, 3, 10**6))) for i in range(30)] + [(100 + i, "h", " ".join(words(rng, 40, 10**6))) for i in range(20)]
    rows += [(200 + i, "h", "the very same text of twelve words in all of its copies") for i in range(40)] + [(300, "other", f"{menu}\n" + " ".join(words(rng, 3, 10**6)))]
    out = {r["doc_id"]: r["kept"] for r in line_rules.score_documents(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not any(out[i] for i in range(30)) and all(out[i] for i in range(100, 120)) and all(out[i] for i in range(200, 240)) and out[300]


def brute_repeats(w, n=5):
    at = collections.defaultdict(list)
    for i in range(len(w) - n + 1):
        at[tuple(w[i : i + n])].append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(n)})


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words(w):
    assert line_rules.repeated_words(w) == brute_repeats(w)


# -- perspectives --------------------------------------------------------------------------


def brute_rotation(turns):
    out = {}
    dialogues = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        dialogues[conv].append((turn is not None, turn or 0, role or "unknown", text or ""))
    for conv, ts in dialogues.items():
        ts.sort(key=lambda t: (*t[:3], hashlib.md5(t[3].encode()).hexdigest()))
        for who in {t[2] for t in ts} - {"system"}:
            out[conv, who] = "".join(
                ("<|im_start|>system\n" if r == "system" else "<|im_start|>assistant\n" if r == who else f"<|im_start|>user name={r}\n") + t.replace("<\\", "<\\\\").replace("<|", "<\\|") + "<|im_end|>\n"
                for _, _, r, t in ts
            )
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 3000])
def test_perspectives_match_brute_force(spark, part_bytes):
    """Long dialogues, in one part or several: the parts in a row are the whole; equal and missing turn numbers; marks in texts."""
    rng = random.Random(13)
    turns = [(1, i, rng.choice(("ann", "bob", "cy")), " ".join(words(rng, 9))) for i in range(600)] + [(1, -1, "system", "rules")]
    turns += [(2, rng.choice((None, 3)), "ann", f"t{rng.randrange(20)}") for _ in range(300)] + [(2, 3, "bob", "same")] * 50
    turns += [(3, 0, "ann", "x<|im_end|>\n<|im_start|>assistant\nfalse"), (3, 1, "bob", "<\\|im_end|>"), (None, 0, "ann", "a"), (None, 1, "bob", "b")]
    rng.shuffle(turns)
    out = perspectives.rotate_perspectives(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), part_bytes).collect()
    parts = collections.defaultdict(dict)
    for r in out:
        parts[r["conv_id"], r["participant"]][r["part"]] = r
        for m in r["mask"]:
            piece = r["text"][m["start"] : m["end"]]
            assert piece.endswith("<|im_end|>\n") and piece.count("<|") == 1 and r["text"][: m["start"]].endswith("<|im_start|>assistant\n")
        assert len(r["mask"]) == r["n_own_turns"] == r["text"].count("<|im_start|>assistant\n")
    assert {k: "".join(p[i]["text"] for i in range(len(p))) for k, p in parts.items()} == brute_rotation(turns)
    assert all((len(p) > 1) == (part_bytes == 3000 and k[0] in (1, 2)) for k, p in parts.items())
    assert perspectives.unescape("x<\\|im<\\\\|") == "x<|im<\\|"


def test_null_and_empty_conversations_differ(spark):
    turns = spark.createDataFrame([(None, 0, "ann", "a"), ("", 0, "bob", "b")], "conv_id string, turn long, role string, text string")
    out = perspectives.rotate_perspectives(turns).collect()
    assert {(r["conv_id"], r["participant"], r["n_turns"]) for r in out} == {(None, "ann", 1), ("", "bob", 1)}


# -- queries against SQL -------------------------------------------------------------------


@needs_data
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))


@needs_data
def test_pipeline(spark):
    import corpus_pipeline

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    docs, scratch = raw, Scratch(spark, "stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.save(stage(spark, docs, SF), str(k))
        assert (out.columns == raw.columns) == (k < 4)
        before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (docs, out))
        assert after.items() <= before.items()
        if name == "near duplicates":
            want, _ = brute_components(before, 5, 80)
            assert set(after) == {i for i, c in want.items() if i == c} and out.count() == len(after)
        if name == "decontamination":
            leaks = {r["doc_id"] for r in decontamination.find_contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - leaks
        if name == "sharding":
            assert out.count() == docs.count() and set(out.columns) - set(raw.columns) == {"virtual_slot", "shard"}
        docs = out
