"""Nulls, empty and long texts, ties and repeated rows, empty tables, clashing columns: every operator has a defined result."""

import pytest
from pyspark.sql import functions as F

from voxlake.llm import decontamination, fixity, licenses, line_rules, mixing, neardup, ngram_lm, perspectives, sharding, toxicity
from voxlake.llm.common import Scratch

SCHEMA = "doc_id long, text string, source string, size long, score double, hash string, shard int, virtual_slot int, `key` string, `_id` long, node long, rank int"
LONG = " ".join(f"w{i % 7919}x{i % 31}" for i in range(60_000))


def _row(doc_id, text, source="a"):
    return (doc_id, text, source, 7, 0.5, "h", 3, 4, "k", 9, 1, 2)


EDGE = [
    _row(1, "one two three four five six seven eight nine ten eleven"),
    _row(1, "one two three four five six seven eight nine ten eleven"),
    _row(2, None),
    _row(None, "a text without an id, of a few words more than ten in all"),
    _row(3, ""),
    _row(4, LONG, None),
    _row(5, "one two"),
    _row(6, "one two"),
    _row(7, " \n\t\n ", "b"),
]
IDS = sorted((r[0] for r in EDGE), key=lambda x: (x is None, x or 0))


@pytest.fixture(params=["edge", "empty"])
def docs(request, spark):
    return spark.createDataFrame(EDGE if request.param == "edge" else [], SCHEMA)


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x or 0))


def expected(docs):
    return IDS if docs.count() else []


def test_sharding(docs):
    out, slots = sharding.shard_records(docs)
    rows = out.collect()
    assert ids(out) == expected(docs)
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in rows if r["doc_id"] in (2, 3))
    dealt = sharding.shard_documents(docs)
    assert dealt.columns == [*docs.columns, "virtual_slot_", "shard_"] and ids(dealt) == expected(docs)
    assert all((r["shard"], r["virtual_slot"]) == (3, 4) and 0 <= r["shard_"] < 24 for r in dealt.collect())


def test_mixing(docs):
    keyed = mixing.keyed_documents(docs)
    out = mixing.copies_taken(keyed, mixing.plan_mix(keyed))
    assert ids(out) == expected(docs)
    assert all(0 <= r["copies"] <= 2 for r in out.collect())
    assert mixing.mix_documents(docs).columns == docs.columns


def test_quality_rules(docs):
    out = line_rules.score_documents(docs)
    assert ids(out) == expected(docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    if rows:
        assert rows[2]["n_words"] == 0 and rows[2]["base_failed"] and not rows[2]["kept"]
        assert rows[4]["n_words"] == 60_000 and rows[7]["n_dup_lines"] == 0
        assert rows[1]["kept"]


def test_licenses(docs):
    out = licenses.scan_licenses(docs)
    assert ids(out) == expected(docs)
    assert out.where("license_id IS NOT NULL OR size(notices) > 0").isEmpty()


def test_toxicity(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert ids(toxicity.score_documents(docs, model)) == expected(docs)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (5, 0, None), (None, 1, 1), (4, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_documents(docs, model).collect())
    assert toxicity.keep_ordinary(docs, model).columns == docs.columns


def test_near_duplicates(docs):
    out = neardup.near_duplicates(docs, 3, 85)
    rows = out.collect()
    assert ids(out) == expected(docs)
    of = {r["doc_id"]: r["component_id"] for r in rows}
    if rows:
        assert of == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, None: None}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == ([1, 2, 3, 4, 5, 7, None] if rows else [])


def test_decontamination(docs, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, "x"), (4, ""), (1, "one two three four five six seven")], "item_id long, text string")
    found = decontamination.find_contamination(docs, items)
    assert sorted({(r["doc_id"], r["item_id"]) for r in found.collect()}) == ([(1, 1)] if docs.count() else [])
    clean = decontamination.remove_contaminated(docs, items)
    assert clean.columns == docs.columns and ids(clean) == [x for x in expected(docs) if x != 1]
    assert decontamination.find_contamination(docs, items.limit(0)).isEmpty()


@pytest.mark.parametrize("trains", [True, False])
def test_language_model(docs, spark, trains):
    out, model = ngram_lm.train_and_score(docs.withColumn("train", F.lit(trains)), Scratch(spark, "lm-test"))
    assert ids(out) == expected(docs)
    for r in out.collect():
        assert r["n_known"] == (r["n_tokens"] if trains else 0) and r["score"] <= 1e-9 and (trains or r["score"] == 0)
    assert ids(ngram_lm.score_documents(docs, model, Scratch(spark, "lm-later"))) == expected(docs)


def test_fixity(spark):
    schema = "page_id long, url string, html string, file int, node long"
    for rows in ([], [(1, "u", "x", 1, 1), (1, "u", "x", 1, 1), (None, None, None, 1, 1), (2, "v\r\nw", "y" * 100_000, 1, 1)]):
        pages = spark.createDataFrame(rows, schema).withColumn("record_id", fixity.record_urn(F.col("page_id"), F.col("url"), F.col("html")))
        records = fixity._records(pages, "a").unionByName(fixity._records(pages.where("page_id IS NULL OR page_id <> 2"), "b"))
        leaves = fixity.lay_out(records, fixity.file_count(records, 1 << 16))
        archive = fixity.Archive(leaves, Scratch(spark, "fix"))
        found = archive.mismatches("a", "b").collect()
        assert [(r["page_id"], r["status"]) for r in found] == ([(2, "lost")] if rows else [])
        assert archive.mismatches("a", "a", "same").isEmpty()


def test_perspectives(spark):
    schema = "conv_id long, turn long, role string, text string, part long, mask string"
    rows = [(1, 0, "ann", "hi", 1, "m"), (1, 1, "bob", None, 1, "m"), (1, 1, "bob", None, 1, "m"), (1, None, None, "x", 1, "m"), (None, 0, "ann", "", 1, "m"), (2, 0, "system", "s", 1, "m"), (3, 0, "ann", LONG * 6, 1, "m"), (3, 1, "bob", "y", 1, "m")]
    out = perspectives.rotate_perspectives(spark.createDataFrame(rows, schema)).collect()
    assert {(r["conv_id"], r["part"], r["participant"]) for r in out} == {(1, 0, p) for p in ("ann", "bob", "unknown")} | {(None, 0, "ann")} | {(3, 0, "ann"), (3, 0, "bob")} | {(3, len(LONG * 6) // perspectives.PART_BYTES, p) for p in ("ann", "bob")}
    assert next(r for r in out if (r["conv_id"], r["participant"]) == (1, "bob"))["n_own_turns"] == 2
    assert perspectives.rotate_perspectives(spark.createDataFrame([], schema)).isEmpty()


def test_pipeline_stages(docs, spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (4, 1, 1), (None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    some = bool(expected(docs))
    kept = {"near duplicates": [1, 2, 3, 4, 5, 7, None], "decontamination": [2, 3, 4, 5, 7, None]}
    scratch, at = Scratch(spark, "edge-stages"), docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.save(stage(spark, at, str(tmp_path)), str(k))
        assert out.columns == (docs.columns if k < 4 else [*docs.columns, "virtual_slot_", "shard_"])
        if name in kept and some and k:
            assert ids(out) == [x for x in kept[name] if x in ids(at)]
        if name == "mixing":
            assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in at.collect()}
        if name == "sharding":
            assert out.count() == at.count()
        assert some or out.isEmpty()
        at = out
