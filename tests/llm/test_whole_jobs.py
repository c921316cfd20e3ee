"""Inputs on which operators once did less than the whole job."""

import random

from voxlake.llm import decontamination, licenses, toxicity


def words(rng, n, vocabulary=50_000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_one_edit_in_hundreds_of_copies_is_found(spark):
    rng = random.Random(8)
    item = words(rng, 60)
    edited = [w if k % 5 else f"e{k}" for k, w in enumerate(item)]
    half = item[:40] + words(rng, 20)
    rows = [(0, item), *((i, words(rng, 50) + edited + words(rng, 50)) for i in range(1, 301)), *((i, half) for i in range(301, 701)), (701, words(rng, 160))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.find_contamination(docs, bench).collect()} == set(range(701))
    assert [r["doc_id"] for r in decontamination.remove_contaminated(docs, bench).collect()] == [701]


def test_rare_terms_and_long_runs_are_in_the_dictionary():
    rng = random.Random(10)
    run = b"abhorrent1 beastly22 contempt33 despicab44 execrabl55 flagrant66 grotesqu77"
    toxic = [" ".join(words(rng, 30, 300)).encode() for _ in range(300)]
    toxic = [b" " + t + (b" zorblax" if k < 4 else b" " + run if k < 60 else b"") + b" " for k, t in enumerate(toxic)]
    ordinary = [b" " + " ".join(words(rng, 30, 300)).encode() + b" " for _ in range(3000)]
    content, _ = toxicity.train_dictionaries(toxic, ordinary)
    assert b"zorblax" in content and sum(w in content for w in run.split()) >= 6


def test_training_reads_whole_texts(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, 6000, 300) + ["scumbag"] * 3 if i % 3 == 0 else words(rng, 60, 300))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert b"scumbag" in model.contents[0]


def test_whole_licenses_are_known(spark):
    texts = licenses.whole_licenses()
    docs = spark.createDataFrame([(i, "Copyright (c) 2020 Someone\n\n" + t.upper()) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(docs).collect()}
    assert found == {i: name for i, (name, _) in enumerate(texts)} and {"Apache-2.0", "GPL-3.0", "MPL-2.0", "Unlicense"} <= set(found.values())
