"""Queries over whole tables against brute force, where their SQL covers less."""

import os
from collections import defaultdict

import numpy as np
import pytest

from voxlake.plans import registry, segment_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/embeddings.parquet"), reason="test tables aren't there")
def test_intruders_of_all_sources_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    assert {r.vec_id % 10 for r in rows} == set(range(10))
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    vectors, sums = [], defaultdict(float)
    for r in rows:
        e = np.array(r.embedding, np.float64)
        e[r.label] += 3
        vectors.append((r.vec_id, r.vec_id % 10, r.label, unit(e)))
        sums[r.vec_id % 10, r.label] = sums[r.vec_id % 10, r.label] + e * (1 + r.vec_id % 7)
    centroids = {k: unit(v) for k, v in sums.items()}
    person = lambda label: max(label, 1)  # S0 and S1 are one person
    margins = defaultdict(list)
    for vec_id, source, label, v in vectors:
        other = [v @ c for (s, x), c in centroids.items() if s == source and person(x) != person(label)]
        if other:
            margins[vec_id % 40].append(v @ centroids[source, label] - max(other))
        else:
            margins[vec_id % 40]
    got = {r.segment_id: r for r in registry.queries()["v12_v13_intruders"](spark, SF).collect()}
    assert got.keys() == margins.keys()
    for k, m in margins.items():
        assert got[k].intruder_s == pytest.approx(0.75 * sum(x < -0.1 for x in m))
        assert got[k].speaker_margin_min == pytest.approx(min(m, default=1.0), abs=1.1e-5)


@pytest.mark.skipif(not os.path.exists(f"{SF}/conversations.parquet"), reason="test tables aren't there")
@pytest.mark.parametrize("name", ["w19_excerpts", "w12_w17_build_segments"])
def test_segments_take_no_joins_of_words(spark, monkeypatch, name):
    """Words of a source are marked where they are read for its segments: no interval join shuffles them."""
    monkeypatch.setattr(segment_queries, "stored", lambda df: df)
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1
