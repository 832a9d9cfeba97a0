"""Wide SimHash prints, and the stage that links by them."""

from __future__ import annotations

import numpy as np

from poolside.llm import near_sets, simhash


def test_blocks_of_prints_meet_similar_sets(spark):
    rng = np.random.default_rng(4)
    rows, near = [], set()
    for k in range(150):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        y = np.r_[x[:284], rng.integers(0, 2**63, 16).astype(np.uint64)]  # a similarity of 0.9
        rows += [(2 * k, bytearray(simhash.wide_print(x))), (2 * k + 1, bytearray(simhash.wide_print(y)))]
        near.add((2 * k, 2 * k + 1))
    rows.append((300, bytearray(simhash.wide_print(np.zeros(0, np.uint64)))))
    prints = spark.createDataFrame(rows, "node long, print binary")
    words = {n: np.frombuffer(bytes(p), ">u4") for n, p in rows}
    meet = {(a, b) for a in words for b in words if a < b and np.bitwise_count(words[a] ^ words[b]).min() <= 2}
    for leading in (None, 12):
        found = {(r.a, r.b) for r in simhash.block_links(prints, leading=leading).collect()}
        assert found == meet and len(found & near) >= 145 and len(found - near) <= 2
    assert simhash.block_links(prints.limit(0)).collect() == []


def test_the_near_duplicate_stage_links_by_simhash(spark, monkeypatch):
    import corpus_pipeline

    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(words), " ".join([*words[:150], "other", *words[151:]]), " ".join(f"v{k}" for k in range(300))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    plain = near_sets.block_links
    monkeypatch.setattr(near_sets, "block_links", lambda prints: seen.append((found := plain(prints)).count()) or found)
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, table, "").collect()) == [0, 2]
    assert seen == [1]
