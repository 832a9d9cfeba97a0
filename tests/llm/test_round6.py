"""Crowds of near prints, and links that one step hands to the next."""

from __future__ import annotations

import numpy as np

from poolside.llm import near_sets, simhash


def _crowd(n: int) -> list[tuple[int, bytearray]]:
    """Prints that differ from one print in two bits of each block."""
    rng = np.random.default_rng(6)
    plain = rng.integers(0, 2**32, 16).astype(np.uint32)
    two = lambda: sum(1 << int(k) for k in rng.choice(32, 2, replace=False))
    return [(k, bytearray((plain ^ np.array([two() for _ in range(16)], np.uint32)).astype(">u4").tobytes())) for k in range(n)]


def test_a_crowd_of_prints_makes_pairs_in_proportion(spark):
    """One pair for each node, block and part; it was one for each variant, which a larger crowd shares more of."""
    count = {}
    for n in (300, 1200):
        rows = _crowd(n)
        words = {k: np.frombuffer(bytes(p), ">u4") for k, p in rows}
        found = {(r.a, r.b) for r in simhash.block_links(spark.createDataFrame(rows, "node long, print binary"), leading=5).collect()}
        assert all(a < b and np.bitwise_count(words[a] ^ words[b]).min() <= 2 for a, b in found)
        assert {k for pair in found for k in pair} == set(words)
        count[n] = len(found)
    assert count[1200] <= 4 * count[300] and count[1200] <= 16 * 6 * 1200


def test_later_steps_get_roots_for_links(spark, monkeypatch):
    """60 texts that differ from one in a word each are all alike: many links, but from then on one for each node."""
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join([*words[: 6 * k], "other", *words[6 * k + 1 :]]) for k in range(60)]
    docs = spark.createDataFrame([*enumerate(texts), (60, " ".join(f"v{k}" for k in range(400)))], "doc_id long, text string")
    seen, plain = [], near_sets.components
    monkeypatch.setattr(near_sets, "components", lambda links: seen.append(links.count()) or plain(links))
    rows = near_sets.keyed_texts(docs)
    nodes = near_sets.checkpointed(near_sets.nodes_of(rows, 5))
    links = near_sets.similar_links(rows, nodes, words=5, small=4, leaders=2)
    assert seen[0] > 59 and seen[1:] == [59] and links.count() == 59
    assert {(r.doc_id, r.component_id) for r in near_sets.near_copies(docs, small=4, leaders=2).collect()} == {(k, 0) for k in range(60)} | {(60, 60)}
