"""Types of carried columns, rows without a partner, and blocks of bits that many prints share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T

from poolside.llm import near_sets, simhash, suffixes


def test_carried_columns_may_be_null_at_any_depth():
    strict = T.StructType([T.StructField("a.b", T.IntegerType(), False), T.StructField("x", T.ArrayType(T.StructType([T.StructField("y", T.StringType(), False)]), False), False)])
    strict.add("m", T.MapType(T.StringType(), T.LongType(), False), False)
    loose = suffixes.loosened(strict)
    assert all(f.nullable for f in loose.fields) and loose["x"].dataType.containsNull and loose["x"].dataType.elementType["y"].nullable and loose["m"].dataType.valueContainsNull
    assert loose.simpleString() == strict.simpleString()


def test_rows_without_a_partner_go_no_further():
    rng = np.random.default_rng(1)
    rows = kept = 0
    for _ in range(100):
        group = np.unique(np.sort(rng.integers(0, rng.integers(1, 12), rng.integers(1, 60))), return_inverse=True)[1]
        size = np.exp(rng.normal(4, 1.5 * rng.random(), len(group))).astype(np.int32) + 1
        place = np.array([rng.integers(0, near_sets.prefix_length(int(s))) for s in size], np.int32)
        fit = (group[:, None] == group[None, :]) & near_sets._fit(size[:, None], place[:, None], size[None, :], place[None, :]) & ~np.eye(len(group), dtype=bool)
        keep = near_sets._partnered(group, size, place)
        assert (keep | ~fit.any(axis=1)).all()
        rows, kept = rows + len(keep), kept + int(keep.sum())
    assert kept < rows / 2


def test_equal_blocks_make_one_row_for_each_node(spark):
    """Each of 300 nodes of one print is linked to the smallest once a block; with variants of all of them it was once for each part they meet in."""
    rng = np.random.default_rng(2)
    same, far = rng.bytes(64), rng.bytes(64)
    prints = spark.createDataFrame([(k, bytearray(same)) for k in range(300)] + [(999, bytearray(far))], "node long, print binary")
    made = []
    plain = type(prints).distinct
    try:
        type(prints).distinct = lambda df: made.append(df.count()) or plain(df)
        found = {(r.a, r.b) for r in simhash.block_links(prints, leading=5).collect()}
    finally:
        type(prints).distinct = plain
    assert found == {(0, k) for k in range(1, 300)} and made[0] <= 16 * 299


def test_pairs_are_ruled_out_before_their_texts_move(spark):
    rng = np.random.default_rng(3)
    whole = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    sets = {1: whole[:3000], 2: np.unique(np.r_[whole[:2900], whole[3000:3100]]), 3: np.unique(np.r_[whole[1000:4000]]), 4: whole[:400], 5: np.unique(rng.integers(0, 1 << 63, 2500, dtype=np.uint64))}
    schema = "node long, size int, bitmap binary, large binary, print binary"
    maps = lambda v: tuple(None if b is None else bytearray(b) for b in (near_sets.bitmap(v), near_sets.large_bitmap(v), simhash.wide_print(v)))
    nodes = spark.createDataFrame([(n, len(v), *maps(v)) for n, v in sets.items()], schema)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (2, 5)], "a long, b long")
    assert {(r.a, r.b) for r in near_sets.possible(pairs, nodes).collect()} == {(1, 2), (1, 4)}  # 4 is small: not judged here
    assert {(r.a, r.b) for r in near_sets.alike(pairs, nodes.select("node", "print")).collect()} >= {(1, 2)}
    assert (1, 5) not in {(r.a, r.b) for r in near_sets.alike(pairs, nodes.select("node", "print")).collect()}
    small = [np.frombuffer(near_sets.bitmap(sets[n]), np.uint64)[None, :] for n in (1, 5)]
    assert near_sets._overlap(*small, np.array([3000]), np.array([2500]))[0]  # the small bitmaps are full
