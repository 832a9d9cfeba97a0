"""Keys of corners whose pictures are connected already."""

from __future__ import annotations

import numpy as np

from poolside.llm import media


def test_rows_of_connected_keys_are_not_matched_again(spark, monkeypatch):
    picture = media.drawn(np.random.default_rng(9).normal(size=64))
    rows = []
    for k in range(24):
        own = picture.copy()
        own[4 * (k % 12) : 4 * (k % 12) + 4, 4 * (k // 12) : 4 * (k // 12) + 4] = 10 + k
        rows.append((k, *own.shape, bytearray(own.tobytes())))
    seen, plain = [], media.matched
    monkeypatch.setattr(media, "matched", lambda rows, **options: seen.append(rows.count() if "root" in rows.columns else -1) or plain(rows, **options))
    found = media.image_classes(spark.createDataFrame(rows, "image_id long, height int, width int, pixels binary")).collect()
    assert {r.class_id for r in found} == {0} and len(found) == 24
    assert seen == [-1, 0, 0]
