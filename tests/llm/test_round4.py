"""Texts in slices, and characters of which a cut leaves a part."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from poolside.llm import pii, suffixes


def test_texts_are_redacted_in_slices():
    model = pii.fit_classifier({})
    text = "mail ann.b@example.com or call. " * 3000
    texts = pa.array([text] * 150 + [None, ""], pa.string())
    tracemalloc.start()
    out = list(pii.redacted_batches(iter([texts, texts[:0]]), model))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(a) for a in out] == [152, 0] and out[0][0].as_py() == "mail [EMAIL] or call. " * 3000 and out[0].to_pylist()[-2:] == [None, ""]
    assert peak < 0.6 * 150 * len(text)  # a whole batch as Python strings is more than once its size


def test_what_is_left_of_a_cut_character_goes(spark):
    same = "x" * 60
    table = spark.createDataFrame([(1, "é" + same), (2, "aè" + same), (3, None)], "doc_id long, text string").withColumn("n", F.lit(4))
    table = table.union(spark.createDataFrame([(4, "b©" + same, 4)], table.schema))  # its last byte is that of é
    whole, plain = ({r.doc_id: r for r in suffixes.remove_repeated(table, keep_text=True, carry=True, whole_characters=w).collect()} for w in (True, False))
    assert (plain[4].kept, whole[4].kept) == (b"b\xc2", b"b") and whole[2].kept == "aè".encode()
    assert all(whole[i].kept_sha256 == plain[i].kept_sha256 and whole[i].rest.n == 4 for i in (1, 2, 3, 4))
