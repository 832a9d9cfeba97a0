"""Ranked lexical search: hashed max-sketches bound the scores, exact scores settle the rest.

A document's sketch has twice as many places as the document has terms (a power of two);
each term's impact goes to the place that its hash names, and a place keeps the largest. A
query looks up the places of its terms: the weighted sum is at least the document's
score. Each task bounds all its documents for all queries of a block by one matrix product,
then scores documents exactly, from the largest bound down, until the bounds fall below the
last of the best so far. Tasks keep the best of each query only; the best of all tasks are
merged in two steps.

Counts and weights cover all documents. Queries are broadcast in blocks of at most
:data:`BLOCK_BYTES` of text, so the whole set of queries may have any size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, give_back, keyed_texts, slices, utf8_values

BEST = 50
#: Text of the queries that are broadcast together; a single longer query is a block of its own.
BLOCK_BYTES = 1_000_000
#: Text of the documents whose sketches are held together.
SLICE = 3_000_000
#: Documents that are scored exactly in one step.
STEP = 64
LEAST_WIDTH = 64
#: Bytes of matrices that are multiplied at once.
MATRIX_BYTES = 48_000_000
#: Results of tasks are merged in so many groups first.
GROUPS = 32

# A term is a run of digits, letters and anything beyond ASCII; A-Z are lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
RESULT = "query long, doc_id long, score long, task long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def place(term: bytes) -> int:
    return zlib.crc32(term)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """The terms of a slice of documents: sorted keys document * terms + term, with how often."""

    def __init__(self, texts: list[bytes]):
        lists = [terms_of(t) for t in texts]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        encoded = pa.array([t for x in lists for t in x], pa.binary()).dictionary_encode()
        self.terms: list[bytes] = encoded.dictionary.to_pylist()
        self.width = max(1, len(self.terms))
        doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.keys, self.times = np.unique(doc * self.width + encoded.indices.to_numpy().astype(np.int64), return_counts=True)
        self.doc, self.term = np.divmod(self.keys, self.width)
        self.distinct = np.bincount(self.doc, minlength=len(texts))

    def impacts(self, n_docs: int, length: int) -> np.ndarray:
        norm = 50 + (50 * self.sizes * n_docs) // max(1, length)
        self.impact = (1_000_000_000 * self.times) // (1000 * self.times + 20 * norm[self.doc])
        return self.impact

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for the terms (numbers of this slice) of one query."""
        wanted = (docs[:, None] * self.width + terms[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = np.where(self.keys[at] == wanted, self.impact[at], 0).reshape(len(docs), len(terms))
        return found @ weights


class Sketches:
    """Documents of one slice by the width of their sketches."""

    def __init__(self, postings: Postings):
        p = postings
        widths = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(2 * p.distinct, 1))).astype(np.int64))
        hashes = np.array([place(t) for t in p.terms], np.int64)
        self.docs_of = {int(w): np.flatnonzero((widths == w) & (p.distinct > 0)) for w in np.unique(widths)}
        self.p, self.widths, self.hashes = p, widths, hashes

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, documents, their sketches), some documents at a time."""
        first = np.searchsorted(self.p.doc, np.arange(len(self.widths) + 1))
        for width, docs in self.docs_of.items():
            step = max(1, MATRIX_BYTES // (8 * width))
            for i in range(0, len(docs), step):
                some = docs[i : i + step]
                rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in some.tolist()]) if len(some) else np.empty(0, np.int64)
                sketch = np.zeros((len(some), width))
                row = np.repeat(np.arange(len(some)), first[some + 1] - first[some])
                np.maximum.at(sketch, (row, self.hashes[self.p.term[rows]] & (width - 1)), self.p.impact[rows])
                yield width, some, sketch


class Queries:
    """The queries of one block: their distinct terms and weights."""

    def __init__(self, terms: list[list[bytes]], weights: dict[bytes, int]):
        self.terms = [[t for t in own if weights.get(t, 0) > 0] for own in terms]
        self.weights = [np.array([weights[t] for t in own], np.int64) for own in self.terms]
        self.hashes = [np.array([place(t) for t in own], np.int64) for own in self.terms]
        self._lookups: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bounds(self, width: int, sketch: np.ndarray) -> np.ndarray:
        """At least the score of each document (row) for each query (column)."""
        if width not in self._lookups:
            places = np.unique(np.concatenate([np.empty(0, np.int64), *(h & (width - 1) for h in self.hashes)]))
            table = np.zeros((len(places), len(self.terms)))
            for q, (h, w) in enumerate(zip(self.hashes, self.weights, strict=True)):
                np.add.at(table[:, q], np.searchsorted(places, h & (width - 1)), w)
            self._lookups[width] = places, table
        places, table = self._lookups[width]
        return sketch[:, places] @ table


class Best:
    """The best documents of one query so far: highest score, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    @property
    def threshold(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        keep = scores >= self.threshold
        if keep.any():
            s, i, n = np.r_[self.scores, scores[keep]], np.r_[self.ids, ids[keep]], np.r_[self.null, null[keep]]
            order = np.lexsort((i, n, -s))[: self.k]
            self.scores, self.ids, self.null = s[order], i[order], n[order]


def _counts(docs: DataFrame, terms: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """(documents with a term, terms of all, documents with each of the terms asked for)."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, have, n, length = shared.value, dict.fromkeys(shared.value, 0), 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                for text in utf8_values(part.column(1)):
                    own = terms_of(text)
                    n += bool(own)
                    length += len(own)
                    for t in asked.intersection(own):
                        have[t] += 1
            give_back()
        rows = [(None, n), (b"", length), *((t, k) for t, k in have.items() if k)]  # no term is empty
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], ["term", "n"])

    rows = docs.mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # as many as the block has terms
    found = {None if r.term is None else bytes(r.term): int(r.n) for r in rows}
    return found.pop(None, 0), found.pop(b"", 0), found


def _best_of_tasks(docs: DataFrame, queries: Queries, n_docs: int, length: int, k: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        asked = shared.value
        best = [Best(k) for _ in asked.terms]
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                _search(part, asked, best, n_docs, length)
            give_back()
        task = TaskContext.get().partitionId()
        for q, b in enumerate(best):
            if len(b.scores):
                size = len(b.scores)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, q)), pa.array(b.ids, mask=b.null), pa.array(b.scores), pa.array(np.full(size, task))], ["query", "doc_id", "score", "task"])

    return docs.mapInArrow(run, RESULT)


def _search(part: pa.RecordBatch, asked: Queries, best: list[Best], n_docs: int, length: int) -> None:
    postings = Postings(utf8_values(part.column(1)))
    if not len(postings.keys):
        return
    postings.impacts(n_docs, length)
    null = part.column(0).is_null().to_numpy(zero_copy_only=False)
    ids = part.column(0).fill_null(0).to_numpy()
    number = {t: i for i, t in enumerate(postings.terms)}
    own = []  # of each query the terms that this slice has
    for terms, weights in zip(asked.terms, asked.weights, strict=True):
        at = [number.get(t, -1) for t in terms]
        there = np.array(at, np.int64)
        own.append((there[there >= 0], weights[there >= 0]))
    for width, docs, sketch in Sketches(postings).blocks():
        bounds = asked.bounds(width, sketch)
        for q, (terms, weights) in enumerate(own):
            if not len(terms):
                continue
            column = bounds[:, q]
            likely = np.flatnonzero(column >= best[q].threshold)
            order = likely[np.argsort(-column[likely], kind="stable")]
            for i in range(0, len(order), STEP):
                some = order[i : i + STEP]
                if column[some[0]] < best[q].threshold:
                    break
                chosen = docs[some]
                best[q].add(postings.scores(chosen, terms, weights), ids[chosen], null[chosen])


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    block, size = [], 0
    rows = items.select(F.col(f"`{item_col}`").alias("item"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    for row in rows.toLocalIterator():
        text = row.text.encode()
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item, sorted(set(terms_of(text)))))
        size += len(text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank, doc_id, score; only scores above 0.

    Equal scores are ranked by ascending doc_id, null ids last. Null texts, on either side,
    have no terms; an item without terms or without a match has no row. Repeated documents
    are ranked each, repeated items get their rows each; an item's null id stays null. Other
    columns are not read, whatever their names; empty tables give an empty result.
    """
    spark = docs.sparkSession
    keyed = keyed_texts(docs, id_col, text_col)
    kind = items.schema[item_col].dataType.simpleString()
    out = None
    for block in _blocks(items, item_col, text_col):
        n_docs, length, df = _counts(keyed, {t for _, own in block for t in own})
        asked = Queries([own for _, own in block], {t: weight(n_docs, n) for t, n in df.items()})
        _best_of_tasks(keyed, asked, n_docs, length, k).write.parquet(path := fresh_path(spark, "best"))
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], f"query long, item_id {kind}")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        found = spark.read.parquet(path).withColumn("some", F.col("task") % GROUPS)
        for keys in (["query", "some"], ["query"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        rows = found.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
#: The same by scores of all documents for all items.
ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
a AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nl FROM d WHERE len(w) > 0),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
s AS (SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // nl)))) AS BIGINT) AS score
 FROM q JOIN tf USING (term) JOIN df USING (term), a GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50"""
