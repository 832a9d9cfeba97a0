"""Near-duplicates by the Jaccard similarity of word shingles: SimHash, then what it misses.

Texts are sets of hashed shingles; equal sets are one node. Wide SimHash prints give
candidates, by small balls in each block of their bits (``simhash.block_links``), and
candidates are compared exactly. At a similarity of 0.8 prints of any length miss some
pairs, so all pairs of sets that are not connected yet go through a filter without loss:

Two sets of similarity s
or more share a shingle among the first few of each in any one order of all shingles
(prefix filter; Chaudhuri et al., 2006), and the place of the first shared one bounds
what they can share in all (Xiao et al., 2008). So does a bitmap of each set: every
bit that only one of two sets has stands for a shingle that they do not share
(Sandes et al., 2020). Sets that meet at a shingle and pass both bounds are compared
exactly; only verified pairs are links.

The order puts shingles that are common in a sample last. It decides how many
sets meet, never which pairs are found.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh_path, give_back, groups, keyed_texts, map_slices, mark_of, partitions, utf8_values
from .components import components, least_labels, one_of_each
from .simhash import LOWER, block_links, wide_print

#: Similarity of near-duplicates, as a fraction.
LEAST = (4, 5)
_MIX, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
ROWS = "shingle long, node long, size int, place int"
#: 64-bit words of a set's bitmap. Larger sets share bits, which makes the bound weaker, never wrong.
MAP_WORDS = 16
#: Sets of more shingles have a second bitmap that grows with them.
LARGE = 512
#: Candidates of SimHash are verified if their prints differ in at most so many of 512 bits; at a similarity of 0.8 it is 78 on average.
FAR = 128


class _Words(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, 7)
        return out


def shingle_set(text: bytes, words: int, known: _Words) -> np.ndarray:
    """The sorted, distinct 64-bit hashes of the shingles of so many words; fewer words are one shingle."""
    found = text.translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), 8)], np.uint64)
    w = np.array([known[x] for x in found], np.uint64)
    n = len(w) - words + 1
    h = w[:n].copy()
    for i in range(1, words):
        h = (h ^ (h >> np.uint64(29))) * _MIX + w[i : n + i]
    h = (h ^ (h >> np.uint64(32))) * _LAST
    return np.unique(h ^ (h >> np.uint64(29)))


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.array([xxhash.xxh64_intdigest(shingles.tobytes())], np.uint64).view(np.int64)[0])


def bitmap(shingles: np.ndarray) -> bytes:
    """The bits that the shingles of a set hash to."""
    bits = np.zeros(64 * MAP_WORDS, np.uint8)
    bits[(shingles >> np.uint64(20)) % np.uint64(64 * MAP_WORDS)] = 1
    return np.packbits(bits).tobytes()


def large_bitmap(shingles: np.ndarray) -> bytes | None:
    """For a large set, the bits that its shingles hash to among two to four times as many; else None."""
    if len(shingles) <= LARGE:
        return None
    bits = np.zeros(1 << (2 * len(shingles) - 1).bit_length(), np.uint8)
    bits[(shingles >> np.uint64(20)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).tobytes()


def prefix_length(size: int) -> int:
    return size + (LEAST[0] * size) // -LEAST[1] + 1 if size else 0


def nodes_of(texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, mark, node, size, bitmap, large, print) of each row; mark is a digest of the text, print the wide SimHash of its shingles."""

    def setup():
        known = _Words()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, words, known) for t in utf8_values(batch.column(1))]
            nodes = pa.array([node_of(s) for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int32())
            maps = [pa.array([f(s) for s in sets], pa.binary()) for f in (bitmap, large_bitmap, wide_print)]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), nodes, sizes, *maps], ["doc_id", "mark", "node", "size", "bitmap", "large", "print"])

        return run

    return map_slices(texts.withColumn("mark", mark_of(F.col("text"))), setup, "doc_id long, mark binary, node long, size int, bitmap binary, large binary, print binary")


def packed_texts(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, packed): one compressed text of each of the wanted nodes; it takes less room than the set."""
    spark = texts.sparkSession
    path = fresh_path(spark, "near-ids")  # written, so that Spark knows the size and decides on the join
    nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("first_id")).write.parquet(path)
    ids = spark.read.parquet(path)
    few = texts.join(ids.select("first_id").distinct(), F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")

    def setup():
        known, seen = _Words(), set()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: dict[int, bytes] = {}
            for t in utf8_values(batch.column(1)):
                n = node_of(shingle_set(t, words, known))
                if n not in seen:
                    seen.add(n)
                    out[n] = zlib.compress(t, 1)
            return pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.binary())], ["node", "packed"])

        return run

    return map_slices(few, setup, "node long, packed binary").join(ids.select("node"), "node", "left_semi").dropDuplicates(["node"])


def common_shingles(texts: DataFrame, words: int, sample: int, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of three or more of about ``sample`` texts, sorted, and their counts. They only shape the order."""
    share = int(min(1.0, sample / max(1, texts.count())) * 1_000_000)
    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share)

    def setup():
        known = _Words()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, words, known) for t in utf8_values(batch.column(1))]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

        return run

    counted = map_slices(some, setup, "shingle long").groupBy("shingle").count().where("count > 2").orderBy(F.desc("count"), "shingle").limit(most).toPandas()
    shingles = counted["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], counted["count"].to_numpy(np.int64)[order]


def prefixes(texts: DataFrame, words: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shingle, node, size, place): the first shingles of each set in the common order."""
    shingles, counts = common

    def setup():
        known, seen = _Words(), set()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, nodes, sizes = [np.zeros(0, np.uint64)], [], []
            for t in utf8_values(batch.column(1)):
                s = shingle_set(t, words, known)
                n = node_of(s)
                if n in seen:
                    continue
                seen.add(n)
                often = np.zeros(len(s), np.int64)
                if len(shingles):
                    at = np.minimum(np.searchsorted(shingles, s), len(shingles) - 1)
                    often = np.where(shingles[at] == s, counts[at], 0)
                out.append(s[np.argsort(often, kind="stable")[: prefix_length(len(s))]])  # s is sorted, so equal counts go by hash
                nodes.append(n)
                sizes.append(len(s))
            lengths = [len(x) for x in out[1:]]
            places = np.concatenate([np.arange(n) for n in lengths]) if lengths else np.zeros(0)
            columns = [
                pa.array(np.concatenate(out).view(np.int64)),
                pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
                pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                pa.array(places.astype(np.int32)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["shingle", "node", "size", "place"])

        return run

    return map_slices(texts, setup, ROWS)


def met(rows: DataFrame) -> DataFrame:
    """Rows of shingles that have a partner there, by size and place, with the count ``n`` of such rows of the shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingle, node, size, place in groups(batches):
            new = np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])]
            shingle, node, size, place = shingle[new], node[new], size[new], place[new]
            group = np.cumsum(np.r_[False, shingle[1:] != shingle[:-1]])
            keep = _partnered(group, size, place)
            n = np.bincount(group[keep], minlength=group[-1] + 1)[group]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (shingle, node, size, place, n.astype(np.int32))], ["shingle", "node", "size", "place", "n"])
        give_back()

    dealt = rows.repartition(partitions(rows.sparkSession), "shingle").sortWithinPartitions("shingle", "node")
    return dealt.mapInArrow(run, ROWS + ", n int")


def _partnered(group: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each row has another of its group that ``_fit`` could accept. Groups are numbered from 0, ascending.

    A row fits sets of up to some size, its reach, and so must the other row reach it. Rows
    with a place so late that they do not reach their own size fit smaller sets only.
    Every row with a partner is kept; some without one may be.
    """
    a, b = LEAST
    s = size.astype(np.int64)
    reach = ((a + b) * (s - place) - a * s) // a
    order = np.lexsort((s, group))
    base = group[order].astype(np.int64) << 32  # keeps groups apart
    at, to = base + s[order], base + reach[order]
    most = np.maximum.accumulate(to)
    late = to < at
    i = np.where(late, np.searchsorted(at, to, "right"), np.arange(len(at)))  # rows before i are smaller, and in reach
    found = (i > 0) & (most[i - 1] >= at)
    other = found | ~late
    after = np.r_[at[other], np.iinfo(np.int64).max][np.cumsum(other)]
    found |= ~late & (after <= to)
    out = np.empty(len(s), bool)
    out[order] = found
    return out


def _fit(sx: np.ndarray, px: np.ndarray, sy: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Whether two sets can be similar enough if this is the first shingle that they share."""
    a, b = LEAST
    sx, px, sy, py = (v.astype(np.int64) for v in (sx, px, sy, py))
    shared = np.minimum(sx - px, sy - py)  # with this one
    return (b * np.minimum(sx, sy) >= a * np.maximum(sx, sy)) & ((a + b) * shared >= a * (sx + sy))


def _overlap(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray) -> np.ndarray:
    """Whether sets of these bitmaps and sizes can be similar enough."""
    a, b = LEAST
    both = x & y
    only_x, only_y = (np.bitwise_count(v ^ both).sum(axis=1, dtype=np.int64) for v in (x, y))
    sx, sy = sx.astype(np.int64), sy.astype(np.int64)
    return (a + b) * np.minimum(sx - only_x, sy - only_y) >= a * (sx + sy)


def proposed(rows: DataFrame, *, small: int, leaders: int | None) -> DataFrame:
    """(a, b), a < b: pairs of nodes of different roots that meet at a shingle and can be similar.

    rows: (shingle, node, size, place, bitmap, root). With ``leaders``, groups of over
    ``small`` nodes pair each node only with so many of them.
    """

    def of_group(node, size, place, maps, root) -> Iterator[np.ndarray]:  # noqa: ANN001
        lead = np.arange(len(node))
        if root.min() == root.max():
            return
        if leaders is not None and len(node) > small:
            mixed = (node.view(np.uint64) * _MIX) >> np.uint64(20)
            lead = np.argsort(mixed, kind="stable")[:leaders]
        maps = np.frombuffer(b"".join(maps), np.uint64).reshape(-1, MAP_WORDS)
        step = max(1, 200_000 // len(lead))
        for at in range(0, len(node), step):
            x = slice(at, at + step)
            ok = (root[x][:, None] != root[lead][None, :]) & _fit(size[x][:, None], place[x][:, None], size[lead][None, :], place[lead][None, :])
            i, j = np.nonzero(ok)
            i, j = i + at, lead[j]
            for k in range(0, len(i), 50_000):
                m, n = i[k : k + 50_000], j[k : k + 50_000]
                ok = _overlap(maps[m], maps[n], size[m], size[n])
                m, n = node[m[ok]], node[n[ok]]
                yield np.stack([np.minimum(m, n), np.maximum(m, n)], axis=1)

    def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
        out = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, k])) for k in range(2)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingle, *rest in groups(batches):
            ends = [*(np.flatnonzero(shingle[1:] != shingle[:-1]) + 1).tolist(), len(shingle)]
            found, size, start = [np.zeros((0, 2), np.int64)], 0, 0
            for end in ends:
                for pairs in of_group(*(c[start:end] for c in rest)):
                    found.append(pairs)
                    size += len(pairs)
                    if size > 200_000:
                        yield batch_of(found)
                        found, size = [np.zeros((0, 2), np.int64)], 0
                start = end
            yield batch_of(found)
        give_back()

    dealt = rows.select("shingle", "node", "size", "place", "bitmap", "root").repartition(partitions(rows.sparkSession), "shingle").sortWithinPartitions("shingle")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _beside(pairs: DataFrame, nodes: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Pairs with columns of both nodes, as ``x`` and ``y``."""
    of = lambda n, s: nodes.select(F.col("node").alias(n), F.struct(*columns).alias(s))
    return pairs.join(of("a", "x"), "a", how).join(of("b", "y"), "b", how).select("a", "b", "x", "y")


def alike(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Pairs of nodes of (node, print) whose wide prints are not FAR apart; those that share a block by chance are, and their number grows with the square of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).field(0).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("x", "y"))
                yield batch.select(["a", "b"]).filter(pa.array(np.bitwise_count(x ^ y).sum(axis=1) <= FAR))

    return _beside(pairs, prints, ["print"], "inner").mapInArrow(run, "a long, b long")


def possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs but those of large sets whose large bitmaps show that they share too little. nodes: (node, size, large)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                if x is None or y is None:
                    keep.append(True)
                    continue
                m, n = (np.frombuffer(v["large"], np.uint64) for v in (x, y))
                words = min(len(m), len(n))  # of powers of two, so the longer one folds to the shorter
                m, n = (np.bitwise_or.reduce(v.reshape(-1, words), axis=0)[None, :] for v in (m, n))
                keep.append(bool(_overlap(m, n, np.array([x["size"]]), np.array([y["size"]]))[0]))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _beside(pairs, nodes.where("large IS NOT NULL").dropDuplicates(["node"]), ["size", "large"], "left").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        read = lru_cache(64)(lambda packed: shingle_set(zlib.decompress(packed), words, known))
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = read(x.as_py()), read(y.as_py())
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(LEAST[1] * shared >= LEAST[0] * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = checkpointed(pairs)
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    packed = checkpointed(packed_texts(texts, nodes, wanted, words))
    of = lambda n, s: packed.select(F.col("node").alias(n), F.col("packed").alias(s))
    return checkpointed(pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def similar_links(texts: DataFrame, nodes: DataFrame, *, words: int = 5, small: int = 32, leaders: int = 16, sample: int = 5_000) -> DataFrame:
    """(a, b): links that connect what pairs of nodes whose similarity is LEAST or more connect, and nothing else.

    SimHash comes first, then the sets that meet at a shingle of their prefixes, but for
    those that are connected already. What one step has connected goes on as a link from
    each node to its root, so later steps have no more links than nodes and new pairs. Groups of over ``small`` nodes first pair their nodes
    with leaders. All other pairs of the group follow, so no pair of different
    components is left out.
    """
    rooted = lambda rows, roots: rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    and_roots = lambda links, roots: roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)
    prints = nodes.select("node", "print").dropDuplicates(["node"])
    roots = components(verified(alike(block_links(prints), prints), texts, nodes, words))
    large = nodes.select("node", "size", "large")
    maps = rooted(nodes.select("node", "bitmap").dropDuplicates(["node"]), roots)
    # Parquet, in order of node: each bitmap is stored once for all rows of its node
    met(prefixes(texts, words, common_shingles(texts, words, sample))).join(maps, "node").sortWithinPartitions("node").write.parquet(path := fresh_path(texts.sparkSession, "near-rows"))
    rows = texts.sparkSession.read.parquet(path)
    links = and_roots(verified(possible(proposed(rows, small=small, leaders=leaders), large), texts, nodes, words), roots)
    crowded = rows.where(F.col("n") > small).drop("root")
    if not crowded.isEmpty():
        roots = components(links)
        links = and_roots(verified(possible(proposed(rooted(crowded, roots), small=small, leaders=None), large), texts, nodes, words), roots)
    return links


def near_copies(docs: DataFrame, *, words: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, component_id) of each row: the smallest id reachable over pairs of similarity LEAST or more.

    Rows of equal sets (copies; empty and null texts) are linked. A null id is a
    component_id only if all ids of the component are null.
    """
    texts = keyed_texts(docs, id_col, text_col)
    nodes = checkpointed(nodes_of(texts, words))
    first = nodes.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    least = least_labels(first, similar_links(texts, nodes, words=words, **options), "first_id")
    return nodes.join(least, "node").select("doc_id", F.col("least").alias("component_id"))


def first_of_each_group(docs: DataFrame, *, words: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, one for each group of near copies, as ``one_of_each`` says."""
    texts = keyed_texts(docs, id_col, text_col)
    nodes = checkpointed(nodes_of(texts, words))
    return one_of_each(docs, nodes, similar_links(texts, nodes, words=words, **options), id_col, text_col)
