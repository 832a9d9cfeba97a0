"""SimHash fingerprints, and near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant that differs
from either in at most r bits. So every fingerprint emits all its variants within
r bits, variants meet in a shuffle, and fingerprints that share one are compared.

A fingerprint has 1 + 64 + 2016 variants within two bits, so they are not sent one
by one. A row goes to each *leading part* that the variants have, and says which
fingerprint it comes from; the receiving task flips the remaining bits itself and
sorts what it has. Every variant is still met at one place. Leading parts in which
very many fingerprints meet (a large group of near copies has almost the same bits)
are split further by a check sum over the low bits of the variants, which deals
the variants of any set of fingerprints evenly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, give_back, groups, keyed_texts, map_slices, mark_of, partitions, utf8_values
from .components import least_labels, one_of_each

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: For a byte, eight bytes that hold its bits, the lowest bit first.
_SPREAD = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], "<u8")
BITS = 64


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """The SimHash of a UTF-8 text over its shingles of so many words, repeats included.

    A bit is set if it is in over half of the shingles' XXH64. With fewer words than
    a shingle has, all of them are the one shingle; without a word it is zero.
    """
    found = text.translate(LOWER).split()  # bytes.split() parts at \x20 and \x09-\x0d
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    if n == 1:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]]).tolist()
        shingles = map(joined.__getitem__, map(slice, starts, (ends[words - 1 :] - 1).tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    return bits_over_half(hashes)


def bits_over_half(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    columns = np.ascontiguousarray(hashes).view(np.uint8).reshape(n, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 255):  # byte-wide counters hold up to 255
        for k in range(8):
            counts[8 * k : 8 * k + 8] += np.add.reduce(_SPREAD[columns[at : at + 255, k]]).reshape(1).view(np.uint8)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > n))


def _prints(texts: DataFrame, words: int, seed: int, schema: str) -> DataFrame:
    def setup():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, words, seed) for t in utf8_values(batch.column(1))], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

        return run

    return map_slices(texts, setup, schema)


def fingerprints(docs: DataFrame, *, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of each row; fp is the fingerprint as a signed long."""
    return _prints(keyed_texts(docs, id_col, text_col), words, seed, "doc_id long, fp long")


def flips(bits: list[int], most: int) -> np.ndarray:
    """Every XOR pattern of at most ``most`` of the bits."""
    return np.array([sum(1 << b for b in some) for k in range(most + 1) for some in combinations(bits, k)], np.uint64)


def _checks(values: np.ndarray, bits: int) -> np.ndarray:
    """A linear check sum of the low bits: equal variants have equal ones, single flips all differ."""
    out = np.zeros(len(values), np.uint64)
    for i in range(bits):
        out ^= ((values >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return out


class Balls:
    """How the variants of fingerprints are dealt."""

    #: Check sums of fewer than 64 low bits.
    PLACES = 64

    def __init__(self, distance: int, leading: int):
        self.distance, self.radius, self.low = distance, -(-distance // 2), BITS - leading
        self.high = flips(list(range(self.low, BITS)), self.radius)
        self.of_low = [flips(list(range(self.low)), k) for k in range(self.radius + 1)]
        self.check_of_low = [_checks(f, self.low) for f in self.of_low]

    def parts(self, fps: np.ndarray) -> np.ndarray:
        """The leading parts of each fingerprint's variants, one row for each fingerprint."""
        return (fps[:, None] ^ self.high[None, :]) >> np.uint64(self.low)

    def links(self, parts: np.ndarray, fps: np.ndarray, check: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of fingerprints that share a variant with their leading part (and this check sum).

        In a group that shares a variant, each is paired with the smallest: any two of
        the group are linked, so pairs with one of them keep the component whole.
        """
        used = np.bitwise_count((fps >> np.uint64(self.low)) ^ parts)
        base = (parts << np.uint64(self.low)) | (fps & np.uint64((1 << self.low) - 1))
        sums = None if check is None else _checks(base, self.low) ^ np.uint64(check)
        variants, owners = [], []
        for k in range(self.radius + 1):
            mine = np.flatnonzero(used == k)
            patterns, of = self.of_low[self.radius - k], self.check_of_low[self.radius - k]
            for s in [None] if sums is None else np.unique(sums[mine]):
                some, fit = (mine, patterns) if s is None else (mine[sums[mine] == s], patterns[of == s])
                variants.append((base[some][:, None] ^ fit[None, :]).ravel())
                owners.append(np.repeat(some, len(fit)))
        return self._shared(np.concatenate(variants), np.concatenate(owners), fps)

    def _shared(self, variants: np.ndarray, owners: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(variants)
        v = variants[order]
        start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else np.zeros(0, np.int64)
        size = np.diff(np.r_[start, len(v)])
        who = fps[owners[order][np.repeat(size > 1, size)]]
        size = size[size > 1]
        if not len(size):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        least = np.repeat(np.minimum.reduceat(who, np.r_[0, np.cumsum(size)[:-1]]), size)
        pairs = np.unique(np.stack([who, least], axis=1), axis=0)
        a, b = pairs[:, 0], pairs[:, 1]
        true = (a != b) & (np.bitwise_count(a ^ b) <= self.distance)
        return a[true], b[true]


def near_links(fps: DataFrame, *, distance: int = 4, leading: int | None = None, hot: int = 50_000) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough of them to connect all within ``distance`` bits.

    fps has one row for each distinct fp. ``leading``: bits that variants are dealt by;
    by default they grow with the logarithm of the count, so that a leading part meets
    about as many fingerprints at any size. ``hot``: a leading part with more rows is
    dealt to 64 places by check sums.
    """
    if leading is None:
        leading = min(24, max(6, (fps.count() // 256).bit_length()))
    balls = Balls(distance, leading)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                own = batch.column(0).slice(at, 5_000).to_numpy(zero_copy_only=False).view(np.uint64)
                parts = balls.parts(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts.ravel().astype(np.int32)), pa.array(np.repeat(own, parts.shape[1]).view(np.int64))], ["part", "fp"]
                )

    dealt = fps.select("fp").mapInArrow(deal, "part int, fp long")
    crowded = dealt.groupBy("part").count().where(F.col("count") > hot).select("part", F.lit(True).alias("crowded"))
    # up to 65,536 parts the table has a bound whatever the data are; beyond it, Spark sees its size and decides
    marked = dealt.join(F.broadcast(crowded) if leading <= 16 else crowded, "part", "left")
    every = F.sequence(F.lit(0), F.lit(Balls.PLACES - 1))
    places = marked.select("part", "fp", F.explode(F.when(F.col("crowded"), every).otherwise(F.array(F.lit(-1)))).alias("place"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, own, place in _whole_groups(batches):
            a, b = balls.links(parts, own, None if place < 0 else place)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
        give_back()

    met = places.repartition(partitions(fps.sparkSession), "part", "place").sortWithinPartitions("place", "part")
    return met.mapInArrow(meet, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 30_000) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(parts, fingerprints, place) in blocks that end with a group; rows come sorted by place and part.

    A block has one group of a place, or at least ``rows`` rows of parts that are not crowded.
    """
    part, fp, place = (np.zeros(0, np.int64) for _ in range(3))
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        part, fp, place = (np.concatenate(x) for x in zip((part, fp, place), new, strict=True))
        while len(part) > rows or (len(part) and place[-1] >= 0):
            ends = np.flatnonzero((part[1:] != part[:-1]) | (place[1:] != place[:-1])) + 1
            ends = ends[:1] if place[0] >= 0 else ends[: max(1, np.searchsorted(ends, rows))][-1:]
            if not len(ends):
                break
            if place[0] < 0:
                ends = np.minimum(ends, np.searchsorted(place, 0)) if place[-1] >= 0 else ends
            n = int(ends[0])
            yield part[:n].astype(np.uint64), fp[:n].view(np.uint64), int(place[0])
            part, fp, place = part[n:], fp[n:], place[n:]
    while len(part):
        n = int(np.searchsorted(place, 0)) if place[0] < 0 else int(np.argmax(np.r_[(part != part[0]) | (place != place[0]), True]))
        yield part[:n].astype(np.uint64), fp[:n].view(np.uint64), int(place[0])
        part, fp, place = part[n:], fp[n:], place[n:]


# --- wide prints, for pairs that differ in more bits than whole balls can have -----

#: A wide print has so many bits; balls are made in each block of so many.
WIDE, BLOCK = 512, 32
_SALTS = np.array([0x9E3779B97F4A7C15 * (k + 1) % 2**64 for k in range(WIDE // 64)], np.uint64)


def wide_print(hashes: np.ndarray) -> bytes:
    """512 bits, each set if over half of the hashes have it; each of 64 is a mix of a hash and its own salt."""
    counts = np.zeros(WIDE, np.int64)
    for at in range(0, len(hashes), 255):  # byte-wide counters hold up to 255
        h = hashes[at : at + 255, None] ^ _SALTS[None, :]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.add.reduce(np.unpackbits((h ^ (h >> np.uint64(32))).view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values."""
    h = (values ^ (values >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def block_links(prints: DataFrame, *, leading: int | None = None) -> DataFrame:
    """(a, b), a < b: pairs of nodes of (node, print), one row each, whose wide prints differ in at most two bits of some block.

    A block of 32 bits has 33 variants within one bit, and two blocks that differ in at
    most two bits share one. Rows are dealt by block and ``leading`` bits of the
    variants, and the other bits are flipped where they meet, as for whole prints. Nodes with
    equal blocks are paired with the smallest of them, which alone makes variants; of all that
    share variants with it in the place where they meet, it is paired with the one that comes
    first in an order of the block's own. So a node makes one pair for each block and place at
    most, however many are near it, and a crowd has another first node in each block. In a
    crowd not all pairs that meet are paired; which of them are similar is left to an exact step.
    Sets of similarity 0.8, 0.85 and 0.9 meet in one of the 16 blocks in about 86, 97 and
    over 99 of 100 cases: these are candidates, to be verified, and some are missed.
    """
    if leading is None:
        leading = min(16, max(5, (prints.count() >> 13).bit_length()))
    low = BLOCK - leading
    high = flips(list(range(leading)), 1)
    spread = flips(list(range(low)), 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                own = batch.slice(at, 1_000)
                blocks = np.frombuffer(b"".join(own.column(1).to_pylist()), ">u4").reshape(own.num_rows, -1).astype(np.uint64)
                place = (np.arange(blocks.shape[1], dtype=np.uint64) << np.uint64(leading))[None, :, None]
                keys = place | (blocks >> np.uint64(low))[:, :, None] ^ high[None, None, :]
                each = keys.shape[1] * keys.shape[2]
                columns = keys.ravel().astype(np.int32), np.repeat(blocks.ravel().astype(np.uint32).view(np.int32), keys.shape[2]), np.repeat(own.column(0).to_numpy(), each)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "block", "node"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block, node in groups(batches):
            key, block = key.astype(np.uint64), block.view(np.uint32).astype(np.uint64)
            order = np.lexsort((node, block, key))
            key, block, node = key[order], block[order], node[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
            least = np.repeat(node[first], np.diff(np.r_[first, len(node)]))
            own = (least < node) & (key & np.uint64((1 << leading) - 1) == block >> np.uint64(low))
            equal = np.stack([least[own], node[own]], axis=1)
            key, block, node = key[first], block[first], node[first]  # one node for each block of bits makes its variants
            part = key & np.uint64((1 << leading) - 1)
            base = (key << np.uint64(low)) | (block & np.uint64((1 << low) - 1))
            same = part == block >> np.uint64(low)
            rank = _mixed((key >> np.uint64(leading) << np.uint64(BLOCK)) | block)  # differs for all blocks of bits of a place
            variants = np.concatenate([base[~same], (base[same][:, None] ^ spread[None, :]).ravel()])
            owners = np.concatenate([np.flatnonzero(~same), np.repeat(np.flatnonzero(same), len(spread))])
            order = np.argsort(variants)
            v, who = variants[order], owners[order]
            start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            lead = rank.copy()
            np.minimum.at(lead, who, np.repeat(np.minimum.reduceat(rank[who], start), np.diff(np.r_[start, len(v)])))
            by_rank = np.argsort(rank)
            lead = node[by_rank[np.searchsorted(rank[by_rank], lead)]]  # a block of bits has the same node in all its parts
            other = lead != node
            near = np.stack([np.minimum(lead, node)[other], np.maximum(lead, node)[other]], axis=1)
            pairs = np.unique(np.concatenate([equal, near]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(2)], ["a", "b"])
        give_back()

    dealt = prints.select("node", "print").mapInArrow(deal, "key int, block int, node long")
    met = dealt.repartition(partitions(prints.sparkSession), "key").sortWithinPartitions("key")
    return met.mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, *, words: int = 4, seed: int = 42, distance: int = 4, leading: int | None = None, hot: int = 50_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row.

    component_id is the smallest doc_id that a row reaches over links between
    fingerprints which differ in at most ``distance`` bits; rows with one
    fingerprint (copies, empty and null texts) are linked. A null id takes part in
    links but is never a component_id, unless all ids of the component are null. An
    empty table gives no rows.

    Only distinct fingerprints are dealt, so copies cost nothing, however many.
    """
    prints = checkpointed(fingerprints(docs, words=words, seed=seed, id_col=id_col, text_col=text_col))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = near_links(distinct, distance=distance, leading=leading, hot=hot)
    least = least_labels(distinct.withColumnRenamed("fp", "node"), links, "first_id").select(F.col("node").alias("fp"), F.col("least").alias("component_id"))
    return prints.join(least, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each_group(
    docs: DataFrame, *, words: int = 4, seed: int = 42, distance: int = 4, leading: int | None = None, hot: int = 50_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs, one for each group of near-duplicates, as ``one_of_each`` says."""
    marked = keyed_texts(docs, id_col, text_col).select(F.struct("doc_id", mark_of(F.col("text")).alias("mark")).alias("doc_id"), "text")
    prints = checkpointed(_prints(marked, words, seed, "doc_id struct<doc_id: bigint, mark: binary>, fp long"))
    nodes = prints.select("doc_id.doc_id", "doc_id.mark", F.col("fp").alias("node"))
    links = near_links(nodes.select(F.col("node").alias("fp")).distinct(), distance=distance, leading=leading, hot=hot)
    return one_of_each(docs, nodes, links, id_col, text_col)
