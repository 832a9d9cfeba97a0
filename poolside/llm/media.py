"""Finding cropped and edited copies of images by local descriptors.

Corners are found at several scales; each gets an orientation from the centre of
mass of its patch, and binary brightness tests turned to that orientation. Six
tables are keyed by two quarters of the tests, and corners that meet in a table and
differ in few bits match. Two images are linked if enough matches agree on one
change of scale, rotation and place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, give_back, partitions
from .components import components, least_labels

RADIUS, TESTS = 9, 128
POINT = "struct<place: bigint, d0: bigint, d1: bigint>"


# --- images made from vectors ---------------------------------------------------


def drawn(vector: np.ndarray, cells: int = 8, block: int = 4) -> np.ndarray:
    """A grey picture of a vector: each number and its neighbours shade four blocks."""
    v = np.zeros(cells * cells)
    v[: min(len(vector), len(v))] = vector[: len(v)]
    level = np.clip(np.floor(v / (np.abs(v).mean() + 1e-9)), -2, 1).astype(np.int64).reshape(cells, cells) + 2
    code = np.arange(cells * cells).reshape(cells, cells) * 64 + level * 16 + np.roll(level, -1, 0) * 4 + np.roll(level, -1, 1)
    quarter = np.repeat(np.repeat(code, 2, 0), 2, 1) * 4 + np.indices((2 * cells, 2 * cells)).sum(0) % 2 + 2 * (np.indices((2 * cells, 2 * cells))[0] % 2)
    mixed = (quarter.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return np.repeat(np.repeat((mixed % np.uint64(216)).astype(np.uint8) + 20, block, 0), block, 1)


def images_of(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", variants: bool = True) -> DataFrame:
    """(image_id, variant, height, width, pixels): a picture of each vector.

    With ``variants``, every tenth id has a cropped copy besides, and every tenth plus
    five one with changed brightness and contrast. image_id is four times the vector's
    id plus the variant. Null vectors give empty pictures.
    """

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for id_, vector in zip(frame["id"], frame["vector"], strict=True):
                image = np.zeros((0, 0), np.uint8) if vector is None else drawn(np.nan_to_num(np.array([np.nan if x is None else x for x in vector], float)))
                made = [(0, image)]
                if variants and not pd.isna(id_) and image.size:
                    if int(id_) % 10 == 0:
                        made.append((1, image[6:58, 9:60]))
                    elif int(id_) % 10 == 5:
                        made.append((2, np.clip(image * 0.8 + 25, 0, 255).astype(np.uint8)))
                out += [(None if pd.isna(id_) else 4 * int(id_) + k, k, *i.shape, np.ascontiguousarray(i).tobytes()) for k, i in made]
            named = pd.DataFrame(out, columns=["image_id", "variant", "height", "width", "pixels"])
            yield named.assign(image_id=named["image_id"].astype("Int64"))

    picked = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return picked.mapInPandas(draw, "image_id long, variant int, height int, width int, pixels binary")


# --- descriptors ------------------------------------------------------------------


def _blur(images: np.ndarray) -> np.ndarray:
    """A small binomial blur of a stack of pictures."""
    p = np.pad(images, ((0, 0), (1, 1), (1, 1)), mode="edge")
    rows = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return (rows[:, :, :-2] + 2 * rows[:, :, 1:-1] + rows[:, :, 2:]) / 16


def _resized(images: np.ndarray, scale: float) -> np.ndarray:
    """Bilinear, scale below one."""
    h, w = int(images.shape[1] * scale), int(images.shape[2] * scale)
    y, x = np.minimum(np.arange(h) / scale, images.shape[1] - 1), np.minimum(np.arange(w) / scale, images.shape[2] - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, images.shape[1] - 1), np.minimum(x0 + 1, images.shape[2] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    top, bottom = images[:, y0], images[:, y1]
    return (top[:, :, x0] * (1 - fx) + top[:, :, x1] * fx) * (1 - fy) + (bottom[:, :, x0] * (1 - fx) + bottom[:, :, x1] * fx) * fy


@lru_cache(1)
def _tests() -> tuple[np.ndarray, np.ndarray]:
    """Fixed pairs of places in the unit disc, drawn from a seeded normal distribution."""
    draw = np.random.RandomState(20).normal(0, RADIUS / 2.2, (TESTS, 2, 2))
    far = np.maximum(1, np.hypot(draw[..., 0], draw[..., 1]) / (RADIUS - 1))
    draw /= far[..., None]
    return draw[:, 0], draw[:, 1]


def keypoints(images: np.ndarray, *, apart: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the picture, (x, y, level, angle), descriptor bytes) of every corner of a stack of pictures of one size.

    Each level is smaller than the one before by a half octave, down to the last that
    has room for a patch. A corner is the strongest place within ``apart`` pixels, so
    their number grows with the area of a picture and none is left out.
    """
    a, b = _tests()
    grid = np.arange(-RADIUS, RADIUS + 1)
    disc = (grid[:, None] ** 2 + grid[None, :] ** 2 <= RADIUS**2).astype(float)
    found = [(np.zeros(0, int), np.zeros((0, 4)), np.zeros((0, TESTS // 8), np.uint8))]
    plain, number = images.astype(float), 0
    while min(int(n * 2 ** (-number / 2)) for n in images.shape[1:]) >= 2 * RADIUS + 4:
        scale = 2 ** (-number / 2)
        level = _blur(plain if number == 0 else _resized(plain, scale))
        gy, gx = np.gradient(level, axis=(1, 2))
        xx, yy, xy = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        corner = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        h, w = corner.shape[1:]
        around = np.pad(corner, ((0, 0), (apart, apart), (apart, apart)), constant_values=-np.inf)
        around = np.maximum.reduce([around[:, k : k + h] for k in range(2 * apart + 1)])
        around = np.maximum.reduce([around[:, :, k : k + w] for k in range(2 * apart + 1)])
        inner = (slice(None), slice(RADIUS + 1, h - RADIUS - 1), slice(RADIUS + 1, w - RADIUS - 1))
        of, ys, xs = np.nonzero((corner[inner] >= around[inner]) & (corner[inner] > 1e-3))
        for at in range(0, len(of), 20_000):
            i, y0, x0 = of[at : at + 20_000], ys[at : at + 20_000] + RADIUS + 1, xs[at : at + 20_000] + RADIUS + 1
            patches = level[i[:, None, None], y0[:, None, None] + grid[None, :, None], x0[:, None, None] + grid[None, None, :]] * disc
            angle = np.arctan2((patches * grid[None, :, None]).sum((1, 2)), (patches * grid[None, None, :]).sum((1, 2)))
            cos, sin = np.cos(angle)[:, None], np.sin(angle)[:, None]

            def turned(p: np.ndarray, level=level, i=i, y0=y0, x0=x0, cos=cos, sin=sin) -> np.ndarray:
                x, y = p[None, :, 0] * cos - p[None, :, 1] * sin, p[None, :, 0] * sin + p[None, :, 1] * cos
                return level[i[:, None], y0[:, None] + np.rint(y).astype(int), x0[:, None] + np.rint(x).astype(int)]

            bits = np.packbits(turned(a) < turned(b), axis=1)
            found.append((i, np.stack([x0 / scale, y0 / scale, np.full(len(i), number), angle], axis=1), bits))
        number += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


#: A place is one long: x and y in quarter pixels, the level, and the angle in 1024ths of a turn.
X, Y, LEVEL, ANGLE = (0, 20), (20, 20), (40, 5), (45, 10)
MOST_PIXELS = 1 << 18


def _field(place: np.ndarray, field: tuple[int, int]) -> np.ndarray:
    return (place >> field[0]) & ((1 << field[1]) - 1)


def places(points: np.ndarray) -> np.ndarray:
    """Rows of (x, y, level, angle) as longs."""
    x, y, level, angle = points.T
    turn = np.rint(angle / (2 * np.pi) * 1024).astype(np.int64) % 1024
    return np.rint(4 * x).astype(np.int64) | (np.rint(4 * y).astype(np.int64) << Y[0]) | (level.astype(np.int64) << LEVEL[0]) | (turn << ANGLE[0])


def described(images: DataFrame) -> DataFrame:
    """(image_id, content, points) of (image_id, height, width, pixels): its digest and the corners of each picture.

    Pictures are described where they are read, so that pixels are never shuffled;
    those of one size together, about a million pixels at a time. A picture may have
    up to 262,143 pixels a side.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("height", "width", "pixels")), strict=True))
            sizes: dict[tuple[int, int], list[int]] = {}
            for k, (h, w, pixels) in enumerate(rows):
                if pixels:
                    if max(h, w) >= MOST_PIXELS:
                        raise ValueError(f"a picture of {h} x {w} pixels")
                    sizes.setdefault((h, w), []).append(k)
            owner, points, bits = [np.zeros(0, int)], [np.zeros((0, 4))], [np.zeros((0, TESTS // 8), np.uint8)]
            for (h, w), own in sizes.items():
                step = max(1, 1_000_000 // (h * w))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    which, where, tests = keypoints(np.stack([np.frombuffer(rows[k][2], np.uint8).reshape(h, w) for k in some]))
                    owner.append(np.array(some)[which])
                    points.append(where)
                    bits.append(tests)
            order = np.argsort(np.concatenate(owner), kind="stable")
            ends = np.searchsorted(np.concatenate(owner)[order], np.arange(len(rows) + 1)).astype(np.int32)
            tests = np.ascontiguousarray(np.concatenate(bits)[order]).view(">i8").astype(np.int64).reshape(-1, 2)
            fields = {"place": places(np.concatenate(points)[order]), "d0": tests[:, 0], "d1": tests[:, 1]}
            structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v)) for v in fields.values()], names=list(fields))
            digests = pa.array([bytes.fromhex(content_of(h, w, pixels or b"")) for h, w, pixels in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("image_id"), digests, pa.ListArray.from_arrays(pa.array(ends), structs)], names=["image_id", "content", "points"])
            give_back()

    picked = images.select(F.col("image_id").cast("long").alias("image_id"), F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), F.col("pixels").cast("binary").alias("pixels"))
    return picked.mapInArrow(look, f"image_id long, content binary, points array<{POINT}>")


# --- tables of quarters -------------------------------------------------------------

#: The quarters of a descriptor, two by two: a table for each pair.
PAIRS = tuple(combinations(range(4), 2))
OTHERS = tuple(tuple(k for k in range(4) if k not in pair) for pair in PAIRS)
PAIR = (55, 3)
ROWS = "key long, node long, place long, rest long"


def _first_tables() -> np.ndarray:
    """The first table in which two descriptors meet, by a table that they meet in and whether either of the other quarters is equal too."""
    out = np.zeros((len(PAIRS), 2, 2), int)
    for p, (pair, (k, m)) in enumerate(zip(PAIRS, OTHERS, strict=True)):
        for x in (0, 1):
            for y in (0, 1):
                equal = {*pair, *([k] if x else []), *([m] if y else [])}
                out[p, x, y] = next(i for i, q in enumerate(PAIRS) if set(q) <= equal)
    return out


FIRST_TABLE = _first_tables()


def tabled(contents: DataFrame) -> DataFrame:
    """Six rows for each corner of (node, points): in each table its key is two quarters of the descriptor, rest the others; place says which."""
    corners = contents.select("node", F.explode("points").alias("p")).select("node", "p.*")
    low = F.lit(0xFFFFFFFF).cast("long")
    quarter = [F.shiftrightunsigned("d0", 32), F.col("d0").bitwiseAND(low), F.shiftrightunsigned("d1", 32), F.col("d1").bitwiseAND(low)]
    both = lambda i, j: F.shiftleft(quarter[i], 32).bitwiseOR(quarter[j])
    tables = (F.struct(both(*pair).alias("key"), both(*other).alias("rest"), F.col("place").bitwiseOR(F.lit(k << PAIR[0]).cast("long")).alias("place")) for k, (pair, other) in enumerate(zip(PAIRS, OTHERS, strict=True)))
    return corners.select("node", F.explode(F.array(*tables)).alias("t")).select("t.key", "node", "t.place", "t.rest")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns in blocks that end with a group of one key; rows come sorted by it."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(new[0]):
            continue
        change = np.flatnonzero(new[0][1:] != new[0][:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if not cut and held and held[-1][0][-1] != new[0][0]:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held = []
        if cut:
            held.append([c[:cut] for c in new])
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held = []
        held.append([c[cut:] for c in new])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _in_group(node: np.ndarray, place: np.ndarray, rest: np.ndarray, root: np.ndarray, distance: int, leaders: int | None) -> Iterator[np.ndarray]:
    """(a, b, at_a, at_b) in rows: the matches among corners of one key, in blocks."""
    lead = np.arange(len(node))
    if leaders is not None:
        names, of = np.unique(node, return_inverse=True)
        mixed = (names.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        by_name = np.argsort(mixed, kind="stable")
        roots = root[np.unique(of, return_index=True)[1]][by_name]
        chosen = by_name[np.sort(np.unique(roots, return_index=True)[1])[:leaders]]
        lead = np.flatnonzero(np.isin(of, chosen))
    pair = _field(place, PAIR)
    where = place & ((1 << PAIR[0]) - 1)
    step = max(1, 500_000 // len(lead))
    for at in range(0, len(node), step):
        x = slice(at, at + step)
        i, j = np.nonzero((root[x][:, None] != root[lead][None, :]) & (pair[x][:, None] == pair[lead][None, :]))
        i, j = i + at, lead[j]
        differ = rest[i] ^ rest[j]
        first = FIRST_TABLE[pair[i], ((differ >> np.uint64(32)) == 0).astype(int), ((differ & np.uint64(0xFFFFFFFF)) == 0).astype(int)]
        ok = (np.bitwise_count(differ) <= distance) & (first == pair[i])
        i, j = i[ok], j[ok]
        i, j = np.where(node[i] > node[j], j, i), np.where(node[i] > node[j], i, j)
        yield np.stack([node[i], node[j], where[i], where[j]], axis=1)


def matched(rows: DataFrame, *, distance: int, small: int, leaders: int | None, keep_crowded: bool = False) -> DataFrame:
    """(crowded false, a, b, at_a, at_b, lead 0): corners of contents a < b that share a key, differ in at most ``distance`` bits, and have different roots.

    rows: (key, node, place, rest), and ``root``, else each node is its own. A match is
    given once, in the first table that both are in. With ``leaders``, keys of over
    ``small`` rows match each corner only with those of one content of each root, of at
    most so many roots: the ones whose mixed names are smallest, so that keys with the
    same contents have the same leaders. ``keep_crowded`` gives the rows of such keys besides, as
    (crowded true, key, node, place, rest, lead); lead is one node of the key, the same for all its rows.
    """
    has_root = "root" in rows.columns

    def batch_of(found: list[np.ndarray], crowded: bool) -> pa.RecordBatch:
        out = np.concatenate([np.zeros((0, 5 if crowded else 4), np.int64), *found])
        out = out if crowded else np.pad(np.unique(out, axis=0), ((0, 0), (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(out), crowded)), *(pa.array(np.ascontiguousarray(out[:, k])) for k in range(5))], names=["crowded", "a", "b", "at_a", "at_b", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            key, node, place, rest = block[:4]
            root = block[4] if has_root else node
            ends = [*(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            starts = np.array([0, *ends[:-1]])
            several = np.minimum.reduceat(root, starts) < np.maximum.reduceat(root, starts)
            found, kept, size = [], [], 0
            for k in np.flatnonzero(several).tolist():
                own = slice(int(starts[k]), ends[k])
                many = ends[k] - starts[k] > small
                for pairs in _in_group(node[own], place[own], rest[own].view(np.uint64), root[own], distance, leaders if many else None):
                    found.append(pairs)
                    size += len(pairs)
                if many and keep_crowded:
                    mixed = (node[own].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                    lead = np.full(len(mixed), node[own][np.argmin(mixed)])
                    kept.append(np.stack([key[own], node[own], place[own], rest[own], lead], axis=1))
                if size > 100_000:
                    yield batch_of(found, False)
                    found, size = [], 0
            yield batch_of(found, False)
            yield batch_of(kept, True)
        give_back()

    picked = rows.select("key", "node", "place", "rest", *(["root"] if has_root else []))
    dealt = picked.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "crowded boolean, a long, b long, at_a long, at_b long, lead long")


def linked(matches: DataFrame, *, agree: int = 4) -> DataFrame:
    """(a, b): pairs of contents with at least ``agree`` matches on one change of scale, rotation and place.

    Changes are counted in overlapping boxes, each match in the nearest box and its
    neighbour, so that a border does not part matches that agree. Corners of a that
    lie at one place count once.
    """
    field = lambda c, f: F.shiftright(c, f[0]).bitwiseAND(F.lit((1 << f[1]) - 1).cast("long"))
    of = {f"{s}{n}": field(f"at_{s}", f) for s in "ab" for n, f in (("x", X), ("y", Y), ("level", LEVEL), ("angle", ANGLE))}
    parts = matches.distinct().select("a", "b", *((v / 4 if k[1:] in ("x", "y") else v).alias(f"_{k}") for k, v in of.items()))
    turn = F.pmod(F.col("_bangle") - F.col("_aangle"), F.lit(1024)) * (2 * math.pi / 1024)
    ratio = F.pow(F.lit(2.0), (F.col("_blevel") - F.col("_alevel")) / 2)
    # a place in a, turned and scaled, lies at a shifted place in b
    dx = F.col("_bx") - ratio * (F.col("_ax") * F.cos(turn) - F.col("_ay") * F.sin(turn))
    dy = F.col("_by") - ratio * (F.col("_ax") * F.sin(turn) + F.col("_ay") * F.cos(turn))
    both = lambda v: F.array(F.floor(v / 8), F.floor(v / 8 + 0.5) + 10_000_000)
    moved = parts.select("a", "b", (F.col("_blevel") - F.col("_alevel")).alias("zoom"), F.pmod(F.round(turn / 0.26), F.lit(24)).alias("turn"), dx.alias("dx"), dy.alias("dy"), F.round("_ax").alias("x"), F.round("_ay").alias("y"))
    boxed = moved.select("a", "b", "zoom", "turn", F.explode(both(F.col("dx"))).alias("dx"), "dy", "x", "y").select("a", "b", "zoom", "turn", "dx", F.explode(both(F.col("dy"))).alias("dy"), "x", "y")
    spots = boxed.distinct()
    counted = spots.groupBy("a", "b", "zoom", "turn", "dx", "dy").agg(F.count("x").alias("n")).where(F.col("n") >= agree)
    return counted.select("a", "b").distinct()


def image_links(contents: DataFrame, *, distance: int = 12, agree: int = 4, small: int = 16, leaders: int = 4) -> DataFrame:
    """(a, b): links between contents (node, points), enough of them to connect all that ``agree`` matches link.

    Keys of over ``small`` rows are first matched with leaders, twice; what is connected
    then need not be compared again. All other pairs are, and their matches are
    counted together with those found before, so no link between components is lost. A
    key all of whose pictures are connected has no such pair, and its rows go no further.
    """
    both = checkpointed(matched(tabled(contents), distance=distance, small=small, leaders=leaders, keep_crowded=True))
    found = both.where("not crowded").drop("crowded", "lead")
    crowded = both.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("node"), F.col("at_a").alias("place"), F.col("at_b").alias("rest"), "lead")
    links = checkpointed(linked(found, agree=agree))
    if not crowded.isEmpty():
        # one row for each picture and lead: pictures of a key are connected if each is connected with its lead
        pictures = checkpointed(crowded.groupBy("node", "lead").agg(F.collect_set("key").alias("keys")))
        for most in (leaders, None):
            roots = checkpointed(components(links))
            of = lambda c, r: roots.select(F.col("node").alias(c), F.col("root").alias(r))  # noqa: E731, B023
            apart = pictures.join(of("node", "root"), "node", "left").join(of("lead", "its"), "lead", "left").where(F.coalesce("root", "node") != F.coalesce("its", "lead"))
            open_rows = checkpointed(crowded.drop("lead").join(apart.select(F.explode("keys").alias("key")).distinct(), "key", "left_semi"))
            rooted = open_rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            found = found.unionByName(checkpointed(matched(rooted, distance=distance, small=small, leaders=most)).drop("crowded", "lead"))
            links = checkpointed(linked(found, agree=agree))
    return links


def image_classes(images: DataFrame, *, id_col: str = "image_id", **options) -> DataFrame:
    """(image_id, content_sha256, class_id) of each row.

    Two contents are linked if at least four of their corners match and agree on one
    change; corners match that share two quarters of the descriptor and differ in at
    most 12 of 128 bits. class_id is the smallest image_id reachable over links. Equal pixels
    are one content, compared once, however many rows have it. Null or empty pictures
    are one content without links. Repeated rows and null ids are kept (a null id is a class_id
    only if the class has no other); an empty table gives no rows.
    """
    seen = checkpointed(described(images.select(F.col(id_col).alias("image_id"), "height", "width", "pixels")))
    per = seen.groupBy("content").agg(F.min("image_id").alias("least"), F.first("points").alias("points"))
    contents = checkpointed(per.select("content", "least", F.xxhash64("content").alias("node"), "points"))
    classes = least_labels(contents.select("node", "least"), image_links(contents.select("node", "points"), **options), "least").withColumnRenamed("least", "class_id")
    known = contents.select("content", "node").join(classes, "node").select("content", "class_id")
    return seen.select("image_id", "content").join(known, "content").select("image_id", F.lower(F.hex("content")).alias("content_sha256"), "class_id")


def content_of(height: int | None, width: int | None, pixels: bytes) -> str:
    """The content_sha256 of a picture; without pixels, sizes do not count."""
    height, width = (height, width) if pixels else (0, 0)
    return hashlib.sha256(f"{height}x{width}:".encode() + pixels).hexdigest()

