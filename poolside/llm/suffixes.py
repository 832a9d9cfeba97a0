"""Removing long passages that repeat across documents, byte by byte.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document
with a smaller id. All such strings are found with sorted suffixes:

1. *Sampling.* Of each string of ``length`` bytes, the places where the least hash of
   its ``gram``-byte substrings stands are anchors. Equal strings have the same
   anchors, so any repeat shows as two suffixes that start at anchors and share a
   prefix of ``gram`` bytes.
2. *Fingerprints.* Sorted, delta-coded fingerprints of those prefixes are exchanged
   first. A suffix whose prefix occurs in one document only can't matter and is
   never sent (the duplicate detection of distributed string sorting by prefix
   doubling). Fingerprints only rule suffixes out; what follows compares bytes.
3. *Merge sort.* Each chunk of documents sorts its remaining suffixes, front-codes
   the run (length of the prefix shared with the suffix before, and the rest), and
   cuts it at splitters. Each range of suffixes merges its runs with a loser tree
   that carries common-prefix lengths, so that known prefixes are not compared again.
4. Suffixes next to each other in merged order tell which strings are shared, and
   the smallest id that has them. Marks go back to the chunks, which cut the bytes.

Exact copies are settled before: all but the first of equal texts lose every byte.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, fresh_table, give_back, keyed_texts, partitions

MIX, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 16
#: Fingerprints exchanged have so many bits.
PRINT_BITS = 48
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


class Sampler:
    """Anchors of a text."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.window = length, gram, length - gram + 1

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of the gram-byte substring at each place, built from powers of two."""
        powers = {1: (data.astype(np.uint64) + np.uint64(1), STEP)}
        n = 1
        while 2 * n <= self.gram:
            h, m = powers[n]
            powers[2 * n] = (h[:-n] * m + h[n:], m * m)
            n *= 2
        out, done = powers[n][0], n
        while done < self.gram:
            n = 1 << ((self.gram - done).bit_length() - 1)
            h, m = powers[n]
            count = len(data) - done - n + 1
            out, done = out[:count] * m + h[done : done + count], done + n
        out = (out ^ (out >> np.uint64(29))) * MIX
        return out ^ (out >> np.uint64(32))

    @staticmethod
    def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
        n = 1
        while 2 * n <= width:
            values, n = pick(values[:-n], values[n:]), 2 * n
        if n < width:
            values = pick(values[: len(values) - (width - n)], values[width - n :])
        return values

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors, ascending."""
        if len(text) < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        data = np.frombuffer(text, np.uint8)
        places, hashes = [], []
        with np.errstate(over="ignore"):
            for at in range(0, len(data) - self.length + 1, BLOCK):  # blocks share length - 1 bytes: every string lies in one
                h = self._hashes(data[at : at + BLOCK + self.length - 1])
                least = self._slide(h, self.window, np.minimum)
                edge = np.zeros(self.window - 1, np.uint64)
                found = np.flatnonzero(self._slide(np.concatenate([edge, least, edge]), self.window, np.maximum) == h)
                places.append(found + at)
                hashes.append(h[found])
        p, h = np.concatenate(places), np.concatenate(hashes)
        if len(places) > 1:
            p, first = np.unique(p, return_index=True)
            h = h[first]
        return p, h


# --- front-coded runs ---------------------------------------------------------


def front_code(suffixes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Shared-prefix lengths, and the rests, of sorted rows of bytes."""
    n, width = suffixes.shape
    shared = np.zeros(n, np.uint8)
    if n > 1:
        differ = suffixes[1:] != suffixes[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return shared, suffixes[np.arange(width)[None, :] >= shared[:, None]].tobytes()


class Run:
    """Reads a front-coded run: the next suffix, and the prefix it shares with the one before."""

    def __init__(self, shared: np.ndarray, rests: bytes, width: int, entries: range):
        self.shared, self.rests, self.width, self.entries = shared.tolist(), rests, width, entries
        self.at, self.next, self.now = 0, 0, b""

    def advance(self) -> int:
        """The common prefix of the new suffix with the last; -1 at the end."""
        if self.next == len(self.shared):
            return -1
        lcp = self.shared[self.next]
        self.now = self.now[:lcp] + self.rests[self.at : self.at + self.width - lcp]
        self.at += self.width - lcp
        self.next += 1
        return lcp


def _common(a: bytes, b: bytes, known: int) -> int:
    """The common prefix of a and b, of which known bytes are known."""
    x = int.from_bytes(a[known:], "big") ^ int.from_bytes(b[known:], "big")
    return len(a) - (x.bit_length() + 7) // 8


def merged(runs: list[Run]) -> Iterator[tuple[int, bytes, int]]:
    """(common prefix with the suffix before, suffix, entry) of all runs in order.

    A loser tree whose nodes know the loser's common prefix with the winner that went
    by: the longer one wins unseen, and only equally long ones are compared, from
    there on. Of equal suffixes the run with the lower number comes first.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list[bytes | None] = [None] * leaves
    prefix = [0] * leaves  # of each head with the suffix that went out last
    for k, run in enumerate(runs):
        if run.advance() >= 0:
            heads[k] = run.now

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser), and the loser's prefix is brought up to date."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = prefix[a], prefix[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        c = _common(x, y, p)
        if c == len(x):
            first = (a, b) if a < b else (b, a)
        else:
            first = (a, b) if x[c] < y[c] else (b, a)
        prefix[first[1]] = c
        return first

    losers = [0] * leaves

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        win, losers[node] = play(build(2 * node), build(2 * node + 1))
        return win

    winner = build(1) if leaves > 1 else 0
    while heads[winner] is not None:
        run = runs[winner]
        yield prefix[winner], heads[winner], run.entries[run.next - 1]
        lcp = run.advance()
        heads[winner], prefix[winner] = (run.now, lcp) if lcp >= 0 else (None, 0)
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


# --- what a chunk does --------------------------------------------------------


class Chunk:
    """The documents of one chunk; the first of equal texts in the table are its leaders."""

    def __init__(self, rows: pa.Table, notes: pa.Table):
        kinds = notes["kind"].to_pylist()
        blobs = notes["blob"].to_pylist()
        leaders = {b for k, b in zip(kinds, blobs, strict=True) if k == 0}
        self.blobs = [b for k, b in zip(kinds, blobs, strict=True) if k == 1]
        own: dict[bytes, bytes] = {}
        self.rows: list[tuple[bytes, bytes]] = []
        for doc_id, sha, text in zip(rows["doc_id"].to_pylist(), rows["sha"].to_pylist(), rows["text"].cast(pa.binary()).to_pylist(), strict=True):
            key = struct.pack(">q", doc_id) + sha
            self.rows.append((key, text))
            if key in leaders:
                own[key] = text
        self.keys = sorted(own)
        self.texts = [own[k] for k in self.keys]
        self.ids = np.array([struct.unpack(">q", k[:8])[0] for k in self.keys], np.int64)


def _tables(rows: pa.Table) -> int:
    return rows["chunk"][0].as_py() if rows.num_rows else -1


def prints_of(hashes: np.ndarray) -> np.ndarray:
    """Fingerprints to exchange. Anchors have the least hashes of their windows, so they are mixed again to fill all ranges alike."""
    with np.errstate(over="ignore"):
        mixed = (hashes ^ (hashes >> np.uint64(33))) * STEP
        return (mixed ^ (mixed >> np.uint64(29))) * MIX >> np.uint64(64 - PRINT_BITS)


def print_runs(chunk: Chunk, sampler: Sampler, ranges: int) -> Iterator[tuple[int, bytes]]:
    """(range, blob): the sorted fingerprints of a chunk, with the documents that have each."""
    prints, docs = [], []
    for k, text in enumerate(chunk.texts):
        own = np.unique(prints_of(sampler(text)[1]))
        prints.append(own)
        docs.append(np.full(len(own), k, np.uint32))
    if not prints:
        return
    values, counts = np.unique(np.concatenate(prints), return_counts=True)
    cuts = np.searchsorted(values, range_bounds(ranges))
    for part in range(ranges):
        low, high = cuts[part], cuts[part + 1]
        if high > low:
            v, c = values[low:high], counts[low:high]
            step = np.diff(v, prepend=v[:1])
            wide = step.max() >= 1 << 32
            several = np.flatnonzero(c > 1).astype("<u4")
            yield (
                part,
                struct.pack("<?IIQ", wide, len(v), len(several), int(v[0])) + step.astype("<u8" if wide else "<u4").tobytes() + several.tobytes() + c[several].astype("<u4").tobytes(),
            )


def range_bounds(ranges: int) -> np.ndarray:
    return np.array([(k << PRINT_BITS) // ranges for k in range(ranges)] + [1 << PRINT_BITS], np.uint64)


def read_print_run(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide, n, several, first = struct.unpack_from("<?IIQ", blob)
    at = struct.calcsize("<?IIQ")
    step = np.frombuffer(blob, "<u8" if wide else "<u4", n, at).astype(np.uint64)
    at += n * (8 if wide else 4)
    which = np.frombuffer(blob, "<u4", several, at)
    counts = np.ones(n, np.int64)
    counts[which] = np.frombuffer(blob, "<u4", several, at + 4 * several)
    return np.cumsum(step) + np.uint64(first), counts


def repeated_prints(chunks: list[int], blobs: list[bytes], crowd: int) -> Iterator[tuple[int, bytes]]:
    """For each chunk, its fingerprints that several documents have; the lowest bit says that over ``crowd`` have it."""
    read = [read_print_run(b) for b in blobs]
    values = np.concatenate([v for v, _ in read])
    counts = np.concatenate([c for _, c in read])
    owner = np.repeat(np.array(chunks, np.int64), [len(v) for v, _ in read])
    order = np.argsort(values, kind="stable")
    v = values[order]
    start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    total = np.add.reduceat(counts[order], start)
    size = np.diff(np.r_[start, len(v)])
    hit = np.repeat(total > 1, size)
    notes = (v[hit] << np.uint64(1)) | np.repeat(total > crowd, size)[hit]
    of = owner[order][hit]
    by = np.argsort(of, kind="stable")
    notes, of = notes[by], of[by]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    for a, b in zip(first, np.r_[first, len(of)][1:], strict=True):
        yield int(of[a]), notes[a:b].astype("<u8").tobytes()


class Shape:
    """A suffix as a row of bytes: ``length`` bytes from the anchor, the bytes before it backwards, and how many of each there are."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.before = length, gram, length - gram
        self.width = length + self.before + 2

    def contexts(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """At each anchor. text has room of ``length`` zeros on both sides."""
        n = len(text) - 2 * self.length
        columns = np.r_[np.arange(self.length), -1 - np.arange(self.before)] + self.length
        out = np.empty((len(at), self.width), np.uint8)
        out[:, :-2] = text[at[:, None] + columns[None, :]]
        out[:, -2] = np.minimum(self.length, n - at)
        out[:, -1] = np.minimum(self.before, at)
        return out

    def strings(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Plain strings that start at each place, marked by a last byte that no context has."""
        out = np.zeros((len(at), self.width), np.uint8)
        out[:, : self.length] = text[at[:, None] + np.arange(self.length)[None, :] + self.length]
        out[:, -2:] = 255
        return out


def suffix_runs(chunk: Chunk, sampler: Sampler, shape: Shape, splitters: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(range, kind, blob) with kind 0: a front-coded run, kind 1: marks found in the chunk itself."""
    if not chunk.blobs:
        return
    notes = np.sort(np.frombuffer(b"".join(chunk.blobs), "<u8"))
    known = notes >> np.uint64(1)
    rows, docs, places = [], [], []
    room = np.zeros(shape.length, np.uint8)
    for k, text in enumerate(chunk.texts):
        at, hashes = sampler(text)
        if not len(at):
            continue
        p = prints_of(hashes)
        i = np.minimum(np.searchsorted(known, p), len(known) - 1)
        hit = known[i] == p
        if not hit.any():
            continue
        crowded = (notes[i] & np.uint64(1)).astype(bool)
        padded = np.concatenate([room, np.frombuffer(text, np.uint8), room])
        single = at[hit & ~crowded]
        rows.append(shape.contexts(padded, single))
        spread = at[hit & crowded]
        starts = np.unique(spread[:, None] - np.arange(shape.before + 1)[None, :]) if len(spread) else spread
        starts = starts[(starts >= 0) & (starts <= len(text) - shape.length)]
        rows.append(shape.strings(padded, starts))
        both = np.concatenate([single, starts])
        docs.append(np.full(len(both), k, np.uint32))
        places.append(both)
    if not rows:
        return
    all_rows, doc, place = np.concatenate(rows), np.concatenate(docs), np.concatenate(places)
    del rows
    order = np.argsort(np.ascontiguousarray(all_rows).view(f"S{shape.width}").ravel(), kind="stable")
    all_rows, doc, place = all_rows[order], doc[order], place[order]
    new = np.r_[True, (all_rows[1:] != all_rows[:-1]).any(axis=1)]
    entry = np.cumsum(new) - 1
    suffixes = all_rows[new]
    del all_rows
    ids = chunk.ids[doc]
    least = np.minimum.reduceat(ids, np.flatnonzero(new))
    first = ids == least[entry]
    marks = Marks(shape)
    for e, d, p in zip(entry[~first].tolist(), doc[~first].tolist(), place[~first].tolist(), strict=True):
        marks.whole(suffixes[e], 0, d, p)
    for blob in marks.blobs.values():
        yield -1, 1, b"".join(blob)
    cuts = np.searchsorted(suffixes[:, : shape.gram].copy().view(f"S{shape.gram}").ravel(), np.array(splitters, f"S{shape.gram}")) if splitters else np.zeros(0, np.int64)
    bounds = [0, *cuts.tolist(), len(suffixes)]
    kept_entry, kept_doc, kept_place = entry[first], doc[first], place[first]
    where = np.searchsorted(kept_entry, np.arange(len(suffixes) + 1))
    for part, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if high > low:
            shared, rests = front_code(suffixes[low:high])
            a, b = where[low], where[high]
            yield (
                part,
                0,
                struct.pack("<II", high - low, b - a)
                + shared.tobytes()
                + least[low:high].astype("<i8").tobytes()
                + np.diff(where[low : high + 1]).astype("<u4").tobytes()
                + kept_doc[a:b].astype("<u4").tobytes()
                + kept_place[a:b].astype("<u8").tobytes()
                + rests,
            )


class Marks:
    """Spans to remove, by chunk, as packed (document of the chunk, start, end)."""

    PACK = struct.Struct("<IQQ")

    def __init__(self, shape: Shape):
        self.shape = shape
        self.blobs: dict[int, list[bytes]] = {}

    def add(self, chunk: int, doc: int, start: int, end: int) -> None:
        self.blobs.setdefault(chunk, []).append(self.PACK.pack(doc, start, end))

    def whole(self, suffix: bytes | np.ndarray, chunk: int, doc: int, place: int) -> None:
        """All strings that an entry stands for."""
        after, before = int(suffix[-2]), int(suffix[-1])
        if before == 255:
            self.add(chunk, doc, place, place + self.shape.length)
        else:
            self.add(chunk, doc, place - before, place + after)


class Entries:
    """What the runs of a range say beside the suffixes."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.chunk: list[int] = []
        self.first: list[int] = [0]
        self.docs: list[int] = []
        self.places: list[int] = []

    def read(self, chunk: int, blob: bytes, width: int) -> Run:
        n, m = struct.unpack_from("<II", blob)
        at, start = 8, len(self.ids)
        shared = np.frombuffer(blob, np.uint8, n, at)
        at += n
        self.ids += np.frombuffer(blob, "<i8", n, at).tolist()
        at += 8 * n
        self.first += (np.cumsum(np.frombuffer(blob, "<u4", n, at)) + len(self.docs)).tolist()
        at += 4 * n
        self.docs += np.frombuffer(blob, "<u4", m, at).tolist()
        at += 4 * m
        self.places += np.frombuffer(blob, "<u8", m, at).tolist()
        at += 8 * m
        self.chunk += [chunk] * n
        return Run(shared, blob[at:], width, range(start, start + n))

    def spots(self, entry: int) -> Iterable[tuple[int, int]]:
        a, b = self.first[entry], self.first[entry + 1]
        return zip(self.docs[a:b], self.places[a:b], strict=True)


def shared_strings(runs: list[Run], entries: Entries, shape: Shape) -> Marks:
    """Merge the runs, and mark what also starts in a document with a smaller id."""
    marks = Marks(shape)
    group: list[tuple[bytes, int, int]] = []  # distinct contexts with one gram: suffix, common prefix, entry of the least id
    equal: list[int] = []
    last = b""

    def settle_equal() -> int:
        """Of equal suffixes all but those of the least id are marked; an entry of the least id is returned."""
        least = min(equal, key=entries.ids.__getitem__)
        for e in equal:
            if entries.ids[e] > entries.ids[least]:
                for doc, place in entries.spots(e):
                    marks.whole(last, entries.chunk[e], doc, place)
        return least

    held: list[list[int]] = []  # per context, the entries of its least id
    since = 0  # the common prefix of the suffix at hand with the last context of the group

    def flush() -> None:
        nonlocal since
        if equal:
            least = settle_equal()
            if last[-1] != 255:
                group.append((last, since, least))
                held.append([e for e in equal if entries.ids[e] == entries.ids[least]])
                since = shape.width

    def close() -> None:
        if len(group) > 1:
            _partial(group, held, entries, shape, marks)
        group.clear()
        held.clear()

    for lcp, suffix, entry in merged(runs):
        if lcp == shape.width and equal:
            equal.append(entry)
            continue
        flush()
        if lcp < shape.gram:
            close()
        since = min(since, lcp)
        equal, last = [entry], suffix
    flush()
    close()
    return marks


def _partial(group: list[tuple[bytes, int, int]], held: list[list[int]], entries: Entries, shape: Shape, marks: Marks) -> None:
    """Strings that contexts with one gram share without being equal.

    A context can share one only if what it has in common with some other to the
    right and to the left of the gram together is long enough.
    """
    length, before, gram = shape.length, shape.before, shape.gram
    n = len(group)
    lcps = [min(length, g[1]) for g in group] + [0]
    lcps[0] = 0
    right = [max(lcps[i], lcps[i + 1], gram) for i in range(n)]
    lefts = [g[0][length : length + before] for g in group]
    order = sorted(range(n), key=lefts.__getitem__)
    left = [0] * n
    for a, b in zip(order, order[1:], strict=False):
        c = _common(lefts[a], lefts[b], 0)
        left[a], left[b] = max(left[a], c), max(left[b], c)
    seen: dict[tuple[bytes, bytes], int] = {}
    tried: list[tuple[int, range]] = []
    for i, (suffix, _, entry) in enumerate(group):
        places = range(max(0, length - min(right[i], suffix[-2])), min(left[i], suffix[-1]) + 1)
        if not len(places):
            continue
        tried.append((i, places))
        id_ = entries.ids[entry]
        for d in places:
            key = (lefts[i][:d], suffix[: length - d])
            if seen.get(key, id_) >= id_:
                seen[key] = id_
    for i, places in tried:
        suffix, _, entry = group[i]
        found = [d for d in places if seen[lefts[i][:d], suffix[: length - d]] < entries.ids[entry]]
        if found:
            for e in held[i]:
                for doc, place in entries.spots(e):
                    marks.add(entries.chunk[e], doc, place - found[-1], place - found[0] + length)


def without(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of text, and the bytes and maximal runs removed."""
    order = np.argsort(spans["start"], kind="stable")
    start, end = spans["start"][order].astype(np.int64), np.maximum.accumulate(spans["end"][order].astype(np.int64))
    first = np.r_[True, start[1:] > end[:-1]]
    begin = start[first]
    until = np.r_[end[np.flatnonzero(first)[1:] - 1], end[-1]]
    kept, at = [], 0
    for a, b in zip(begin.tolist(), until.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), int((until - begin).sum()), len(begin)


# --- the Spark job ------------------------------------------------------------


def remove_repeated(
    docs: DataFrame,
    *,
    length: int = 50,
    gram: int = 26,
    chunk_bytes: int = 1_500_000,
    range_bytes: int = 64_000_000,
    crowd: int = 20_000,
    keep_text: bool = False,
    carry: bool = False,
    whole_characters: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary][, rest struct]) of each row.

    Texts count as UTF-8 bytes, null as empty. Rows with a null id come after all
    others but those of the greatest long, which count as of one id with them; rows with one id do not remove from each other, whatever their texts.
    Texts shorter than ``length`` lose nothing. An empty table gives no rows.

    ``crowd``: suffixes whose prefix more documents have are exchanged as plain strings
    of ``length`` bytes, which are combined in each chunk, so that a passage found
    almost everywhere is spread over many ranges. The table of texts is written
    once, bucketed by chunk, and read again without a shuffle. ``keep_text`` adds what is
    left of each text, ``carry`` the other columns of docs in a struct. With
    ``whole_characters`` what is left of a character of which bytes were removed is not
    in ``kept``; its digest is that of all remaining bytes.
    """
    spark = docs.sparkSession
    last = (1 << 63) - 1
    others = [docs.schema[c] for c in docs.columns if c != text_col] if carry else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.struct(*(F.col(f"`{f.name}`") for f in others)).alias("rest")] if carry else []
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("doc_id"), F.col(id_col).isNotNull().alias("known"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"), *rest)
    total = keyed_texts(docs, id_col, text_col).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # ranges follow the data, and so do chunks, up to a bound, for every chunk sends a run to every range
    parts = max(partitions(spark), -(-total // range_bytes))
    chunk_bytes = min(4 * chunk_bytes, max(chunk_bytes, total // 8192))
    chunks = max(1, -(-total // chunk_bytes))
    chunk = F.pmod(F.xxhash64("sha", "doc_id"), F.lit(chunks)).cast("int")
    table = fresh_table(spark, "texts")
    (
        base.withColumn("chunk", chunk)
        .repartition(parts, "chunk")
        .write.bucketBy(parts, "chunk")
        .option("path", fresh_path(spark, "texts"))
        .option("compression", "zstd")
        .saveAsTable(table)
    )
    texts = spark.table(table)
    leaders = texts.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).select(
        chunk.alias("chunk"), F.lit(0).alias("kind"), F.concat(F.unhex(F.lpad(F.hex("doc_id"), 16, "0")), "sha").alias("blob")
    )
    sampler, shape = Sampler(length, gram), Shape(length, gram)
    notes = "chunk int, kind int, blob binary"

    def with_notes(extra: DataFrame | None, apply, schema: str | T.StructType, *more: str) -> DataFrame:
        right = leaders if extra is None else leaders.unionByName(extra.select("chunk", F.lit(1).alias("kind"), "blob"))
        rows = texts.select("chunk", "doc_id", "sha", "text", *more)
        return rows.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(apply, schema)

    def columns(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
        lists = list(zip(*rows, strict=True)) or [()] * len(names)
        give_back()
        return pa.table({n: pa.array(v, t) for n, v, t in zip(names, lists, types, strict=True)})

    def exchange_prints(left: pa.Table, right: pa.Table) -> pa.Table:
        number = _tables(left)
        rows = [(part, number, blob) for part, blob in print_runs(Chunk(left, right), sampler, parts)] if left.num_rows else []
        return columns(rows, ["part", "chunk", "blob"], [pa.int32(), pa.int32(), pa.binary()])

    def find_repeated(rows: pa.Table) -> pa.Table:
        found = repeated_prints(rows["chunk"].to_pylist(), rows["blob"].to_pylist(), crowd)
        return columns(found, ["chunk", "blob"], [pa.int32(), pa.binary()])

    prints = with_notes(None, exchange_prints, "part int, chunk int, blob binary")
    repeated = prints.groupBy("part").applyInArrow(find_repeated, "chunk int, blob binary")
    splitters = range_splitters(texts, sampler, parts)

    def sort_suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        number = _tables(left)
        rows = []
        if left.num_rows:
            for part, kind, blob in suffix_runs(Chunk(left, right), sampler, shape, splitters):
                rows.append((part if part >= 0 else number % parts, number, kind, blob))
        return columns(rows, ["part", "chunk", "kind", "blob"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()])

    def merge_range(rows: pa.Table) -> pa.Table:
        entries, runs, out = Entries(), [], []
        for number, kind, blob in zip(rows["chunk"].to_pylist(), rows["kind"].to_pylist(), rows["blob"].to_pylist(), strict=True):
            if kind == 1:
                out.append((number, blob))
            else:
                runs.append(entries.read(number, blob, shape.width))
        if runs:
            out += [(number, b"".join(found)) for number, found in shared_strings(runs, entries, shape).blobs.items()]
        return columns(out, ["chunk", "blob"], [pa.int32(), pa.binary()])

    runs = with_notes(repeated, sort_suffixes, "part int, chunk int, kind int, blob binary")
    marks = runs.groupBy("part").applyInArrow(merge_range, "chunk int, blob binary")
    packed = np.dtype([("doc", "<u4"), ("start", "<u8"), ("end", "<u8")])

    schema = T.StructType.fromDDL(RESULT)
    if not keep_text:
        schema = T.StructType(schema.fields[:-1])
    schema = schema.add("known", "boolean")
    if carry:
        schema = schema.add("rest", loosened(texts.schema["rest"].dataType))  # columns come back from Python as ones that may be null, whatever the table says

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        """Every row of a chunk: leaders without their spans, copies without anything."""
        own = Chunk(left, right)
        spans = np.frombuffer(b"".join(own.blobs), packed)
        spans = spans[np.argsort(spans["doc"], kind="stable")]
        where = np.searchsorted(spans["doc"], np.arange(len(own.keys) + 1))
        number = {key: k for k, key in enumerate(own.keys)}
        rows = []
        for key, text in own.rows:
            k = number.get(key)
            if k is None:
                kept, removed, runs_ = (b"", len(text), 1) if len(text) >= length else (text, 0, 0)
            elif where[k + 1] > where[k]:
                kept, removed, runs_ = without(text, spans[where[k] : where[k + 1]])
            else:
                kept, removed, runs_ = text, 0, 0
            rows.append((struct.unpack(">q", key[:8])[0], len(text), removed, runs_, hashlib.sha256(kept).hexdigest(), None if not keep_text else kept.decode("utf-8", "ignore").encode() if whole_characters else kept))
        out = columns(rows, [c.split()[0] for c in RESULT.split(", ")], [pa.int64()] * 4 + [pa.string(), pa.binary()])
        out = out if keep_text else out.drop_columns(["kept"])
        out = out.append_column("known", left["known"])
        return out.append_column("rest", left["rest"]) if carry else out

    done = with_notes(marks, cut, schema, "known", *(["rest"] if carry else []))
    return done.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


def loosened(kind: T.DataType) -> T.DataType:
    """A type of which every part may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, loosened(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(loosened(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(loosened(kind.keyType), loosened(kind.valueType))
    return kind


def range_splitters(texts: DataFrame, sampler: Sampler, ranges: int, sample: int = 400) -> list[bytes]:
    """Boundaries of equal shares of anchors, from a sample of at most ``sample`` texts and 200 anchors of each.

    They decide how evenly ranges are filled, and nothing else.
    """
    gram = sampler.gram

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                at = sampler(text)[0]
                out += [text[p : p + gram] for p in at[:: max(1, len(at) // 200)].tolist()]
            yield pa.RecordBatch.from_pydict({"gram": pa.array(out, pa.binary())})

    some = texts.select("sha", "text").orderBy("sha").limit(sample).select("text")
    grams = sorted(r[0] for r in some.mapInArrow(look, "gram binary").toLocalIterator())
    return sorted({bytes(grams[len(grams) * k // ranges]) for k in range(1, ranges)}) if grams else []
