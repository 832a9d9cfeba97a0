"""Two tokenizers side by side: which of their tokens overlap in a text, and where both end.

Within a batch of texts each side is a table of tokens by where they start. pandas'
merge_asof, keyed by document, finds for each token start the other side's token that covers
it; both directions together give all overlaps, and starts that fall together cut a text
into groups.

How often an id pair is linked in the whole corpus is a join on the pair. Tasks put their
texts together in batches of :data:`BATCH_BYTES` and send each pair of a batch once, with its
count, so no pair is frequent among the rows that are shuffled, however frequent it is in texts;
what the batch holds by document comes back from the shared folder and meets the counts there.

Both tokenizers cut a text before a blank that follows anything but white space: byte-level
splitting starts a new piece there, and no piece of the other vocabulary has a blank after
another character (checked when it is loaded). So what lies between such blanks is encoded once in each
task and remembered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import fresh_path, give_back, keyed_texts, slices
from .tokens import UNUSUAL, Remembered, joined

#: Text that is aligned at once, and text whose pairs are sent once.
SLICE, BATCH_BYTES = 3_000_000, 32_000_000
ENTRIES = 250_000
#: New fragments that are encoded in one call.
TOGETHER = 64
#: Stands for a fragment that a tokenizer does not give back byte by byte.
BROKEN = 0xFFFF
BLANK = "▁"
#: A blank and what follows, up to the next blank after something that is not white space.
FRAGMENT = re.compile(r"(?s: (?:\S++(?= |\Z)|.*?\S(?= |\Z)|.*))")
SEPARATORS = (",", "|", ";")
BATCHES = "batch long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, sizes array<long>, links binary, pairs array<long>, counts array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_of() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: itself if printable, else the next ones from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


class Side:
    """One tokenizer: fragments to ids, ids to bytes."""

    tokens: list[bytes]

    def __init__(self) -> None:
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def learn(self, fragments: list[str]) -> list[bytes]:
        """The ids of new fragments; those that end in no white space are encoded some at a time."""
        out: list[bytes | None] = [None] * len(fragments)
        fit = [k for k, f in enumerate(fragments) if not f[-1].isspace() and len(f) < 200]
        some = [fit[i : i + TOGETHER] for i in range(0, len(fit), TOGETHER)]
        for own, ids in zip(some, self._ids(["".join(fragments[k] for k in own) for own in some]), strict=True):
            whole = [fragments[k].encode() for k in own]
            if b"".join([self.tokens[i] for i in ids]) == b"".join(whole):
                bounds, at = np.cumsum(self.sizes[ids]), 0
                ends = np.searchsorted(bounds, np.cumsum([len(w) for w in whole])) + 1
                if (bounds[ends - 1] == np.cumsum([len(w) for w in whole])).all():
                    for k, end in zip(own, ends.tolist(), strict=True):
                        out[k], at = np.array(ids[at:end], "<u2").tobytes(), end
        alone = [k for k, v in enumerate(out) if v is None]
        for k, ids in zip(alone, self._ids([fragments[k] for k in alone]), strict=True):
            same = b"".join([self.tokens[i] for i in ids]) == fragments[k].encode()
            out[k] = np.array(ids if same else [BROKEN], "<u2").tobytes()
        return out


class ByteSide(Side):
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings in a text are then plain text
        if json.load(open(path, encoding="utf-8"))["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path} adds blanks of its own")
        byte_of = _byte_of()
        self.tokens = [b""] * self.tokenizer.get_vocab_size()
        for token, id_ in self.tokenizer.get_vocab().items():
            self.tokens[id_] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else b""
        super().__init__()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError(f"{path} has pieces that go on after a blank")
        special = lambda i: self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if special(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.blank = self.model.piece_to_id(BLANK)
        super().__init__()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """It puts a blank before each text, but not before an empty one."""
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [ids if t != " " else [self.blank] for t, ids in zip(texts, found, strict=True)]


def cover(starts: np.ndarray, docs: np.ndarray, other_starts: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each token start the other side's token that covers it, by its row."""
    left = pd.DataFrame({"at": starts, "doc": docs})
    right = pd.DataFrame({"at": other_starts, "doc": other_docs, "row": np.arange(len(other_starts))})
    return pd.merge_asof(left, right, on="at", by="doc")["row"].to_numpy().astype(np.int64)


class Aligned:
    """The tokens of some texts on both sides, their links and groups."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.b, self.a_doc, self.b_doc = a, b, a_doc, b_doc
        a_start, b_start = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
        over_a, over_b = cover(a_start, a_doc, b_start, b_doc), cover(b_start, b_doc, a_start, a_doc)
        a_cut, b_cut = b_start[over_a] == a_start, a_start[over_b] == b_start
        self.a_group, self.b_group = np.cumsum(a_cut) - 1, np.cumsum(b_cut) - 1
        inner = ~b_cut  # where both start together, the pair is there already
        self.link_a = np.r_[np.arange(len(a)), over_b[inner]]
        self.link_b = np.r_[over_a, np.flatnonzero(inner)]

    def texts(self, table: pa.Array, docs: int) -> list[bytes]:
        """The groups of each document as text."""
        n_groups = int(self.a_group[-1]) + 1
        first_a, first_b = np.searchsorted(self.a_group, np.arange(n_groups + 1)), np.searchsorted(self.b_group, np.arange(n_groups + 1))
        entries = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[first_a[1:] - 1], last_b[first_b[1:] - 1] = 1, 2
        entries[np.arange(len(self.a)) + first_b[self.a_group]] = self.a.astype(np.int64) * len(SEPARATORS) + last_a
        entries[np.arange(len(self.b)) + first_a[self.b_group + 1]] = self.b.astype(np.int64) * len(SEPARATORS) + last_b
        taken = table.take(pa.array(entries))
        data, offsets = memoryview(taken.buffers()[2]), np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
        ends = np.cumsum(np.bincount(self.a_doc, minlength=docs) + np.bincount(self.b_doc, minlength=docs))
        bounds = offsets[np.r_[0, ends]].tolist()
        return [bytes(data[x : y - 1]) if y > x else b"" for x, y in zip(bounds, bounds[1:], strict=False)]


def fragments_of(texts: list[str | None]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(fragments of all texts, each with a blank before it, one after the other; where each text ends in them)."""
    odd = {k: FRAGMENT.findall(" " + t) for k, t in enumerate(texts) if t and UNUSUAL.search(t)}
    marked = pc.replace_substring(pa.array([None if k in odd or not t else " " + t for k, t in enumerate(texts)], pa.large_string()).fill_null(""), " ", "\0 ")
    has = lambda what: pc.any(pc.match_substring(marked, what)).as_py()
    for c in "\t\n\v\f\r ":
        while has(f"{c}\0 "):
            marked = pc.replace_substring(marked, f"{c}\0 ", f"{c} ")
    split = pc.split_pattern(marked, "\0")  # the first one of each text is empty
    counts, flat = np.diff(split.offsets.to_numpy()) - 1, split.flatten()
    flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    if odd:
        first, at, parts = np.r_[0, np.cumsum(counts)], 0, []
        for k, own in odd.items():
            parts += [flat.slice(at, first[k] - at), pa.array(own, pa.large_string())]
            at, counts[k] = first[k], len(own)
        flat = pa.chunked_array([*parts, flat.slice(at)], pa.large_string()).combine_chunks()
    return flat.dictionary_encode(), np.cumsum(counts)


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        self.known = Remembered(lambda f: list(zip(self.a.learn(f), self.b.learn(f), strict=True)), ENTRIES)
        largest = max(len(self.a.tokens), len(self.b.tokens))
        if largest > BROKEN:
            raise ValueError("ids must fit into 16 bits")
        self.table = pa.array([f"{i}{s}" for i in range(largest) for s in SEPARATORS], pa.large_string())

    def ids(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """The ids of both sides for each text; none for texts that a side does not give back."""
        pieces, ends = fragments_of(texts)
        known = self.known.values(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        a, b = (joined([v[side] for v in known], pieces.indices, ends) for side in (0, 1))
        mark = BROKEN.to_bytes(2, "little")
        for k in range(len(texts)):
            if any(mark in x and (np.frombuffer(x, "<u2") == BROKEN).any() for x in (a[k], b[k])):
                a[k] = b[k] = b""
        return a, b

    def __call__(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
        """(counts n_a, n_b, n_groups, n_links of each text; digests; by text and pair sorted rows (text << 32 | pair); how often)."""
        a_ids, b_ids = self.ids(texts)
        n = len(texts)
        a_counts, b_counts = (np.array([len(x) // 2 for x in ids], np.int64) for ids in (a_ids, b_ids))
        if not a_counts.any():
            none = np.zeros(n, np.int64)
            return [none] * 4, [""] * n, np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.frombuffer(b"".join(ids), "<u2") for ids in (a_ids, b_ids))
        a_doc, b_doc = np.repeat(np.arange(n), a_counts), np.repeat(np.arange(n), b_counts)
        found = Aligned(a, b, a_doc, b_doc, self.a.sizes[a], self.b.sizes[b])
        groups = np.zeros(n, np.int64)
        there = np.flatnonzero(a_counts)
        last = found.a_group[np.cumsum(a_counts)[there] - 1]
        groups[there] = np.diff(np.r_[-1, last])
        digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.texts(self.table, n)]
        link_doc = a_doc[found.link_a]
        rows, times = np.unique(link_doc << 32 | a[found.link_a].astype(np.int64) << 16 | b[found.link_b].astype(np.int64), return_counts=True)
        return [a_counts, b_counts, groups, np.bincount(link_doc, minlength=n)], digests, rows, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for each Python worker and pair of files."""
    if (byte_path, piece_path) not in _ALIGNERS:
        _ALIGNERS[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _ALIGNERS[byte_path, piece_path]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Batch:
    """What is kept of the texts of one batch until its pairs are sent."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.counts: list[list[np.ndarray]] = []
        self.digests: list[str] = []
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, ids: pa.Array, found: tuple, size: int) -> None:
        counts, digests, rows, times = found
        self.ids.append(ids)
        self.counts.append(counts)
        self.digests += digests
        self.sizes.append(np.bincount(rows >> 32, minlength=len(ids)))
        self.pairs.append((rows & 0xFFFFFFFF).astype(np.uint32))
        self.times.append(times.astype(np.uint32))
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        pairs, times, sizes = np.concatenate(self.pairs), np.concatenate(self.times), np.concatenate(self.sizes)
        distinct = np.unique(np.concatenate([np.unique(p) for p in self.pairs]))
        index = np.searchsorted(distinct, pairs).astype(np.int64)
        counts = np.bincount(index, times, len(distinct)).astype(np.int64)
        steps = np.diff(index, prepend=0)  # ascending within a text
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[firsts] = index[firsts]
        head = _packed(steps)
        links = len(head).to_bytes(8, "little") + head + _packed(times)
        lists = [pa.concat_arrays(self.ids), *(pa.array(np.concatenate([c[k] for c in self.counts])) for k in range(4)), pa.array(self.digests, pa.string()), pa.array(sizes)]
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = [pa.array([number]), *map(one, lists), pa.array([links], pa.binary()), one(pa.array(distinct.astype(np.int64))), one(pa.array(counts))]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in BATCHES.split(", ")])


def _batches(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligned, batch, number = aligner(byte_path, piece_path), Batch(), TaskContext.get().partitionId() << 32
        for some in batches:
            for part in slices(some, "text", SLICE):
                batch.add(part.column(0), aligned(part.column(1).to_pylist()), part.column(1).nbytes)
                if batch.bytes >= BATCH_BYTES:
                    yield batch.row(number)
                    batch, number = Batch(), number + 1
            give_back()
        if batch.ids:
            yield batch.row(number)

    return docs.mapInArrow(run, BATCHES)


def _with_counts(batch: pa.Table, looked: pa.Table) -> pa.Table:
    """One row for each document of one batch, from the counts of the batch's pairs."""
    row = {c: batch.column(c)[0] for c in batch.column_names}
    n = row["n_pairs"].as_py()
    counts, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = looked.column("i").to_numpy()
    counts[at], best[at] = looked.column("count").to_numpy(), looked.column("best").to_numpy()
    sizes = row["sizes"].values.to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n_best = count_sum = np.zeros(len(sizes), np.int64)
    if len(doc):
        data = row["links"].as_py()
        head = int.from_bytes(data[:8], "little")
        steps, times = _unpacked(data[8 : 8 + head]), _unpacked(data[8 + head :])
        firsts = np.cumsum(sizes) - sizes
        total = np.cumsum(steps)
        index = total - np.repeat((total - steps)[np.minimum(firsts, len(steps) - 1)], sizes)
        n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        np.add.at(n_best, doc, times * best[index])
        np.add.at(count_sum, doc, times * counts[index])
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    columns = [row[c].values for c in names] + [pa.array(n_best), pa.array(count_sum), row["groups_sha256"].values]
    return pa.table(columns, names=[*names, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: tokens of both sides, groups, links, and what the corpus says of the links.

    Null and empty texts, and texts that one of the two does not give back byte by byte, have
    no tokens: zeros, and '' as digest. Repeated rows count each; null ids stay null. Other
    columns are not read, whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    _batches(keyed_texts(docs, id_col, text_col), byte_path, piece_path).write.parquet(path := fresh_path(spark, "aligned"))
    sent = spark.read.parquet(path).select("batch", F.posexplode(F.arrays_zip("pairs", "counts")).alias("i", "p")).select("batch", "i", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = sent.groupBy("pair").agg(F.sum("n").alias("count"))
    totals.write.parquet(summed := fresh_path(spark, "pairs"))
    totals = spark.read.parquet(summed).withColumn("b", F.col("pair").bitwiseAND(0xFFFF))
    most = totals.groupBy("b").agg(F.max("count").alias("most"))  # as many rows as the vocabulary has ids
    known = totals.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    looked = sent.select("batch", "i", "pair").join(known, "pair").select("batch", "i", "count", "best")
    whole = spark.read.parquet(path).withColumn("n_pairs", F.size("pairs")).drop("pairs", "counts")
    return whole.groupBy("batch").cogroup(looked.groupBy("batch")).applyInArrow(_with_counts, RESULT)
