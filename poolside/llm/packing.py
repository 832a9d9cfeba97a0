"""Packing tokenised documents into training sequences.

Documents are dealt by a seeded hash into groups of a few thousand.
Each group is packed on its own: what a document has beyond whole sequences goes
to the bins by first-fit decreasing, with a tournament tree over the bins' free
space, so that each document costs one walk from root to leaf. Then the emptiest
bins are cut up to fill what room the fullest have left, and the last one is cut at
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, map_slices, partitions
from .tokens import TOKEN_SLICE, encoder

#: Text of so many bytes is packed in one task.
TASK_BYTES = 64_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Bins:
    """Bins of one size under a tournament tree of their free space."""

    def __init__(self, count: int, size: int):
        self.leaves = 1
        while self.leaves < max(1, count):
            self.leaves *= 2
        self.free = [size] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """Take need from the first bin that has it, and return that bin."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bin_ = node - self.leaves
        free[node] -= need
        while node > 1:
            node //= 2
            left, right = free[2 * node], free[2 * node + 1]
            most = left if left >= right else right
            if free[node] == most:
                break
            free[node] = most
        return bin_


def pack(lengths: list[int], size: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces that hold each token of each document once.

    least: the shortest piece that is cut off merely to fill a gap.
    """
    whole: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        full = n // size
        whole += [[(doc, k * size, size)] for k in range(full)]
        if n % size:
            rest.append((n % size, doc, full * size))
    rest.sort(key=lambda r: (-r[0], r[1]))
    bins = Bins(len(rest), size)
    held: dict[int, list[tuple[int, int, int]]] = {}
    for n, doc, start in rest:
        held.setdefault(bins.first_fit(n), []).append((doc, start, n))
    used = {b: sum(p[2] for p in pieces) for b, pieces in held.items()}

    # the emptiest bins are cut up to fill the gaps of the fullest, until they meet
    by_fill = sorted(held, key=lambda b: (used[b], b))
    low, high = 0, len(by_fill) - 1
    while low < high:
        giver, taker = by_fill[low], by_fill[high]
        gap = size - used[taker]
        if gap < least:
            high -= 1
            continue
        doc, start, n = held[giver].pop()
        take = min(n, gap)
        held[taker].append((doc, start, take))
        used[taker] += take
        used[giver] -= take
        if take < n:
            held[giver].append((doc, start + take, n - take))
        if not used[giver]:
            del held[giver]
            low += 1
    out = whole
    for b in sorted(held):
        out += [held[b]] if size - used[b] < least else at_powers_of_two(held[b], used[b])
    return out


def at_powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """Sequences whose lengths are the powers of two that make up total."""
    out, left = [], list(reversed(pieces))
    while total:
        want = 1 << (total.bit_length() - 1)
        total -= want
        sequence = []
        while want:
            doc, start, n = left.pop()
            take = min(n, want)
            sequence.append((doc, start, take))
            want -= take
            if take < n:
                left.append((doc, start + take, n - take))
        out.append(sequence)
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 1,
    size: int = 2048,
    least: int = 16,
    group_docs: int = 4096,
    group_bytes: int = 16_000_000,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents; one row for each piece.

    Every document, also an empty or null one, has at least its end id. A document
    may be cut anywhere; ``start`` counts its ids before the piece. Rows with the
    same id, or a null id, are packed as documents of their own. A sequence is full
    up to ``size``, or its length is a power of two, or it lacks fewer than
    ``least`` tokens. An empty table gives no rows.

    Only ids move in the shuffle. A group has about ``group_docs`` documents or
    ``group_bytes`` of text, whichever is less, and groups are dealt to as many tasks as the
    text asks for. Rows are dealt by id, text and a thousand rows of their partition, so
    neither a repeated id nor repeated rows meet in one group; docs should come from files,
    whose partitions are the same when a lost task runs again.
    """
    base = keyed_texts(docs, id_col, text_col)
    seen = base.agg(F.count("text").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    groups = max(1, -(-seen["n"] // group_docs), -(-seen["bytes"] // group_bytes))
    tasks = max(partitions(docs.sparkSession), -(-seen["bytes"] // TASK_BYTES))
    spread = F.xxhash64("doc_id", "text", F.shiftright(F.monotonically_increasing_id(), 10), F.lit(seed))

    def setup():
        codec = encoder(tokenizer)
        end = np.array([end_id], codec.dtype).tobytes()

        def tokenise(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x + end for x in codec.encode(batch.column(2).to_pylist())]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["bunch", "doc_id", "ids"])

        return tokenise

    width = 2 if _small_vocabulary(tokenizer) else 4
    ids = map_slices(base.select(F.pmod(spread, F.lit(groups)).alias("bunch"), "doc_id", "text"), setup, "bunch long, doc_id long, ids binary", limit=TOKEN_SLICE)

    def pack_bunch(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(check=[zlib.crc32(x) for x in rows["ids"]]).sort_values(["doc_id", "check"], kind="stable")
        values, names = rows["ids"].tolist(), rows["doc_id"].tolist()
        bunch = int(rows["bunch"].iloc[0])
        lengths = [len(v) // width for v in values]
        out: dict[str, list] = {c: [] for c in ("doc", "start", "length", "sequence_id", "offset")}
        for k, sequence in enumerate(pack(lengths, size, least)):
            offset = 0
            for doc, start, n in sequence:
                for c, v in zip(out, (doc, start, n, (bunch << 32) + k, offset), strict=True):
                    out[c].append(v)
                offset += n
        docs_ = out.pop("doc")
        crc = [
            zlib.crc32(np.frombuffer(values[d], f"<u{width}", n, s * width).astype("<u4").tobytes())
            for d, s, n in zip(docs_, out["start"], out["length"], strict=True)
        ]
        frame = pd.DataFrame(out)
        frame.insert(0, "doc_id", pd.array([None if pd.isna(names[d]) else int(names[d]) for d in docs_], "Int64"))
        frame["ids_crc32"] = crc
        frame["doc_tokens"] = [lengths[d] for d in docs_]
        return frame[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return ids.repartition(tasks, "bunch").groupBy("bunch").applyInPandas(pack_bunch, PIECES)


def _small_vocabulary(tokenizer: str) -> bool:
    return encoder(tokenizer).dtype.itemsize == 2

