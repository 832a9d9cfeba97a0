"""BPE encoding and decoding with forced boundaries.

A merge joins two neighbouring symbols into a token of the vocabulary. So where
two neighbouring units (bytes, the last one of a word with the end-of-word mark)
stand side by side inside no token of the vocabulary, no merge can ever reach
across, and the word may be cut there. Fragments between such cuts are encoded
each on its own, and their ids are put one after the other.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import keyed_texts, map_slices
from .tokens import CACHE_ENTRIES, TOKEN_SLICE, Pieces, Remembered, joined

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ForcedBoundaryBPE:
    """Encodes and decodes as a BPE file of the tokenizers library says."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.inside = {pair for token in self.vocab for pair in self._neighbours(self.units(token))}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.decoder = spec["decoder"]
        self.pieces = Pieces(spec)
        self.token_of = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.entries = entries
        self.known = Remembered(lambda pieces: [self._word(p) for p in pieces], entries)
        self.fragments: dict[tuple[str, ...], list[int]] = {}

    def units(self, token: str) -> list[str]:
        """The units of a token: characters that stand for bytes, the last with the end-of-word mark."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            out = list(token[: -len(self.end)])
            out[-1] += self.end
            return out
        return list(token)

    @staticmethod
    def _neighbours(units: list[str]) -> zip:
        return zip(units, units[1:], strict=False)

    def cut(self, units: list[str]) -> list[tuple[str, ...]]:
        """Fragments of a word between pairs that no token holds."""
        out, start = [], 0
        for i in range(1, len(units)):
            if (units[i - 1], units[i]) not in self.inside:
                out.append(tuple(units[start:i]))
                start = i
        out.append(tuple(units[start:]))
        return out

    def fragment_ids(self, fragment: tuple[str, ...]) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        found = self.fragments.get(fragment)
        if found is not None:
            return found
        symbols = self._merged(list(fragment)) if len(fragment) <= 64 else self._merged_by_heap(list(fragment))
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        if len(self.fragments) >= self.entries:
            self.fragments.clear()
        self.fragments[fragment] = ids
        return ids

    def _merged(self, symbols: list[str]) -> list[str]:
        rank, none = self.rank, len(self.rank)
        while len(symbols) > 1:
            best, at = none, -1
            for i in range(len(symbols) - 1):
                r = rank.get((symbols[i], symbols[i + 1]), none)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _merged_by_heap(self, symbols: list[str]) -> list[str]:
        """The same for long fragments, with the pairs in a heap by rank and place."""
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(self._neighbours(symbols)) if (r := rank.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            k = after[i]
            if symbols[i] != a or k >= n or symbols[k] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[k], after[i] = a + b, "", after[k]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank.get((symbols[left], symbols[right]))) is not None:
                    heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [s for s in symbols if s]

    def word_ids(self, piece: str) -> list[int]:
        """The ids of a piece between white space."""
        if any(a in piece for a in self.added):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        if self.tokenizer.normalizer is not None:
            piece = self.tokenizer.normalizer.normalize_str(piece)
        ids: list[int] = []
        for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece):
            units = list(word)
            if not units:
                continue
            units[-1] += self.end
            for fragment in self.cut(units):
                ids += self.fragment_ids(fragment)
        return ids

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pieces.of_unusual(text) for i in self.word_ids(piece)]

    def decode(self, ids: list[int]) -> str:
        """As decode(ids, skip_special_tokens=False): without a decoder, tokens joined by blanks."""
        if self.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(self.token_of[i] for i in ids if i in self.token_of)

    def _word(self, piece: str) -> tuple[bytes, bytes]:
        """The ids of a piece, and its tokens with a blank before each."""
        ids = self.word_ids(piece)
        tokens = "" if self.decoder is not None else "".join(f" {self.token_of[i]}" for i in ids if i in self.token_of)
        return np.array(ids, "<u4").tobytes(), tokens.encode()

    def encoded_and_decoded(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        if not texts:
            return []
        pieces, ends = self.pieces(texts)
        found = self.known.values(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = joined([f[0] for f in found], pieces.indices, ends)
        if self.decoder is not None:
            return [(x, self.decode(np.frombuffer(x, "<u4").tolist()).encode()) for x in ids]
        return list(zip(ids, (x[1:] for x in joined([f[1] for f in found], pieces.indices, ends)), strict=True))


_MODELS: dict[str, ForcedBoundaryBPE] = {}


def model(path: str) -> ForcedBoundaryBPE:
    """One model for each Python worker and file."""
    if path not in _MODELS:
        _MODELS[path] = ForcedBoundaryBPE(path)
    return _MODELS[path]


def bpe_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text; a null text has no ids."""

    def setup():
        codec = model(tokenizer)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(x) for x in ids])], ["doc_id", "ids", "decoded"]
            )

        return run

    return map_slices(keyed_texts(docs, id_col, text_col), setup, "doc_id long, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text, and return digests; no shuffle.

    A null or empty text has no ids and decodes to the empty text. Repeated rows and
    null ids are kept. Texts of any length are cut at white space first, so memory
    is bounded by a slice of rows and the caches of words and fragments.
    """

    def setup():
        codec = model(tokenizer)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            both = codec.encoded_and_decoded(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(i) // 4 for i, _ in both], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in both]),
                    pa.array([hashlib.sha256(d).hexdigest() for _, d in both]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return run

    return map_slices(keyed_texts(docs, id_col, text_col), setup, DIGESTS, limit=TOKEN_SLICE)
