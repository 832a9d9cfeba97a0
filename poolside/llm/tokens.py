"""Encoding whole texts by pieces that the tokenizer never merges across.

A tokenizer of the ``tokenizers`` library spends most of its time on book-keeping
for each text. Both vocabularies used here cut a text at white space first, so the
ids of a text are the ids of its pieces, one after the other. Pieces repeat a lot:
a slice of texts is split and its distinct pieces are found by Arrow's kernels, and each
Python worker keeps a bounded cache of the ids of pieces it has seen.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Unicode White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
#: A run of white space and what follows it: a token may start with the run, never hold it inside.
LEADING_SPACE_PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
ASCII_PIECES = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
#: Characters that str.split() takes for white space and Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORDS = re.compile(f"[^{SPACE}]+")
#: Both vocabularies also cut between letters and what is neither letter, digit nor space; the apostrophe has rules of its own.
PARTS = re.compile(f"[{SPACE}]*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[!-&(-/:-@[-`{{-~])|(?s:.)+")

#: Texts with one of these are split in Python: white space beyond ASCII, what str.split() alone takes for it, and the mark of a cut.
UNUSUAL = re.compile("[\x00\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LETTER_MARK = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"

CACHE_ENTRIES = 450_000
#: Texts are encoded in slices of about this many bytes.
TOKEN_SLICE = 6_000_000


def space_words(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space."""
    return WORDS.findall(text) if SEPARATORS.search(text) else text.split()


def leading_space_pieces(text: str) -> list[str]:
    """Pieces for tokenizers that keep white space before a word."""
    return (ASCII_PIECES if text.isascii() else LEADING_SPACE_PIECES).findall(text)


def folded(text: str, special: re.Pattern) -> str:
    """text in lower case, for tokenizers that lower it themselves: more pieces are then alike.

    Only texts of Latin-1 letters, which no normal form changes, and only if that makes up no special token.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    low = text.lower()
    return text if special.search(low) else low


def lowers(spec: dict) -> bool:
    """Does this tokenizers file lower its texts?"""
    return '"Lowercase"' in json.dumps(spec["normalizer"])


def before_space(texts: pa.Array) -> pa.Array:
    """texts with a mark before each run of ASCII white space."""
    has = lambda what: pc.any(pc.match_substring(texts, what)).as_py()
    spaces = [c for c in "\t\n\v\f\r " if has(c)]
    for c in spaces:
        texts = pc.replace_substring(texts, c, "\0" + c)
    for a in spaces:
        for b in spaces:
            while has(f"{a}\0{b}"):
                texts = pc.replace_substring(texts, f"{a}\0{b}", a + b)
    return texts


#: New words that are encoded in one call.
TOGETHER = 50


class Remembered:
    """Values of strings, kept for two generations of at most ``entries`` each."""

    def __init__(self, learn: Callable[[list[str]], list], entries: int):
        self.learn, self.entries = learn, entries
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, keys: list[str]) -> list:
        """The value of each of the keys, which are distinct."""
        out = list(map(self.new.get, keys))
        missing = [k for k, v in enumerate(out) if v is None]
        if not missing:
            return out
        if len(self.new) + len(missing) > self.entries:
            self.old, self.new = self.new, {}
        unknown = []
        for k in missing:
            out[k] = v = self.old.get(keys[k])
            if v is None:
                unknown.append(k)
            else:
                self.new[keys[k]] = v
        for k, v in zip(unknown, self.learn([keys[k] for k in unknown]), strict=True):
            out[k] = self.new[keys[k]] = v
        return out


class Pieces:
    """Splits texts into pieces, most of them with Arrow's kernels."""

    def __init__(self, spec: dict):
        self.keeps_space = spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)
        self.plain: Callable[[str], list[str]] = leading_space_pieces if self.keeps_space else space_words
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.lowers = lowers(spec)

    def unusual(self, text: str) -> bool:
        return UNUSUAL.search(text) is not None or self.special.search(text) is not None

    def of_unusual(self, text: str) -> list[str]:
        return [x for p in self.plain(text) for x in ([p] if self.special.search(p) else PARTS.findall(p))]

    def __call__(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(pieces of all texts one after the other, where each text ends in them)."""
        if self.lowers:
            texts = [folded(t, self.special) for t in texts]
        odd = {k: self.of_unusual(t) for k, t in enumerate(texts) if self.unusual(t)}
        usual = pa.array(["" if k in odd else t for k, t in enumerate(texts)] if odd else texts, pa.large_string())
        if self.keeps_space:
            split = pc.split_pattern(pc.replace_substring_regex(before_space(usual), LETTER_MARK, "\\1\0\\2"), "\0")
        else:
            split = pc.ascii_split_whitespace(pc.replace_substring_regex(usual, LETTER_MARK, "\\1 \\2"))
        ends, flat = np.diff(split.offsets.to_numpy()), split.flatten()
        if odd:  # their pieces are put in place of the one empty piece that stands for them
            first, at, parts = split.offsets.to_numpy(), 0, []
            for k, own in odd.items():
                parts += [flat.slice(at, first[k] - at), pa.array(own, pa.large_string())]
                at, ends[k] = first[k + 1], len(own)
            flat = pa.chunked_array([*parts, flat.slice(at)], pa.large_string()).combine_chunks()
        return flat.dictionary_encode(), np.cumsum(ends)


def joined(values: list[bytes], indices: pa.Array, ends: np.ndarray) -> list[bytes]:
    """For each text the values of its pieces, one after the other."""
    taken = pa.array(values, pa.large_binary()).take(indices)
    if not len(taken):
        return [b""] * len(ends)
    data = memoryview(taken.buffers()[2] or b"")
    bounds = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[np.r_[0, ends]].tolist()
    return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


class PieceEncoder:
    """Texts to little-endian id bytes with a tokenizers file."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        spec = json.load(open(path, encoding="utf-8"))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = Pieces(spec)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.known = Remembered(self._learn, entries)
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        names = [""] * size
        for token, id_ in tokens.items():
            names[id_] = token
        mark = spec["model"]["end_of_word_suffix"]
        self.lasts = np.array([t.endswith(mark) for t in names]) if mark else None
        self.sizes = np.array([len(t) for t in names])  # a character stands for a byte
        self.word, self.between = (re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+"), "") if self.pieces.keeps_space else (re.compile("[a-zß-öø-ÿ]+"), " ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        pieces, ends = self.pieces(texts)
        return joined(self.known.values(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), pieces.indices, ends)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of new pieces. Plain words are encoded some at a time, for a call costs more than a word."""
        out: list[bytes] = [b""] * len(pieces)
        plain = [k for k, p in enumerate(pieces) if self.word.fullmatch(p)]
        for i in range(0, len(plain), 50 * TOGETHER):
            some = [plain[at : at + TOGETHER] for at in range(i, min(i + 50 * TOGETHER, len(plain)), TOGETHER)]
            texts = [self.between.join([pieces[k] for k in own]) for own in some]
            for own, found in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(found.ids, self.dtype)
                ends = self._ends(ids, [len(pieces[k].encode()) for k in own])
                data, at = ids.tobytes(), 0
                for k, end in zip(own, (ends * self.dtype.itemsize).tolist(), strict=True):
                    out[k] = data[at:end]
                    at = end
        others = [k for k, p in enumerate(pieces) if p and not self.word.fullmatch(p)]
        for i in range(0, len(others), 20_000):
            found = self.tokenizer.encode_batch_fast([pieces[k] for k in others[i : i + 20_000]], add_special_tokens=False)
            for k, f in zip(others[i : i + 20_000], found, strict=True):
                out[k] = np.array(f.ids, self.dtype).tobytes()
        return out

    def _ends(self, ids: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Where each of some words that were encoded together ends in their ids."""
        if self.lasts is not None:  # each word ends with the one token that has the end-of-word mark
            return np.flatnonzero(self.lasts[ids]) + 1
        return np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes)) + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker and file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def as_u4(ids: bytes, dtype: np.dtype) -> bytes:
    """The same ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()
