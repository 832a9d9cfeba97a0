"""Keeping documents by rules and by labelling their lines.

A linear-chain conditional random field marks each line of a document as content
or boilerplate; Viterbi decoding finds the likeliest marks, and the share of
characters in content lines decides. The field is fitted to a bounded sample of
documents with a quality label. Its targets are lines: in good documents those that
show weak signs of boilerplate (notices, many symbols, a line said before) count as
boilerplate and all others as content; bad documents have no content.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, map_slices, utf8_values

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
VERDICTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    with np.errstate(over="ignore"):
        hashed = np.zeros(n, np.uint64)
        for k in range(width):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
        hashed ^= hashed >> np.uint64(31)
    ordered = np.sort(hashed)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal hashes
        return 0
    rank, span = codes.astype(np.int64), 1
    while span < width:  # ranks of windows, doubled in width: exact
        rank = np.unique(rank[:-span] * (len(words) + 1) + rank[span:], return_inverse=True)[1]
        span *= 2
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1]) > 0))


@dataclass(frozen=True)
class Counts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < 20 or 100 * self.n_repeat_words > 30 * self.n_words


def counts(text: bytes) -> Counts:
    """The base figures of a UTF-8 text; bytes.split() parts at \\x20 and \\x09-\\x0d."""
    words = text.split()
    lines, again = set(), 0
    for line in text.split(b"\n"):
        if line in lines:
            again += 1
        elif line.strip():
            lines.add(line)
    joined = b"".join(words)
    return Counts(len(words), len(joined.decode()), sum(text.count(bytes([c])) for c in SYMBOLS), again, repeated_words(words))


# --- lines --------------------------------------------------------------------

#: Words that often stand in notices; matched without regard to case.
NOTICE = re.compile(rb"licen[cs]e|copyright|cookie|all rights|subscribe|sign in|privacy|terms of|click here|share this", re.I)
FEATURES = 14
#: Features that are weak signs of boilerplate: many symbols, notices, lines said before.
SIGNS = [4, 8, 9]


def line_features(lines: list[bytes]) -> np.ndarray:
    """Binary features of each line."""
    out = np.zeros((len(lines), FEATURES), np.float32)
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n, size = len(words), max(1, len(line))
        marks = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
        upper = sum(w.isupper() for w in words)
        row = out[i]
        row[0] = 1
        row[1] = n <= 3
        row[2] = 3 < n <= 8
        row[3] = n > 20
        row[4] = 20 * marks > size
        row[5] = 2 * upper > n
        row[6] = n > 3 and 2 * len(set(words)) < n
        row[7] = line.rstrip()[-1:] in b".!?:;" and n > 0
        row[8] = NOTICE.search(line) is not None
        row[9] = line in seen
        row[10] = 4 * line.count(b"|") > n
        row[11] = line.count(b"!") > 2
        row[12] = 10 * sum(map(line.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))) > size
        row[13] = sum(map(len, words)) > 12 * max(1, n)
        seen.add(line)
    return out


@dataclass(frozen=True)
class LineField:
    """Weights of a two-label chain: label 1 is content."""

    emit: np.ndarray  # (features, 2)
    move: np.ndarray  # (2, 2)

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels; content wins ties."""
        score = (features @ self.emit).tolist()
        (aa, ab), (ba, bb) = self.move.tolist()
        a, b = score[0]
        back = []
        for x, y in score[1:]:
            from_a, from_b = (a + aa > b + ba), (a + ab > b + bb)
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + aa if from_a else b + ba) + x, (a + ab if from_b else b + bb) + y
        label = 0 if a > b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1])


def line_targets(features: np.ndarray, good: int) -> np.ndarray:
    """1 for lines of content: those of good documents without a weak sign of boilerplate."""
    return (features[:, SIGNS].max(axis=1) < 0.5).astype(np.int64) * good if len(features) else np.zeros(0, np.int64)


def fit_field(documents: list[tuple[np.ndarray, int]], steps: int = 80, rate: float = 0.15, ridge: float = 1e-3) -> LineField:
    """Maximum likelihood of the line targets by Adam; forward-backward runs over all documents side by side."""
    emit, move = np.zeros((FEATURES, 2)), np.eye(2) * 0.5
    documents = [d for d in documents if len(d[0])]
    if len({label for _, label in documents}) < 2:
        return LineField(np.tile([0.0, 1e-3], (FEATURES, 1)), move)  # nothing to learn from: all is content
    longest = max(len(f) for f, _ in documents)
    x = np.zeros((len(documents), longest, FEATURES))
    here = np.zeros((len(documents), longest), bool)
    good = np.array([label for _, label in documents])
    gold = np.zeros((len(documents), longest), np.int64)
    for i, (f, label) in enumerate(documents):
        x[i, : len(f)] = f
        here[i, : len(f)] = True
        gold[i, : len(f)] = line_targets(f, label)
    # documents of either label weigh the same together
    weight = np.where(good == 1, 0.5 / max(1, (good == 1).sum()), 0.5 / max(1, (good == 0).sum()))
    moments = [np.zeros_like(p) for p in (emit, emit, move, move)]
    for step in range(1, steps + 1):
        scores = x @ emit
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1][:, :, None] + move[None], axis=1) + scores[:, t]
        for t in range(longest - 2, -1, -1):
            ahead = np.logaddexp.reduce(move[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(here[:, t + 1][:, None], ahead, 0)
        total = np.logaddexp.reduce(forward[:, 0] + backward[:, 0], axis=1)
        # padded places have other sums than their text: they are left out before exp(), not after
        node = np.exp(np.where(here[:, :, None], forward + backward - total[:, None, None], -np.inf))
        lengths = here.sum(axis=1)
        w = weight / lengths
        target = np.stack([here & (gold == 0), here & (gold == 1)], axis=2).astype(float)
        g_emit = np.einsum("ntf,ntl,n->fl", x, target - node, w) - ridge * emit
        g_move = -ridge * move
        for t in range(longest - 1):
            both = here[:, t + 1]
            if not both.any():
                break
            edge = np.exp(forward[both, t][:, :, None] + move[None] + (scores[both, t + 1] + backward[both, t + 1])[:, None, :] - total[both][:, None, None])
            want = np.zeros_like(edge)
            want[np.arange(len(edge)), gold[both, t], gold[both, t + 1]] = 1
            g_move += np.einsum("nij,n->ij", want - edge, w[both])
        for k, (p, g) in enumerate(((emit, g_emit), (move, g_move))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m = moments[2 * k] = 0.9 * m + 0.1 * g
            v = moments[2 * k + 1] = 0.99 * v + 0.01 * g * g
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    if not (np.isfinite(emit).all() and np.isfinite(move).all()):
        raise ArithmeticError("the field's weights are not finite")
    return LineField(emit, move)


def content_share(text: bytes, field: LineField) -> float:
    """The share of characters in content lines; 0 if there is no word."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if not lines:
        return 0.0
    labels = field.viterbi(line_features(lines))
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    return float((sizes * labels).sum() / sizes.sum())


def window_of(text: bytes, lines: list[bytes], most: int) -> list[bytes]:
    """At most ``most`` consecutive lines, from a place that the text's hash chooses."""
    first = zlib.crc32(text) % (len(lines) - most + 1) if len(lines) > most else 0
    return lines[first : first + most]


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 1000, most_lines: int = 160, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> LineField:
    """Fit the field to at most ``sample`` labelled documents and ``most_lines`` consecutive lines of each.

    Rows are chosen by a seeded hash of their id, lines of longer documents by a hash of the
    text, so both bounds together bound the driver's memory and time whatever the longest
    document. Only line features come to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    picked = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "label").limit(sample)
    rows = keyed_texts(docs, id_col, text_col).join(picked, "doc_id").select("label", "text")

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for text in (t.encode() for t in frame["text"]):
                features = line_features([x for x in text.split(b"\n") if x.strip()])
                found.append(np.array(window_of(text, list(features), most_lines), features.dtype).reshape(-1, FEATURES))
            yield pd.DataFrame({"label": frame["label"], "lines": [f.astype(np.uint8).tobytes() for f in found]})

    seen = sorted((bytes(r["lines"]), r["label"]) for r in rows.mapInPandas(look, "label int, lines binary").collect())
    return fit_field([(np.frombuffer(b, np.uint8).reshape(-1, FEATURES).astype(np.float32), y) for b, y in seen])


def judge(docs: DataFrame, field: LineField, *, least_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base figures of each row, its content share and verdict; no shuffle.

    A null or empty text has no words and fails. Repeated rows and null ids are kept.
    A row is kept if the base rules pass and ``least_share`` of its characters are content.
    """

    def setup():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: dict[str, list] = {c.split()[0]: [] for c in VERDICTS.split(", ")[1:]}
            for text in utf8_values(batch.column(1)):
                c, share = counts(text), content_share(text, field)
                values = (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.failed, share, not c.failed and share >= least_share)
                for column, v in zip(out.values(), values, strict=True):
                    column.append(v)
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], ["doc_id", *out])

        return run

    return map_slices(keyed_texts(docs, id_col, text_col), setup, VERDICTS)
