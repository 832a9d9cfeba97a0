"""Finding personal data: fixed patterns, and spans voted for by weak labelers.

Four patterns always count. Beyond them, loose patterns propose candidates, and
labelers vote on each: what the characters look like, which words of a gazetteer
stand before it, and what surrounds it. No labeler is trusted as it is: from the
votes on all candidates of all documents, expectation-maximisation estimates how
reliable each is (Dawid and Skene, 1979), and what it believes of each candidate
trains a logistic classifier, which decides.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, keyed_texts, map_slices, slices

KINDS = ("email", "ip", "card", "phone")
ADDED = ("secret", "national_id", "local_phone", "spoken_email", "iban")
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
Span = tuple[int, int, str]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Groups of digits with single dots between them; four in a row are a match of [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+).
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches can only end their first part at an @, so only the runs before one are tried."""
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and not NOT_LOCAL.match(text[start - 1]):
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            yield start, match.end(), "email"
            after = match.end()
        at = text.find("@", max(after, at + 1))


def _ips(text: str) -> Iterator[Span]:
    """Fours of the groups of each dotted chain, one after the other, so that long runs of digits are read once."""
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        start, groups = m.start(), m.group().split(".")
        for k in range(0, len(groups) - 3, 4):
            four = groups[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g[-3:]) <= 255 for g in four):
                yield start, end, "ip"
            start = end + 1


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then by kind as listed."""
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        found += _ips(text)
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- candidates and labelers ---------------------------------------------------

CANDIDATES = re.compile(
    r"(?P<secret>(?<![A-Za-z0-9_])[A-Za-z0-9_/+=-]{24,}(?![A-Za-z0-9_]))"
    r"|(?P<national_id>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<local_phone>(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-]))"
    r"|(?P<spoken_email>[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63} ?(?:\.|[\[(]dot[\])]) ?[A-Za-z]{2,10})"
    r"|(?P<iban>(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|(?: ?[A-Z0-9]{4}){2} ?[A-Z0-9]{3})(?![A-Z0-9]))"
)
#: Where an IBAN can begin, and how far it can go: groups of four, of which the last may be shorter.
IBAN_START = re.compile(r"(?<![A-Za-z0-9_])(?=[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4})")
IBAN_GROUPS = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
#: Some character without which a text has no candidate.
HINT = re.compile(r"[0-9]|[\[(]at[\])]")
#: Gazetteer: words that announce each kind.
CUES = {
    "secret": ("token", "key", "secret", "password", "passwd", "bearer", "credential", "auth"),
    "national_id": ("ssn", "social security", "national id", "tax id"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "spoken_email": ("mail", "contact", "write", "reach"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
}
WRONG_CUES = ("version", "isbn", "page", "build", "commit", "checksum", "figure", "price")
LABELERS = 5


def is_iban(value: str) -> bool:
    compact = value.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans with the check digits of an IBAN, the longest at each place."""
    out, after = [], 0
    for at in IBAN_START.finditer(text):
        start = at.start()
        m = IBAN_GROUPS.match(text, start) if start >= after else None
        if not m:
            continue
        for end in range(m.end(), start + 14, -1):
            if text[end - 1] != " " and not re.match(r"[A-Za-z0-9_]", text[end : end + 1]) and is_iban(text[start:end]):
                out.append((start, end))
                after = end
                break
    return out


def _shape_vote(kind: str, value: str) -> int:
    """1 for, -1 against, 0 abstains."""
    if kind == "secret":
        digits, letters = sum(map(str.isdigit, value)), sum(map(str.isalpha, value))
        return 1 if digits >= 6 and letters >= 4 and len(set(value)) >= 10 else -1
    if kind == "national_id":
        return -1 if value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[-4:] == "0000" else 1
    if kind == "local_phone":
        digits = re.sub(r"\D", "", value)
        return -1 if digits[0] in "01" or digits[3] in "01" else 1
    if kind == "iban":
        return 1 if is_iban(value) else -1
    return 1


def votes(text: str, kind: str, start: int, end: int, near: bool) -> tuple[int, ...]:
    """One vote of each labeler on a candidate."""
    before = text[max(0, start - 40) : start].lower()
    close = before[-16:]
    return (
        _shape_vote(kind, text[start:end]),
        1 if any(c in before for c in CUES[kind]) else 0,
        -1 if any(c in close for c in WRONG_CUES) else 0,
        1 if re.search(r"[:=]\s*[\"'(]?$", close) else (-1 if kind == "secret" else 0),
        1 if near else 0,
    )


class _Intervals:
    """Spans that can be asked what they touch, in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = sorted(s for s, _ in spans), sorted(e for _, e in spans)
        merged: list[list[int]] = []
        for s, e in sorted(spans):
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        self.merged, self.firsts = merged, [s for s, _ in merged]

    def touches(self, start: int, end: int) -> bool:
        k = bisect.bisect_left(self.firsts, end) - 1
        return k >= 0 and self.merged[k][1] > start

    def holds(self, start: int, end: int) -> bool:
        k = bisect.bisect_right(self.firsts, start) - 1
        return k >= 0 and self.merged[k][1] >= end

    def near(self, start: int, end: int, reach: int = 200) -> bool:
        within = lambda places, at: bisect.bisect_right(places, at - reach) < bisect.bisect_left(places, at + reach)
        return within(self.starts, end) or within(self.ends, start)


def candidates(text: str, base: list[Span]) -> list[tuple[Span, tuple[int, ...]]]:
    """Candidate spans with their votes: whole IBANs, and what else touches no base span."""
    if not HINT.search(text):
        return []
    whole = ibans(text)
    fixed, accounts = _Intervals([(s, e) for s, e, _ in base]), _Intervals(whole)
    spans = [(s, e, "iban") for s, e in whole]
    for m in CANDIDATES.finditer(text):
        kind, (start, end) = m.lastgroup, m.span()
        if fixed.touches(start, end) or (accounts.touches(start, end) if kind == "iban" else accounts.holds(start, end)):
            continue
        spans.append((start, end, kind))
    return [((start, end, kind), votes(text, kind, start, end, fixed.near(start, end))) for start, end, kind in spans]


def pattern_of(kind: str, vote: tuple[int, ...]) -> int:
    """A number for kind and votes; there are 5 * 3 ** 5 of them."""
    out = ADDED.index(kind)
    for v in vote:
        out = out * 3 + v + 1
    return out


def pattern_votes(pattern: int) -> tuple[int, np.ndarray]:
    out = []
    for _ in range(LABELERS):
        out.append(pattern % 3 - 1)
        pattern //= 3
    return pattern, np.array(out[::-1])


@dataclass(frozen=True)
class SpanClassifier:
    weights: dict[int, float]  # probability by pattern, for all patterns that there can be
    reliability: np.ndarray  # P(vote | class), (labelers, classes, votes)

    def accepts(self, kind: str, vote: tuple[int, ...], least: float = 0.5) -> bool:
        if kind == "iban":  # its check digits decide
            return vote[0] > 0
        return self.weights[pattern_of(kind, vote)] >= least


def _pattern_features(patterns: np.ndarray) -> np.ndarray:
    rows = []
    for p in patterns.tolist():
        kind, v = pattern_votes(p)
        rows.append(np.r_[1.0, np.eye(len(ADDED))[kind], v > 0, v < 0, v[0] * v[1], v[0] * v[3]])
    return np.array(rows, float)


def aggregate_votes(counts: dict[int, int], rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over counts of vote patterns: (patterns, posterior, reliability)."""
    patterns = np.array(sorted(counts), np.int64)
    n = np.array([counts[p] for p in patterns.tolist()], float)
    v = np.array([pattern_votes(p)[1] for p in patterns.tolist()]).reshape(-1, LABELERS)
    post = 1 / (1 + np.exp(-1.2 * v.sum(axis=1)))  # begin with the majority
    table = np.full((LABELERS, 2, 3), 1 / 3)
    # a labeler is taken to be better than chance: pseudo-counts in favour of its own vote
    prior = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])
    for _ in range(rounds):
        both = np.stack([n * (1 - post), n * post])
        for k in range(LABELERS):
            for c in range(2):
                mass = np.array([both[c][v[:, k] == x].sum() for x in (-1, 0, 1)]) + prior[c]
                table[k, c] = mass / mass.sum()
        share = (both[1].sum() + 1) / (n.sum() + 2)
        score = np.log(share / (1 - share)) + sum(np.log(table[k, 1, v[:, k] + 1]) - np.log(table[k, 0, v[:, k] + 1]) for k in range(LABELERS))
        post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return patterns, post, table


#: Counts of vote patterns are scaled down until the largest is no more than this: Newton steps then stay well conditioned beside the prior.
LARGEST_COUNT = 1e6


def fit_classifier(counts: dict[int, int]) -> SpanClassifier:
    """A logistic classifier trained on the posteriors, by Newton steps over the patterns."""
    every = np.arange(len(ADDED) * 3**LABELERS)
    features = _pattern_features(every)
    if not counts:
        w = np.zeros(features.shape[1])
        w[0] = -1.0
        table = np.full((LABELERS, 2, 3), 1 / 3)
    else:
        patterns, post, table = aggregate_votes(counts)
        n = np.array([counts[p] for p in patterns.tolist()], float)
        x, n = features[patterns], n * min(1.0, LARGEST_COUNT / n.max())  # one factor for all, so that their weights keep their relation
        w = np.zeros(x.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (n * (post - p)) - w
            hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
    return SpanClassifier(dict(zip(every.tolist(), (1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))).tolist(), strict=True)), table)


def count_votes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> dict[int, int]:
    """How often each vote pattern occurs in all documents; at most 1,215 rows reach the driver."""

    def setup():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            seen: dict[int, int] = {}
            for text in batch.column(1).to_pylist():
                if HINT.search(text):
                    for (_, _, kind), vote in candidates(text, base_spans(text)):
                        p = pattern_of(kind, vote)
                        seen[p] = seen.get(p, 0) + 1
            return pa.RecordBatch.from_pydict({"pattern": pa.array(seen.keys(), pa.int64()), "n": pa.array(seen.values(), pa.int64())})

        return run

    found = map_slices(keyed_texts(docs, id_col, text_col), setup, "pattern long, n long")
    return {r["pattern"]: r["n"] for r in found.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


def all_spans(text: str, model: SpanClassifier) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    more = [span for span, vote in candidates(text, base) if model.accepts(span[2], vote)]
    order = (*KINDS, *ADDED)
    return base, sorted(base + more, key=lambda s: (s[0], order.index(s[2])))


def find_personal_data(docs: DataFrame, model: SpanClassifier | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, a digest of the base spans, and all spans of each row; no shuffle.

    A null or empty text has none. Repeated rows and null ids are kept. Without a
    model, one is fitted to the votes on all documents first.
    """
    model = model or fit_classifier(count_votes(docs, id_col=id_col, text_col=text_col))

    def setup():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text, model)
                kinds = [s[2] for s in base]
                for column, v in zip(out, [*map(kinds.count, KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)], strict=True):
                    column.append(v)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string()), pa.array(out[5], pa.string())],
                [c.split()[0] for c in RESULT.split(", ")],
            )

        return run

    return map_slices(keyed_texts(docs, id_col, text_col), setup, RESULT)


def redacted(text: str, model: SpanClassifier) -> str:
    """text with each stretch covered by spans replaced by the kind of the first."""
    out, at, end_before = [], 0, 0
    for start, end, kind in all_spans(text, model)[1]:
        if start < end_before:
            end_before = max(end_before, end)
            at = end_before
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end_before = end
    return "".join([*out, text[at:]])


def redacted_batches(batches: Iterator[pa.Array], model: SpanClassifier) -> Iterator[pa.Array]:
    """Redacted texts, null where they are null. Texts become Python strings in slices of two megabytes, whatever a batch holds."""
    for texts in batches:
        done = [pa.array([], pa.string())]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            done.append(pa.array([None if t is None else redacted(t, model) for t in part.column(0).to_pylist()], pa.string()))
        yield pa.concat_arrays(done)
        give_back()


def redact(docs: DataFrame, model: SpanClassifier | None = None, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with personal data replaced in the text; null texts stay null, all else is as it was."""
    model = model or fit_classifier(count_votes(docs, id_col=id_col, text_col=text_col))

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return redacted_batches(batches, model)

    return docs.withColumn(text_col, clean(F.col(text_col)))
