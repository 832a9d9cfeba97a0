"""Toxicity by a weighted finite-state grammar over clauses.

Each word of a clause belongs to a class: insult, harm, target, negation, report or
other. Small weighted machines read the classes side by side and are composed into
one: an insult scores, more so near a target; harm done to a target is a threat;
a negation just before takes most of the score away, reported speech some. Clauses
are scored as wholes, and a logistic model turns the clause scores of a text into
a probability. Insults are learned: words, and beginnings of words, that are much
more frequent in texts labelled toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, keyed_texts, map_slices, slices

OTHER, INSULT, HARM, TARGET, NEGATION, REPORT = range(6)

# Fixed word lists, in English, German, French and Spanish.
WORDS = {
    HARM: "kill hurt beat destroy burn shoot stab punch strangle töten schlagen umbringen verletzen tuer tuerai frapper brûler matar golpear quemar herir",
    TARGET: "you your yours yourself du dich dir dein deine ihr euch tu toi ton ta vous votre vos tú ti usted ustedes vosotros eres",
    NEGATION: "not never isn't aren't don't nicht kein keine nie jamais aucun aucune nunca jamás tampoco",
    REPORT: "said says saying wrote writes called calls quoted reported allegedly sagte sagt schrieb nannte berichtete dit écrit déclaré dijo dice escribió llamó",
}
CLAUSE = re.compile(r"[.!?;\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
STEM = 6
LEAST_EVIDENCE = 6.0
FEATURES = 7


class Machine:
    """A weighted transducer over word classes: (state, class) to (state, factor, bonus).

    factor scales the weight of an insult read now; bonus is scored for itself.
    """

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, float, float]], decay: int):
        self.arcs, self.decay = arcs, decay

    def step(self, state: int, read: int) -> tuple[int, float, float]:
        """Without an arc a state counts down to 0, which is 'nothing near'."""
        return self.arcs.get((state, read)) or (max(0, state - self.decay), 1.0, 0.0)


def _near(opens: int, reach: int, factor: float, decay: int = 1) -> Machine:
    """After a word of class opens, insults within reach words are scaled."""
    arcs = {(s, opens): (reach, 1.0, 0.0) for s in range(reach + 1)}
    arcs |= {(s, INSULT): (max(0, s - decay), factor, 0.0) for s in range(1, reach + 1)}
    return Machine(arcs, decay)


def machines() -> list[Machine]:
    addressed = _near(TARGET, 4, 1.5)
    denied = _near(NEGATION, 3, 0.3)
    reported = _near(REPORT, 1, 0.6, decay=0)  # holds to the end of the clause
    # an insult just before its target scores as well: "idiot, you"
    vocative = Machine({**{(s, INSULT): (3, 1.0, 0.0) for s in range(4)}, **{(s, TARGET): (0, 1.0, 0.5) for s in range(1, 4)}}, 1)
    threat = Machine({**{(s, HARM): (4, 1.0, 0.0) for s in range(5)}, **{(s, TARGET): (0, 1.0, 1.0) for s in range(1, 5)}}, 1)
    # a second insult in a clause is no accident
    piled = Machine({(0, INSULT): (1, 1.0, 0.0), (1, INSULT): (1, 1.3, 0.0)}, 0)
    return [addressed, denied, reported, vocative, threat, piled]


class Grammar:
    """The machines, composed; transitions of the product are made when first taken."""

    def __init__(self) -> None:
        self.parts = machines()
        self.start = (0,) * len(self.parts)
        self.table: dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], float, float]] = {}

    def step(self, state: tuple[int, ...], read: int) -> tuple[tuple[int, ...], float, float]:
        found = self.table.get((state, read))
        if found is None:
            steps = [m.step(s, read) for m, s in zip(self.parts, state, strict=True)]
            factor = float(np.prod([f for _, f, _ in steps]))
            found = self.table[state, read] = (tuple(s for s, _, _ in steps), factor, sum(b for _, _, b in steps))
        return found

    def score(self, clause: list[tuple[int, float]]) -> float:
        state, total = self.start, 0.0
        for read, weight in clause:
            state, factor, bonus = self.step(state, read)
            total += weight * factor + bonus
        return total


class Lexicon(dict):
    """Word to (class, weight), remembering at most so many words."""

    def __init__(self, insults: dict[str, float], entries: int = 60_000):
        super().__init__()
        self.insults, self.entries = insults, entries
        self.fixed = {w: c for c, words in WORDS.items() for w in words.split()}

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= self.entries:
            self.clear()
        if word in self.fixed:
            out = (self.fixed[word], 0.0)
        elif word in self.insults:
            out = (INSULT, self.insults[word])
        elif len(word) > STEM and word[:STEM] + "*" in self.insults:
            out = (INSULT, 0.5 * self.insults[word[:STEM] + "*"])
        else:
            out = (OTHER, 0.0)
        self[word] = out
        return out


def features(text: str, lexicon: Lexicon, grammar: Grammar) -> list[float]:
    """What the clauses of a text score together."""
    words = matched = clauses = 0
    total = most = insults = 0.0
    kinds: dict[str, float] = {}
    for clause in CLAUSE.split(text.lower()):
        found = WORD.findall(clause)
        if not found:
            continue
        clauses += 1
        words += len(found)
        read = list(map(lexicon.__getitem__, found))
        own = [w for w, (c, _) in zip(found, read, strict=True) if c == INSULT]
        if not own and not any(c == HARM for c, _ in read):
            continue
        score = grammar.score(read)
        # what the grammar leaves of the clause's insults: little if they are denied, less than all if reported
        strength = min(1.0, score / max(1e-9, sum(w for _, w in read))) if own else 0.0
        for w in own:
            kinds[w] = max(kinds.get(w, 0.0), strength)
        insults += len(own) * strength
        if score > 0:
            matched += 1
            total += score
            most = max(most, score)
    n = max(1, words)
    return [np.log1p(total), min(20.0, 100 * total / n), min(10.0, most), np.log1p(matched), np.log1p(sum(kinds.values())), min(10.0, 100 * insults / n), matched / max(1, clauses)]


@dataclass(frozen=True)
class ToxicityModel:
    insults: dict[str, float]
    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.spread] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps; without both labels the base rate alone."""
    mean, spread = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    w = np.zeros(FEATURES + 1)
    if len(y) == 0 or y.min() == y.max():
        w[0] = -2.0 if len(y) == 0 or y.max() == 0 else 2.0
        return w, mean, spread
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    penalty = np.r_[0.0, np.full(FEATURES, ridge)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6), z.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, spread


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 24_000, least: float = LEAST_EVIDENCE, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn insults and weights from about ``sample`` labelled rows outside the held-out ones.

    Half of the rows, by a seeded hash of the id, give the insults, and the other half
    the weights, so that words which only the first half makes look bad get no credit.
    Counts by word are made by Spark; the driver gets the words and beginnings whose evidence
    (log odds by the root of the count) is ``least`` or more, which the sample bounds, and
    seven numbers for each row of the second half.
    """
    ids = F.col("doc_id")
    known = labels.select(ids.cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(~held_out(ids)).dropDuplicates(["doc_id"])
    share = min(1.0, sample / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000))
    known = known.withColumn("place", place).where(F.col("place") < int(share * 1_000_000))
    texts = keyed_texts(docs, id_col, text_col).where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = texts.join(known, "doc_id")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    stems = F.transform(F.filter(words, lambda w: F.length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*")))
    first = rows.where(F.col("place") % 2 == 0)
    sizes = first.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    toxic, clean = sizes["t"] or 0, sizes["c"] or 0
    found: dict[str, float] = {}
    if toxic and clean:
        counts = first.select("toxic", F.explode(F.array_union(words, F.array_distinct(stems))).alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("toxic").alias("n"))
        odds = F.log((F.col("t") + 0.3) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.3) / (clean + 1))
        ranked = counts.where("t >= 2").withColumn("odds", odds).where("odds > 1.5").where(F.col("odds") * F.sqrt("t") >= least).orderBy("word")
        found = {r["word"]: float(min(r["odds"], 6.0)) / 4 for r in ranked.collect() if r["word"] not in {w for ws in WORDS.values() for w in ws.split()}}

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, grammar = Lexicon(found), Grammar()
        for frame in frames:
            x = np.array([features(t, lexicon, grammar) for t in frame["text"]], np.float32).reshape(-1, FEATURES)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "x": list(map(bytes, x))})
            give_back()

    seen = sorted((r["doc_id"], bytes(r["x"]), r["toxic"]) for r in rows.where(F.col("place") % 2 == 1).select("doc_id", "text", "toxic").mapInPandas(look, "doc_id long, toxic int, x binary").collect())
    x = np.array([np.frombuffer(b, np.float32) for _, b, _ in seen], float).reshape(-1, FEATURES)
    return ToxicityModel(found, *fit_logistic(x, np.array([y for *_, y in seen], float)))


def score_texts(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; no shuffle.

    A null or empty text has no clause and gets the score of that. Repeated rows and
    null ids are kept; a null id is not held out. Only the text is scored.
    """

    def setup():
        lexicon, grammar = Lexicon(model.insults), Grammar()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([features(t, lexicon, grammar) for t in batch.column(1).to_pylist()]).reshape(-1, FEATURES)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(x))], ["doc_id", "score"])

        return run

    scored = map_slices(keyed_texts(docs, id_col, text_col), setup, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, in a filter without a shuffle; other columns may have any name."""

    width = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # mapInArrow() looks names up, and a dot would part them

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, grammar = Lexicon(model.insults), Grammar()
        for batch in batches:
            for rows in slices(batch, f"c{width}"):
                x = np.array([features(t or "", lexicon, grammar) for t in rows.column(width).to_pylist()]).reshape(-1, FEATURES)
                yield rows.filter(pa.array(model.probability(x) < threshold))
            give_back()

    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
