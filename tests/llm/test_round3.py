"""Ranked search, alignment of tokenizers and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poolside.llm import align, decontaminate, ranked_search

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ITEM = "When the Mörder came home, nobody had seen the 14 small boats leave the old harbour at dawn again"
COMMON = "word after word after word after word after word after word"
DOCS = [
    (1, "Intro. " + ITEM + ". Outro of its own."),
    (2, "when the MÖRDER came home nobody HAD seen the 14 small boats"),  # one letter differs only in a case beyond A-Z: no hit for Ö
    (3, "when the mörder -- came home? nobody had seen the 14 small boats. leave the old harbour at noon"),
    (4, ""),
    (5, None),
    (6, "tiny"),
    (7, "a short item; and tiny things"),
    (8, COMMON + " " + COMMON),
    (9, "x " * 5000 + ITEM),
    (9, "x " * 5000 + ITEM),
    (None, ITEM + " " + ITEM),
    (12, "word " * 3000),
    (13, "\x00   ÀÉ éß ﬁ x y"),
]
ITEMS = [("a", ITEM), ("b", COMMON), ("c", "short item"), ("c", "short item"), ("d", "Tiny"), ("e", ""), ("f", None), (None, "own"), ("g", "never found anywhere in any of the documents here at all")]


def _table(spark, rows, schema, n=3):
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns({"score": F.lit("x"), "start": F.lit(1), "a.b": F.lit(2), "pair": F.lit(None).cast("int")}).repartition(n)


@pytest.fixture(scope="module")
def docs(spark):
    return _table(spark, DOCS, "doc_id long, text string").cache()


@pytest.fixture(scope="module")
def items(spark):
    return _table(spark, ITEMS, "item_id string, text string", 1)


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _contaminated(docs, items):
    windows = {}
    for item, text in items:
        w = _words(text)
        for s in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[s : s + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = _words(text), set(), set()
        for g, own in windows.items():
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit.update(range(s, s + len(g)))
                    found |= own - {None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_decontamination(spark, docs, items):
    got = decontaminate.contaminated(docs, items)
    assert Counter(tuple(r) for r in got.collect()) == _contaminated(DOCS, ITEMS)
    hits = {r.doc_id: r.n_hit for r in got.collect()}
    assert hits[1] == 20 and hits[2] == 0 and hits[9] == 19 and hits[6] == 1


def test_decontamination_with_few_words(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 400)))) for i in range(40)]
    items = [(str(i), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))) for i in range(12)]
    got = decontaminate.contaminated(_table(spark, docs, "doc_id long, text string"), _table(spark, items, "item_id string, text string"))
    assert Counter(tuple(r) for r in got.collect()) == _contaminated(docs, items)


def test_decontamination_of_empty_tables(spark, docs, items):
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contaminated(no_docs, items).collect() == []
    clean = decontaminate.contaminated(docs, no_items).collect()
    assert len(clean) == len(DOCS) and not any(r.contaminated or r.n_hit or r.n_items for r in clean)


def test_decontamination_uses_no_python(docs, items):
    windows, _ = decontaminate.windows_of(items)
    hits, rows = decontaminate.occurrences(docs, windows)
    for frame in (windows, hits, rows):
        assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().toString())


def _search(docs, items, k):
    terms_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    have = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs, length = sum(bool(w) for _, w in have), sum(w.total() for _, w in have)
    out = []
    for item, text in items:
        scored = []
        for d, words in have:
            m, score = 100 - 50 + (50 * words.total() * n_docs) // length, 0
            for t in set(terms_of(text)) & set(words):
                df = sum(t in w for _, w in have)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1_000_000_000 * words[t]) // (1000 * words[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("k", [2, 50])
def test_ranked_search(docs, items, k):
    assert Counter(tuple(r) for r in ranked_search.search(docs, items, k).collect()) == _search(DOCS, ITEMS, k)


@pytest.mark.parametrize("options", [{}, {"BLOCK_BYTES": 60, "SLICE": 2000, "STEP": 3, "MATRIX_BYTES": 4096}])
def test_ranked_search_with_ties_and_crowded_sketches(spark, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzüvw"]
    docs = [(i % 90, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 3, 40, 700])))) for i in range(120)] + [(500 + i, "ax by") for i in range(70)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(25)]
    found = ranked_search.search(_table(spark, docs, "doc_id long, text string", 5), _table(spark, items, "item_id long, text string"), 20)
    assert Counter(tuple(r) for r in found.collect()) == _search(docs, items, 20)


def test_bounds_are_never_below_scores():
    rng = random.Random(6)
    words = [f"w{i}".encode() for i in range(300)]
    texts = [b" ".join(rng.choices(words, k=rng.randint(0, 500))) for _ in range(50)]
    postings = ranked_search.Postings(texts)
    postings.impacts(50, int(postings.sizes.sum()))
    asked = ranked_search.Queries([rng.sample(words, 20) for _ in range(8)], {w: i for i, w in enumerate(words)})
    number = {t: i for i, t in enumerate(postings.terms)}
    for width, some, sketch in ranked_search.Sketches(postings).blocks():
        bounds = asked.bounds(width, sketch)
        for q, (terms, weights) in enumerate(zip(asked.terms, asked.weights, strict=True)):
            there = [(number[t], w) for t, w in zip(terms, weights, strict=True) if t in number]
            exact = postings.scores(some, *(__import__("numpy").array(x) for x in zip(*there, strict=True)))
            assert (bounds[:, q] >= exact).all() and (exact >= 0).all()


def test_search_of_empty_tables(spark, docs, items):
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")
    assert ranked_search.search(no_docs, items).collect() == []
    assert ranked_search.search(docs, no_items).collect() == []


class _Plain:
    """Alignment by comparing all tokens of a text."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.a.encode_special_tokens = True
        known = align.aligner(BYTE, PIECE)
        self.bytes = known.a.tokens, known.b.tokens

    def text(self, text):
        none = 0, 0, 0, "", []
        if not text:
            return none
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spans = []
        for own, tokens in zip(ids, self.bytes, strict=True):
            if b"".join(tokens[i] for i in own) != (" " + text).encode():
                return none
            at, s = 0, []
            for i in own:
                s.append((at, at + len(tokens[i])))
                at += len(tokens[i])
            spans.append(s)
        links = [(ids[0][i], ids[1][j]) for i, (x, y) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if x < v and u < y]
        low, groups = 0, []
        for cut in sorted({y for _, y in spans[0]} & {v for _, v in spans[1]}):
            groups.append("|".join(",".join(str(own[i]) for i, (x, y) in enumerate(s) if low <= x and y <= cut) for own, s in zip(ids, spans, strict=True)))
            low = cut
        return len(ids[0]), len(ids[1]), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links

    def corpus(self, rows):
        found = [(d, self.text(t)) for d, t in rows]
        counts = Counter(p for _, x in found for p in x[4])
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(n, most.get(b, 0))
        return Counter(
            (d, a, b, g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha) for d, (a, b, g, sha, links) in found
        )


def _hostile(n):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "▁", "日本", "<s>", "</s>", "<|endoftext|>", "\t", "\x00", "\x1c", " ", " ", "👍", "the ", "ing", "'s", "1", ".", "<0x41>", "\r\n"]
    return [None, "", " ", "  ", "x ", "▁", " leading", "trail  ", "\n", "a\n b"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("size", [align.BATCH_BYTES, 500])
def test_alignment(spark, monkeypatch, size):
    monkeypatch.setattr(align, "BATCH_BYTES", size)
    rows = [*DOCS[:8], *DOCS[10:], *((100 + k, t) for k, t in enumerate(_hostile(600)))]
    got = align.align(_table(spark, rows, "doc_id long, text string"), BYTE, PIECE).collect()
    assert Counter(tuple(r) for r in got) == _Plain().corpus(rows)
    assert sum(r.n_a > 0 for r in got) > 250


def test_alignment_of_an_empty_table_and_of_a_long_text(spark):
    assert align.align(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).collect() == []
    long = [(1, "no_blank_at_all" * 20_000), (2, "many words here " * 30_000)]
    got = {r.doc_id: r for r in align.align(spark.createDataFrame(long, "doc_id long, text string"), BYTE, PIECE).collect()}
    plain = _Plain()
    for i, t in long:
        assert got[i].n_a == len(plain.a.encode(" " + t, add_special_tokens=False).ids) and got[i].n_b == len(plain.b.encode(t))


def test_line_quality_stays_with_a_very_long_document(spark):
    """One labelled document of 5,000 lines beside short ones changes no verdict, and training sees a bounded part of it."""
    from poolside.llm import line_quality

    good, bad = "It is a plain sentence with quite a few words in it.\nAnd here is one more of them, to be read by all.\n", "#### $$$ | %%% &&& | *** ###\n" * 3
    rows = [(i, f"Number {i} of many. {good * (1 + i % 3)}" if i % 2 else f"{i} {bad}") for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(60)]
    kind, label = "doc_id long, text string", "doc_id long, quality int, toxic int"
    long = (1000, "".join(f"Line {k} says that there is something to read, and then some more.\n" for k in range(5000)))
    plain = line_quality.train(spark.createDataFrame(rows, kind), spark.createDataFrame(labels, label))
    table = spark.createDataFrame([*rows, long], kind)
    mixed = line_quality.train(table, spark.createDataFrame([*labels, (1000, 1, 0)], label))
    verdicts = [{r.doc_id: r.content_share >= 0.5 for r in line_quality.judge(table, f).collect()} for f in (plain, mixed)]
    assert verdicts[0] == verdicts[1] and verdicts[1][1] and not verdicts[1][2] and verdicts[1][1000]
    seen = line_quality.window_of(b"x", [b"%d" % k for k in range(5000)], 160)
    assert len(seen) == 160 and int(seen[-1]) - int(seen[0]) == 159


def test_stages_take_columns_of_any_name(spark):
    """Names with a dot, a blank or a clash pass every stage that keeps the columns of its documents."""
    from poolside.llm import near_sets, pii, simhash, suffixes, toxicity

    rows = [(1, "some words of a text that is here to stay for all of us", 1), (2, "other words of another text, mail a.b@example.com", None), (None, None, 3), (4, "", 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, extra int").withColumnsRenamed({"extra": "a.b"}).withColumns({"a b": F.lit(1), "row": F.lit("x"), "score": F.lit(2), "known": F.lit(3), "n": F.lit(4)})
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for kept in (
        toxicity.reject_toxic(table, toxicity.train(table, labels)), near_sets.first_of_each_group(table), simhash.first_of_each_group(table), pii.redact(table),
        suffixes.remove_repeated(table, keep_text=True, carry=True).select("rest.*"),
    ):
        assert set(kept.columns) >= {"doc_id", "a.b", "a b", "row", "score", "known", "n"} and kept.count() >= 3
    nothing = table.limit(0)
    assert toxicity.reject_toxic(nothing, toxicity.train(table, labels)).count() == near_sets.first_of_each_group(nothing).count() == pii.redact(nothing).count() == suffixes.remove_repeated(nothing, keep_text=True, carry=True).count() == 0


def test_a_url_rate_does_not_tell_its_own_label(spark):
    from poolside.llm import urls

    ruled = urls.with_features(urls.with_rule(urls.with_parts(spark.createDataFrame([(i, f"https://h{i}.{'org' if i % 2 else 'com'}/{'x' if i % 2 else 'de'}/{i}") for i in range(60)], "page_id long, url string")), urls.RULES)).where("ruled is not null")
    model = urls.train(ruled)
    seen, blind = (({r.url: r["domain_rate"] for r in model.features(ruled, out_of_fold=own).collect()}) for own in (False, True))
    assert len({round(v, 6) for v in blind.values()}) == 1 and len({round(v, 6) for v in seen.values()}) == 2
