"""Operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import os
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poolside.llm import bpe, line_quality, media, near_sets, packing, pii, simhash, sstable, suffixes, toxicity, urls
from poolside.llm.components import components
from poolside.llm.files import open_input
from poolside.llm.tokens import encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = "a passage of well over fifty bytes that several of the documents share, word for word. "
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today. " + PASSAGE),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today. " + PASSAGE),
    (3, PASSAGE + "Another text. Mail ann.b@example.com or +41 (44) 123-4567, card 4111 1111 1111 1111, host 10.0.0.255."),
    (4, ""),
    (5, None),
    (6, "x"),
    (7, "ÀÉ ß ΑΣ ﬁ \x00 \x1c a\u2003b\u00a0c " * 3 + PASSAGE[:60]),
    (8, 'a token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" and <|endoftext|> 123-45-6789'),
    (9, "word " * 3000),
    (9, "word " * 3000),
    (None, "no id at all " + PASSAGE),
    (11, "abcabc" * 40 + PASSAGE),
]
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, EMPTY)
    # extra columns may have any name
    return rows.withColumns({"component_id": F.lit("x"), "score": F.lit(None).cast("int"), "part": F.lit(1), "fp": F.lit(2)}).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EMPTY)


def _fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(simhash.LOWER))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(docs, nothing):
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    want = {(i, f"{_fingerprint(t):016x}") for i, t in ROWS}
    assert {(r.doc_id, r.fingerprint) for r in found} == want
    group = {r.doc_id: r.component_id for r in found}
    assert group[1] == group[2] == 1 and group[4] == group[5] == 4 and group[9] == 9
    assert simhash.near_duplicates(nothing).collect() == []
    kept = simhash.first_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8, 9, 11]
    assert simhash.first_of_each_group(nothing).collect() == []


@pytest.mark.parametrize("operator", [simhash.first_of_each_group, near_sets.first_of_each_group])
def test_each_group_keeps_a_row_whatever_its_ids(spark, operator):
    texts = [" ".join(f"{w}{k}" for k in range(30)) for w in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (None, texts[4]), (3, texts[4]), (9, texts[5]), (8, texts[5] + " ")]
    table = spark.createDataFrame(rows, EMPTY).withColumns({"id": F.lit(1), "mark": F.lit(2), "row": F.lit("x")})
    kept = operator(table)
    assert kept.columns == table.columns
    want = [(0, texts[0]), (0, texts[1]), (3, texts[4]), (7, texts[2]), (7, texts[3]), (8, texts[5] + " ")]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == want


@pytest.mark.parametrize("hot", [50_000, 3])
def test_ball_hashing_links_all_within_four_bits(spark, hot):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centres for _ in range(6)]
    fps = sorted({int(c) for c in centres} | set(near))
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), hot=hot)
    got = {s: s for s in signed} | {r.node: r.root for r in components(links).collect()}
    groups = {}
    for f, s in zip(fps, signed, strict=True):
        groups.setdefault(find(f), set()).add(got[s])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("options", [{}, {"small": 3, "leaders": 1}])
def test_near_copies_equal_brute_force_over_jaccard(spark, options):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    texts = []
    for _ in range(12):
        words = [f"w{x}" for x in rng.integers(0, 4000, 120)]
        for k in range(8):
            own = list(words)
            for at in rng.choice(120, k // 2, replace=False):
                own[at] = f"v{rng.integers(0, 4000)}"
            texts.append(" ".join(own) + (" common closing words of every text here" if k % 2 else ""))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    table = spark.createDataFrame(list(enumerate(texts)), EMPTY)
    assert {r.doc_id: r.component_id for r in near_sets.near_copies(table, **options).collect()} == dict(enumerate(root))
    assert 12 <= len(set(root)) < 40
    if not options:
        assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, table, "").collect()} == set(root)
        assert near_sets.first_of_each_group(table.limit(0)).collect() == []


def test_bitmaps_rule_out_no_similar_sets():
    rng = np.random.default_rng(11)
    passed = 0
    for size in (1, 5, 40, 300, 5000):
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            y = np.unique(np.r_[x[: len(x) - rng.integers(0, 1 + len(x) // 4)], rng.integers(0, 2**63, rng.integers(0, 1 + size // 4)).astype(np.uint64)])
            maps = [np.frombuffer(near_sets.bitmap(v), np.uint64)[None, :] for v in (x, y)]
            shared = len(np.intersect1d(x, y))
            similar = 5 * shared >= 4 * (len(x) + len(y) - shared)
            may = bool(near_sets._overlap(*maps, np.array([len(x)]), np.array([len(y)]))[0])
            assert may or not similar
            passed += may and not similar and size <= 300
    assert passed < 60


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}
    assert components(chain.limit(0)).collect() == []


def _removed(rows):
    """Each 50-byte string by the smallest id that it starts in; null ids come last."""
    last = 1 << 62
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], last), last if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (last if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 300, "crowd": 2}, {"gram": 38, "chunk_bytes": 2000}])
def test_repeated_passages_against_brute_force(spark, docs, nothing, options):
    found = suffixes.remove_repeated(docs, **options).collect()
    assert sorted((tuple(r) for r in found), key=str) == _removed(ROWS)
    assert suffixes.remove_repeated(nothing, **options).collect() == []
    most = spark.createDataFrame([(2**63 - 1, PASSAGE), (None, "other " + PASSAGE)], EMPTY)
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffixes.remove_repeated(most, **options).collect()) == [(0, 0), (2**63 - 1, 0)]


def test_merge_never_loses_order():
    rng = np.random.default_rng(4)
    rows = sorted({bytes(rng.integers(97, 99, 12, dtype=np.uint8)) for _ in range(300)})
    runs, expected = [], []
    for k in range(7):
        own = sorted(rng.choice(len(rows), 40, replace=False).tolist())
        expected += [rows[i] for i in own]
        shared, rests = suffixes.front_code(np.frombuffer(b"".join(rows[i] for i in own), np.uint8).reshape(-1, 12))
        runs.append(suffixes.Run(shared, rests, 12, range(40 * k, 40 * k + 40)))
    out = list(suffixes.merged(runs))
    assert [s for _, s, _ in out] == sorted(expected)
    for (_, a, _), (lcp, b, _) in zip(out, out[1:], strict=False):
        assert lcp == next((i for i in range(12) if a[i] != b[i]), 12)


def test_shards_round_trip(docs, nothing, spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORD)
    manifest = sstable.write_shards(docs, WORD, f"file://{tmp_path}/s", shards=3)
    found = sstable.read_shards(manifest).orderBy("start").collect()
    ids = sorted((-1 if i is None else i) for i, _ in ROWS)
    assert [(-1 if r.doc_id is None else r.doc_id) for r in found] == ids
    at = 0
    of = dict(ROWS)
    for r in found:
        want = tokenizer.encode(of[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    shards = [sstable.ShardReader(open_input(m.path)) for m in manifest.collect()]
    assert sum(len(s.get(9)) for s in shards) == 2 and sum(len(s.get(None)) for s in shards) == 1
    assert not any(s.get(12345) for s in shards)
    assert sstable.token_shards(nothing, WORD).collect() == []


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_bpe_equals_the_library(docs, nothing, path):
    tokenizer = Tokenizer.from_file(path)
    texts = [t or "" for _, t in ROWS] + ["don't I'LL 12½", "  a  b\n\n c\t\td ", "\x85a b", "é ́x", "👩‍👩‍👧 🏳️‍🌈", "ÄÖÜ ÑANDÚ I'M <|ENDOFTEXT|> \xb5\xa0H\u0331 X", "<|EndOfText|> UPPER case <|endoftext|>", "H\u0331 ΣΑΣ İ", "a\n\n b\t\r\n  c d, e.f (g)-h it's\x0b\x0c", " lead", "trail ", "Énée's CAFÉ,%%% x\x00y", "x" * 100 + " ", "\n"]
    model = bpe.ForcedBoundaryBPE(path)
    for text, ids in zip(texts, encoder(path).encode(texts), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == want
        assert np.frombuffer(ids, encoder(path).dtype).tolist() == want
        a, b = model.encoded_and_decoded([text])[0]
        assert (np.frombuffer(a, "<u4").tolist(), b.decode()) == (want, tokenizer.decode(want, skip_special_tokens=False))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.bpe_digests(docs, path).collect()}
    enc = {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in ROWS}
    assert got == {(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in enc.items()}
    assert bpe.bpe_tokens(nothing, path).collect() == []


def test_packing_holds_each_id_once(docs, nothing):
    tokenizer = Tokenizer.from_file(BYTE)
    rows = packing.pack_documents(docs, BYTE, group_docs=5).toPandas()
    assert len(packing.pack_documents(nothing, BYTE).collect()) == 0
    for i, t in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = rows[rows.doc_id.isna()] if i is None else rows[rows.doc_id == i]
        copies = sum(1 for j, _ in ROWS if j == i)
        assert own.length.sum() == copies * len(ids) and (own.doc_tokens == len(ids)).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1].tolist()] and s.length.sum() <= 2048


def test_packing_deals_repeated_rows_over_groups(spark):
    table = spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some words of one text").alias("text")).repartition(4)
    out = packing.pack_documents(table, BYTE, group_docs=1500).groupBy((F.col("sequence_id") / 2**32).cast("int").alias("bunch")).agg(F.sum("length").alias("n")).collect()
    assert len(out) > 1 and sum(r.n for r in out) == 6000 * (len(Tokenizer.from_file(BYTE).encode("some words of one text").ids) + 1)


def test_packing_wastes_little():
    rng = np.random.default_rng(2)
    lengths = np.maximum(1, rng.lognormal(6, 1.5, 3000)).astype(int).tolist()
    found = packing.pack(lengths, 2048, 16)
    used = [sum(n for *_, n in s) for s in found]
    assert sum(used) == sum(lengths) and max(used) <= 2048
    assert sum(2048 - u for u in used if u & (u - 1)) < 0.002 * sum(lengths)
    pieces = sorted(p for s in found for p in s)
    at = {}
    for d, start, n in pieces:
        assert start == at.get(d, 0)
        at[d] = start + n


def _plain_spans(x):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub(r"\D", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 10 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@pytest.mark.parametrize("text", [t or "" for _, t in ROWS] + ["a@b@c.d.e@f.g", "@x.y a@.b %%@a.b", "1.2.3.4.5.6.7.8 0256.1.1.1 00000255.0.0.1", "+1 2+3 4567890123", "4111-1111 11111111 4111111111111111 1"])
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == _plain_spans(text)


def test_personal_data(docs, nothing):
    votes = {pii.pattern_of("secret", (1, 1, 0, 1, 0)): 50, pii.pattern_of("secret", (-1, 0, 0, -1, 0)): 400}
    model = pii.fit_classifier(votes)
    assert model.accepts("secret", (1, 1, 0, 1, 0)) and not model.accepts("secret", (-1, 0, 0, -1, 0))
    found = {r.doc_id: r for r in pii.find_personal_data(docs, model).collect()}
    assert (found[3].n_email, found[3].n_phone, found[3].n_card, found[3].n_ip) == (1, 1, 1, 1)
    assert "secret:" in found[8].spans and found[5].spans == ""
    clean = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert "example.com" not in clean[3] and "[EMAIL]" in clean[3] and clean[5] is None and clean[1] == ROWS[0][1]
    assert pii.find_personal_data(nothing).collect() == []


@pytest.mark.parametrize("iban", ["DE89370400440532013000", "FR1420041010050500013M02606", "GB82WEST12345698765432", "CH9300762011623852957", "ES9121000418450200051332", "NO9386011117947", "MT84MALT011000012345MTLCAST001S", "BE68539007547034"])
def test_ibans_of_any_length_are_redacted_whole(iban):
    model = pii.fit_classifier({})
    for shape in (iban, " ".join(iban[i : i + 4] for i in range(0, len(iban), 4))):
        for text in ("pay to {} today", "account {}", "iban={}.", "{} IS THE BANK ACCOUNT", "AB12 3456 7890 1234 {}"):
            assert pii.redacted(text.format(shape), model) == text.format("[IBAN]"), text.format(shape)
    wrong = iban[:-1] + ("1" if iban[-1] != "1" else "2")
    assert "[IBAN]" not in pii.redacted(f"pay to {wrong} today", model)


def test_long_secrets_are_candidates():
    token = "aB3dE5gH1jK0" * 17
    text = f"token = {token} end"
    assert [s for s, _ in pii.candidates(text, [])] == [(8, 8 + len(token), "secret")] and len(token) > 200


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1." * 500_000, "1.2.3.4 " * 60_000, "a@b.c " * 100_000, "+1 (" * 250_000, "aB3/" * 250_000, "ann[at]" * 140_000, "123-45-6789 x@y.z " * 50_000])
def test_personal_data_in_long_texts_takes_linear_time(text):
    began = time.process_time()
    pii.all_spans(text, pii.fit_classifier({}))
    assert time.process_time() - began < 20


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_words_merge_alike(path):
    rng, codec = np.random.default_rng(9), bpe.ForcedBoundaryBPE(path)
    for n in (65, 200, 3000):
        for letters in ("x", "ab", "etaoin"):
            word = list("".join(rng.choice(list(letters), n)))
            assert codec._merged_by_heap(list(word)) == codec._merged(list(word))


def test_very_long_texts(spark):
    """One word, one line, many lines and many digits, of 200 KB each, through every operator."""
    texts = ["x" * 200_000, "two words " * 20_000, "a line of words here\n" * 10_000, "12 " * 66_000]
    table = spark.createDataFrame(list(enumerate(texts)), EMPTY)
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    began = time.time()
    assert [r.component_id for r in simhash.near_duplicates(table).orderBy("doc_id").collect()] == [0, 1, 2, 3]
    assert near_sets.first_of_each_group(table).count() == 4
    assert all(r.n_bytes == len(texts[r.doc_id]) for r in suffixes.remove_repeated(table).collect())
    assert sstable.token_shards(table, WORD).count() == 4 and bpe.bpe_digests(table, WORD).count() == 4
    assert toxicity.score_texts(table, toxicity.train(table, labels)).count() == 4
    assert pii.find_personal_data(table).count() == 4
    assert {r.kept for r in line_quality.judge(table, line_quality.train(table, labels)).collect()} == {False}
    assert packing.pack_documents(table, BYTE).agg(F.countDistinct("doc_id")).first()[0] == 4
    assert time.time() - began < 240


def test_viterbi_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(6)
    for n in range(1, 9):
        field = line_quality.LineField(rng.normal(size=(line_quality.FEATURES, 2)), rng.normal(size=(2, 2)))
        x = rng.integers(0, 2, (n, line_quality.FEATURES)).astype(float)
        score = x @ field.emit
        total = lambda y: sum(score[k, v] for k, v in enumerate(y)) + sum(field.move[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        assert tuple(field.viterbi(x)) == max(product((0, 1), repeat=n), key=total)


def test_line_quality_marks_lines_of_mixed_documents(spark):
    rng = np.random.default_rng(7)
    plain = lambda: " ".join(f"w{x}" for x in rng.integers(0, 500, 12)) + "."
    notice, signs = "All rights reserved, see the terms of use and the privacy policy.", "### *** $$$ | %%%"
    good = ["\n".join([plain() for _ in range(6)] + [notice] * (k % 2)) for k in range(30)]
    bad = ["\n".join([signs, notice] * 3) for _ in range(30)]
    table = spark.createDataFrame(list(enumerate(good + bad)), EMPTY)
    labels = spark.createDataFrame([(k, int(k < 30), 0) for k in range(60)], "doc_id long, quality int, toxic int")
    field = line_quality.train(table, labels)
    lines = [plain(), plain(), plain(), notice, signs, plain()]
    assert field.viterbi(line_quality.line_features([x.encode() for x in lines])).tolist() == [1, 1, 1, 0, 0, 1]
    assert 0.02 < line_quality.content_share("\n".join(lines).encode(), field) < 0.98


def test_base_counts_equal_sql(spark):
    import duckdb

    rows = [(1, "[a] b # * [c] <d>|&%$ x"), (2, None), (3, "one\ntwo\n\none\n one\n\n"), (4, "ä [é]\u00a0b\x0bc\td"), *[(5 + k, t) for k, (_, t) in enumerate(ROWS)]]
    path = "/root/testdata/sf0.001/documents.parquet"
    given = [(r.doc_id + 1000, r.text) for r in spark.read.parquet(path).select("doc_id", "text").collect()] if os.path.exists(path) else []
    rows += given
    found = line_quality.judge(spark.createDataFrame(rows, EMPTY), line_quality.LineField(np.zeros((line_quality.FEATURES, 2)), np.zeros((2, 2))))
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", rows)
    want = con.execute(r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM d),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
        s AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS dups FROM (SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY 1)
        SELECT doc_id, len(words), coalesce(list_sum([length(x) for x in words]), 0), len(regexp_extract_all(t, '[#*$%&|<>]')), coalesce(dups, 0) FROM w LEFT JOIN s USING (doc_id)""").fetchall()
    assert sorted(tuple(r) for r in found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines").collect()) == sorted(tuple(map(int, r)) for r in want)


def test_line_quality(docs, nothing, spark):
    def plain_repeats(words):
        seen = {}
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i : i + 8]), []).append(i)
        return len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)})

    for text in [t or "" for _, t in ROWS] + ["a b c d e f g h " * 3 + "x y", "a\n\na\n \n b\nb"]:
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        c = line_quality.counts(text.encode())
        assert (c.n_words, c.word_chars, c.n_repeat_words) == (len(words), sum(map(len, words)), plain_repeats([w.encode() for w in words]))
        lines = text.split("\n")
        assert c.n_dup_lines == sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0d]", x) and x in lines[:i])
    good, bad = "It is a plain sentence with quite a few words in it.\n" * 1 + "And here is one more of them, to be read.\n", "#### $$$ | %%% &&& | *** ###\n" * 3
    rows = [(i, f"Number {i}. {good}" if i % 2 else f"{i} {bad}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    field = line_quality.train(spark.createDataFrame(rows, EMPTY), labels)
    assert line_quality.content_share(good.encode(), field) == 1 and line_quality.content_share(bad.encode(), field) == 0
    found = {r.doc_id: r for r in line_quality.judge(docs, field).collect()}
    assert found[9].base_failed and not found[4].kept and found[4].content_share == 0
    assert line_quality.judge(nothing, line_quality.train(nothing, labels.limit(0))).collect() == []


def test_line_quality_learns_from_all_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(line_quality, "fit_field", lambda rows: seen.extend(rows))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    line_quality.train(spark.createDataFrame([(1, "A line of words.\n" * 90)], EMPTY), labels)
    assert [len(features) for features, _ in seen] == [90]


def test_toxicity(docs, nothing, spark):
    rows = [(i, "the weather is fine today. " * 3 + ("you are such a clown and an idiot. " if i % 3 == 0 else "they walk home. ") * 2) for i in range(240)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame(rows, EMPTY)
    model = toxicity.train(texts, labels)
    assert {"clown", "idiot"} <= model.insults.keys()
    found = toxicity.score_texts(texts, model).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert len(toxicity.score_texts(docs, model).collect()) == len(ROWS)
    assert toxicity.reject_toxic(texts, model).count() == 160
    empty = toxicity.train(nothing, labels.limit(0))
    assert toxicity.score_texts(nothing, empty).collect() == []
    grammar, lexicon = toxicity.Grammar(), toxicity.Lexicon({"clown": 1.0})
    score = lambda t: grammar.score([lexicon[w] for w in t.split()])
    assert score("you clown") > score("a clown") > score("not a clown") and score("kill you") > 0 and score("he said a clown") < score("a clown")


def test_grammar_equals_its_machines_side_by_side():
    """Every clause of up to five classes: the composed machine against the separate ones."""
    from itertools import product

    grammar = toxicity.Grammar()
    for n in range(1, 6):
        for classes in product(range(6), repeat=n):
            states, total = [0] * 6, 0.0
            for c in classes:
                steps = [m.step(s, c) for m, s in zip(toxicity.machines(), states, strict=True)]
                factor = np.prod([f for _, f, _ in steps])
                total += (1.0 if c == toxicity.INSULT else 0.0) * factor + sum(b for *_, b in steps)
                states = [s for s, *_ in steps]
            assert abs(grammar.score([(c, 1.0 if c == toxicity.INSULT else 0.0) for c in classes]) - total) < 1e-9


def test_denied_and_reported_insults_count_less():
    grammar, lexicon = toxicity.Grammar(), toxicity.Lexicon({"clown": 1.0})
    plain, denied, reported = (toxicity.features("The sky is blue today. " * 10 + t, lexicon, grammar) for t in ("he is a clown.", "he is not a clown.", "she said he is a clown."))
    for k in (0, 2, 4, 5):
        assert plain[k] > reported[k] > denied[k]


def _judged(url):
    host = path = ""
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if m:
        host, path = m[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), m[2]
    best = None
    for r in urls.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r
    return host, path, best and best.text, best and best.verdict


def test_url_rules(spark):
    found = ["https://A.Example.ORG/es/x?q=1#f", "http://example.org/en/17", "http://x.org", "http://myexample.org/es/1", "ftp://shop.com/de/1", "http://shop.com/fr/", None, "", "no scheme.com/de/", "a://b://c.com/fr/x", "http://example.org/en/2#://", "http://q.net/en/5"]
    pages = spark.createDataFrame(list(enumerate(found)) + [(None, "http://a.org/")], "page_id long, url string")
    rows = urls.judge_urls(pages).collect()
    assert len(rows) == len(found) + 1
    for r in rows:
        if r.page_id is not None:
            host, path, rule, verdict = _judged(found[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_trees_rank_urls_that_they_have_not_seen(spark):
    rows = [(i, f"http://site{i % 40}.{'org' if i % 2 else 'com'}/{'en' if i % 2 else 'de'}/{'a' * (i % 7)}{'?x=1&y=2' if i % 2 == 0 else ''}") for i in range(800)]
    auc = urls.held_out_auc(spark.createDataFrame(rows, "page_id long, url string"), trees=3)
    assert auc["all"] > 0.95 and auc["numbers"] > 0.95
    clash = spark.createDataFrame([(1, "http://b.net/x", "h", 2), (1, "http://b.net/x", "h", 2)], "page_id long, url string, host string, score int")
    assert [(r.page_id, r.host) for r in urls.judge_urls(clash).collect()] == [(1, "b.net")] * 2


def test_url_rates_cover_every_ruled_url(spark):
    rows = [(i, f"http://site{i}.com/{'fr' if i % 2 else 'de'}/{i}") for i in range(1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    model = urls.train(urls.with_features(urls.with_rule(urls.with_parts(pages))), sample=100, trees=1)
    counts = {r.domain: (r["_good"], r["_n"]) for r in model.rates["domain"].where("_fold is null").collect()}
    assert model.base == 0.5 and counts == {f"site{i}.com": (i % 2, 1) for i in range(1500)}


def _edited(image, rng):
    """Copies of a picture: cropped, changed in brightness, noisy, turned, and half as large."""
    yield image[6:58, 9:60]
    yield np.clip(image * 0.8 + 25, 0, 255).astype(np.uint8)
    yield np.clip(image + rng.normal(0, 5, image.shape), 0, 255).astype(np.uint8)
    yield np.rot90(image).copy()


def _pictures(spark, pictures):
    rows = [(k, *p.shape, bytearray(np.ascontiguousarray(p).tobytes())) for k, p in enumerate(pictures)]
    return spark.createDataFrame(rows, "image_id long, height int, width int, pixels binary").withColumns({"key": F.lit("x"), "node": F.lit(1), "content": F.lit(0)})


def _agreement(a, b, distance=12):
    """The most matches of two described pictures on one change, counted corner by corner."""
    best = {}
    for pa, qa in zip(*a, strict=True):
        for pb, qb in zip(*b, strict=True):
            same = sum(qa[4 * k : 4 * k + 4] == qb[4 * k : 4 * k + 4] for k in range(4))
            if same < 2 or sum((x ^ y).bit_count() for x, y in zip(qa, qb, strict=True)) > distance:
                continue
            (xa, ya, la, ta), (xb, yb, lb, tb) = ([v[0] / 4, v[1] / 4, v[2], v[3]] for v in (pa, pb))
            turn, zoom = (tb - ta) % 1024 * 2 * np.pi / 1024, lb - la
            dx = xb - 2 ** (zoom / 2) * (xa * np.cos(turn) - ya * np.sin(turn))
            dy = yb - 2 ** (zoom / 2) * (xa * np.sin(turn) + ya * np.cos(turn))
            for hx in (0, 0.5):
                for hy in (0, 0.5):
                    box = zoom, int(turn / 0.26 + 0.5) % 24, hx, np.floor(dx / 8 + hx), hy, np.floor(dy / 8 + hy)
                    best.setdefault(box, set()).add((int(xa + 0.5), int(ya + 0.5)))
    return max(map(len, best.values()), default=0)


@pytest.mark.parametrize("options", [{}, {"small": 2, "leaders": 1}])
def test_media_classes_equal_brute_force(spark, options):
    rng = np.random.default_rng(5)
    originals = [media.drawn(rng.normal(size=64)) for _ in range(5)]
    big = rng.integers(20, 236, (24, 24), dtype=np.uint8).repeat(6, 0).repeat(6, 1)
    pictures = [p for o in originals for p in (o, *_edited(o, rng))] + [originals[0][:, : 30 + k] for k in range(14)]
    pictures += [big, big[::2, ::2].copy(), big[20:120, 10:140], np.zeros((0, 0), np.uint8), np.full((40, 40), 7, np.uint8)]
    seen = []
    for p in pictures:
        _, where, tests = media.keypoints(p[None]) if p.size else (None, np.zeros((0, 4)), np.zeros((0, 16), np.uint8))
        at = media.places(where)
        seen.append(([tuple(int(media._field(x, f)) for f in (media.X, media.Y, media.LEVEL, media.ANGLE)) for x in at], [bytes(t) for t in tests]))
    root = list(range(len(pictures)))
    for i in range(len(pictures)):
        for j in range(i):
            if root[i] != root[j] and _agreement(seen[j], seen[i]) >= 4:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    found = {r.image_id: r.class_id for r in media.image_classes(_pictures(spark, pictures), **options).collect()}
    assert found == dict(enumerate(root))
    assert root[:25] == [5 * (k // 5) for k in range(25)] and set(root[25:39]) <= {0, *range(25, 39)} and root[39:42] == [39] * 3


def test_media_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(30)] + [(30, None), (31, rows_like := rng.normal(size=64).tolist()), (32, rows_like), (32, rows_like), (None, rows_like)]
    images = media.images_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    rows = media.image_classes(images).collect()
    assert len(rows) == images.count()
    found = {r.image_id: r.class_id for r in rows}
    for i in range(30):
        for k, there in ((1, i % 10 == 0), (2, i % 10 == 5)):
            assert found.get(4 * i + k) == (4 * i if there else None)
    assert found[4 * 31] == found[4 * 32] == found[None] == 4 * 31
    assert len(set(found.values())) == 32 and found[120] == 120
    assert media.image_classes(images.limit(0)).collect() == []


def test_clean_up_removes_what_operators_made(spark, docs):
    from poolside.llm import common

    suffixes.remove_repeated(docs).collect()
    assert common.clean_up(spark) > 0 and common.clean_up(spark) == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_pipeline_on_a_small_table(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS if i is not None]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {1, 3, 4, 6, 7, 8, 9, 11} and PASSAGE not in kept[3] and "[EMAIL]" in kept[3]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(pieces.doc_id) == set(kept)
