"""Operators on documents against plain versions and the contracts' edge cases."""

import random
import re
import zlib
from collections import Counter
from math import log10

import duckdb
import numpy as np
import pytest
from plain import LOWER, near_groups, sha, shingles, without_repeats, words
from pyspark.sql import functions as F

from marketloom.llm import licenses, lm, minhash, mixing, packing, quality, queries, sqltext, suffixes


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Packing

def test_packing_is_exact(spark, as_documents, edge_rows):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    plain = Tokenizer.from_file(path)
    docs = as_documents([*edge_rows, (11, "it's | a <|endoftext|> x|y\x1cz q r", "en", "a")])
    out = packing.pack(packing.cut(docs.where("doc_id <> 1"), path)).collect()
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc, text in {(r.doc_id, r.text) for r in docs.where("doc_id <> 1").collect()}:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        own = sorted(pieces[doc], key=lambda r: r.start)
        assert b"".join(r.ids for r in own) == ids and all(r.doc_tokens == len(ids) // 4 for r in own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids) // 4
            at += r.length
        assert at <= packing.CAPACITY


def test_plain_words_skip_the_whole_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    plain = ["Word", "word.", "WORD,", "Straße,", "ÀÉÎ.", "ÿþð", "naïve", "it", "s"]
    plain += ["".join(rng.choice("abcXYZéÖñßÞ") for _ in range(rng.randrange(1, 12))) + rng.choice(["", ".", ","]) for _ in range(300)]
    odd = ["it's", "a.b", "x..", "Ĳssel", "İ", "e\u0301", "ª", "ÿ\u0301,", "x×y", "a1,", ".", ",", "x|y", "<|endoftext|>,", "ΟΔΟΣ.", "ﬁn,"]
    whole = []
    learn_whole = packing.WordIds.learn_whole
    monkeypatch.setattr(packing.WordIds, "learn_whole", lambda self, words: (whole.extend(words), learn_whole(self, words)))
    text = " ".join(rng.sample([*plain, *odd], len(plain) + len(odd)))
    got = packing.WordIds(queries.tokenizer(), 1000).of([text, ""])
    want = Tokenizer.from_file(queries.tokenizer()).encode(text, add_special_tokens=False).ids
    assert got == [np.array(want, "<u4").tobytes(), b""]
    assert sorted(whole) == sorted(odd)


def test_patterns_cover_the_demand():
    rng = random.Random(1)
    for n in (1, 7, 300, 5000):
        counts = Counter(rng.randint(1, 128) for _ in range(n))
        plan = packing.patterns(dict(counts), 128)
        packed = Counter()
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= 128
            for s, k in pattern.items():
                packed[s] += k * times
        assert packed == counts
        bound = -(-sum(s * k for s, k in counts.items()) // 128)
        assert sum(t for _, t in plan) <= 1.03 * bound + 6


# Mixing

def test_targets_fill_and_cap():
    assert mixing.targets([100, 10, 100], [3, 1, 2], 1.5, 2) == pytest.approx([187.0, 20.0, 108.0], abs=25)
    got = mixing.targets([100, 10, 100], [3, 1, 2], 1.5, 2)
    assert sum(got) == pytest.approx(315) and got[1] == 20


def test_mix_takes_its_targets(as_documents, edge_rows):
    def taken(docs):
        sized = mixing.with_size(docs).drop("row")
        sources = mixing.plan_sources(mixing.source_sizes(sized), block=64)
        placed = mixing.place(sized, sources, sized.count())
        spans = mixing.mix(placed, sources, 64, 8)
        return placed, spans, sources

    docs = as_documents(edge_rows)
    placed, spans, sources = taken(docs)
    by_sid = {r["sid"]: r["n"] for r in spans.groupBy("sid").agg(F.sum(F.expr("word_to - word_from")).alias("n")).collect()}
    assert all(by_sid.get(s.sid, 0) == round(s.target) for s in sources)
    assert [s.name for s in sources] == ["a", "b", "c", "d", None]
    most = spans.groupBy("sid", "position").agg(F.sum(F.expr("word_to - word_from")).alias("n")).join(placed, ["sid", "position"])
    assert most.where("n > 2 * size").isEmpty()
    assert rows_of(spans) == rows_of(taken(docs.repartition(7))[1])


def test_mixed_documents_are_parts_of_their_own(as_documents, edge_rows):
    docs = as_documents(edge_rows)
    out = mixing.mixed_documents(docs, block=64)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    total = 0
    for r in out.collect():
        assert r.n_chars == len(r.text) and set(words(r.text)) <= set(words(texts[r.doc_id]))
        total += len(words(r.text))
    assert total == pytest.approx(1.5 * sum(len(words(t)) for _, t, _, _ in edge_rows), abs=5)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(0))).collect()
        assert sorted(r[0] for r in got) == list(range(n))


# Quality

def test_quality_equals_sql(spark, as_documents, edge_rows):
    docs = as_documents(edge_rows)
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841  DuckDB finds it by name
    want = con.execute(sqltext.quality()).fetchall()
    got = quality.judged(quality.measured(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert rows_of(got) == sorted(want, key=repr)
    assert quality.judged(quality.measured(docs.limit(0))).count() == 0


def test_repeated_words(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 8, 30, 200)]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", quality.measures().alias("m")).collect()
    for r in got:
        w = words(r.text)
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(windows)
        assert r.m.n_repeat_words == len({i + d for i, x in enumerate(windows) if n[x] > 1 for d in range(3)})


def test_sketch_buckets_keep_the_order(spark):
    values = [*range(300), *(3**k for k in range(6, 20))]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", quality.bucket(F.col("v")).alias("b"), quality.bucket_value(quality.bucket(F.col("v"))).alias("low")).orderBy("v").collect()
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(r.low <= r.v <= r.low * (1 + 1 / 32) for r in got)


# Near copies

def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
    return " ".join(w)


@pytest.mark.parametrize("small_band", [minhash.SMALL_BAND, 3])
def test_near_copies_equal_plain(monkeypatch, as_documents, edge_rows, small_band):
    monkeypatch.setattr(minhash, "SMALL_BAND", small_band)
    monkeypatch.setattr(minhash, "PER_TASK", 4)
    rng = random.Random(8)
    base = [" ".join(f"t{rng.randrange(400)}" for _ in range(80)) for _ in range(4)]
    rows = [*edge_rows[2:], *((100 + i, changed(rng, base[i % 4], i // 8), "en", "a") for i in range(80))]
    docs = as_documents(rows)
    for width in (2, 5):
        want = near_groups([(i, t) for i, t, _, _ in rows], width, 8, 10)
        got = {r.doc_id: r for r in minhash.near_duplicates(docs, width=width).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.n_shingles == len(shingles(t, width)) and r.kept == (r.component_id == i)
                   for i, t, _, _ in rows for r in [got[i]])


def test_copies_that_stay_apart_are_not_compared_pair_by_pair(monkeypatch, spark):
    rng, compared = random.Random(4), []

    def variant(k):
        words = [f"b{i}" for i in range(150)]
        for at in rng.sample(range(150), 4 + k % 9):
            words[at] = f"n{rng.randrange(10**9)}"
        return " ".join(words)

    rows = [(i, variant(i)) for i in range(240)]
    rows += [(300 + i, rows[i][1] + " and so on") for i in range(0, 240, 12)]  # linked with one that may stay apart
    verified = minhash.verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(minhash, "verified", counted)
    monkeypatch.setattr(minhash, "SMALL_BAND", 16)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    want = near_groups(rows, 2, 8, 10)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) > 50  # of 260
    assert sum(compared) < 60 * len(rows)  # 170 where each class outside the main component met all others


def test_near_copies_edge_cases(as_documents, edge_rows):
    docs = as_documents([*edge_rows, (None, "word", "en", "a"), (None, "alone here", "en", "a")])
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(edge_rows) + 2
    assert sorted((r.component_id or 0, r.kept) for r in got if r.doc_id is None) == [(0, True), (8, False)]
    assert sorted(r.kept for r in got if r.component_id == 1) == [False, False, True]  # one of the equal rows 1, not 10
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_told_apart(as_documents):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    got = minhash.near_duplicates(as_documents([(5, a, "", ""), (7, a, "", ""), (7, b, "", ""), (9, b, "", "")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(5, 5, True), (7, 5, False), (7, 7, True), (9, 7, False)]


# Repeats

@pytest.mark.parametrize("split_from", [suffixes.SPLIT_FROM, 3])
def test_repeats_equal_plain(monkeypatch, as_documents, edge_rows, split_from):
    monkeypatch.setattr(suffixes, "SPLIT_FROM", split_from)
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(700))
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [*edge_rows[2:], (20, "ab" * 200, "", ""), (21, base, "", ""), (22, "é" * 120, "", ""), (23, "zé" + "é" * 120, "", ""),
            *((30 + i, noise(50) + base[50:300] + noise(20) + base[40 * (i % 7):250], "", "") for i in range(30))]
    want = without_repeats([(i, t) for i, t, _, _ in rows])
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["to"] - s["from"])
    got = suffixes.deduplicated(as_documents(rows)).select(
        "row.doc_id", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {i: (n, s, sha(k)) for i, (_, n, s, k) in want.items()}


def test_repeats_edge_cases(monkeypatch, as_documents, edge_rows):
    monkeypatch.setattr(suffixes, "TILE", 5000)  # long texts are hashed in tiles
    docs = as_documents([*edge_rows, (None, "x" * 500, "en", "a")])
    got = suffixes.deduplicated(docs).select("row.doc_id", F.size("spans").alias("n"), F.length("kept").alias("left")).collect()
    assert len(got) == len(edge_rows) + 1
    assert [r.left for r in got if r.doc_id is None] == [1]  # its strings but the first start earlier as well
    assert sorted(r.left for r in got if r.doc_id == 1)[0] == 0  # of equal rows one keeps its text
    assert [r.left for r in got if r.doc_id == 9] == [0]
    assert suffixes.deduplicated(docs.limit(0)).count() == 0


def test_texts_cross_the_last_exchange_once(as_documents, edge_rows):
    plan = suffixes.deduplicated(as_documents(edge_rows[2:]))._jdf.queryExecution().optimizedPlan().toString()
    columns = re.findall(r"Join LeftOuter.*\n(.*)", plan)  # the side that has the rows
    assert len(columns) == 1 and "AS row" in columns[0] and " AS _text" not in columns[0]


def test_repeats_of_rows_that_share_an_id(as_documents):
    rng = random.Random(3)
    p, x, other = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 100, 400))
    got = suffixes.deduplicated(as_documents([(1, p, "", ""), (2, p + x, "", ""), (2, other, "", ""), (None, other, "", "")]))
    left = sorted((r.doc_id or 0, bytes(r.kept).decode()) for r in got.select("row.doc_id", "kept").collect())
    assert left == sorted([(1, p), (2, x), (2, other), (0, "")])


def test_blind_trie_orders_suffixes():
    rng = random.Random(6)
    data = bytes(rng.choice(b"ab") for _ in range(400)) + bytes(8)
    starts = rng.sample(range(350), 200)
    trie = suffixes.BlindTrie(data, 20)
    for p in starts:
        trie.add(p)
    leaves = [[data[p:p + 20] for p in leaf] for leaf in trie.leaves()]
    assert all(len(set(leaf)) == 1 for leaf in leaves)
    assert [leaf[0] for leaf in leaves] == sorted({data[p:p + 20] for p in starts})


# Language model

def test_base_scores_and_edges(as_documents, edge_rows):
    rows = [*edge_rows[2:], *((50 + i, f"Alpha beta x{i} gamma", "en", "a") for i in range(20)), (None, "beta", "en", "a")]
    toks = {i: [*words((t or "").translate(LOWER)), ""] for i, t, _, _ in rows}
    train = Counter(w for i, w in toks.items() if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in w)
    n, v = sum(train.values()), len(train)
    for frequent in (5, 200_000):
        got = lm.scored(as_documents(rows), vocabulary=8, frequent=max(frequent, 6), epochs=1).collect()
        assert len(got) == len(rows)
        for r in got:
            w = toks[r.doc_id]
            assert r.base_score == pytest.approx(sum(log10((train[x] + 1) / (n + v + 1)) for x in w))
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(train[x] > 0 for x in w), n)
    assert lm.scored(as_documents(rows).limit(0)).count() == 0


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    ids = np.empty(40_000, int)  # each token mostly follows from the one before
    ids[0] = 0
    for i in range(1, len(ids)):
        ids[i] = (ids[i - 1] * 3 + 1) % 20 if rng.random() < 0.8 else rng.integers(20)
    q = np.bincount(ids, minlength=20) / len(ids)
    model = lm.LogBilinear(q, 8, 0)
    squares = [np.zeros_like(p) for p in (model.one, model.two, model.out, model.bias)]
    one, two = np.append(0, ids[:-1]), np.append([0, 0], ids[:-2])
    for _ in range(12):
        for s in range(0, 36_000, 1000):
            model.train(ids[s:s + 1000], one[s:s + 1000], two[s:s + 1000], rng, squares, 16, 0.1)
    z = model.normalisers()
    scores = (model.one[3] + model.two[5]) @ model.out.T + model.bias
    assert np.exp(scores - z[3, 5]).sum() == pytest.approx(1, abs=1e-3)
    test = slice(36_000, None)
    s = ((model.one[one[test]] + model.two[two[test]]) * model.out[ids[test]]).sum(axis=1) + model.bias[ids[test]] - z[one[test], two[test]]
    assert s.mean() > np.log(q[ids[test]]).mean() + 0.5


# Licences

def test_licences_are_found_and_inherited(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    files = [
        (1, "a/LICENSE", mit), (2, "a/x.py", "print()"), (3, "a/b/c/y.py", None), (4, "a/b/COPYING.txt", gpl),
        (5, "a/b/z.py", "code\n" + mit + "\ncode"), (6, "top.py", ""), (7, None, gpl), (8, "d/e.py", "the word license alone"),
        (9, "a/b/c/w.py", ""), (10, None, None), (11, "a/b/c/w.py", ""),
    ]
    got = {r.fid: (r.license, r.origin) for r in licenses.scanned(
        spark.createDataFrame([(*f, "clash") for f in files], "fid long, path string, text string, header string")).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "inherited"), 4: ("GPL-3.0", "own"), 5: ("MIT", "own"),
        6: (None, None), 7: ("GPL-3.0", "own"), 8: (None, None), 9: ("GPL-3.0", "inherited"), 10: (None, None),
        11: ("GPL-3.0", "inherited"),
    }


def test_whole_licences_and_source_headers_are_found(spark):
    holder = "Copyright (c) 2020 Jane Doe and others. All rights reserved."
    texts = {p.stem: p.read_text() for p in licenses.TEXTS.glob("*.txt")}
    mit = " ".join(texts["MIT"].replace("<year> <copyright holders>", "2020 Jane Doe").split())
    gpl = "".join(f"# {x}\n" for x in [holder, *licenses.SOURCE_HEADERS["GPL-3.0"].split("\n")])
    pasted = "".join(f" * {x}\n" for x in texts["MIT"].replace("<year> <copyright holders>", "2020 Jane Doe").split("\n"))
    files = [
        *((i, f"{k}/LICENSE", t) for i, (k, t) in enumerate(sorted(texts.items()))), (20, "m/LICENSE", mit), (21, "m/x.py", "print()"),
        (22, "s/gpl.py", gpl + "import os\n"), (23, "s/mit.c", f"/*\n{pasted}*/\nint x;"),
        (24, "s/two.py", f"{holder}\n{licenses.TEMPLATES['MIT']}\nx = 1"), (25, "s/none.py", "see the license file for a copy"),
    ]
    got = {r.fid: (r.license, r.origin) for r in licenses.scanned(
        spark.createDataFrame(files, "fid long, path string, text string")).collect()}
    # A whole text that one of the short notices already fits keeps that notice's name.
    assert {k: got[i][0].removesuffix("-long") for i, k in enumerate(sorted(texts))} == {k: k for k in texts}
    assert {i: got[i] for i in range(20, 26)} == {
        20: ("MIT", "own"), 21: ("MIT", "inherited"), 22: ("GPL-3.0", "own"), 23: ("MIT", "own"), 24: ("MIT", "own"), 25: (None, None)}
