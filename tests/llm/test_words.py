"""Whole-document packing, spelling variants and periodic runs against plain versions."""

import hashlib
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from plain import words

from marketloom.llm import bestfit, periodic, queries, variants


# Best-fit packing

def test_best_fit_packing_is_exact(spark, as_documents, edge_rows):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    odd = [(11, "it's\n\n a  \n<|endoftext|> x|y\x1cz\n\n\n q r  ", "en", "a"), (None, "no id", "en", "a"), (12, " lead\n", "en", "a")]
    docs = as_documents([*edge_rows, *odd])
    pieces = {}
    for r in bestfit.cut(docs.where("doc_id IS NULL OR doc_id <> 1"), path, capacity=64, cached=50).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for doc, text in {(r.doc_id, r.text) for r in docs.where("doc_id IS NULL OR doc_id <> 1").collect()}:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert b"".join(r.ids for r in own) == ids and [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 64 for r in own[1:]) and [r.start for r in own] == [
            sum(p.length for p in own[:k]) for k in range(len(own))]
    sequences = {}
    out = bestfit.pack(bestfit.cut(docs, path, capacity=64), capacity=64)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    for r in out.collect():
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids) // 4
            at += r.length
        assert at <= 64
    assert bestfit.pack(bestfit.cut(docs.limit(0), path)).count() == 0


def fewest_pairs(lengths, capacity):
    """Sequences that a greatest matching of large pieces needs, by trying all."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = 1 + fewest_pairs(rest, capacity)
    for k, other in enumerate(rest):
        if first + other <= capacity and (k == 0 or rest[k - 1] != other):
            best = min(best, 1 + fewest_pairs(rest[:k] + rest[k + 1:], capacity))
    return best


def test_matching_needs_fewest_sequences():
    rng = random.Random(5)
    for _ in range(150):
        lengths = sorted(rng.randint(11, 30) for _ in range(rng.randint(1, 8)))
        seqs = bestfit.Sequences(30)
        bestfit.match_large(Counter(lengths), seqs)
        assert seqs.count == fewest_pairs(lengths, 30)


def test_plan_fills_gaps():
    """Ranges of like sequences equal best fit of single pieces."""
    rng = random.Random(6)
    for n in (1, 40, 400):
        lengths = [rng.randint(1, 64) for _ in range(n)]
        seqs = bestfit.Sequences(64)
        bestfit.match_large(Counter(lengths), seqs)
        rooms = sorted(r for r, found in seqs.ranges.items() for _, times in found for _ in range(times))
        full = seqs.count - len(rooms)
        for length in sorted((x for x in lengths if 3 * x <= 64), reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 64) - length)
        table = bestfit.plan(dict(Counter(lengths)), 64)
        used = {int(s) for length, rows in table.items() for i, (rank, first, each, _) in enumerate(rows.tolist())
                for s in range(first, first - (-((rows[i + 1][0] if i + 1 < len(rows) else Counter(lengths)[length]) - rank) // each))}
        assert len(used) == full + len(rooms)


# Spelling variants

def edits_apart(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def plain_variants(counts):
    near = {w: [v for v in counts if edits_apart(w, v) == 1] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


@pytest.mark.parametrize(("groups", "subtree"), [(20, 2048), (20, 4), (3, 2), (1, 1)])
def test_variants_equal_brute_force(spark, groups, subtree):
    rng = random.Random(7)
    counts = {"aaaaaaa": 2000, "aaaaaab": 200, "aaaaabb": 20, "aaaabbb": 2, "é" * 7: 30, "é" * 8: 3, "b" * 30_000: 2, "b" * 29_999: 2}
    for _ in range(250):
        w = "".join(rng.choice("abcdé") for _ in range(rng.randint(7, 9)))
        counts[w] = rng.choice([2, 3, 25, 400])
    got = variants.grouped(spark.createDataFrame(list(counts.items()), "word string, n long"), groups=groups, subtree=subtree)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    short = {w: n for w, n in counts.items() if len(w) < 100}
    want = plain_variants(short)
    rows = sorted(tuple(r) for r in got.collect())
    assert [r for r in rows if len(r[0]) < 100] == want
    assert [(r[4], r[1]) for r in rows if len(r[0]) > 100] == [(1, None), (1, None)]


def test_words_are_counted(as_documents, edge_rows):
    docs = as_documents([*edge_rows, (20, "Straßen ÀÉÎ÷×ÿab ÀÉÎ÷×ÿab abcdefg1abcdefgh-ABCDEFG", "de", "a"), (None, "abcdefg", None, None)])
    got = {r.word: r.n for r in variants.counted(docs).groupBy("word").sum("n").toDF("word", "n").collect()}
    assert {w: got[w] for w in ("straßen", "ÀÉÎ÷×ÿab", "abcdefg", "abcdefgh", "a" * 3000)} == {
        "straßen": 1, "ÀÉÎ÷×ÿab": 2, "abcdefg": 3, "abcdefgh": 1, "a" * 3000: 1}
    typo = {r.word for r in variants.counted(docs, change=lambda doc, w: w[1:] if doc == "20" else w).collect()}
    assert "traßen" not in typo and "bcdefgh" in typo and "abcdefg" in typo
    empty = variants.grouped(variants.counted(docs.limit(0)))
    assert empty.count() == 0


# Periodic runs

def plain_runs(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q) and not any(
                    w[i:j + q - p] == w[i + p:j + q] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force(spark):
    rng = random.Random(9)
    docs = []
    for i in range(150):
        letters = "abcdefghij"[:rng.choice([1, 2, 3, 10])]
        w = [rng.choice(letters) for _ in range(rng.choice([0, 5, 23, 24, 60, 150]))]
        for _ in range(rng.randint(0, 2)):
            if len(w) > 10:
                a, p = rng.randrange(len(w)), rng.randint(1, len(w) // 3)
                for k in range(a + p, rng.randint(a, len(w))):
                    w[k] = w[k - p]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    frame = spark.createDataFrame([*docs, (None, "z " * 30), (None, None), (3, docs[3][1])], "doc_id long, text string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.collapsed(frame.repartition(5)).collect()), key=repr)
    want = []
    for i, text in [*docs, (None, "z " * 30), (None, None), (3, docs[3][1])]:
        w = words(text)
        runs = plain_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert got == sorted(want, key=repr)
    assert sum(len(r) for _, r, _ in want) > 20
    assert periodic.collapsed(frame.limit(0)).count() == 0


def test_period_query_digests(spark, as_documents, edge_rows, monkeypatch):
    docs = as_documents([*edge_rows, (21, "tick tock " * 40 + "end", "en", "a"), (22, "x y z " * 500, None, None)])
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    monkeypatch.setattr(queries, "with_periods", lambda d: d)
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, "").collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    r = got[21]
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 80, 2, 40_000)
    assert r.collapsed_sha256 == hashlib.sha256(b"tick tock end").hexdigest()
    assert r.runs_sha256 == hashlib.sha256(b"0,80,2\n").hexdigest()
    assert (got[2].n_runs, got[2].start, got[2].exponent_milli) == (0, None, None)
    assert got[2].runs_sha256 == got[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert Fraction(got[22].length, got[22].period) == 500


def test_planted_periods(spark):
    import zlib

    docs = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate([0, 1, 2, 3, 7, 50, 333] * 12)]
    frame = spark.createDataFrame([*docs, (None, "a b")], "doc_id long, text string")
    for r in queries.with_periods(frame).collect():
        w = words(dict(docs).get(r.doc_id, "a b"))
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if r.doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert words(r.text) == w
