"""Near-duplicate documents by MinHash, banding and alternating stars.

A document is the set of its word shingles. Documents with equal sets form a
class, represented by its smallest id. Many universal hash minima of a class
are cut into bands; classes that share a band may be similar. One bit of each
minimum is kept as the class's signature: candidates whose signatures differ in
more bits than a pair at the threshold does, by ``SIGMAS`` standard deviations,
or whose sizes rule the threshold out, go no further. The others are verified on
their full sets, and verified links joined to components.

A large band's classes are not compared pair by pair. First each class meets
the smallest class of each of its bands. Then only bands that still hold several
components count. In those of at most ``SMALL_BAND`` classes, classes of
different components meet. A larger one takes the representative of its main
component as a pivot. Two sets differ from each other in exactly the shingles in
which one of their differences from the pivot has what the other lacks, so the
differences alone say how many of their shingles a linked pair must share. Sets
linked with the pivot are one component; any other one meets only those that share
one of its rarest such shingles (a prefix filter), so no link within a band is
lost. With 48 bands of 6 rows a pair at similarity 0.8 shares no band with a
probability below 1e-6, and fails the signatures with one of about 1e-5.

Edge cases: a text without words has an empty set and links with nothing; a
text shorter than a shingle is one shingle; each row is a document of its own,
also where rows share a doc_id (ordered by a hash of the text) or have none (they come last): of
equal rows one is kept. A component without any doc_id has none. A text of any
length is one value of a row; other columns are left aside; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import components
from marketloom.llm.rows import numbered
from marketloom.session import materialize

BANDS, ROWS = 48, 6
#: Classes of a band that are compared pair by pair; a larger band has a pivot.
SMALL_BAND = 64
#: How far from its mean a true pair's count of differing signature bits may lie.
SIGMAS = 4.5
#: Classes that meet one other class in one task; more are spread by a salt.
PER_TASK = 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""

    LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

    def __init__(self, width: int, cached: int = 500_000) -> None:
        self.width, self.cached, self.known = width, cached, {}

    def words(self, text: str) -> np.ndarray:
        import xxhash

        words = text.encode().translate(self.LOWER).split()
        if len(self.known) > self.cached:
            self.known.clear()
        for w in {w for w in words if w not in self.known}:
            self.known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str | None) -> np.ndarray:
        h = self.words(text or "")
        n = max(1, len(h) - self.width + 1) if len(h) else 0
        span = min(self.width, len(h))
        out = np.full(n, span, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(span):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
        return np.unique(out)


def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of n universal hash functions in 32 bits."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, (n, 1), np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, (n, 1), np.uint32))


def band_hashes(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray], bands: int,
                rows: int) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit number per band from the minima of bands x rows universal hashes, and a bit of each minimum.

    The upper halves of the shingle hashes are hashed on, in 32 bits.
    """
    a, b = functions
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for s in range(0, len(short), 512):
            np.minimum(least, (short[None, s:s + 512] * a + b).min(axis=1), out=least)
        minima = least.reshape(bands, rows).astype(np.uint64)
        out = np.arange(bands, dtype=np.uint64)
        for r in range(rows):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + minima[:, r])
        bits = (_mix(minima.ravel() + np.uint64(1)) >> np.uint64(63)).astype(np.uint8)
    return out, np.packbits(np.pad(bits, (0, -len(bits) % 64))).view(np.int64)


def signed(docs: DataFrame, width: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, bits) of each document; no texts."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        shingler, functions = Shingler(width), coefficients(bands * rows, seed)
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                sizes, digests, marks, signatures = [], [], [], []
                for text in batch["text"].to_pylist():
                    h = shingler.of(text)
                    sizes.append(len(h))
                    digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    made, bits = band_hashes(h, functions, bands, rows) if len(h) else (np.empty(0), np.empty(0, np.int64))
                    marks.append(made.view(np.int64))
                    signatures.append(bits)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     *(pa.array(lists, pa.list_(pa.int64())) for lists in (marks, signatures))],
                    names=["doc_id", "n_shingles", "digest", "bands", "bits"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, hashes) of the documents in ``ids``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                made = [shingler.of(t).tobytes() for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(made, pa.binary())], names=["id", "hashes"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(ids, "id", "left_semi")
    return chosen.mapInArrow(sets, "id long, hashes binary")


def _meeting(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, salt, member, id, hashes): the set of each a, then those of all b that meet it, in one task.

    An a with many partners is repeated for every ``PER_TASK`` of them.
    """
    many = materialize(
        pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_TASK).cast("int").alias("salts")), "pair-salts")
    members = (
        pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        .join(sets, F.col("b") == F.col("id")).select("a", "salt", F.lit(1).alias("member"), "id", "hashes")
    )
    centers = many.join(sets, F.col("a") == F.col("id")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("member"), "id", "hashes")
    return members.unionByName(centers).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * intersection >= num * union of their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, center = None, np.empty(0, np.uint64), -1
        for batch in batches:
            a_out, b_out = [], []
            rows = zip(*(batch[c].to_pylist() for c in ("a", "salt", "member", "id", "hashes")), strict=True)
            for a, salt, member, id_, raw in rows:
                h = np.frombuffer(raw, np.uint64)
                if not member:
                    if at != (a, salt):
                        at, own, center = (a, salt), h, id_
                    continue
                if at != (a, salt):
                    continue
                small, large = (own, h) if len(own) < len(h) else (h, own)
                if num * len(large) > den * len(small):
                    continue
                i = np.searchsorted(large, small)
                shared = int((large[np.minimum(i, len(large) - 1)] == small).sum())
                if den * shared >= num * (len(own) + len(h) - shared):
                    a_out.append(center)
                    b_out.append(id_)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return _meeting(pairs, sets).mapInArrow(compare, "a long, b long")


def differences(pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, id, p, n, delta): sizes of the pivot's and the class's sets and what only one of them has."""

    def subtract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.empty(0, np.uint64)
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                out: list[tuple] = []
                rows = zip(*(batch[c].to_pylist() for c in ("a", "salt", "member", "id", "hashes")), strict=True)
                for a, salt, member, id_, raw in rows:
                    h = np.frombuffer(raw, np.uint64)
                    if not member:
                        at, own = (a, salt), h
                    elif at == (a, salt):
                        out.append((a, id_, len(own), len(h), np.setxor1d(own, h, assume_unique=True).view(np.int64)))
                if out:
                    kinds = (*[pa.int64()] * 4, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=["pivot", "id", "p", "n", "delta"])

    return _meeting(pivots.toDF("a", "b"), sets).mapInArrow(subtract, "pivot long, id long, p long, n long, delta array<long>")


def pivot_pairs(grouped: DataFrame, sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Links with the pivots, and the pairs (a, b) that may be linked, of (pivot, id, c) with components c.

    With s = (den - num) / (den + num), sets x and y are linked if they differ in
    at most s (x + y) shingles. Their differences d from a pivot p must share
    half of d_x + d_y - s (x + y) at least. What is not linked with p itself has
    d_x > s (x + p), and every set has d_y >= s (y - p). These bounds give the
    prefixes, the two sets' own sizes the rest.
    """
    s_den, s_num = den + num, den - num
    apart = materialize(
        differences(grouped.select("pivot", "id"), sets).join(grouped, ["pivot", "id"])
        .withColumn("d", F.size("delta").cast("bigint")).withColumn("e", s_den * F.col("d") - s_num * F.col("n")), "differences")
    outside = F.col("e") > s_num * F.col("p")
    linked = apart.where(~outside & (F.col("pivot") != F.col("id"))).select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    shingles = materialize(apart.select("pivot", "id", F.explode("delta").alias("h")), "delta-shingles")
    often = shingles.groupBy("pivot", "h").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # What nothing else has comes first and is only counted.
    shared = shingles.join(often, ["pivot", "h"]).groupBy("pivot", "id").agg(
        F.sort_array(F.collect_list(F.struct("times", "h"))).alias("shared"))
    placed = materialize(
        apart.drop("delta").join(shared, ["pivot", "id"])
        .select("pivot", "id", "p", "c", "d", "e", F.posexplode("shared").alias("i", "x"), F.size("shared").alias("k"))
        .withColumn("rest", F.col("k") - F.col("i")).select("pivot", "id", "p", "c", "e", "rest", F.col("x.h").alias("h")),
        "delta-prefixes")
    centers = placed.where(outside & (2 * s_den * F.col("rest") >= F.col("e") - s_num * F.col("p"))).select(
        "pivot", "h", F.col("id").alias("a"), F.col("c").alias("c_a"), F.col("e").alias("e_a"), F.col("rest").alias("rest_a"))
    near = placed.where(2 * s_den * F.col("rest") >= F.col("e") + s_num * F.col("p")).select(
        "pivot", "h", F.col("id").alias("b"), F.col("c").alias("c_b"), F.col("e").alias("e_b"), F.col("rest").alias("rest_b"))
    fits = 2 * s_den * F.least("rest_a", "rest_b") >= F.col("e_a") + F.col("e_b")
    pairs = centers.join(near, ["pivot", "h"]).where((F.col("c_a") != F.col("c_b")) & fits)
    return linked, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def alike(a: str, b: str, minima: int, num: int, den: int) -> Column:
    """True unless sizes or signatures of two classes (structs of n and bits) rule out num / den."""
    differ = (1 - num / den) / 2  # a bit of different minima is the same half the time
    most = minima * differ + SIGMAS * math.sqrt(minima * differ * (1 - differ))
    x, y = F.col(a), F.col(b)
    apart = sum(F.bit_count(x["bits"][k].bitwiseXOR(y["bits"][k])) for k in range(-(-minima // 64)))
    return (den * F.least(x["n"], y["n"]) >= num * F.greatest(x["n"], y["n"])) & (apart <= int(most))


def _labelled(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Band members with c, the component of each class."""
    of = labels.select(F.col("node").alias("id"), "component_id")
    return live.join(of, "id", "left").select("band", "id", "sig", F.coalesce("component_id", "id").alias("c"))


def _open_bands(rows: DataFrame) -> DataFrame:
    """(band, size, main): bands with more than one component, with the largest one."""
    return (
        rows.groupBy("band", "c").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("band").agg(F.sum("n").alias("size"), F.max(F.struct("n", "c")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("band", "size", F.col("most.c").alias("main"))
    )


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after new links: only the components that the links touch are looked at."""
    of = labels.select(F.col("node").alias("_n"), F.col("component_id").alias("_c"))
    edges = links
    for end in ("a", "b"):
        other = "b" if end == "a" else "a"
        edges = edges.join(of, F.col(end) == F.col("_n"), "left").select(F.coalesce("_c", end).alias(end), other)
    roots = materialize(components(edges.select("a", "b")), "joined-roots")
    moved = labels.join(roots.select(F.col("node").alias("_n"), F.col("component_id").alias("_to")),
                        F.col("component_id") == F.col("_n"), "left")
    return materialize(moved.select("node", F.coalesce("_to", "component_id").alias("component_id")).union(roots), "labels")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, bands: int = BANDS,
                    rows: int = ROWS, seed: int = 9) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document.

    Links are pairs with a similarity of at least num / den on sets of
    ``width``-word shingles. ``kept`` is true for one row of each component,
    the first one with its smallest doc_id.
    """
    given, own = numbered(docs)
    found = grouped_rows(given.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text")),
                         width, num, den, bands, rows, seed)
    if own:
        return found
    names = given.select("id", F.col("row.doc_id").cast("bigint").alias("name"))
    members = found.withColumnRenamed("doc_id", "id").join(names, "id")
    firsts = names.toDF("component_id", "first")
    return members.join(firsts, "component_id").select(
        F.col("name").alias("doc_id"), "n_shingles", F.col("first").alias("component_id"), "kept")


def grouped_rows(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, bands: int = BANDS,
                 rows: int = ROWS, seed: int = 9) -> DataFrame:
    """``near_duplicates`` of documents that all have a doc_id of their own."""
    signatures = materialize(signed(docs, width, bands, rows, seed), "signatures")
    reps = materialize(
        signatures.where("n_shingles > 0").groupBy("digest")
        .agg(F.min(F.struct("doc_id", "bands", F.struct(F.col("n_shingles").alias("n"), "bits").alias("sig"))).alias("r"))
        .select("digest", F.col("r.doc_id").alias("rep"), "r.bands", "r.sig"), "set-classes")
    banded = reps.select(F.explode("bands").alias("band"), F.col("rep").alias("id"))
    shared = materialize(
        banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least")).where("size > 1"), "shared-bands")
    of = reps.select(F.col("rep").alias("id"), "sig")
    members = materialize(banded.join(shared.select("band", "least"), "band"), "band-members")
    nearest = members.where("least < id").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    both = (
        nearest.join(of.toDF("a", "sig_a"), "a").join(of.toDF("b", "sig_b"), "b")
        .where(alike("sig_a", "sig_b", bands * rows, num, den)).select("a", "b")
    )
    sets = materialize(shingle_sets(docs, members.select("id").distinct(), width), "shingle-sets")
    links = materialize(verified(materialize(both, "nearest-pairs"), sets, num, den), "links")
    labels = materialize(components(links), "labels")
    live = members.select("band", "id").join(of, "id")
    marked = materialize(_labelled(live, labels), "marked-bands")
    open_ = materialize(_open_bands(marked.select("band", "id", "c")), "open-bands")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("c", "sig")]
    small = marked.join(open_.where(F.col("size") <= SMALL_BAND).select("band"), "band", "left_semi")
    pairs = (
        small.select("band", F.col("id").alias("a"), *side("a")).join(small.select("band", F.col("id").alias("b"), *side("b")), "band")
        .where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & alike("sig_a", "sig_b", bands * rows, num, den))
        .select("a", "b").distinct()
    )
    grouped = materialize(
        marked.join(open_.where(F.col("size") > SMALL_BAND).select("band", F.col("main").alias("pivot")), "band")
        .select("pivot", "id", "c").distinct(), "pivot-classes")
    linked, far = pivot_pairs(grouped, sets, num, den)
    pairs = materialize(pairs.union(far).distinct(), "open-pairs")
    labels = _joined(labels, materialize(verified(pairs, sets, num, den).union(linked), "links"))
    classes = reps.select("digest", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component_id", "rep").alias("component_id"))
    whole = signatures.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
