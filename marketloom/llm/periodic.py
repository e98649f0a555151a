"""Runs of repeated words: periodic stretches of documents, found in tiles.

A run is a maximal stretch of words with smallest period q that is at least
``least`` words and ``times`` periods long. Words i and i + q agree along it, on
an interval of at least twice q words. So with boundaries every S words, S at
most q, some block of S words from a boundary b comes again at b + q. Each
octave of periods (S to 2S - 1) has its own boundaries, and around each of them
a tile of some S words that overlaps its neighbours.

Tiles in which no block comes again are found by rolling hashes and not sent
on; the test is exact in the sense that it keeps every tile with a repeat. The
others are dealt out by hash, so a long document's tiles are solved by many
tasks. Inside a tile the Z-functions of the text after the boundary and of the
reversed text before it say how far words agree at each distance. Both ends
are clipped to the tile; the next tile goes on where one ends. The pieces of
intervals are shuffled by document and period and stitched where they touch.

Edge cases: a missing or empty text has no words and no runs; repeated rows and
rows that share a doc_id, or have none, are each a document of their own; very
long texts are cut into tiles like others; an empty table gives an empty
result; columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.words import worker_state
from marketloom.session import materialize

LEAST, TIMES = 24, 3
RUN = "struct<start: long, length: long, period: long>"
TILE = "struct<block: int, low: long, centre: int, words: binary>"
#: Odd, so it has an inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; bytes.split() parts at the six plain white-space characters."""
    return (text or "").encode().split()


def coded(words: list) -> np.ndarray:
    """Words as numbers, equal exactly for equal words."""
    codes: dict = {}
    return np.fromiter([codes.setdefault(w, len(codes)) for w in words], np.int64, len(words))


def lowest_block(least: int, times: int) -> int:
    """Block of the lowest octave, which holds all periods below twice as many words.

    Two blocks fit into the shortest interval along which a run agrees.
    """
    if times < 3:
        raise ValueError("a run has at least three periods")
    return max(1, (min(max(least - q, (times - 1) * q) for q in range(1, max(least, 2))) + 1) // 2)


def octaves(n: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """(block, smallest period, largest period) of each octave in which n words can have runs."""
    out, low, block = [], 1, lowest_block(least, times)
    while low * times <= n and least <= n:
        out.append((block, low, min(2 * block - 1, n // times)))
        low, block = 2 * block, 2 * block
    return out


def powers(n: int, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the factor and of its inverse; ``kept`` holds the longest so far."""
    if n > kept.get("n", -1):
        kept["n"] = size = max(n, 4096)
        for name, f in (("up", FACTOR), ("down", pow(FACTOR, -1, 1 << 64))):
            kept[name] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, np.uint64(f)))))
    return kept["up"][:n], kept["down"][:n]


def live_tiles(codes: np.ndarray, least: int = LEAST, times: int = TIMES,
               kept: dict | None = None) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(block, first word, place of the boundary, words) of each tile in which a block comes again."""
    n = len(codes)
    levels = octaves(n, least, times)
    if not levels:
        return
    with np.errstate(over="ignore"):
        up, down = powers(n, {} if kept is None else kept)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed * up)))
        for block, low, high in levels:
            # Hash of each stretch of a block's size, wherever it stands.
            hashes = (sums[block:] - sums[:n - block + 1]) * down[:n - block + 1]
            if low == 1:
                # Blocks of all octaves begin with one of this size: where none of these comes again, none does.
                ordered = np.sort(hashes)
                if not (ordered[1:] == ordered[:-1]).any():
                    return
            starts = np.arange(0, len(hashes) - low, block)
            # Rows of the hashes a boundary's block is compared with; those beyond the end are other than any.
            ahead = np.concatenate((hashes[low:], np.zeros(high, np.uint64)))
            views = sliding_window_view(ahead, high - low + 1)[starts]
            same = views == hashes[starts][:, None]
            if not same.any():
                continue
            same &= starts[:, None] + np.arange(low, high + 1) < len(hashes)
            for b in starts[same.any(axis=1)].tolist():
                begin = max(0, b - block)
                yield block, begin, b - begin, codes[begin:b + 2 * block + high]


def z_function(text: list[int], upto: int) -> list[int]:
    """Length of the longest common prefix of the text with its suffixes that start before ``upto``."""
    n = len(text)
    upto = min(upto, n)
    z = [0] * upto
    left = right = 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve(block: int, low: int, centre: int, words: list[int], lowest: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to): where words agree at a period's distance, around a tile's boundary.

    Counted from the document's start; at most one block before the boundary
    and two after it.
    """
    after = z_function(words[centre:], 2 * block)
    periods = [q for q in range(1 if block == lowest else block, len(after)) if after[q] >= block]
    if not periods:
        return
    # Before the boundary: agreement read backwards, from b - 1 and from b + q - 1.
    back, reach = words[:centre][::-1], centre + periods[-1]
    start = len(back) + 1 + reach - centre  # where the text before the boundary begins, read backwards
    before = z_function([*back, -1, *words[:reach][::-1]], start - periods[0] + 1) if back else []
    for q in periods:
        left = min(before[start - q], block) if back else 0
        yield q, low + centre - left, low + centre + min(after[q], 2 * block)


def tiled(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, words, tiles) of the documents with a live tile; words joined by a space."""

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.list_(pa.struct([
            ("block", pa.int32()), ("low", pa.int64()), ("centre", pa.int32()), ("words", pa.binary())])))
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                rows = []
                kept = worker_state("periodic-powers")
                for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    words = words_of(text)
                    tiles = [{"block": block, "low": low, "centre": centre, "words": part.astype("<i4").tobytes()}
                             for block, low, centre, part in live_tiles(coded(words), least, times, kept)]
                    if tiles:
                        rows.append((doc, b" ".join(words).decode(), tiles))
                columns = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "words", "tiles"])

    return docs.mapInArrow(tile, f"doc_id long, words string, tiles array<{TILE}>")


def untiled(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, words) of the documents without a live tile, which have no runs."""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                ids, texts = [], []
                kept = worker_state("periodic-powers")
                for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    words = words_of(text)
                    if next(live_tiles(coded(words), least, times, kept), None) is None:
                        ids.append(doc)
                        texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "words"])

    return docs.mapInArrow(plain, "doc_id long, words string")


def fragments(tiles: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(row, period, from, to) of what each tile holds."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest = lowest_block(least, times)
        for batch in batches:
            rows = []
            for row, block, low, centre, raw in zip(
                    *(batch[c].to_pylist() for c in ("row", "block", "low", "centre", "words")), strict=True):
                words = np.frombuffer(raw, "<i4").tolist()
                rows += [(row, q, a, b) for q, a, b in solve(block, low, centre, words, lowest)]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["row", "period", "from", "to"])

    return tiles.mapInArrow(solved, "row long, period long, from long, to long")


def stitched(parts: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(row, start, length, period) of the runs that the fragments make up.

    Fragments of one document and period that touch are one interval, and an
    interval from s to e is a run up to e + period. What has a period has its
    multiples as well, over the same words: the smallest one counts.
    """
    along = Window.partitionBy("row", "period").orderBy("from", "to")
    reach = F.max("to").over(along.rowsBetween(Window.unboundedPreceding, -1))
    whole = (
        parts.withColumn("_new", F.coalesce((F.col("from") > reach).cast("int"), F.lit(1)))
        .withColumn("_interval", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "period", "_interval").agg(F.min("from").alias("start"), F.max("to").alias("_end"))
        .withColumn("length", F.expr("_end + period - start"))
    )
    return (
        whole.where((F.col("length") >= least) & (F.col("length") >= times * F.col("period")))
        .groupBy("row", "start", "length").agg(F.min("period").alias("period"))
    )


def without_repeats(words: list[str], runs: list[dict]) -> list[str]:
    """The words that no run holds after its first period."""
    change = [0] * (len(words) + 1)
    for run in runs:
        change[run["start"] + run["period"]] += 1
        change[run["start"] + run["length"]] -= 1
    kept, open_ = [], 0
    for word, step in zip(words, change, strict=False):
        open_ += step
        if not open_:
            kept.append(word)
    return kept


def collapsed(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, collapsed): each document's runs, by start and period, and its words without their repeats.

    Only documents with a live tile are stored and shuffled; the others' words
    are made once more where they are read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    stored = materialize(
        tiled(docs, least, times).withColumn("row", F.monotonically_increasing_id()), "tiles")
    tiles = stored.select("row", F.explode("tiles").alias("t")).select("row", "t.*")
    parts = fragments(tiles.repartition(F.col("row"), F.col("block"), F.col("low")), least, times)
    runs = (
        stitched(parts, least, times).groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
        .select("row", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))
    )
    none: Column = F.array().cast(f"array<{RUN}>")

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for words, found in zip(batch["words"].to_pylist(), batch["runs"].to_pylist(), strict=True):
                texts.append(b" ".join(without_repeats(words.encode().split(), found)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["runs"], pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])

    periodic = (
        stored.select("row", "doc_id", "words").join(runs, "row", "left")
        .select("doc_id", "words", F.coalesce("runs", none).alias("runs"))
        .mapInArrow(collapse, f"doc_id long, runs array<{RUN}>, collapsed string")
    )
    return periodic.unionByName(untiled(docs, least, times).select("doc_id", none.alias("runs"), F.col("words").alias("collapsed")))
