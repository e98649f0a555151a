"""Remove text that repeats earlier text, by sorting suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier
(in a document with a smaller id, or before in the same one).

Suffixes that could share ``length`` bytes are brought together by the smallest
hash among the k-byte strings inside each window: equal windows have the same
smallest hash. Neighbouring windows with the same hash form a run, the unit that
is shuffled (as hashes and places, without text). Runs that are equal as a whole
are settled by their first place. Where a key has different runs, or a run
could repeat itself, its text is fetched and its suffixes are sorted: multikey
quicksort on 8-byte symbols to a shallow depth, then a blind trie for each
group that still ties, which finds the suffixes equal in all ``length`` bytes.
Keys with many different runs are split further by the bytes that all windows
of a few offsets have in common.

Edge cases: a missing text is empty and nothing is removed from it; each row is
a document of its own, also where rows share a doc_id (ordered by a hash of the text) or have
none (they come last), so of equal rows all but one lose what they repeat; a text
of any length is hashed in tiles, but is one value of a row; other columns travel
in ``row`` whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.rows import numbered
from marketloom.session import materialize

LENGTH = 100
GRAM = 24
SHALLOW = 32
#: Bytes hashed at a time; longer texts are cut into tiles that overlap by a window.
TILE = 1 << 20
#: Different runs of a key from which on it is split by content; fewer fit easily in one task.
SPLIT_FROM = 4096
#: Split texts that a task remembers, to settle equal ones before the shuffle.
REMEMBERED = 100_000
SPLIT_OFFSETS = 8

_FACTOR = 0x100000001B3
_SPREAD = np.random.default_rng(5).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def powers_of_factor(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of the hash factor and of its inverse modulo 2**64."""
    both = []
    for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        p = np.full(n, f, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p))
    return both[0], both[1]


class Hasher:
    """Hashes of any substring of a byte array from one pass of prefix sums."""

    def __init__(self, data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> None:
        ahead, self.back = powers
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SPREAD[data] * ahead[:len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        return _mix((self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w] for each i, in two passes over blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def tiles(docs: Iterator[tuple[int, str]], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (doc_id, base, bytes) of about ``TILE`` bytes."""
    out, size = [], 0
    for doc, text in docs:
        raw = text.encode()
        for base in range(0, max(1, len(raw) - length + 1), TILE):
            part = raw[base:base + TILE + length - 1]
            if len(part) >= length:
                out.append((doc, base, part))
                size += len(part)
            if size >= TILE:
                yield out
                out, size = [], 0
    if out:
        yield out


def runs_of(group: list[tuple[int, int, bytes]], powers: tuple[np.ndarray, np.ndarray], length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with the same smallest gram hash in a list of tiles."""
    sizes = np.array([len(t) for _, _, t in group])
    data = np.frombuffer(b"".join(t for _, _, t in group), np.uint8)
    begin = np.cumsum(sizes) - sizes
    w = length - gram + 1
    with np.errstate(over="ignore"):
        hasher = Hasher(data, powers)
        grams = hasher.grams(gram)
        least = sliding_min(grams, w)
        whole = np.zeros(len(least) + 1, bool)  # window starts that stay inside their tile
        change = np.zeros(len(least) + 1, bool)
        change[1:-1] = least[1:] != least[:-1]
        for b, n in zip(begin.tolist(), sizes.tolist(), strict=True):
            whole[b:b + n - length + 1] = True
            change[b] = True
            change[b + n - length + 1 if b + n - length + 1 < len(change) else -1] = True
        start = np.flatnonzero(change)
        stop = np.append(start[1:], len(least))
        real = whole[start] & (stop > start)
        start, stop = start[real], stop[real]
        n = stop - start
        span = n + w - 1  # grams inside the run's windows
        at = np.repeat(start - (np.cumsum(span) - span), span) + np.arange(span.sum())
        same = np.add.reduceat(grams[at] == np.repeat(least[start], span), np.cumsum(span) - span)
        tile = np.searchsorted(begin, start, side="right") - 1
        return {
            "key": least[start].view(np.int64), "run": hasher.of(start, stop + length - 1).view(np.int64),
            "doc_id": np.array([d for d, _, _ in group], np.int64)[tile],
            "start": np.array([b for _, b, _ in group], np.int64)[tile] + start - begin[tile],
            "n": n.astype(np.int32), "multi": same > 1,
        }


def find_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_of_factor(3 * TILE)
        rows = ((d, t) for b in batches for d, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True))
        for group in tiles(rows, length):
            yield pa.RecordBatch.from_pydict(runs_of(group, powers, length, gram))

    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        runs, "key long, run long, doc_id long, start long, n int, multi boolean")


def settle_runs(runs: DataFrame) -> DataFrame:
    """Runs with a verdict: 'repeat' as a whole, or 'open' and to be sorted.

    Rows stream by in (key, run, place) order; only the first place of the
    current run and one pending row are held, however many rows a key has.
    """
    names = ["key", "run", "doc_id", "start", "n", "multi"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None  # the first run of the last key, while it is the key's only one
        key = run = place = None
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {x: batch[x].to_numpy(zero_copy_only=False) for x in names}
            k, r = c["key"], c["run"]
            new_key = np.append(k[0] != key if key is not None else True, k[1:] != k[:-1])
            new_run = new_key | np.append(r[0] != run if run is not None else True, r[1:] != r[:-1])
            first = np.maximum.accumulate(np.where(new_run, np.arange(len(k)), -1))
            doc0 = np.where(first >= 0, c["doc_id"][first], place[0] if place else 0)
            start0 = np.where(first >= 0, c["start"][first], place[1] if place else 0)
            repeat = ~new_run & ((c["doc_id"] != doc0) | (c["start"] != start0))
            heads = np.flatnonzero(new_run)
            group = np.cumsum(new_key) - new_key[0]
            per_key = np.bincount(group[heads], minlength=group[-1] + 1)
            carried = not new_key[0]
            several = per_key > 1
            if carried:
                several[0] = several[0] or per_key[0] > 0
            open_rows = heads[several[group[heads]] | c["multi"][heads]]
            verdict = np.zeros(len(k), np.int8)
            verdict[repeat] = 1
            verdict[open_rows] = 2
            take = np.flatnonzero(verdict)
            out = {x: c[x][take].tolist() for x in ("key", "doc_id", "start", "n")}
            out["open"] = (verdict[take] == 2).tolist()
            if carried and per_key[0] > 0 and pending is not None:
                for x, v in zip(("key", "doc_id", "start", "n"), pending, strict=True):
                    out[x].append(v)
                out["open"].append(True)
                pending = None
            last_heads = heads[group[heads] == group[-1]]
            if len(last_heads):
                h = last_heads[-1]
                place = (int(c["doc_id"][h]), int(c["start"][h]))
            if group[-1] > 0 or not carried:
                alone = len(last_heads) == 1 and not c["multi"][last_heads[0]]
                h = last_heads[0]
                pending = tuple(int(c[x][h]) for x in ("key", "doc_id", "start", "n")) if alone else None
            key, run = k[-1], r[-1]
            yield pa.RecordBatch.from_pydict(out, schema=SETTLED)

    return (
        runs.repartition("key").sortWithinPartitions("key", "run", "doc_id", "start")
        .mapInArrow(settle, "key long, doc_id long, start long, n int, open boolean")
    )


SETTLED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("open", pa.bool_())])


class BlindTrie:
    """Orders suffixes that share a long prefix; leaves hold those equal in ``length`` bytes.

    Inner nodes keep a depth and one branching byte per child, no text. A
    suffix is led down blindly to some leaf, compared with it once, and placed
    at the depth where the two differ.
    """

    def __init__(self, data: bytes, length: int) -> None:
        self.data, self.length, self.root = data, length, None

    def _common(self, p: int, q: int) -> int:
        lo, hi = 0, self.length
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.data[p:p + mid] == self.data[q:q + mid]:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def add(self, p: int) -> None:
        if self.root is None:
            self.root = [p]
            return
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(self.data[p + depth]) or next(iter(children.values()))
        q = node[0]
        if self.data[p:p + self.length] == self.data[q:q + self.length]:
            node.append(p)
            return
        at = self._common(p, q)
        parent, byte, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < at:
            parent, byte = node, self.data[p + node[0]]
            node = node[1][byte]
        if isinstance(node, tuple) and node[0] == at:
            node[1][self.data[p + at]] = [p]
            return
        made = (at, {self.data[p + at]: [p], self.data[q + at]: node})
        if parent is None:
            self.root = made
        else:
            parent[1][byte] = made

    def leaves(self) -> Iterator[list[int]]:
        """Groups of equal suffixes in lexicographic order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node


def equal_suffixes(data: bytes, group: np.ndarray, pos: np.ndarray, length: int, shallow: int) -> Iterator[np.ndarray]:
    """Sets of suffixes (as indices into pos) of one group that agree in ``length`` bytes.

    ``data`` must have eight bytes of padding. Deep-shallow sorting: three-way
    refinement by 8-byte symbols down to ``shallow``; suffixes alone in their
    class drop out, classes that still tie go to a blind trie.
    """
    symbols = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), 8)
    live, rank = np.arange(len(pos)), group
    for depth in range(0, shallow, 8):
        word = np.ascontiguousarray(symbols[pos[live] + depth]).view(">u8").ravel()
        order = np.lexsort((word, rank))
        live, rank, word = live[order], rank[order], word[order]
        new = np.append(True, (rank[1:] != rank[:-1]) | (word[1:] != word[:-1]))
        rank = np.cumsum(new)
        tied = np.bincount(rank)[rank] > 1
        live, rank = live[tied], rank[tied]
        if not len(live):
            return
    cuts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(live)], strict=True):
        members = live[a:b]
        index = dict(zip(pos[members].tolist(), members.tolist(), strict=True))
        trie = BlindTrie(data, length)
        for p in index:
            trie.add(p)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                yield np.array([index[p] for p in leaf])


def fetch_text(open_runs: DataFrame, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(bucket, doc_id, start, n, data): the text of open runs, cut by offset where a key has many runs.

    Of equal cut texts only the first that a task meets is sent on; later
    places have no data and are repeats.
    """
    many = open_runs.groupBy("key").agg(F.count(F.lit(1)).alias("runs"))
    listed = open_runs.join(many, "key").groupBy("doc_id").agg(
        F.collect_list(F.struct("key", "start", "n", (F.col("runs") >= SPLIT_FROM).alias("hot"))).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_of_factor(TILE + 2 * length)
        seen: dict[tuple[int, bytes], tuple[int, int]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                doc, raw, rows = batch["doc_id"][i].as_py(), batch["text"][i].as_py().encode(), []
                for r in batch["runs"][i].as_py():
                    s, n = r["start"], r["n"]
                    part = raw[s:s + n + length - 1]
                    for bucket, a, b in split_run(part, r["key"], n, powers) if r["hot"] else [(r["key"], 0, n)]:
                        own = part[a:b + length - 1]
                        if r["hot"] and seen.setdefault((bucket, own), (doc, s + a)) < (doc, s + a):
                            own = None
                        rows.append((bucket, s + a, b - a, own))
                    if len(seen) > REMEMBERED:
                        seen.clear()
                bucket, start, n, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int64()), pa.array([doc] * len(rows), pa.int64()), pa.array(start, pa.int64()),
                     pa.array(n, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "doc_id", "start", "n", "data"])

    def split_run(part: bytes, key: int, n: int, powers: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(bucket, from, to) of the windows of a run, by their first anchor and offset from it.

        The windows of ``SPLIT_OFFSETS`` neighbouring offsets share all but a
        few bytes; what they share is hashed into the bucket.
        """
        with np.errstate(over="ignore"):
            hasher = Hasher(np.frombuffer(part, np.uint8), powers)
            anchors = np.flatnonzero(hasher.grams(gram).view(np.int64) == key)
            p = np.arange(n)
            anchor = anchors[np.searchsorted(anchors, p)]
            o = (anchor - p) // SPLIT_OFFSETS * SPLIT_OFFSETS
            cuts = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (o[1:] != o[:-1])))
            low = (anchor - o)[cuts]
            common = hasher.of(low, low - SPLIT_OFFSETS + 1 + length)
            buckets = (np.uint64(key & (2**64 - 1)) ^ _mix(common + o[cuts].astype(np.uint64))).view(np.int64)
        return zip(buckets.tolist(), cuts.tolist(), [*cuts[1:].tolist(), n], strict=True)

    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.join(listed, "doc_id").mapInArrow(cut, "bucket long, doc_id long, start long, n int, data binary")


def sort_suffixes(open_text: DataFrame, length: int, shallow: int) -> DataFrame:
    """(doc_id, start, n): windows equal to an earlier one, found by sorting each bucket's suffixes."""

    def flagged(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        bucket, doc, start, n, data = zip(*rows, strict=True)
        sizes, n = np.array([len(d) for d in data]), np.array(n)
        row = np.repeat(np.arange(len(n)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos = (np.cumsum(sizes) - sizes)[row] + within
        docs, starts = np.array(doc, np.int64)[row], np.array(start, np.int64)[row] + within
        hit = np.zeros(len(pos), bool)
        blob = b"".join(data) + bytes(8)
        for same in equal_suffixes(blob, np.unique(np.array(bucket), return_inverse=True)[1][row], pos, length, shallow):
            d = docs[same]
            early = same[d == d.min()]
            first = starts[early].min()
            hit[same] = (d != d.min()) | (starts[same] != first)
        at = np.flatnonzero(hit)
        cuts = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(row[at]) != 0))) if len(at) else at
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[at[cuts]]), pa.array(starts[at[cuts]]),
             pa.array(np.diff(np.append(cuts, len(at))).astype(np.int32))], names=["doc_id", "start", "n"])

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("bucket", "doc_id", "start", "n", "data")), strict=True):
                if size > TILE and r[0] != held[-1][0]:
                    yield flagged(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield flagged(held)

    return (
        open_text.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(buckets, "doc_id long, start long, n int")
    )


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW) -> DataFrame:
    """(doc_id, windows): the windows of each document that also start earlier, as (start, n).

    Every row must have a doc_id of its own, see ``rows.numbered``.
    """
    settled = materialize(settle_runs(find_runs(docs, length, gram)), "settled-runs")
    text = materialize(
        fetch_text(settled.where("open").select("key", "doc_id", "start", "n"), docs, length, gram), "open-runs")
    found = (
        settled.where("NOT open").select("doc_id", "start", "n")
        .union(text.where("data IS NULL").select("doc_id", "start", "n"))
        .union(sort_suffixes(text.where("data IS NOT NULL"), length, shallow))
    )
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("windows"))


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW,
                 whole_characters: bool = False) -> DataFrame:
    """Each document as ``row`` with ``spans`` (from, to) of bytes to remove and ``kept``, the bytes that stay.

    With ``whole_characters`` what is left of a character that a span cuts
    through goes too, so the kept bytes are valid UTF-8.
    """
    own, _ = numbered(docs)
    texts = own.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text"))
    found = repeats(texts, length, gram, shallow).withColumnRenamed("doc_id", "_doc_id")

    def spans_of(windows: list[dict] | None) -> list[tuple[int, int]]:
        out: list[list[int]] = []
        for s, e in sorted((w["start"], w["start"] + w["n"] - 1 + length) for w in windows or ()):
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        return [(s, e) for s, e in out]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Documents are taken some at a time: each may hold many windows as Python objects.
        for batch in (whole.slice(s, 256) for whole in batches for s in range(0, whole.num_rows, 256)):
            spans, kept = [], []
            for text, windows in zip(batch["row"].field("text").to_pylist(), batch["_windows"].to_pylist(), strict=True):
                raw, at, parts = (text or "").encode(), 0, []
                spans.append([{"from": s, "to": e} for s, e in spans_of(windows)])
                for s, e in spans_of(windows):
                    parts.append(raw[at:s])
                    at = e
                parts.append(raw[at:])
                if whole_characters:
                    parts = [x.decode(errors="ignore").encode() for x in parts]
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["row", "spans", "kept"])

    # The text crosses the exchange once, inside its row.
    rows = own.select("row", F.col("id").alias("_id"))
    joined = rows.join(found, F.col("_id") == F.col("_doc_id"), "left").select("row", F.col("windows").alias("_windows"))
    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, spans array<struct<from: bigint, to: bigint>>, kept binary")
