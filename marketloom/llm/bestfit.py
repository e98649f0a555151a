"""Pack whole documents into sequences: matched large pieces, then best fit.

A document's ids stay together unless they are longer than a sequence; then
they are cut from the end into full pieces, so only the first may be shorter.
Of pieces above a third of the capacity at most two share a sequence, so they
are matched: the longest takes the longest other one that still fits. Pieces of
a third and below then go, longest first, where they leave the least room.

Both steps look at lengths only, so they run on the histogram of lengths (at
most ``capacity`` numbers, the one thing that comes to the driver), a whole
range of like sequences at a time. The result is a table from (length, rank) to
(sequence, offset); ranks are given in (length, doc_id, start) order by a
distributed sort, and no task holds more than that table and a batch.

Edge cases: a missing or empty text is its end id alone; equal rows, rows that
share a doc_id and rows without one are packed each; an empty table gives no
pieces; columns of the input beside doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import worker_state
from marketloom.operators.ranking import with_row_index
from marketloom.session import materialize

CAPACITY = 2048
END_ID = 0
#: Chunks of text in one generation of those whose ids a Python worker keeps.
CACHED_CHUNKS = 600_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class ChunkIds(dict):
    """Ids of texts under a byte-level BPE, as little-endian 32-bit bytes.

    The tokenizer never joins a character that is no space with a space after
    it, so a text is cut at its spaces and the ids of chunks are looked up:
    ``self["word"]`` has those of " word", ``self["\nword"]`` those of the line's
    start, ``self["\rword"]`` those of "word" at the start of a text. Of two
    generations of known chunks the older goes when the younger is full, so
    frequent ones stay. A new chunk that is a word with marks after it goes
    straight to the tokenizer's model; others, and texts with long or rare
    white space or special tokens, go through the whole tokenizer.
    """

    RARE_SPACE = re.compile(r"[^\S \n]")
    LONG_SPACE = ("   ", "  \n", " \n ", " \n\n", "\n  ", "\n \n", "\n\n ", "\n\n\n")
    SPACE_END = ("  ", " \n", "\n ", "\n\n")
    WORD = re.compile(r"(\n?)( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, tokenizer_path: str, cached: int) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.cached = cached
        self.older: dict[str, bytes] = {}
        # The model's alphabet: printable Latin-1 as it is, other bytes from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
        self.space = chr(self.alphabet[ord(" ")])
        self.tokenize = self.tokenizer.model.tokenize

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        """Ids of what the tokenizer takes as one word."""
        if word.isascii():  # letters, which are themselves in the alphabet, after a space at most
            letters = word.replace(" ", self.space)
        else:
            letters = word.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.tokenize(letters)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.older.get(chunk)) is None:
            text = chunk[1:] if chunk[:1] == "\r" else chunk if chunk[:1] == "\n" else f" {chunk}"
            if parts := self.WORD.fullmatch(text):
                line, word, marks = parts.groups()
                ids = (self["\n"] if line else b"") + self.word(word) + (self[f"\r{marks}"] if marks else b"")
            else:
                ids = self.encode(text)
        self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        if len(self) > self.cached:
            self.older = dict(self)
            self.clear()
        if (text.endswith(self.SPACE_END) or any(s in text for s in self.LONG_SPACE)
                or any(s in text for s in self.special) or self.RARE_SPACE.search(text)):
            return self.encode(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return (self[f"\r{first}"] if first else b"") + b"".join(map(self.__getitem__, rest))


def worker_ids(tokenizer_path: str, cached: int) -> ChunkIds:
    """The worker process's own ChunkIds, kept from task to task."""
    kept = worker_state("chunk-ids")
    if (tokenizer_path, cached) not in kept:
        kept[tokenizer_path, cached] = ChunkIds(tokenizer_path, cached)
    return kept[tokenizer_path, cached]


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
        cached: int = CACHED_CHUNKS) -> DataFrame:
    """(doc_id, piece, start, length, ids): one piece a document, or full ones after a first shorter one."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = worker_ids(tokenizer_path, cached)
        end = np.asarray([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in (whole.slice(s, 256) for s in range(0, whole.num_rows, 256)):
                rows: list[tuple] = []
                for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    raw = ids_of.of(text or "") + end
                    n = len(raw) // 4
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append((doc, k, a, b - a, raw[4 * a:4 * b]))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces, PIECES)


class Sequences:
    """Sequences as ranges of like ones, by the room left in them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.count = capacity, 0
        self.rooms: list[int] = []
        self.ranges: dict[int, list[tuple[int, int]]] = {}
        self.placed: dict[int, list[tuple[int, int, int, int]]] = {}
        self.rank: dict[int, int] = {}

    def open(self, times: int) -> int:
        first, self.count = self.count, self.count + times
        return first

    def leave(self, room: int, first: int, times: int) -> None:
        """Keep a range of sequences with this much room."""
        if room and times:
            if room not in self.ranges:
                insort(self.rooms, room)
                self.ranges[room] = []
            self.ranges[room].append((first, times))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        """Take out a range with the least room that holds ``length``: (room, first, times)."""
        i = bisect_left(self.rooms, length)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        first, times = self.ranges[room].pop()
        if not self.ranges[room]:
            del self.ranges[room], self.rooms[i]
        return room, first, times

    def place(self, length: int, first: int, times: int, each: int, offset: int) -> None:
        """The next ``times * each`` pieces of this length go to ``times`` sequences from ``first``."""
        rank = self.rank.get(length, 0)
        self.placed.setdefault(length, []).append((rank, first, each, offset))
        self.rank[length] = rank + times * each


def match_large(counts: dict[int, int], seqs: Sequences) -> None:
    """Pieces above a third: each longest one with the longest other that fits, if any does."""
    left = {length: n for length, n in counts.items() if 3 * length > seqs.capacity}
    lengths = sorted(left)
    while lengths:
        long = lengths[-1]
        i = bisect_left(lengths, seqs.capacity - long + 1) - 1
        mate = lengths[i] if i >= 0 else None
        if mate == long and left[long] == 1:
            mate = lengths[i - 1] if i else None
        if mate is None:
            times = left[long]
        else:
            times = left[long] // 2 if mate == long else min(left[long], left[mate])
        first = seqs.open(times)
        seqs.place(long, first, times, 1, 0)
        if mate is not None:
            seqs.place(mate, first, times, 1, long)
        seqs.leave(seqs.capacity - long - (mate or 0), first, times)
        for length in (long, mate):
            if length is not None:
                left[length] -= times
        lengths = [x for x in lengths if left[x]]


def fit_small(counts: dict[int, int], seqs: Sequences) -> None:
    """Pieces of a third and below, longest first, each where it leaves the least room.

    The tightest sequence stays the tightest for a further piece of the same
    length, so it takes as many as it holds.
    """
    for length in sorted((x for x in counts if 3 * x <= seqs.capacity), reverse=True):
        left = counts[length]
        while left:
            found = seqs.tightest(length)
            if found is None:
                each = seqs.capacity // length
                found = seqs.capacity, seqs.open(-(-left // each)), -(-left // each)
            room, first, times = found
            each = min(room // length, left)
            used = min(times, left // each)
            seqs.place(length, first, used, each, seqs.capacity - room)
            seqs.leave(room - each * length, first, used)
            seqs.leave(room, first + used, times - used)
            left -= used * each


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, pieces per sequence, offset of the first), by rank."""
    seqs = Sequences(capacity)
    match_large(counts, seqs)
    fit_small(counts, seqs)
    return {length: np.array(rows, np.int64) for length, rows in seqs.placed.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, start, length and any other columns."""
    # The sort samples its input first, so the pieces are stored, not made twice.
    pieces = materialize(pieces, "whole-pieces")
    kept, schema = pieces.columns, ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    indexed = with_row_index(pieces.withColumn("_length", F.col("length")), ["_length", "doc_id", "start"], "_idx", start=0)
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().orderBy("length").collect()}  # <= capacity rows
    first, at = {}, 0
    for length, n in counts.items():
        first[length], at = at, at + n
    table = plan(counts, capacity)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, rank = batch["_length"].to_numpy(), batch["_idx"].to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                r, own = rank[rows] - first[length], table[length]
                i = np.searchsorted(own[:, 0], r, side="right") - 1
                share, place = np.divmod(r - own[i, 0], own[i, 2])
                sequence[rows], offset[rows] = own[i, 1] + share, own[i, 3] + place * length
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])

    return indexed.mapInArrow(assign, f"{schema}, sequence_id long, offset long")
