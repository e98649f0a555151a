"""Pack documents into training sequences by cutting-stock column generation.

A document's ids are cut into full sequences and one remainder. Remainders fall
into length classes of ``grain`` ids, and the histogram of classes is the
demand of a cutting-stock problem: a linear program over patterns (how many
pieces of each class share a sequence), whose columns are priced by a knapsack
dynamic program on the duals. The solution is rounded down and the few pieces
left over are packed largest first. Only the histogram (at most
capacity / grain numbers) and the patterns are on the driver. Pieces are ranked
within their class in (doc_id, start) order; the rank decides which pattern,
and so which sequence, a piece goes to.

Edge cases: a missing or empty text is its end id alone; equal rows are packed
each; a text longer than a sequence is cut; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.ranking import with_row_index
from marketloom.session import materialize

CAPACITY = 2048
GRAIN = 16
END_ID = 1
#: Words whose ids a Python worker keeps; beyond that it starts anew.
CACHED_WORDS = 1_200_000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


class WordIds:
    """Ids of texts, word by word, as little-endian 32-bit bytes.

    White space always ends a token, so a text's ids are its words' ids one
    after the other and frequent words are looked up. New words of Latin
    letters, with at most one mark at the end, go straight to the tokenizer's
    model, letters and mark apart as the tokenizer takes them. The others are
    encoded together, with a word between them whose id nothing else can have.
    """

    MARK = "|"
    PLAIN = r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)"
    ODD_SPACES = r"[\x1c-\x1f\x85\xa0  -     　]"

    def __init__(self, tokenizer_path: str, cached: int) -> None:
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.mark = self.encode(self.MARK)
        self.cached = cached
        self.known: dict[str, bytes] = {}
        self.letters = re.compile(self.PLAIN).fullmatch
        self.ends = {end: self.encode(end) for end in ("", ".", ",")}
        # The model's alphabet: printable Latin-1 as it is, other bytes from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = dict(zip((b for b in range(256) if b not in printable), range(256, 512), strict=False))
        self.tokenize = self.tokenizer.model.tokenize
        self.odd = re.compile(self.ODD_SPACES)
        self.plain = re.compile(r"[ \t\n\r\x0b\x0c]+")

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def split(self, text: str) -> list[str]:
        # str.split() and the tokenizer differ on a few rare space characters.
        return [w for w in self.plain.split(text) if w] if self.odd.search(text) else text.split()

    def learn(self, words: set[str]) -> None:
        whole = set()
        for word in words:
            if found := self.letters(word):
                core = found[1].lower()
                if not core.isascii():
                    core = core.encode().decode("latin-1").translate(self.alphabet)
                ids = [t.id for t in self.tokenize(core)]
                self.known[word] = pack_ids(f"<{len(ids)}I", *ids) + self.ends[found[2]]
            else:
                whole.add(word)
        self.learn_whole(whole)

    def learn_whole(self, words: set[str]) -> None:
        plain = [w for w in words if self.MARK not in w]
        if plain:
            raw = self.encode(f" {self.MARK} ".join(plain))
            ends = (np.flatnonzero(np.frombuffer(raw, "<u4") == np.frombuffer(self.mark, "<u4")[0]) * 4).tolist()
            for word, a, b in zip(plain, [0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True):
                self.known[word] = raw[a:b]
        for word in words.difference(plain):
            self.known[word] = self.encode(word)

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cached:
            self.known.clear()
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def worker_ids(tokenizer_path: str, cached: int) -> WordIds:
    """The worker process's own WordIds, kept from task to task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_marketloom_word_ids", {})
    if (tokenizer_path, cached) not in kept:
        kept[tokenizer_path, cached] = WordIds(tokenizer_path, cached)
    return kept[tokenizer_path, cached]


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
        cached: int = CACHED_WORDS) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): each document's ids in pieces of at most ``capacity``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_ids(tokenizer_path, cached)
        end = np.asarray([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in (whole.slice(s, 256) for s in range(0, whole.num_rows, 256)):
                rows: list[tuple] = []
                for doc, ids in zip(batch["doc_id"].to_pylist(), words.of([t or "" for t in batch["text"].to_pylist()]),
                                    strict=True):
                    raw = ids + end
                    for a in range(0, len(raw), 4 * capacity):
                        part = raw[a:a + 4 * capacity]
                        rows.append((doc, a // 4, len(part) // 4, part, len(raw) // 4))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES)


def best_pattern(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack dynamic program: the most valuable pattern of at most ``capacity``."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = np.searchsorted(sizes, room, side="right")
        value[room] = value[room - 1]
        if n:
            total = value[room - sizes[:n]] + worth[:n]
            k = int(total.argmax())
            if total[k] > value[room] + 1e-12:
                value[room], choice[room] = total[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if (k := choice[room]) < 0:
            room -= 1
        else:
            pattern[k] += 1
            room -= sizes[k]
    return float(value[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, refresh: int = 500,
          least: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per column) and how often each is used, as a linear program.

    Starts from one pattern per class and brings in the best-priced column until
    none improves. Any basis on the way is a valid plan, so it also stops where
    ``refresh`` columns have saved less than the share ``least``. The demand is
    shifted a little for each class, against cycling.
    """
    wanted = demand * (1 + 1e-6 * np.sqrt(np.arange(1, len(sizes) + 1)))
    fill = capacity // sizes
    basis, inverse, used = np.diag(fill).astype(float), np.diag(1.0 / fill), wanted / fill
    step, before = 0, np.inf
    while True:
        if step % refresh == 0:
            used = np.maximum(inverse @ wanted, 0)  # drops what rounding has added up
            if used.sum() > before * (1 - least):
                break
            before = used.sum()
        gain, column = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if gain <= 1 + 1e-7:
            break
        move = inverse @ column
        ratio = np.where(move > 1e-7, used / np.where(move > 1e-7, move, 1), np.inf)
        out = int(ratio.argmin())
        enter = ratio[out]
        used = np.maximum(used - enter * move, 0)
        used[out] = enter
        basis[:, out] = column
        inverse[out] /= move[out]
        others = np.arange(len(sizes)) != out
        inverse[others] -= np.outer(move[others], inverse[out])
        step += 1
    return np.rint(basis).astype(np.int64), np.maximum(inverse @ demand, 0)


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns {class: pieces} with their multiplicities, covering ``counts`` exactly."""
    if not counts:
        return []
    sizes = np.array(sorted(counts))
    left = np.array([counts[s] for s in sizes.tolist()])
    basis, used = solve(sizes, left.astype(float), capacity)
    plan = []
    for column, times in zip(basis.T, np.floor(used + 1e-9).astype(np.int64), strict=True):
        wanted = column > 0
        times = int(min(times, (left[wanted] // column[wanted]).min())) if wanted.any() else 0
        if times > 0:
            plan.append(({int(s): int(n) for s, n in zip(sizes[wanted], column[wanted], strict=True)}, times))
            left = left - times * column
    while left.any():  # what rounding leaves: largest first
        room, pattern = capacity, {}
        for i in np.flatnonzero(left)[::-1]:
            n = int(min(left[i], room // sizes[i]))
            if n:
                pattern[int(sizes[i])] = n
                room -= n * int(sizes[i])
        times = min(int(left[np.searchsorted(sizes, s)]) // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[np.searchsorted(sizes, s)] -= n * times
        plan.append((pattern, times))
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per class: rows (first rank, first sequence, pieces per sequence), by rank."""
    out: dict[int, list] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for size, n in pattern.items():
            out.setdefault(size, []).append((rank.get(size, 0), sequence, n))
            rank[size] = rank.get(size, 0) + n * times
        sequence += times
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, start, length and any other columns."""
    # The sort samples its input first, so the pieces are stored, not made twice.
    pieces, classes = materialize(pieces, "pieces"), capacity // grain
    cls = F.least(F.ceil(F.col("length") / grain), F.lit(classes)).cast("int")
    indexed = with_row_index(pieces.withColumn("_class", cls), ["_class", "doc_id", "start"], "_idx", start=0)
    counts = {r[0]: r[1] for r in indexed.groupBy("_class").count().orderBy("_class").collect()}  # <= classes rows
    first, at = {}, 0
    for c, n in counts.items():
        first[c], at = at, at + n
    table = places(patterns(counts, classes))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, rank = batch["_class"].to_numpy(), batch["_idx"].to_numpy()
            sequence, slot = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
            for k in np.unique(c):
                rows = np.flatnonzero(c == k)
                r, own = rank[rows] - first[k], table[k]
                i = np.searchsorted(own[:, 0], r, side="right") - 1
                share, rest = np.divmod(r - own[i, 0], own[i, 2])
                sequence[rows], slot[rows] = own[i, 1] + share, (classes - k) * classes + rest
            yield pa.RecordBatch.from_arrays(
                [*(col for name, col in zip(batch.schema.names, batch.columns, strict=True) if name in kept),
                 pa.array(sequence), pa.array(slot)], names=[*kept, "sequence_id", "_slot"])

    kept = pieces.columns
    schema = ", ".join([*(f"`{n}` {t}" for n, t in pieces.dtypes), "sequence_id long", "_slot long"])
    # A sequence holds at most ``classes`` pieces, so the window is bounded.
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        indexed.mapInArrow(assign, schema)
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .drop("_slot")
    )
