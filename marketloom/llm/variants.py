"""Spelling variants of words by a frequency-vector trie.

Letters fall into groups of about equal use. A word is the vector of its letter
counts by group, and all words form a trie: level k branches on the count of
group k. One inserted, deleted or replaced character raises at most one count
by one (a surplus) and lowers at most one by one (a deficit), so the words near
a given one lie where a depth-first search arrives that may spend one surplus
and one deficit. What such a search finds at the leaves is verified letter by
letter.

The trie is dealt out by its first levels. Those levels' share of the budget is
spent before the shuffle: a word goes to the subtree of its own prefix, and to
each one whose prefix has one letter of one group less, where it has spent its
surplus. Two near words then meet in exactly one subtree: the one of what their
prefixes have in common. The depth of the prefix is the least at which no
subtree holds more than ``SUBTREE`` words, so subtrees stay small however many
words there are.

Edge cases: a missing or empty text has no words; a row without doc_id counts
like any other; repeated rows count again; ties of a form are settled by
code-point order; an empty table gives no words; columns beside doc_id and
text are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from operator import ne

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, TIMES_MORE = 7, 2, 10
GROUPS = 20
#: Words of a subtree beyond which the trie is dealt out by one level more.
SUBTREE = 2048
#: Distinct words a task counts before it hands them on.
COUNTED = 200_000
#: Counts are letters from here on, so that a vector is a string. Larger ones
#: count as ``MOST``, which brings vectors closer only.
ZERO, MOST = 48, 20_000

Change = Callable[[str, str], str]
#: The rest of the vector below the prefix, the group that lost a letter, the word, its occurrences.
Entry = tuple[str, int, str, int]


def counted(docs: DataFrame, least: int = MIN_LENGTH, change: Change | None = None) -> DataFrame:
    """(word, n): words of at least ``least`` letters with their occurrences, summed within tasks only.

    ``change(doc_id, word)`` gives the spelling to count for a word of a
    document, for instance to plant errors; rows without doc_id keep theirs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
        runs = re.compile(f"[{LETTERS}]{{{least},}}")
        total: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word, n in Counter(runs.findall((text or "").encode().translate(lower).decode())).items():
                    if change is not None and doc is not None:
                        word = change(doc, word)
                        if len(word) < least:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) > COUNTED:
                    yield flush()
        yield flush()

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, "word string, n long")


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[int, str]:
    """Group of each letter: the next most used one goes to the group used least so far.

    The driver gets one count per letter of the alphabet.
    """
    used = (
        words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
        .groupBy("letter").count().orderBy(F.desc("count"), "letter").collect()
    )
    weight, out = [0] * groups, {}
    for letter, n in used:
        k = weight.index(min(weight))
        weight[k] += n
        out[ord(letter)] = chr(ZERO + k)
    return out


def profiled(words: DataFrame, table: dict[int, str], groups: int) -> DataFrame:
    """Words with ``profile``: the counts of their letters by group, a character each."""

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [chr(ZERO + k) for k in range(groups)]
        for batch in batches:
            made = ["".join([chr(ZERO + min(n, MOST)) for n in map(w.translate(table).count, marks)])
                    for w in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], pa.array(made, pa.string())], names=["word", "n", "profile"])

    return words.select("word", "n").mapInArrow(profiles, "word string, n long, profile string")


def subtree_depth(words: DataFrame, groups: int, most: int = SUBTREE) -> int:
    """The least prefix at which no subtree holds more than ``most`` words, or all levels."""
    depths = F.array(*[F.lit(d) for d in range(1, groups)])
    sizes = (
        words.select("profile", F.explode(depths).alias("depth"))
        .groupBy("depth", F.expr("substring(profile, 1, depth)").alias("prefix")).count()
        .groupBy("depth").agg(F.max("count").alias("largest"))
    )
    return next((r["depth"] for r in sizes.orderBy("depth").collect() if r["largest"] <= most), groups)


def dealt(words: DataFrame, depth: int) -> DataFrame:
    """(subtree, spent, word, n, rest): each word at its own prefix and at those with one letter less.

    ``spent`` is the group that lost its letter, from 1; 0 at the word's own prefix.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            subtree, spent, at = [], [], []
            for i, profile in enumerate(batch["profile"].to_pylist()):
                prefix = profile[:depth]
                subtree.append(prefix)
                spent.append(0)
                at.append(i)
                for k, c in enumerate(prefix):
                    if (n := ord(c)) > ZERO:
                        subtree.append(prefix[:k] + chr(n - 1) + prefix[k + 1:])
                        spent.append(k + 1)
                        at.append(i)
            rest = [p[depth:] for p in batch["profile"].to_pylist()]
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(subtree, pa.string()), pa.array(spent, pa.int32()), batch["word"].take(at),
                 batch["n"].take(at), pa.array(rest, pa.string()).take(at)],
                names=["subtree", "spent", "word", "n", "rest"])

    return words.mapInArrow(deal, "subtree string, spent int, word string, n long, rest string")


def one_edit(a: str, b: str) -> bool:
    """True if exactly one character is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(map(ne, a, b)) == 1
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1:]


def grow(vectors: list[str], low: int, high: int, level: int) -> dict | int:
    """Trie of the sorted distinct vectors low to high: dicts by count, single vectors as their number."""
    if high - low == 1:
        return low
    node, start = {}, low
    while start < high:
        count, end = vectors[start][level], start + 1
        while end < high and vectors[end][level] == count:
            end += 1
        node[ord(count)] = grow(vectors, start, end, level + 1)
        start = end
    return node


def reachable(root: dict | int, vectors: list[str], vector: str) -> list[tuple[int, int, int]]:
    """Leaves within the budget, depth first: (leaf, surplus, deficit of ``vector`` there)."""
    counts, found = list(map(ord, vector)), []
    todo = [(root, 0, 0, 0)]
    while todo:
        node, level, surplus, deficit = todo.pop()
        if type(node) is int:
            for mine, theirs in zip(counts[level:], map(ord, vectors[node][level:]), strict=True):
                if mine > theirs:
                    surplus += mine - theirs
                elif theirs > mine:
                    deficit += theirs - mine
            if surplus < 2 and deficit < 2:
                found.append((node, surplus, deficit))
            continue
        count, level = counts[level], level + 1
        if (child := node.get(count)) is not None:
            todo.append((child, level, surplus, deficit))
        if not surplus and (child := node.get(count - 1)) is not None:
            todo.append((child, level, 1, deficit))
        if not deficit and (child := node.get(count + 1)) is not None:
            todo.append((child, level, surplus, 1))
    return found


def verified(a: Entry, others: list[Entry]) -> Iterator[tuple[Entry, Entry]]:
    """The others whose word is one edit away; an edit leaves the first or the last half as it is."""
    word = a[2]
    half = (len(word) - 1) // 2
    start, end = word[:half], word[len(word) - half:]
    for b in others:
        other = b[2]
        if (other.startswith(start) or other.endswith(end)) and one_edit(word, other):
            yield a, b


def near_in(entries: list[Entry]) -> Iterator[tuple[Entry, Entry]]:
    """Pairs of near words in one subtree.

    Searches start at words in the subtree of their own prefix. A word that has
    lost a letter on the way here has spent the searching word's deficit, and two
    such words must be equal from here on and have lost letters of two groups.
    """
    vectors = sorted({e[0] for e in entries})
    number = {v: i for i, v in enumerate(vectors)}
    own: list[list[Entry]] = [[] for _ in vectors]
    lost: list[list[Entry]] = [[] for _ in vectors]
    for e in entries:
        (lost if e[1] else own)[number[e[0]]].append(e)
    root = grow(vectors, 0, len(vectors), 0) if vectors and vectors[0] else 0
    for leaf, vector in enumerate(vectors):
        for k, a in enumerate(lost[leaf]):
            yield from verified(a, [b for b in lost[leaf][k + 1:] if a[1] != b[1]])
        if not own[leaf]:
            continue
        for other, _, deficit in reachable(root, vectors, vector):
            for k, a in enumerate(own[leaf]):
                if other >= leaf:
                    yield from verified(a, own[other] if other > leaf else own[leaf][k + 1:])
                if not deficit:
                    yield from verified(a, lost[other])


def near_words(words: DataFrame, depth: int) -> DataFrame:
    """(word, near, near_n) for either word of each pair of near words."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries = None, []

        def pairs() -> pa.RecordBatch:
            rows = []
            for (_, _, u, n_u), (_, _, v, n_v) in near_in(entries):
                rows += [(u, v, n_v), (v, u, n_u)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)],
                names=["word", "near", "near_n"])

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("subtree", "rest", "spent", "word", "n")), strict=True)
            for subtree, *entry in rows:
                if subtree != at:
                    if len(entries) > 1:
                        yield pairs()
                    at, entries = subtree, []
                entries.append(tuple(entry))
        if len(entries) > 1:
            yield pairs()

    return (
        dealt(words, depth).repartition("subtree").sortWithinPartitions("subtree")
        .mapInArrow(search, "word string, near string, near_n long")
    )


def rooted(forms: DataFrame, times_more: int, most: int) -> DataFrame:
    """(word, root): forms followed to the last one, twice as far each round.

    A form is at least ``times_more`` as frequent as its word and none is more
    frequent than ``most``, which bounds the length of a chain and the rounds.
    """
    chain = math.log(max(most, 2), times_more) if times_more > 1 else most
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(chain + 1))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        roots = materialize(roots.join(further, "root", "left").select(
            "word", F.coalesce("_further", "root").alias("root")), "roots")
    return roots


def grouped(words: DataFrame, min_count: int = MIN_COUNT, times_more: int = TIMES_MORE, groups: int = GROUPS,
            subtree: int = SUBTREE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``counted`` with at least ``min_count`` occurrences.

    A word's form is its most frequent near word if that occurs at least
    ``times_more`` as often (of equally frequent ones the smallest); its root is
    what its form's forms lead to, or the word itself.
    """
    vocabulary = materialize(
        words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "vocabulary")
    profiles = materialize(profiled(vocabulary, letter_groups(vocabulary, groups), groups), "profiles")
    near = (
        near_words(profiles, subtree_depth(profiles, groups, subtree)).groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    )
    formed = F.col("near_n") >= times_more * F.col("n")
    out = materialize(vocabulary.join(near, "word", "left").select(
        "word", F.when(formed, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("near_n")).alias("form_n")), "forms")
    forms = out.where("form IS NOT NULL")
    most = forms.agg(F.max("form_n")).first()[0] or 0
    return out.join(rooted(forms, times_more, most), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
