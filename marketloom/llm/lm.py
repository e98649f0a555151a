"""Score documents with a log-bilinear language model trained in numpy.

Tokens are the words of a text, lower-cased, and one end token. The model
predicts a token of a bounded vocabulary (the most frequent words, the end and
one class for all other words) from vectors of the two tokens before it. It is
trained with noise-contrastive estimation on every training token: each task
runs AdaGrad over its documents from the same start, and the tasks' parameters
are averaged by Spark, weighted by tokens, once per epoch. A table of
normalisers over all pairs of context tokens, from batched matrix products,
turns scores into normalised log-probabilities. A word of the class of others
gets the class's probability times its smoothed share of the class.

Word counts are a distributed aggregation. Counts of frequent words (at most
``FREQUENT``) go to all tasks; tokens beyond those are looked up by a join.

Edge cases: a missing or empty text is one end token; a missing doc_id counts
as training; equal rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import materialize

VOCABULARY = 512
FREQUENT = 200_000
DIMENSIONS = 16
NOISE = 32
EPOCHS = 2
BATCH = 4096
RATE = 0.05
#: Stands for the end of a text among the words; no word is empty.
END = ""
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().translate(LOWER).split(), b""]


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) over all training tokens, summed inside each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in seen]), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch["text"].to_pylist():
                seen.update(tokens(text))
                if len(seen) > 500_000:
                    yield flush()
        if seen:
            yield flush()

    return training.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """Words with the highest counts, at most ``most``; of those with the lowest count all or none.

    The bound comes from how many words have each count, so no more than these
    words are sent anywhere.
    """
    words = counts.where(F.col("word") != END)
    sizes = words.groupBy((F.when(F.col("c") > 10_000, F.lit(10_000)).otherwise(F.col("c"))).alias("c")).count()
    least, held = None, 0
    for r in sorted(sizes.collect(), reverse=True):  # at most 10,000 rows
        held += r["count"]
        if held > most:
            break
        least = r["c"]
    if least is None:
        return [(r[0], r[1]) for r in words.orderBy(F.col("c").desc(), "word").limit(most).collect()]
    return sorted(((r[0], r[1]) for r in words.where(F.col("c") >= least).collect()), key=lambda x: (-x[1], x[0]))


def scattered(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by index."""
    width = values.shape[1]
    at = index[:, None] * width + np.arange(width)
    return np.bincount(at.ravel(), values.ravel(), n * width).reshape(n, width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.clip(x, -30, 30)
    np.exp(np.negative(y, out=y), out=y)
    y += 1
    return np.divide(1, y, out=y)


class LogBilinear:
    """Vectors of the two context places and of the targets, and target biases."""

    def __init__(self, q: np.ndarray, dimensions: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.log_q = np.log(q)
        self.one, self.two, self.out = (rng.normal(0, 0.1, (len(q), dimensions)) for _ in range(3))
        self.bias = self.log_q.copy()

    def matrix(self) -> np.ndarray:
        """All parameters, one row per token and kind."""
        bias = np.zeros((len(self.bias), self.one.shape[1]))
        bias[:, 0] = self.bias
        return np.concatenate([self.one, self.two, self.out, bias])

    def load(self, matrix: np.ndarray) -> None:
        self.one, self.two, self.out, bias = np.split(matrix, 4)
        self.bias = bias[:, 0].copy()

    def train(self, ids: np.ndarray, context1: np.ndarray, context2: np.ndarray, rng: np.random.Generator,
              squares: list[np.ndarray], noise: int, rate: float) -> None:
        """One AdaGrad step of noise-contrastive estimation, with noise shared by the batch."""
        drawn = rng.choice(len(self.log_q), noise, p=np.exp(self.log_q))
        h = self.one.take(context1, axis=0)
        h += self.two.take(context2, axis=0)
        log_k = np.log(noise)
        target, negative = self.out.take(ids, axis=0), self.out.take(drawn, axis=0)
        true = (h * target).sum(axis=1) + self.bias[ids]
        false = h @ negative.T
        false += self.bias[drawn]
        false -= log_k
        false -= self.log_q[drawn]
        g_true = 1 - sigmoid(true - log_k - self.log_q[ids])
        g_false = sigmoid(false)
        np.negative(g_false, out=g_false)
        g_h = np.multiply(target, g_true[:, None], out=target)
        g_h += g_false @ negative
        n = len(self.bias)
        grads = [
            scattered(context1, g_h, n), scattered(context2, g_h, n),
            scattered(ids, g_true[:, None] * h, n) + scattered(drawn, g_false.T @ h, n),
            np.bincount(ids, g_true, n) + np.bincount(drawn, g_false.sum(axis=0), n),
        ]
        for p, g, s in zip((self.one, self.two, self.out, self.bias), grads, squares, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s + 1e-6)

    def normalisers(self) -> np.ndarray:
        """log of the sum of exp scores for each pair (token before, token two before)."""
        n = len(self.bias)
        out = np.empty((n, n), np.float32)
        for a in range(n):
            scores = (self.one[a] + self.two).astype(np.float32) @ self.out.T.astype(np.float32) + self.bias.astype(np.float32)
            top = scores.max(axis=1)
            out[a] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return out


def shifted(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before and the one two before; documents start after end tokens."""
    one = np.append(end_id, ids[:-1])
    two = np.append(end_id, one[:-1])
    two[np.append(0, ends[:-1] + 1)] = end_id  # the document's first token sees nothing of the one before
    return one, two


def train(training: DataFrame, vocabulary: list[str], q: np.ndarray, dimensions: int, epochs: int, noise: int,
          rate: float, batch_tokens: int, seed: int) -> LogBilinear:
    """Train on all tokens of ``training``; the last id stands for all other words."""
    model = LogBilinear(q, dimensions, seed)
    index = {w.encode(): i for i, w in enumerate(vocabulary)}
    other, end_id, rows = len(vocabulary), vocabulary.index(END), 4 * len(q)

    for epoch in range(epochs):
        start = model.matrix()

        def learn(batches: Iterator[pa.RecordBatch], epoch: int = epoch, start: np.ndarray = start) -> Iterator[pa.RecordBatch]:
            own = LogBilinear(q, dimensions, seed)
            own.load(start.copy())
            squares = [np.zeros_like(p) for p in (own.one, own.two, own.out, own.bias)]
            rng = np.random.default_rng([seed, epoch])
            held: list[np.ndarray] = []
            waiting = seen = 0

            def step() -> int:
                ids = np.concatenate(held)
                one, two = shifted(ids, np.flatnonzero(ids == end_id), end_id)
                for s in range(0, len(ids), batch_tokens):
                    e = s + batch_tokens
                    own.train(ids[s:e], one[s:e], two[s:e], rng, squares, noise, rate)
                held.clear()
                return len(ids)

            for batch in batches:
                for text in batch["text"].to_pylist():
                    words = tokens(text)
                    held.append(np.fromiter(map(index.get, words, repeat(other)), np.int64, len(words)))
                    waiting += len(words)
                    if waiting >= 16 * batch_tokens:
                        seen += step()
                        waiting = 0
            if held:
                seen += step()
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rows, dtype=np.int32)), pa.array(np.full(rows, float(seen))),
                     pa.array((own.matrix() * seen).tolist(), pa.list_(pa.float64()))], names=["row", "tokens", "values"])

        parts = training.select("text").mapInArrow(learn, "row int, tokens double, values array<double>")
        sums = parts.groupBy("row").agg(
            F.sum("tokens").alias("tokens"), *[F.sum(F.col("values")[d]).alias(f"v{d}") for d in range(dimensions)])
        got = sums.orderBy("row").collect()  # 4 x vocabulary rows, whatever the input
        if got:
            model.load(np.array([[r[f"v{d}"] / r["tokens"] for d in range(dimensions)] for r in got]))
    return model


def scored(docs: DataFrame, vocabulary: int = VOCABULARY, frequent: int = FREQUENT, dimensions: int = DIMENSIONS,
           epochs: int = EPOCHS, noise: int = NOISE, rate: float = RATE, batch_tokens: int = BATCH,
           seed: int = 3) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), scores in log10."""
    training = docs.where(~held_out())
    counts = materialize(word_counts(training), "word-counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = most_frequent(counts, frequent)
    end_count = (counts.where(F.col("word") == END).head() or (END, 0))[1]
    known = [*top[:vocabulary - 2], (END, end_count)]
    other_tokens = total - sum(c for _, c in known)
    other_types = types - len([c for _, c in known if c])
    c = np.array([n for _, n in known] + [other_tokens], float) + 1
    model = train(training, [w for w, _ in known], c / c.sum(), dimensions, epochs, noise, rate, batch_tokens, seed)
    zs = model.normalisers()

    words = [*(w for w, _ in top), END]
    n = np.array([*(x for _, x in top), end_count], float)
    base_log = np.log10((n + 1) / (total + types + 1))
    in_other = np.log10((n + 1) / (other_tokens + other_types + 1))
    model_id = np.full(len(words), len(known))
    model_id[:len(known) - 1] = np.arange(len(known) - 1)
    model_id[-1] = len(known) - 1
    end_id, other_id, is_known = len(known) - 1, len(known), n > 0

    def log_probability(ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        h = model.one.take(one, axis=0)
        h += model.two.take(two, axis=0)
        h *= model.out.take(ids, axis=0)
        return h.sum(axis=1) + model.bias[ids] - zs[one, two]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w.encode(): i for i, w in enumerate(words)}
        for whole in batches:
            for batch in (whole.slice(s, 256) for s in range(0, whole.num_rows, 256)):
                texts = [tokens(t) for t in batch["text"].to_pylist()]
                sizes = np.array([len(t) for t in texts])
                at = np.fromiter(map(index.get, chain.from_iterable(texts), repeat(-1)), np.int64, sizes.sum())
                first = np.cumsum(sizes) - sizes
                rare = at < 0
                ids = np.where(rare, other_id, model_id[at])
                one, two = shifted(ids, np.cumsum(sizes) - 1, end_id)
                s = np.concatenate([log_probability(*(x[k:k + BATCH] for x in (ids, one, two))) for k in range(0, len(ids), BATCH)])
                s = s / np.log(10) + np.where(~rare & (ids == other_id), in_other[at], 0)
                b = np.where(rare, 0, base_log[at])
                left = [list(Counter(w for w, r in zip(t, rare[f:f + len(t)].tolist(), strict=True) if r).items())
                        if rare[f:f + len(t)].any() else [] for t, f in zip(texts, first.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["held_out"], pa.array(sizes, pa.int64()),
                     pa.array(np.add.reduceat(~rare & is_known[at], first).astype(np.int64)),
                     pa.array(np.add.reduceat(b, first)), pa.array(np.add.reduceat(s, first)),
                     pa.array([[{"word": w.decode(), "n": k} for w, k in r] for r in left],
                              pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"])

    kind = dict(docs.dtypes)["doc_id"]
    part = materialize(
        docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
            score, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, model double, "
                   "rare array<struct<word: string, n: bigint>>")
        .withColumn("rid", F.monotonically_increasing_id()), "scored")
    looked_up = (
        part.select("rid", F.inline("rare")).join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
        .groupBy("rid").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(total + types + 1)))).alias("more_base"),
            F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(other_tokens + other_types + 1)))).alias("more_score"))
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0)))
    return part.drop("rare").join(looked_up, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", plus("known", "more_known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        plus("base", "more_base").alias("base_score"), plus("model", "more_score").alias("score"))
