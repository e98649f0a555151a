"""Quality rules whose thresholds come from the data.

Base rules are fixed. The rest compare a document with others of its language
and source: each metric is counted into the buckets of a mergeable quantile
sketch (log-linear buckets, relative error below 1/32), one sketch per
(language, source); sketches of groups with few documents are merged into their
language's, and a small language's into the one of all documents. A metric's
upper fence is its upper quartile plus ``REACH`` quartile ranges, and the
documents are filtered by a join with the fences.

Edge cases: a missing or blank text has no words and fails the base rules; a
missing language or source is a group of its own; equal rows get equal verdicts;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.words import SPACES, WORD

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PCT = 50
#: Metrics, in parts of ``SCALE``, with the least quartile range that counts.
SCALE = 10_000
METRICS = {"symbols": 100, "dup_lines": 1000, "repeats": 700, "word_length": 10_000}
REACH = 6
MIN_GROUP = 100


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found more than once.

    Windows are hashed; only a text with a repeated window is sorted. Sorting
    finds the positions of repeated windows, and the gaps between the sorted
    positions give the number of words covered.
    """

    def covered(positions: Column) -> Column:
        gap = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
        return F.aggregate(gap, F.lit(0), lambda a, b: a + b)

    def repeated(ordered: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(ordered, i + step)["h"] == x["h"], F.lit(False))
        hits = F.filter(ordered, lambda x, i: same(x, i, -1) | same(x, i, 1))
        return bind(F.sort_array(F.transform(hits, lambda x: x["i"])), covered)

    def windows(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(pairs), repeated))

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(hashes, windows))


def measures(text: str = "text") -> Column:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words as a struct of longs."""
    body = F.coalesce(F.col(text), F.lit(""))
    word_chars = F.length(body) - F.regexp_count(body, F.lit(f"[{SPACES}]"))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    line_counts = bind(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("own")))
    word_counts = bind(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)),
                       lambda w: F.struct(F.size(w).alias("words"), repeated_words(w).alias("repeats")))
    long = lambda c, name: c.cast("bigint").alias(name)
    return bind(F.struct(line_counts.alias("l"), word_counts.alias("w")), lambda x: F.struct(
        long(x["w"]["words"], "n_words"),
        long(word_chars, "word_chars"),
        long(F.regexp_count(body, F.lit(f"[{SYMBOLS}]")), "n_symbols"),
        long(x["l"]["all"], "n_lines"),
        long(x["l"]["all"] - x["l"]["own"], "n_dup_lines"),
        long(x["w"]["repeats"], "n_repeat_words"),
    ))


def measured(docs: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, lang, source, carried ..., measures ..., base_failed); texts are kept only where they are carried."""
    keys = ["doc_id", "lang", "source", *carried]
    return (
        docs.select(*keys, measures().alias("m")).select(*keys, "m.*")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")))
    )


def metric_values() -> dict[str, Column]:
    share = lambda a, b: F.expr(f"{a} * {SCALE} div greatest({b}, 1)")
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """Number of the sketch bucket: exact below 64, then 32 for each doubling."""
    top = F.length(F.bin(value)) - 1
    sub = F.floor(value / F.pow(F.lit(2.0), top - 5))
    return F.when(value < 64, value).otherwise(64 + (top - 6) * 32 + sub - 32).cast("bigint")


def bucket_value(b: Column) -> Column:
    """The smallest value of a bucket."""
    steps = F.floor((b - 64) / 32)
    return F.when(b < 64, b).otherwise(((b - 64) % 32 + 32) * F.pow(F.lit(2.0), steps + 1)).cast("bigint")


def sketches(measured_docs: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n) over documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), bucket(v).alias("bucket")) for k, v in metric_values().items()])
    return (
        measured_docs.where(~F.col("base_failed"))
        .select("lang", "source", F.inline(pairs))
        .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches over ``keys``: (keys, metric, total, low, high)."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    # A sketch has at most 64 + 32 * 58 buckets, so these windows are bounded.
    w = Window.partitionBy(*keys, "metric")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(upto))
    at = lambda quarters: F.min(F.when(4 * F.col("upto") >= quarters * F.col("total"), F.col("bucket")))
    return ranked.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"), bucket_value(at(1)).alias("low"), bucket_value(at(3)).alias("high"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, metric, fence) for each group that has a sketch."""
    fine = quartiles(sketch, ["lang", "source"])
    by_lang = quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("metric").alias("_metric"), *[F.col(c).alias(f"l_{c}") for c in ("total", "low", "high")])
    overall = quartiles(sketch, []).select(F.col("metric").alias("_m"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    joined = (
        fine.join(by_lang, (F.col("metric") == F.col("_metric")) & F.col("lang").eqNullSafe(F.col("_lang")))
        .join(overall, F.col("metric") == F.col("_m"))
    )
    level = lambda c: F.when(F.col("total") >= MIN_GROUP, F.col(c)).when(
        F.col("l_total") >= MIN_GROUP, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    least = F.create_map(*[F.lit(x) for kv in METRICS.items() for x in kv])
    spread = F.greatest(level("high") - level("low"), least[F.col("metric")])
    return joined.select("lang", "source", "metric", (level("high") + REACH * spread).alias("fence"))


def judged(measured_docs: DataFrame) -> DataFrame:
    """Add ``kept``: passes the base rules and lies within all fences of its group.

    ``measured_docs`` is read twice and should be a stored table.
    """
    limits = (
        fences(sketches(measured_docs)).groupBy("lang", "source")
        .agg(F.map_from_entries(F.collect_list(F.struct("metric", "fence"))).alias("fences"))
        .withColumnsRenamed({"lang": "_lang", "source": "_source"})
    )
    inside = F.lit(True)
    for name, value in metric_values().items():
        inside = inside & (value <= F.col("fences")[name])
    return (
        measured_docs.join(limits, F.col("lang").eqNullSafe(F.col("_lang"))
                           & F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
        .drop("_lang", "_source", "fences")
    )
