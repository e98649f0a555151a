"""Mix sources to target weights by drawing fixed-length blocks of words.

The words of each source form one stream, cut into blocks of ``block`` words
(the last one shorter). Each output shard draws how many of its slots go to
which source from a multinomial over the targets. The slots of a source are
numbered over all shards; a slot number is mapped through a pseudorandom
permutation of the source's block numbers, a new one each time the source has
been used up, and blocks are joined to slots by number. Everything hangs on
hashes of ids and numbers, so reruns and other partitionings agree.

Draws sum to a source's target only on average. The slots that a source draws
beyond its target go to the sources that fell short, and the last slot of a
source is cut, so the words taken equal the rounded target and no block is
used more often than its source is repeated (at most ``repeats`` times).

Edge cases: a missing or blank text has size 0 and takes nothing; a missing
source is a source of its own, ordered last; equal rows are placed one after
the other and counted each; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.words import SPACES, prefix_sums, word_count
from marketloom.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
ROUNDS = 24
CHUNK_ROWS = 512


@dataclass(frozen=True)
class Source:
    """Target and block numbers of one source."""

    name: str | None
    sid: int
    size: int
    target: float
    blocks: int
    slots: int
    last_words: int


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, repeats: float) -> list[float]:
    """Share ``share`` x all sizes by weight; none above ``repeats`` x its size."""
    total = share * sum(sizes)
    out: list[float | None] = [None] * len(sizes)
    while open_ := [i for i, t in enumerate(out) if t is None]:
        left = total - sum(t for t in out if t is not None)
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / whole > repeats * sizes[i]]
        for i in full or open_:
            out[i] = float(repeats * sizes[i]) if full else left * weights[i] / whole
    return [float(t) for t in out]


def plan_sources(sizes: list[tuple[str | None, int]], block: int, weights: Sequence[float] = WEIGHTS,
                 share: float = 1.5, repeats: int = 2) -> list[Source]:
    """Targets, and the slots that take exactly the rounded target.

    In each pass over a source its full blocks come first, in permuted order,
    and the short last block comes last, so the words of the first k slots are
    known without looking at them.
    """
    named = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    goal = targets([n for _, n in named], [weights[i % len(weights)] for i in range(len(named))], share, repeats)
    out = []
    for sid, ((name, size), target) in enumerate(zip(named, goal, strict=True)):
        blocks = -(-size // block)
        passes, rest = divmod(round(target), size) if size else (0, 0)
        slots, last = passes * blocks + -(-rest // block), 0
        if rest:
            last = rest - (-(-rest // block) - 1) * block
        elif passes:
            last = size - (blocks - 1) * block
        out.append(Source(name, sid, size, target, blocks, slots, last))
    return out


def source_sizes(sized: DataFrame) -> list[tuple[str | None, int]]:
    """Words per source. One row per source comes to the driver, no more."""
    return [(r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size").cast("bigint")).collect()]


def source_table(spark, sources: Sequence[Source]) -> DataFrame:
    """(source, sid, source_size, target, blocks), one row per source."""
    if not sources:
        return spark.range(0).selectExpr("string(null) source", "0 sid", "0L source_size", "0d target", "0L blocks")
    rows = [
        F.struct(F.lit(s.name).cast("string").alias("source"), F.lit(s.sid).alias("sid"),
                 F.lit(s.size).cast("bigint").alias("source_size"), F.lit(s.target).alias("target"),
                 F.lit(s.blocks).cast("bigint").alias("blocks"))
        for s in sources
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def with_size(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, tie) and, as ``row``, all columns of the documents."""
    return docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("tie"),
                       F.struct("*").alias("row"))


def place(sized: DataFrame, sources: Sequence[Source], rows: int) -> DataFrame:
    """Add the source's columns and ``position``: where a document starts in it.

    The order inside a source is by hashed chunks of about ``CHUNK_ROWS`` rows,
    so a source that holds most rows is still spread over many tasks. Rows
    without words have no position.
    """
    chunks = max(1, rows // CHUNK_ROWS)
    within = Window.partitionBy("sid", "_chunk").orderBy("doc_id", "size", "tie")
    known = sized.withColumnRenamed("source", "_source").join(
        source_table(sized.sparkSession, sources).withColumnRenamed("source", "_name"),
        F.col("_source").eqNullSafe(F.col("_name"))
    ).drop("_name").withColumnRenamed("_source", "source")
    chunked = known.withColumn("_chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    starts = prefix_sums(
        chunked.groupBy("sid", "_chunk").agg(F.sum("size").alias("_words")), ["sid"], "_chunk", "_words", "_start"
    ).drop("_words")
    before = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        chunked.withColumn("_before", before)
        .join(starts, ["sid", "_chunk"])
        .withColumn("position", F.when(F.col("size") > 0, F.col("_start") + F.col("_before")))
        .drop("_chunk", "_before", "_start")
    )


def permuted(x: Column, size: Column, *key: Column) -> Column:
    """A keyed permutation of 0 .. size-1 (swap-or-not, ``ROUNDS`` rounds).

    Each round pairs x with (k - x) mod size and swaps the two or not by a
    hash of the pair, which is a permutation for any size.
    """

    def step(at: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(*key, r, F.lit("pair")), size)
        other = F.pmod(k - at, size)
        swap = F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, step)


def draw_slots(spark, sources: Sequence[Source], block: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, sid, slot, block_no, words): what each shard takes, in slots."""
    slots = sum(s.slots for s in sources)
    ends, bounds = 0, []
    for s in sources:
        ends += s.slots
        bounds.append(ends)
    if not slots:
        return spark.range(0).selectExpr("0L shard", "0 sid", "0L slot", "0L pass", "0L block_no", "0L words")
    per_source = {
        name: F.array(*[F.lit(int(v)).cast("bigint") for v in values])
        for name, values in {
            "ends": bounds, "slots": [s.slots for s in sources], "blocks": [s.blocks for s in sources],
            "sizes": [s.size for s in sources], "last": [s.last_words for s in sources],
        }.items()
    }
    of = lambda name: F.get(per_source[name], F.col("sid"))
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(slots))
    drawn = (
        spark.range(slots).withColumn("_u", u)
        .select(
            F.expr(f"id div {shard_slots}").alias("shard"),
            F.size(F.filter(per_source["ends"], lambda e: e <= F.col("_u"))).alias("sid"),
        )
        .groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = prefix_sums(drawn, ["sid"], "shard", "n", "first")
    split = counted.withColumn("keep", F.least(F.col("n"), F.greatest(F.lit(0), of("slots") - F.col("first"))))
    kept = split.where("keep > 0").select("shard", "sid", "first", F.col("keep").alias("n"))
    # Slots drawn beyond a target, numbered over all shards, fill the open
    # targets in the order of the sources.
    totals = counted.groupBy("sid").agg(F.sum("n").alias("n")).collect()  # one row per source
    drawn_n = {r["sid"]: r["n"] for r in totals}
    gaps, at = [], 0
    for s in sources:
        missing = s.slots - drawn_n.get(s.sid, 0)
        if missing > 0:
            gaps.append((s.sid, at, at + missing, drawn_n.get(s.sid, 0)))
            at += missing
    if gaps:
        spare = split.where("n > keep").groupBy("shard").agg(F.sum(F.expr("n - keep")).alias("n"))
        spare = prefix_sums(spare.withColumn("_all", F.lit(0)), ["_all"], "shard", "n", "first")
        gap = F.explode(F.array(*[
            F.struct(F.lit(sid).alias("sid"), F.lit(a).cast("bigint").alias("a"),
                     F.lit(b).cast("bigint").alias("b"), F.lit(base).cast("bigint").alias("base"))
            for sid, a, b, base in gaps
        ]))
        low, high = F.greatest("first", "g.a"), F.least(F.expr("first + n"), F.col("g.b"))
        filled = spare.select("shard", "first", "n", gap.alias("g")).where(high > low).select(
            "shard", F.col("g.sid").alias("sid"), (F.col("g.base") + low - F.col("g.a")).alias("first"),
            (high - low).alias("n"))
        kept = kept.unionByName(filled)
    numbered = kept.select("shard", "sid", F.explode(F.sequence(F.col("first"), F.expr("first + n - 1"))).alias("slot"))
    return (
        numbered
        .withColumn("_pass", F.floor(F.col("slot") / of("blocks")))
        .withColumn("_i", F.col("slot") % of("blocks"))
        .withColumn("block_no", F.when(F.col("_i") == of("blocks") - 1, F.col("_i")).otherwise(
            permuted(F.col("_i"), of("blocks") - 1, F.lit(seed), F.col("sid"), F.col("_pass"))))
        .withColumn("words", F.when(F.col("slot") == of("slots") - 1, of("last"))
                    .when(F.col("_i") == of("blocks") - 1, of("sizes") - F.col("_i") * block)
                    .otherwise(F.lit(block)).cast("bigint"))
        .select("shard", "sid", "slot", F.col("_pass").alias("pass"), "block_no", "words")
    )


def mix(placed: DataFrame, sources: Sequence[Source], block: int = 1024, shard_slots: int = 256,
        seed: int = 7) -> DataFrame:
    """Spans of documents that the mix takes.

    One row per document part in a slot: (shard, slot, pass, sid, position,
    doc_id, word_from, word_to), words counted from 0 inside the document.
    """
    start, end = F.col("position"), F.col("position") + F.col("size")
    parts = placed.where("size > 0").select(
        "doc_id", "sid", "position", "size",
        F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))).alias("block_no"),
    )
    slots = draw_slots(placed.sparkSession, sources, block, shard_slots, seed)
    first = F.greatest(F.col("position"), F.col("block_no") * block)
    last = F.least(F.col("position") + F.col("size"), F.col("block_no") * block + F.col("words"))
    return (
        parts.join(slots, ["sid", "block_no"])
        .where(last > first)
        .select("shard", "slot", "pass", "sid", "position", "doc_id",
                (first - F.col("position")).alias("word_from"), (last - F.col("position")).alias("word_to"))
    )


def mixed_documents(docs: DataFrame, block: int = 1024, seed: int = 7, **plan) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: one row per document and pass.

    A text is cut to the words that the pass takes, with the white space that
    follows each; a document taken whole keeps its text as it is.
    """
    sized = with_size(docs)
    slim = materialize(sized.select("source", "size"), "mix-sizes")
    sources = plan_sources(source_sizes(slim), block, **plan)
    placed = place(sized, sources, slim.count())
    spans = (
        mix(placed.drop("row", "tie"), sources, block, seed=seed)
        .groupBy("sid", "position", "pass")
        .agg(F.sort_array(F.collect_list(F.struct("word_from", "word_to"))).alias("spans"),
             F.sum(F.expr("word_to - word_from")).alias("taken"))
    )
    text = F.col("row.text")
    # Each piece is a word and the white space after it; white space before
    # the first word is a piece of its own.
    pieces = F.split(text, f"(?<=[{SPACES}])(?=[^{SPACES}])")
    lead = F.when(text.rlike(f"^[{SPACES}]"), 1).otherwise(0)
    cut = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(
        F.col("pieces"), (s["word_from"] + 1 + F.col("lead")).cast("int"),
        (s["word_to"] - s["word_from"]).cast("int")))), "")
    whole = F.col("taken") == F.col("size")
    made = (
        placed.join(spans, ["sid", "position"])
        .withColumn("pieces", F.when(~whole, pieces)).withColumn("lead", lead)
        .withColumn("cut", F.when(whole, text).otherwise(cut))
    )
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("bigint")}
    return made.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
