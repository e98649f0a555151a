"""One query per corpus operator, and the pipeline, over the test tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (
    bestfit,
    chat,
    embeddings,
    licenses,
    lm,
    minhash,
    mixing,
    packing,
    periodic,
    quality,
    sqltext,
    suffixes,
    urls,
    variants,
)
from marketloom.llm.words import WORD, table
from marketloom.session import materialize

TOKENIZER = "word_bpe_49k.json"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@query("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes, summed from its spans."""
    docs = table(spark, sf_dir, "documents")
    sized = materialize(mixing.with_size(docs).drop("row"), "mix-sized")
    sources = mixing.plan_sources(mixing.source_sizes(sized), block=1024)
    placed = mixing.place(sized, sources, sized.count())
    taken = (
        mixing.mix(placed, sources)
        .groupBy("sid", "position").agg(F.sum(F.expr("word_to - word_from")).alias("taken"))
    )
    return placed.join(taken, ["sid", "position"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "source")


@query("op4_quality_rules", sqltext.quality())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(quality.measured(table(spark, sf_dir, "documents")), "quality-measures")
    return quality.judged(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_embedding_near_dups")
def op10_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_url_filter", sqltext.urls())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    pieces = packing.cut(docs, tokenizer_path)
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


@query("op1_pack_sequences")
def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer())


@query("op9_minhash_near_dups")
def op9_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["to"] - s["from"])
    return suffixes.deduplicated(docs).select(
        "row.doc_id", (F.octet_length("kept") + removed).cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_lm_scores")
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


@query("op3_license_scan", sqltext.licenses())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below source/lang; one that is mostly a notice is its folder's licence file."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    notice = 3 * F.length(licenses.header(text)) >= F.length(text)
    name = F.when(notice & (text != ""), F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(
        F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                       F.expr("string(doc_id div 1000)"), name)
    files = docs.select(F.col("doc_id").alias("fid"), path.alias("path"), "text")
    return licenses.scanned(files).select(F.col("fid").alias("doc_id"), "path", "own", "cosine", "license", "origin")


@query("op7_chat_format")
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(chat.repaired(table(spark, sf_dir, "conversations")))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bestfit.cut(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return bestfit.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def with_typo(doc_id: str, word: str) -> str:
    """One occurrence in 31, by document and word, loses a letter."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    at = h % len(word)
    return word[:at] + word[at + 1:] if h % 31 == 0 else word


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.counted(table(spark, sf_dir, "documents"), change=with_typo))


def with_periods(docs: DataFrame) -> DataFrame:
    """One document in ten, by its id, goes on from some word with a stretch of its words over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n, g = F.greatest(F.size(words), F.lit(1)), F.expr("_h div 10")
    start = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - start) / (3 + g % 8)).cast("int")
    times = F.ceil((n - start) / period).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, start + 1, period), times)), F.lit(1), n - start)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), start), again), " ")
    return docs.withColumn("_h", h).select(
        "doc_id", F.when((F.col("_h") % 10 == 0) & (F.size(words) > 0), changed).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapsed(with_periods(table(spark, sf_dir, "documents")))
    best = F.aggregate(
        "runs", F.lit(None).cast(periodic.RUN),
        lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
