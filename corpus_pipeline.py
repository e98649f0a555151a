"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, which is
written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import minhash, mixing, quality, queries, suffixes
from marketloom.llm.rows import numbered
from marketloom.llm.words import table
from marketloom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's fences.

    Each row is judged by itself, whatever its id: rows without one, or that
    share one, do not decide for each other.
    """
    rows = docs.withColumn("row", F.struct(*docs.columns))
    measured = materialize(quality.measured(rows, "row"), "quality-measures")
    return quality.judged(measured).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Rows count by themselves, with any ids or none: of equal rows one stays.
    A document without words stays, an empty table stays empty.
    """
    rows, _ = numbered(docs)
    texts = rows.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text"))
    copies = minhash.grouped_rows(texts, width=5, num=8, den=10).where("NOT kept").select(F.col("doc_id").alias("id"))
    return rows.join(copies, "id", "left_anti").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what they repeat of earlier ones; a text with nothing left goes.

    A cut through a character takes the whole character. ``n_chars`` counts
    what is left. Rows count by themselves, whatever their ids; a missing text
    stays as it is.
    """
    text = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(F.decode("kept", "UTF-8"))
    cut = suffixes.deduplicated(docs, whole_characters=True).withColumn("text", text)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.where("size(spans) = 0 OR octet_length(kept) > 0").select(
        *[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes their words.

    A document without words is in no mix; a missing source is one of its own.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences.

    A missing text is the end mark alone; rows that share an id are packed each.
    """
    return queries.packed(docs, queries.tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

# Near copies, passages and packing have no practical SQL form; tests compare
# the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
