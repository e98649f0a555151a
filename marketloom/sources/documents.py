"""Document collections: envelope scan, incremental slice, envelope checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import utc

COLLECTIONS = ("tickers", "orderbooks", "user_events")
DOCUMENT_SOURCE = "mongodb"

# Fields each document must carry to be extracted, the fields the
# collections' own validators ask for, and the form of their timestamps.
ENVELOPE = ("_id", "event", "context", "ingested_at")
VALIDATED = {
    "tickers": ("event", "context", "ingested_at"),
    "orderbooks": ("event", "context", "ingested_at"),
    "user_events": ("event_type", "context", "ingested_at"),
}
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


class EnvelopeError(ValueError):
    """A batch holds documents without a required field."""


def namespace(collection: str) -> str:
    return f"{DOCUMENT_SOURCE}.{collection}"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines to the envelope; ``context`` is kept as its JSON text.

    Exported object ids (``{"$oid": ...}``) become their text.
    """
    df = spark.read.schema(schemas.DOCUMENT).json(path)
    return df.withColumn("_id", F.coalesce(F.get_json_object("_id", "$['$oid']"), F.col("_id")))


def tabular(df: DataFrame) -> DataFrame:
    """The four declared columns; a missing context is an empty object."""
    return df.select("_id", "event", F.coalesce("context", F.lit("{}")).alias("context"), "ingested_at")


def newer_documents(df: DataFrame, mark: datetime | str | None, strict: bool = True) -> DataFrame:
    """Documents ingested after the mark, compared as instants.

    Ingestion time is used, not event time, so late events are not lost. Texts
    may carry fractions and any offset. A text that is no time is let through,
    for the envelope check to report.
    """
    if mark is None:
        return df
    at = F.col("ingested_at").try_cast("timestamp")
    since = F.lit(mark).cast("timestamp") if isinstance(mark, str) else F.lit(utc(mark))
    newer = at > since if strict else at >= since
    return df.where(newer | (at.isNull() & F.col("ingested_at").isNotNull()))


def max_ingested(df: DataFrame) -> datetime | None:
    return df.agg(F.max(F.col("ingested_at").cast("timestamp"))).first()[0]


def missing_fields(required: tuple[str, ...]) -> Column:
    """Names of the required fields a document lacks."""
    return F.filter(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required]), lambda f: f.isNotNull()
    )


def envelope_violations(df: DataFrame, required: tuple[str, ...] = ENVELOPE) -> DataFrame:
    return df.select("_id", missing_fields(required).alias("missing")).where(F.size("missing") > 0)


def require_envelope(df: DataFrame) -> None:
    """Fail the batch if any document lacks an envelope field."""
    bad = envelope_violations(df).select(F.array_sort("missing").alias("m")).limit(1).collect()
    if bad:
        raise EnvelopeError(f"Document missing required fields: {set(bad[0].m)}")


def enforce_envelope(df: DataFrame) -> DataFrame:
    """Same rows, but reading a broken document fails the job that does it.

    The check rides on the write instead of needing a pass of its own.
    """
    missing = missing_fields(ENVELOPE)
    message = F.concat(F.lit("Document missing required fields: "), F.array_join(missing, ", "))
    return df.withColumn(
        "_id", F.when(F.size(missing) == 0, F.col("_id")).otherwise(F.raise_error(message).cast("string"))
    )


@dataclass(frozen=True)
class DocumentRule:
    name: str
    broken: Column


def document_rules(collection: str) -> list[DocumentRule]:
    """A collection's validator: required fields, object context, ISO timestamp."""
    rules = [DocumentRule(f"{f} is required", F.col(f).isNull()) for f in VALIDATED[collection]]
    rules.append(DocumentRule(
        "context must be an object",
        F.col("context").isNotNull() & ~F.ltrim("context").startswith("{"),
    ))
    rules.append(DocumentRule(
        "ingested_at must be ISO-8601",
        F.col("ingested_at").isNotNull() & ~F.col("ingested_at").rlike(ISO_PATTERN),
    ))
    return rules


def document_warnings(df: DataFrame, collection: str) -> DataFrame:
    """One row per document and broken rule. Warn-only: nothing is dropped."""
    broken = F.filter(
        F.array(*[F.when(r.broken, F.lit(r.name)) for r in document_rules(collection)]),
        lambda r: r.isNotNull(),
    )
    return df.select(
        F.lit(collection).alias("collection"), F.col("_id").alias("event_id"),
        F.explode(broken).alias("warning"),
    )
