"""Structured Streaming jobs: new files in, the same daily models out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketloom.functions import ingestion_date, ingestion_hour
from marketloom.jobs.increments import ACTIVITY
from marketloom.jobs.quotes import market_model
from marketloom.operators.partials import Mergeable, PartialStore
from marketloom.operators.upsert import upsert
from marketloom.plans import marts
from marketloom.sinks.bronze import json_ready
from marketloom.sources.landing import dataset_root

Staging = Callable[[DataFrame], DataFrame]


def read_landing(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
                 max_files: int = 10_000, **options: str) -> DataFrame:
    """Stream over the files of a landing folder, in bounded batches."""
    return (
        spark.readStream.schema(schema).format(fmt)
        .option("maxFilesPerTrigger", max_files).options(**options).load(path)
    )


def run_available(stream: DataFrame, checkpoint: str,
                  each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that has arrived, then stop.

    The checkpoint takes the place of stored marks: a batch's files are marked
    done only after ``each_batch`` returns, and a failed batch is repeated with
    the same number and the same files.
    """
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def stream_to_bronze(stream: DataFrame, root: str, source: str, dataset: str, checkpoint: str,
                     ingested_at: str = "ingested_at") -> str:
    """Land new rows as JSON by ingestion date, hour and batch.

    The batch is part of the layout: repeating one after a failure replaces its
    own files, so every row lands exactly once.
    """
    path = dataset_root(root, source, dataset)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        at = F.col(ingested_at).cast("timestamp")
        (
            json_ready(batch).withColumns({
                "ingestion_date": ingestion_date(at), "hour": ingestion_hour(at), "batch": F.lit(batch_id),
            })
            .hint("rebalance", "ingestion_date", "hour").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingestion_date", "hour", "batch").json(path)
        )

    run_available(stream, checkpoint, each_batch)
    return path


def stream_daily_market(spark: SparkSession, stream: DataFrame, root: str, stage: Staging,
                        tie_break: Column | str | None = None) -> DataFrame:
    """Keep the daily market table current from a stream of quotes.

    A batch is reduced to states per date and symbol, and the dates it touches
    are merged from the states of all batches and upserted: each quote is read
    once. Late quotes just touch an older date, and a batch repeated after a
    failure replaces its own states, so it cannot count anything twice.
    """
    return _stream_model(spark, stream, root, stage, market_model(tie_break), "daily_market", ["date", "symbol"])


def stream_user_activity(spark: SparkSession, stream: DataFrame, root: str, stage: Staging) -> DataFrame:
    """Keep the daily user activity mart current from a stream of user events.

    The states hold the counts of each user and date, so a user seen in many
    batches counts once a day.
    """
    model = Mergeable(ACTIVITY.partial, ACTIVITY.merge, lambda s: marts.user_activity_daily(ACTIVITY.finish(s)))
    return _stream_model(spark, stream, root, stage, model, "user_activity_daily", marts.GRAIN["user_activity_daily"])


def _stream_model(spark: SparkSession, stream: DataFrame, root: str, stage: Staging, model: Mergeable,
                  table: str, keys: list[str]) -> DataFrame:
    path = f"{root}/{table}"

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        store = PartialStore(batch.sparkSession, f"{root}/states", model)
        dates = store.add(stage(batch), batch_id)
        if dates:
            upsert(batch.sparkSession, path, store.current(dates), keys, unique=True)

    run_available(stream, f"{root}/checkpoint", each_batch)
    return spark.read.parquet(path)
