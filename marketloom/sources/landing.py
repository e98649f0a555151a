"""Landing zone: raw JSON runs laid out by source, dataset, date and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom import schemas
from marketloom.functions import file_captured_at, file_stem
from marketloom.storage import entries, exists

API_SOURCE = "exchange"


class NoRunsError(FileNotFoundError):
    """No landing file exists for a dataset."""


def dataset_root(root: str, source: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/source={source}/dataset={dataset}"


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    """Files of a dataset with their run name and modification time.

    A listing only: the binary reader leaves contents unread when the content
    column is not selected.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "modificationTime")
    )
    return files.where(F.col("path").rlike(r"\.json(/[^/]*)?$")).withColumn("run", file_stem("path"))


def last_in_path_order(spark: SparkSession, path: str) -> str | None:
    """The last run below a folder, found from the highest names down.

    Dates and hours are folder names, so each level is listed once and only its
    highest branch that holds a run is entered, however long the history is.
    """
    below = entries(spark, path)
    for name, full, folder in sorted(below, key=lambda e: f"{e[0]}/" if e[2] else e[0], reverse=True):
        if not folder:
            if name.endswith(".json"):
                return full
        elif name.endswith(".json"):
            if any(not inner for _, _, inner in entries(spark, full)):
                return full
        elif (found := last_in_path_order(spark, full)) is not None:
            return found
    return None


def last_modified(spark: SparkSession, path: str) -> str | None:
    """The run modified last, which takes a listing of all of them."""
    newest = list_runs(spark, path).agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    folder = None if newest is None else newest.rsplit("/", 1)[0]
    return folder if folder is not None and folder.endswith(".json") else newest


def latest_run(spark: SparkSession, roots: Sequence[str], by: str = "path") -> str:
    """Path of the newest run: a ``.json`` file, or the folder Spark wrote it as.

    Newest is last in path order, or the last modified with ``by="modified"``.
    Of several roots the first holding any run decides.
    """
    newest = last_in_path_order if by == "path" else last_modified
    for root in roots:
        if exists(spark, root) and (found := newest(spark, root)) is not None:
            return found
    raise NoRunsError(f"no landing files below {list(roots)}")


def _read(spark: SparkSession, path: str, ddl: str | StructType) -> DataFrame:
    """JSON documents (one array or object per file, or JSON lines) with their file."""
    return (
        spark.read.schema(ddl).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path).withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_payload(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """Raw payload rows of one run or of all runs below ``path``.

    A pairs file is an array, giving one row per pair; a summaries file is one
    object, giving one row. ``run_id`` and ``captured_at`` come from the name;
    ``position`` keeps the order within a file.
    """
    ddl = {"pairs": schemas.PAIRS_PAYLOAD, "summaries": schemas.SUMMARIES_PAYLOAD}[dataset]
    stem = file_stem("source_file")
    return _read(spark, path, ddl).withColumns({
        "position": F.monotonically_increasing_id(),
        "run_id": F.regexp_extract(stem, r"([^_]+)$", 1),
        "captured_at": file_captured_at("source_file"),
    })


def read_latest(spark: SparkSession, dataset: str, roots: Sequence[str]) -> DataFrame:
    """Payload of the newest run only; one path is scanned, nothing is filtered."""
    return read_payload(spark, dataset, latest_run(spark, roots))


def read_runs(spark: SparkSession, root: str, source: str, dataset: str, ddl: str) -> DataFrame:
    """All runs of a tabular dataset written as JSON lines, with its partitions.

    ``ingestion_date`` and ``hour`` stay text, and filters on them prune folders.
    """
    full = StructType(
        schemas.struct(ddl).fields + schemas.struct("ingestion_date string, hour string").fields
    )
    return (
        spark.read.schema(full).json(dataset_root(root, source, dataset))
        .withColumn("run_id", file_stem("_metadata.file_path"))
    )


def read_snapshots(spark: SparkSession, root: str, dataset: str, ddl: str,
                   ingestion_date: str | None = None, hour: str | None = None) -> DataFrame:
    """Snapshot parquet of the lake, pruned to a date and hour if given."""
    fields = {f.name: f for f in schemas.struct(ddl)}
    for extra in ("ingestion_date", "hour"):
        fields.setdefault(extra, schemas.struct(f"{extra} string").fields[0])
    df = spark.read.schema(StructType(list(fields.values()))).parquet(
        f"{root.rstrip('/')}/dataset={dataset}")
    if ingestion_date is not None:
        df = df.where(F.col("ingestion_date") == ingestion_date)
    if hour is not None:
        df = df.where(F.col("hour") == hour)
    return df


def check_payload(dataset: str, df: DataFrame) -> None:
    """Shape check of a payload: pair objects with an id, summaries with tickers."""
    if dataset == "pairs":
        broken = df.where(F.col("id").isNull() & F.col("ticker_id").isNull())
        message = "Expected a list of pair objects"
    else:
        broken = df.where(F.col("tickers").isNull())
        message = "Expected an object with 'tickers'"
    if not broken.isEmpty() or df.isEmpty():
        raise ValueError(f"{dataset}: {message}")


def count_records(pairs: DataFrame, summaries: DataFrame) -> int:
    """Listed pairs plus tickers: the record count an API extraction reports."""
    tickers = summaries.agg(F.coalesce(F.sum(F.greatest(F.size("tickers"), F.lit(0))), F.lit(0))).first()[0]
    return pairs.count() + tickers
