"""Bronze writer: one JSON run per source, dataset and run id."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
    IntegerType, LongType, MapType, ShortType, StringType, StructType, TimestampNTZType,
    TimestampType, VariantType,
)

from marketloom.context import RunContext
from marketloom.functions import isoformat
from marketloom.sources.landing import API_SOURCE

_PLAIN = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType,
          StringType, VariantType)


def bronze_path(root: str, source: str | None, dataset: str, ctx: RunContext) -> str:
    """Deterministic run path; a re-run of the same run lands in the same place.

    Without a source the layout starts at the dataset. A root that already ends
    in the source's or dataset's own folder is not extended by it again.
    """
    levels = [] if source is None else [f"source={source}"]
    levels.append(f"dataset={dataset}")
    base = root.rstrip("/")
    for i in range(len(levels), 0, -1):
        prefix = "/".join(levels[:i])
        if base == prefix or base.endswith("/" + prefix):
            levels = levels[i:]
            break
    levels += [f"ingestion_date={ctx.ingestion_date}", f"hour={ctx.hour}",
               f"{dataset}_{ctx.run_id}.json"]
    return "/".join([base, *levels])


def _encode(c: Column, t: DataType, name: str) -> Column:
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return isoformat(c)
    if isinstance(t, DateType):
        return c.cast("string")
    if isinstance(t, DecimalType):
        return c.cast("double")
    if isinstance(t, _PLAIN):
        return c
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: _encode(x, t.elementType, name))
    if isinstance(t, MapType) and isinstance(t.keyType, StringType):
        return F.transform_values(c, lambda _, v: _encode(v, t.valueType, name))
    if isinstance(t, StructType):
        fields = [_encode(c[f.name], f.dataType, name).alias(f.name) for f in t]
        return F.when(c.isNotNull(), F.struct(*fields))
    raise TypeError(f"Column {name} of type {t.simpleString()} is not JSON serializable")


def json_ready(df: DataFrame) -> DataFrame:
    """Times to ISO text, decimals to numbers; other unknown types are an error."""
    return df.select(*[_encode(F.col(f.name), f.dataType, f.name).alias(f.name) for f in df.schema])


def write_bronze(df: DataFrame, root: str, dataset: str, ctx: RunContext,
                 source: str | None = API_SOURCE, max_records_per_file: int = 5_000_000,
                 compact: bool = False) -> str:
    """Write one run; the commit protocol makes it visible all at once.

    Rows go straight from the source's partitions to files. ``compact`` adds an
    exchange that evens out file sizes, for small slices of large sources.
    """
    path = bronze_path(root, source, dataset, ctx)
    rows = json_ready(df)
    if compact:
        rows = rows.hint("rebalance")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("ignoreNullFields", False).json(path)
    )
    return path


def write_many(datasets: Mapping[str, DataFrame], root: str, ctx: RunContext,
               source: str | None = API_SOURCE, threads: int = 4) -> dict[str, str]:
    """Write several datasets of one run as concurrent Spark jobs.

    Returns once all are written; if any fails the error surfaces.
    """
    if not datasets:
        return {}
    with ThreadPoolExecutor(max_workers=threads) as pool:
        jobs = {n: pool.submit(write_bronze, df, root, n, ctx, source) for n, df in datasets.items()}
        return {n: job.result() for n, job in jobs.items()}


def write_bronze_parquet(df: DataFrame, root: str, dataset: str, source: str) -> str:
    """Parquet Bronze for tabular sources, by ingestion date and hour of ``ingested_at``."""
    path = f"{root.rstrip('/')}/source={source}/dataset={dataset}"
    (
        df.withColumns({
            "ingestion_date": F.date_format("ingested_at", "yyyy-MM-dd"),
            "hour": F.date_format("ingested_at", "HH"),
        })
        .hint("rebalance", "ingestion_date", "hour").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date", "hour").parquet(path)
    )
    return path
