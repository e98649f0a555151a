"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from marketloom.storage import delete

# Runtime settings the plans in this package are written for. A value the
# caller has set explicitly always wins, except the time zone: every date in
# the data model is a UTC date.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the join's partitioning is reused
    # by a following aggregation; the extra exchange is added only on skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where every shuffled partition of a join's build side turns out to be this
    # small, join by hash without sorting either side; else sort-merge as before.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# Beyond this the map-output bookkeeping costs more than larger partitions do.
MAX_SHUFFLE_PARTITIONS = 50_000

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    explicit = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def _scanned_bytes(df: DataFrame) -> int:
    """Size of the files a plan reads; sources of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 62)


def fit_shuffle(spark: SparkSession, *inputs: DataFrame, target_mb: int = 128, growth: int = 3) -> int:
    """Raise the shuffle partition count to suit the inputs' size on storage.

    ``growth`` allows for compressed columnar files turning into larger shuffled
    rows. The count is only ever raised: too many partitions are merged again at
    run time, too few spill.
    """
    stored = sum(_scanned_bytes(df) for df in inputs)
    needed = min(MAX_SHUFFLE_PARTITIONS, -(-stored * growth // (target_mb << 20)))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return max(needed, current)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with the setting absent;
    on a cluster a missing setting is an error, since a machine-local path
    would be lost together with its executor.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="marketloom-")
    return _local_dirs[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts lineage in a way that survives the loss of any executor, and
    freezes values that depend on the partition layout.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_work(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder.

    Call it when no DataFrame built on materialized steps is needed any more.
    """
    delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
