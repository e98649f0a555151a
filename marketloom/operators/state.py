"""High-water marks: a few rows per source, kept as versioned snapshots."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import utc
from marketloom.storage import children, create_new, delete, exists

#: Older versions are deleted on commit.
KEPT_VERSIONS = 20
COMMIT_ATTEMPTS = 10


class ConcurrentCommitError(Exception):
    """Other writers were faster every time; nothing tells that the marks are in the newest version."""


class MarkStore:
    """All marks as one small parquet snapshot per commit.

    Committing writes a complete new snapshot in one job, so several marks
    change together or not at all; readers take the newest finished snapshot.
    The state has one row per namespace, a handful by nature.

    A version belongs to the writer that creates its claim file, which fails
    where the file exists (atomic on HDFS and on object stores with conditional
    writes). The writer claims first, then reads the state it builds on, and
    looks for later claims when it has finished: whoever claimed later either
    saw this version or makes the writer commit again on top. So no commit that
    returned is lost, and a claim whose writer died holds nobody up.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _numbers(self) -> list[int]:
        """All versions, claimed or finished."""
        return sorted(int(n.split("=")[1]) for n in children(self.spark, self.root) if n.startswith("version="))

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def _versions(self) -> list[int]:
        """Finished versions."""
        return [v for v in self._numbers() if exists(self.spark, f"{self._path(v)}/_SUCCESS")]

    def _claim(self) -> int:
        """A version number that no other writer has."""
        for _ in range(COMMIT_ATTEMPTS):
            version = max(self._numbers(), default=0) + 1
            if create_new(self.spark, f"{self._path(version)}/_claim"):
                return version
        raise ConcurrentCommitError(f"no version of {self.root} could be claimed in {COMMIT_ATTEMPTS} attempts")

    def table(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], schemas.struct(schemas.WATERMARK))
        return self.spark.read.schema(schemas.WATERMARK).parquet(self._path(versions[-1]))

    def all(self) -> dict[str, datetime]:
        return {
            r.namespace: datetime.fromtimestamp(r.us // 1_000_000, timezone.utc).replace(microsecond=r.us % 1_000_000)
            for r in self.table().select("namespace", F.unix_micros("last_watermark").alias("us")).collect()
        }

    def get(self, namespace: str) -> datetime | None:
        return self.all().get(namespace)

    def commit(self, marks: Mapping[str, datetime], source: str | Mapping[str, str]) -> None:
        """Insert or update several marks at once; ``source`` is theirs, or one for each."""
        if not marks:
            return
        now = datetime.now(timezone.utc)
        of = source if isinstance(source, Mapping) else dict.fromkeys(marks, source)
        rows = self.spark.createDataFrame(
            [(n, of[n], utc(m), now) for n, m in sorted(marks.items())],
            schemas.struct(schemas.WATERMARK),
        )
        for _ in range(COMMIT_ATTEMPTS):
            version = self._claim()
            kept = self.table().where(~F.col("namespace").isin(list(marks)))
            # The folder is there already, with the claim alone in it.
            kept.unionByName(rows).coalesce(1).write.mode("append").parquet(self._path(version))
            if self._numbers()[-1] == version:
                break
        else:
            raise ConcurrentCommitError(f"marks of {self.root} were overtaken {COMMIT_ATTEMPTS} times")
        finished = self._versions()
        for old in [v for v in self._numbers() if v < finished[-KEPT_VERSIONS:][0]]:
            delete(self.spark, self._path(old))

    def update(self, namespace: str, source: str, mark: datetime) -> None:
        self.commit({namespace: mark}, source)
