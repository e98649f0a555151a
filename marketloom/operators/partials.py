"""Daily aggregates kept as mergeable states per date and batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.session import materialize
from marketloom.storage import NULL_PARTITION, children, delete

#: Batches of a date beyond which all but the newest are merged into one state.
COMPACT_AFTER = 32
_OPEN = -1  # the ``upto`` of a batch's own states


@dataclass(frozen=True)
class Mergeable:
    """An aggregate by date in three steps: rows to states, states to one, states to results."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


class PartialStore:
    """States at ``path/date=/upto=/batch=``.

    Each row is aggregated once, in its own batch. A batch that is delivered
    again replaces its own states, so nothing counts twice. Reading a date
    merges its batches; when there are many, all but the newest become one state
    under ``upto``, the last batch it stands for. Readers take the highest
    ``upto`` of a date and the batches after it, so a compaction that dies half
    way, before or after the states it stands for are removed, changes nothing.
    A batch may be repeated until a later one has been added to the same date.
    """

    def __init__(self, spark: SparkSession, path: str, model: Mergeable, compact_after: int = COMPACT_AFTER) -> None:
        self.spark, self.path, self.model, self.compact_after = spark, path.rstrip("/"), model, compact_after
        self.schema: StructType | None = None

    def add(self, rows: DataFrame, batch: int) -> list[date | None]:
        """Store a batch's states and return its dates, one per calendar day at most."""
        states = materialize(self.model.partial(rows), "states")
        self.schema = states.schema
        dates = [r[0] for r in states.select("date").distinct().collect()]
        for day in dates:
            if (taken := self._upto(day)) >= batch:
                raise ValueError(f"batch {batch} of {day} is already part of a merged state up to {taken}")
        self._write(states, _OPEN, batch)
        for day in dates:
            self._compact(day)
        return dates

    def read(self, dates: Sequence[date | None]) -> DataFrame | None:
        """The states of these dates, None where there are none; only their folders are listed."""
        paths = [p for day in dates for p in self._live(day)]
        if not paths:
            return None
        reader = self.spark.read.option("basePath", self.path)
        if self.schema is not None:
            reader = reader.schema(StructType(self.schema.fields))
        return reader.parquet(*paths).drop("upto", "batch")

    def current(self, dates: Sequence[date | None]) -> DataFrame | None:
        """The results of these dates over all batches so far."""
        states = self.read(dates)
        return None if states is None else self.model.finish(self.model.merge(states))

    def _write(self, states: DataFrame, upto: int, batch: int) -> None:
        (
            states.withColumns({"upto": F.lit(upto).cast("bigint"), "batch": F.lit(batch).cast("bigint")})
            .hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "upto", "batch").parquet(self.path)
        )

    def _folder(self, day: date | None) -> str:
        return f"{self.path}/date={NULL_PARTITION if day is None else day}"

    def _upto(self, day: date | None) -> int:
        return max((int(name.split("=")[1]) for name in children(self.spark, self._folder(day))), default=_OPEN)

    def _batches(self, day: date | None) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in children(self.spark, f"{self._folder(day)}/upto={_OPEN}"))

    def _live(self, day: date | None) -> list[str]:
        folder, upto = self._folder(day), self._upto(day)
        merged = [] if upto == _OPEN else [f"{folder}/upto={upto}/batch={upto}"]
        return merged + [f"{folder}/upto={_OPEN}/batch={b}" for b in self._batches(day) if b > upto]

    def _compact(self, day: date | None) -> None:
        """Merge all batches of a date but the newest, which may still be repeated."""
        before, batches = self._upto(day), self._batches(day)
        live = [b for b in batches if b > before]
        if len(live) > self.compact_after:
            upto = live[-2]
            paths = [p for p in self._live(day) if not p.endswith(f"/batch={live[-1]}")]
            reader = self.spark.read.option("basePath", self.path).schema(self.schema)
            self._write(materialize(self.model.merge(reader.parquet(*paths)), "merged-states"), upto, upto)
            before = upto
        for b in batches:
            if b <= before:
                delete(self.spark, f"{self._folder(day)}/upto={_OPEN}/batch={b}")
        for name in children(self.spark, self._folder(day)):
            if _OPEN < int(name.split("=")[1]) < before:
                delete(self.spark, f"{self._folder(day)}/{name}")
