"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label become one class. In each pass the classes of a label
are ordered lexicographically by the signs of 64 random projections; each is
compared with the ``window`` classes that follow it, and pairs at or above the
cosine are linked. The pairs of all passes are united. The number of passes
follows from the size of the largest label, so that a pair at the threshold is
missed with at most the probability ``miss``.

The order is cut into blocks of ``block`` rows; a block also gets the first
``window`` rows of the next one. Where links still turn up in the far half of a
window, the block is compared with whole blocks further on until none are
found, so a group of near copies larger than the window loses no pair.

Edge cases: a vector links with nothing if it, its id or its label is null, if
it has a null or non-finite component, or if it is zero; vectors of different
length never link; equal rows are vectors of their own; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import components
from marketloom.operators.ranking import with_row_index
from marketloom.session import materialize

COSINE = 0.93
BITS = 64
PAIRS = "block long, a long, b long, n_a long, n_b long, far boolean"


def passes_needed(rows: int, window: int, cosine: float, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``.

    Two vectors agree in a projection's sign with probability 1 - angle/pi, and
    lie within a window of each other if they agree in the first
    log2(rows/window) + 1 signs.
    """
    agree = 1 - math.acos(cosine) / math.pi
    bits = max(0.0, math.log2(max(rows, 1) / window)) + 1
    return max(2, math.ceil(math.log(miss) / math.log(1 - agree**bits)))


def cleaned(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec, usable): whether the vector can link at all."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    there = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    return vectors.select("vec_id", "label", vec.alias("vec")).withColumn(
        "usable", F.coalesce(there & ~bad & F.exists("vec", lambda x: x != 0), F.lit(False)))


def sign_keys(unit: np.ndarray, seed: int, number: int) -> np.ndarray:
    """The signs of the pass's projections, as one signed 64-bit sort key."""
    directions = np.random.default_rng([seed, number, unit.shape[1]]).standard_normal((unit.shape[1], BITS))
    bits = np.packbits(unit @ directions >= 0, axis=1)
    return bits.view(">u8").ravel().astype(np.uint64).view(np.int64)


def keyed(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """One row per class and pass with the pass's sort key."""

    def add_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch["vec"].offsets.to_numpy())
            values = batch["vec"].flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(size)])
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = values[starts[rows][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                part = batch.take(pa.array(rows)).select(["rep", "n", "label"])
                data = pa.array([v.tobytes() for v in x], pa.binary())
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), p, np.int32)), *part.columns,
                         pa.array(np.full(len(rows), dim, np.int32)), pa.array(sign_keys(x, seed, p)), data],
                        names=["pass", "rep", "n", "label", "dim", "key", "unit"])

    label = dict(classes.dtypes)["label"]
    return classes.select("rep", "n", "label", "vec").mapInArrow(
        add_keys, f"pass int, rep long, n long, label {label}, dim int, key long, unit binary")


def linked(left: pd.DataFrame, right: pd.DataFrame, block: int, window: int | None, cosine: float) -> pd.DataFrame:
    """Pairs at or above the cosine, of rows of one pass, label and length.

    With a window, ``right`` continues ``left`` in order and a row meets the
    ``window`` rows after it; without one, all of ``left`` meet all of ``right``.
    """
    found = []
    for group, mine in left.groupby(["pass", "label", "dim"], sort=False):
        theirs = right[(right["pass"] == group[0]) & (right["label"] == group[1]) & (right["dim"] == group[2])]
        if not len(theirs):
            continue
        x, y = (np.frombuffer(b"".join(t["unit"]), np.float64).reshape(-1, group[2]) for t in (mine, theirs))
        at, to = mine["idx"].to_numpy(), theirs["idx"].to_numpy()
        for s in range(0, len(x), 256):
            hit = x[s:s + 256] @ y.T >= cosine
            gap = to[None, :] - at[s:s + 256, None]
            if window is not None:
                hit &= (gap > 0) & (gap <= window)
            i, j = np.nonzero(hit)
            far = gap[i, j] * 2 > window if window is not None else np.ones(len(i), bool)
            i += s
            one, two = mine.iloc[i], theirs.iloc[j]
            a, b = one["rep"].to_numpy(), two["rep"].to_numpy()
            n_a, n_b = one["n"].to_numpy(), two["n"].to_numpy()
            low = a < b
            found.append(pd.DataFrame({
                "block": block, "a": np.where(low, a, b), "b": np.where(low, b, a),
                "n_a": np.where(low, n_a, n_b), "n_b": np.where(low, n_b, n_a), "far": far}))
    if not found:
        return pd.DataFrame({"block": [], "a": [], "b": [], "n_a": [], "n_b": [], "far": []}).astype(
            {"block": "int64", "a": "int64", "b": "int64", "n_a": "int64", "n_b": "int64", "far": "bool"})
    return pd.concat(found)


def _whole_blocks(block: int, cosine: float, apart: int):
    """Compare a block with the one ``apart`` blocks on; at 0 with itself, beyond the window."""

    def against(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["block"].iloc[0])
        mine = rows["idx"] // block == number
        pairs = linked(rows[mine], rows[~mine] if apart else rows, number, None, cosine)
        return pairs[pairs["a"] != pairs["b"]]

    return against


def near_pairs(ordered: DataFrame, block: int, window: int, cosine: float) -> list[DataFrame]:
    """Stored tables of linked pairs; the first from windows, the rest from wider runs.

    ``ordered`` is the stored table of all passes in order with its row number.
    """
    own = ordered.withColumn("block", F.expr(f"idx div {block}"))
    halo = own.where((F.col("idx") % block < window) & (F.col("block") > 0)).withColumn("block", F.col("block") - 1)

    def windows(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        number = int(rows["block"].iloc[0])
        return linked(rows[rows["idx"] // block == number], rows, number, window, cosine)

    found = [materialize(own.unionByName(halo).groupBy("block").applyInPandas(windows, PAIRS), "near-pairs")]
    apart = 0
    while (wide := found[-1].where("far").select("block").distinct()).head(1):
        pair = own.join(wide, "block")
        if apart:
            later = wide.select((F.col("block") + apart).alias("block"), F.col("block").alias("_first"))
            pair = pair.unionByName(own.join(later, "block").drop("block").withColumnRenamed("_first", "block"))
        found.append(materialize(pair.groupBy("block").applyInPandas(_whole_blocks(block, cosine, apart), PAIRS), "near-pairs"))
        apart += 1
    return found


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, window: int = 512, block: int = 1024,
                    miss: float = 1e-4, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label)."""
    rows = materialize(cleaned(vectors), "vectors")
    usable_rows = rows.where("usable")
    classes = materialize(
        usable_rows.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    passes = passes_needed(largest, window, cosine, miss)
    ordered = with_row_index(keyed(classes, passes, seed), ["pass", "label", "dim", "key", "rep"], "idx", start=0)
    tables = near_pairs(materialize(ordered, "ordered"), block, window, cosine)
    united = tables[0]
    for more in tables[1:]:
        united = united.union(more)
    pairs = materialize(united.select("a", "b", "n_a", "n_b").distinct(), "links")
    degrees = (
        pairs.select(F.col("a").alias("rep"), F.col("n_b").alias("more"))
        .union(pairs.select("b", "n_a")).groupBy("rep").agg(F.sum("more").alias("more"))
    )
    of_class = (
        classes.join(degrees, "rep", "left")
        .join(components(pairs).withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "vec", (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component_id", "rep").alias("component_id"))
    )
    found = usable_rows.join(of_class, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    others = rows.where("NOT usable").select("vec_id", F.lit(0).cast("bigint"), "vec_id")
    return found.union(others).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)).alias("kept"))
