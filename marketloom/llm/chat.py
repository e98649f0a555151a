"""Repair the roles of conversations at least cost, then render them.

A legal conversation is an optional system turn, then user and assistant turns
by turns, from a user's to an assistant's. A small automaton accepts these; a
dynamic program over it chooses for each turn whether to keep its role, to take
another one, to merge into the turn before, or to put an empty turn before it,
so that the total cost is least.

The cost of a stretch of turns is a matrix over (state before, state after),
and stretches combine by the min-plus product, which is associative. So a
conversation is cut into blocks of ``BLOCK`` turns, each block's matrix is made
in its own task, the matrices of a conversation are combined in order, and each
block then finds its own turns from its two end states. A conversation of any
length is spread over many tasks; what meets in one place is one small row per
block.

Edge cases: a missing role, or one that is not known, may become any role at
the cost of a relabel; a missing text is empty; turns are ordered by number,
missing ones first, then by role and text, so repeated rows stay as turns of
their own; a missing conversation id is a conversation of its own; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.words import prefix_sums
from marketloom.session import materialize

ROLES = ("system", "user", "assistant")
#: State: the role of the last turn; 3 is the start.
START = 3
#: Roles that may follow each state.
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
FINAL = 2
MERGE, RELABEL, INSERT = 2, 3, 4
BLOCK = 256
TEMPLATE = "<|{role}|>\n{text}\n"


def inserted(before: int, role: int) -> list[list[int]]:
    """Empty turns, at most two, that make ``role`` legal after ``before``."""
    found = [] if role not in NEXT[before] else [[]]
    for a in NEXT[before]:
        if role in NEXT[a]:
            found.append([a])
        found += [[a, b] for b in NEXT[a] if role in NEXT[b]]
    return found


#: (state before, role) -> the cheapest insertion, fewest turns first.
GAP = {(s, r): min(ways, key=lambda w: (len(w), w)) for s in NEXT for r in range(3) if (ways := inserted(s, r))}


def steps(given: int) -> list[tuple[int, int, int, str]]:
    """(cost, state before, state after, action) of one turn whose role is ``given`` (-1: unknown)."""
    out = []
    for before in NEXT:
        for role in range(3):
            label = 0 if role == given else RELABEL
            if (before, role) in GAP:
                gap = GAP[before, role]
                out.append((label + INSERT * len(gap), before, role, "keep" if not label else "relabel"))
            if before == role:
                out.append((label + MERGE, before, role, "merge"))
    return out


STEPS = {g: steps(g) for g in (-1, 0, 1, 2)}


def matrix(given: list[int]) -> np.ndarray:
    """Least cost from each state to each state over the turns of a block."""
    total = np.full((4, 4), np.inf)
    np.fill_diagonal(total, 0)
    for g in given:
        one = np.full((4, 4), np.inf)
        for cost, s, t, _ in STEPS[g]:
            one[s, t] = min(one[s, t], cost)
        total = (total[:, :, None] + one[None]).min(axis=1)
    return total


def best_path(given: list[int], first: int, last: int) -> list[tuple[int, int, str]]:
    """(state before, role, action) of each turn on a cheapest way from state to state."""
    cost, back = {first: 0}, []
    for g in given:
        then, choice = {}, {}
        for c, s, t, action in STEPS[g]:
            if s in cost and cost[s] + c < then.get(t, np.inf):
                then[t], choice[t] = cost[s] + c, (s, t, action)
        cost = then
        back.append(choice)
    out, state = [], last
    for choice in reversed(back):
        out.append(choice[state])
        state = choice[state][0]
    return out[::-1]


def closing(state: int) -> list[int]:
    """Empty turns that end a conversation legally after ``state``."""
    return {START: [], FINAL: [], 1: [2], 0: [1, 2]}[state]


def placed(conversations: DataFrame) -> DataFrame:
    """Add ``at``, the place of a turn in its conversation, and its block.

    Places come from two levels: turns are first bucketed by number, so no
    window holds more than the turns of one bucket.
    """
    keyed = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("_key"),
        "turn", F.col("role").alias("given"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.expr("turn div 256"), F.lit(-(1 << 60))).cast("bigint").alias("_bucket"))
    starts = prefix_sums(
        keyed.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n")), ["_key"], "_bucket", "_n", "_start"
    ).select("_key", "_bucket", "_start")
    order = Window.partitionBy("_key", "_bucket").orderBy("turn", "given", "text")
    numbered = keyed.withColumn("_i", F.row_number().over(order) - 1)
    return (
        numbered.join(starts, ["_key", "_bucket"])
        .withColumn("at", F.col("_start") + F.col("_i"))
        .select("conv_id", "_key", "turn", "given", "text", "at", F.expr(f"at div {BLOCK}").alias("block"))
    )


def _given(role: str | None) -> int:
    return ROLES.index(role) if role in ROLES else -1


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per turn of the repaired conversations.

    (conv_id, block, at, turn, given, role, action, text, is_end): ``is_end``
    marks the rows of the conversation's last block; ``action`` is keep,
    relabel, merge (into the turn before) or insert (an empty turn, with no
    turn number, at the place of the turn that follows it).
    """
    turns = materialize(placed(conversations), "turns")
    kind = dict(conversations.dtypes)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names = ["conv_id", "block", "at", "turn", "given", "role", "action", "text", "is_end"]
    types = [arrow[kind["conv_id"]], pa.int64(), pa.int64(), arrow[kind["turn"]], *[pa.string()] * 4, pa.bool_()]

    def blocks_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in columns), strict=True))
        for _, own in groupby(rows, key=lambda r: r[:2]):
            yield list(own)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in blocks_of(batches, ("_key", "block", "given")):
            cost = matrix([_given(r[2]) for r in own])
            yield pa.RecordBatch.from_pydict(
                {"_key": [own[0][0]], "block": [own[0][1]], "cost": [cost.ravel().tolist()]}, schema=pa.schema(
                        [("_key", pa.string()), ("block", pa.int64()), ("cost", pa.list_(pa.float64()))]))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("_key", "block", "cost")), strict=True))
        for key, own in groupby(rows, key=lambda r: r[0]):
            own = list(own)
            # Least cost to reach each state before each block, then back from the best end.
            costs = [np.where(np.arange(4) == START, 0.0, np.inf)]
            for _, _, cost in own:
                costs.append((costs[-1][:, None] + np.array(cost).reshape(4, 4)).min(axis=0))
            total = costs[-1] + np.array([INSERT * len(closing(s)) for s in range(4)])
            state = int(total.argmin())
            out = []
            for i in range(len(own) - 1, -1, -1):
                way = costs[i] + np.array(own[i][2]).reshape(4, 4)[:, state]
                before = int(way.argmin())
                out.append((key, own[i][1], before, state, i == len(own) - 1))
                state = before
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["_key", "block", "first", "last", "is_end"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("_key", "block", "conv_id", "at", "turn", "given", "text", "first", "last", "is_end")
        for own in blocks_of(batches, columns):
            out = []
            for r, (before, role, action) in zip(own, best_path([_given(r[5]) for r in own], own[0][7], own[0][8]), strict=True):
                if action != "merge":
                    out += [(r[2], r[1], r[3], None, None, ROLES[g], "insert", "", r[9]) for g in GAP[before, role]]
                out.append((r[2], r[1], r[3], r[4], r[5], ROLES[role], action, r[6], r[9]))
            if own[0][9]:
                out += [(own[-1][2], own[-1][1], own[-1][3] + 1, None, None, ROLES[g], "insert", "", True) for g in closing(own[0][8])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    costs = turns.select("_key", "block", "given", "at").repartition("_key", "block").sortWithinPartitions("_key", "block", "at")
    small = materialize(costs.mapInArrow(matrices, "_key string, block long, cost array<double>"), "block-costs")
    states = materialize(
        small.repartition("_key").sortWithinPartitions("_key", "block")
        .mapInArrow(ends, "_key string, block long, first int, last int, is_end boolean"), "block-ends")
    joined = turns.join(states, ["_key", "block"]).repartition("_key", "block").sortWithinPartitions("_key", "block", "at")
    return joined.mapInArrow(
        solve, f"conv_id {kind['conv_id']}, block long, at long, turn {kind['turn']}, given string, role string, "
               "action string, text string, is_end boolean")


def rendered(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, block, n_turns, rendered): the text of each block of turns, in order.

    A conversation of up to ``BLOCK`` turns is one row; concatenating the rows
    of a longer one by block gives the whole.
    """
    head, mid, end = template.replace("{role}", "\0").replace("{text}", "\0").split("\0")
    # A turn closes the one before it, so a block never needs to know the next.
    opened = F.concat(F.when((F.col("block") == 0) & F.col("is_first"), F.lit("")).otherwise(F.lit(end)),
                      F.lit(head), F.col("role"), F.lit(mid), F.col("text"))
    order = Window.partitionBy("conv_id", "block").orderBy("at", (F.col("action") != "insert"), F.col("role").desc())
    piece = F.when(F.col("action") == "merge", F.concat(F.lit("\n"), "text")).otherwise(opened)
    numbered = turns.withColumn("_i", F.row_number().over(order)).withColumn("is_first", F.col("_i") == 1)
    return numbered.groupBy("conv_id", "block").agg(
        F.count(F.when(F.col("action") != "merge", 1)).alias("n_turns"), F.max("is_end").alias("is_end"),
        F.sort_array(F.collect_list(F.struct("_i", piece.alias("p")))).alias("t"),
    ).select("conv_id", "block", "n_turns", F.concat(
        F.array_join(F.transform("t", lambda x: x["p"]), ""), F.when(F.col("is_end"), F.lit(end)).otherwise("")).alias("rendered"))
