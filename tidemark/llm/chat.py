"""Minimum-cost role repair of conversations, and their rendering.

A legal conversation is an optional system turn followed by user and assistant turns by
turns, ending with the assistant. A repair keeps every text: it may relabel a turn,
merge it into the turn before, or insert empty turns, each at a cost, and dynamic
programming over the automaton of legal turns finds the cheapest repair.

The automaton has four states, so what a block of turns costs from any state to any other
is a small table. Long conversations are cut into blocks; their tables are combined,
which fixes the states between the blocks, and each block is then repaired by itself.
No task holds a whole conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import staged
from tidemark.llm.ngram_join import runs_of

# Turns of a conversation that are repaired in one go.
BLOCK = 512

ROLES = ["system", "user", "assistant"]
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4

MERGE, INSERT = 1, 2
# Cost of calling a turn something else; unknown roles cost the same for all.
RELABEL = {
    "system": {"system": 0, "user": 2, "assistant": 4},
    "user": {"system": 5, "user": 0, "assistant": 3},
    "assistant": {"system": 6, "user": 3, "assistant": 0},
    None: {"system": 3, "user": 1, "assistant": 1},
}
# Empty turns needed before a new turn of a role, by the state so far; absent: not legal.
BEFORE = {
    (START, SYSTEM): [],
    (START, USER): [],
    (START, ASSISTANT): ["user"],
    (SYSTEM, USER): [],
    (SYSTEM, ASSISTANT): ["user"],
    (USER, USER): ["assistant"],
    (USER, ASSISTANT): [],
    (ASSISTANT, USER): [],
    (ASSISTANT, ASSISTANT): ["user"],
}
# Empty turns needed at the end of a conversation.
AT_END = {SYSTEM: ["user", "assistant"], USER: ["assistant"], ASSISTANT: []}
FAR = 1 << 40


def _steps(role: str | None) -> list[list[tuple[int, int]]]:
    """For each pair of states the cheapest cost of a turn between them, and whether it merges."""
    table = [[(FAR, 0)] * STATES for _ in range(STATES)]
    for state in range(STATES):
        for after in (SYSTEM, USER, ASSISTANT):
            change = RELABEL[role][ROLES[after - 1]]
            ways = []
            if state == after:
                ways.append((change + MERGE, 1))
            if (state, after) in BEFORE:
                ways.append((change + INSERT * len(BEFORE[state, after]), 0))
            table[state][after] = min(ways, default=(FAR, 0))
    return table


STEPS = {role: _steps(role) for role in RELABEL}


def table_of(roles: list[str | None]) -> np.ndarray:
    """Cost of a block from each state to each other."""
    total = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for role in roles:
        step = np.array([[c for c, _ in row] for row in STEPS[role]])
        total = np.minimum((total[:, :, None] + step[None, :, :]).min(axis=1), FAR)
    return total


def end_costs() -> np.ndarray:
    return np.array([0] + [INSERT * len(AT_END[s]) for s in (SYSTEM, USER, ASSISTANT)])


def repair(roles: list[str | None], entry: int, leave: int | None) -> list[tuple[int, int, int]]:
    """State before, state after and merge mark of each turn on the cheapest path.

    From ``entry`` to ``leave``, or to the cheapest end if that is None. Of equally
    cheap paths, the one through the lowest states, seen from the end.
    """
    best, back = [FAR] * STATES, []
    best[entry] = 0
    for role in roles:
        now, came = [FAR] * STATES, [0] * STATES
        for after in range(STATES):
            for state in range(STATES):
                cost = best[state] + STEPS[role][state][after][0]
                if cost < now[after]:
                    now[after], came[after] = cost, state
        best = now
        back.append(came)
    if leave is None:
        leave = int(np.argmin(np.array(best) + end_costs()))
    path, state = [], leave
    for role, came in zip(reversed(roles), reversed(back), strict=True):
        path.append((came[state], state, STEPS[role][came[state]][state][1]))
        state = came[state]
    return path[::-1]


def _said(text: str) -> str:
    """A text must not contain what marks turns."""
    return text.replace("<|", "< |")


def _opened(role: str) -> str:
    return f"<|{role}|>\n"


END_OF_TURN = "<|end|>\n"


def render(text: str | None, before: int, after: int, merges: int, last: bool) -> str:
    """The part of the rendered conversation that one turn contributes."""
    said = _said(text or "")
    if merges:
        out = "\n" + said
    else:
        empties = "".join(_opened(r) + END_OF_TURN for r in BEFORE[before, after])
        out = (END_OF_TURN if before != START else "") + empties + _opened(ROLES[after - 1]) + said
    if last:
        out += END_OF_TURN + "".join(_opened(r) + END_OF_TURN for r in AT_END[after])
    return out


def _role(name: str | None) -> str | None:
    name = (name or "").strip().lower()
    name = ALIASES.get(name, name)
    return name if name in ROLES else None


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in runs_of(batches, ["conv", "block"]):
        roles = [_role(r) for r in table.column("role").to_pylist()]
        costs = [table_of(roles[a:b]).ravel().tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                table.column("conv").combine_chunks().take(pa.array(starts[:-1])),
                table.column("block").combine_chunks().take(pa.array(starts[:-1])),
                pa.array(costs, pa.list_(pa.int64())),
            ],
            ["conv", "block", "costs"],
        )


def _between(frame: pd.DataFrame) -> pd.DataFrame:
    """States before and after each block of one conversation."""
    frame = frame.sort_values("block")
    tables = [np.array(c).reshape(STATES, STATES) for c in frame["costs"]]
    rest = [end_costs()]
    for table in reversed(tables):
        rest.append(np.minimum((table + rest[-1][None, :]).min(axis=1), FAR))
    rest = rest[::-1]
    state, entries, leaves = START, [], []
    for table, after in zip(tables, rest[1:], strict=True):
        entries.append(state)
        state = int(np.argmin(table[state] + after))
        leaves.append(state)
    return pd.DataFrame({"conv": frame["conv"], "block": frame["block"], "entry": entries, "leave": leaves})


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in runs_of(batches, ["conv", "block"]):
        names = table.column("role").to_pylist()
        texts = table.column("text").to_pylist()
        roles = [_role(r) for r in names]
        entries, leaves = table.column("entry").to_pylist(), table.column("leave").to_pylist()
        lasts = table.column("last").to_pylist()
        new, actions, costs, inserts, parts = [], [], [], [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            path = repair(roles[a:b], entries[a], None if leaves[a] < 0 else leaves[a])
            for i, (before, after, merges) in enumerate(path, a):
                role = ROLES[after - 1]
                done = [w for w, on in (("relabel", role != roles[i]), ("merge", merges)) if on]
                added = len(AT_END[after]) if lasts[i] else 0
                new.append(role)
                actions.append("+".join(done) or "keep")
                costs.append(STEPS[roles[i]][before][after][0] + INSERT * added)
                inserts.append((0 if merges else len(BEFORE[before, after])) + added)
                parts.append(render(texts[i], before, after, merges, lasts[i]))
        yield pa.RecordBatch.from_arrays(
            [
                table.column("conv_id").combine_chunks(),
                table.column("turn").combine_chunks(),
                table.column("place").combine_chunks(),
                pa.array(names, pa.string()),
                pa.array(new, pa.string()),
                pa.array(actions, pa.string()),
                pa.array(inserts, pa.int32()),
                pa.array(costs, pa.int32()),
                pa.array(parts, pa.string()),
            ],
            ["conv_id", "turn", "place", "role", "new_role", "action", "inserted", "cost", "rendered"],
        )


def repair_roles(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, place, role, new_role, action, inserted, cost, rendered.

    Turns are taken in order of ``turn``, NULL first; ties, repeated rows among them, in
    order of role and text. ``place`` counts them from 0. The ``rendered`` parts of a
    conversation, one after another, are the whole rendered conversation; ``inserted``
    counts the empty turns in a part. A NULL or unknown role becomes whichever is
    cheapest, a NULL text is empty, rows with a NULL conv_id form one conversation, and
    an empty table gives no rows. Only conv_id, turn, role and text are read, so other columns
    may have any name. Texts are carried whole, however long, and very long conversations are cut.
    """
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(-(2**63)))
    order = ["turn", "role", "tie", "id"]
    # Ranges cut long conversations; written out, they are the same for all passes.
    ordered = staged(
        conversations.select(
            conv.alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
            F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("id"),
        )
        .repartitionByRange("conv", *order)
        .withColumn("piece", F.spark_partition_id()),
        "chat-pieces",
    )
    pieces = ordered.groupBy("conv", "piece").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col("conv").alias("c"),
        F.col("piece").alias("p"),
        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("conv")).alias("size"),
    )
    inside = Window.partitionBy("conv", "piece").orderBy(*order)
    placed = (
        ordered.withColumn("row", F.row_number().over(inside) - 1)
        .join(pieces, (F.col("conv") == F.col("c")) & (F.col("piece") == F.col("p")))
        .withColumn("place", F.col("start") + F.col("row"))
        .withColumn("block", F.floor(F.col("place") / BLOCK))
        .withColumn("last", F.col("place") == F.col("size") - 1)
        .drop("c", "p", "start", "row", "piece", "tie", "id")
    )
    blocks = (
        placed.filter(F.col("size") > BLOCK).select("conv", "block", "place", "role")
        .repartition("conv", "block").sortWithinPartitions("conv", "block", "place")
        .mapInArrow(_tables, "conv bigint, block bigint, costs array<bigint>")
        # One row for BLOCK turns.
        .groupBy("conv").applyInPandas(_between, "conv bigint, block bigint, entry int, leave int")
    )
    blocks = staged(blocks, "chat-blocks").select(
        F.col("conv").alias("c"), F.col("block").alias("b"), "entry", "leave"
    )
    return (
        placed.join(blocks, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b")), "left")
        .select(
            "conv", "block", "conv_id", "turn", "place", "role", "text", "last",
            F.coalesce("entry", F.lit(START)).alias("entry"), F.coalesce("leave", F.lit(-1)).alias("leave"),
        )
        .repartition("conv", "block").sortWithinPartitions("conv", "block", "place")
        .mapInArrow(
            _repaired,
            f"conv_id {dict(conversations.dtypes)['conv_id']}, turn bigint, place bigint, role string, "
            "new_role string, action string, inserted int, cost int, rendered string",
        )
    )
