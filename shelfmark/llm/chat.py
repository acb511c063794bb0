"""Chat formatting by minimum-cost role repair.

A legal conversation is ``[system] (user assistant)* [user]``.  Dynamic programming over an automaton of its turns finds the
cheapest repair: a turn may be merged into the one before it, take another role, or follow inserted empty messages.
The costs of a stretch of turns form a small matrix under (min, +), so very long conversations are cut into chunks
that are solved side by side and joined by their matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise, texts_of

ROLES = ("system", "user", "assistant")
# States: nothing yet, and the role of the last message.
START, SYSTEM, USER, ASSISTANT = range(4)
# After which state a message of the role may follow without insertions.
_LEGAL = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0


def _inserted(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty messages that lead from ``state`` to a place where ``role`` may follow."""
    if state in _LEGAL[role]:
        return ()
    if role == USER:
        return (ASSISTANT,)  # after a user's message
    if role == ASSISTANT:
        return (USER,)  # at the start, after the system's or the assistant's message
    return None  # the system speaks first or not at all


@lru_cache(maxsize=64)
def _moves(role: int, costs: Costs) -> tuple[tuple[int, int, float, tuple[int, ...], bool], ...]:
    """``(from, to, cost, inserted, merged)`` for a turn whose given role is ``role``; 0 is an unknown one."""
    out = []
    for state in range(4):
        if state != START:
            out.append((state, state, costs.merge + (costs.relabel if role != state else 0.0), (), True))
        for to in (SYSTEM, USER, ASSISTANT):
            between = _inserted(state, to)
            if between is not None:
                out.append((state, to, len(between) * costs.insert + (costs.relabel if role != to else 0.0), between, False))
    return tuple(out)


def step_matrix(role: int, costs: Costs) -> np.ndarray:
    out = np.full((4, 4), np.inf)
    for a, b, cost, _, _ in _moves(role, costs):
        out[a, b] = min(out[a, b], cost)
    return out


def solve(roles: list[int], first: int, last: int | None, costs: Costs) -> tuple[float, list[tuple[int, tuple[int, ...], bool]]]:
    """Cheapest path from state ``first`` to ``last`` (any, if None): per turn ``(role, inserted, merged)``.

    Ties go to the smaller state, then to a plain turn, an insertion, a merge, in this order.
    """
    best, back = np.full(4, np.inf), []
    best[first] = 0.0
    for role in roles:
        new, how = np.full(4, np.inf), [None] * 4
        for a, b, cost, between, merged in sorted(_moves(role, costs), key=lambda m: (m[4], len(m[3]), m[0])):
            if best[a] + cost < new[b]:
                new[b], how[b] = best[a] + cost, (a, between, merged)
        best = new
        back.append(how)
    state = int(np.argmin(best)) if last is None else last
    total, out = float(best[state]), []
    for how in reversed(back):
        a, between, merged = how[state]
        out.append((state, between, merged))
        state = a
    return total, out[::-1]


def repair(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per turn and per inserted message.

    The columns are ``conv_id, turn, chunk, seq, role, given_role, inserted, merged, segment``.  Sorted by ``(chunk,
    seq)`` the segments of a conversation, put together, are its rendered text: a merged turn goes on with its
    message, every other one closes the message before it and opens its own.

    Turns are ordered by ``turn`` (null last), role and text.  Unknown and null roles may take any role at the price
    of a relabel; null texts are empty.  Repeated rows are turns of their own, and null conversation ids form one
    conversation.  An empty table gives no rows.  No conversation is ever gathered in one task: chunks are the pieces
    that a sorted partition holds.
    """
    turns = conversations.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), F.lower(F.trim("role")).alias("given_role"), F.coalesce("text", F.lit("")).alias("body")
    )
    code = F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("given_role")), F.lit(0)).cast("int")
    turns = turns.withColumn("code", code).withColumn("late", F.col("turn").isNull()).withColumn("draw", F.rand(11))
    keys = ["conv", "late", "turn", "given_role", "body", "draw"]
    ordered = turns.repartitionByRange(*keys).sortWithinPartitions(*keys)
    chunks = materialise(ordered.withColumn("chunk", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).withColumn("turn", F.col("turn").cast("string")).drop("draw", "late"), "chat-chunks")

    steps = {role: step_matrix(role, costs) for role in range(4)}

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for (conv, chunk), part in rows.groupby(["conv", "chunk"], dropna=False, sort=False):
                total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
                for role in part.sort_values("at")["code"]:
                    total = (total[:, :, None] + steps[role][None]).min(axis=1)
                out.append((conv, chunk, int(part["at"].min()), total.ravel()))
            yield pd.DataFrame({"conv": texts_of(x[0] for x in out), "chunk": [x[1] for x in out], "low": [x[2] for x in out], "costs": [x[3] for x in out]})

    # A batch may hold part of a chunk: its matrices are multiplied in order of the first turn.
    spread = chunks.select("conv", "chunk").distinct().groupBy("conv").agg(F.count("*").alias("pieces"))
    cut = materialise(spread.where("pieces > 1").select(F.col("conv").alias("cut_conv")), "cut-conversations")
    parts = chunks.join(cut, F.col("conv").eqNullSafe(F.col("cut_conv"))).select("conv", "chunk", "at", "code")
    parts = materialise(parts.repartitionByRange("conv", "chunk", "at").sortWithinPartitions("conv", "chunk", "at").mapInPandas(matrices, "conv string, chunk int, low long, costs array<double>"), "chat-matrices")

    def ends(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Entry and exit state of every chunk of one long conversation; a row per chunk and batch."""
        rows = rows.sort_values(["chunk", "low"])
        totals = {}
        for chunk, costs_ in zip(rows["chunk"], rows["costs"]):
            one = np.asarray(costs_, float).reshape(4, 4)
            totals[chunk] = one if chunk not in totals else (totals[chunk][:, :, None] + one[None]).min(axis=1)
        best, back = np.array([0.0, np.inf, np.inf, np.inf]), []
        for chunk in totals:
            all_costs = best[:, None] + totals[chunk]
            back.append(all_costs.argmin(axis=0))
            best = all_costs.min(axis=0)
        state, out = int(best.argmin()), []
        for chunk, how in zip(reversed(list(totals)), reversed(back)):
            out.append((chunk, int(how[state]), state))
            state = int(how[state])
        return pd.DataFrame({"conv": texts_of([rows["conv"].iloc[0]] * len(out)), "chunk": [x[0] for x in out], "entry": [x[1] for x in out], "exit": [x[2] for x in out]})

    states = parts.groupBy("conv").applyInPandas(ends, "conv string, chunk int, entry int, exit int")
    states = materialise(states, "chat-states").withColumnsRenamed({"conv": "s_conv", "chunk": "s_chunk"})
    fits = F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("chunk") == F.col("s_chunk"))
    known = chunks.join(states, fits, "left").select("conv", "turn", "given_role", "body", "code", "chunk", "at", F.coalesce("entry", F.lit(START)).alias("entry"), F.coalesce("exit", F.lit(-1)).alias("exit"))

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        entry, last = int(rows["entry"].iloc[0]), int(rows["exit"].iloc[0])
        _, path = solve(rows["code"].tolist(), entry, None if last < 0 else last, costs)
        out, before = [], entry
        for (role, between, merged), turn, given, body, at in zip(path, rows["turn"], rows["given_role"], rows["body"], rows["at"]):
            for empty in between:
                out.append((turn, at, len(out), ROLES[empty - 1], None, True, False, _close(before) + _open(empty)))
                before = empty
            text = "\n" + body if merged else _close(before) + _open(role) + body
            out.append((turn, at, len(out), ROLES[role - 1], given, False, merged, text))
            before = role
        frame = pd.DataFrame(out, columns=["turn", "at", "seq", "role", "given_role", "inserted", "merged", "segment"])
        frame["conv"], frame["chunk"] = texts_of([rows["conv"].iloc[0]] * len(out)), int(rows["chunk"].iloc[0])
        for name in ("turn", "role", "given_role", "segment"):
            frame[name] = texts_of(frame[name])
        return frame

    kind = "turn string, at long, seq int, role string, given_role string, inserted boolean, merged boolean, segment string, conv string, chunk int"
    repaired = known.groupBy("conv", "chunk").applyInPandas(write, kind)
    return repaired.select(F.col("conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "chunk", "seq", "role", "given_role", "inserted", "merged", "segment")


def _open(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


def _close(state: int) -> str:
    return "" if state == START else "\n<|end|>\n"
