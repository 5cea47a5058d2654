"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn and then user and assistant turns in alternation, starting with the
user. A source turn keeps its role, gets another one, or is merged into the turn before it; empty turns may be inserted
before it. The cheapest repair is a shortest path through the automaton, found by dynamic programming. One turn is a
matrix of costs between states, and the min-plus product of matrices is associative, so a conversation may be spread
over many partitions: each one multiplies its own turns, the few conversations that cross a border between partitions
are joined from one small matrix per partition, and each partition then walks back through its own turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import cut, mapped, width

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, INSERT = 1, 2, 3
_NEVER = 1 << 30
#: States: before the first turn, and after a turn of each role.
START, SYSTEM, USER, ASSISTANT = range(4)
_LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of ending in a state; a conversation of system turns only gets an empty user turn.
_END = np.array([0, INSERT, 0, 0])


def _steps(role: int | None) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """All ways (from, to, cost, action, roles of inserted turns) of a source turn with this role (1 to 3 or None)."""
    found = []
    for state in range(4):
        paths = [((), state)]
        for _ in range(2):
            paths += [(p + (n,), n) for p, s in paths[-3:] for n in _LEGAL[s] if len(p) < 2]
        for path, at in dict.fromkeys(paths):
            for to in range(1, 4):
                relabel = 0 if role == to else 1 if role is None else RELABEL
                if to in _LEGAL[at]:
                    found.append((state, to, len(path) * INSERT + relabel, "keep" if role == to else "relabel", path))
                if to == at and not path:
                    found.append((state, to, MERGE + relabel, "merge" if role == to else "relabel+merge", path))
    # ties: fewer insertions, then merging before relabelling, then the order of states
    order = {"keep": 0, "merge": 1, "relabel+merge": 2, "relabel": 3}
    return sorted(set(found), key=lambda s: (s[0], s[1], s[2], len(s[4]), order[s[3]], s[4]))


def _best(role: int | None) -> tuple[np.ndarray, dict[tuple[int, int], tuple[str, tuple[int, ...]]]]:
    matrix, ways = np.full((4, 4), _NEVER), {}
    for a, b, cost, action, path in _steps(role):
        if cost < matrix[a, b]:
            matrix[a, b], ways[a, b] = cost, (action, path)
    return matrix, ways


_TABLE = [_best(None), *(_best(r) for r in (1, 2, 3))]
_COST = np.stack([m for m, _ in _TABLE])


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _NEVER)


def total(roles: np.ndarray) -> np.ndarray:
    """The matrix of a run of turns, as a tree of products over halves."""
    m = _COST[roles]
    while len(m) > 1:
        if len(m) % 2:
            m = np.concatenate([m, np.where(np.eye(4, dtype=bool), 0, _NEVER)[None]])
        m = np.minimum((m[0::2, :, :, None] + m[1::2, None, :, :]).min(axis=2), _NEVER)
    return m[0]


def walk(roles: np.ndarray, enter: int, leave: int | None) -> tuple[list[tuple[str, int, tuple[int, ...]]], int]:
    """Action, state and inserted roles of each turn on a cheapest path; it ends in `leave`, or cheapest if None."""
    cost, back = np.full(4, _NEVER), np.zeros((len(roles), 4), np.int8)
    cost[enter] = 0
    for k, role in enumerate(roles):
        through = cost[:, None] + _COST[role]
        back[k] = through.argmin(axis=0)
        cost = np.minimum(through.min(axis=0), _NEVER)
    state = int((cost + _END).argmin()) if leave is None else leave
    out = []
    last = state
    for k in range(len(roles) - 1, -1, -1):
        before = int(back[k, state])
        action, path = _TABLE[roles[k]][1][before, state]
        out.append((action, state, path))
        state = before
    return out[::-1], last


def _opened(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


def render(texts: list[str], steps: list[tuple[str, int, tuple[int, ...]]], enter: int, last: bool, leave: int) -> list[str]:
    """The part of the rendered conversation that each turn adds; markers inside of texts are broken up."""
    out = []
    open_ = enter != START
    for text, (action, state, path) in zip(texts, steps, strict=True):
        if "merge" in action:
            part = "\n"
        else:
            part = "<|im_end|>\n" if open_ else ""
            part += "".join(_opened(p) + "<|im_end|>\n" for p in path) + _opened(state)
        out.append(part + text.replace("<|im_", "<| im_"))
        open_ = True
    if last and out:
        out[-1] += "<|im_end|>\n"
        if leave == SYSTEM:
            out[-1] += _opened(USER) + "<|im_end|>\n"
    return out


def _codes(column: pa.Array) -> np.ndarray:
    known = {r: k + 1 for k, r in enumerate(ROLES)}
    return np.array([known.get((r or "").strip().lower(), 0) for r in column.to_pylist()], np.int64)


def _edges(keys: list) -> list[tuple[int, int]]:
    edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
    return [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]


def repair(turns: DataFrame) -> DataFrame:
    """One row per row of `turns` (conv_id, turn, role, text): conv_id, turn, position, role, action, role_out, inserted,
    rendered.

    Turns go by (turn, role, text), null turns first; repeated rows are turns of their own. `position` orders the rows
    of a conversation, and `rendered` in that order is the formatted conversation. `inserted` counts the empty turns
    put before the turn. Roles are compared without case and outer blanks; others, and null, are unknown and get the
    cheapest role. Null texts count as empty, very long ones are rendered whole. Rows with a null conv_id form one
    conversation. An empty table gives an empty one.

    Conversations are dealt by range of (conversation, turn), so one that holds a third of all rows is spread over
    many partitions. The positions are fixed by a checkpoint before they are used.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(width(turns), *order, "_tie").sortWithinPartitions(*order, "text", "_tie").drop("_tie")
    ranged = cut(ranged.withColumn("position", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    key = dict(ranged.dtypes)["conv_id"]

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # a conversation may go on in the next batch
        for batch in batches:
            keys, codes, part = batch.column(0).to_pylist(), _codes(batch.column(1)), batch.column(2).to_pylist()
            done = []
            for a, b in _edges(keys):
                m = total(codes[a:b])
                if held is not None and held[0] == keys[a]:
                    held = (keys[a], part[a], times(held[2], m))
                    continue
                if held is not None:
                    done.append(held)
                held = (keys[a], part[a], m)
            yield rows_of(done)
        if held is not None:
            yield rows_of([held])

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        cells = [pa.array([f[0] for f in found], plain), pa.array([f[1] for f in found], pa.int32()),
                 pa.array([f[2].ravel().tolist() for f in found], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(cells, names=["conv_id", "part", "matrix"])

    plain = pa.string() if key == "string" else pa.int64()
    if key not in ("string", "bigint"):
        raise TypeError("conv_id has to be a string or a long")
    pieces = cut(mapped(ranged.select("conv_id", "role", "part"), up, f"conv_id {key}, part int, matrix array<bigint>"))
    crossing = pieces.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c_id"))
    # at most two pieces of each partition belong to conversations that cross a border, so groups hold a row a partition
    crossing = pieces.join(crossing, F.col("conv_id").eqNullSafe(F.col("c_id"))).select("conv_id", "part", "matrix")

    def through(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part").reset_index(drop=True)
        matrices = [np.array(m, np.int64).reshape(4, 4) for m in group["matrix"]]
        cost, back = np.full(4, _NEVER), []
        cost[START] = 0
        for m in matrices:
            way = cost[:, None] + m
            back.append(way.argmin(axis=0))
            cost = np.minimum(way.min(axis=0), _NEVER)
        state, ends = int((cost + _END).argmin()), []
        for b in back[::-1]:
            ends.append((int(b[state]), state))
            state = int(b[state])
        enter, leave = zip(*ends[::-1], strict=True)
        return pd.DataFrame({"c_id": group["conv_id"], "c_part": group["part"], "enter": enter, "leave": leave,
                             "final": [k == len(group) - 1 for k in range(len(group))]})

    states = crossing.groupBy("conv_id").applyInPandas(through, f"c_id {key}, c_part int, enter int, leave int, final boolean")
    # two rows per partition at most
    placed = ranged.join(F.broadcast(states), F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("part") == F.col("c_part")), "left")
    names = ["conv_id", "turn", "position", "role", "action", "role_out", "inserted", "rendered"]

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(table: pa.Table) -> pa.RecordBatch:
            keys, codes = table.column("conv_id").to_pylist(), _codes(table.column("role"))
            texts = table.column("text").to_pylist()
            enter, leave, final = (table.column(c).to_pylist() for c in ("enter", "leave", "final"))
            steps: list = []
            shown: list[str] = []
            for a, b in _edges(keys):
                begin = START if enter[a] is None else enter[a]
                found, end = walk(codes[a:b], begin, leave[a])
                steps += found
                shown += render(texts[a:b], found, begin, final[a] is None or final[a], end)
            cells = [*(table.column(c).combine_chunks() for c in names[:4]), pa.array([s[0] for s in steps], pa.string()),
                     pa.array([ROLES[s[1] - 1] for s in steps], pa.string()), pa.array([len(s[2]) for s in steps], pa.int32()),
                     pa.array(shown, pa.string())]
            return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cells], names=names)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_pylist()
            a = _edges(keys)[-1][0]
            if a == 0 and held and held[-1].column(0)[-1].as_py() == keys[0]:
                held.append(batch)
                continue
            yield finish(pa.Table.from_batches([*held, batch.slice(0, a)]))
            held = [batch.slice(a)]
        if held:
            yield finish(pa.Table.from_batches(held))

    return mapped(placed.select("conv_id", "turn", "position", "role", "text", "enter", "leave", "final"), down,
                  f"conv_id {key}, turn long, position long, role string, action string, role_out string, inserted int, rendered string")


def cheapest(roles: list[str | None]) -> int:
    """The cost of the best repair by trying all state sequences; for tests on short conversations."""
    known = {r: k + 1 for k, r in enumerate(ROLES)}
    codes = [known.get((r or "").strip().lower(), 0) for r in roles]
    best = _NEVER
    for states in product(range(1, 4), repeat=len(codes)):
        path = (START, *states)
        best = min(best, sum(int(_COST[c][a, b]) for c, a, b in zip(codes, path[:-1], path[1:], strict=True)) + int(_END[path[-1]]))
    return best if codes else 0
