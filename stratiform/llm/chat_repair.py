"""Chat formatting: minimum-cost role repair by dynamic programming, then rendering.

A legal conversation is an optional system turn, then user and assistant turns
in alternation, from a user to an assistant turn. An automaton over the last
role (start, system, user, assistant) says which turns may follow. Every turn
of a conversation, in order, is kept, merged into the repaired turn before it,
or relabelled, and empty turns are inserted where one is missing; the cheapest
sequence by ``COSTS`` is taken, ties broken by fewer repaired turns and then in
the order the choices are listed. No turn is dropped.

Turns are sorted over the cluster by range of (conversation, turn), so a
conversation may lie in several partitions. Sorted rows are worked in chunks of
``CHUNK`` rows or ``CHUNK_BYTES`` of text. A chunk's effect on the automaton is a 4 x 4 matrix of costs, and
such matrices are combined by the (min, +) product: the first and last
conversation of each chunk send their matrices, one small pass finds the states
at the chunks' borders, and a second pass over the chunks chooses and renders.
So a conversation with a third of all rows is never gathered.

The result has one row for each input turn and each insertion. ``rendered``
strings, in order of ``out_turn, piece``, concatenate to the whole conversation.

Defined results: a null text is empty; a null or unknown role is no legal role
and must be relabelled; turns with equal numbers, null ones first, follow each
other by role and text hash; repeated rows are turns of their own; a null
conversation id is one conversation; a very long text is a chunk of its own; an
empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: Roles that may follow each state.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
CHUNK, CHUNK_BYTES = 4096, 4 << 20
OPEN, CLOSE = "<|im_start|>{role}\n", "<|im_end|>\n"


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    name_unknown: int = 1      # a role for a turn without a legal one


COSTS = Costs()
#: Costs count first, repaired turns second.
UNIT = 1 << 32
NEVER = 1 << 62


def steps(costs: Costs = COSTS) -> dict[int, list[list[tuple[int, str, tuple[int, ...], int]]]]:
    """For each input role (0: none) and state: (cost, action, inserted roles, next state)."""
    paths: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for state in range(4):              # what can be inserted, at most two turns
        paths[state] = [((), state)]
        for first in LEGAL[state]:
            paths[state].append(((first,), first))
            paths[state] += [((first, second), second) for second in LEGAL[first]]
    out = {}
    for role in range(4):
        out[role] = []
        for state in range(4):
            options = []
            for inserted, at in paths[state]:
                base = costs.insert * len(inserted)
                for to in LEGAL[at]:
                    change = 0 if to == role else costs.relabel if role else costs.name_unknown
                    action = "keep" if to == role else "relabel"
                    options.append(((base + change) * UNIT + len(inserted) + 1, action, inserted, to))
                if at != START and not inserted:
                    change = 0 if at == role else costs.relabel if role else costs.name_unknown
                    action = "merge" if at == role else "relabel+merge"
                    options.append(((change + costs.merge) * UNIT, action, inserted, at))
            out[role].append(options)
    return out


def closing(costs: Costs = COSTS) -> list[tuple[int, tuple[int, ...]]]:
    """Cost and insertions that bring each state to a legal end."""
    return [(NEVER, ()), (2 * (costs.insert * UNIT + 1), (USER, ASSISTANT)), (costs.insert * UNIT + 1, (ASSISTANT,)), (0, ())]


def matrix(roles: list[int], table) -> np.ndarray:
    """Cost of passing the turns, from each state to each state."""
    total = np.full((4, 4), NEVER, dtype=object)
    for s in range(4):
        total[s, s] = 0
    one = {}
    for role in set(roles):
        m = np.full((4, 4), NEVER, dtype=object)
        for s in range(4):
            for cost, _, _, to in table[role][s]:
                m[s, to] = min(m[s, to], cost)
        one[role] = m
    for role in roles:
        total = product(total, one[role])
    return total


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def choose(roles: list[int], start: int, end: int | None, table, ending) -> list[tuple[str, tuple[int, ...], int]]:
    """Cheapest (action, inserted, role) of each turn from a state to a state; to
    any legal end if ``end`` is None."""
    best, back = {start: 0}, []
    for role in roles:
        nxt, how = {}, {}
        for state in sorted(best):
            for cost, action, inserted, to in table[role][state]:
                total = best[state] + cost
                if to not in nxt or total < nxt[to]:
                    nxt[to], how[to] = total, (state, action, inserted)
        best = nxt
        back.append(how)
    if end is None:
        end = min(best, key=lambda s: (best[s] + ending[s][0], s))
    out = []
    for how in reversed(back):
        state, action, inserted = how[end]
        out.append((action, inserted, end))
        end = state
    return out[::-1]


def _sorted_rows(turns: DataFrame) -> DataFrame:
    role = F.lower(F.trim(F.coalesce(F.col("role").cast("string"), F.lit(""))))
    for other, name in ALIASES.items():
        role = F.when(role == other, name).otherwise(role)
    code = F.coalesce(*[F.when(role == name, F.lit(i + 1)) for i, name in enumerate(ROLES)], F.lit(0))
    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text"), code.alias("code"))
    # The row number keeps repeated rows from falling into one range.
    rows = rows.withColumns({"tie": F.xxhash64("code", "text"), "row": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "code", "tie", "row"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("seg", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = chunk = held = used = 0
        for batch in batches:
            place = np.zeros(batch.num_rows, dtype=np.int64)
            for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
                if held == CHUNK or held and used + n > CHUNK_BYTES:
                    chunk, held, used = chunk + 1, 0, 0
                place[i], held, used = chunk, held + 1, used + n
            yield batch.append_column("pos", pa.array(np.arange(at, at + batch.num_rows))).append_column("chunk", pa.array(place))
            at += batch.num_rows
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return stored(rows.mapInArrow(number, f"{kinds}, pos bigint, chunk bigint"), "chat-sorted")


def _segments(conv: list) -> list[tuple[int, int]]:
    """Runs of equal conversation ids."""
    edge = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
    return list(zip(edge, edge[1:])) if conv else []


def repair(turns: DataFrame, costs: Costs = COSTS) -> DataFrame:
    """``conv_id, out_turn, piece, turn, role, action, rendered`` of every repaired turn's pieces."""
    table, ending = steps(costs), closing(costs)
    rows = _sorted_rows(turns)
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def border(chunk):
        chunk = chunk.sort_by("pos")
        conv, code = chunk["conv_id"].to_pylist(), chunk["code"].to_pylist()
        parts = _segments(conv)
        ends = sorted({0, len(parts) - 1})
        cells = [[int(x) for x in matrix(code[parts[k][0]:parts[k][1]], table).ravel()] for k in ends]
        first = chunk.slice(0, 1)
        seg, at = first["seg"][0].as_py(), first["chunk"][0].as_py()
        return pa.table({"conv_id": pa.array([conv[parts[k][0]] for k in ends], chunk.schema.field("conv_id").type),
                         "seg": pa.array([seg] * len(ends), pa.int32()), "chunk": pa.array([at] * len(ends), pa.int64()),
                         "k": pa.array(ends, pa.int32()), "m": pa.array(cells, pa.list_(pa.int64()))})
    borders = rows.select("conv_id", "code", "seg", "chunk", "pos").groupBy("seg", "chunk").applyInArrow(
        border, f"conv_id {kind['conv_id']}, seg int, chunk bigint, k int, m array<bigint>")

    def solve(parts):
        parts = parts.sort_by([("seg", "ascending"), ("chunk", "ascending"), ("k", "ascending")])
        ms = [np.array(m, dtype=object).reshape(4, 4) for m in parts["m"].to_pylist()]
        ahead = [{START: 0}]
        for m in ms:
            last = ahead[-1]
            ahead.append({t: min(last[s] + m[s, t] for s in last) for t in range(4) if any(m[s, t] < NEVER for s in last)})
        end = min(ahead[-1], key=lambda s: (ahead[-1][s] + ending[s][0], s))
        states = [end]
        for m, before in zip(reversed(ms), reversed(ahead[:-1])):
            states.append(min((s for s in before if m[s, states[-1]] < NEVER), key=lambda s: (before[s] + m[s, states[-1]], s)))
        states.reverse()
        emitted, at = [], 0
        for m, s, t in zip(ms, states, states[1:]):
            emitted.append(at)
            at += m[s, t] % UNIT
        n = len(ms)
        return pa.table({"seg": parts["seg"], "chunk": parts["chunk"],
                         "k": parts["k"], "start": pa.array(states[:-1], pa.int32()), "stop": pa.array(states[1:], pa.int32()),
                         "before": pa.array(emitted, pa.int64()), "final": pa.array([i == n - 1 for i in range(n)])})
    plan = borders.groupBy("conv_id").applyInArrow(
        solve, "seg int, chunk bigint, k int, start int, stop int, before bigint, final boolean")

    def render(chunk, solved):
        chunk = chunk.sort_by("pos")
        conv = chunk["conv_id"].to_pylist()
        given = {x["k"]: x for x in solved.to_pylist()}
        out = {c: [] for c in ("row", "out_turn", "piece", "role", "action", "rendered")}

        def add(row, turn, piece, role, action, text):
            for c, x in zip(out, (row, turn, piece, ROLES[role - 1], action, text)):
                out[c].append(x)
        code, text = chunk["code"].to_pylist(), chunk["text"].to_pylist()
        # Pieces of a merged turn follow the order of all rows, in whatever chunk they lie.
        place = [(seg << 40) + pos + 1 for seg, pos in zip(chunk["seg"].to_pylist(), chunk["pos"].to_pylist())]
        for k, (a, b) in enumerate(_segments(conv)):
            known = given.get(k)
            state, n = (known["start"], known["before"]) if known else (START, 0)
            stop, final = (known["stop"], known["final"]) if known else (None, True)
            for i, (action, inserted, role) in zip(range(a, b), choose(code[a:b], state, stop, table, ending)):
                for r in inserted:
                    add(i, n, 0, r, "insert", (CLOSE if n else "") + OPEN.format(role=ROLES[r - 1]))
                    n += 1
                if "merge" in action:
                    add(i, n - 1, place[i], role, action, "\n" + text[i])
                else:
                    add(i, n, 0, role, action, (CLOSE if n else "") + OPEN.format(role=ROLES[role - 1]) + text[i])
                    n += 1
                state = role
            if final:
                for r in ending[state][1]:
                    add(b - 1, n, 0, r, "insert", CLOSE + OPEN.format(role=ROLES[r - 1]))
                    n += 1
                add(b - 1, n, 0, state, "close", CLOSE)
        return out

    def run(chunk, solved):
        got = render(chunk, solved)
        chunk = chunk.sort_by("pos")
        at = pa.array(got["row"], pa.int64())
        turn = [None if a in ("insert", "close") else t for a, t in zip(got["action"], chunk["turn"].take(at).to_pylist())]
        return pa.table({"conv_id": chunk["conv_id"].take(at), "out_turn": pa.array(got["out_turn"], pa.int64()),
                         "piece": pa.array(got["piece"], pa.int64()), "turn": pa.array(turn, chunk.schema.field("turn").type),
                         "role": pa.array(got["role"], pa.string()), "action": pa.array(got["action"], pa.string()),
                         "rendered": pa.array(got["rendered"], pa.string())})
    return rows.groupBy("seg", "chunk").cogroup(plan.groupBy("seg", "chunk")).applyInArrow(
        run, f"conv_id {kind['conv_id']}, out_turn bigint, piece bigint, turn {kind['turn']}, role string, action string, rendered string")
