"""Chat rendering after a repair of roles at least cost.

A legal conversation is an optional system turn, then user and assistant in turn, from the user on.
Each given turn keeps its role or gets another (relabel), and then follows the turn before it (step),
joins it (merge, where both have the same role), or has one empty turn put in between (insert).
A dynamic program over the automaton of legal turns finds the cheapest sequence; of equally cheap
ones the first in the order step, merge, insert and system, user, assistant.

Costs of one turn are a (min, +) matrix over the states, and matrices multiply, so a conversation
of any length is worked on in blocks of rows: rows are ordered over all tasks by a range shuffle,
blocks of up to ``block`` rows are summed up as matrices where a conversation crosses their border,
one small row per block fixes the states at the borders, and each block is then repaired alone.
One row per turn and inserted turn comes out, with a piece of the rendered text: the pieces of a
conversation in the order of position are its text, and no cell grows with the conversation.

Turns are ordered by turn (null last), role and text; repeated rows are turns of their own. A null
conv_id is a conversation of its own, null texts are empty, and unknown or null roles take any role
for a small cost. Markers inside texts are broken by a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.tables import staged, text_of

#: States: before the first turn, then the role of the last turn.
ROLES = ("start", "system", "user", "assistant")
NAMES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant", "ai": "assistant", "chatgpt": "assistant", "developer": "system"}
RELABEL, UNKNOWN, MERGE, INSERT = 3.0, 0.5, 1.0, 2.0
NEXT = {(0, 1), (0, 2), (1, 2), (2, 3), (3, 2)}
BLOCK = 4096
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _moves() -> list[tuple[int, int, int, int, float]]:
    """(state, role, action, inserted role, cost), cheapest ties first."""
    out = []
    for s in range(4):
        for r in range(1, 4):
            if (s, r) in NEXT:
                out.append((s, r, 0, 0, 0.0))
            if s == r:
                out.append((s, r, 1, 0, MERGE))
            out += [(s, r, 2, t, INSERT) for t in (2, 3) if (s, t) in NEXT and (t, r) in NEXT]
    return sorted(out, key=lambda m: (m[2], m[1], m[3]))


MOVES = _moves()


def label(role: str | None) -> int:
    """A role's state; 0: unknown."""
    name = (role or "").strip().lower()
    name = NAMES.get(name, name)
    return ROLES.index(name) if name in ROLES[1:] else 0


def cost(given: int, role: int) -> float:
    return 0.0 if given == role else UNKNOWN if given == 0 else RELABEL


def matrix(labels: list[int]) -> np.ndarray:
    """Least cost from each state before the turns to each state after them."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for given in labels:
        one = np.full((4, 4), np.inf)
        for s, r, _, _, c in MOVES:
            one[s, r] = min(one[s, r], c + cost(given, r))
        total = (total[:, :, None] + one[None, :, :]).min(1)
    return total


def repaired(labels: list[int], enter: int, leave: int | None = None) -> list[tuple[int, int, int]]:
    """(role, action, inserted role) of each turn: of the cheapest ways the first in the order of MOVES.

    Without ``leave`` any last state will do.
    """
    left = [{s: 0.0 for s in range(4) if leave in (None, s)}]
    for given in reversed(labels):
        now: dict[int, float] = {}
        for s, r, _, _, c in MOVES:
            if r in left[-1]:
                now[s] = min(now.get(s, np.inf), c + cost(given, r) + left[-1][r])
        left.append(now)
    out = []
    for k, given in enumerate(labels):
        here, after = left[len(labels) - k], left[len(labels) - k - 1]
        for s, r, action, inserted, c in MOVES:
            if s == enter and r in after and c + cost(given, r) + after[r] == here[s]:
                out.append((r, action, inserted))
                enter = r
                break
    return out


def ranks(labels: list[int], total: np.ndarray) -> np.ndarray:
    """For each state before the turns, the order of the states after them by their first cheapest way."""
    out = np.zeros((4, 4))
    order = {m: k for k, m in enumerate(MOVES)}
    for s in range(4):
        ways = []
        for r in np.flatnonzero(np.isfinite(total[s])):
            way, at = [], s
            for role, action, inserted in repaired(labels, s, int(r)):
                way.append(next(k for m, k in order.items() if m[:4] == (at, role, action, inserted)))
                at = role
            ways.append((way, r))
        for k, (_, r) in enumerate(sorted(ways)):
            out[s, r] = k
    return out


def chain(matrices: list[np.ndarray], orders: list[np.ndarray]) -> list[tuple[int, int]]:
    """States before and after each block of a conversation on the first of its cheapest ways."""
    left = [np.zeros(4)]
    for m in reversed(matrices):
        left.append((m + left[-1][None, :]).min(1))
    out, state = [], 0
    for k, (m, order) in enumerate(zip(matrices, orders)):
        go = m[state] + left[len(matrices) - k - 1]
        ties = np.flatnonzero(go == go.min())
        after = int(ties[np.argmin(order[state][ties])])
        out.append((state, after))
        state = after
    return out


def ordered(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, role, text with piece, block and place: the order of all turns over all tasks."""
    rows = turns.select("conv_id", "turn", "role", text_of().alias("text"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.xxhash64("text")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = np.arange(at, at + len(batch))
            at += len(batch)
            columns = [batch.column(c) for c in ("conv_id", "role", "text")]
            numbers = [np.full(len(batch), piece), place // block, place]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(n.astype(np.int64)) for n in numbers)],
                ["conv_id", "role", "text", "piece", "block", "place"],
            )

    kinds = [turns.schema[c].dataType.simpleString() for c in ("conv_id", "role")]
    schema = f"conv_id {kinds[0]}, role {kinds[1]}, text string, piece long, block long, place long"
    return staged(rows.mapInArrow(number, schema), "turns")


def _spans(ids: list) -> list[tuple[int, int]]:
    """(first, end) of each run of equal ids."""
    at = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]]
    return list(zip(at, [*at[1:], len(ids)]))


def _borders(rows: DataFrame) -> DataFrame:
    """States at the borders of blocks, per block and conversation that touches its first or last row."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def summary(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        ids, labels = table.column("conv_id").to_pylist(), [label(r) for r in table.column("role").to_pylist()]
        spans = _spans(ids)
        spans = spans[:1] + spans[1:][-1:]
        costs = [matrix(labels[a:b]) for a, b in spans]
        orders = [ranks(labels[a:b], c) for (a, b), c in zip(spans, costs)]
        square = pa.list_(pa.float64())
        return pa.table(
            {
                "conv_id": table.column("conv_id").take(pa.array([a for a, _ in spans])),
                "piece": [table.column("piece")[0]] * len(spans),
                "block": [table.column("block")[0]] * len(spans),
                "n": pa.array([b - a for a, b in spans], pa.int64()),
                "costs": pa.array([c.ravel() for c in costs], square),
                "orders": pa.array([o.ravel() for o in orders], square),
            }
        )

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by([("piece", "ascending"), ("block", "ascending")])
        costs, orders = ([np.array(c).reshape(4, 4) for c in table.column(n).to_pylist()] for n in ("costs", "orders"))
        ways = chain(costs, orders)
        n = table.column("n").to_numpy()
        last = np.arange(len(n)) == len(n) - 1
        added = {"enter": [w[0] for w in ways], "leave": [w[1] for w in ways], "before": np.cumsum(n) - n, "ends": last}
        kept = {c: table.column(c) for c in ("conv_id", "piece", "block")}
        return pa.table({**kept, **{c: pa.array(v) for c, v in added.items()}})

    head = f"conv_id {kind}, piece long, block long"
    summed = rows.drop("text").groupBy("piece", "block").applyInArrow(summary, f"{head}, n long, costs array<double>, orders array<double>")
    return summed.groupBy("conv_id").applyInArrow(
        states, f"{head}, enter long, leave long, before long, ends boolean"
    )


def broken(text: str) -> str:
    return text.replace(OPEN, "< |im_start|>").replace(CLOSE, "< |im_end|>")


def render(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, position, role, action, relabelled, rendered: one row per turn and inserted turn."""
    rows = ordered(turns, block)
    borders = staged(_borders(rows), "borders")
    kind = turns.schema["conv_id"].dataType.simpleString()

    def repair(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("place")
        ids, texts = left.column("conv_id").to_pylist(), left.column("text").to_pylist()
        labels = [label(r) for r in left.column("role").to_pylist()]
        known = {r["conv_id"]: r for r in right.to_pylist()}
        out = []
        for a, b in _spans(ids):
            own = labels[a:b]
            at = known.get(ids[a])
            enter, leave = (at["enter"], at["leave"]) if at else (0, None)
            before, ends, state = at["before"] if at else 0, at["ends"] if at else True, enter
            for k, (role, action, inserted) in enumerate(repaired(own, enter, leave)):
                place = 2 * (before + k)
                close = f"{CLOSE}\n" if state else ""
                if action == 2:
                    out.append((a + k, place, ROLES[inserted], "insert", False, f"{close}{OPEN}{ROLES[inserted]}\n"))
                    close = f"{CLOSE}\n"
                text = broken(texts[a + k])
                piece = f"\n{text}" if action == 1 else f"{close}{OPEN}{ROLES[role]}\n{text}"
                if ends and k == b - a - 1:
                    piece += f"{CLOSE}\n"
                what = "merge" if action == 1 else "step"
                out.append((a + k, place + 1, ROLES[role], what, own[k] != role, piece))
                state = role
        at, *columns = zip(*out)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
        names = ["position", "role", "action", "relabelled", "rendered"]
        made = {n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)}
        return pa.table({"conv_id": left.column("conv_id").take(pa.array(at)), **made})

    keys = ("piece", "block")
    schema = f"conv_id {kind}, position long, role string, action string, relabelled boolean, rendered string"
    return rows.groupBy(*keys).cogroup(borders.groupBy(*keys)).applyInArrow(repair, schema)


