"""Minimum-cost role repair of conversations, and rendering (operator 1).

A legal conversation is ``[system] (user assistant)+``.  Turns in order are
read against that automaton by dynamic programming: a turn keeps its role or
is relabelled, joins the message before it (merge), opens the next message, or
opens one after empty messages that had to be put in.  Costs add up, and the
repair of the least cost is rendered; on equal cost a turn rather keeps its
role, then takes the lower role in the order system, user, assistant.

A conversation may be longer than a task should hold.  Turns are dealt by
ranges of (conversation, turn); a task that has only a stretch of one computes
its least costs from each entry state to each exit state (a min-plus matrix).
The stretches' matrices, two for each range at most, are multiplied on the
driver, which fixes every stretch's entry and exit; then each stretch is
repaired on its own.

Result: a row for each turn, with its new role, what happened, its share of
the cost and the rendered fragment; fragments in order are the conversation.

Defined results: order is by turn (nulls first), then role and text; equal
rows are turns of their own; a null or unknown role takes any role at the cost
of a relabel; null text is empty; null ids are one conversation; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import partitions, stage

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
#: Wire names of the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT}
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT
NEVER = 1 << 40


def _between() -> dict[tuple[int, int], tuple[int, ...]]:
    """The messages between two states on the shortest legal way from one to the other."""
    out = {}
    for start in range(4):
        ways = [(start, ())]
        for state, way in ways:  # grows as it is read: breadth first
            for to in LEGAL[state]:
                if (start, to) not in out:
                    out[start, to] = way
                    ways.append((to, (*way, to)))
    return out


BETWEEN = _between()


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 3
    insert: int = 4

    def step(self, state: int, label: int, role: int) -> tuple[int, bool, tuple[int, ...]]:
        """(cost, merged, inserted) of a turn of ``role`` read as ``label`` in ``state``."""
        cost = 0 if label == role else self.relabel
        between = BETWEEN.get((state, label))
        if state == label and (between is None or self.merge <= self.insert * len(between)):
            return cost + self.merge, True, ()
        if between is None:
            return NEVER, False, ()
        return cost + self.insert * len(between), False, between

    def end(self, state: int) -> tuple[int, tuple[int, ...]]:
        """(cost, inserted) of ending in ``state``."""
        if state == FINAL:
            return 0, ()
        more = (*BETWEEN[state, FINAL], FINAL)
        return self.insert * len(more), more


def _table(costs: Costs) -> dict[int, list[list[tuple[int, int]]]]:
    """By role and state after: (state before, cost), the best predecessors first on ties."""
    return {role: [[(s, costs.step(s, label, role)[0]) for s in range(4) if label and costs.step(s, label, role)[0] < NEVER] for label in range(4)] for role in (0, SYSTEM, USER, ASSISTANT)}


def _only(state: int) -> list[int]:
    """Costs of the states where ``state`` is free and no other possible."""
    return [0 if s == state else NEVER for s in range(4)]


def _forward(table: dict, roles: list[int], begin: list[int]) -> list[list[int]]:
    """Least cost of each state after each turn, from the costs ``begin``."""
    now = begin
    rows = [now]
    for role in roles:
        now = [min((now[s] + c for s, c in ways), default=NEVER) for ways in table[role]]
        rows.append([min(x, NEVER) for x in now])
        now = rows[-1]
    return rows


def matrix(costs: Costs, roles: list[int]) -> list[list[int]]:
    """Least cost from each entry state to each exit state."""
    table = _table(costs)
    return [_forward(table, roles, _only(s))[-1] for s in range(4)]


def _walk(table: dict, rows: list[list[int]], roles: list[int], leave: int, before: int) -> tuple[list[int], int]:
    """(label of each turn, state at the start) of the least way to ``leave``;
    ``before``: the role of the turn before the first (-1: none)."""
    labels, state = [], leave
    for i in range(len(roles) - 1, -1, -1):
        labels.append(state)
        # The state before; on equal cost one that lets the turn before keep its role.
        kept = roles[i - 1] if i else before
        state = min(table[roles[i]][state], key=lambda w: (rows[i][w[0]] + w[1], w[0] != kept, w[0]))[0]
    return labels[::-1], state


def repair(costs: Costs, roles: list[int], begin: list[int] | None = None, leave: int | None = None, before: int = -1) -> tuple[list[int], int]:
    """(label of each turn, cost) from ``begin`` (costs of the states; the
    start, if not given) to ``leave``, or to a legal end."""
    table = _table(costs)
    rows = _forward(table, roles, _only(START) if begin is None else begin)
    if leave is None:
        leave = min(range(4), key=lambda s: (rows[-1][s] + costs.end(s)[0], s))
    return _walk(table, rows, roles, leave, before)[0], rows[-1][leave]


def entries(costs: Costs, roles: list[int], begin: list[int], before: int) -> list[int]:
    """For each state that a stretch may end in, the one that its least way starts from (-1: no way)."""
    table = _table(costs)
    rows = _forward(table, roles, begin)
    return [_walk(table, rows, roles, s, before)[1] if rows[-1][s] < NEVER else -1 for s in range(4)]


def role_of(name: str | None) -> int:
    return ALIASES.get((name or "").strip().lower(), 0)


def fragments(costs: Costs, roles: list[int], texts: list[str], entry: int, leave: int | None, last: bool, begin: list[int] | None = None, before: int = -1) -> list[tuple[str, str, int, str]]:
    """(new role, action, cost, fragment) of each turn of a stretch."""
    labels, _ = repair(costs, roles, begin, leave, before)
    out, state = [], entry
    for i, (role, text, label) in enumerate(zip(roles, texts, labels, strict=True)):
        cost, merged, inserted = costs.step(state, label, role)
        action = "+".join(("relabel",) * (label != role) + ("merge",) * merged + ("insert",) * bool(inserted)) or "keep"
        close = "" if state == START else "<|im_end|>\n"
        piece = "\n" + text if merged else close + "".join(f"<|im_start|>{NAMES[x]}\n<|im_end|>\n" for x in inserted) + f"<|im_start|>{NAMES[label]}\n{text}"
        if last and i == len(roles) - 1:
            more, added = costs.end(label)
            cost += more
            piece += "<|im_end|>\n" + "".join(f"<|im_start|>{NAMES[x]}\n<|im_end|>\n" for x in added)
            if added:
                action = "insert" if action == "keep" else action if "insert" in action else action + "+insert"
        out.append((NAMES[label], action, cost, piece))
        state = label
    return out


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (range, conversation, turn, role, text) of one range and conversation at a time."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


@dataclass
class Way:
    """What a stretch has to know of the conversation around it."""

    entry: int = START
    leave: int | None = None
    last: bool = True
    #: Least costs of the states at its start, and the role of the turn before it.
    begin: list[int] | None = None
    before: int = -1


def _ways(every: DataFrame, several: set[int | None], costs: Costs) -> dict[tuple, Way]:
    """The ways of the stretches of the conversations in ``several``, as one
    walk over the whole conversation takes them, ties included.

    Forward: the matrices of the stretches give the costs at the start of each.
    Backward: with these, each stretch tells for every end which start its
    least way has (a second pass), and the ends follow from the last stretch.
    The driver holds a few numbers for each stretch.
    """

    def told(values):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for mine in _stretches(batches):
                if mine[0][1] in several:
                    roles = [role_of(r[3]) for r in mine]
                    yield pa.RecordBatch.from_arrays([pa.array([mine[0][0]], pa.int32()), pa.array([mine[0][1]], pa.int64()), pa.array([values(mine[0][:2], roles)], pa.list_(pa.int64()))], names=["range", "conv", "found"])

        rows = every.mapInArrow(run, "range int, conv long, found array<long>").collect()
        return {(r["range"], r["conv"]): r["found"] for r in rows}

    stretches: dict = {}
    for key, found in sorted(told(lambda _, roles: [*(c for row in matrix(costs, roles) for c in row), roles[-1]]).items(), key=lambda x: x[0][0]):
        stretches.setdefault(key[1], []).append((key, [found[4 * i : 4 * i + 4] for i in range(4)], found[16]))
    ways: dict[tuple, Way] = {}
    ends = {}
    for conv, mine in stretches.items():
        now, before = _only(START), -1
        for i, (key, m, role) in enumerate(mine):
            ways[key] = Way(last=i == len(mine) - 1, begin=now, before=before)
            now, before = [min(min(now[s] + m[s][t] for s in range(4)), NEVER) for t in range(4)], role
        ends[conv] = min(range(4), key=lambda s: (now[s] + costs.end(s)[0], s))
    starts = told(lambda key, roles: entries(costs, roles, ways[key].begin, ways[key].before))
    for conv, mine in stretches.items():
        state = ends[conv]
        for key, _, _ in reversed(mine):
            ways[key].leave = state
            state = ways[key].entry = starts[key][state]
    return ways


def repair_conversations(turns: DataFrame, costs: Costs = Costs(), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, new_role, action, cost, fragment) of every turn."""
    spark = turns.sparkSession
    parts = partitions(spark)
    rows = turns.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    dealt = rows.repartitionByRange(parts, *order).select(F.spark_partition_id().alias("range"), *order)
    dealt = stage(dealt, "chat-ranges")
    every = dealt.repartition(parts, "range").sortWithinPartitions("range", *order)
    # Conversations that several ranges have a part of: one for each bound between ranges at most.
    ranges = dealt.groupBy("conv").agg(F.min("range").alias("low"), F.max("range").alias("high"))
    several = [r["conv"] for r in ranges.where("low < high").select("conv").collect()]
    ways: dict[tuple, Way] = {}
    if several:
        ways = _ways(every, set(several), costs)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for mine in _stretches(batches):
            way = ways.get(mine[0][:2], Way())
            done = fragments(costs, [role_of(r[3]) for r in mine], [r[4] for r in mine], way.entry, way.leave, way.last, way.begin, way.before)
            out.extend((r[1], r[2], r[3], *x) for r, x in zip(mine, done, strict=True))
            if len(out) >= 2000:
                yield _rendered(out)
                out = []
        if out:
            yield _rendered(out)

    return every.mapInArrow(render, "conv_id long, turn long, role string, new_role string, action string, cost long, fragment string")


def _rendered(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["conv_id", "turn", "role", "new_role", "action", "cost", "fragment"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
