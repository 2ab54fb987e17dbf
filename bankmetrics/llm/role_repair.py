"""Chat formatting: repairs the roles of a conversation at least cost, then renders it.

Legal conversations are those of an automaton whose state is the role of the last turn: an optional system turn first,
then user and assistant in turns, and an assistant turn last. Each turn is either kept, merged with the one before it,
or relabelled, and empty turns may be inserted before it, so that the sequence becomes legal; the cheapest way is found
by dynamic programming over turns and states. Ties prefer keeping, then merging, relabelling, inserting.

The step of a turn is a matrix of costs from state to state, and steps in a row multiply in the (min, +) algebra. So a
conversation that is spread over many partitions needs no single task: each partition reduces its piece to one matrix,
the few matrices of a conversation tell the state at each cut, and each partition then traces its own piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmetrics.llm.common import kept, slices, work_folder

#: States: nothing yet, and the role of the last turn.
STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)

#: Roles that may follow a state. A role after itself is a merge.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LAST = ASSISTANT

#: Costs: keep, merge, relabel, insert. A relabelled turn that merges pays both.
KEEP, MERGE, RELABEL, INSERT = 0, 2, 3, 4

#: Other names of roles.
NAMES = {
    "system": SYSTEM, "developer": SYSTEM,
    "user": USER, "human": USER, "prompter": USER, "customer": USER,
    "assistant": ASSISTANT, "model": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "ai": ASSISTANT,
}

NEVER = 1 << 40
RENDERED = "<|{role}|>\n{text}\n"


def paths(state: int) -> dict[int, tuple[int, ...]]:
    """For each role that can be made legal after ``state``, the fewest empty turns to insert before it."""
    found: dict[int, tuple[int, ...]] = {}
    open_states = [(state, ())]
    while open_states:
        at, before = open_states.pop(0)
        for role in NEXT[at]:
            if role not in found:
                found[role] = before
                open_states.append((role, (*before, role)))
    return found


def moves(role: int | None) -> list[list[tuple[int, str, tuple[int, ...]] | None]]:
    """From each state to each state, the cheapest treatment of a turn of ``role``: cost, action, turns inserted."""
    table: list[list[tuple[int, str, tuple[int, ...]] | None]] = [[None] * len(STATES) for _ in STATES]
    for state in range(len(STATES)):
        ways = paths(state)
        for to in range(1, len(STATES)):
            label = 0 if to == role else RELABEL
            # In order of preference: the first of equal cost stays.
            options = []
            if to in ways and not ways[to]:
                options.append((KEEP + label, "relabel" if label else "keep", ()))
            if to == state:
                options.append((MERGE + label, "relabel+merge" if label else "merge", ()))
            if to in ways and ways[to]:
                options.append((label + INSERT * len(ways[to]), "relabel+insert" if label else "insert", ways[to]))
            if options:
                table[state][to] = min(options, key=lambda x: x[0])
    return table


MOVES = {role: moves(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def closing(state: int) -> tuple[int, ...]:
    """Empty turns that end a conversation legally; a conversation without turns stays empty."""
    if state in (START, LAST):
        return ()
    return (*paths(state)[LAST], LAST)


def role_of(name: str | None) -> int | None:
    return NAMES.get((name or "").strip().lower())


#: Costs from state to state, and for each state to, the order of the states from, by the ways' states read backwards.
#: Of equally cheap ways the first in that order is taken, so results don't depend on where a conversation is cut.
Matrix = tuple[list[list[int]], list[list[int]]]

ALL = range(len(STATES))


def times(left: Matrix | None, right: Matrix) -> Matrix:
    """The steps of ``left`` and then those of ``right``; None is no step."""
    if left is None:
        return right
    (lc, lo), (rc, ro) = left, right
    costs, order = [[NEVER] * len(STATES) for _ in ALL], [[0] * len(STATES) for _ in ALL]
    for b in ALL:
        keys = []
        for a in ALL:
            m = min(ALL, key=lambda m: (min(lc[a][m] + rc[m][b], NEVER), ro[m][b]))
            costs[a][b] = min(lc[a][m] + rc[m][b], NEVER)
            keys.append((ro[m][b], lo[a][m]))
        for rank, a in enumerate(sorted(ALL, key=lambda a: keys[a])):
            order[a][b] = rank
    return costs, order


STEPS: dict[int | None, Matrix] = {
    role: ([[x[0] if x else NEVER for x in row] for row in step], [[a] * len(STATES) for a in ALL])
    for role, step in MOVES.items()
}


def reduced(roles: list[int | None], before: Matrix | None = None) -> Matrix | None:
    """Least costs from state to state over all turns."""
    for role in roles:
        before = times(before, STEPS[role])
    return before


def traced(roles: list[int | None], entry: int, leave: int | None) -> list[tuple[int, str, tuple[int, ...]]]:
    """Role, action and inserted turns of each turn on the cheapest way from ``entry`` to ``leave``.

    Without ``leave`` the way ends where a legal end costs least.
    """
    costs, back = [0 if s == entry else NEVER for s in range(len(STATES))], []
    for role in roles:
        step, after, came = MOVES[role], [NEVER] * len(STATES), [0] * len(STATES)
        for to in range(len(STATES)):
            for at in range(len(STATES)):
                if step[at][to] and costs[at] + step[at][to][0] < after[to]:
                    after[to], came[to] = costs[at] + step[at][to][0], at
        costs = after
        back.append(came)
    state = best_end(costs) if leave is None else leave
    out = []
    for role, came in zip(reversed(roles), reversed(back)):
        cost, action, inserted = MOVES[role][came[state]][state]
        out.append((state, action, inserted))
        state = came[state]
    return out[::-1]


def best_end(costs: list[int]) -> int:
    """The state with the cheapest legal end, the last turn's role preferred in ties."""
    return min(range(len(STATES)), key=lambda s: (costs[s] + INSERT * len(closing(s)), s != LAST, s))


def ways(pieces: list[Matrix]) -> list[tuple[int, int]]:
    """The states in which the cheapest way through a conversation's pieces enters and leaves each."""
    costs, back = [0 if s == START else NEVER for s in ALL], []
    for c, order in pieces:
        came = [min(ALL, key=lambda a: (min(costs[a] + c[a][b], NEVER), order[a][b])) for b in ALL]
        costs = [min(costs[came[b]] + c[came[b]][b], NEVER) for b in ALL]
        back.append(came)
    state, out = best_end(costs), []
    for came in reversed(back):
        out.append((came[state], state))
        state = came[state]
    return out[::-1]


KIND = "conv_id long, turn long, part long, place long, role string, text string, action string, inserted array<string>, closing array<string>, rendered string"


def _rows(conv: int | None, turns: list[tuple], entry: int, leave: int | None, ends: bool) -> list[dict]:
    """Result rows of the turns of one conversation's piece; turns: (part, place, role, text, turn)."""
    steps = traced([t[2] for t in turns], entry, leave)
    out = []
    for i, ((part, place, _, text, turn), (role, action, inserted)) in enumerate(zip(turns, steps)):
        last = ends and i == len(turns) - 1
        after = closing(role) if last else ()
        shown = "".join(RENDERED.format(role=STATES[r], text="") for r in inserted)
        # A merged turn goes on in the turn before it.
        shown += text + "\n" if action.endswith("merge") else RENDERED.format(role=STATES[role], text=text)
        shown += "".join(RENDERED.format(role=STATES[r], text="") for r in after)
        out.append(
            {"conv_id": conv, "turn": turn, "part": part, "place": place, "role": STATES[role], "text": text, "action": action,
             "inserted": [STATES[r] for r in inserted], "closing": [STATES[r] for r in after], "rendered": shown}
        )
    return out


def repaired(turns: DataFrame) -> DataFrame:
    """One row for each turn of ``turns`` (conv_id, turn, role, text); part and place, a row's range and number in it,
    give their order.

    role is the repaired role, action what was done, ``inserted`` the roles of empty turns before it, ``closing`` those
    after a conversation's last turn. The ``rendered`` parts of a conversation in that order are its rendered text.
    Turns sort by turn, null first, then by hashes of role and text, so equal rows are exchangeable and repeated rows
    are turns of their own. A null or unknown role fits no role, so it is relabelled; null text is empty. Rows without a
    conv_id are one conversation. An empty table gives an empty result.

    A conversation is never gathered: turns are sorted in ranges, which cut long conversations. Those that lie within a
    range are done there. For the first and last conversation of each range, a matrix of costs says what the states at
    its cuts are, and its turns are then traced piece by piece.
    """
    spark, folder = turns.sparkSession, work_folder(turns.sparkSession, "roles")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("role", "text"))
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "mark")]
    # A running number parts rows that are all the same, so that they can fill several ranges.
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = spread.repartitionByRange(*key, F.col("_row")).sortWithinPartitions(*key, F.col("_row"))

    names = [c.split()[0] for c in KIND.split(", ")]
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()),
         ("action", pa.string()), ("inserted", pa.list_(pa.string())), ("closing", pa.list_(pa.string())), ("rendered", pa.string())]
    )
    wide = schema.append(pa.field("state", pa.string())).append(pa.field("costs", pa.list_(pa.int64())))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        # The first conversation may have begun in the range before, and a long one may go on in the next: they are open.
        conv, held, matrix, is_open, begun = None, [], None, True, False

        def waiting(conv: int | None, held: list[tuple]) -> list[dict]:
            blank = dict.fromkeys(("action", "inserted", "closing", "rendered", "costs"))
            return [
                {"conv_id": conv, "turn": t[4], "part": t[0], "place": t[1], "role": None if t[2] is None else STATES[t[2]],
                 "text": t[3], "state": "open", **blank}
                for t in held
            ]

        def total(conv: int | None, matrix: Matrix) -> dict:
            flat = [c for half in matrix for row in half for c in row]
            return {**dict.fromkeys(names), "conv_id": conv, "part": part, "state": "cut", "costs": flat}

        for batch in slices(batches, "text"):
            out: list[dict] = []
            for c, turn, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
                if begun and c != conv:
                    if is_open:
                        out += [*waiting(conv, held), total(conv, reduced([t[2] for t in held], matrix))]
                    else:
                        out += [{**r, "state": "done", "costs": None} for r in _rows(conv, held, START, None, True)]
                    held, matrix, is_open = [], None, False
                conv, begun = c, True
                held.append((part, place, role_of(role), text, turn))
                place += 1
                if len(held) >= 4096:
                    matrix, is_open = reduced([t[2] for t in held], matrix), True
                    out += waiting(conv, held)
                    held = []
            if out:
                yield pa.RecordBatch.from_pylist(out, wide)
        if begun:
            out = [*waiting(conv, held), total(conv, reduced([t[2] for t in held], matrix))]
            yield pa.RecordBatch.from_pylist(out, wide)

    found = dealt.select("conv_id", "turn", "role", "text").mapInArrow(pieces, f"{KIND}, state string, costs array<bigint>")
    found = kept(found, folder, "pieces")
    cuts = found.where("state = 'cut'").select("conv_id", "part", "costs")

    def entries(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        n = len(STATES)
        halves = [[c[i * n : (i + 1) * n] for i in range(2 * n)] for c in table.column("costs").to_pylist()]
        states = ways([(x[:n], x[n:]) for x in halves])
        return pa.Table.from_pydict(
            {
                "_conv": table.column("conv_id"),
                "_part": table.column("part"),
                "entry": pa.array([a for a, _ in states], pa.int64()),
                "leave": pa.array([b for _, b in states], pa.int64()),
                "ends": pa.array([i == len(states) - 1 for i in range(len(states))]),
            }
        )

    known = kept(
        cuts.groupBy("conv_id").applyInArrow(entries, "_conv long, _part long, entry long, leave long, ends boolean"), folder, "cuts"
    )
    turns_open = found.where("state = 'open'").select("conv_id", "turn", "part", "place", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    turns_open = turns_open.join(known, same).drop("_conv", "_part")

    def trace(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by("place").to_pylist()
        held = [(r["part"], r["place"], STATES.index(r["role"]) if r["role"] else None, r["text"], r["turn"]) for r in rows]
        r = rows[0]
        return pa.Table.from_pylist(_rows(r["conv_id"], held, r["entry"], r["leave"], r["ends"]), schema)

    ends = turns_open.groupBy("conv_id", "part").applyInArrow(trace, KIND)
    return found.where("state = 'done'").drop("state", "costs").unionByName(ends)

