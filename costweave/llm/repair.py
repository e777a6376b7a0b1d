"""Conversation structure repair: cheapest edits that make roles alternate, in one streamed pass.

Turns are dealt out by conversation and sorted inside a partition; ``mapInPandas`` then
sees each conversation in order and carries the state of a dynamic programme from Arrow
batch to Arrow batch. The programme follows the roles written so far through the pattern
``(s?(ua)+)?``:

    START -s-> SYSTEM -u-> USER -a-> ASSISTANT -u-> USER ...     ends: START, ASSISTANT

For every state it keeps the least cost and, among equal costs, the order of the edit
strings that lead there. Two such strings end with an edit that uses up the same turn, so
none is the beginning of another, and their order never changes by what follows: comparing
the ranks of the four states and the last few letters is enough. What is left of the four
ways is one back-pointer of a byte for each state and turn.

Costs differ by a few units between states, so only few situations exist; each is worked
out once for each sort of turn and then looked up.

As soon as all four ways come from one state the edits before it are settled and leave.
Turns that are not settled wait in memory up to ``HELD`` bytes, beyond which they and their
back-pointers go to a temporary file of the task, which is read back piece by piece and
removed. Memory is bounded whatever the length of a conversation.

A conversation is read by one task, since its repaired form is one ordered text, but
nothing of it is held there. What must look across the whole conversation, the first
occurrence of a role and text, comes from a sum by key with a map-side part.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.llm.common import task_count

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3

#: Bytes of unsettled turns and back-pointers that a task holds in memory.
HELD = 8 << 20
#: Conversations in a batch of the result, and letters of an edit string that are joined at a time.
ROWS = 4096

_BLANK, _DUPLICATE, _TRUNCATED = "blank", "duplicate", "truncated"
_SPACES = " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: Inserted roles that lead from state to state; more than two in a row never pay.
_NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NAMES = {"u": "user", "a": "assistant"}
_NEXT_ROLES = ("s", "u", "a")


def faults(turns: DataFrame) -> DataFrame:
    """``conv, turn, role, text, fault``: the first fault of every turn, nulls read as one space.

    ``turns`` holds ``conv, turn, role, text``. Of equal roles and texts the one with the
    lowest turn, nulls first, is no duplicate; equal rows of one turn are told apart later,
    where they stand side by side.
    """
    space = F.lit(" ")
    rows = turns.select(
        "conv", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    ).withColumn("said", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    # nulls come first, as the least turn
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = rows.groupBy("conv", "said").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    again = first.where("times > 1").select(F.col("conv").alias("_conv"), F.col("said").alias("_said"), "first")
    joined = rows.join(
        again, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")), "left"
    )
    ended = F.rtrim("text", F.lit(_SPACES))
    return joined.select(
        "conv", "turn", "role", "text", "said",
        F.when(ended == "", _BLANK)
        .when(place > F.col("first"), _DUPLICATE)
        .when(~F.substring(ended, -1, 1).isin(".", "!", "?"), _TRUNCATED)
        .alias("fault"),
    )


def edits(turns: DataFrame) -> DataFrame:
    """``conv, place, edit, role, text, turn, was, fault, cost``: every edit of every conversation, in order.

    ``turns`` holds ``conv, turn, role, text``; null ids are one conversation. Turns of one
    number follow each other by role and text. ``role`` and ``text`` are those of the
    repaired conversation, null for a deletion; ``was`` is the role before, null for an
    insertion. Rows of a conversation stand together and in order within a partition.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = (
        faults(turns).repartition(task_count(turns.sparkSession), "conv").sortWithinPartitions(*order)
        .select(_shown("conv"), _shown("turn"), "role", "text", "said", "fault")
    )
    found = dealt.mapInPandas(
        _walk, "conv string, place long, edit string, role string, text string, turn string, was string, "
        "fault string, cost int"
    )
    return found.withColumns({"conv": F.col("conv").cast(kind), "turn": F.col("turn").cast("long")})


def _shown(column: str) -> Column:
    """As text: whole numbers with nulls would reach pandas as floating point."""
    return F.col(column).cast("string").alias(column)


def digests(edited: DataFrame) -> DataFrame:
    """One row for each conversation of ``edits``: counts, cost, ``audit`` and ``repaired_sha256``.

    Reads the rows of ``edits`` as they come, conversation by conversation, without a
    shuffle: only the hash and the letters of the present one are in memory.
    """
    kind = edited.schema["conv"].dataType.simpleString()
    rows = edited.select(_shown("conv"), "edit", "role", "text", _shown("turn"), "was", "fault", "cost")
    found = rows.mapInPandas(
        _digest, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return found.withColumn("conv", F.col("conv").cast(kind))


def repaired(edited: DataFrame) -> DataFrame:
    """``conv, place, role, text``: the turns of the repaired conversations."""
    return edited.where(F.col("edit") != DELETE).select("conv", "place", "role", "text")


def damage(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``conv, turn, role, text`` with the faults that a crc32 of ``key:turn`` draws; nulls as one space."""
    space = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), space) for c in (key, "turn")]
    drawn = (F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20).alias("drawn")
    turns = rows.select(
        F.col(key).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), drawn,
    ).where("drawn <> 0")
    text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return turns.select(
        "conv", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


# ---- the programme ----------------------------------------------------------------------


#: A state this much dearer than the cheapest cannot win: two insertions lead from the cheapest
#: to a user or an assistant, and all that a start is ahead of an assistant is one system turn,
#: which the other deletes.
BEHIND = 2 * COST[INSERT] + COST[DELETE]


def _inserted(state: int) -> list[tuple[str, int]]:
    """``roles, state``: at most two insertions, of users and assistants."""
    out, front = [("", state)], [("", state)]
    for _ in range(2):
        front = [(roles + r, to) for roles, at in front for r, to in _NEXT[at].items() if r != "s"]
        out += front
    return out


_WAYS = {state: _inserted(state) for state in range(4)}

#: The situation before the first turn: costs (None: not reached) and ranks of the states.
FIRST = ((0, None, None, None), (0, 0, 0, 0))


def step(situation: tuple, sort: tuple[str, str | None]) -> tuple[tuple, bytes]:
    """The situation after a turn, its costs counted from the least, and its back-pointers.

    ``sort`` is the role's initial and the fault. A back-pointer holds the state before, the
    number of insertions and the edit: ``state | n << 2 | edit << 4``; 255 for no way.
    """
    costs, ranks = situation
    initial, fault = sort
    best: dict[int, tuple] = {}
    for state in range(4):
        if costs[state] is None:
            continue
        for roles, at in _WAYS[state]:
            paid = costs[state] + COST[INSERT] * len(roles)
            choices = [(DELETE, at, COST[DELETE])]
            if fault not in (_BLANK, _DUPLICATE):
                more = TRUNCATED if fault == _TRUNCATED else 0
                if initial in _NEXT[at]:
                    choices.append((KEEP, _NEXT[at][initial], COST[KEEP] + more))
                choices += [(REROLE, to, COST[REROLE] + more) for r, to in _NEXT[at].items() if r != "s"]
            for edit, to, cost in choices:
                way = (paid + cost, (ranks[state], INSERT * len(roles) + edit), state, len(roles), edit)
                if to not in best or way < best[to]:
                    best[to] = way
    least = min(way[0] for way in best.values())
    best = {state: way for state, way in best.items() if way[0] <= least + BEHIND}
    order = {key: i for i, key in enumerate(sorted(way[1] for way in best.values()))}
    after = (
        tuple(best[s][0] - least if s in best else None for s in range(4)),
        tuple(order[best[s][1]] if s in best else 0 for s in range(4)),
    )
    back = bytes(best[s][2] | best[s][3] << 2 | "DKR".index(best[s][4]) << 4 if s in best else 255 for s in range(4))
    return after, back


def ending(situation: tuple) -> tuple[int, int]:
    """``state, insertions`` of the cheapest way to an end, of equal ones the least string."""
    costs, ranks = situation
    ways = [
        (costs[state] + COST[INSERT] * len(roles), (ranks[state], INSERT * len(roles)), state, len(roles))
        for state in range(4) if costs[state] is not None
        for roles, at in _WAYS[state] if at in ENDS
    ]
    return min(ways)[2:]


class _Waiting:
    """Unsettled turns with their back-pointers, in memory or, beyond ``HELD`` bytes, in a file."""

    def __init__(self):
        self.turns: list[tuple] = []
        self.size = 0
        self.file = None
        self.parts: list[int] = []

    def add(self, turn: tuple, size: int) -> None:
        self.turns.append(turn)
        self.size += size
        if self.size > HELD:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            self.parts.append(self.file.tell())
            # pointers and turns apart: the way back reads pointers only
            pickle.dump(b"".join(t[0] for t in self.turns), self.file)
            pickle.dump([t[1:] for t in self.turns], self.file)
            self.turns, self.size = [], 0

    def _pointers(self) -> Iterator[tuple[int, bytes]]:
        """Back-pointers from the last part to the first."""
        yield len(self.parts), b"".join(t[0] for t in self.turns)
        for i in reversed(range(len(self.parts))):
            self.file.seek(self.parts[i])
            yield i, pickle.load(self.file)

    def settle(self, state: int) -> Iterator[tuple[int, str, tuple]]:
        """``insertions, edit, turn`` of all that waits, in order, given the state it ends in."""
        chosen = tempfile.TemporaryFile() if self.parts else None
        places: dict[int, tuple[int, int]] = {}
        held = b""
        for part, back in self._pointers():
            taken = bytearray(len(back) // 4)
            for i in range(len(taken) - 1, -1, -1):
                taken[i] = back[4 * i + state]
                state = taken[i] & 3
            if chosen is None:
                held = bytes(taken)
            else:
                places[part] = (chosen.tell(), len(taken))
                chosen.write(taken)
        for part in range(len(self.parts) + 1):
            if part < len(self.parts):
                self.file.seek(self.parts[part])
                pickle.load(self.file)
                turns = pickle.load(self.file)
            else:
                turns = [t[1:] for t in self.turns]
            if chosen is None:
                taken = held
            else:
                chosen.seek(places[part][0])
                taken = chosen.read(places[part][1])
            for way, turn in zip(taken, turns):
                yield way >> 2 & 3, "DKR"[way >> 4], turn
        for file in (chosen, self.file):
            if file is not None:
                file.close()


class _Conversation:
    """The programme over one conversation.

    ``origin`` names, for each state, the state at the last mark that its way comes from. When
    all ways come from one state there, what stands before the mark is settled and leaves,
    and the mark moves to the present turn.
    """

    steps: dict[tuple, tuple] = {}

    def __init__(self):
        self.situation = FIRST
        self.before, self.since = _Waiting(), _Waiting()
        self.origin = (0, 1, 2, 3)
        self.written = START
        self.place = 0

    def turn(self, turn) -> Iterator[tuple]:
        sort = ((turn.role[:1] if turn.role[:1] in _NEXT_ROLES else ""), turn.fault)
        known = self.steps.get((self.situation, sort))
        if known is None:
            known = self.steps[self.situation, sort] = step(self.situation, sort)
        self.situation, back = known
        gone = turn.fault in (_BLANK, _DUPLICATE)
        # what is deleted for sure needs no text later
        kept = (turn.turn, turn.role, None if gone else turn.text, turn.fault)
        self.since.add((back, *kept), 80 + len(turn.role) + (0 if gone else 2 * len(turn.text)))
        self.origin = tuple(self.origin[b & 3] if b != 255 else None for b in back)
        ways = {state for state in self.origin if state is not None}
        if len(ways) == 1:
            yield from self._leave(self.before, ways.pop())
            self.before, self.since, self.origin = self.since, _Waiting(), (0, 1, 2, 3)

    def end(self) -> Iterator[tuple]:
        state, n = ending(self.situation)
        yield from self._leave(self.before, self.origin[state])
        yield from self._leave(self.since, state)
        yield from self._insert(n)

    def _leave(self, waiting: _Waiting, state: int) -> Iterator[tuple]:
        for n, edit, turn in waiting.settle(state):
            yield from self._insert(n)
            yield self._edit(edit, *turn)

    def _insert(self, n: int) -> Iterator[tuple]:
        for _ in range(n):
            # only a user or an assistant can follow, one of them
            r = "a" if self.written == USER else "u"
            self.written = _NEXT[self.written][r]
            self.place += 1
            yield self.place, INSERT, _NAMES[r], "", None, None, None, COST[INSERT]

    def _edit(self, edit: str, number, role: str, text: str, fault: str | None) -> tuple:
        self.place += 1
        if edit == DELETE:
            return self.place, DELETE, None, None, number, role, fault, COST[DELETE]
        if edit == REROLE:
            r = "a" if self.written == USER else "u"
            self.written = _NEXT[self.written][r]
            shown = _NAMES[r]
        else:
            self.written = _NEXT[self.written][role[:1]]
            shown = role
        cost = COST[edit] + (TRUNCATED if fault == _TRUNCATED else 0)
        return self.place, edit, shown, text, number, role, fault, cost


_EDIT = ["conv", "place", "edit", "role", "text", "turn", "was", "fault", "cost"]


def _nothing(value) -> bool:
    return value is None or value != value


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    conv, now, before = None, None, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if now is None or row.conv != conv:
                if now is not None:
                    yield from ((conv, *edit) for edit in now.end())
                conv, now, before = row.conv, _Conversation(), None
            fault = row.fault
            # equal rows of one turn stand side by side: all but the first are duplicates
            if (row.turn, row.said) == before and fault != _BLANK:
                fault = _DUPLICATE
            before = (row.turn, row.said)
            yield from ((conv, *edit) for edit in now.turn(row._replace(fault=fault)))
    if now is not None:
        yield from ((conv, *edit) for edit in now.end())


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    size = 0
    for edit in _edited(map(_plain, batches)):
        out.append(edit)
        size += 100 + len(edit[4] or "")
        if size > HELD:
            yield pd.DataFrame(out, columns=_EDIT, dtype=object)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=_EDIT, dtype=object)


def _plain(batch: pd.DataFrame) -> pd.DataFrame:
    """With None for every null."""
    return batch.astype(object).where(batch.notna(), None)


class _Summary:
    def __init__(self, conv):
        self.conv = conv
        self.hash, self.empty = hashlib.sha256(), True
        self.audit: list[str] = []
        self.count = {_BLANK: 0, _DUPLICATE: 0, _TRUNCATED: 0}
        self.low = self.high = self.last = None
        self.numbers = self.illegal = self.cost = 0
        self.role = None

    def add(self, row) -> None:
        self.audit.append(row.edit)
        self.cost += row.cost
        if row.edit != INSERT:
            if row.fault is not None:
                self.count[row.fault] += 1
            if row.turn is not None:
                turn = int(row.turn)
                self.numbers += turn != self.last
                self.low = turn if self.low is None else self.low
                self.last = self.high = turn
            if self.role is not None and self.role + row.was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.role = row.was[:1]
        if row.edit != DELETE:
            self.hash.update(("" if self.empty else "\n").encode() + f"{row.role}:{row.text}".encode())
            self.empty = False
        if len(self.audit) > ROWS:
            self.audit = ["".join(self.audit)]

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        return (self.conv, gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out: list[tuple] = []
    now = None
    for batch in map(_plain, batches):
        for row in batch.itertuples(index=False):
            if now is None or row.conv != now.conv:
                if now is not None:
                    out.append(now.row())
                now = _Summary(row.conv)
            now.add(row)
        if len(out) > ROWS:
            yield pd.DataFrame(out, columns=names, dtype=object)
            out = []
    if now is not None:
        out.append(now.row())
    if out:
        yield pd.DataFrame(out, columns=names, dtype=object)
