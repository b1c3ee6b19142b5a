"""Conversation structure repair by a survivor-coalescence Viterbi search.

A sound conversation is empty, or an optional system turn followed by pairs of user and assistant turns.  The cheapest edits that
make a conversation sound are found in one pass over its turns, in order.  Edits and costs: Keep 0, Rerole to user or assistant 3,
Delete 4 (required for blank and repeated turns), Insert an empty user or assistant turn 3; a truncated turn that stays adds 3.
Of equally cheap edit sequences the ASCII-least string of initials wins.

The search keeps one survivor for each of the four states of the pattern, unless another is sure to do better whatever follows.
Survivors are leaves of a tree of edits whose nodes point back and count their references; what no survivor needs falls away.  Once all survivors descend from one node, the edits up to
it are certain: they are applied and given out, and the turns they cover are forgotten.  Survivors of equal cost are compared
by the edits behind their last common node, which are complete: equal cost, state and turns exclude that one sequence begins
another, so the first difference decides, whatever follows.

Turns are shuffled by conversation once and sorted by Spark, which spills; a task reads them as a stream and holds the undecided
turns only.  A turn's repetition elsewhere in its conversation is found by an aggregation over digests, not by a set in a task.
One conversation is one stream: the order of its edits is the result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from footlight.operators.skew import lookup_join
from footlight.session import materialise

REROLE, DROP, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = "\t\n\x0b\x0c\r "
# Rows of a batch given out, and turns after which certain edits are looked for first.
BATCH, LOOK = 4096, 32

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
# Where each state goes by a turn of a role with that initial; a pattern may end in the states of _END.
_NEXT = [{"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER}]
_MADE = ["user", "user", "assistant", "user"]
_END = (_START, _ASSISTANT)


class _Node:
    """An edit, the node before it, its distance from the beginning, and how many nodes and survivors point to it."""

    __slots__ = ("before", "edit", "depth", "uses")

    def __init__(self, before: _Node | None, edit: str):
        self.before, self.edit, self.uses = before, edit, 0
        self.depth = 0
        if before is not None:
            self.depth = before.depth + 1
            before.uses += 1


def _less(a: tuple[_Node, str], b: tuple[_Node, str]) -> bool:
    """Whether the edits of node and next edit ``a`` come before those of ``b``."""
    (x, first), (y, second) = a, b
    while x is not y:
        if x.depth >= y.depth:
            first, x = x.edit, x.before
        else:
            second, y = y.edit, y.before
    return first < second


class Search:
    """Feeds on turns; ``certain`` and ``finish`` give the initials of edits that can no longer change."""

    def __init__(self):
        self.root = _Node(None, "")
        self.best: list[tuple[int, _Node] | None] = [(0, self.root), None, None, None]
        self.root.uses = 1
        self._insert()

    def _replace(self, state: int, cost: int, before: _Node, edit: str) -> None:
        node, old = _Node(before, edit), self.best[state]
        node.uses += 1
        self.best[state] = (cost, node)
        if old:
            self._release(old[1])

    @staticmethod
    def _release(node: _Node | None) -> None:
        node.uses -= 1
        while node.uses == 0 and node.before is not None:
            node = node.before
            node.uses -= 1

    def _insert(self) -> None:
        """Inserted turns: into user from every other state, then from user into assistant."""
        for states, to in (((_START, _SYSTEM, _ASSISTANT), _USER), ((_USER,), _ASSISTANT)):
            for state in states:
                if self.best[state]:
                    cost, node = self.best[state]
                    cost, own = cost + INSERT, self.best[to]
                    if own is None or cost < own[0] or cost == own[0] and _less((node, "I"), (own[1].before, own[1].edit)):
                        self._replace(to, cost, node, "I")

    def turn(self, initial: str, fault: str | None) -> None:
        found: list[tuple[int, _Node, str] | None] = [None] * 4

        def offer(state: int, cost: int, node: _Node, edit: str) -> None:
            old = found[state]
            if old is None or cost < old[0] or cost == old[0] and _less((node, edit), old[1:]):
                found[state] = (cost, node, edit)

        for state, own in enumerate(self.best):
            if own is None:
                continue
            cost, node = own
            offer(state, cost + DROP, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            cost += TRUNCATED if fault == "truncated" else 0
            if initial in _NEXT[state]:
                offer(_NEXT[state][initial], cost, node, "K")
            offer(_NEXT[state][_MADE[state][0]], cost + REROLE, node, "R")
        old, self.best = self.best, [None] * 4
        for state, way in enumerate(found):
            if way:
                self._replace(state, *way)
        for own in old:
            if own:
                self._release(own[1])
        self._insert()
        self._prune()

    def _prune(self) -> None:
        """Survivors go that no continuation can make the best: another does as well by the same edits, or by one deletion more."""
        for state, by in ((_SYSTEM, _START), (_ASSISTANT, _START), (_SYSTEM, _ASSISTANT)):
            own, other = self.best[state], self.best[by]
            if own and other and (other[0] < own[0] or other[0] == own[0] and _less((other[1], ""), (own[1], ""))):
                self._release(own[1])
                self.best[state] = None
        begin, other = self.best[_START], self.best[_ASSISTANT]
        if begin and other and begin[0] > other[0] + DROP:  # only a system turn fits here and not there
            self._release(begin[1])
            self.best[_START] = None

    def _edits(self, node: _Node) -> list[_Node]:
        """The nodes behind the root up to ``node``, first to last."""
        out = []
        while node is not self.root:
            out.append(node)
            node = node.before
        return out[::-1]

    def certain(self) -> str:
        """The edits that all survivors share, forgotten from now on."""
        out = []
        for node in self._edits(next(own[1] for own in self.best if own)):
            if self.root.uses != 1:
                break
            out.append(node.edit)
            node.before, self.root = None, node
        return "".join(out)

    def finish(self) -> str:
        """The rest of the cheapest edits."""
        ends = [self.best[state] for state in _END if self.best[state]]
        (cost, node), *others = ends
        for own in others:
            if own[0] < cost or own[0] == cost and _less((own[1], ""), (node, "")):
                cost, node = own
        return "".join(n.edit for n in self._edits(node))


class _Conversation:
    """Turns that are not decided yet, and the rows of those that are."""

    def __init__(self, key):
        self.key, self.search, self.waiting, self.state, self.n, self.look, self.last = key, Search(), deque(), _START, 0, LOOK, None

    def add(self, turn, role: str, text: str, blank: bool, again: bool, truncated: bool) -> None:
        again = again or self.last == (turn, role, text)
        self.last = (turn, role, text)
        fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else None
        self.waiting.append((turn, role, text, fault))
        self.search.turn(role[:1], fault)

    def decided(self) -> Iterator[tuple]:
        """Rows of certain edits, looked for again after as many turns as are left undecided."""
        if len(self.waiting) >= self.look:
            yield from self._rows(self.search.certain())
            self.look = max(LOOK, 2 * len(self.waiting))

    def rest(self) -> Iterator[tuple]:
        yield from self._rows(self.search.finish())
        if not self.n:
            yield (self.key, 0, None, None, None, None, None, None, 0)

    def _rows(self, edits: str) -> Iterator[tuple]:
        for edit in edits:
            self.n += 1
            turn, was, text, fault = (None, None, "", None) if edit == "I" else self.waiting.popleft()
            role = _MADE[self.state] if edit in "IR" else was
            cost = {"K": 0, "R": REROLE, "D": DROP, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            if edit != "D":
                self.state = _NEXT[self.state][role[0]]
            yield (self.key, self.n, edit, turn, was, role, text, fault, cost)


def _run(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for key, turn, role, text, present, blank, again, truncated in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.key != key:
                    if now is not None:
                        out.extend(now.rest())
                    now = _Conversation(key)
                if present:
                    now.add(turn, role, text, blank, again, truncated)
                    out.extend(now.decided())
                if len(out) >= BATCH:
                    yield packed(out)
                    out = []
        if now is not None:
            out.extend(now.rest())
        if out:
            yield packed(out)

    return run


def repair(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    present_column: str | None = None,
) -> DataFrame:
    """(<id>, n, edit, turn, was, role, text, fault, cost): one row per edit, conversations whole and in order within a partition.

    ``edit`` is K, R, D or I, ``n`` counts from 1; ``was`` is the role before (null for I), ``role`` the one after, ``fault`` blank,
    duplicate or truncated.  Rows with D show what goes; all others, in order, are the repaired conversation.  A conversation
    without turns has one row with ``n`` 0 and no edit: rows whose ``present_column`` is false only tell that it exists.

    Turns are ordered by turn (null first), then role, then text.  Null roles and texts count as one blank.  Rows without an id are one
    conversation.  Repeated rows are duplicates; an empty table gives no rows; other columns are left out.
    """
    role = F.coalesce(F.col(role_column).cast("string"), F.lit(" "))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(" "))
    present = F.coalesce(F.col(present_column).cast("boolean"), F.lit(False)) if present_column else F.lit(True)
    rows = turns.select(F.col(id_column).alias("id"), F.col(turn_column).alias("turn"), role.alias("role"), text.alias("text"), present.alias("present"))
    named = F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.lit(":"), F.char_length("role").cast("string"), F.lit(":"))
    rows = rows.withColumn("same", F.md5(F.concat(named, "role", "text").cast("binary")))
    seen = rows.where("present").groupBy("same").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("turn")).alias("_first"))
    seen = materialise(seen.where(F.col("_n") > 1).select("same", "_n", F.col("_first.turn").alias("_turn")), "repeated_turns")
    rows = lookup_join(rows, seen, ["same"], weight="_n")
    later = F.col("_n").isNotNull() & F.col("turn").isNotNull() & (F.col("_turn").isNull() | (F.col("turn") > F.col("_turn")))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    ready = rows.select(
        "id", "turn", "role", "text", "present",
        (last == "").alias("blank"), F.coalesce(later, F.lit(False)).alias("again"), (~last.isin(".", "!", "?")).alias("truncated"),
    )
    ready = ready.repartition("id").sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text")
    kinds = {f.name: f.dataType for f in ready.schema.fields}
    schema = (
        f"`{id_column}` {kinds['id'].simpleString()}, n long, edit string, turn {kinds['turn'].simpleString()}, "
        "was string, role string, text string, fault string, cost long"
    )
    shape = turns.sparkSession.createDataFrame([], schema).schema
    return ready.mapInArrow(_run(to_arrow_schema(shape)), shape)
