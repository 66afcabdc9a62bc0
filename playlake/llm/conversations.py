"""Conversation structure repair: a generalised LR parse of the roles whose actions may edit them.

A conversation must read: an optional system turn, then pairs of a user's and an assistant's turn;
or nothing. The role grammar is

    C -> O T | nothing     O -> s | nothing     T -> P | T P     P -> u a

Its LR tables are below. All parses go on side by side in a graph-structured stack: a stack is its
top state and the stack under it, which many tops share. At each row every top may delete the row,
keep it (shift its role), or shift another role in its place; between rows it may shift a role that
isn't there. Each action has a weight. Equal tops are merged: in this grammar the top alone says
what may follow, so only the one with the smallest (cost, audit) lives on. The audit is the string
of the actions' initials.

Rows pass one by one, in order, and what all living tops agree on is settled and leaves at once; a
top that can't win any more is dropped. So a task holds the few rows that are still open, not a
conversation.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import take

KEEP, DELETE, REROLE, INSERT, CUT_OFF = 0, 4, 3, 3, 3
ROLES = {"u": "user", "a": "assistant"}

# LR tables: states 0 start, 1 O, 2 s, 3 u, 4 T, 5 P, 6 T P, 7 u a
SHIFT = {(0, "s"): 2, (1, "u"): 3, (4, "u"): 3, (3, "a"): 7}
GOTO = {(0, "O"): 1, (1, "T"): 4, (1, "P"): 5, (4, "P"): 6}
#: By state and next role; None: whatever comes next. The symbol made, and how many it is made of.
REDUCE = {(0, "u"): ("O", 0), (2, "u"): ("O", 1), (5, None): ("T", 1), (6, None): ("T", 2), (7, None): ("P", 2)}
ACCEPT = (0, 4)
#: (top, other): what the rest can cost the top more than the other, at most.
BEHIND = {(0, 2): 0, (0, 3): INSERT, (0, 4): 0, (2, 0): 2 * INSERT, (2, 3): INSERT, (2, 4): 2 * INSERT,
          (3, 0): INSERT + DELETE, (3, 2): INSERT, (3, 4): INSERT, (4, 0): DELETE, (4, 2): 0, (4, 3): INSERT}

Stack = tuple  # (state, stack below or None)
Tops = dict[int, tuple[int, str, Stack]]

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


def _reduced(stack: Stack, role: str | None) -> Stack:
    """After all reductions that the next role asks for (None: those that need not know it)."""
    while True:
        rule = REDUCE.get((stack[0], None)) or REDUCE.get((stack[0], role))
        if rule is None:
            return stack
        symbol, size = rule
        for _ in range(size):
            stack = stack[1]
        stack = (GOTO[stack[0], symbol], stack)


def shifted(stack: Stack, role: str) -> Stack | None:
    """The stack after a role, or None if it can't follow."""
    stack = _reduced(stack, role)
    state = SHIFT.get((stack[0], role))
    return None if state is None else _reduced((state, stack), None)


def _offer(tops: Tops, cost: int, audit: str, stack: Stack | None) -> bool:
    """Merges a stack into the equal top; whether it is the better one."""
    if stack is None:
        return False
    old = tops.get(stack[0])
    if old is not None and (old[0], old[1]) <= (cost, audit):
        return False
    tops[stack[0]] = (cost, audit, stack)
    return True


def _inserted(tops: Tops) -> Tops:
    """The tops with all that insertions reach."""
    todo = list(tops.values())
    while todo:
        cost, audit, stack = todo.pop()
        for role in ROLES:
            made = shifted(stack, role)
            if _offer(tops, cost + INSERT, audit + "I", made):
                todo.append(tops[made[0]])
    return tops


def _living(tops: Tops) -> Tops:
    """Without the tops that cost more than another one in any case."""
    return {s: t for s, t in tops.items()
            if not any(o[0] + BEHIND[p, s] < t[0] for p, o in tops.items() if p != s)}


class Repair:
    """One conversation: takes its rows in order and gives back settled edits with their rows."""

    def __init__(self) -> None:
        self.tops: Tops = {0: (0, "", (0, None))}
        self.open: deque = deque()
        self.last = ""  # the role that was put out last

    def add(self, row: tuple, role: str, must_go: bool, cut_off: bool) -> Iterator[tuple]:
        """Takes a row with the initial of its role."""
        self.open.append(row)
        more = CUT_OFF if cut_off else 0
        after: Tops = {}
        for cost, audit, stack in _inserted(dict(self.tops)).values():
            _offer(after, cost + DELETE, audit + "D", stack)
            if must_go:
                continue
            _offer(after, cost + KEEP + more, audit + "K", shifted(stack, role))
            for other in ROLES:
                _offer(after, cost + REROLE + more, audit + "R", shifted(stack, other))
        self.tops = _living(after)
        return self.settle(commonprefix([t[1] for t in self.tops.values()]))

    def settle(self, agreed: str) -> Iterator[tuple]:
        """The edits that all tops agree on: initial, row (None: inserted) and new role (None: as it is)."""
        self.tops = {s: (c, a[len(agreed):], k) for s, (c, a, k) in self.tops.items()}
        for edit in agreed:
            row = None if edit == "I" else self.open.popleft()
            role = None
            if edit in "RI":
                role = "assistant" if self.last == "u" else "user"
                self.last = role[0]
            elif edit == "K":
                self.last = row[0]
            yield edit, row, role

    def end(self) -> Iterator[tuple]:
        tops = _inserted(dict(self.tops))
        self.tops = {0: min(tops[s] for s in ACCEPT if s in tops)}
        return self.settle(self.tops[0][1])


EDITS = "conv_id {}, turn {}, edit string, cost long, role string, text string, fault string, illegal boolean, place long"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All conversations of a partition, whose rows come in order."""
    repair, current, place, out = None, None, 0, []
    kinds = None

    def put(settled: Iterator[tuple]) -> None:
        nonlocal place
        for edit, row, role in settled:
            if edit == "I":
                out.append((current, None, "I", INSERT, role, "", None, False, place))
            else:
                _, turn, own, text, fault, illegal = row
                cost = (DELETE if edit == "D" else (KEEP if edit == "K" else REROLE) + (CUT_OFF if fault == TRUNCATED else 0))
                out.append((current, turn, edit, cost, role or own, text, fault, illegal, place))
            place += 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * 9
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["conv_id", "turn", "edit", "cost", "role", "text", "fault", "illegal", "place"]
    for rows in batches:
        kinds = [rows.column("conv_id").type, rows.column("turn").type, pa.string(), pa.int64(), pa.string(),
                 pa.string(), pa.string(), pa.bool_(), pa.int64()]
        for conv, turn, role, text, fault, illegal in zip(*[rows.column(c).to_pylist() for c in (
                "conv_id", "turn", "role", "text", "fault", "illegal")], strict=True):
            if repair is None or conv != current:
                if repair is not None:
                    put(repair.end())
                repair, current, place = Repair(), conv, 0
            put(repair.add((role[:1], turn, role, text, fault, illegal), role[:1], fault in (BLANK, DUPLICATE), fault == TRUNCATED))
        yield batch()
    if repair is not None:
        put(repair.end())
        yield batch()


def faults(conversations: DataFrame) -> DataFrame:
    """Each row with its first ``fault`` (blank, duplicate, truncated or null), and whether its role
    can't follow the row before (``illegal``); rows of a conversation lie together, in order."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = take(conversations, "conv_id", "turn", "role", "text").select("conv_id", "turn", space("role"), space("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.repartition("conv_id")
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(Window.partitionBy("conv_id").orderBy(*order)), initial)
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(order[0])) > 1
    return rows.withColumn("again", again).select(
        "conv_id", "turn", "role", "text",
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("again"), DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).alias("fault"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    ).sortWithinPartitions("conv_id", *order)


def repaired(conversations: DataFrame) -> DataFrame:
    """The cheapest edits that bring each conversation in order, one row per edit.

    Takes ``conv_id``, ``turn``, ``role`` and ``text``. Returns ``conv_id``, ``place`` (from 0),
    ``edit`` (K keep, R rerole, D delete, I insert) and its ``cost``, ``role`` and ``text`` after it, the
    row's ``turn`` (null: inserted), its first ``fault`` and whether its role can't follow the row
    before (``illegal``). The rows that aren't deleted are the repaired conversation.

    Rows stand in the order of ``turn``, null first, ties by role and text. A null role or text counts
    as one blank, a null ``conv_id`` is a conversation of its own. Repeated rows are duplicates. An
    empty table gives an empty one; long texts are passed on; further columns don't matter.

    A conversation is one training example, and its rows pass through one task in order. They are
    sorted outside of memory, and only those not yet settled are held.
    """
    kind = {f.name: f.dataType.simpleString() for f in take(conversations, "conv_id", "turn").schema}
    return faults(conversations).mapInArrow(_edits, EDITS.format(kind["conv_id"], kind["turn"]))


def conversation_key(conv_id: str = "conv_id", turn: str = "turn") -> Column:
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)])


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults made in them, by the checksum of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    Nulls count as one blank."""
    kind = F.crc32(conversation_key().cast("binary")) % 20
    rows = take(conversations, "conv_id", "turn", "role", "text").withColumn("kind", kind).where("kind <> 0")
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(times).alias("copy")).drop("copy")


def repair_report(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: turns missing (``gaps``), rows by fault, illegal
    neighbours, ``cost``, ``audit``, and the SHA-256 of the repaired ``role:text`` lines.

    A conversation without rows in ``edits`` has zeros, an empty audit and the hash of an empty text.
    """
    all_ids = take(conversations, "conv_id").distinct()
    rows = edits.unionByName(all_ids, allowMissingColumns=True)
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    line = F.when(F.col("edit") != "D", F.concat_ws(":", "role", "text"))
    summed = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)).cast("long").alias("reach"),
        F.size(F.collect_set("turn")).cast("long").alias("different"),
        *[count(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
        count(F.col("illegal")).alias("illegal"),
        F.coalesce(F.sum("cost"), F.lit(0)).cast("long").alias("cost"),
        F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "edit", line.alias("line"))))).alias("edits"))
    return summed.select(
        "conv_id", (F.col("reach") - F.col("different")).alias("gaps"), BLANK, DUPLICATE, TRUNCATED, "illegal", "cost",
        F.concat_ws("", F.col("edits.edit")).alias("audit"),
        F.sha2(F.concat_ws("\n", F.col("edits.line")), 256).alias("repaired_sha256"))
