"""Conversation structure repair: the cheapest edits to a system turn or none, then user and assistant turns in turn.

Faults, the first of a row counts: blank (no character but white space), duplicate (role and text seen earlier in the
conversation), truncated (the last character but white space is not one of . ! ?).

Edits: K keeps a row (0), R gives it the role user or assistant (1), D deletes it (2; blank rows and duplicates must go),
I inserts an empty user or assistant row (5); a truncated row that stays adds 5. What remains is nothing, or `s?(ua)+` by
the roles' initials. Of edits of least cost those count whose letters, in order, are least as ASCII.

Search. A* on the lattice of (rows passed, what may follow). The heuristic is a suffix sum: 2 for each row that must go
and the unavoidable charge of 2 for each truncated one (to delete it is cheaper than to keep it). It never falls by more
than an edit costs, so the first goal taken from the queue, ordered by cost plus heuristic and then by letters, is the
least one: of two edits of the same rows and cost none begins with the other.

Scale. Rows are sorted by ranges of conversation and turn; stretches of at most SEGMENT rows are searched by themselves.
Almost every conversation is one stretch. For one that is several, or meets the edge of a partition, each stretch yields
the least cost from every entry to every exit; these, a few numbers each, give the cost to go at each border. Each
stretch is then searched from every entry, which names the exit of the least letters, and the chain of exits picks the
entries. A task gathers two letters for each row of a stretch, and the letters of one conversation; texts pass once, as a
sorted stream.

Cases: a null role or text counts as one space; null turns come first and leave no gap; a null conv_id is a conversation;
rows of one turn are taken by role and a hash of the text; repeated rows are duplicates; roles of other initials are
re-roled or deleted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import batch, drop_written, tidy, written

#: Rows that are searched together.
SEGMENT = 1024
#: What may follow: anything (0), user after a system row (1), assistant (2), user or the end (3).
STATES = range(4)
#: Where a user and an assistant row lead.
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
#: Where a kept row leads, by its role's initial.
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: The cost to end from each state, by rows inserted last.
END = (0, 10, 5, 0)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 60
SPACE = " \t\n\x0b\x0c\r"


def row_edits(initial: str, fault: str, state: int) -> Iterator[tuple[str, int, int]]:
    """letter, cost, next state of the edits that pass a row."""
    yield "D", DELETE, state
    if fault not in "bd":
        extra = TRUNCATED if fault == "t" else 0
        if (initial, state) in KEPT:
            yield "K", extra, KEPT[initial, state]
        yield "R", REROLE + extra, NEXT[state]


def search(initials: str, faults: str, entry: int, to_go: tuple[int, ...]) -> tuple[int, int, str]:
    """exit state, cost, letters of the least edits of a stretch from an entry state, by A*; to_go: the cost that each
    exit leaves for what follows. Rows inserted after the last one belong to what follows."""
    n = len(initials)
    rest = [min(to_go)] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if faults[i] in "bd" else min(DELETE, TRUNCATED) if faults[i] == "t" else 0)
    queue, done = [(rest[0], "", 0, entry, 0)], set()
    while queue:
        _, letters, i, state, cost = heapq.heappop(queue)
        if i > n:
            return state, cost, letters
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == n:
            if to_go[state] < NEVER:
                heapq.heappush(queue, (cost + to_go[state], letters, n + 1, state, cost))
            continue
        heapq.heappush(queue, (cost + INSERT + rest[i], letters + "I", i, NEXT[state], cost + INSERT))
        for letter, price, after in row_edits(initials[i], faults[i], state):
            heapq.heappush(queue, (cost + price + rest[i + 1], letters + letter, i + 1, after, cost + price))
    return entry, NEVER, ""


def passage(initials: str, faults: str) -> list[int]:
    """The least cost from each entry to each exit of a stretch, 16 numbers."""
    out = []
    for entry in STATES:
        cost = [0 if s == entry else NEVER for s in STATES]
        for initial, fault in zip(initials, faults, strict=True):
            for _ in range(2):  # up to two rows inserted before this one
                for s in STATES:
                    cost[NEXT[s]] = min(cost[NEXT[s]], cost[s] + INSERT)
            new = [NEVER] * 4
            for s in STATES:
                if cost[s] < NEVER:
                    for _, price, after in row_edits(initial, fault, s):
                        new[after] = min(new[after], cost[s] + price)
            cost = new
        out += cost
    return out


def illegal_pairs(initials: str) -> int:
    """Rows beside each other whose initials are none of su, ua, au."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, key: what tells rows of a conversation apart but for their turn."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text[0].alias("role"), text[1].alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), F.concat("role", "text"))
    return rows.withColumn("key", F.sha2(key, 256))


def _faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, key, copies, initial, fault (of the first copy), again (of the others): equal rows of a turn
    are one row here. A row is a duplicate if a turn before holds its key."""
    shown = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(shown == "", "b").when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "t").otherwise(".")
    rows = rows.select("conv_id", "turn", "role", "key", F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"), kind.alias("kind"))
    rows = rows.groupBy("conv_id", "turn", "role", "key", "initial", "kind").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    first = rows.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select("key", "first")
    rows = rows.join(first, "key", "left")
    again = F.when(F.col("kind") == "b", "b").otherwise("d")
    fault = F.when(F.col("first").isNotNull() & (place > F.col("first")), again).otherwise(F.col("kind"))
    return rows.select("conv_id", "turn", "role", "key", "copies", "initial", fault.alias("fault"), again.alias("again"))


_ORDER = ["conv_id", "turn", "role", "key"]
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("whole", pa.bool_()), ("initials", pa.string()), ("faults", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())])
_SEGMENT_SQL = "conv_id long, part int, number long, whole boolean, initials string, faults string, low long, high long, turns long"


def _segments(most: int):
    def run(batches: Iterator[pa.RecordBatch]):
        part, number, out = TaskContext.get().partitionId(), 0, []
        conv, opened, initials, faults, turns = None, None, "", "", []

        def close(ends: bool) -> None:
            nonlocal number, opened, initials, faults, turns
            if initials:
                known = [t for t in turns if t is not None]
                out.append((conv, part, number, ends and opened is True, initials, faults, known[0] if known else None, known[-1] if known else None, len(set(known))))
                number, opened = number + 1, False
            initials, faults, turns = "", "", []

        for b in batches:
            for c, turn, copies, initial, fault, again in zip(*(b.column(x).to_pylist() for x in ("conv_id", "turn", "copies", "initial", "fault", "again")), strict=True):
                if opened is None or c != conv:
                    close(True)
                    conv, opened = c, opened is not None  # the first conversation may have begun in the partition before
                while copies:
                    n = min(copies, most - len(initials))
                    initials, faults = initials + initial * n, faults + fault + again * (n - 1)
                    turns.append(turn)
                    copies, fault = copies - n, again
                    if len(initials) == most:
                        close(False)
            if out:
                yield batch(_SEGMENT, *zip(*out, strict=True))
                out.clear()
        close(False)  # the last one may go on in the next partition
        if out:
            yield batch(_SEGMENT, *zip(*out, strict=True))

    return run


def _rows(schema: pa.Schema, function: Callable[..., Iterator[tuple]], *columns: str):
    """For mapInArrow: the rows that function makes of each row's columns."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out = [x for row in zip(*(b.column(c).to_pylist() for c in columns), strict=True) for x in function(*row)]
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


_PLAN = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
_PLAN_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _counts(faults: str) -> tuple[int, int, int]:
    return faults.count("b"), faults.count("d"), faults.count("t")


def _whole(conv_id, initials, faults, low, high, turns):
    state, cost, letters = search(initials, faults, 0, END)
    gaps = 0 if low is None else high - low + 1 - turns
    yield conv_id, gaps, *_counts(faults), illegal_pairs(initials), cost + END[state], letters + "I" * (END[state] // INSERT)


def _backward(parts):
    """The cost to go behind each stretch of a conversation."""
    to_go = END
    for k in range(len(parts) - 1, -1, -1):
        p = parts[k]
        yield p["part"], p["number"], list(to_go), k == 0
        to_go = tuple(min(NEVER, *(p["passage"][4 * s + e] + to_go[e] for e in STATES)) for s in STATES)


def _choices(part, number, conv_id, initials, faults, low, high, turns, to_go, first):
    found = [search(initials, faults, s, tuple(to_go)) if s == 0 or not first else (s, NEVER, "") for s in STATES]
    exits, costs, letters = zip(*found, strict=True)
    yield part, number, conv_id, list(exits), list(costs), list(letters), *_counts(faults), illegal_pairs(initials), low, high, turns, initials[0], initials[-1]


def _forward(parts):
    """The entry of each stretch."""
    state = 0
    for p in parts:
        yield p["part"], p["number"], state
        state = p["exits"][state]


def _joined(conv_id, parts):
    """A conversation's row from those of its stretches."""
    gaps, last, letters = None, parts[-1]["exit"], [p["letters"] for p in parts]
    known = [p for p in parts if p["low"] is not None]
    if known:
        distinct = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - distinct
    illegal = sum(p["illegal"] for p in parts) + sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(parts, parts[1:], strict=False))
    yield conv_id, gaps or 0, *(sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")), illegal, sum(p["cost"] for p in parts) + END[last], "".join(letters) + "I" * (END[last] // INSERT)


_BORDER = pa.schema([("part", pa.int32()), ("number", pa.int64()), ("to_go", pa.list_(pa.int64())), ("first", pa.bool_())])
_CHOICE = pa.schema([("part", pa.int32()), ("number", pa.int64()), ("conv_id", pa.int64()), ("exits", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())), ("letters", pa.list_(pa.string())), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")), ("first", pa.string()), ("last", pa.string())])
_CHOICE_SQL = "part int, number long, conv_id long, exits array<int>, costs array<long>, letters array<string>, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, first string, last string"


def _gathered(rows: DataFrame, *columns: str) -> Column:
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "number", *columns))).alias("parts"))


def _of_parts(parts: DataFrame) -> DataFrame:
    """The plans of conversations of several stretches."""
    place = pa.schema([("part", pa.int32()), ("number", pa.int64())])
    costs = pa.schema([*place, ("conv_id", pa.int64()), ("passage", pa.list_(pa.int64()))])
    through = parts.mapInArrow(_rows(costs, lambda p, n, c, i, f: [(p, n, c, passage(i, f))], "part", "number", "conv_id", "initials", "faults"), "part int, number long, conv_id long, passage array<long>")
    borders = _gathered(through, "passage").mapInArrow(_rows(_BORDER, _backward, "parts"), "part int, number long, to_go array<long>, first boolean")
    columns = ("part", "number", "conv_id", "initials", "faults", "low", "high", "turns", "to_go", "first")
    choices = written(parts.join(borders, ["part", "number"]).select(*columns).mapInArrow(_rows(_CHOICE, _choices, *columns), _CHOICE_SQL))
    entry = _gathered(choices, "exits").mapInArrow(_rows(pa.schema([*place, ("entry", pa.int32())]), _forward, "parts"), "part int, number long, entry int")
    pick = [F.get(c, F.col("entry")).alias(name) for c, name in (("exits", "exit"), ("costs", "cost"), ("letters", "letters"))]
    counts = ["blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "first", "last"]
    chosen = choices.join(entry, ["part", "number"]).select("conv_id", "part", "number", *pick, *counts)
    return _gathered(chosen, "exit", "cost", "letters", *counts).select("conv_id", "parts").mapInArrow(_rows(pa.schema(_PLAN), _joined, "conv_id", "parts"), _PLAN_SQL)


def repair_plans(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation with rows (conv_id, turn,
    role, text). gaps: turns missing between the least and the greatest; illegal: pairs of rows that may not follow each
    other; audit: the letters of the edits."""
    faults = written(_faults(_keyed(rows)))
    segments = written(faults.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(tidy(_segments(SEGMENT)), _SEGMENT_SQL))
    drop_written(faults)
    whole = segments.where("whole").mapInArrow(_rows(pa.schema(_PLAN), _whole, "conv_id", "initials", "faults", "low", "high", "turns"), _PLAN_SQL)
    return written(whole.unionByName(_of_parts(segments.where("not whole"))))


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_RESULT = pa.schema([*_PLAN, ("repaired_sha256", pa.string())])


def _role(state: int) -> str:
    """The role that a re-roled or inserted row gets."""
    return "assistant" if state == 2 else "user"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of a sorted stream of a plan and then rows for each conversation: ("plan", its row), each row that remains as
    ("row", letter, turn, role, text), and ("end",)."""
    plan, at, state, conv, begun = None, 0, 0, None, False
    columns = [n for n, _ in _PLAN] + ["kind", "turn", "role", "text"]

    def inserted():
        nonlocal at, state
        while plan and at < len(plan) and plan[at] == "I":
            yield "row", "I", None, _role(state), ""
            at, state = at + 1, NEXT[state]

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
            head, (kind, turn, role, text) = row[: len(_PLAN)], row[len(_PLAN) :]
            if not begun or head[0] != conv:
                if begun:
                    yield from inserted()
                    yield ("end",)
                begun, conv, plan, at, state = True, head[0], head[-1], 0, 0
                yield "plan", head if kind == 0 else (conv, 0, 0, 0, 0, 0, 0, "")
            if kind == 1:
                yield from inserted()
                letter, at = plan[at], at + 1
                if letter != "D":
                    role = role if letter == "K" else _role(state)
                    yield "row", letter, turn, role, text
                    state = KEPT[role[0], state]
    if begun:
        yield from inserted()
        yield ("end",)


def _digest_rows(batches: Iterator[pa.RecordBatch]):
    out, head, digest, empty = [], None, None, True
    for what, *x in _edited(batches):
        if what == "plan":
            head, digest, empty = x[0], hashlib.sha256(), True
        elif what == "row":
            digest.update(("" if empty else "\n").encode() + f"{x[2]}:{x[3]}".encode())
            empty = False
        else:
            out.append((*head, digest.hexdigest()))
            if len(out) == 2000:
                yield batch(_RESULT, *zip(*out, strict=True))
                out = []
    if out:
        yield batch(_RESULT, *zip(*out, strict=True))


def _repaired(batches: Iterator[pa.RecordBatch]):
    out, conv, place, size = [], None, 0, 0
    for what, *x in _edited(batches):
        if what == "plan":
            conv, place = x[0][0], 0
        elif what == "row":
            out.append((conv, place, *x))
            place, size = place + 1, size + len(x[3])
            if size > 2_000_000:
                yield batch(_REPAIRED, *zip(*out, strict=True))
                out, size = [], 0
    if out:
        yield batch(_REPAIRED, *zip(*out, strict=True))


def _stream(rows: DataFrame, plans: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """Plans (kind 0), rows (1) and mere ids (2), together by conversation and in order."""
    out = plans.withColumn("kind", F.lit(0)).unionByName(_keyed(rows).withColumn("kind", F.lit(1)), allowMissingColumns=True)
    if conversations is not None:
        ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        out = out.unionByName(ids.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return out.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "key")


def conversation_repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The columns of repair_plans() and repaired_sha256, the hash of the rows that remain as `role:text`, one a line.
    conversations: a table of conv_id; those without rows get zeros and hashes of nothing."""
    return _stream(rows, repair_plans(rows), conversations).mapInArrow(tidy(_digest_rows), f"{_PLAN_SQL}, repaired_sha256 string")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit (K, R or I), turn, role, text: the rows of all conversations after repair."""
    return _stream(rows, repair_plans(rows), None).mapInArrow(tidy(_repaired), "conv_id long, place long, edit string, turn long, role string, text string")
