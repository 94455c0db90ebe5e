"""Conversation repair against all edits of small conversations, and against a plain table of states."""

import hashlib
import random
import re
import zlib

import pytest

from twinfold.llm import conversation_repair as module
from twinfold.llm.conversation_repair import END, STATES, conversation_repair, passage, repaired_rows, search
from twinfold.llm.digests import damaged

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    out, seen = "", set()
    for _, role, text in rows:
        shown = WORD.findall(text)
        out += "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "."
        seen.add((role, text))
    return out


def plain(rows, faults):
    """cost, letters, lines of the least edits, by the least of each state after each row; no heuristic, no queue."""
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(2):
            for s, (cost, letters, lines) in list(best.items()):
                role, after = ("assistant", 3) if s == 2 else ("user", 2)
                new = (cost + 5, letters + "I", (*lines, f"{role}:"))
                best[after] = min(best.get(after, new), new)
        return best

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for s, (cost, letters, lines) in insert(best).items():
            options = [(cost + 2, letters + "D", lines, s)]
            if fault not in "bd":
                extra = 5 if fault == "t" else 0
                given = "assistant" if s == 2 else "user"
                options.append((cost + 1 + extra, letters + "R", (*lines, f"{given}:{text}"), 3 if s == 2 else 2))
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(s)
                if to is not None:
                    options.append((cost + extra, letters + "K", (*lines, f"{role}:{text}"), to))
            for *x, to in options:
                new[to] = min(new.get(to, tuple(x)), tuple(x))
        best = new
    return min(x for s, x in insert(best).items() if s in (0, 3))


def want(rows):
    """The contract's row but for conv_id. rows: turn, role, text."""
    rows = sorted(([t, r or " ", x or " "] if x != "" and r != "" else [t, r if r is not None else " ", x if x is not None else " "] for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    faults = faults_of(rows)
    cost, letters, lines = plain(rows, faults)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_rows(rng, n):
    """Rows of one conversation; rows of one turn are equal, so that their order does not matter."""
    out, turn = [], rng.randrange(3)
    for _ in range(n):
        row = (rng.choice([None] + [turn] * 9) if not out else turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "Umpire", "", None]), rng.choice(["Yes.", "No!", "What?", "cut off", "cut", "", " \n", None, "Done. \t", f"only {rng.random()}."]))
        out += [row] * rng.choice([1, 1, 1, 1, 2])
        turn += rng.choice([1, 1, 1, 2])
    return out


def test_search_finds_the_least_letters():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), f"{i}.") for i in range(rng.randrange(0, 9))]
        faults = "".join(rng.choice(".....btd") for _ in rows)
        state, cost, letters = search("".join(r[1][0] if r[1][0] in "sua" else "-" for r in rows), faults, 0, END)
        assert (cost + END[state], letters + "I" * (END[state] // 5)) == plain(rows, faults)[:2]


def test_passages_are_least_costs():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 7)
        initials, faults = "".join(rng.choice("sua-") for _ in range(n)), "".join(rng.choice("...btd") for _ in range(n))
        costs = passage(initials, faults)
        for s in STATES:
            for e in STATES:
                only = tuple(0 if x == e else module.NEVER for x in STATES)
                assert min(costs[4 * s + e], module.NEVER) == search(initials, faults, s, only)[1]


@pytest.mark.parametrize("segment", [1, 3, 1024])
def test_conversation_repair(spark, monkeypatch, segment):
    monkeypatch.setattr(module, "SEGMENT", segment)
    rng = random.Random(3)
    held = {c: random_rows(rng, rng.choice([1, 2, 3, 5, 8, 30])) for c in [None, *range(40)]}
    held[40] = [(t, "user" if t % 2 else "assistant", f"{t % 700}.") for t in range(2100)]
    rows = [(c, *r) for c, own in held.items() for r in own]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", key int, part string, copies int").repartition(5)
    ids = spark.createDataFrame([(c,) for c in [*held, 99, 99]], "conv_id long")
    got = conversation_repair(frame, ids).collect()
    assert len(got) == len(held) + 1
    for r in got:
        assert tuple(r)[1:] == want(held.get(r["conv_id"], [])), r["conv_id"]
    lines = {}
    for r in sorted(repaired_rows(frame).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in got:
        assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_ties_of_one_turn_are_settled(spark):
    rows = [(1, 5, "user", "b."), (1, 5, "assistant", "a."), (1, 5, "user", "a."), (1, None, "system", "s.")] * 2
    first = conversation_repair(spark.createDataFrame(rows, SCHEMA).repartition(1)).collect()
    assert conversation_repair(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4)).collect() == first
    assert first[0]["duplicate"] == 4


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_repair(none).count() == 0 and repaired_rows(none).count() == 0


def test_damage(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *range(20)]), rng.choice(["user", "assistant", None]), rng.choice(["A. B! c?", None, "plain"])) for _ in range(400)]
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if code:
            out += [(c, t, "user" if code == 4 else role, "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)] * (2 if code == 3 else 1)
    assert sorted(map(str, damaged(spark.createDataFrame(rows, SCHEMA)).collect())) == sorted(f"Row(conv_id={c!r}, turn={t!r}, role={r!r}, text={x!r})" for c, t, r, x in out)
