"""Conversation repair against all edit scripts of short conversations, and over odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from playlake.llm import conversations as c
from playlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL, BEGUN = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")


def brute_repair(rows):
    """The least (cost, audit, lines) over all edits that give legal roles, those too long left out."""
    fault, least = faults(rows), {}
    todo = [(0, "", 0, "", ())]  # cost, audit, rows done, roles so far, lines
    while todo:
        cost, audit, i, roles, lines = todo.pop()
        if not BEGUN.match(roles) or len(roles) > len(rows) + 2 or least.get((i, roles), (cost, audit + "Z")) < (cost, audit):
            continue
        least[i, roles] = (cost, audit, lines)
        for name in ("user", "assistant"):
            todo.append((cost + 3, audit + "I", i, roles + name[0], (*lines, name + ":")))
        if i < len(rows):
            role, text = rows[i]
            todo.append((cost + 4, audit + "D", i + 1, roles, lines))
            if fault[i] not in ("blank", "duplicate"):
                more = 3 if fault[i] == "truncated" else 0
                for name in ("user", "assistant"):
                    todo.append((cost + 3 + more, audit + "R", i + 1, roles + name[0], (*lines, f"{name}:{text}")))
                todo.append((cost + more, audit + "K", i + 1, roles + (role[:1] or "-"), (*lines, f"{role}:{text}")))
    return min(v for (i, roles), v in least.items() if i == len(rows) and LEGAL.match(roles))


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def spoiled(rows):
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, "user" if kind == 4 else role, text


def brute_report(given, rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in {r[0] for r in given}:
        mine = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in mine} - {None}
        pairs = [r[1:] for r in mine]
        counted = Counter(faults(pairs))
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        cost, audit, lines = brute_repair(pairs)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counted["blank"], counted["duplicate"],
                     counted["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs, longest):
    pick = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", ""], ["Yes.", "No!", "cut", "", " ", "Why?\n", "A. b"]
    return [(conv, turn, pick.choice(roles), pick.choice(texts)) for conv in range(convs) for turn in range(pick.randrange(longest))]


def test_report_equals_brute_force(spark):
    rows = random_rows(1, 150, 6)
    given = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in c.repair_report(c.repaired(given), given).collect()}
    assert got == brute_report(rows, rows)


ODD = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "assistant", None), (1, 0, "user", "Q?"), (1, 0, "user", "Q?"),
       (1, 5, "Assistant", "é."), (2, 0, None, ""), (3, 3, "user", "x" * 100_000), (3, 9, "assistant", "done!"),
       (4, 2, "system", "Be kind."), (4, 2, "assistant", "a."), (4, 7, "assistant", "b.")]


def test_odd_rows(spark):
    given = spark.createDataFrame([(*r, "x", "y") for r in ODD], SCHEMA + ", place string, EDIT string").withColumnRenamed("EDIT", "Text")
    got = {r[0]: tuple(r[1:]) for r in c.repair_report(c.repaired(given), given).collect()}
    assert got == brute_report(ODD, ODD)
    none = given.limit(0)
    assert c.repair_report(c.repaired(none), none).count() == 0


@pytest.mark.parametrize("rows", [ODD, random_rows(2, 60, 6)])
def test_query_on_a_fixture(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got == brute_report(rows, list(spoiled(rows)))


def test_rows_leave_as_soon_as_they_are_settled():
    repair, held = c.Repair(), 0
    pick = random.Random(3)
    for k in range(20_000):
        role = pick.choice("uasx") if k % 3 else "ua"[k % 2]
        list(repair.add((role, k), role, pick.random() < 0.1, pick.random() < 0.2))
        held = max(held, len(repair.open))
    list(repair.end())
    assert held < 100


def test_a_long_conversation_passes_in_order(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(30_000)]
    edits = c.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    assert [r.turn for r in edits] == list(range(30_000)) and {r.edit for r in edits} == {"K"}
