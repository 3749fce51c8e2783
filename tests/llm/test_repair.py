"""Repair of conversations against a search backwards over all edits."""

import hashlib
import random
from functools import cache

import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import repair
from ledgerstrata.llm.repair import Conversation, repair_reports, repaired_turns

BLANKS = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit) of (initial, must go, cut) turns, from the end to the start."""

    after = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}

    @cache
    def rest(i, state, inserted=0):
        found = []

        def then(symbol, cost, *at):
            more = rest(*at)
            if more is not None:
                found.append((cost + more[0], symbol + more[1]))

        if i == len(turns) and state in (0, 3):
            found.append((0, ""))
        for role in "ua":
            if state in after[role] and inserted < 3:
                then("I", 2, i, after[role][state], inserted + 1)
        if i < len(turns):
            initial, gone, cut = turns[i]
            then("D", 3, i + 1, state)
            if not gone:
                if state in after.get(initial, {}):
                    then("K", cut, i + 1, after[initial][state])
                for role in "ua":
                    if state in after[role]:
                        then("R", 2 + cut, i + 1, after[role][state])
        return min(found, default=None)

    return rest(0, 0)


def streamed(turns):
    emitted = []
    now = Conversation(lambda *edit: emitted.append(edit))
    for initial, gone, cut in turns:
        fault = repair.BLANK if gone else repair.CUT if cut else repair.SOUND
        now.add(None, "sua?".index(initial), fault, initial.encode(), b"text")
    cost = now.end()
    return (cost, now.audit.decode()), emitted


def test_random_conversations_equal_the_search_backwards():
    rng = random.Random(5)
    for _ in range(3000):
        weights = rng.choice([(1, 1, 1, 1), (0, 1, 1, 0), (3, 1, 1, 0), (0, 1, 0, 3)])
        turns = [
            (rng.choices("sua?", weights)[0], rng.random() < 0.3, int(rng.random() < 0.3))
            for _ in range(rng.randint(0, 7))
        ]
        got, emitted = streamed(turns)
        assert got == cheapest(turns), turns
        roles = "".join(e[1].decode()[0] for e in emitted if e[0] != ord("D"))
        body = roles[1:] if roles[:1] == "s" else roles
        assert body == "ua" * (len(body) // 2) and (body or not roles)


def test_unresolved_edits_stay_few_and_memory_small():
    now = Conversation(lambda *edit: None)
    most = 0
    for i in range(20_000):
        now.add(i, (repair.U, repair.A)[i % 2] if i % 7 else repair.S, repair.CUT if i % 5 == 0 else 0, b"x", b"y")
        most = max(most, len(now.waiting))
    assert most < 20
    # Roles that fit nowhere leave two readings open to the end: a few nodes, one byte per edit.
    now = Conversation(lambda *edit: None)
    for i in range(20_000):
        now.add(i, repair.OTHER, repair.SOUND, b"tool", b"y")
    nodes = {id(n) for leaf in now.search.leaves.values() for n in now.search._path(leaf)}
    assert len(nodes) <= 7
    assert now.end() == 40_000 and len(now.audit) == 20_000


def plain_report(rows):
    """The report of one conversation from (turn, role, text) rows, None for NULL."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        shown = text.strip(BLANKS)
        blank, again, cut = not shown, (role, text) in seen, shown[-1:] not in (".", "!", "?")
        seen.add((role, text))
        fault = 0 if blank else 1 if again else 2 if cut else None
        if fault is not None:
            counts[fault] += 1
        turns.append((role[:1] if role[:1] in ("s", "u", "a") else "?", blank or again, int(cut and not blank and not again)))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = cheapest(turns)
    out, waiting, user = [], iter(rows), True
    for edit in audit:
        row = None if edit == "I" else next(waiting)
        if edit == "D":
            continue
        if edit == "K" and row[1][:1] == "s" and not out:
            out.append(f"{row[1]}:{row[2]}")
            continue
        role = row[1] if edit == "K" else "user" if user else "assistant"
        user = not user
        out.append(f"{role}:{row[2] if row else ''}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, digest), out


SCHEMA = "conv_id long, turn long, role string, text string"
ODD = {
    1: [(0, "system", "S."), (1, "user", "Hi."), (2, "assistant", "Yes"), (4, "assistant", "No."), (4, "assistant", "No.")],
    2: [(None, None, None), (0, None, "é."), (0, "tool", "x!"), (1, "", "y?\n\x0b")],
    3: [(0, "user", ""), (1, "user", " \t\r"), (2, "user", None)],
    4: [(0, "user", "word " * 50_000), (0, "user", "word " * 50_000)],
    5: [(i, "User" if i % 3 else "u", "same.") for i in range(6)],
    None: [(3, "system", "a."), (1, "user", " "), (2, "assistant", "b.")],
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(c, *r) for c, turns in ODD.items() for r in turns]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("here", F.lit(True))
    gone = spark.createDataFrame([(9, 0, "user", "Away.")], SCHEMA).withColumn("here", F.lit(False))
    for name in ("fault", "initial", "place", "present", "audit", "_id"):
        df, gone = df.withColumn(name, F.lit("extra")), gone.withColumn(name, F.lit("extra"))
    return df.unionByName(gone).repartition(4)


def test_odd_conversations(odd):
    got = {r[0]: tuple(r)[1:] for r in repair_reports(odd, present="here").collect()}
    want = {c: plain_report(turns)[0] for c, turns in ODD.items()}
    want[9] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_repaired_turns_are_what_the_report_digests(odd):
    edits = repaired_turns(odd, present="here").orderBy("conv_id", "position").collect()
    for conv, turns in ODD.items():
        own = [r for r in edits if r.conv_id == conv]
        report, lines = plain_report(turns)
        assert "".join(r.edit for r in own) == report[6]
        assert [r.position for r in own] == list(range(1, len(own) + 1))
        assert [f"{r.role}:{r.text}" for r in own if r.edit != "D"] == lines


def test_empty_table_and_one_shuffle(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_reports(empty).collect() == [] and repaired_turns(empty).collect() == []
    plan = repair_reports(empty)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_hot_conversation_of_many_turns(spark):
    """A third of all rows in one conversation, with thousands of repeats."""
    hot = spark.range(30_000).selectExpr(
        "1 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "if(id % 3 = 0, 'again.', concat('text ', id, '.')) AS text",
    )
    rest = spark.range(60_000).selectExpr(
        "2 + id div 2 AS conv_id", "id % 2 AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "concat('text ', id, '.') AS text",
    )
    reports = {r.conv_id: r for r in repair_reports(hot.union(rest)).collect()}
    assert len(reports) == 30_001
    assert reports[1].duplicate == 10_000 - 2 and reports[1].audit.count("D") >= 9_998
    assert {(r.cost, r.audit) for c, r in reports.items() if c != 1} == {(0, "KK")}
