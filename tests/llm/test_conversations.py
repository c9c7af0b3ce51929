import hashlib
import random
import re

import pytest

from stintlake.llm import conversations as C
from stintlake.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences

TURNS = "conv_id bigint, turn bigint, role string, text string"


def every_repair(rows):
    """All edit sequences that cost little enough, tried one by one; the cheapest, ASCII-least."""
    best = []

    def go(i, cost, audit, out, inserts):
        if best and (cost, audit) >= best[0][:2] and cost >= best[0][0] + 1:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or " " for r, _ in out)):
            if not best or (cost, audit) < best[0][:2]:
                best[:] = [(cost, audit, out)]
        if inserts < 2:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*out, (role, "")], inserts + 1)
        if i < len(rows):
            role, text, gone, cut = rows[i]
            go(i + 1, cost + 3, audit + "D", out, 0)
            if not gone:
                go(i + 1, cost + cut, audit + "K", [*out, (role, text)], 0)
                for other in ("user", "assistant"):
                    go(i + 1, cost + 2 + cut, audit + "R", [*out, (other, text)], 0)

    # A bound to begin with: everything deleted.
    best.append((3 * len(rows), "D" * len(rows), []))
    go(0, 0, "", [], 0)
    return best[0]


def brute(rows):
    """The row of a conversation from its (turn, role, text) rows, in plain Python."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
    seen, marks, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(C.BLANKS)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marks.append((role, text, fault in (0, 1), int(not bare or bare[-1] not in ".!?")))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [m[0][:1] or " " for m in marks]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, out = every_repair(marks)
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def answer(df):
    solved = C.solve(df)
    digests = {r.conv_id: r.repaired_sha256 for r in C.repaired_digests(df, solved).collect()}
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv_id])
        for r in solved.collect()
    }


@pytest.mark.parametrize("window", [1, 3, 32])
def test_every_edit_sequence(spark, monkeypatch, window):
    monkeypatch.setattr(C, "WINDOW", window)
    dice = random.Random(window)
    roles, texts = ["user", "assistant", "system", "tool", None, ""], ["Yes.", "No!", "Well", " \t", None, "Go? \n", "."]
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(dice.randint(1, 5)):
            rows.append((conv, dice.choice([None, *range(6)]), dice.choice(roles[:3] * 2 + roles), dice.choice(texts)))
    found = answer(spark.createDataFrame(rows, TURNS).repartition(7))
    for conv in [None, *range(60)]:
        assert found[conv] == brute([r[1:] for r in rows if r[0] == conv]), (conv, rows)


def cheapest(marks):
    """Cost and audit of the best repair, state by state."""
    def inserted(table):
        for _ in range(3):
            for s, (cost, audit) in list(table.items()):
                more = (cost + 2, audit + "I")
                table[C._NEXT[s]] = min(table.get(C._NEXT[s], more), more)
        return table

    table = {C.START: (0, "")}
    for initial, gone, cut in marks:
        after = {}
        for s, (cost, audit) in inserted(table).items():
            moves = [(s, (cost + 3, audit + "D"))]
            if not gone:
                moves.append((C._NEXT[s], (cost + 2 + cut, audit + "R")))
                if (s, initial) in C._KEEP:
                    moves.append((C._KEEP[s, initial], (cost + cut, audit + "K")))
            for state, entry in moves:
                after[state] = min(after.get(state, entry), entry)
        table = after
    return min(e for s, e in inserted(table).items() if s in (C.START, C.ASSISTANT))


def test_one_conversation_over_many_tasks(spark):
    """A third of all rows and more in one conversation: its runs are searched apart and joined up."""
    dice = random.Random(5)
    rows = [(9, t, dice.choice(["user", "assistant", "user", "system"]), f"t{t % 2000}{dice.choice('.a')}")
            for t in range(5000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", "Fine.") for c in (1, 20) for t in range(4)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = answer(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen, marks = set(), []
    for _, _, role, text in rows[:5000]:
        marks.append((role[0], (role, text) in seen, text[-1] != "."))
        seen.add((role, text))
    assert found[9][5:7] == cheapest(marks)
    assert found[1][5:7] == (6, "KKDD") and found[20] == found[1]


def test_repaired_turns(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes.")], TURNS
    ).selectExpr("*", "1 AS place", "2 AS edit", "3 AS _first", "4 AS kind", "5 AS digest")
    out = C.repaired_turns(df, C.solve(df)).orderBy("place").collect()
    assert [(r.edit, r.role, r.text) for r in out] == [
        ("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "There."), ("K", "assistant", "Yes."),
    ]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert C.solve(empty).count() == 0 and C.repaired_turns(empty, C.solve(empty)).count() == 0
    long = spark.createDataFrame(
        [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "word " * 400_000 + ".") for t in range(4)], TURNS
    )
    assert answer(long)[1][5:7] == (0, "KKKK")
    copies = spark.createDataFrame([(1, 0, "user", "Same.")] * 500, TURNS)
    assert answer(copies)[1][:7] == (0, 0, 499, 0, 499, 3 * 499 + 2, "K" + "D" * 499 + "I")


def test_bounds_are_never_too_high():
    dice = random.Random(3)
    for _ in range(500):
        marks = [(dice.choice("sua "), dice.random() < 0.2, dice.random() < 0.3) for _ in range(dice.randint(0, 8))]
        assert C.suffix_bounds(marks, "sua")[0] <= cheapest(marks)[0]


def test_query_beside_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    count, bad = differences(
        QUERIES["op11_conversations"](spark, sf), connect(sf), ORACLE["op11_conversations"]
    )
    assert count > 0 and not bad
