"""Conversation repair: paths against all edit sequences, rows against SQL, and awkward tables."""

import hashlib
import itertools
import random

import duckdb
import pytest

from shoalspark.llm import conversations as C
from shoalspark.llm.sql import ORACLES

SCHEMA = "conv_id long, turn long, role string, text string"


def every_path(rows):
    """The cheapest edits by trying all sequences with up to three insertions at each place."""
    best = None
    choices = itertools.product(*[[(n, e) for n in range(4) for e in "DKR"] for _ in rows], [(n, "") for n in range(4)]) if rows else [[(n, "")] for n in range(4)]
    for chosen in choices:
        state, cost, labels = 0, 0, ""
        for row, (inserted, edit) in zip([*rows, None], chosen, strict=True):
            for _ in range(inserted):
                state, cost, labels = C.GRAMMAR[state][C.GIVEN[state][0]], cost + 5, labels + "I"
            if not edit:
                continue
            labels += edit
            if edit == "D":
                cost += 2
                continue
            initial = C.GIVEN[state][0] if edit == "R" else row.lower()
            if row == "!" or initial not in C.GRAMMAR[state]:
                state = None
                break
            state, cost = C.GRAMMAR[state][initial], cost + (edit == "R") + 5 * row.isupper()
        if state in C.ACCEPTED and (best is None or (cost, labels) < best):
            best = cost, labels
    return best


def test_shortest_paths_are_those_of_all_sequences():
    for n in range(4):
        for rows in itertools.product("suaxUAX!", repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product("suaxSUAX!", repeat=3)), 60):
            assert C.shortest("".join(rows)) == every_path("".join(rows)), rows


def test_parts_compose_to_the_whole():
    draw = random.Random(2)
    for _ in range(200):
        rows = "".join(draw.choices("suuuaaaxUA!", k=draw.randrange(1, 40)))
        cuts = sorted(draw.sample(range(len(rows) + 1), min(3, len(rows) + 1)))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        assert C.joined([[C.shortest(p, s, t) for s in C.GRAMMAR for t in C.GRAMMAR] for p in parts]) == C.shortest(rows)


def by_sql(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(map(str, db.execute(f"SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({ORACLES['op11_conversation_repair']})").fetchall()))


def by_spark(df):
    return sorted(str(tuple(r)) for r in C.repair(C.damage(df), df).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect())


AWKWARD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."), (1, 5, "user", "Hello?"), (1, 5, "user", "Hello?"),
    (2, None, "user", "First."), (2, 3, None, "No role."), (2, 4, "", "Empty role."), (2, 4, "tool", "A tool."), (2, 7, "assistant", None),
    (None, 0, "user", "Nameless"), (None, 1, "assistant", "Yes!"), (3, None, None, None), (4, 1, "User", "Upper case."), (4, 2, "agent", "An agent. \t\n"),
    (5, 1, "user", ".\n"), (5, 2, "user", " "), (5, 2, "assistant", "a"), (5, 2, "assistant", "b."), (5, 2, "user", "b."), (6, -3, "assistant", "x" * 100_000 + "."),
]


def test_awkward_rows_equal_the_sql(spark):
    rows = AWKWARD + [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t % 7}.") for c in range(10, 30) for t in range(c % 9)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "'x' as fault", "'y' as audit")
    assert by_spark(df) == by_sql(rows)


def test_a_long_conversation_spans_tasks(spark):
    draw = random.Random(3)
    rows = [(7, t, draw.choice(["user", "assistant", "system", "tool"]), f"Text {draw.randrange(90)}{draw.choice('. ,')}") for t in range(400)] + [(c, 0, "user", "One.") for c in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so small a table is one task's
    try:
        assert by_spark(df) == by_sql(rows)
        assert C.audits(C.faults(C.damage(df))).where("conv_id = 7").count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_turns_have_the_digest(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    rows = C.damage(df)
    turns = {}
    for r in C.repaired_turns(rows).orderBy("conv_id", "position").collect():
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in C.repair(rows, df).collect():
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(turns.get(r["conv_id"], [])).encode()).hexdigest()


def test_an_empty_table_gives_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.repair(C.damage(df), df).count() == 0
    assert C.repaired_turns(C.damage(df)).count() == 0


@pytest.mark.parametrize("state", C.GRAMMAR)
def test_labels_decide_between_arcs(state):
    for row in [None, *"suaxSUAX!"]:
        for inserts in range(C.INSERTS + 1):
            labels = [a[0] for a in C.arcs(row, inserts, state)]
            assert len(labels) == len(set(labels))
