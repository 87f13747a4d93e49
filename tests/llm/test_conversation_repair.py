"""Repairs against a full table of costs and audits, and the query's SQL on odd rows."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pandas as pd
import pytest

import orderloom.llm.conversation_repair as repairs
from orderloom.llm.conversation_repair import Conversation, damaged, repair, repaired_rows, search
from orderloom.llm.queries import CHECKS

WANTED, THEN = "uuau", (2, 2, 3, 2)


def plain(rows):
    """The best (cost, audit) by a table over all places, row after row."""
    best = {0: (0, "")}

    def insert():
        for _ in range(4):
            for place, (cost, audit) in list(best.items()):
                way = (cost + 3, audit + "I")
                best[THEN[place]] = min(best.get(THEN[place], way), way)

    for initial, fault in rows:
        insert()
        after = {}
        for place, (cost, audit) in best.items():
            ways = [(place, cost + 4, "D")]
            if fault != 2:
                extra = 3 if fault else 0
                ways.append((THEN[place], cost + extra + 3, "R"))
                if initial == WANTED[place]:
                    ways.append((THEN[place], cost + extra, "K"))
                if initial == "s" and place == 0:
                    ways.append((1, cost + extra, "K"))
            for to, total, letter in ways:
                after[to] = min(after.get(to, (total, audit + letter)), (total, audit + letter))
        best = after
    insert()
    return min(best[p] for p in (0, 3) if p in best)


@pytest.mark.parametrize("initials,faults", [("uuaast ", (0, 0, 0, 1, 2)), ("ua", (0, 0, 0, 0, 1)), ("st", (0, 1)), ("u", (0,))])
def test_search_finds_the_cheapest_and_least_audit(initials, faults):
    rng = random.Random(initials)
    for size in [*range(12)] * 40 + [200] * 3:
        rows = [(rng.choice(initials), rng.choice(faults)) for _ in range(size)]
        assert search(rows, 0, (0, 3), final=True) == plain(rows)


def test_long_conversations_are_chains_of_searches(monkeypatch):
    rng = random.Random(2)
    for _ in range(150):
        monkeypatch.setattr(repairs, "SEARCH_ROWS", rng.choice([1, 2, 3, 7]))
        talk, rows, seen, lines = Conversation(1, True), [], set(), []
        for i in range(rng.randint(0, 60)):
            role = rng.choice(["user", "assistant", "system", "tool", ""])
            text = rng.choice(["", "a.", "b", f"c{i}.", f"d{i}."])
            talk.add(i, role, text)
            lines.append((role, text))
            fault = 2 if not text or (role, text) in seen else 0 if text[-1] == "." else 1
            seen.add((role, text))
            rows.append((role[:1], fault))
        *_, cost, audit, digest = talk.finish()
        assert (cost, audit) == plain(rows)
        written = [(role, text) for _, _, _, role, text in talk.written]
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in written).encode()).hexdigest()
        roles = "".join(r[0] for r, _ in written)
        assert roles == "" or roles.lstrip("s").replace("ua", "") == "" and roles.count("s") <= 1
        kept = [line for line, edit in zip(lines, audit.replace("I", "")) if edit == "K"]
        assert [w[3:] for w in talk.written if w[2] == "K"] == kept


def odd_rows():
    rng = random.Random(8)
    texts = ["Yes.", "No", "", " \t", None, "Why?\n", "x. ", "é!", "a " * 30_000 + "."]
    rows = [(c if c else None, t if t % 5 else None, rng.choice(["user", "assistant", "system", "tool", None, ""]),
             rng.choice(texts)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(700)]  # one search does not hold it
    return rows + rows[:20] + [(60, None, None, None)] * 3


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, cost string")


def test_query_agrees_with_sql_on_odd_rows(spark):
    rows = odd_rows()
    got = [tuple(r) for r in repair(damaged(frame(spark, rows)), absent="dropped").collect()]
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    want = con.sql(CHECKS["op12_branch_and_bound_repair"]).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(got) == len({r[0] for r in rows})


def test_rows_are_those_of_the_hash(spark):
    talks = damaged(frame(spark, odd_rows()))
    by_id = {}
    for r in sorted(repaired_rows(talks, absent="dropped").collect(), key=lambda r: r.position):
        by_id.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in repair(talks, absent="dropped").collect():
        assert hashlib.sha256("\n".join(by_id.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_empty_table_and_dropped_conversations(spark):
    assert repair(damaged(frame(spark, []))).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, gone boolean")
    row = tuple(repair(gone, absent="gone").first())
    assert row == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
