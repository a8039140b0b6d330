"""Repair of conversations, against plain Python."""

import hashlib
import random
import zlib
from functools import cache

import duckdb

from playlake.llm import turn_repair
from playlake.llm.queries import QUERIES
from tests.conftest import SMALL

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        def shown(value):
            return " " if value is None else value
        lot = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if lot == 0:
            continue
        if lot == 1:
            text = ""
        if lot == 2:
            text = "".join(c for c in text if c not in ".!?")
        if lot == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if lot == 3 else 1)
    return out


def plain(rows):
    """Faults and cheapest repair of one conversation's rows (turn, role, text), in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        faults.append(fault)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    n = len(rows)

    @cache
    def best(i, state, inserts):
        """Least (cost, audit, lines) from row i on; state is the initial of the last turn."""
        options = []
        if i == n and state in ("", "a"):
            options.append((0, "", ()))
        new = "a" if state == "u" else "u"
        if inserts < 2:
            cost, audit, lines = best(i, new, inserts + 1)
            options.append((cost + 2, "I" + audit, ({"u": "user", "a": "assistant"}[new] + ":",) + lines))
        if i < n:
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                extra = int(faults[i] == "truncated")
                if initials[i] == new or (initials[i] == "s" and state == ""):
                    cost, audit, lines = best(i + 1, initials[i], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}",) + lines))
                cost, audit, lines = best(i + 1, new, 0)
                options.append((cost + extra + 2, "R" + audit, ({"u": "user", "a": "assistant"}[new] + ":" + text,) + lines))
        return min(options) if options else (10**9, "", ())

    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(initials, initials[1:]))
    for i in range(n, -1, -1):  # from the end on, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damage([r for r in rows if r[0] == conv])]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:16], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        out[conv] = plain(own)
    return out


def test_repair_of_given_conversations(spark):
    rows = duckdb.execute(f"SELECT conv_id, turn, role, text FROM '{SMALL}/conversations.parquet'").fetchall()
    got = QUERIES["op11_turn_repair"](spark, SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected(rows)


def random_rows(n_convs, longest, seed):
    dice = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "so", " \t", "", None, "é…", "a.b"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(n_convs)]:
        for _ in range(dice.randint(1, longest)):
            rows.append((conv, dice.choice([None, *range(6)]), dice.choices(roles, [8, 8, 2, 1, 1, 1, 1])[0], dice.choice(texts) if dice.random() < 0.5 else f"t{dice.random()}."))
    return rows


def run(spark, rows, block):
    df = spark.createDataFrame(rows, SCHEMA)
    _, found = turn_repair.repaired(turn_repair.damaged(df, "conv_id", "turn", "role", "text"), "conv", "turn", "role", "text", block=block)
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def test_ties_nulls_and_conversations_over_many_blocks(spark):
    rows = random_rows(60, 12, 5)
    want = {conv: row for conv, row in expected(rows).items() if any(r[0] == conv for r in damage(rows))}
    assert run(spark, rows, 1 << 16) == want
    assert run(spark, rows, 3) == want


def test_one_conversation_of_all_rows(spark):
    rows = [(7, i, r, x) for i, (_, _, r, x) in enumerate(random_rows(1, 400, 8) * 3)]
    want = expected(rows)
    assert run(spark, rows, 16) == want
    assert run(spark, rows, 1 << 16) == want


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "And?"), (1, 1, "user", "And?"), (1, 2, "tool", "cut")]
    lines, found = turn_repair.repaired(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    assert [r["edit"] for r in lines.orderBy("p").collect()].count("D") == 1
    assert found.first()["cost"] == plain([r[1:] for r in rows])[5]
    text = "\n".join(r["lines"] for r in lines.orderBy("p").collect() if r["lines"] is not None)
    assert hashlib.sha256(text.encode()).hexdigest() == found.first()["repaired_sha256"]


def test_no_conversations_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repaired(empty, "conv_id", "turn", "role", "text")[1].count() == 0
    clash = spark.createDataFrame([("x", 1, "user", "A.", 3, 4)], "key string, p int, place string, digest string, symbol int, block int")
    found = turn_repair.repaired(clash, "key", "p", "place", "digest")[1].first()
    assert (found["key"], found["audit"]) == ("x", "KI")
    long = spark.createDataFrame([(1, 0, "user", "x " * 500_000 + "."), (1, 1, "assistant", " " * 1_000_000)], SCHEMA)
    assert turn_repair.repaired(long, "conv_id", "turn", "role", "text")[1].first()["audit"] == "KDI"
