"""Conversation repair against a plain search, edge cases and the query's SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from airwave.llm import repair
from airwave.llm.queries import QUERIES, oracle_sql

COLUMNS = "conv_id long, turn long, role string, text string, part int, symbols string, alone int, least int"
SF = "/root/testdata/sf0.001"


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's damaged rows."""
    lines = []
    for conv_id, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv_id, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(shown).encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        lines += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    lines.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in lines:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", [])}

    def offer(at, state, way):
        if state not in at or way[:2] < at[state][:2]:
            at[state] = way

    def filled(at):
        """With insertions, as many as may help."""
        at = dict(at)
        for _ in range(4):
            for state, (cost, audit, out) in list(at.items()):
                role = "assistant" if state == "u" else "user"
                offer(at, role[0], (cost + 3, audit + "I", [*out, f"{role}:"]))
        return at

    for (_, role, text), fault in zip(lines, faults, strict=True):
        new = {}
        for state, (cost, audit, out) in filled(best).items():
            offer(new, state, (cost + 4, audit + "D", out))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                if (state, role[:1]) in after:
                    offer(new, after[state, role[:1]], (cost + more, audit + "K", [*out, f"{role}:{text}"]))
                to = "assistant" if state == "u" else "user"
                offer(new, to[0], (cost + 3 + more, audit + "R", [*out, f"{to}:{text}"]))
        best = new
    ends = filled(best)
    cost, audit, out = min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])
    turns = {t for t, _, _ in lines if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_rows(seed, conversations, turns):
    random.seed(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(random.randint(1, turns)):
            role = random.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = random.choice(["Yes.", "No", "Why?", " \t\n", "", None, f"{turn}!", f"{turn} é", "end. \n"])
            rows.append((conv, random.choice([turn, turn, turn, None, turn // 2]), role, text))
    return rows


@pytest.mark.parametrize("most", [1, 3, 4096])
def test_repair_is_the_cheapest_and_first(spark, most):
    rows = random_rows(most, 60, 14)
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], COLUMNS).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repaired(df, most=most).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = plain([r for r in rows if r[0] == conv])
    assert got == want


def test_a_long_conversation_in_many_pieces(spark):
    random.seed(5)
    rows = [(7, t, random.choice(["user", "assistant"]), random.choice(["a.", "b", f"{t}.", f"{t}"])) for t in range(3000)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], COLUMNS)
    (got,) = repair.repaired(df, most=100).collect()
    assert tuple(got)[1:] == plain(rows)


def test_equal_rows_without_end_and_an_empty_table(spark):
    rows = [(1, 0, "user", "hi.")] * 5000 + [(1, 1, "assistant", "yes.")]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], COLUMNS)
    (got,) = repair.repaired(df, most=512).collect()
    assert tuple(got)[1:] == plain(rows)
    assert repair.repaired(df.where("false")).collect() == []


def test_rules_rewrite_without_loss():
    rng = np.random.RandomState(3)
    grammar = repair.Grammar()
    text = np.append(np.concatenate([np.append(rng.randint(0, 3, rng.randint(0, 40)), -1) for _ in range(200)]), [0, 0, 0, 0, 0, -1])
    for _ in range(6):
        now = grammar.rewritten(text)
        symbols = len(repair.SYMBOLS) + len(grammar.rules)
        codes, n = np.unique(repair._pairs(now, symbols), return_counts=True)
        top = sorted(((int(c), int(k)) for c, k in zip(codes, n, strict=True) if c >= 0), key=lambda x: -x[1])
        grammar.add(top)

    def expanded(s):
        return [s] if s < len(repair.SYMBOLS) else [y for x in grammar.rules[s - len(repair.SYMBOLS)] for y in expanded(x)]

    out = grammar.rewritten(text)
    assert [y for s in out.tolist() for y in expanded(s)] == text.tolist() and len(out) < len(text) / 3
    for s, matrix in enumerate(grammar.matrices()):  # a rule's matrix is the product of its rows' matrices
        assert [[e and (e[0], str(e[1])) for e in row] for row in matrix] == [
            [e and (e[0], str(e[1])) for e in row] for row in repair.fold(repair.Grammar(), np.array(expanded(s)), (0, 1, 2, 3))
        ]


def test_ropes_compare_as_their_strings():
    random.seed(4)

    def rope(depth):
        return repair.Rope("".join(random.choices("DK", k=random.randint(0, 2)))) if not depth else repair.Rope(left=rope(depth - 1), right=rope(depth - 1))

    for _ in range(500):
        x, y = rope(random.randint(0, 3)), rope(random.randint(0, 3))
        assert (x < y) == (str(x) < str(y))


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = QUERIES["op12_conversation_repair"](spark, SF)
    cursor = db.execute(oracle_sql()["op12_conversation_repair"])
    names = [c[0] for c in cursor.description]
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(cursor.fetchall())
