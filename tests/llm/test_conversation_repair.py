"""Conversation repair against a plain version (cost to go, then the least edit at each step), blocks, trails, edge cases."""

import hashlib
import random

import pytest

from incentiva.llm import conversation_repair as CR
from incentiva.llm.audit_trail import ROOT, Trail

ROWS = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """The report of one conversation: rows of (turn, role, text), in any order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    togo = {}

    def edits(i, state):
        """(initial, cost, next row, next state)"""
        for new, role in (("u", "user"), ("a", "assistant")):
            if (state, new) in after:
                yield "I", 5, i, new
        if i < len(rows):
            yield "D", 2, i + 1, state
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 * (kinds[i] == "truncated")
                if (state, rows[i][1][:1]) in after:
                    yield "K", more, i + 1, after[state, rows[i][1][:1]]
                for new in "ua":
                    if (state, new) in after:
                        yield "R", 1 + more, i + 1, new

    for i in range(len(rows), -1, -1):
        for s in "sua":
            togo[i, s] = togo[i, ""] = float("inf")
        if i == len(rows):
            togo[i, ""] = togo[i, "a"] = 0
        for _ in range(4):  # insertions stay at a row
            for s in ("", "s", "u", "a"):
                togo[i, s] = min([togo[i, s]] + [c + togo.get((j, t), float("inf")) for _, c, j, t in edits(i, s)])
    i, state, audit, lines, cost = 0, "", "", [], togo[0, ""]
    while i < len(rows) or state not in ("", "a"):
        e, _, j, new = min(x for x in edits(i, state) if x[1] + togo[x[2], x[3]] == togo[i, state])
        role = {"u": "user", "a": "assistant"}.get(new)
        lines += [f"{role}:"] if e == "I" else [f"{rows[i][1] if e == 'K' else role}:{rows[i][2]}"] if e in "KR" else []
        i, state, audit = j, new, audit + e
    initials = [r[1][:1] for r in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def check(spark, rows, **params):
    got = {r["conv_id"]: r.asDict() for r in CR.repair(spark.createDataFrame(rows, ROWS).repartition(5), **params).collect()}
    convs = {}
    for c, *r in rows:
        convs.setdefault(c, []).append(r)
    assert got == {c: {"conv_id": c, **plain(r)} for c, r in convs.items()}


def conversation(rng, n, c):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "u", "Assistant", "", None]
    texts = ["Hello.", "Why?", "no end", "So it is!", " ", "", None, "a\nb.", "é😀.", "x. \t"]
    return [(c, rng.choice([i, i, i, rng.randrange(n), None]), rng.choice(roles[: rng.choice([2, 4, 10])]),
             rng.choice(texts) if rng.random() < 0.5 else f"own {rng.randrange(10 ** 6)}" + rng.choice([".", "", "!"])) for i in range(n)]


@pytest.mark.parametrize("params", [{}, {"block_rows": 3}, {"block_rows": 17, "block_chars": 60}])
def test_random_conversations(spark, params):
    rng = random.Random(11)
    rows = [r for c in range(60) for r in conversation(rng, rng.randrange(1, 30), c)]
    rows += conversation(rng, 400, 1000) + conversation(rng, 25, None)
    rows += rng.sample(rows, 40)
    check(spark, rows, **params)


def test_cases(spark):
    rows = [(1, 0, "assistant", "Only."), (2, None, None, None), (3, 0, "system", "You."), (4, 5, "user", "One."), (4, 5, "user", "One."), (4, 5, "user", "One."),
            (5, 0, "user", "x" * 300_000 + "."), (5, 9, "assistant", " " * 300_000), (6, 0, "user", "A."), (6, 1, "user", "B."), (6, 2, "assistant", "C.")]
    check(spark, rows)
    assert CR.repair(spark.createDataFrame([], ROWS)).collect() == []
    assert CR.report(spark.createDataFrame([], ROWS)).collect() == []


def test_extra_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 7, 1)] * 2000, ROWS + ", n int, part int")
    (row,) = CR.repair(df).collect()
    assert (row["duplicate"], row["illegal"], row["cost"]) == (1999, 1999, 4000) and row["audit"] == "D" * 2000


def test_report_keeps_conversations_without_rows(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(200)]
    got = {r["conv_id"]: r for r in CR.report(spark.createDataFrame(rows, ROWS)).collect()}
    assert set(got) == set(range(200))
    lost = [r for r in got.values() if r["audit"] == ""]
    assert 0 < len(lost) < 40 and all(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() and r["cost"] == 0 for r in lost)


def test_trail_order_is_that_of_strings():
    rng = random.Random(3)
    trail, nodes = Trail(), {ROOT: ""}
    layer = [ROOT]
    for _ in range(70):
        layer = [trail.extend(n, t) for n in rng.sample(layer, min(4, len(layer))) for t in rng.sample(["D", "K", "R", "IK", "IR"], 2)]
        for n in layer:
            nodes[n] = "".join(trail.tokens(n))
        for a in layer:
            for b in layer:
                assert trail.less(a, b) == (nodes[a] < nodes[b])


def test_trail_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr(Trail, "_code", lambda self, token: len(token))
    trail = Trail()
    a, b = trail.extend(ROOT, "D"), trail.extend(ROOT, "R")
    for t in "KDKRKD":
        a, b = trail.extend(a, t), trail.extend(b, t)
    a, b = trail.extend(a, "IR"), trail.extend(b, "D")
    assert trail.less(a, b) and not trail.less(b, a)
