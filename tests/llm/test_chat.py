"""Chat formatting: the fold against a plain version, reversible escapes, loss masks, edge cases."""

import random

from pyspark.sql import functions as F

from incentiva.llm import chat

EVENTS = "conv bigint, seq bigint, msg bigint, kind string, role string, text string"


def plain_fold(events):
    out = {}
    key = lambda e: (e[1] is not None, e[1] or 0, chat.RANK[e[3]], e[5] or "")
    for c, m in {(e[0], e[2]) for e in events if e[3] in chat.RANK}:
        role, text, live = "", "", True
        for e in sorted((e for e in events if (e[0], e[2]) == (c, m) and e[3] in chat.RANK), key=key):
            if e[3] == "start":
                role = e[4] or ""
            if e[3] == "delta":
                text += e[5] or ""
            elif e[3] == "delete":
                live = False
            else:
                text, live = e[5] or "", True
        if live:
            out[c, m] = (role, text)
    return out


def folded(spark, events):
    return {(r["conv"], r["msg"]): (r["role"], r["text"]) for r in chat.fold(spark.createDataFrame(events, EVENTS).repartition(3)).collect()}


def test_fold(spark):
    rng = random.Random(2)
    events = []
    for c in range(12):
        for s in range(rng.randrange(1, 40)):
            events.append((c, s if rng.random() < 0.95 else rng.randrange(20), rng.randrange(4),
                           rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate", "delete", "other"]), rng.choice(["user", "assistant"]), rng.choice("abcdé")))
    # a deleted message that goes on with deltas stays deleted
    assert folded(spark, events) == {k: v for k, v in plain_fold(events).items()}


def test_cases(spark):
    events = [(1, 1, 1, "start", None, None), (1, 2, 1, "delta", None, "x"), (1, None, 1, "delta", "r", "early"), (None, 1, 1, "start", "user", "n"),
              (2, 1, 1, "start", "user", "gone"), (2, 2, 1, "delete", None, None), (3, 1, 1, "delta", None, "a"), (3, 1, 1, "delta", None, "a"), (4, 1, 1, None, "u", "t")]
    assert folded(spark, events) == {(1, 1): ("", "x"), (None, 1): ("user", "n"), (3, 1): ("", "aa")}
    assert chat.digest(chat.render(chat.fold(spark.createDataFrame([], EVENTS)))).count() == 0


def test_reversible_with_control_strings(spark):
    rng = random.Random(4)
    parts = list(chat.CONTROL) + [chat.TURN, chat.TEXT, chat.END, "\\", "\\\\", "<", "[", "|", ">", "s>", "INST]", "<<", "a", "é😀", "\n", "<\\s>", "/"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    rows = [(i // 3, i % 3, ["user", "assistant", texts[-i - 1][:4]][i % 3], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.render(chat.fold(chat.log_of(df)))
    got = out.select("conv", "formatted", "mask", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"))
    for r in got.collect():
        own = [x for x in rows if x[0] == r["conv"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2], x[3]) for x in own]
        assert r["loss"] == "".join(x[3] for x in own if x[2] == "assistant")
        inside = r["formatted"][len(chat.BEGIN): -len(chat.STOP)]
        for mark in (chat.TURN, chat.TEXT, chat.END):
            assert inside.count(mark) == len(own)
        for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
            assert c not in inside
        assert len(r["mask"]) == sum(x[2] == "assistant" for x in own)


def test_repeated_turns_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, None, "system", "s"), (None, 1, None, "t")], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv"]: [(t["role"], t["text"]) for t in r["turns"]] for r in
           chat.render(chat.fold(chat.log_of(df))).select("conv", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("system", "s"), ("user", ""), ("user", "")], None: [("", "t")]}
