"""Chat formatting by event sourcing. DataFrame functions only.

A log has one event a row: conversation, sequence number, message number, kind, role, text.
Kinds: ``start`` opens a message with a role (its text begins it), ``delta`` appends, ``edit`` replaces what
is there so far, ``regenerate`` discards it (its text begins the new version), ``delete`` removes the message; a later
start, edit or regenerate brings it back. Other kinds are ignored.

Events are partitioned by conversation, sorted by sequence, folded into final messages, and rendered:

    <s><|turn|>role<|text|>text<|end|><|turn|>...<|end|></s>

Control strings inside roles and texts get a backslash after their first character, and every backslash is
doubled; so no control string is left in them, and ``unescape`` gives the exact text back. The loss mask is
a list of code point intervals of the rendered string: the texts of assistant turns, without markers.

One row is one rendered conversation, so the largest group that a task gathers is one conversation's events, which the
result has to hold in one cell anyway; messages are folded before the conversation is put together.

Defined cases: null role or text is empty; events of equal sequence number are ordered start, edit or regenerate, delta, delete, then by
text; a null sequence number comes first; repeated events count each time; conversations whose messages are all deleted have no row;
a null conversation id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's marks, and control strings of common templates.
BEGIN, TURN, TEXT, END, STOP = "<s>", "<|turn|>", "<|text|>", "<|end|>", "</s>"
CONTROL = ("<s>", "</s>", "<|", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
RANK = {"start": 0, "edit": 1, "regenerate": 1, "delta": 2, "delete": 3}

_FIRST = "|".join(rf"{q[0]}(?={q[1]})" for q in ((f"\\{c[0]}" if c[0] in "[" else c[0], c[1:].translate(
    {ord(x): f"\\{x}" for x in "[]|"})) for c in CONTROL))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _FIRST, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """From columns conv, seq, msg, kind, role, text: conv, msg, role, text of the final messages."""
    rank = F.lit(None).cast("int")
    for kind, r in RANK.items():
        rank = F.when(F.col("kind") == kind, r).otherwise(rank)
    e = events.select("conv", "msg", F.struct("seq", rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"),
                                              F.coalesce("role", F.lit("")).alias("role")).alias("e")).where("e.rank is not null")
    found = e.groupBy("conv", "msg").agg(F.sort_array(F.collect_list("e")).alias("es"))
    found = found.withColumn("at", F.array_max(F.transform(F.col("es"), lambda x, i: F.when(x["rank"] < 2, i))))
    # events from the last start, edit or regenerate on; without any, from the beginning
    found = found.withColumn("live", F.when(F.col("at").isNull(), F.col("es")).otherwise(F.slice("es", F.col("at") + 1, F.size("es"))))
    role = F.filter("es", lambda x: x["rank"] == 0)
    return found.where(~F.exists("live", lambda x: x["rank"] == 3)).select(
        "conv", "msg", F.coalesce(F.get(role, F.size(role) - 1)["role"], F.lit("")).alias("role"),
        F.array_join(F.transform("live", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv, formatted, mask (array of s, e: code points, end exclusive) from final messages."""
    m = messages.withColumns({"head": F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)), "body": escape(F.col("text"))})
    m = m.withColumns({"h": F.length("head"), "b": F.length("body")})
    before = Window.partitionBy("conv").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    at = F.lit(len(BEGIN)) + F.coalesce(F.sum(F.col("h") + F.col("b") + len(END)).over(before), F.lit(0)) + F.col("h")
    span = F.when(F.col("role") == "assistant", F.struct(at.alias("s"), (at + F.col("b")).alias("e")))
    m = m.select("conv", F.struct("msg", F.concat("head", "body", F.lit(END)).alias("t"), span.alias("span")).alias("x"))
    all_ = m.groupBy("conv").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return all_.select("conv", F.concat(F.lit(BEGIN), F.array_join("xs.t", ""), F.lit(STOP)).alias("formatted"),
                       F.filter("xs.span", lambda s: s.isNotNull()).alias("mask"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a rendered conversation."""
    inner = F.substring(formatted, len(BEGIN) + 1, F.length(formatted) - len(BEGIN) - len(STOP))
    turns = F.split(inner, END.replace("|", r"\|"))
    fields = F.transform(F.slice(turns, 1, F.size(turns) - 1), lambda t: F.split(
        F.substring(t, len(TURN) + 1, F.length(t)), TEXT.replace("|", r"\|")))
    return F.transform(fields, lambda f: F.struct(unescape(f[0]).alias("role"), unescape(f[1]).alias("text")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(
        F.substring(formatted, s["s"].cast("int") + 1, (s["e"] - s["s"]).cast("int")))), "")


def log_of(conversations: DataFrame) -> DataFrame:
    """A log that ends in the given turns (conv_id, turn, role, text), with streamed halves, edits and regenerations on the way."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("conv"), "turn", F.col("role").cast("string").alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("msg", F.row_number().over(order).cast("bigint"))
    half = F.floor(F.length("text") / 2).cast("int")
    a, b = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))

    def event(i: int, kind: str, text: Column) -> Column:
        return F.struct((F.col("msg") * 8 + i).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    none = F.lit("")
    streamed = F.array(event(0, "start", none), event(1, "delta", b), event(2, "regenerate", none), event(3, "delta", a), event(4, "delta", b))
    typed = F.array(event(0, "start", F.lit("?")), event(1, "edit", a), event(2, "delta", b))
    return rows.select("conv", "msg", "role", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(typed)).alias("e")) \
        .select("conv", "msg", "role", "e.*")


def digest(rendered: DataFrame) -> DataFrame:
    """The report row of each conversation, read back from the rendered string."""
    r = rendered.select("conv", "formatted", read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("mask")).alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return r.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
