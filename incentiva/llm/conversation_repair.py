"""Conversation structure repair: the cheapest edits that give turns (system, then) user, assistant, user, ...

Rows of a conversation are taken by turn (nulls first), then role, then SHA-256 of the text. A row's first fault counts: blank
(only white space), duplicate (role and text seen earlier), truncated (no full stop, exclamation or question mark at its
end). Edits: keep 0, change the role to user or assistant 1, delete 2 (required of blank and duplicate
rows), insert an empty turn 5; a truncated row that stays costs 5. Of the cheapest edits the
audit, their initials in order (D, I, K, R), is the ASCII-least one.

1. Equal rows (conversation, turn, role, text) become one with a count, so repeats are collapsed before any shuffle
   by order. Duplicates of other turns are found by a lookup of the first turn of (conversation, role, text).
2. Rows are range-partitioned by conversation and place, so a conversation with a third of all rows is many
   partitions, and streamed in order. A task cuts blocks of at most BLOCK_ROWS rows or BLOCK_CHARS of text.
3. Audit DP over a block: for each state of the grammar the cheapest audit, as a node of a ``Trail``
   (shared prefixes, binary-lifting ancestors, rolling hashes; ties by a longest-common-prefix search). An insertion directly before a deletion is
   never least, so every row gives one token of edits, none of which begins another: of two equally
   dear audits in one state the lesser stays the lesser whatever follows.
4. A conversation that lies in one block is finished there. Of others each block gives its best audit from each state to
   each state; a second trail over blocks, streamed per conversation, chooses among them, and the chosen
   texts are hashed as a stream. Only the audit itself, which the result holds, grows with a conversation.

Defined cases: null role or text is one space; a null conversation id is a conversation; a null turn comes first and
takes no part in gaps; repeated rows are duplicates of each other; the role's initial is its first character;
an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audit_trail import ROOT, Trail
from .common import Stage, lookup

BLOCK_ROWS = 2048
BLOCK_CHARS = 1_000_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar (s?(ua)+)? by what stands last: nothing, system, user, assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The edits that end a conversation in each state.
ENDING = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
SPACE = "\\x20\\x09-\\x0D"
LEGAL = ("su", "ua", "au")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: by crc32 of ``conv_id:turn`` modulo 20 rows are dropped, emptied, cut, repeated or given role user."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(own[0], F.lit(":"), own[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def faults(rows: DataFrame, stage: Stage) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, th) with their number n, and blank, repeated (seen at an earlier turn), cut (truncated)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = stage.put(rows.select("*", F.sha2("text", 256).alias("th"), F.sha2(whole, 256).alias("rh"), blank.alias("blank"),
                                 F.col("text").rlike(f"[^.!?{SPACE}][{SPACE}]*\\z").alias("cut")), "rows")
    # the first turn, nulls first, of what stands at more than one
    first = rows.where("not blank").groupBy("conv_id", "rh").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"), F.count("*").alias("turns")).where("turns > 1")
    first = stage.put(first.select(F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("conv_id").isNull()).alias("ch"),
                                   "rh", "none", "least"), "firsts")
    rows = rows.withColumn("ch", F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("conv_id").isNull()))
    later = F.coalesce(F.when(F.col("none"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least")), F.lit(False))
    return lookup(rows, first, ["ch", "rh"], stage, "firsts").select(
        "conv_id", "turn", "role", "text", "th", "n", "blank", (later & ~F.col("blank")).alias("repeated"), "cut")


def _after(state: int, initial: str) -> int | None:
    """The state after a turn with this initial, None if it is not allowed."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _next(state: int) -> int:
    """The state after the user or assistant turn that may follow."""
    return ASSISTANT if state == USER else USER


def _moves(state: int, initial: str, n: int, forced: bool, cut: bool) -> Iterator[tuple[int, int, str]]:
    """(state, cost, token) of each edit of a row that stands n times: its repeats are deleted."""
    yield state, DELETE * n, "D" * n
    if forced:
        return
    rest, cost = "D" * (n - 1), DELETE * (n - 1) + TRUNCATED * cut
    for add, at in ((0, state), (1, _next(state))):
        head, more = "I" * add, INSERT * add
        kept = _after(at, initial)
        if kept is not None:
            yield kept, cost + more + KEEP, f"{head}K{rest}"
        yield _next(at), cost + more + REROLE, f"{head}R{rest}"


def _better(trail: Trail, best: dict, state: int, cost: int, node: int, token: str) -> None:
    """Keep the cheapest, then ASCII-least way to ``state``: (cost, node it extends, token, node or None)."""
    old = best.get(state)
    if old is not None and old[0] < cost:
        return
    if old is not None and old[0] == cost:
        if old[3] is None:
            old = best[state] = (*old[:3], trail.extend(old[1], old[2]))
        new = trail.extend(node, token)
        if trail.less(new, old[3]):
            best[state] = (cost, node, token, new)
        return
    best[state] = (cost, node, token, None)


def _settled(trail: Trail, best: dict) -> dict[int, tuple[int, int]]:
    return {s: (c, trail.extend(up, token) if node is None else node) for s, (c, up, token, node) in best.items()}


def block_paths(rows: list[tuple], entry: int) -> list[tuple[int, int, str]]:
    """(exit, cost, audit) of the best edits of rows (initial, n, forced, cut) from a state to each other."""
    trail = Trail()
    now = {entry: (0, ROOT)}
    for initial, n, forced, cut in rows:
        best: dict = {}
        for state, (cost, node) in now.items():
            for to, more, token in _moves(state, initial, n, forced, cut):
                _better(trail, best, to, cost + more, node, token)
        now = _settled(trail, best)
    return [(state, cost, "".join(trail.tokens(node))) for state, (cost, node) in now.items()]


def finish(paths: list[tuple[int, int, str]]) -> tuple[int, str]:
    """(cost, audit) of the best way to end a conversation whose rows gave these paths."""
    return min((cost + INSERT * len(ENDING[state]), audit + ENDING[state]) for state, cost, audit in paths)


def repaired(rows: list[tuple], audit: str, state: int) -> tuple[list[str], int]:
    """Lines ``role:text`` that the audit makes of rows (role, text, n), and the state after them."""
    lines, source = [], ((role, text) for role, text, n in rows for _ in range(n))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(source)
        if edit == "D":
            continue
        state = _after(state, role[:1]) if edit == "K" else _next(state)
        if edit != "K":
            role = "assistant" if state == ASSISTANT else "user"
        lines.append(f"{role}:{text}")
    return lines, state


_PATHS = "array<struct<entry: int, exit: int, cost: bigint, audit: string>>"
_ROWS = "array<struct<role: string, text: string, n: bigint>>"
_RESULT = "cost bigint, audit string, repaired_sha256 string, illegal bigint"
_BLOCKS = f"part int, ord int, done boolean, {_RESULT}, first string, last string, paths {_PATHS}, rows {_ROWS}"


def _arrow_paths():
    return pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _arrow_rows():
    return pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64())]))


_KINDS = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]


def _emit(out: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *[c.split()[0] for c in _BLOCKS.split(", ")[:9]], "paths", "rows"]
    kinds = [key, *_KINDS, _arrow_paths(), _arrow_rows()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)


class _Cutter:
    """Collects the rows of one conversation in order and turns them into result rows."""

    def __init__(self, part: int, block_rows: int, block_chars: int):
        self.block_rows, self.block_chars = block_rows, block_chars
        self.part, self.ord, self.rows, self.chars, self.conv = part, 0, [], 0, None
        self.opened = self.began = False  # began: its first row was seen in this partition

    def add(self, role, text, n, blank, again, cut):
        forced = blank or again
        self.rows.append((role, "" if forced else text, n, forced, cut))
        self.chars += 0 if forced else len(text)

    def full(self) -> bool:
        return len(self.rows) >= self.block_rows or self.chars >= self.block_chars

    def block(self, ended: bool) -> tuple:
        """The rows so far as a finished conversation, or as a block of one."""
        rows, self.rows, self.chars = self.rows, [], 0
        initials = [r[0][:1] for r in rows]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])) + sum(r[2] - 1 for r in rows)
        steps = [(r[0][:1], *r[2:]) for r in rows]
        if self.began and not self.opened and ended:
            paths = block_paths(steps, EMPTY)
            cost, audit = finish(paths)
            lines, _ = repaired([r[:3] for r in rows], audit, EMPTY)
            return (self.conv, self.part, 0, True, cost, audit, sha256("\n".join(lines).encode()).hexdigest(), illegal, None, None, None, None)
        entries = (EMPTY,) if self.began and not self.opened else (EMPTY, SYSTEM, USER, ASSISTANT)
        paths = [{"entry": e, "exit": x, "cost": c, "audit": a} for e in entries for x, c, a in block_paths(steps, e)]
        self.opened, self.ord = True, self.ord + 1
        kept = [{"role": r[0], "text": r[1], "n": r[2]} for r in rows]
        return (self.conv, self.part, self.ord, False, None, None, None, illegal, initials[0], initials[-1], paths, kept)


def _cut_blocks(batches: Iterator[pa.RecordBatch], key: pa.DataType, block_rows: int, block_chars: int) -> Iterator[pa.RecordBatch]:
    cutter, seen = _Cutter(TaskContext.get().partitionId(), block_rows, block_chars), False
    out: list[tuple] = []
    for batch in batches:
        for s in range(0, batch.num_rows, 1000):
            b = batch.slice(s, 1000)
            for conv, *row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "n", "blank", "repeated", "cut"))):
                if not seen or conv != cutter.conv:
                    if seen:
                        out.append(cutter.block(True))
                    cutter.conv, cutter.opened, cutter.began, seen = conv, False, seen, True
                elif cutter.full():
                    out.append(cutter.block(False))
                cutter.add(*row)
            if out:
                yield _emit(out, key)
                out = []
    if seen:
        yield _emit([cutter.block(False)], key)


_CHOICES = "part int, ord int, entry int, piece string, final boolean, cost bigint, illegal bigint"


def _choose(batches: Iterator[pa.RecordBatch], key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each block of the conversations, streamed in order, the entry state and audit of the cheapest way through all."""
    names = ["conv_id", *[c.split()[0] for c in _CHOICES.split(", ")]]
    kinds = [key, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]

    def chosen(conv, blocks, trail, now, illegal):
        ends = []
        for state, (cost, node) in now.items():
            # the last block's token, with what ends the conversation
            ends.append((cost + INSERT * len(ENDING[state]), state, node))
        low = min(e[0] for e in ends)
        best = None
        for cost, state, node in ends:
            if cost == low and (best is None or trail.less(node, best[1])):
                best = (state, node)
        state, node = best
        pieces = trail.tokens(node)
        entry, rows = EMPTY, []
        for k, ((part, ord_, steps), piece) in enumerate(zip(blocks, pieces)):
            last = k == len(blocks) - 1
            rows.append((conv, part, ord_, entry, piece + (ENDING[state] if last else ""), last, low if last else None, illegal if last else None))
            entry = steps[entry, piece]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    seen, conv = False, None
    blocks, trail, now, illegal, last = [], Trail(), {}, 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            c, part, ord_, more, first, end, paths = (batch.column(x)[i].as_py() for x in ("conv_id", "part", "ord", "illegal", "first", "last", "paths"))
            if not seen or c != conv:
                if seen:
                    yield chosen(conv, blocks, trail, now, illegal)
                seen, conv = True, c
                blocks, trail, now, illegal, last = [], Trail(), {EMPTY: (0, ROOT)}, 0, None
            illegal += more + (last is not None and last + first not in LEGAL)
            last = end
            best: dict = {}
            for p in paths:
                if p["entry"] in now:
                    cost, node = now[p["entry"]]
                    _better(trail, best, p["exit"], cost + p["cost"], node, p["audit"])
            now = _settled(trail, best)
            blocks.append((part, ord_, {(p["entry"], p["audit"]): p["exit"] for p in paths}))
    if seen:
        yield chosen(conv, blocks, trail, now, illegal)


def _block_text(batches: Iterator[pa.RecordBatch], key: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "part", "ord", "piece", "final", "cost", "illegal", "out"]
    for b in batches:
        for i in range(b.num_rows):
            rows = [(r["role"], r["text"], r["n"]) for r in b.column("rows")[i].as_py()]
            lines, _ = repaired(rows, b.column("piece")[i].as_py(), b.column("entry")[i].as_py())
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in names[:-1]), pa.array(["\n".join(lines)], pa.string())], names)


def _joined(batches: Iterator[pa.RecordBatch], key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation from its blocks in order; texts pass through, never kept."""
    audit, digest, begun = [], sha256(), False
    for b in batches:
        for i in range(b.num_rows):
            audit.append(b.column("piece")[i].as_py())
            out = b.column("out")[i].as_py()
            if out:
                digest.update((("\n" if begun else "") + out).encode())
                begun = True
            if b.column("final")[i].as_py():
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id").slice(i, 1), b.column("cost").slice(i, 1), pa.array(["".join(audit)], pa.string()),
                     pa.array([digest.hexdigest()]), b.column("illegal").slice(i, 1)], ["conv_id", "cost", "audit", "repaired_sha256", "illegal"])
                audit, digest, begun = [], sha256(), False


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    stage = Stage(rows.sparkSession, "conversation-repair")
    kind = rows.schema["conv_id"].dataType.simpleString()
    key = rows.sparkSession.createDataFrame([], f"conv_id {kind}").toArrow().schema.field(0).type
    found = stage.put(faults(rows, stage), "faults")
    ordered = found.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "th") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "th")
    blocks = stage.put(ordered.select("conv_id", "role", "text", "n", "blank", "repeated", "cut").mapInArrow(
        lambda b: _cut_blocks(b, key, block_rows, block_chars), f"conv_id {kind}, {_BLOCKS}"), "blocks")
    result = blocks.where("done").select("conv_id", *[c.split()[0] for c in _RESULT.split(", ")])
    long = blocks.where("not done")
    in_order = lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "ord")
    choices = stage.put(in_order(long.select("conv_id", "part", "ord", "illegal", "first", "last", "paths")).mapInArrow(
        lambda b: _choose(b, key), f"conv_id {kind}, {_CHOICES}"), "choices")
    texts = long.select("part", "ord", "rows").join(choices, ["part", "ord"]).select(
        "conv_id", "part", "ord", "entry", "piece", "final", "cost", "illegal", "rows")
    texts = texts.mapInArrow(lambda b: _block_text(b, key),
                             f"conv_id {kind}, part int, ord int, piece string, final boolean, cost bigint, illegal bigint, out string")
    result = result.union(in_order(texts).mapInArrow(lambda b: _joined(b, key), f"conv_id {kind}, {_RESULT}"))
    repeats = F.when(F.col("blank"), 0).when(F.col("repeated"), F.col("n")).otherwise(F.col("n") - 1)
    counts = found.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).cast("long").alias("blank"), F.sum(repeats).cast("long").alias("duplicate"),
        F.sum((F.col("cut") & ~F.col("blank") & ~F.col("repeated")).cast("long")).alias("truncated"))
    parts = counts.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _RESULT.split(", ")]).unionByName(
        result, allowMissingColumns=True)
    return parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])


def report(conversations: DataFrame) -> DataFrame:
    """The contract's rows: every conversation, its rows damaged and repaired; zeros where no row is left."""
    found = repair(damaged(conversations))
    names = found.columns[1:]
    every = conversations.select("conv_id").distinct().select(
        "conv_id", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in names])
    empty = {"audit": "", "repaired_sha256": sha256(b"").hexdigest()}
    return every.union(found).groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(empty.get(c, 0))).alias(c) for c in names])
