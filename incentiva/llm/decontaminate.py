"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

The benchmark's texts are normalised (ASCII lower case, words joined by one space)
and cut into windows of ``window`` consecutive words; a text of fewer words, but not
none, is one window. All windows become one automaton, which scans each whole
document once in its normalised form; an array maps normalised offsets back to
code points of the original, so every hit is a span of the original text.

The benchmark is a stated query set. Only its distinct windows are sent to the tasks, as text and number; which items a
window belongs to is looked up after the scan, so a window of very many items costs no more. If the windows have more than ``block_bytes`` of text (4 MB,
about 0.2 GB as an automaton), they are dealt by hash into blocks: the documents are
written once with row numbers, each block is a pass of its own that returns only the
rows with hits, and these are merged. So a task holds one block, whatever the benchmark's size.

Defined cases: a null or empty text has no words and no hits; a benchmark row with
null text has no windows; one with a null ``item_id`` marks words as hit but is not
listed as an item; repeated benchmark rows count once per item_id; an empty benchmark
hits nothing. Columns pass through by position, so their
names cannot clash with the operator's.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import BROADCAST_ROWS, Stage, lookup, text_slices, utf8_parts
from .words import LOWER, split_words

WINDOW = 10
BLOCK_BYTES = 4_000_000
#: ASCII characters that end a word, as in the class of WORD.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: What a scan returns of a document; windows: the numbers of those that occur.
SCANNED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("windows", T.ArrayType(T.LongType())),
])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item, pattern): each distinct window of each item, words joined by a space; items as strings."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (words.where(F.size("w") > 0)
            .select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("pattern")).distinct())


class _Automaton:
    """Built once per Python worker and block from the broadcast patterns."""

    kept: dict = {}

    @classmethod
    def of(cls, key: str, patterns: list[tuple[str, int]]):
        if key not in cls.kept:
            import ahocorasick

            cls.kept.clear()  # one block in memory at a time
            a = ahocorasick.Automaton()
            for k, (p, _) in enumerate(patterns):
                # bytes of the pattern as characters 0-255: offsets are byte offsets
                b = p.encode()
                a.add_word((b" " + b + b" ").decode("latin-1"), (len(b) + 1, k))
            a.make_automaton()
            cls.kept[key] = a
        return cls.kept[key]


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Union of half-open intervals, sorted."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _scan(batches: Iterator[pa.RecordBatch], patterns, key: str, text_at: int, keep: list[int], kind: pa.DataType,
          hit_only: bool) -> Iterator[pa.RecordBatch]:
    """The columns ``keep`` and the struct found of each row (or of those with hits only)."""
    block = patterns.value
    automaton = _Automaton.of(key, block) if block else None
    for whole in batches:
        for b in text_slices(whole, text_at):
            rows = _scan_rows(b.column(text_at), automaton, block)
            out = pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(rows, kind)], [f"c{i}" for i in keep] + ["found"])
            yield out.filter(pa.array([bool(r["hits"]) for r in rows], pa.bool_())) if hit_only else out


def _scan_rows(texts: pa.Array, automaton, block) -> list[dict]:
    raw, at = utf8_parts(texts)
    w = split_words(raw, at, hashes=False)
    first = np.zeros(len(at), np.int64)
    np.cumsum(w.count, out=first[1:])
    size = w.end - w.start
    # normalised text of all rows, a space before and after each word and one more between rows
    begin = np.cumsum(size + 1) - size + w.doc
    norm = np.full((int(begin[-1] + size[-1]) if len(size) else 0) + 1, 32, np.uint8)
    norm[_ranges(begin, size)] = LOWER[raw[_ranges(w.start, size)]]
    found: dict[int, list[tuple[int, int]]] = {}
    if automaton is not None:
        for end, (length, k) in automaton.iter(norm.tobytes().decode("latin-1")):
            i = int(np.searchsorted(begin, end - length))  # the word with which the window begins
            found.setdefault(int(w.doc[i]), []).append((i, k))
    points = np.cumsum((raw & 0xC0) != 0x80) if found else None  # code points up to and with each byte
    rows = [{"n_words": n, "hits": [], "spans": [], "windows": []} for n in w.count.tolist()]
    for r, places in found.items():
        f0 = int(first[r])
        zero = int(points[at[r]]) - 1
        hits = _merge([(i - f0, i - f0 + block[k][0].count(" ") + 1) for i, k in places])
        spans = [[int(points[w.start[f0 + s]]) - 1 - zero, int(points[w.end[f0 + e - 1] - 1]) - zero] for s, e in hits]
        rows[r] = {"n_words": int(w.count[r]), "hits": hits, "spans": spans, "windows": sorted({block[k][1] for _, k in places})}
    return rows


def _merged(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The results of a row from several blocks as one."""
    for b in batches:
        out = []
        for parts in b.column("parts").to_pylist():
            pairs = sorted((h, s) for p in parts for h, s in zip(p["hits"], p["spans"]))
            hits, spans = [], []
            for (s, e), (a, z) in pairs:
                if hits and s <= hits[-1][1]:
                    if e > hits[-1][1]:
                        hits[-1][1], spans[-1][1] = e, z
                else:
                    hits.append([s, e])
                    spans.append([a, z])
            out.append({"n_words": parts[0]["n_words"], "hits": hits, "spans": spans, "windows": sorted({w for p in parts for w in p["windows"]})})
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, kind)], ["row", "found"])


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[k], begin[k]+1, ... (size[k] of them) for each k, joined."""
    if not len(size):
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(int(ends[-1])) - np.repeat(ends - size - begin, size)


def _scanned(docs: DataFrame, windows: DataFrame, n_blocks: int, text_at: int, kept: list[int], stage: Stage) -> DataFrame:
    """The columns ``kept`` (c0, c1, ...) of ``docs`` and found, from one pass or one for each block of windows."""
    kind = to_arrow_type(SCANNED)
    spark = docs.sparkSession

    def scan(df: DataFrame, k: int, text: int, keep: list[int], hit_only: bool) -> DataFrame:
        part = windows.where(F.pmod(F.xxhash64("pattern"), F.lit(n_blocks)) == k)
        sent = spark.sparkContext.broadcast([tuple(r) for r in part.select("pattern", "number").collect()])
        schema = T.StructType([df.schema[df.columns[i]] for i in keep] + [T.StructField("found", SCANNED)])
        out = df.mapInArrow(partial(_scan, patterns=sent, key=uuid.uuid4().hex, text_at=text, keep=keep, kind=kind, hit_only=hit_only), schema)
        return out.toDF(*[df.columns[i] for i in keep], "found")

    if n_blocks == 1:
        return scan(docs, 0, text_at, kept, False)
    numbered = stage.put(docs.withColumn("row", F.monotonically_increasing_id()), "documents")
    last = numbered.columns.index("row")
    parts = [stage.put(scan(numbered, k, text_at, [last], True), f"block-{k}") for k in range(n_blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    found = found.groupBy("row").agg(F.collect_list("found").alias("parts")).mapInArrow(
        partial(_merged, kind=kind), T.StructType([T.StructField("row", T.LongType()), T.StructField("found", SCANNED)]))
    found = stage.put(found, "found")
    # rows without a hit still have their number of words
    words = scan_words(F.col(numbered.columns[text_at]))
    nothing = F.struct(words.alias("n_words"), *[F.array().cast(f.dataType).alias(f.name) for f in SCANNED[1:]])
    joined = numbered.join(found, "row", "left")
    return joined.select(*[numbered.columns[i] for i in kept], F.coalesce("found", nothing).alias("found"))


def scan_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  keep: list[str] | None = None, item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, list_items: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and a struct column, found.

    found: n_words; hits, the hit word intervals [start, end); spans, the same as code
    points of the original text; items, the ids (as strings) of items with hits (unless not ``list_items``).
    """
    names, stage = docs.columns, Stage(docs.sparkSession, "decontaminate")
    keep = names if keep is None else keep
    pairs = stage.put(benchmark_windows(benchmark, window, item_col, item_text_col), "pairs")
    windows = stage.put(pairs.select("pattern").distinct().withColumn("number", F.monotonically_increasing_id()), "windows")
    total = windows.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    # by position, so that no column name can clash
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text_at, kept = names.index(text_col), [names.index(c) for c in keep]
    df = df.select(*[F.col(c).cast("string") if i == text_at and text_col not in keep else F.col(c) for i, c in enumerate(df.columns)])
    scanned = _scanned(df, windows, max(1, -(-total // block_bytes)), text_at, kept, stage)
    if not list_items:
        return scanned.toDF(*keep, "found")
    scanned = stage.put(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    # the items of each window that occurs, in one row of a window; rows of hot windows are salted
    hit = stage.put(scanned.where("size(found.windows) > 0").select("row", F.explode("found.windows").alias("number")), "hit")
    items = pairs.where("item is not null").join(windows, "pattern").groupBy("number").agg(F.collect_set("item").alias("items"))
    items = stage.put(items.join(hit.select("number").distinct(), "number", "left_semi"), "items")
    n_items = items.agg(F.sum(F.size("items"))).first()[0] or 0
    listed = lookup(hit, items, ["number"], stage, "items", total=max(n_items, items.count())).where("items is not null") \
        .select("row", F.explode("items").alias("item")).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    listed = stage.put(listed, "listed")
    if (listed.agg(F.sum(F.size("items"))).first()[0] or 0) <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    found = F.struct("found.n_words", "found.hits", "found.spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return scanned.join(listed, "row", "left").select(*[f"c{i}" for i in kept], found.alias("found")).toDF(*keep, "found")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report row of each document from ``decontaminate``'s output."""
    n_hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return found.select(
        id_col, "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without a hit, their columns unchanged."""
    found = decontaminate(docs, benchmark, window, list_items=False)
    names = docs.columns
    flat = found.toDF(*[f"c{i}" for i in range(len(names))], "found").where(F.size("found.hits") == 0)
    return flat.drop("found").toDF(*names)
