"""Filter interaction audit: what each filter removes, alone and after the others, in every order.

1. Facts: one row per document with its part, the filters it fails and its quality labels, written
   once with a row number (doc_id may be null or repeat, so row numbers are the ids of the lists).
2. Posting lists: per part and range of RANGE row numbers, the sorted row numbers that fail each
   filter, and those labelled good or toxic. A part with a third of all rows is many ranges.
3. Per range, unions of the lists of every set of filters are merged, a list at a time, and a filter's list less the
   union of those before it is what it removes. In each merge the ids of the shorter list leap into the longer one by
   binary search (galloping), so a short list against a long one costs little.
4. The sizes are summed per part, filter and set of earlier filters (80 numbers per range, with map-side
   sums), and the 120 orders are read from them: what a filter removes depends only on the set before it.

``FILTERS`` gives each filter's condition of failure over columns text and words; the E of the contract, a text
that a smaller doc_id has, needs the whole table and is found by SHA-256 of the text.

Defined cases: null text is empty; a null source is the part '' (as an empty one); a document is each row,
also if its doc_id is null or repeats; a null doc_id is neither smaller nor larger than another; a document
is good (toxic) if any of its label rows says 1; an empty table has no part and gives no row.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, lookup

SPACE = "[\\x20\\x09-\\x0D]+"
#: Condition of failure by letter, over the columns text and words (an array).
FILTERS = {
    "A": "size(words) < 50",
    "B": "100L * size(array_distinct(words)) < 65L * size(words)",
    "C": "100L * length(regexp_replace(text, '[^A-Z]+', '')) > 5L * length(text)",
    "D": "text rlike '[#$%&*|]'",
}
REPEATED = "E"
LETTERS = (*FILTERS, REPEATED)
#: Row numbers of a range; its lists are what a task holds at once.
RANGE_BITS = 16
LABELS = ("good", "toxic")


def facts(docs: DataFrame, labels: DataFrame, stage: Stage) -> DataFrame:
    """(part, A..E, good, toxic, row), written: row is a number unique in the table."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.col("text"), SPACE), "")
    base = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text")).withColumn("words", words)
    base = stage.put(base.select("doc_id", "part", F.sha2("text", 256).alias("copy"), *[F.expr(c).alias(k) for k, c in FILTERS.items()]), "single")
    first = stage.put(base.groupBy("copy").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                      .where("first < last").select("copy", "first"), "copies")
    said = stage.put(labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")), "labels")
    rows = stage.put(lookup(base, first, ["copy"], stage, "copies").select(
        "doc_id", "part", *FILTERS, F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias(REPEATED)), "repeated")
    rows = lookup(rows, said, ["doc_id"], stage, "labels")
    return stage.put(rows.select("part", *LETTERS, *[F.coalesce(c, F.lit(False)).alias(c) for c in LABELS],
                                 F.monotonically_increasing_id().alias("row")), "facts")


def posting_lists(found: DataFrame, range_bits: int = RANGE_BITS) -> DataFrame:
    """(part, range, n, A..E, good, toxic): the sorted row numbers of each list; n: documents of the part in the range."""
    lists = [F.sort_array(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c) for c in (*LETTERS, *LABELS)]
    return found.groupBy("part", F.shiftright("row", range_bits).alias("range")).agg(F.count("*").alias("n"), *lists)


def _held(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which ids of the sorted a are in the sorted b; the shorter one leaps into the longer one."""
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        return (at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a) if len(b) else np.zeros(len(a), bool)
    at = np.searchsorted(a, b)
    there = at < len(a)
    out = np.zeros(len(a), bool)
    out[at[there][a[at[there]] == b[there]]] = True
    return out


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The sorted union of sorted lists without repeats: each shorter list is merged into the longest so far."""
    lists = sorted(lists, key=len)
    now = lists.pop() if lists else np.zeros(0, np.int64)
    while lists:
        new = lists.pop()
        new = new[~_held(new, now)]
        now = np.insert(now, np.searchsorted(now, new), new)
    return now


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[~_held(a, b)]


SIZES = "part string, filter string, prior string, fails long, removed long, kept long, unique_fails long, good_lost long, toxic_lost long"


def _sizes(lists_of: pa.Table) -> pa.Table:
    """Of the lists of one range (one row): for each filter and set of earlier filters, the sizes of what is left."""
    head = lists_of.combine_chunks().to_batches()[0]
    part, n = head.column("part")[0].as_py(), head.column("n")[0].as_py()
    lists = {c: np.asarray(head.column(c)[0].values, np.int64) for c in (*LETTERS, *LABELS)}
    unions = {(): np.zeros(0, np.int64)}
    for k in range(1, len(LETTERS) + 1):
        for s in combinations(LETTERS, k):
            unions[s] = union([unions[s[:-1]], lists[s[-1]]])
    rows = []
    for f in LETTERS:
        others = tuple(c for c in LETTERS if c != f)
        alone = len(difference(lists[f], unions[others]))
        for k in range(len(others) + 1):
            for s in combinations(others, k):
                gone = difference(lists[f], unions[s])
                kept = n - len(unions[tuple(sorted((*s, f)))])
                rows.append((part, f, "".join(s), len(lists[f]), len(gone), kept, alone, *(int(_held(gone, lists[c]).sum()) for c in LABELS)))
    names = [c.split()[0] for c in SIZES.split(", ")]
    return pa.table({name: pa.array(col, pa.string() if j < 3 else pa.int64()) for j, (name, col) in enumerate(zip(names, zip(*rows)))})


def audit(docs: DataFrame, labels: DataFrame, range_bits: int = RANGE_BITS) -> DataFrame:
    """One row per part, order of the filters and step.

    ``docs``: doc_id, source, text; ``labels``: doc_id, quality, toxic. Other columns are not read.
    """
    stage = Stage(docs.sparkSession, "filter-audit")
    lists = stage.put(posting_lists(facts(docs, labels, stage), range_bits), "postings")
    sizes = lists.groupBy("part", "range").applyInArrow(_sizes, SIZES).groupBy("part", "filter", "prior").agg(
        *[F.sum(c).alias(c) for c in ("fails", "removed", "kept", "unique_fails", "good_lost", "toxic_lost")])
    # a filter stands after a given set of k others in k! (4 - k)! orders
    weights = F.array(*[F.lit(factorial(k) * factorial(len(LETTERS) - 1 - k)) for k in range(len(LETTERS))])
    sizes = stage.put(sizes, "sizes")
    shapley = sizes.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.get(weights, F.length("prior"))).cast("long").alias("shapley"))
    orders = [("".join(p), k + 1, p[k], "".join(sorted(p[:k]))) for p in permutations(LETTERS) for k in range(len(p))]
    orders = docs.sparkSession.createDataFrame(orders, "filter_order string, step int, filter string, prior string")
    return sizes.join(shapley, ["part", "filter"]).join(F.broadcast(orders), ["filter", "prior"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley")
