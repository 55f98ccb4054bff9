"""Helpers the operators share: staged tables, broadcast by measured size, batch slicing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import shared_dir

#: A side is broadcast when it has at most so many rows of at most ROW_BYTES bytes each.
BROADCAST_ROWS = 200_000
#: Bytes of text worked on at once inside a task; a longer single text is taken whole.
SLICE_BYTES = 1_000_000


class Stage:
    """Written tables of one run, in the folder that all executors share.

    A written table cuts the lineage, survives lost executors, and gives the
    planner real sizes. The folder belongs to the run; whoever started the run may
    delete it once the result is stored.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows, else as it is.

    For narrow staged tables (some dozens of bytes a row): the count is read from
    the file footers, so the size of what is broadcast is proven each time.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


#: Salts over which a heavy key of a lookup is spread.
SALTS = 64
#: A key is heavy from so many rows on, or one in so many of all rows if that is more.
HEAVY_ROWS = 100_000


def lookup(rows: DataFrame, found: DataFrame, keys: list[str], stage: Stage, name: str, heavy_rows: int = HEAVY_ROWS,
           max_rows: int = BROADCAST_ROWS, n_col: str | None = None, total: int | None = None) -> DataFrame:
    """``rows LEFT JOIN found`` on ``keys``, where ``found`` has each key once, whatever the skew of ``rows``.

    A ``found`` of at most ``max_rows`` rows is broadcast. Else keys with more than ``heavy_rows`` rows
    (counted, with map-side partial sums) are dealt over SALTS by the rows' input partition, and their one
    row of ``found`` is repeated for each salt. At most ``heavy_rows`` keys can be heavy, so that
    list is bounded. ``n_col``: a column of ``found`` that has those counts already; ``total``: what
    counts as its number of rows, if its rows are wide. Both sides are read more than once: pass staged tables.
    """
    if (found.count() if total is None else total) <= max_rows:
        return rows.join(F.broadcast(found), keys, "left")
    least = max(heavy_rows, rows.count() // heavy_rows)
    counts = rows.groupBy(*keys).count().where(F.col("count") > least) if n_col is None else found.where(F.col(n_col) > least)
    heavy = stage.put(counts.select(*keys, F.lit(True).alias("__heavy")), f"{name}-heavy")
    if heavy.isEmpty():
        return rows.join(found, keys, "left")
    salt = F.when(F.col("__heavy"), F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0)
    salts = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(F.broadcast(heavy), keys, "left").withColumn("__salt", salt).drop("__heavy")
    right = found.join(F.broadcast(heavy), keys, "left").withColumn("__salt", F.explode(salts)).drop("__heavy")
    return left.join(right, [*keys, "__salt"], "left").drop("__salt")


def text_slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive zero-copy slices of a batch with about ``size`` bytes of text each."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(utf8_lengths(batch.column(column)))
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(first, last - first)
        first = last


def utf8_lengths(col: pa.Array) -> np.ndarray:
    return np.diff(utf8_parts(col)[1])


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows (null: empty), without copies where possible."""
    if col.null_count:
        col = col.fill_null("")
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]
