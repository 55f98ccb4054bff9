"""Connected components of a link table: local forests and star rounds.

Links are read in tasks of about EDGES_PER_TASK. Each task contracts its own links to a forest of
stars (node, least node of its tree), which keeps what is connected and drops every redundant link. If that took one
task, it is the answer. Otherwise large-star and small-star rounds (two joins and aggregates each) re-hang the
stars under the least neighbours until nothing changes. Nothing is collected; each round is written to the shared
folder, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

EDGES_PER_TASK = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): each node of the task's links but the least of its tree, and that least node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            u, v = root(u), root(v)
            parent[max(u, v)] = min(u, v)
    nodes = [x for x in parent if parent[x] != x]
    for k in range(0, len(nodes), 100_000):
        part = nodes[k: k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links re-hung under the least neighbour of each node."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    hung = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else \
        joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return hung.where("u <> v").distinct()


def connected_components(edges: DataFrame, stage: Stage, name: str, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, label): the least node of its component, for each node that has a link to another.

    ``edges`` has bigint columns u, v; loops, repeats and either direction are allowed.
    """
    now = stage.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    seen, k, tasks = None, 0, 2
    while True:
        k, tasks = k + 1, max(1, -(-now.count() // per_task))
        now = stage.put(now.coalesce(tasks).mapInArrow(_forest, "u bigint, v bigint"), f"{name}-{k}-forest")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tasks == 1 or state == seen:
            break
        seen = state
        now = stage.put(_star(_star(now, True), False), f"{name}-{k}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
