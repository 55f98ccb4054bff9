"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one kept per component.

1. Equal vectors of a label are one node with a count, so copies, however many, cost nothing from here on.
2. Spherical k-means is fitted on a bounded sample (SAMPLE_VALUES numbers, the nodes of least hash) of the most
   common dimension; vectors of other dimensions share one cell. The number of cells is the power of two, at least
   LEAST_CELLS, with the least estimated work: products within cells, copies and assignments.
3. A vector belongs to the cell of its nearest centre. It is also copied to each other cell whose border is
   within half the angle of the threshold: a great circle between two vectors of different cells crosses
   that border, so of a pair within the angle at least one is within half of it. So no pair is lost, whatever the
   centres; vectors without clusters only cause more copies.
4. Within a cell its own vectors meet each other and the copies in blocks of BLOCK vectors; each pair of blocks is one
   task, which multiplies matrices in double precision and returns per vector its number of links and the least
   node it is connected with there, never pairs. A pair that two cells see counts in the lower one.
5. Components of those links give the classes; the vector with the least vec_id is kept.

Cosines within 1e-12 of the threshold are recomputed with exact sums. Work within a cell is quadratic in its
vectors (at matrix speed); where vectors have no cluster structure in a high dimension, no exact partition
avoids that. ``margin`` (sine of the angle to a border up to which vectors are copied) trades recall for copies;
None is exact.

Defined cases: null, empty and zero vectors, and those with null or non-finite components, link with nothing, as do
those with a null label; vectors of unlike length link with nothing; each row is a vector, so rows that repeat
a vec_id count as links of each other; a null vec_id takes part, but names no component (null if there is no other id),
and is kept only where its component has no id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, fsum, sin, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, lookup, small
from .components import connected_components

THRESHOLD = 0.93
SAMPLE_VALUES = 1_000_000
LEAST_CELLS, MOST_CELLS = 8, 4096
#: Sampled vectors a centre needs.
PER_CENTRE = 24
BLOCK = 8192
#: A copy of a vector costs about as much as so many products with it; a product with a centre as much as one.
COPY_COST = 3000
_TILE = 1024
_SLACK = 1e-9


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """The vectors of equal length (no nulls) as unit rows in double precision."""
    flat = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]


def fit_cells(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Spherical k-means: k unit centres of the unit rows x; an empty cell takes the row farthest from its centre."""
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = x @ centres.T
        home = near.argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        lost = np.flatnonzero(np.bincount(home, minlength=k) == 0)
        total[lost] = x[np.argsort(near.max(axis=1), kind="stable")[: len(lost)]]
        size = np.sqrt((total ** 2).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, total / np.where(size > 0, size, 1), centres)
    return centres


def assign(x: np.ndarray, centres: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each row, and a matrix that is true where the row is copied to another cell."""
    if not len(centres):
        return np.zeros(len(x), np.int64), np.zeros((len(x), 1), bool)
    near = x @ centres.T
    home = near.argmax(axis=1)
    between = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    close = near.max(axis=1, keepdims=True) - near <= margin * between + _SLACK
    close[np.arange(len(x)), home] = False
    return home, close


def choose_cells(x: np.ndarray, pairs: float, rows: float, margin: float) -> np.ndarray:
    """Centres fitted on x, their number with the least estimated work for ``rows`` vectors with ``pairs`` pairs of equal label."""
    best, work, k = x[:0], np.inf, LEAST_CELLS
    while k <= min(MOST_CELLS, len(x) // PER_CENTRE):
        centres = fit_cells(x, k)
        home, close = assign(x, centres, margin)
        own = np.bincount(home, minlength=k) / len(x)
        copied = close.sum(axis=0) / len(x)
        cost = pairs * float((own * (own / 2 + copied)).sum()) + rows * (k + COPY_COST * (1 + copied.sum()))
        if cost >= work:
            break
        best, work, k = centres, cost, 2 * k
    return best


def _assigned(batches: Iterator[pa.RecordBatch], centres: np.ndarray, margin: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for s in range(0, whole.num_rows, 4096):
            b = whole.slice(s, 4096)
            dim = b.column("dim").to_numpy()
            home, cells = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)]
            for at in [np.flatnonzero(dim == centres.shape[1])] if len(centres) else []:
                if len(at):
                    home[at], close = assign(unit_rows(b.column("embedding").take(pa.array(at))), centres, margin)
                    for i, row in zip(at, close):
                        cells[i] = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("node", "n", "label", "dim", "embedding")), pa.array(home, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))], ["node", "n", "label", "dim", "embedding", "home", "cells"])


def _least_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the labels of linked rows in place; each class ends with its least label (labels are row numbers)."""
    while True:
        a, b = label[u], label[v]
        unlike = a != b
        if not unlike.any():
            return
        u, v, a, b = u[unlike], v[unlike], a[unlike], b[unlike]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _exact(a: pa.Scalar, b: pa.Scalar, threshold: float) -> bool:
    a, b = (np.asarray(v.values, np.float64) for v in (a, b))
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return fsum(a * b) / (sqrt(fsum(a * a)) * sqrt(fsum(b * b))) >= threshold


def _links(t: pa.Table, threshold: float) -> pa.Table:
    """(node, links, least) of the linked vectors of two blocks of a cell (or of one block)."""
    t = t.combine_chunks()
    order = np.argsort(t.column("node").to_numpy(), kind="stable")
    t = t.take(pa.array(order)).combine_chunks()
    node, n, block = (t.column(c).to_numpy() for c in ("node", "n", "block"))
    cell, i, j = (t.column(c)[0].as_py() for c in ("cell", "i", "j"))
    vectors = t.column("embedding").chunk(0)
    x = unit_rows(vectors)
    home = t.column("home").to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    # rows copied from a lower cell see this pair there too, if the vector here was copied to it
    lower = [c for c in np.unique(home) if c < cell]
    cells = t.column("cells").chunk(0)
    of = np.repeat(np.arange(len(node)), cells.value_lengths().to_numpy())
    cells = cells.flatten().to_numpy()
    copied = {c: np.bincount(of[cells == c], minlength=len(node)) > 0 for c in lower}
    links, label = np.zeros(len(node)), np.arange(len(node))
    for s in range(0, len(left), _TILE):
        a = left[s: s + _TILE]
        for e in range(s if i == j else 0, len(right), _TILE):
            b = right[e: e + _TILE]
            product = x[a] @ x[b].T
            near = product >= threshold
            for p, q in np.argwhere(np.abs(product - threshold) < 1e-12):
                near[p, q] = _exact(vectors[int(a[p])], vectors[int(b[q])], threshold)
            for c in lower:
                near[np.ix_(copied[c][a], home[b] == c)] = False
            if i == j and s == e:
                np.fill_diagonal(near, False)
            links[a] += near.astype(np.float64) @ n[b].astype(np.float64)
            if i != j or s != e:
                links[b] += near.T.astype(np.float64) @ n[a].astype(np.float64)
            p, q = np.nonzero(near)
            if len(p):
                _least_labels(label, a[p], b[q])
    has = np.flatnonzero(links > 0)
    return pa.table({"node": node[has], "links": links[has].astype(np.int64), "least": node[label[has]]})


def _blocks(assigned: DataFrame, stage: Stage, block: int) -> DataFrame:
    """Rows repeated for each pair of blocks (i, j) of a (label, dim, cell) in which they meet others."""
    where = ["label", "dim", "cell"]
    own = assigned.select(*where[:2], F.col("home").alias("cell"), F.lit(1).alias("own"), F.lit(0).alias("copies"))
    copies = assigned.select(*where[:2], F.explode("cells").alias("cell"), F.lit(0).alias("own"), F.lit(1).alias("copies"))
    size = own.union(copies).groupBy(*where).agg(F.sum("own").alias("own"), F.sum("copies").alias("copies")) \
        .where("own > 0 and own + copies > 1") \
        .select(*where, F.ceil(F.col("own") / block).cast("int").alias("nb"), F.ceil(F.col("copies") / block).cast("int").alias("cb"))
    size = small(stage.put(size, "sizes"))
    cols = ["node", "n", "embedding", "home", "cells"]
    deal = F.xxhash64("node", F.lit(1))
    natives = assigned.withColumn("cell", F.col("home")).join(size, where).withColumn("block", F.pmod(deal, "nb").cast("int"))
    natives = natives.select(*where, *cols, "block", F.explode(F.sequence(F.lit(0), F.col("nb") + F.col("cb") - 1)).alias("other"))
    copies = assigned.withColumn("cell", F.explode("cells")).withColumn("cells", F.expr("slice(cells, 1, 0)")).join(size, where) \
        .withColumn("block", (F.col("nb") + F.pmod(deal, "cb")).cast("int")) \
        .select(*where, *cols, "block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    return natives.union(copies).select(*where, *cols, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def near_duplicate_vectors(table: DataFrame, threshold: float = THRESHOLD, margin: float | None = None, block: int = BLOCK) -> DataFrame:
    """One row per row of ``table`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    stage = Stage(table.sparkSession, "embedding-dedup")
    margin = sin(acos(threshold) / 2) if margin is None else margin
    # a third of the rows may be one vector: rows are named by two hashes of label and vector
    fit = F.expr("label is not null and coalesce(size(embedding), 0) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
                 "and exists(embedding, x -> x <> 0)")
    vector = F.when(F.coalesce(fit, F.lit(False)), F.col("embedding"))
    rows = table.select("vec_id", "label", vector.alias("embedding"))
    rows = rows.select("vec_id", "label", "embedding", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")).alias("h"),
                       F.when(F.col("embedding").isNotNull(), F.hash("embedding", "label")).alias("g"))
    named = stage.put(rows.select("vec_id", "h", "g"), "rows")
    nodes = rows.where("h is not null").groupBy("h", "g").agg(F.count("*").alias("n"), F.min("vec_id").alias("id"),
                                                           F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    nodes = stage.put(nodes.withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    common = nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    centres = np.zeros((0, 0))
    if common is not None:
        pairs, total = nodes.groupBy("label").count().agg(F.sum(F.col("count").cast("double") ** 2), F.sum("count")).first()
        most = max(1, SAMPLE_VALUES // common["dim"])
        # about twice as many as wanted, by a share of the hashes, then the least of them
        few = nodes.where(F.col("dim") == common["dim"]).where(F.pmod("h", F.lit(1 << 30)) <= int(min(1, 2 * most / common["count"]) * (1 << 30)))
        sample = few.orderBy("h", "g").limit(most).select("embedding").toArrow()
        centres = choose_cells(unit_rows(sample.column(0).combine_chunks()), pairs, total, margin)
    assigned = stage.put(nodes.select("node", "n", "label", "dim", "embedding").mapInArrow(
        lambda batches: _assigned(batches, centres, margin),
        f"node bigint, n bigint, label {nodes.schema['label'].dataType.simpleString()}, dim int, "
        f"embedding {nodes.schema['embedding'].dataType.simpleString()}, home int, cells array<int>"), "assigned")
    links = stage.put(_blocks(assigned, stage, block).groupBy("label", "dim", "cell", "i", "j").applyInArrow(
        lambda t: _links(t, threshold), "node bigint, links bigint, least bigint"), "links")
    labels = connected_components(links.select(F.col("node").alias("u"), F.col("least").alias("v")), stage, "components")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    # only nodes with a link or with copies differ from the default
    found = nodes.select("node", "h", "g", "n", "id").join(small(stage.put(counts, "counts")), "node", "left") \
        .join(small(stage.put(labels, "labels")), "node", "left").where("n > 1 or links is not null")
    found = stage.put(found.select("h", "g", "n", "id", "links", F.coalesce("label", "node").alias("class")), "found")
    least = stage.put(found.groupBy("class").agg(F.min("id").alias("component_id")), "least")
    found = stage.put(found.join(small(least), "class").select(
        "h", "g", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id",
        F.lit(True).alias("grouped")), "results")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("vec_id"))
    return lookup(named, found, ["h", "g"], stage, "members").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
