"""Near-duplicate vectors against all pairs, cells and blocks, edge cases; the shared lookup."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from incentiva.llm import embedding_dedup as ED
from incentiva.llm.common import Stage, lookup

ROWS = "vec_id bigint, embedding array<float>, label int"


def plain(rows, threshold=0.93):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float32).astype(np.float64)
        return a / np.linalg.norm(a)

    units = [None if label is None else unit(v) for _, v, label in rows]
    links = {i: {j for j in range(len(rows)) if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
                 and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold} for i in range(len(rows))}
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), least, key == least))
    return sorted(out, key=repr)


def run(spark, rows, **params):
    return sorted((tuple(r) for r in ED.near_duplicate_vectors(spark.createDataFrame(rows, ROWS).repartition(4), **params).collect()), key=repr)


def vectors(rng, n, dim, groups):
    out = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    while len(out) < n:  # chains and clusters of near copies around the threshold
        near = rng.choice(out)
        size = math.sqrt(sum(x * x for x in near))
        noise = rng.choice([0.02, 0.3, 0.38, 0.42, 0.8])
        out.append([x + noise * size / math.sqrt(dim) * rng.gauss(0, 1) for x in near])
    return out


@pytest.mark.parametrize("params", [{}, {"block": 40}])
def test_random_vectors(spark, params):
    rng = random.Random(13)
    rows = [(i, v, rng.choice([0, 0, 0, 1, None])) for i, v in enumerate(vectors(rng, 700, 8, 60))]
    rows += [(1000 + i, rows[rng.randrange(50)][1], 0) for i in range(60)] + [(2000 + i, rows[3][1], rows[3][2]) for i in range(30)]
    assert run(spark, rows, **params) == plain(rows)


def test_cells_lose_no_pair():
    """Each pair within the threshold shares a cell, as own vector of one, whatever the centres."""
    rng = np.random.default_rng(5)
    for dim, k in ((2, 16), (6, 40), (32, 64)):
        x = rng.normal(size=(600, dim))
        x[300:] = x[:300] + 0.35 * np.linalg.norm(x[:300], axis=1, keepdims=True) * (y := rng.normal(size=(300, dim))) / np.linalg.norm(y, axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for centres in (ED.fit_cells(x, k), (z := rng.normal(size=(k, dim))) / np.linalg.norm(z, axis=1, keepdims=True)):
            home, close = ED.assign(x, centres, math.sin(math.acos(0.93) / 2))
            u, v = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
            assert len(u) > 100
            assert ((home[u] == home[v]) | close[u, home[v]] | close[v, home[u]]).all()


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
            (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.1], 1), (None, [0.0, 1.0], 3),
            (12, [-1.0, -0.0], 1), (13, [1e-30, 0.0], 1), (14, [3e38, 3e38], 4), (15, [1e-38, 1e-38], 4)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1), (2, [1.0], None)]) == plain([(1, None, 1), (2, [1.0], None)])


def test_threshold_itself_links(spark):
    # 93 / 100 exactly: a = e1, b = (0.93, sqrt(1 - 0.93 ** 2)) up to double precision
    rows = [(1, [1.0, 0.0], 1), (2, [0.93, math.sqrt(1 - 0.93 ** 2)], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    a, b = np.array(rows[0][1]), np.array(rows[1][1])
    want = int(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93)
    assert [r["n_links"] for r in ED.near_duplicate_vectors(df).collect()] == [want, want]


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 5, 6), (2, [1.0, 0.0], 1, 7, 8)], ROWS + ", node int, n int")
    assert sorted(tuple(r) for r in ED.near_duplicate_vectors(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_lookup_of_heavy_keys(spark):
    rows = [(1, i) for i in range(500)] + [(2, 1), (None, 2), (3, 3)] + [(4, i) for i in range(60)]
    stage = Stage(spark, "test-lookup")
    left = stage.put(spark.createDataFrame(rows, "k bigint, v bigint").repartition(6), "rows")
    right = stage.put(spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "k bigint, x string"), "found")
    want = sorted((k, v, {1: "a", 2: "b"}.get(k)) for k, v in [(k or 0, v) for k, v in rows])
    for name, params in (("small", {}), ("heavy", {"max_rows": 0, "heavy_rows": 50}), ("none", {"max_rows": 0})):
        got = lookup(left, right, ["k"], stage, name, **params)
        assert got.columns == ["k", "v", "x"]
        assert sorted((r["k"] or 0, r["v"], r["x"]) for r in got.collect()) == want
    assert lookup(left, right, ["k"], stage, "plan", max_rows=0, heavy_rows=50).where(F.col("k") == 1).count() == 500
