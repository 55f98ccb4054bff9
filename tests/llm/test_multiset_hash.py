"""Multiset fingerprints: order, insertion, deletion, and the edited report against brute force."""

import hashlib

from pyspark.sql import functions as F

from incentiva.llm import multiset_hash as H


def lanes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return {r["k"]: r["lanes"] for r in H.fingerprints(df, ["k"]).collect()}


def test_homomorphism(spark):
    a, b, both, turned, dup = "first one\nsecond", "third é漢 line\n" + "x" * 400, "first one\nsecond\nthird é漢 line\n" + "x" * 400, \
        "x" * 400 + "\nsecond\n\nthird é漢 line\nfirst one", "second\nsecond\nfirst one"
    f = lanes(spark, [a, b, both, turned, dup, "", None])
    df = spark.createDataFrame([(f[0], f[1], f[2])], "a array<bigint>, b array<bigint>, c array<bigint>")
    plus, minus = df.select(H.combine(F.col("a"), F.col("b")), H.combine(F.col("c"), F.col("b"), -1)).first()
    assert plus == f[2] and minus == f[0]
    assert f[2] == f[3] and f[4] != f[0]
    assert f[5] == f[6] == [0] * H.LANES
    wide = [int(hashlib.sha512(b"second").hexdigest()[8 * i: 8 * i + 8], 16) for i in range(H.WIDE)]
    two = [(2 * x + int(hashlib.sha512(b"first one").hexdigest()[8 * i: 8 * i + 8], 16)) % 2**32 for i, x in enumerate(wide)]
    assert f[4][H.SKETCH:] == two


def brute(rows):
    order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 4
        out.append((d, t, t[: len(t) - k] + nxt[:k], nxt))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bucket", F.lit(1))
    got = sorted((r.asDict() for r in H.edited_report(df.repartition(3)).collect()), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["edited_sha256"]))
    want = sorted(brute(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[2].encode()).hexdigest()))
    assert len(got) == len(rows)
    hexes = {}
    f = lanes(spark, [x for r in want for x in (r[1], r[2], r[3])])
    one = spark.createDataFrame([(k, v) for k, v in f.items()], "k int, v array<bigint>").select("k", H.as_text(F.col("v")).alias("t"))
    texts = {r["k"]: r["t"] for r in one.collect()}
    for i, (g, w) in enumerate(zip(got, want)):
        assert (g["doc_id"], g["n_chars"], g["edited_sha256"]) == (w[0], len(w[1]), hashlib.sha256(w[2].encode()).hexdigest())
        assert (g["fingerprint"], g["edited_fingerprint"]) == (texts[3 * i], texts[3 * i + 1])
        assert hexes.setdefault(w[1], g["fingerprint"]) == g["fingerprint"]
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
        assert (g["near_next"] == 1.0) if f[3 * i] == f[3 * i + 2] else g["near_next"] < 1.0
    return got


def test_report(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()]
    got = check(spark, docs)
    assert sum(g["near_edited"] > g["near_next"] for g in got) > 0.95 * len(got)


def test_buckets(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET_ROWS", 3)
    check(spark, [(i * 7 % 101, f"text {i}\nline {i % 5} of it\n" + "é" * i) for i in range(60)])
    check(spark, [(i // 9, f"text {i} line") for i in range(40)])  # many equal ids


def test_cases(spark):
    check(spark, [(1, "only"), ])
    check(spark, [(None, "none"), (1, None), (2, ""), (2, ""), (3, "\n\n"), (3, "abc"), (4, "漢" * 9), (5, "w " * 30000)])
    assert H.edited_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
