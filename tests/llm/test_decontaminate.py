"""Decontamination against a brute-force version."""

import random
import re

from pyspark.sql import functions as F

from incentiva.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return [(m[0], m.start(), m.end()) for m in WORD.finditer((t or "").translate(LOWER))]


def brute(text, items, window):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        q = [x[0] for x in words(t)]
        size = min(len(q), window)
        for i in range(max(1, len(q) - window + 1) if q else 0):
            for j in range(len(w) - size + 1):
                if [x[0] for x in w[j: j + size]] == q[i: i + size]:
                    hit.update(range(j, j + size))
                    if item is not None:
                        found.add(str(item))
    return len(w), hit, found


def check(spark, docs, items, window=4, **params):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.decontaminate(df, bench, window, **params)
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, found = brute(r["text"], items, window)
        f = r["found"]
        assert f["n_words"] == n
        assert {i for s, e in f["hits"] for i in range(s, e)} == hit
        assert f["items"] == sorted(found)
        w = words(r["text"])
        assert f["spans"] == [[w[s][1], w[e - 1][2]] for s, e in f["hits"]]
    return got


def test_random_texts(spark):
    rng = random.Random(3)
    vocab = ["a", "B", "cc", "é", "漢", "d9", "Zz", "😀x"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "\n", "--", " . "]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(60)]
    items = [(i % 9, text(rng.choice([1, 2, 3, 5, 8]))) for i in range(12)]
    check(spark, docs, items)
    check(spark, docs, items, block_bytes=30)  # several blocks, several passes


def test_cases(spark):
    docs = [(1, None), (2, ""), (3, "..."), (3, "a b c d e"), (3, "a b c d e"), (None, "A B C D"), (4, "a b " * 5000 + "c d")]
    items = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "b c d e"), (7, "!"), (8, "d")]
    got = D.digest(check(spark, docs, items))
    assert got.where("contaminated").count() == 4
    assert D.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")) \
        .where(F.size("found.hits") > 0).count() == 0
    assert check(spark, [], items).count() == 0


def test_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "a b c d", "x", 5), (2, "z", "y", 6)], "doc_id bigint, text string, found string, c0 int")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string")
    kept = D.remove_contaminated(df, bench, 4)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(2, "z", "y", 6)]


def test_a_window_of_very_many_items_and_ten_blocks(spark):
    """Items are looked up after the scan, block by block the windows are scanned: results as in one pass."""
    rng = random.Random(8)
    words_ = [f"w{i}" for i in range(3000)]
    shared = "one shared window of five"
    items = [(i, shared) for i in range(20_000)] + [(30_000 + i, " ".join(rng.choice(words_) for _ in range(9))) for i in range(400)]
    docs = [(i, " ".join(rng.choice(words_) for _ in range(30)) + (" | " + items[20_000 + i][1] + " x" if i % 2 else "") + (f" {shared}" if i % 50 == 0 else "")) for i in range(200)]
    docs += [(None, None), (1, ""), (1, "no hit here")]
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    one = D.decontaminate(df, bench, 5)
    size = sum(len(" ".join(t.split()[i:i + 5])) for _, t in items[20_000:] for i in range(5))
    ten = D.decontaminate(df, bench, 5, block_bytes=size // 9)
    key = lambda rows: sorted(map(repr, rows))
    assert key(one.collect()) == key(ten.collect())
    hit = {r["doc_id"]: r["found"]["items"] for r in one.collect() if r["found"]["items"]}
    assert len(hit[0]) == 20_000 and hit[1] == ["30001"] and set(hit) == {i for i in range(200) if i % 2 or i % 50 == 0}
    kept = D.remove_contaminated(df, bench, 5)
    assert kept.count() == len(docs) - len(hit)
