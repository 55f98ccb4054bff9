"""WARC: round trip over many small splits, magic inside payloads, revisits, edge cases."""

import base64
import hashlib
import random

import pytest

from incentiva.llm import warc
from incentiva.llm.common import Stage

SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def round_trip(spark, rows, files=2, **params):
    path = f"{Stage(spark, 'warc-test').root}/warc"
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(files), path, **params)
    return [r.asDict() for r in warc.read_warc(spark, path).collect()]


def fake(n):
    body = "x" * n
    return f"<p>WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\n{body}\r\n\r\nWARC/1.0\r\n</p>WARC/1.0\r\n\r\n"


def expected(rows, min_bytes=0):
    best = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            best[h] = max(best.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = h or ""
        n = sum(1 for r in rows if (r[2] or "") == h)
        again = n > 1 and len(h.encode()) >= min_bytes and h in best and best[h] != i
        out.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                    "revisit" if again else "response", best[h] if again else None, None if again else h.encode()))
    return out


def digest(found):
    def page(u):
        return None if u in (None, warc.URN) else int(u.removeprefix(warc.URN))

    return [(page(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["warc_type"], page(r["refers_to"]), r["payload"]) for r in found]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_many_splits_and_magic_inside_payloads(tiny_splits):
    rng = random.Random(5)
    rows = [(i, f"http://h{i}/", rng.choice([fake(rng.randrange(2000)), "é漢" * rng.randrange(3000), "", "<b>" * 50, fake(9000) * 3]) + str(i % 25))
            for i in range(60)]
    rows.append((1000, "u", "plain " * 20000))  # a record over many splits
    rows.append((1001, "u", fake(50) * 1200))  # magic in each of many splits
    same(digest(round_trip(tiny_splits, rows)), expected(rows))
    same(digest(round_trip(tiny_splits, rows, files=1)), expected(rows))


def test_nulls_repeats_and_empty(spark):
    rows = [(1, None, None), (2, "a\r\nb", ""), (3, "u", "x"), (3, "u", "x"), (None, "u", "x"), (None, "u", "only"), (4, "u", "y")]
    found = round_trip(spark, rows)
    same(digest(found), expected(rows))
    assert {r["target_uri"] for r in found if r["record_id"] == warc.URN + "2"} == {"a%0D%0Ab"}
    assert round_trip(spark, []) == []


def test_least_size(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    same(digest(round_trip(spark, rows, min_bytes=3)), expected(rows, 3))


def test_broken_chain_stops(spark):
    path = f"{Stage(spark, 'warc-test').root}/warc"
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nok"
    bad = record.replace("Content-Length: 2", "Content-Length: two")
    spark.createDataFrame([(record,), (bad,), (record,)], "value string").coalesce(1).write.option("lineSep", warc.GAP).text(path)
    assert len(warc.read_warc(spark, path).collect()) == 1
