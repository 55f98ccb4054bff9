"""WARC archives: writing with revisit records, and reading by verified chains of records.

Writing. A page's payload is its HTML in UTF-8. Of pages with equal payloads (SHA-1) of at least ``min_bytes`` bytes the one with
the largest id is a response record, the others are revisit records that refer to it. Spark's text writer makes the
files, one record a row, so files are committed as a whole and survive lost tasks.

Reading. Files are split anywhere. A scan cuts each split at the magic ``WARC/1.0``, which may as well stand
inside a payload. Each piece that looks like a header is a candidate record, and its lengths name its successor's offset.

1. Each task follows the successors inside its split and emits, for each candidate, the offset at which its chain leaves
   the split. Sums of the splits' bytes turn relative offsets into absolute ones.
2. Pointer jumping from each file's start, over the candidates at which some chain enters a split: the reached set doubles its
   steps each round, so a file of n splits takes log2(n) rounds over a few rows a split.
3. A second scan starts each split at its verified entry and emits only records on the chain. A record that goes on in later
   splits is put together from its parts; everything else stays where it was read, payloads are not shuffled.

Defined cases: null HTML is the empty payload (which counts as one payload); a null id is kept, as no id, and only refers to others or stands for
itself; of repeated rows with the largest id each is a response; line ends in URLs are percent-encoded; an empty table makes an
archive without records; a file whose chain breaks yields the records up to the break.
"""

from __future__ import annotations

import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Stage, small

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
_M, _G = MAGIC.encode(), GAP.encode()


def base32_sha1(text: Column) -> Column:
    """SHA-1 in base 32: groups of 20 bits, five hex digits each, to four digits of the RFC 4648 alphabet."""
    h = F.sha1(text)
    groups = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, stage: Stage, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """One column, value: the text of each page's record, without the blank lines after it."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    p = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("about:blank")).alias("url"),
                     html.alias("html"), base32_sha1(html).alias("digest"))
    shared = p.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    shared = stage.put(shared.where("n > 1 and first is not null").select("digest", "first"), "shared-payloads")
    p = p.join(small(shared), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    size = F.octet_length("html")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(GAP))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.concat(http, F.when(again, "").otherwise(F.col("html")))

    def urn(c: Column) -> Column:
        return F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">\r\n"))

    return p.select(F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), urn(F.col("id")),
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT}\r\nWARC-Refers-To: "), urn(F.col("first")))).otherwise("\r\n"),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit(GAP), block).alias("value"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> None:
    """The archive of ``pages`` as files in the folder ``path``."""
    records(pages, Stage(pages.sparkSession, "warc"), id_col, url_col, html_col, min_bytes).write.option("lineSep", GAP).text(path)


def _header(piece: bytes) -> tuple[int, int] | None:
    """Lengths of the header (with the blank line) and of the content, if the piece begins with a record's header."""
    end = piece.find(_G)
    if end < 0:
        return None
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        if name.strip().lower() == b"content-length":
            value = value.strip()
            return (end + len(_G), int(value)) if value.isdigit() and len(value) < 19 else None
    return None


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(file, block, pieces as an iterator) of a task's rows, in order."""
    rows = ((f, b, v, x) for batch in batches for f, b, v, x in zip(
        batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value"),
        batch.column("entry").to_pylist() if "entry" in batch.schema.names else [None] * batch.num_rows))
    now = next(rows, None)
    while now is not None:
        key = now[:2]

        def pieces():
            nonlocal now
            while now is not None and now[:2] == key:
                yield now[2].as_py(), now[3]
                now = next(rows, None)

        own = pieces()
        yield *key, own
        for _ in own:
            pass


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each candidate of a split: where its content begins and where its chain leaves the split, relative to the split. Row -1: the split's bytes."""
    for file, block, pieces in _splits(batches):
        at, starts, nexts = 0, [], []
        for k, (piece, _) in enumerate(pieces):
            lengths = _header(piece) if k or block else None
            if lengths:
                starts.append(at)
                nexts.append(at + sum(lengths) + len(_G) + len(_M))
            at += len(piece) + len(_M)
        exits: dict[int, int | None] = {}
        for s, n in zip(reversed(starts), reversed(nexts)):
            exits[s] = n if n >= at else exits.get(n)
        ok = [(s, e) for s, e in exits.items() if e is not None]
        n = len(ok) + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([file] * n), pa.array([block] * n, pa.int64()), pa.array([-1] + [s for s, _ in ok], pa.int64()),
            pa.array([at] + [e for _, e in ok], pa.int64())], ["file", "block", "start", "leave"])


def _entries(spark: SparkSession, scan: DataFrame, stage: Stage) -> DataFrame:
    """(file, block, base, entry, after): each split's absolute base, the relative offset of its first verified record (null: none),
    and the absolute offset of the first verified record from this split on."""
    found = stage.put(scan.mapInArrow(_candidates, "file string, block bigint, start bigint, leave bigint"), "candidates")
    size = found.where("start = -1").select("file", "block", F.col("leave").alias("size"))
    order = Window.partitionBy("file").orderBy("block")
    splits = stage.put(size.withColumn("base", F.sum("size").over(order) - F.col("size")).withColumn("k", F.row_number().over(order)), "splits")
    nodes = found.where("start >= 0").join(splits, ["file", "block"]).select(
        "file", (F.col("base") + F.col("start")).alias("here"), (F.col("base") + F.col("leave")).alias("there"))
    # only places where some chain enters a split, or a file begins, can be on a path from a file's start
    first = splits.where("k = 1").select("file", F.lit(len(_M)).cast("bigint").alias("here"))
    entered = nodes.select("file", F.col("there").alias("here")).union(first).distinct()
    jump = stage.put(nodes.join(entered, ["file", "here"]).select("file", "here", "there"), "jump-0")
    reached = stage.put(first, "reached-0")
    most = splits.agg(F.max("k")).first()[0] or 0
    for k in range(1, max(0, most - 1).bit_length() + 1):
        step = reached.join(jump, ["file", "here"]).select("file", F.col("there").alias("here"))
        reached = stage.put(reached.union(step).distinct(), f"reached-{k}")
        jump = stage.put(jump.join(jump.select("file", F.col("here").alias("there"), F.col("there").alias("next")), ["file", "there"])
                         .select("file", "here", F.col("next").alias("there")), f"jump-{k}")
    # a split has at most one verified entry: the place, in its bytes, at which the chain from the start enters it
    at = reached.join(splits, "file").where("here >= base and here < base + size").groupBy("file", "block").agg(F.min("here").alias("here"))
    # the last record of a file ends beyond all splits
    end = reached.groupBy("file").agg(F.max("here").alias("end"))
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return stage.put(splits.join(at, ["file", "block"], "left").join(end, "file", "left").select(
        "file", "block", "base", (F.col("here") - F.col("base")).alias("entry"),
        F.coalesce(F.first("here", ignorenulls=True).over(later), "end").alias("after")), "entries")


_PARTS = "file string, offset bigint, owner bigint, whole boolean, data binary"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records on the chain (whole), and parts of records that cross splits; owner: the absolute offset that follows the record."""
    for file, _, pieces in _splits(batches):
        at, due, rows, size, record = 0, None, [], 0, []
        for piece, (base, entry, after) in ((p, (x["base"], x["entry"], x["after"])) for p, x in pieces):
            if at == 0:
                due = entry
            if not record and (due is None or at != due):
                # before the entry: the end of a record of an earlier split
                if after is not None and base + at < after and at + base > 0 and (due is None or at < due):
                    rows.append((file, base + at, after, False, (_M if at or base else b"") + piece))
            elif not record:
                lengths = _header(piece)
                if lengths is None:
                    due = None
                else:
                    start, due, record = base + at, at + sum(lengths) + len(_G) + len(_M), [piece]
            else:
                record += [_M, piece]
            at += len(piece) + len(_M)
            if record and due <= at:
                rows.append((file, start, base + due, True, b"".join(record)[: due - (start - base) - len(_G) - len(_M)]))
                record = []
            size += len(piece)
            if size > 4_000_000:
                yield _batch(rows)
                rows, size = [], 0
        if record:
            rows.append((file, start, base + due, False, b"".join(record)))
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)


_RECORD = ("file string, offset bigint, warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
           "payload_bytes bigint, payload binary")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for file, offset, data in zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("data")):
            data = data.as_py()
            lengths = _header(data)
            if lengths is None:
                continue
            head = dict((n.strip().lower(), v.strip()) for n, _, v in (x.partition(":") for x in data[: lengths[0]].decode("utf-8", "replace").split("\r\n")))
            content = data[lengths[0]: sum(lengths)]
            stop = content.find(_G)
            http, payload = (content[:stop], content[stop + len(_G):]) if stop >= 0 else (b"", content)
            said = [int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            revisit = head.get("warc-type") == "revisit"
            out.append((file, offset, head.get("warc-type"), head.get("warc-record-id", "").strip("<>") or None, head.get("warc-target-uri"),
                        head.get("warc-refers-to", "").strip("<>") or None,
                        head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else b32encode(hashlib.sha1(payload).digest()).decode(),
                        said[0] if revisit and said else len(payload), None if revisit else payload))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 9, kinds)],
                                         [x.split()[0] for x in _RECORD.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The verified records of an archive: file, offset of the content, warc_type, record_id, target_uri, refers_to, payload_digest, payload_bytes, payload.

    The digest and size of a response are those of the payload as read, of a revisit those its record states.
    """
    stage = Stage(spark, "warc-read")
    scan = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    entries = _entries(spark, scan, stage).select("file", "block", F.struct("base", "entry", "after").alias("entry"))
    if entries.count() <= BROADCAST_ROWS:
        rows = scan.join(F.broadcast(entries), ["file", "block"])  # keeps the rows of a split in order
    else:
        rows = scan.withColumn("k", F.monotonically_increasing_id()).join(entries, ["file", "block"]).sortWithinPartitions("file", "block", "k")
    parts = rows.select("file", "block", "value", "entry").mapInArrow(_chain, _PARTS)
    whole = parts.where("whole").select("file", "offset", "data").mapInArrow(_parse, _RECORD)
    # the parts of a record that crosses splits, by offset; there are at most as many as splits, but for payloads full of magic
    cut = parts.where("not whole").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "data"))).alias("ps"))
    cut = cut.select("file", F.col("ps")[0]["offset"].alias("offset"), F.aggregate(
        "ps", F.lit(b""), lambda a, p: F.concat(a, p["data"])).alias("data"))
    return whole.union(cut.mapInArrow(_parse, _RECORD))


def page_id(urn: Column) -> Column:
    """The id in a record's URN; null for an empty one."""
    return F.nullif(F.substring(urn, len(URN) + 1, F.length(urn)), F.lit(""))
