"""Document fingerprints: a homomorphic multiset hash of paragraphs. DataFrame functions only.

Each paragraph (line that is not empty) is hashed to a wide vector, a document's fingerprint is
the sum of its paragraphs' vectors, lane by lane modulo a power of two. So the order of paragraphs
does not matter, equal multisets have equal fingerprints, and a document that gains or loses
paragraphs has its fingerprint plus or minus theirs, without a look at the rest.

The vector has two parts. ``WIDE`` lanes modulo 2**32 are the 512 bits of the paragraph's SHA-512:
they decide equality. ``SKETCH`` lanes modulo 2**16 hold the paragraph's blocks of 2 to 32 characters, each
as +1 or -1 in the lane that its hash picks: the cosine of two documents' sketches estimates
how alike the documents are. Both add up in the same way.

A document's elements are exploded to (row, lane, value) rows and summed by a hash aggregate, so a
long text never becomes one large array of vectors.

Defined cases: null text is the empty text, whose fingerprint is all zeros; empty texts are alike (1);
rows with equal ids are ordered by text; a null id comes before all others; a table of one row is
followed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH, WIDE = 128, 16
LANES = SKETCH + WIDE
#: Characters of a block, by the least length of the paragraph (short ones have finer blocks).
BLOCKS = ((257, 32), (65, 16), (17, 4), (0, 2))
#: Rows of a bucket of the order by id, on average.
BUCKET_ROWS = 100
MOST_BUCKETS = 20_000


def _pattern(length: Column) -> Column:
    picked = F.lit(f"(?s).{{1,{BLOCKS[-1][1]}}}")
    for least, size in BLOCKS[-2::-1]:
        picked = F.when(length >= least, f"(?s).{{1,{size}}}").otherwise(picked)
    return picked


def paragraphs(text: Column, a: int, b: int) -> Column:
    """Array of (p, a, b): the paragraphs of a text that counts a times in a first document and b times in a second."""
    return F.transform(F.filter(F.split(text, "\n"), lambda p: p != ""), lambda p: F.struct(
        p.alias("p"), F.lit(a).alias("a"), F.lit(b).alias("b")))


def sum_lanes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """From ``keys`` and parts (an array of ``paragraphs``): keys, x, y: the two documents' fingerprints as arrays of lanes."""
    names, keys = keys, [f"key{i}" for i in range(len(keys))]
    rows = rows.select(*[F.col(c).alias(k) for c, k in zip(names, keys)], "parts")
    each = rows.select(*keys, F.explode_outer("parts").alias("v")).select(*keys, "v.*")
    blocks = F.regexp_extract_all("p", _pattern(F.length("p")), F.lit(0))
    each = each.select(*keys, "a", "b", blocks.alias("blocks"), F.sha2("p", 512).alias("h"))
    # the paragraph's entries as strings: its blocks, then the lanes of its hash
    wide = F.array(*[F.substring("h", 8 * i + 1, 8) for i in range(WIDE)])
    entries = each.select(*keys, "a", "b", F.size("blocks").alias("n"), F.posexplode_outer(F.concat("blocks", wide)).alias("i", "s"))
    hash_ = F.xxhash64("s")
    sketch = F.col("i") < F.col("n")
    entries = entries.select(*keys, "a", "b", F.when(sketch, F.pmod(hash_, F.lit(SKETCH))).otherwise(F.col("i") - F.col("n") + SKETCH).cast("int").alias("lane"),
                             F.when(sketch, F.when(hash_.bitwiseAND(F.lit(1 << 40)) == 0, 1).otherwise(-1))
                             .otherwise(F.conv("s", 16, 10).cast("bigint")).alias("value"))
    lanes = entries.groupBy(*keys, "lane").agg(F.sum(F.col("value") * F.col("a")).alias("x"), F.sum(F.col("value") * F.col("b")).alias("y"))
    power = F.when(F.col("lane") < SKETCH, 1 << 16).otherwise(1 << 32)
    lists = lanes.select(*keys, F.struct("lane", F.pmod("x", power).alias("x"), F.pmod("y", power).alias("y")).alias("v")) \
        .groupBy(*keys).agg(F.collect_list("v").alias("v"))
    lists = lists.select(*keys, F.col("v.lane").alias("lane"), F.col("v.x").alias("x"), F.col("v.y").alias("y"))

    def dense(values: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: F.coalesce(
            F.get(values, F.array_position("lane", i).cast("int") - 1), F.lit(0).cast("bigint")))

    return lists.select(*keys, dense("x").alias("x"), dense("y").alias("y")).toDF(*names, "x", "y")


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint lanes of a document with b's paragraphs inserted (sign 1) or deleted (-1)."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda v, i: F.pmod(
        v["a"] + sign * v["b"], F.when(i < SKETCH, F.lit(1 << 16)).otherwise(F.lit(1 << 32))))


def as_text(lanes: Column) -> Column:
    """Lanes as one lower-case hex string."""
    digits = F.transform(lanes, lambda v, i: F.lpad(F.hex(v), F.when(i < SKETCH, 4).otherwise(8), F.lit("0")))
    return F.lower(F.array_join(digits, ""))


def signed(lanes: Column) -> Column:
    """The sketch as signed numbers."""
    return F.transform(F.slice(lanes, 1, SKETCH), lambda x: F.when(x < 1 << 15, x).otherwise(x - (1 << 16)).cast("double"))


def dot(p: Column, q: Column) -> Column:
    return F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def likeness(a: Column, b: Column, product: Column, norm: Column) -> Column:
    """1 for equal fingerprints a, b, else the cosine of their sketches, at least 0.

    product: their dot product; norm: the product of their squared norms.
    """
    cosine = F.when(norm > 0, product / F.sqrt(norm)).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """keys, lanes: the fingerprint of each distinct key's text (several rows of a key add up)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keys, paragraphs(text, 1, 0).alias("parts"))
    return sum_lanes(rows, keys).select(*keys, F.col("x").alias("lanes"))


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, guest, id, text): rows dealt to buckets of neighbouring ids; the first id of the next bucket is a guest at the end.

    So a bucket can be sorted on its own and yet the follower of its last row is there. After the
    last bucket comes the first id. Bucket bounds are ids at even ranks, found by one scan of
    the id column; the driver holds at most MOST_BUCKETS of them.
    """
    least = -(1 << 63)
    df = docs.select("id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("id", F.lit(least)).alias("place"))
    n = docs.count()
    buckets = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    shares = [k / buckets for k in range(1, buckets)]
    found = df.agg(F.min("place").alias("lo"), F.percentile_approx("place", shares, 10 * buckets).alias("at") if shares else
                   F.array().cast("array<bigint>").alias("at")).first()
    if n == 0:
        return df.select(F.lit(0).alias("bucket"), F.lit(False).alias("guest"), "id", "place", "text")
    bounds = sorted({found["lo"], *found["at"]})
    at = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if len(bounds) < 2 else F.lit(bounds)
    # the last bound that is not above the row's place, by halving
    steps = max(1, (len(bounds) - 1).bit_length())
    jumps = F.array(*[F.lit(1 << k) for k in range(steps - 1, -1, -1)])
    bucket = F.aggregate(jumps, F.lit(0), lambda b, j: F.when(
        (b + j < len(bounds)) & (F.element_at(at, F.least(b + j, F.lit(len(bounds) - 1)) + 1) <= F.col("place")), b + j).otherwise(b))
    df = df.withColumn("own", bucket)
    first = F.element_at(at, F.col("own") + 1) == F.col("place")
    host = F.pmod(F.col("own") - 1, F.lit(len(bounds)))
    places = F.when(first, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
                                   F.struct(host.alias("bucket"), F.lit(True).alias("guest")))) \
        .otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))))
    return df.select(F.explode(places).alias("p"), "id", "place", "text").select("p.bucket", "p.guest", "id", "place", "text")


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness to that and to the next document.

    Edited: the last quarter (rounded down) of the characters replaced by the first as many of the next document. Its
    fingerprint is not computed afresh: the paragraphs that the edit touches are deleted and the new ones inserted.
    """
    base = in_order(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")))
    order = Window.partitionBy("bucket").orderBy("guest", "place", "text")
    rows = base.withColumn("row", F.row_number().over(order)).withColumn("next", F.lead("text", 1, "").over(order)) \
        .withColumn("n", F.length("text").cast("bigint")).withColumn("k", F.floor(F.col("n") / 4).cast("int"))
    rows = rows.withColumn("head", F.expr("left(text, int(n) - k)")).withColumn("new", F.expr("left(next, k)"))
    rows = rows.withColumn("cut", F.expr("instr(reverse(head), '\\n')"))
    rows = rows.withColumn("cut", F.expr("if(cut = 0, 0, length(head) - cut + 1)"))  # whole paragraphs before the edit
    parts = F.concat(paragraphs(F.expr("left(text, cut)"), 1, 1), paragraphs(F.expr("substring(text, cut + 1)"), 1, 0),
                     paragraphs(F.expr("concat(substring(head, cut + 1), new)"), 0, 1))
    keys = ["bucket", "row", "guest", "id", "n", "sha"]
    rows = rows.select("bucket", "row", "guest", "id", "n", F.unhex(F.sha2(F.concat("head", "new"), 256)).alias("sha"), parts.alias("parts"))
    found = sum_lanes(rows, keys).withColumns({"p": signed(F.col("x")), "q": signed(F.col("y"))})
    found = found.withColumns({"pp": dot(F.col("p"), F.col("p")), "qq": dot(F.col("q"), F.col("q")), "pq": dot(F.col("p"), F.col("q"))})
    after = Window.partitionBy("bucket").orderBy("row")
    found = found.withColumns({c: F.lead(o).over(after) for c, o in (("next", "x"), ("r", "p"), ("rr", "pp"))}).where("not guest")
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.lower(F.hex("sha")).alias("edited_sha256"),
        as_text(F.col("x")).alias("fingerprint"), as_text(F.col("y")).alias("edited_fingerprint"),
        likeness(F.col("x"), F.col("y"), F.col("pq"), F.col("pp") * F.col("qq")).alias("near_edited"),
        likeness(F.col("x"), F.col("next"), dot(F.col("p"), F.col("r")), F.col("pp") * F.col("rr")).alias("near_next"))
