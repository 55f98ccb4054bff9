"""Personal data: generators of candidates, boosted trees, calibrated thresholds. DataFrame functions and Spark ML only.

1. Base spans of the kinds email, ip, card and phone are found by the rules below and always stay.
2. High-recall generators, one for each kind, propose further spans that may overlap each other and
   the base: spaced or masked addresses, dotted numbers of any size, long numbers in groups,
   numbers with and without a country prefix.
3. Every candidate gets format features of its normalised form (masks such as "(at)" undone, prefix and separators
   off: numbers and sizes of its parts, kinds of characters) and context features (characters beside it, cue words before
   it). Gradient-boosted trees are trained on all candidates: those with equal features and label are one row with
   their number as its weight. Positive are those that the rules accept; the tests by which the rules decide (checksum, ranges,
   numbers of digits, the @ and the +) are no features. Of the others, those that match a rule's pattern and
   fail its test are negative; those that no rule's pattern can match are unlabelled, as they may well be
   personal data, and weigh ``UNLABELLED`` of a negative.
4. For the thresholds all candidates are scored once more, those of either half of the texts (by a hash) by trees that learned from
   the other half. Each kind gets the least threshold, from ``EVEN`` on, at which ``PRECISION`` of the weight of what
   scores above is accepted, among candidates that pass the kind's test (a card's checksum, an address' ranges, a
   phone's digits); if none reaches it, the kind gets no further spans.
5. Further spans are those that pass the test, score above the threshold and meet no base span; of those that meet each other
   the best stay.

Patterns are possessive versions of the plain ones (same leftmost matches, no backtracking). Starts are running
sums in two levels, contexts are taken from the text between matches, and overlaps are counted in
a sorted sweep over starts and ends, so long texts and very many matches in one
text cost nearly linear time. Offsets are code points, end exclusive.

Defined cases: null text is empty; a document without candidates has no spans; rows with equal id and equal
text get the same result; if either half holds fewer than ``LEAST_CLASS`` candidates of either label, there are
no further spans. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage

KINDS = ("email", "ip", "card", "phone")
LEAST_CLASS = 20
PRECISION = 0.95
#: No threshold is under this score: below it a candidate is likelier not accepted.
EVEN = 0.5
UNLABELLED = 0.3
TREES, DEPTH = 12, 3
BINS = 200

_LOCAL = "[A-Za-z0-9._%+-]"
#: \G lets a match begin right after the one before, as the plain pattern may.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,4}(?:\x20?\.\x20?[0-9]{1,4}){3}(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+|00)?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![A-Za-z0-9])",
}
#: A text without this cannot match the generator.
TRIGGER = {
    "email": r"@|\(at\)|\[at\]| at ", "ip": r"[0-9]\x20?\.\x20?[0-9]", "card": r"[0-9][\x20.-]?[0-9]", "phone": r"[0-9][\x20().-]{0,2}[0-9]",
}
#: The same for the base rules: a base phone may have more than two separators between its digits.
BASE_TRIGGER = TRIGGER | {"phone": r"\+[0-9]"}
CUES = {
    "email": "mail|contact|write|e-mail|courriel|correo", "ip": r"\bip\b|host|server|address|addr|ping",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta", "phone": "tel|phone|call|fax|mobile|whatsapp|sms|anruf",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPAN = "array<struct<kind: string, s: int, e: int, m: string>>"
#: How masked separators read.
UNMASKED = [(r"\x20?(?:\(at\)|\[at\]|\x20at\x20|@)\x20?", "@"), (r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?", ".")]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.split(F.reverse(digits), "")
    doubled = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(F.filter(doubled, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        m = F.translate(m, " ", "")
        return F.regexp_like(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


#: Elements of a chunk of a running sum.
CHUNK = 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, by: str) -> Column:
    """Running sums (``by`` "sum") or maxima ("max") of an array of ints, itself included.

    Within chunks, then over the chunks' totals: appending to an array copies it, so one
    fold over all would be quadratic.
    """
    plus = (lambda a, x: a + x) if by == "sum" else (lambda a, x: F.greatest(a, x))
    zero = F.lit(0) if by == "sum" else F.lit(-1)
    ints = F.array().cast("array<int>")

    def fold(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.struct(start.alias("at"), ints.alias("out")), lambda a, x: F.struct(
            plus(a["at"], x).alias("at"), F.concat(a["out"], F.array(plus(a["at"], x))).alias("out")), lambda a: a["out"])

    def cut(v: Column) -> Column:
        n = F.ceil(F.size(v) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(v, k * CHUNK + 1, F.lit(CHUNK)))

    def joined(chunks: Column) -> Column:
        totals = fold(F.transform(chunks, lambda c: F.aggregate(c, zero, plus)), zero)
        return _let(totals, lambda t: F.flatten(F.transform(chunks, lambda c, k: fold(c, F.coalesce(F.get(t, k - 1), zero)))))

    return _let(values, lambda v: F.when(F.size(v) > 0, _let(cut(v), joined)).otherwise(ints))


def matches(text: Column, pattern: str, trigger: str, kind: str, context: bool = False) -> Column:
    """Array of (kind, s, e, m): the pattern's leftmost non-overlapping matches, from the lengths of matches and of what lies between.

    With ``context`` also left and right: up to 40 characters before (back to the match before the last one's end) and 2 after.
    """
    found = F.struct(F.split(text, pattern).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("ms"))
    kind_of = SPAN if not context else SPAN.replace("m: string", "m: string, left: string, right: string")
    empty = F.array().cast(kind_of)

    def spans(f: Column) -> Column:
        steps = F.transform(f["ms"], lambda m, i: F.length(F.get(f["gaps"], i)) + F.length(m))

        def place(ends: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                out = [F.lit(kind).alias("kind"), (F.get(ends, i) - F.length(m)).alias("s"), F.get(ends, i).alias("e"), m.alias("m")]
                if context:
                    before = F.concat(F.coalesce(F.get(f["ms"], i - 1), F.lit("")), F.get(f["gaps"], i))
                    after = F.concat(F.left(F.get(f["gaps"], i + 1), F.lit(2)), F.left(F.coalesce(F.get(f["ms"], i + 1), F.lit("")), F.lit(2)))
                    out += [F.right(before, F.lit(40)).alias("left"), F.left(after, F.lit(2)).alias("right")]
                return F.struct(*out)

            return F.transform(f["ms"], one)

        return F.when(F.size(f["ms"]) > 0, _let(running(steps, "sum"), place)).otherwise(empty)

    return F.when(F.regexp_like(text, F.lit(trigger)), _let(found, spans)).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """From columns id, text: id, th (hash of the text), base (spans by the rules), more (spans by the generators, with context)."""
    text = F.col("text")

    def accepted(k: str) -> Column:
        return F.filter(matches(text, BASE[k], BASE_TRIGGER[k], k), lambda x: _valid(k, x["m"]))

    base = F.concat(*map(accepted, KINDS))
    more = F.concat(*[matches(text, WIDE[k], TRIGGER[k], k, True) for k in KINDS])
    return docs.select("id", F.xxhash64("text").alias("th"), base.alias("base"), more.alias("more"))


def labelled(found: DataFrame) -> DataFrame:
    """The candidates (id, th, kind, s, e, m, left, right) with accepted (a base span) and meets (a base span overlaps it).

    A sweep over the sorted starts and ends of a document: base spans that begin before a candidate's end, less those
    that end by its start, are those it meets.
    """
    some = found.where("size(more) > 0").dropDuplicates(["id", "th"])
    base = some.select("id", "th", F.explode("base").alias("x")).select("id", "th", "x.kind", "x.s", "x.e", *[F.lit(None).cast("string").alias(c) for c in ("m", "left", "right")])
    more = some.select("id", "th", F.explode("more").alias("x")).select("id", "th", "x.kind", "x.s", "x.e", "x.m", "x.left", "x.right")
    bare = [F.lit(None).cast("string").alias(c) for c in ("m", "left", "right")]
    name = ["id", "th", "kind", "s", "e"]
    # at one position: ends of candidates, starts of base, ends of base, starts of candidates
    events = more.select(*name, *bare, F.col("e").alias("at"), F.lit(0).alias("what")) \
        .union(base.select(*name, *bare, F.col("s").alias("at"), F.lit(1).alias("what"))) \
        .union(base.select(*name, *bare, F.col("e").alias("at"), F.lit(2).alias("what"))) \
        .union(more.select(*name, "m", "left", "right", F.col("s").alias("at"), F.lit(3).alias("what")))
    upto = Window.partitionBy("id", "th").orderBy("at", "what").rowsBetween(Window.unboundedPreceding, 0)
    what = F.col("what")
    swept = events.withColumn("begun", F.sum((what == 1).cast("int")).over(upto)).withColumn("ended", F.sum((what == 2).cast("int")).over(upto))
    return swept.groupBy(*name).agg(
        F.max("m").alias("m"), F.max("left").alias("left"), F.max("right").alias("right"), F.max(what == 1).alias("accepted"),
        (F.max(F.when(what == 0, F.col("begun"))) > F.max(F.when(what == 3, F.col("ended")))).alias("meets")).where("m is not null")


def _by_kind(per: dict[str, Column], other: Column) -> Column:
    out = other
    for k, c in per.items():
        out = F.when(F.col("kind") == k, c).otherwise(out)
    return out


def features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Columns f0, f1, ... of candidates with kind, m, left, right: no test by which a rule decides is among them."""
    m, left, right = F.col("m"), F.col("left"), F.col("right")
    plain = m
    for pattern, to in UNMASKED:
        plain = F.regexp_replace(plain, pattern, to)
    plain = _by_kind({"email": plain, "ip": F.translate(m, " ", ""), "phone": F.regexp_replace(m, r"^(?:\+|00)", ""), "card": m}, m)
    parts = F.filter(F.split(F.col("plain"), "[^A-Za-z0-9]+"), lambda p: p != "")
    sizes = F.transform(F.col("parts"), lambda p: F.least(F.length(p), F.lit(8)))
    letters = F.length(F.regexp_replace(F.col("plain"), "[^A-Za-z]", ""))
    cue = _by_kind({k: F.regexp_like(F.lower(left), F.lit(CUES[k])) for k in KINDS}, F.lit(False))
    other_cue = F.lit(False)
    for k in KINDS:
        other_cue = other_cue | ((F.col("kind") != k) & F.regexp_like(F.lower(left), F.lit(CUES[k])))
    last = F.element_at("parts", -1)
    found = [
        *[(F.col("kind") == k).cast("double") for k in KINDS],
        F.size("sizes"), F.array_max("sizes"), F.array_min("sizes"), F.size(F.array_distinct("sizes")), F.element_at("sizes", 1), F.element_at("sizes", -1),
        letters / F.greatest(F.length("plain"), F.lit(1)), F.regexp_like(last, F.lit("^[A-Za-z]{2,6}$")), F.regexp_like(F.element_at("parts", 1), F.lit("^[A-Z][a-z]")),
        F.size(F.array_distinct(F.split(F.col("plain"), ""))), F.length("plain") - F.length(F.translate("plain", "()", "")),
        F.regexp_like(left, F.lit("[A-Za-z0-9._%+@-]$")), F.regexp_like(left, F.lit(r"(^|[\n.!?:;(\[])\s*$")), F.regexp_like(left, F.lit(r"[:=]\s?$")),
        F.regexp_like(right, F.lit("^[A-Za-z0-9@%+-]")), F.regexp_like(right, F.lit(r"^\.[0-9]")), F.regexp_like(right, F.lit(r"^(\s|$|[.,;)\]])")),
        cue, other_cue,
    ]
    names = [f"f{i}" for i in range(len(found))]
    rows = rows.withColumn("plain", plain).withColumn("parts", parts).withColumn("sizes", sizes)
    rows = rows.withColumns({n: F.coalesce(f.cast("double"), F.lit(0.0)) for n, f in zip(names, found)})
    return rows.drop("plain", "parts", "sizes"), names


def _tally(found: DataFrame, names: list[str], stage: Stage) -> DataFrame:
    """All candidates, as numbers n of those that are equal in all that learning and calibrating depend on."""
    half = F.pmod(F.xxhash64("th", F.lit("half")), F.lit(2)).alias("half")
    keys = ["half", "kind", "label", "weight", "valid", *names]
    rows = found.select(half, *keys[1:]).groupBy(*keys).agg(F.count("*").alias("n"))
    return stage.put(rows.sortWithinPartitions(*keys), "tally")


def _learn(tally: DataFrame):
    """Trees over all of ``tally``."""
    from pyspark.ml.classification import GBTClassifier

    # up to maxBins ** 2 rows Spark's choice of split points reads all of them, beyond that a sample
    bins = max(32, isqrt(tally.count()) + 1)
    return GBTClassifier(featuresCol="vector", labelCol="label", weightCol="mass", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3,
                         maxBins=bins, seed=7).fit(tally)


def _score(found: DataFrame, stage: Stage) -> DataFrame | None:
    """Candidates that pass their kind's test and its threshold, with their score; None if there is too little to learn from."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    failed = _by_kind({k: F.regexp_like(F.col("m"), F.lit(f"^(?:{BASE[k]})$")) for k in KINDS}, F.lit(False)) & ~F.col("accepted")
    found = found.withColumn("label", F.col("accepted").cast("double")) \
        .withColumn("weight", F.when(F.col("accepted") | failed, 1.0).otherwise(UNLABELLED)) \
        .withColumn("valid", _by_kind({k: _valid(k, F.col("m")) for k in KINDS}, F.lit(False)))
    found, names = features(found)
    assembler = VectorAssembler(inputCols=names, outputCol="vector")
    tally = assembler.transform(_tally(found, names, stage).withColumn("mass", F.col("weight") * F.col("n")))
    counts = {(r["label"], r["half"]): r["n"] for r in tally.groupBy("label", "half").agg(F.sum("n").alias("n")).collect()}
    if any(counts.get((y, h), 0) < LEAST_CLASS for y in (0.0, 1.0) for h in (0, 1)):
        return None
    p = vector_to_array("probability")[1]
    half = F.col("half")
    held = [_learn(tally.where(half == h)).transform(tally.where((half != h) & F.col("valid"))) for h in (0, 1)]
    # precision above each of BINS thresholds, by kind: a table of bounded size
    bins = held[0].union(held[1]).groupBy("kind", F.floor(p * BINS).alias("bin")) \
        .agg(F.sum("mass").alias("mass"), F.sum(F.col("label") * F.col("n")).alias("good")).collect()
    least = {}
    for k in KINDS:
        up = good = 0
        for r in sorted((r for r in bins if r["kind"] == k and r["bin"] >= EVEN * BINS), key=lambda r: -r["bin"]):
            up, good = up + r["mass"], good + r["good"]
            if good >= PRECISION * up:
                least[k] = r["bin"] / BINS
    threshold = _by_kind({k: F.lit(t) for k, t in least.items()}, F.lit(2.0))
    above = _learn(tally).transform(assembler.transform(found.where("valid and not meets"))).withColumn("score", p) \
        .where(F.col("score") >= threshold)
    return above.select("id", "th", "kind", "s", "e", "m", "score")


def _best(scored: DataFrame) -> DataFrame:
    """(id, th, added): of spans that meet, the best (then first) stays; spans that meet directly or through others are a cluster."""
    before = Window.partitionBy("id", "th").orderBy("s", "e", "kind").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("id", "th").orderBy("s", "e", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce((F.col("s") >= F.max("e").over(before)).cast("int"), F.lit(1))
    clusters = scored.withColumn("fresh", fresh).withColumn("cluster", F.sum("fresh").over(upto)) \
        .groupBy("id", "th", "cluster").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), "s", "e", "kind", "m"))).alias("c"))
    kept = F.aggregate("c", F.array().cast(SPAN), lambda a, x: F.when(F.exists(a, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])), a).otherwise(
        F.concat(a, F.array(F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"))))))
    return clusters.withColumn("kept", kept).groupBy("id", "th").agg(F.flatten(F.collect_list("kept")).alias("added"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, base, added: arrays of (kind, s, e, m)."""
    stage = Stage(docs.sparkSession, "pii")
    all_ = stage.put(candidates(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))), "candidates")
    found = stage.put(labelled(all_), "labelled")
    scored = _score(found, stage)
    empty = F.array().cast(SPAN)
    if scored is None:
        return all_.select(F.col("id").alias(id_col), "base", empty.alias("added"))
    best = stage.put(_best(scored).select(F.col("id").alias("id2"), F.col("th").alias("th2"), "added"), "added")
    joined = all_.join(best, (F.col("th") == F.col("th2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
    return joined.select(F.col("id").alias(id_col), "base", F.coalesce("added", empty).alias("added"))


def spans_text(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report row of each document from ``find_spans``' output."""
    def count(k: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    return found.select(id_col, *map(count, KINDS), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(text: Column, spans: Column) -> Column:
    """Text with each span replaced by its kind in brackets; spans that meet are one stretch, named by the first (then longest)."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))))

    def cut(given: Column) -> Column:
        xs, chars = given["xs"], given["chars"]

        def between(a: Column, b: Column) -> Column:
            return F.array_join(F.slice(chars, a + 1, F.greatest(b - a, F.lit(0))), "")

        def pieces(ends: Column) -> Column:
            at = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
            each = F.transform(xs, lambda x, i: F.when((x["s"] < at(i)) & (i > 0), F.lit("")).otherwise(
                F.concat(between(at(i), x["s"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))))
            return F.concat(F.array_join(each, ""), between(F.element_at(ends, -1), F.size(chars)))

        return _let(running(F.transform(xs, lambda x: -x["e"]), "max"), pieces)

    # by characters: substrings of a text count from its start each time
    given = F.struct(ordered.alias("xs"), F.split(text, "").alias("chars"))
    return F.when(F.size(spans) > 0, _let(given, cut)).otherwise(text)
