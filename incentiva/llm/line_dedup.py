"""Line deduplication by winnowing: later copies of repeated passages are deleted.

A passage is a run of consecutive non-blank lines with at least ``min_words`` words. Every
line goes that lies in a passage which also stands at an earlier place, whatever is around it.
Only DataFrame functions are used.

1. Each document becomes arrays over its non-blank lines: position, hash of the trimmed
   line, number of words.
2. Windows: from each line the fewest lines that hold ``min_words`` words, and to each line the
   fewest that end there. Both depend on the passage alone, so equal passages have equal windows,
   and every line of a passage is in a window inside it. A document has at most two a line.
3. Winnowing: each window selects its least line (the first of the least hash). The fingerprint is that
   line's hash with its place in the window and the hash of the window. (The line alone would be too little: a
   frequent short line is the least of many unlike windows, and its first place says nothing about the others.)
4. Fingerprints are joined with the first position (least doc_id, then line) of their minimum, so a
   window in a million documents gives a million rows, never pairs of them.
5. A joined pair of minima is extended both ways, back to the first and on to the last line of the window: so far
   its hash vouches that both places are equal, and where they go on to be, the next window's minimum is
   joined as well. Extended matches that overlap or touch are one repeated run (within one document, so
   a run may follow several earlier ones). Runs are deleted; every deleted line has an
   equal line earlier, so a first copy always stays. (Extending each aligned pair of documents as far as it goes
   finds the same lines, at a cost that grows with the square of a text of repeated lines.)

Words are runs of characters that are not white space; in Han and kana, which have no spaces, each character is
one. Lines are compared without white space at their ends, so \\r\\n and \\n copies are alike. Windows are
equal if a 64-bit and a 32-bit hash of them are. Blank lines between deleted lines go with them.

Defined cases: null text stays null; text without newline is one line; rows with equal id and
equal text are one document and get the same result; a null id comes before all others. Other
columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, lookup

MIN_WORDS = 50
#: The table of deletions is broadcast up to so many intervals (24 bytes each).
BROADCAST_INTERVALS = 500_000
#: White space at the ends of lines, as characters of a SQL text.
ENDS = " \\t\\r\\u000B\\u000C\\u0085\\u00A0\\u1680\\u2000\\u2001\\u2002\\u2003\\u2004\\u2005\\u2006\\u2007\\u2008\\u2009\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
_DENSE = "\\\\p{IsHan}\\\\p{IsHiragana}\\\\p{IsKatakana}"
_BLANK = "\\\\x09-\\\\x0D\\\\x20\\\\x85\\\\xA0\\\\u1680\\\\u2000-\\\\u200A\\\\u2028\\\\u2029\\\\u202F\\\\u205F\\\\u3000"
WORD = f"[{_DENSE}]|[^{_BLANK}{_DENSE}]+"
#: Texts of these characters only, without two spaces in a row, have single spaces between words: no other white space, no Han or kana.
PLAIN = "\\\\A[\\\\x20-\\\\x84\\\\n\\\\x86-\\\\x9F\\\\xA1-\\\\u167F\\\\u2010-\\\\u2027\\\\u2030-\\\\u205E]*+\\\\z"


def line_arrays(docs: DataFrame) -> DataFrame:
    """From columns id, text: id, th (hash of the text), and arrays at, h, g, w over the non-blank lines."""
    # o: whether words and line ends need the wider rules, found once a text
    odd = f"not text rlike '{PLAIN}' or contains(text, '  ')"
    trimmed = f"struct(i as i, o as o, if(o, trim(BOTH '{ENDS}' FROM l), trim(l)) as l)"
    lines = f"filter(transform(split(text, '\\\\n'), (l, i) -> {trimmed}), x -> x.l <> '')"
    words = f"if(y.o, regexp_count(y.l, '{WORD}'), length(y.l) - length(replace(y.l, ' ', '')) + 1)"
    return (docs.where("text is not null")
            .select("id", F.xxhash64("text").alias("th"), F.expr(f"element_at(transform(array({odd}), o -> {lines}), 1)").alias("x"))
            .where("size(x) > 0")
            .select("id", "th", F.expr("transform(x, y -> y.i)").alias("at"),
                    F.expr("transform(x, y -> xxhash64(y.l))").alias("h"), F.expr("transform(x, y -> hash(y.l))").alias("g"),
                    F.expr(f"transform(x, y -> {words})").alias("w")))


def fingerprints(lines: DataFrame, min_words: int) -> DataFrame:
    """(id, th, m, back, on, f, g): of each window the position of its least line (non-blank lines from 0), the lines before
    and after it in the window, and the fingerprint; at_s, at_e: the line numbers of the window's ends."""
    # the last line of the shortest window from i; null if the rest of the document has fewer words
    end = (f"aggregate(slice(w, i + 1, {min_words}), struct(0 as n, 0 as s), "
           f"(a, x) -> if(a.s >= {min_words}, a, struct(a.n + 1 as n, a.s + x as s)), a -> if(a.s >= {min_words}, i + a.n - 1, null))")
    # from i also up to each line that no later start reaches: the shortest windows that end there
    from_i = "if(x is null, array(), transform(sequence(x, greatest(x, coalesce(get(ends, i + 1), size(h)) - 1)), j -> struct(i as s, j as e)))"
    hashed = ("transform(win, x -> struct(x.s as s, x.e as e, at[x.s] as at_s, at[x.e] as at_e, slice(h, x.s + 1, x.e - x.s + 1) as hs, "
              "hash(slice(g, x.s + 1, x.e - x.s + 1)) as g))")
    least = "transform(hashed, x -> struct(x, array_min(x.hs) as low, int(array_position(x.hs, array_min(x.hs)) - 1) as back))"
    return (lines.withColumn("ends", F.expr(f"transform(sequence(0, size(h) - 1), i -> {end})"))
            .withColumn("win", F.expr(f"flatten(transform(ends, (x, i) -> {from_i}))"))
            .withColumn("hashed", F.expr(hashed)).select("id", "th", F.explode(F.expr(least)).alias("y"))
            .select("id", "th", (F.col("y.x.s") + F.col("y.back")).alias("m"), F.col("y.back").alias("back"),
                    (F.col("y.x.e") - F.col("y.x.s") - F.col("y.back")).alias("on"), F.col("y.x.at_s").alias("at_s"), F.col("y.x.at_e").alias("at_e"),
                    F.xxhash64("y.low", "y.back", "y.x.hs").alias("f"), F.col("y.x.g").alias("g")))


def repeated_runs(lines: DataFrame, stage: Stage, min_words: int) -> DataFrame:
    """(id, th, runs): the intervals of line numbers to delete, of each document that has any."""
    found = stage.put(fingerprints(lines, min_words), "fingerprints")
    first = stage.put(found.groupBy("f", "g").agg(F.min(F.struct("id", "th", "m")).alias("first"), F.count("*").alias("n"))
                      .where("n > 1"), "first")
    # rows with equal id and text are one document: their windows are equal places
    later = lookup(found, first, ["f", "g"], stage, "first", n_col="n").where("first is not null and not (id <=> first.id and th = first.th and m = first.m)")
    # extended both ways from the minimum; of the windows from a line, the longest
    extended = later.groupBy("id", "th", (F.col("m") - F.col("back")).alias("s"), "at_s").agg(
        F.max(F.struct((F.col("m") + F.col("on")).alias("e"), "at_e")).alias("end"))
    cut = extended.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("s", "end.e", "at_s", "end.at_e"))).alias("x"))
    # sorted by start the windows are sorted by end too; those that overlap or touch are one run
    begins = "transform(filter(x, (r, i) -> i = 0 or r.s > x[i - 1].e + 1), r -> r.at_s)"
    ends = "transform(filter(x, (r, i) -> i = size(x) - 1 or x[i + 1].s > r.e + 1), r -> r.at_e)"
    return stage.put(cut.select("id", "th", F.expr(f"zip_with({begins}, {ends}, (s, e) -> struct(s, e))").alias("runs")), "runs")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated passages deleted from ``text_col``, and a column, deleted_lines (last)."""
    names = docs.columns
    stage = Stage(docs.sparkSession, "line-dedup")
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    lines = stage.put(line_arrays(df.select(key.alias("id"), text.cast("string").alias("text"))), "lines")
    runs = repeated_runs(lines, stage, min_words)
    if (runs.agg(F.sum(F.size("runs"))).first()[0] or 0) <= BROADCAST_INTERVALS:
        runs = F.broadcast(runs)
    joined = df.join(runs, key.eqNullSafe(F.col("id")) & (F.xxhash64(text.cast("string")) == F.col("th")), "left")
    # stretches of kept lines between the runs (sorted by start, they may overlap)
    joined = joined.withColumn("lines", F.when(F.col("runs").isNotNull(), F.split(text, "\n"))).withColumn("kept", F.expr(
        "aggregate(runs, struct(0 as at, cast(array() as array<struct<s: int, n: int>>) as kept), "
        "(a, r) -> struct(greatest(a.at, r.e + 1) as at, if(r.s > a.at, concat(a.kept, array(struct(a.at as s, r.s - a.at as n))), a.kept) as kept), "
        "a -> if(size(lines) > a.at, concat(a.kept, array(struct(a.at as s, size(lines) - a.at as n))), a.kept))"))
    joined = joined.withColumn("kept", F.expr("flatten(transform(kept, k -> slice(lines, k.s + 1, k.n)))"))
    gone = F.when(F.col("runs").isNull(), 0).otherwise(F.size("lines") - F.size("kept"))
    out = [F.when(F.col("runs").isNull(), text).otherwise(F.array_join("kept", "\n")) if n == text_col else F.col(f"c{i}")
           for i, n in enumerate(names)]
    return joined.select(*out, gone.cast("long")).toDF(*names, "deleted_lines")


def drop_repeated(docs: DataFrame, **params) -> DataFrame:
    """``docs`` after line deduplication; documents of which nothing but blanks is left, where lines were deleted, are dropped."""
    names = docs.columns
    df = dedup_lines(docs, **params).toDF(*[f"c{i}" for i in range(len(names))], "gone")
    text = F.col(f"c{names.index(params.get('text_col', 'text'))}")
    return df.where((F.col("gone") == 0) | (F.trim(F.translate(text, "\n\t\r", "")) != "")).drop("gone").toDF(*names)
