"""Language identification of whole texts, with spans of mixed-language text.

Learning: counts of character 1- to 3-grams of the letters of each language's documents,
summed by Spark per language and turned into log probabilities there. The ``MOST_LANGS`` most frequent labels
are learned (a documented bound, so that a dirty label column cannot grow the model): of each language
all labelled rows are read, unless the caller bounds them (``sample_rows`` a language; chosen by a hash of the row key; whole
texts). Of rows with other labels their letters by script are counted. The model is one table of log probabilities
per hashed n-gram and language, 384 KB a language, plus each language's share of scripts.

Prediction, one pass: a word is a run of letters and marks. Its script (by ranges of code
points) narrows the candidates to the languages that use it; its score for a candidate is
the sum of the log probabilities of its n-grams. Viterbi over the words of a document, with
a penalty for each switch of language, labels every word; neighbouring words of one label
are a span. Texts are taken in slices that shrink with the number of languages, and scores are summed in chunks of
CHUNK cells, so a task's memory does not grow with the languages. The document's language is the one whose spans hold most letters, its score
that share. All documents of a batch take their Viterbi steps together.

Defined cases: null text, or text without a letter, is ``und`` with score 0 and no spans. Words in
a script that no learned language uses count as letters of none; a text with only such
words gets the most frequent learned language with score 0. Ties go to the language that is
first in order of its name. With no labelled row at all every document is ``und``; the filter
of the pipeline then keeps all that have a letter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Rows are drawn by a hash below this.
DRAW = 1 << 53
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SWITCH_PENALTY = 12.0
SMOOTHING = 0.5
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
MOST_LANGS = 256
#: Bytes of text worked on at once, for up to four languages; with more in proportion less.
SLICE = 1_000_000
#: Cells (letters x languages) of scores held at once.
CHUNK = 4_000_000

#: Script ranges (first, last code point); what is in none is "other".
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F), (0xA8E0, 0xA8FF)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("telugu", [(0xC00, 0xC7F)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)]),
    ("han", [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]),
]
N_SCRIPTS = len(SCRIPTS) + 1


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: 1 for a letter, 2 for a mark; its lower case; its script."""
    top = 0x110000
    kind, lower, script = np.zeros(top, np.uint8), np.arange(top, dtype=np.uint32), np.full(top, N_SCRIPTS - 1, np.uint8)
    for p in range(0x40000):
        if 0xD800 <= p < 0xE000:
            continue
        c = unicodedata.category(chr(p))
        if c[0] == "L":
            kind[p] = 1
            if c in ("Lu", "Lt") and len(s := chr(p).lower()) == 1:
                lower[p] = ord(s)
        elif c[0] == "M":
            kind[p] = 2
    for k, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            script[a: b + 1] = k
    return kind, lower, script


@dataclass
class Letters:
    """Words of a slice of rows: start, end (in the joined code points), row; grams: bucket of each order at each position."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    at: np.ndarray  # where each row begins in the joined code points
    letters: np.ndarray  # of each word
    scripts: np.ndarray  # of each word: that of its first letter
    grams: list[np.ndarray]
    inside: np.ndarray  # positions that belong to words, in order
    first: np.ndarray  # where each word begins among them


def read_letters(texts: list[str | None]) -> Letters:
    kind, lower, script = _tables()
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    k = kind[points]
    word = k > 0
    edge = np.zeros(len(points) + 1, bool)
    edge[at] = True
    start = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:-1])) if len(points) else np.zeros(0, np.int64)
    end = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1 if len(points) else np.zeros(0, np.int64)
    # a run of marks alone is no word
    upto = np.zeros(len(points) + 1, np.int64)
    np.cumsum(k == 1, out=upto[1:])
    letters = upto[end] - upto[start]
    start, end, letters = start[letters > 0], end[letters > 0], letters[letters > 0]
    size = end - start
    first = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) + np.repeat(start - first, size)
    low = lower[points[inside]].astype(np.uint64)
    # letters before the first of a word count as 0, so prefixes are n-grams of their own
    head = np.arange(len(inside)) - np.repeat(first, size)
    grams, h = [], np.zeros(len(inside), np.uint64)
    for n in ORDERS:
        back = np.zeros(len(inside), np.uint64)
        if n == 1:
            back = low
        else:
            back[n - 1:] = low[: len(low) - n + 1]
            back[head < n - 1] = 0
        h = (h ^ (back + np.uint64(n))) * np.uint64(0x9E3779B97F4A7C15)
        grams.append(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(BUCKETS))
    row = np.searchsorted(at, start, side="right") - 1
    return Letters(start, end, row, at, letters, script[points[start]] if len(start) else np.zeros(0, np.uint8), grams, inside, first)


@dataclass
class Model:
    langs: list[str]
    score: list[np.ndarray]  # for each order (BUCKETS, languages), float32
    uses: np.ndarray  # (scripts, languages)
    common: int  # the most frequent language
    whole: bool  # there are labelled rows, and all were learned from
    other: np.ndarray | None = None  # scripts in which labelled rows that were not learned from may be (None: any, or none if whole)

    def telling(self) -> np.ndarray:
        """For each script, whether its letters tell something about a text without a label: unknown ones do if no labelled row has them."""
        if self.whole:
            return np.ones(N_SCRIPTS, bool)
        known = self.uses.any(axis=1)
        return known if self.other is None else known | ~self.other


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language of this task's rows, one row of fixed size for each language."""
    kept: dict[str, np.ndarray] = {}
    for whole in batches:
        for b in text_slices(whole, "text"):
            langs = b.column("lang").to_pylist()
            w = read_letters(b.column("text").to_pylist())
            of_word = np.array(langs, object)[w.row] if len(w.row) else np.zeros(0, object)
            for lang in set(langs):
                mine = of_word == lang
                c = kept.setdefault(lang, np.zeros(len(ORDERS) * BUCKETS + N_SCRIPTS + 1, np.int64))
                c[-1] += langs.count(lang)
                c[-1 - N_SCRIPTS:-1] += np.bincount(w.scripts[mine], w.letters[mine], N_SCRIPTS).astype(np.int64)
                at = np.repeat(mine, w.end - w.start)
                for k, g in enumerate(w.grams):
                    c[k * BUCKETS:(k + 1) * BUCKETS] += np.bincount(g[at].astype(np.int64), minlength=BUCKETS)
    for lang, c in kept.items():
        cell = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell)), pa.array(cell), pa.array(c[cell])], ["lang", "cell", "n"])


def _scripts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scripts of this task's words."""
    found = np.zeros(N_SCRIPTS, bool)
    for whole in batches:
        for b in text_slices(whole, "text"):
            found[read_letters(b.column("text").to_pylist()).scripts] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found).astype(np.int32))], ["script"])


def _model_row(counts: pa.Table) -> pa.Table:
    """One language's log probabilities and letters by script, from its counts."""
    c = np.zeros(len(ORDERS) * BUCKETS + N_SCRIPTS + 1)
    c[counts.column("cell").to_numpy()] = counts.column("n").to_numpy()
    grams = c[:len(ORDERS) * BUCKETS].reshape(len(ORDERS), BUCKETS) + SMOOTHING
    score = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    return pa.table({"lang": counts.column("lang").slice(0, 1), "score": pa.array([score.tobytes()], pa.binary()),
                     "scripts": pa.array([c[-1 - N_SCRIPTS:-1].tolist()], pa.list_(pa.float64()))})


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        sample_rows: int | None = None, most_langs: int = MOST_LANGS) -> Model:
    """The model from rows with a language; of each one all rows, or about ``sample_rows``, if given, chosen by a hash of ``key_col``.

    Of labels beyond ``most_langs`` the most frequent are learned (ties by name); of the rest only the scripts are. The driver
    gets one row for each of those learned: its size, and then its finished row of the model.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                F.pmod(F.xxhash64(F.col(key_col), F.lit("sample")), F.lit(DRAW)).alias("draw"))
    # the least draw of a language is always in, so none is lost
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).orderBy(F.desc("n"), "lang").limit(most_langs + 1).collect()
    all_langs = len(sizes) <= most_langs
    sizes = {r["lang"]: (r["n"], r["least"]) for r in sizes[:most_langs]}
    rest = None
    if not all_langs:
        rest = rows.where(~F.col("lang").isin(*sizes)).select("text")
        rows = rows.where(F.col("lang").isin(*sizes))
    upto = {x: max(least, DRAW * sample_rows // n) for x, (n, least) in sizes.items() if sample_rows is not None and n > sample_rows}
    if upto:
        bound = F.create_map(*[F.lit(v) for pair in upto.items() for v in pair])
        rows = rows.where(F.col("draw") <= F.coalesce(bound[F.col("lang")], F.lit(DRAW)))
    counts = rows.select("lang", "text").mapInArrow(_count, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = counts.groupBy("lang").applyInArrow(_model_row, "lang string, score binary, scripts array<double>").orderBy("lang").toArrow()
    langs = table.column("lang").to_pylist()
    score = [np.zeros((BUCKETS, len(langs)), np.float32) for _ in ORDERS]
    for i, row in enumerate(table.column("score")):
        for k, part in enumerate(np.frombuffer(row.as_buffer(), np.float32).reshape(len(ORDERS), BUCKETS)):
            score[k][:, i] = part
    by_script = np.array(table.column("scripts").to_pylist()).reshape(len(langs), N_SCRIPTS)
    uses = (by_script >= SCRIPT_SHARE * np.maximum(by_script.sum(axis=1, keepdims=True), 1)).T & (by_script.T > 0)
    other = None
    if rest is not None and not upto:
        other = np.zeros(N_SCRIPTS, bool)
        other[[r["script"] for r in rest.mapInArrow(_scripts, "script int").distinct().collect()]] = True
    return Model(langs, score, uses, int(np.argmax([sizes[x][0] for x in langs])) if langs else 0, bool(langs) and not upto and all_langs, other)


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word. score: (words, labels); the words of sequence i are first[i]:first[i+1].

    Step t treats the t-th word of all sequences at once, longest sequences first.
    """
    n, size = len(first) - 1, np.diff(first)
    order = np.argsort(-size, kind="stable")
    order = order[: np.count_nonzero(size)]
    begin, size = first[:-1][order], size[order]
    label = np.zeros(len(score), np.int16)
    if not len(order):
        return label
    kind = np.int8 if score.shape[1] <= 127 else np.int16
    came = np.zeros(score.shape, kind)
    alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # sequences with a t-th word
    best = score[begin].astype(np.float64)
    final = np.zeros((len(order), score.shape[1]))
    own = np.arange(score.shape[1], dtype=kind)
    for t in range(1, int(size[0])):
        m = alive[t]
        if m < len(best):
            final[m: len(best)] = best[m:]
            best = best[:m]
        top = best.argmax(axis=1)
        moved = best[np.arange(m), top] - penalty
        stay = best >= moved[:, None]
        came[begin[:m] + t] = np.where(stay, own, top[:, None].astype(kind))
        best = np.where(stay, best, moved[:, None]) + score[begin[:m] + t]
    final[: len(best)] = best
    now = final.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        m = alive[t]
        label[begin[:m] + t] = now[:m]
        now[:m] = came[begin[:m] + t, now[:m]] if t else now[:m]
    return label


def word_scores(w: Letters, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(words, languages) scores, and which words have a candidate at all."""
    score = np.full((len(w.first), len(m.langs)), np.float32(-1e6))
    known = m.uses.any(axis=1)[w.scripts]
    # no candidate: the word says nothing, so the label of its neighbours goes on
    score[~known] = 0
    # only the languages that use some script of these words
    cols = np.flatnonzero(m.uses[np.unique(w.scripts)].any(axis=0)) if len(w.first) else np.zeros(0, np.int64)
    if not len(cols):
        return score, known
    every = len(cols) == len(m.langs)
    ends = np.append(w.first[1:], len(w.inside))
    step, s = max(1, CHUNK // len(cols)), 0
    while s < len(w.first):
        e = max(s + 1, int(np.searchsorted(ends, w.first[s] + step, side="right")))
        a, b = int(w.first[s]), int(ends[e - 1])
        total = np.zeros((b - a, len(cols)), np.float32)
        for g, table in zip(w.grams, m.score):
            part = table[g[a:b].astype(np.int64)]
            total += part if every else part[:, cols]
        summed = np.add.reduceat(total, w.first[s:e] - a, axis=0)
        here = m.uses[w.scripts[s:e]][:, cols]
        score[s:e, cols] = np.where(known[s:e, None], np.where(here, summed, np.float32(-1e6)), np.float32(0))
        s = e
    return score, known


def _predict(batches: Iterator[pa.RecordBatch], model, text_at: int, kind: pa.DataType, penalty: float,
             spans: bool) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    for whole in batches:
        for b in text_slices(whole, text_at, SLICE * 4 // max(4, len(m.langs))):
            found = pa.array(_predict_rows(b.column(text_at).to_pylist(), m, penalty, spans), kind)
            yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, "found"])


def _predict_rows(texts: list, m: Model, penalty: float, spans: bool) -> list[dict]:
    w = read_letters(texts)
    n, k = len(texts), len(m.langs)
    first = np.searchsorted(w.row, np.arange(n + 1))
    letters = np.bincount(w.row, w.letters, n)
    if not k:
        return [{"lang_pred": "und", "score": 0.0, "spans": [], "letters": int(x), "known": 0.0, "telling": 0.0} for x in letters]
    score, known = word_scores(w, m)
    label = viterbi(score, first, penalty)
    weight = np.bincount(w.row * k + label, w.letters * known, n * k).reshape(n, k)
    sure = weight.sum(axis=1)
    top = np.where(sure > 0, weight.argmax(axis=1), m.common)
    share = weight[np.arange(n), top] / np.maximum(letters, 1)
    known_share = sure / np.maximum(letters, 1)
    telling = np.bincount(w.row, w.letters * m.telling()[w.scripts], n) / np.maximum(letters, 1)
    each: list[list] = [[] for _ in range(n)]
    if spans and len(w.row):
        shown = np.where(known, label, -1)
        cut = np.flatnonzero(np.concatenate([[True], (shown[1:] != shown[:-1]) | (w.row[1:] != w.row[:-1])]))
        last = np.append(cut[1:], len(shown)) - 1
        for r, s, e, v in zip(w.row[cut].tolist(), (w.start[cut] - w.at[w.row[cut]]).tolist(),
                              (w.end[last] - w.at[w.row[cut]]).tolist(), shown[cut].tolist()):
            each[r].append({"start": s, "end": e, "lang": m.langs[v] if v >= 0 else "und"})
    return [{"lang_pred": m.langs[top[i]] if letters[i] else "und", "score": float(share[i]), "spans": each[i],
             "letters": int(letters[i]), "known": float(known_share[i]), "telling": float(telling[i])} for i in range(n)]


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH_PENALTY, spans: bool = True) -> DataFrame:
    """``docs`` with a struct column, found: lang_pred, score, spans (code points [start, end) and language), letters, known, telling.

    known: the share of letters in words of a script that a learned language uses; telling: that, and of a script in which
    no labelled row is.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    kind = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))),
        T.StructField("letters", T.LongType()), T.StructField("known", T.DoubleType()), T.StructField("telling", T.DoubleType())])
    names = docs.columns
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    df = df.mapInArrow(partial(_predict, model=sent, text_at=names.index(text_col), kind=to_arrow_type(kind), penalty=penalty,
                               spans=spans), T.StructType([*df.schema.fields, T.StructField("found", kind)]))
    return df.toDF(*names, "found")


#: A document is rejected if less than this share of its letters is in its language.
LEAST_SCORE = 0.25


def keep_identified(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE, lang_col: str = "lang") -> DataFrame:
    """``docs`` without those that have no letter or no predominant known language; columns unchanged.

    Letters of scripts that the model does not know tell against a document only if it has no label
    (``lang_col``, if there is one) and no labelled row that was not learned from may be in that script; else the
    others decide. ``fit`` reads all labelled rows unless its caller bounds them, so this does not turn on how many there are.
    """
    names = docs.columns
    df = identify(docs, model, spans=False).toDF(*[f"c{i}" for i in range(len(names))], "found")
    judged = F.col("found.telling")
    if lang_col in names:
        judged = F.when(F.col(f"c{names.index(lang_col)}").isNotNull(), F.col("found.known")).otherwise(judged)
    kept = (F.col("found.letters") > 0) & (F.col("found.score") >= least_score * judged)
    if model.langs:
        kept &= F.col("found.lang_pred") != "und"
    return df.where(kept).drop("found").toDF(*names)
