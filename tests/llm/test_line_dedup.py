"""Line deduplication against a plain version of the same rule, and its guarantees."""

import random

from incentiva.llm import line_dedup as LD

MIN = 6


def whole(rows, min_words):
    """Texts without the lines in a run of min_words words that stands anywhere earlier too; rows: distinct, sorted by id."""
    docs = [[(i, x.strip()) for i, x in enumerate(t.split("\n")) if x.strip()] for _, t in rows]
    seen, out = set(), {}
    for (key, text), ls in zip(rows, docs):
        gone = set()
        for i in range(len(ls)):
            for e in range(i, len(ls)):
                run = tuple(x for _, x in ls[i:e + 1])
                if sum(map(words, run)) >= min_words:
                    if run in seen:
                        gone.update(range(i, e + 1))
                    seen.add(run)
                if sum(map(words, run[1:])) >= min_words:
                    break  # a longer run from here is one of these and one from the next line
        lines = {ls[i][0] for i in gone} | {j for i in gone if i + 1 in gone for j in range(ls[i][0], ls[i + 1][0])}
        out[key] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines), len(lines)
    return out


def words(line):
    """Runs between white space; each Han or kana character is one."""
    spread = "".join(f" {c} " if "\u3040" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff" else c for c in line)
    return len(spread.split())


def run(spark, rows, min_words=MIN):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in LD.dedup_lines(df.repartition(4), min_words).collect()]
    each = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    want = whole(each, min_words)
    assert sorted(map(repr, got)) == sorted(repr((i, *(want[i] if t is not None else (None, 0)))) for i, t in rows)
    return {r[0]: r[1] for r in got}


def test_random_documents(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choice("abcdefg") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    rows = [(i, "\n".join(rng.choice(pool + ["", "  "]) for _ in range(rng.randrange(1, 14)))) for i in range(70)]
    passage = "\n".join(pool[3:9])
    rows += [(100 + i, f"own {i} line\n{passage}\nend {i} of it") for i in range(15)]
    got = run(spark, rows)
    assert sum(passage in (t or "") for t in got.values()) <= 1


def test_cases(spark):
    long = "one two three four five six seven"
    rows = [(None, long), (1, long), (2, None), (3, ""), (4, "\n\n"), (5, f"{long}\n{long}\n{long}"), (6, f"x\n{long}\ny"), (6, f"x\n{long}\ny"),
            (7, "short line"), (8, "short line"), (9, "\n".join(f"w{i} a b c" for i in range(3000)))]
    got = run(spark, rows)
    assert got[None] == long and got[1] == "" and got[5] == "" and got[6] == "x\ny" and got[7] == got[8] == "short line"
    assert run(spark, []) == {}


def test_white_space_and_scripts_without_spaces(spark):
    a, b = "one two three\tfour", "five  six seven"
    rows = [(1, f"{a}\n{b}\nend"), (2, f"start\r\n{a}\r\n{b}\r\nfin"), (3, f"\u00a0{a}\u3000\n\t{b} \nlast"), (4, "猫と犬が走る\n一二三\nx"), (5, "y\n猫と犬が走る \n一二三"),
            (6, "p q r s t"), (7, "p q r s t"), (8, "p  q\tr\u00a0s  t"), (9, "p  q\tr\u00a0s  t")]
    got = run(spark, rows)
    assert got[2] == "start\r\nfin" and got[3] == "last" and got[4].endswith("x") and got[5] == "y" and got[7] == rows[6][1] and got[9] == rows[8][1]


def test_texts_that_overlap_in_many_ways(spark):
    """Runs that begin in one document and go on in another, shifted copies in one document, and lists of like lines."""
    rng = random.Random(67)
    book = [" ".join(f"{rng.choice('abcdef')}{rng.randrange(9)}" for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            s = rng.randrange(50)
            parts += book[s: s + rng.randrange(1, 12)] + [f"own {i}"] * rng.randrange(2)
        rows.append((i, "\n".join(parts)))
    rows += [(100, "\n".join(["same line"] * 30)), (101, "\n".join(["same line"] * 12 + ["x"] + ["same line"] * 9))]
    for n in (5, 11):
        run(spark, rows, n)


def test_columns_and_dropping(spark):
    long = " ".join("abcdefghij")
    df = spark.createDataFrame([(1, long, 1, 2), (2, long, 3, 4), (3, long + "\nown", 5, 6), (4, "", 7, 8)], "doc_id bigint, text string, runs int, c0 int")
    kept = LD.drop_repeated(df, min_words=MIN)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, long, 1, 2), (3, "own", 5, 6), (4, "", 7, 8)]


def test_any_earlier_equal_run(spark):
    """Lines picked earlier in other contexts do not save a second copy."""
    rng = random.Random(66)
    pool = [" ".join(rng.choice("abcdefg") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 7))) for _ in range(14)]
    rows = [(i, "\n".join(rng.choice(pool + ["", " "]) for _ in range(rng.randrange(1, 14)))) for i in range(150)]
    for min_words in (6, 12, 20):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert {r["doc_id"]: (r["text"], r["deleted_lines"]) for r in LD.dedup_lines(df.repartition(4), min_words).collect()} == whole(rows, min_words)
