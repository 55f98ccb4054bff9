
from __future__ import annotations

import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incentiva.functions import ladder as L
from incentiva.functions.scalars import share
from incentiva.operators import portfolio as P
from incentiva.params import NEW_LADDER, OLD_LADDER, Ladder

# (graduates, portfolio, share, unit, payout, next target, next count)
OLD_CASES = [
    (0, 100, "0.0000", 0, 0, "0.03", "3"), (2, 100, "0.0200", 0, 0, "0.03", "3"),
    (1, 34, "0.0294", 0, 0, "0.03", "2"), (3, 100, "0.0300", 40, 120, "0.06", "6"),
    (6, 100, "0.0600", 50, 300, "0.10", "10"), (10, 100, "0.1000", 60, 600, "0.15", "15"),
    (15, 100, "0.1500", 70, 1050, "0.20", "20"), (20, 100, "0.2000", 85, 1700, "0.25", "25"),
    (24, 100, "0.2400", 85, 2040, "0.25", "25"), (25, 100, "0.2500", 100, 2500, "max", "max"),
    (57, 100, "0.5700", 100, 5700, "max", "max"), (1, None, None, 0, 0, "0.03", None),
    (3, 0, None, 0, 0, "0.03", "0"),
]
NEW_CASES = [
    (1, 100, "0.0100", 0, 0, "0.02", "2"), (2, 100, "0.0200", 60, 120, "0.04", "4"),
    (4, 100, "0.0400", 75, 300, "0.07", "7"), (7, 100, "0.0700", 90, 630, "0.11", "11"),
    (11, 100, "0.1100", 100, 1100, "0.14", "14"), (14, 100, "0.1400", 130, 1820, "0.18", "18"),
    (18, 100, "0.1800", 150, 2700, "max", "max"), (1, None, None, 0, 0, "0.02", None),
]


def _apply(spark, pairs, ladder: Ladder):
    df = spark.createDataFrame(pairs, "g bigint, c int")
    sh = share(F.col("g"), F.col("c"))
    return (
        df.withColumn("share", sh)
        .select(
            "g", "c", "share",
            L.unit_rate(F.col("share"), ladder).alias("unit"),
            L.payout(F.col("g"), F.col("share"), ladder).alias("pay"),
            L.next_target(F.col("share"), ladder).alias("meta"),
            L.next_target_count(F.col("c"), F.col("share"), ladder).alias("cnt"),
            L.next_target_share(F.col("share"), ladder).alias("meta_typed"),
        )
        .collect()
    )


@pytest.mark.parametrize("ladder, cases", [(OLD_LADDER, OLD_CASES), (NEW_LADDER, NEW_CASES)])
def test_ladder_golden(spark, ladder, cases):
    rows = _apply(spark, [(g, c) for g, c, *_ in cases], ladder)
    for r, (g, c, sh, unit, pay, meta, count) in zip(rows, cases):
        assert (r.g, r.c) == (g, c)
        assert r.share == (None if sh is None else Decimal(sh)), (g, c)
        assert (r.unit, r.pay, r.meta, r.cnt) == (unit, pay, meta, count), (g, c)
        assert r.meta_typed == (None if meta == "max" else Decimal(meta))


def test_totals_through_join_with_missing_and_split_advisor(spark):
    # advisor o1 is split across two mentors: each row's share is over the whole portfolio
    grad = spark.createDataFrame(
        [("m1", "o1", "s1", 1), ("m1", "o1", "s2", 1), ("m2", "o1", "s3", 1), ("m1", "o9", "s4", 1)],
        "mentora string, orientador string, store_url string, flag_graduado int",
    )
    size = spark.createDataFrame([("o1", 100, 50)], "orientador string, cartera int, cartera_nuevos int")
    got = {(r.mentora, r.orientador): (r.porc_graduados, r.cartera, r.total_graduados, r.porc_meta, r.emprendedores_meta)
           for r in P.portfolio_totals_all(grad, size, populations=["old"]).collect()}
    assert got == {
        ("m1", "o1"): (Decimal("0.0200"), 100, 2, "0.03", "3"),
        ("m2", "o1"): (Decimal("0.0100"), 100, 1, "0.03", "3"),
        ("m1", "o9"): (None, None, 1, "0.03", None),
    }


def _share_ref(g: int, c: int | None) -> Decimal | None:
    if c is None or c == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 60
        q = Decimal(g) / Decimal(c)
        q6 = q.quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        return q6.quantize(Decimal("0.0001"), rounding=ROUND_DOWN)


def _band_ref(p: Decimal | None, c: int | None, g: int, ladder: Ladder):
    """The original's band form, evaluated in Python."""
    rs = ladder.rungs
    unit = 0
    if p is not None:
        for r in reversed(rs):
            if p >= r.threshold:
                unit = r.rate
                break
    if p is not None and p >= ladder.top.threshold:
        return unit, g * unit, "max", "max"
    nxt = ladder.lowest.threshold
    if p is not None:
        for lo, hi in zip(rs[:-1], rs[1:]):
            if lo.threshold <= p < hi.threshold:
                nxt = hi.threshold
    count = None if c is None else str(int((Decimal(c) * nxt).to_integral_value(rounding="ROUND_CEILING")))
    return unit, g * unit, str(nxt), count


@pytest.mark.parametrize("ladder", [OLD_LADDER, NEW_LADDER], ids=["old", "new"])
def test_ladder_exhaustive_small_portfolios(spark, ladder):
    pairs = spark.range(1, 301).select(F.col("id").cast("int").alias("c")).withColumn(
        "g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c").cast("bigint"))))
    sh = share(F.col("g"), F.col("c"))
    rows = pairs.withColumn("share", sh).select(
        "g", "c", "share",
        L.unit_rate(F.col("share"), ladder).alias("unit"),
        L.payout(F.col("g"), F.col("share"), ladder).alias("pay"),
        L.next_target(F.col("share"), ladder).alias("meta"),
        L.next_target_count(F.col("c"), F.col("share"), ladder).alias("cnt"),
    ).collect()
    assert len(rows) == sum(c + 1 for c in range(1, 301))
    for r in rows:
        p = _share_ref(r.g, r.c)
        assert r.share == p
        assert (r.unit, r.pay, r.meta, r.cnt) == _band_ref(p, r.c, r.g, ladder), (r.g, r.c)


def test_share_exact_on_large_portfolios(spark):
    rnd = random.Random(7)
    pairs = [(g, c) for c in (20_043, 20_067, 2_000_000, 123_456_789) for g in (1, 601, c // 33, c // 7, c - 1)]
    pairs += [(rnd.randrange(0, 10**7), rnd.randrange(1, 10**8)) for _ in range(500)]
    # quotients just below a rounding boundary at the 6th digit
    pairs += [(600, 20_001), (3, 100_000_001), (1, 2_000_000), (1, 1_999_999), (1, 2_000_001)]
    df = spark.createDataFrame(pairs, "g bigint, c int").select("g", "c", share(F.col("g"), F.col("c")).alias("s"))
    for r in df.collect():
        assert r.s == _share_ref(r.g, r.c), (r.g, r.c)


def test_share_strict_raises_on_zero(spark):
    df = spark.createDataFrame([(1, 0)], "g bigint, c int")
    with pytest.raises(PySparkException):
        df.select(share(F.col("g"), F.col("c"), strict=True)).collect()


def test_ladder_rejects_float_thresholds():
    with pytest.raises(TypeError):
        Ladder.of((0.03, 40))  # type: ignore[arg-type]
    with pytest.raises(ValueError):
        Ladder.of(("0.06", 50), ("0.03", 40))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@st.composite
def ladders(draw):
    cents = draw(st.lists(st.integers(1, 60), min_size=1, max_size=8, unique=True))
    rates = draw(st.lists(st.integers(1, 500), min_size=len(cents), max_size=len(cents)))
    return Ladder.of(*[(f"0.{c:02d}", r) for c, r in zip(sorted(cents), rates)])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ladder=ladders(), pairs=st.lists(st.tuples(st.integers(0, 5000), st.one_of(st.none(), st.integers(0, 5000))),
                                        min_size=1, max_size=60))
def test_any_ladder_matches_band_form(spark, ladder, pairs):
    rows = _apply(spark, pairs, ladder)
    for r in rows:
        p = _share_ref(r.g, r.c)
        assert r.share == p
        assert (r.unit, r.pay, r.meta, r.cnt) == _band_ref(p, r.c, r.g, ladder), (r.g, r.c, ladder)


def test_truncate_to_cuts_toward_zero(spark):
    from incentiva.functions.scalars import truncate_to

    df = spark.createDataFrame([(Decimal(v),) for v in ("0.56999", "-0.56999", "1.00009", "0")], "x decimal(10,5)")
    got = [r.t for r in df.select(truncate_to(F.col("x"), 4).alias("t")).collect()]
    assert got == [Decimal("0.5699"), Decimal("-0.5699"), Decimal("1.0000"), Decimal("0.0000")]
