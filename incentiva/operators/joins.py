"""Join helpers: size-checked broadcast and dimension multiplicity.

* ``checked_broadcast`` hints a broadcast only when a dimension's measured size
  (rows and bytes, from one small distributed aggregate over it or over the
  table it derives from) is under both limits; otherwise the join is left to a
  shuffle join (and to AQE's run-time re-planning).
* ``with_multiplicity`` collapses duplicate dimension rows into one row with a
  count. Joining that and multiplying the measure by the count gives the same
  sums as joining the raw rows (duplicates multiply, as in the original SQL),
  but every fact row meets at most one dimension row per distinct value.
* ``salted_join`` is a shuffle join in which missing and measured heavy keys are
  spread over many tasks, whatever the session's skew settings.
* ``times`` is that product, exact at any scale of the amounts.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MULTIPLICITY = "__copies"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    bytes: int
    broadcast: bool


def _row_bytes(schema: T.StructType) -> Column:
    """Upper-bound-ish size of one row in Spark's binary row format."""
    fixed = 8 * len(schema.fields) + 8 * ((len(schema.fields) + 63) // 64)
    var = [
        F.coalesce(F.octet_length(F.col(f.name)) + F.lit(7), F.lit(0))
        for f in schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    var += [F.lit(16) for f in schema.fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18]
    total = F.lit(fixed)
    for v in var:
        total = total + v
    return total.cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a DataFrame, by one distributed aggregate; one row to the driver."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def measure_many(frames: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """``measure`` for several DataFrames in one job (one row each to the driver)."""
    parts = [
        df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("b"))
        for name, df in frames.items()
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {r["name"]: (int(r["n"]), int(r["b"] or 0)) for r in union.collect()}


def checked_broadcast(df: DataFrame, max_bytes: int, max_rows: int, bound: tuple[int, int] | None = None,
                      extra_bytes_per_row: int = 8, copies: int = 1, memo: dict | None = None,
                      key: tuple = (), shrinks: bool = True) -> tuple[DataFrame, SizeCheck]:
    """Return ``(df hinted for broadcast, check)`` when small enough, else ``(df, check)``.

    ``bound`` is the measured (rows, bytes) of a table that ``df`` is derived from
    by filters, projections and duplicate collapsing (which only shrink it); each
    derived row may add ``extra_bytes_per_row`` (e.g. a copy count), and ``copies``
    stacked copies of the table multiply it. When there is no bound, or the bound
    is over a limit, ``df`` itself is measured (one more aggregate over the
    dimension, never over the fact), so a large table whose filtered part is
    small is still broadcast; not where ``shrinks`` is false, as then ``df`` is as
    large as its table. ``memo`` keeps such measurements by ``key`` between builds.
    """
    def fits(r: int, b: int) -> bool:
        return r <= max_rows and b <= max_bytes

    def decide(rows: int, size: int, how: str) -> tuple[DataFrame, SizeCheck]:
        ok = fits(rows, size)
        log.info("dimension %s: %d rows, %d bytes (%s) -> %s", df.columns[:3], rows, size, how,
                 "broadcast" if ok else "shuffle join")
        return (F.broadcast(df) if ok else df), SizeCheck(rows, size, ok)

    if bound is not None:
        raw_rows, raw_bytes = bound
        rows = raw_rows * copies
        size = copies * (raw_bytes + raw_rows * extra_bytes_per_row)
        if fits(rows, size) or max_rows <= 0 or not shrinks:
            return decide(rows, size, "bound of the whole table")
    # no bound, or the whole table is too large: measure what would be broadcast
    if memo is not None and key in memo:
        rows, size = memo[key]
    else:
        rows, size = measure(df)
        if memo is not None:
            memo[key] = rows, size
    return decide(rows, size + rows * extra_bytes_per_row, "measured")


def with_multiplicity(dim: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct ``cols`` of a dimension with the number of copies of each."""
    return dim.groupBy(*cols).agg(F.count(F.lit(1)).alias(MULTIPLICITY))


#: Tasks over which a heavy key is spread, and the most keys that can be.
SALTS = 64
MOST_HEAVY = 10_000
_HEAVY, _KEY = "__heavy", "__key_"


def heavy_keys(df: DataFrame, keys: list[str], rows: int, counted: Column | None = None) -> DataFrame:
    """The keys with more than ``rows`` rows of ``df``, the MOST_HEAVY heaviest at most (so broadcasting them is bounded).

    Counted with map-side partial sums. A key beyond that list is joined like any other, so nothing is lost.
    ``counted``: count the rows where this is not null. Where ``df`` is an aggregate, naming its result
    keeps both readers of it alike, so that Spark runs it once (a reused exchange).
    """
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return (known.groupBy(*keys).agg(F.count(F.lit(1) if counted is None else counted).alias(MULTIPLICITY))
            .where(F.col(MULTIPLICITY) > rows)
            .orderBy(F.desc(MULTIPLICITY), *keys).limit(MOST_HEAVY)
            .select(*[F.col(k).alias(_KEY + k) for k in keys], F.lit(True).alias(_HEAVY)))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str, salt: str,
                heavy_rows: int, counted: Column | None = None) -> DataFrame:
    """``left JOIN right`` on ``keys`` (inner or left) and a salt column, which stays in the result.

    Left rows with a missing key match nothing and go anywhere: their salt is a hash of
    ``spread``. Rows of a heavy key (measured, see ``heavy_keys``) are dealt by the same hash over
    SALTS salts, and the right rows of that key are repeated for each of them. All other rows
    have a hash of the key. The salt depends on keys and ``spread`` only, so a
    grouping by those needs no exchange after the join.
    """
    heavy = F.broadcast(heavy_keys(left, keys, heavy_rows, counted))
    own, anywhere = F.xxhash64(*keys), F.xxhash64(*spread)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()

    def marked(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k) == F.col(_KEY + k))
        return df.join(heavy, same, "left").drop(*[_KEY + k for k in keys])

    dealt = F.when(missing, anywhere).when(F.col(_HEAVY), F.pmod(anywhere, F.lit(SALTS))).otherwise(own)
    salts = F.when(F.col(_HEAVY), F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).otherwise(F.array(own))
    a = marked(left).withColumn(salt, dealt).drop(_HEAVY)
    b = marked(right).withColumn(salt, F.explode(salts)).drop(_HEAVY)
    return a.join(b, [*keys, salt], how)


def times(amount: Column, count: Column, scale: int) -> Column:
    """``amount * count`` without loss of scale, as decimal(38, scale).

    The plain product of a wide decimal and a bigint would need more than 38 digits,
    and Spark then cuts the scale. Here whole part and fraction are multiplied
    apart, each within 38 digits. A product of 10^(37 - scale) or more fails (as a
    sum beyond 38 digits does); ``scale`` is at most ``schemas.MOST_SCALE``.
    """
    n = count.cast(T.DecimalType(18, 0))
    whole = F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount))
    fraction = (amount.cast(T.DecimalType(38, scale)) % F.lit(1).cast(T.DecimalType(1, 0))).cast(T.DecimalType(scale + 1, scale))
    total = (whole.cast(T.DecimalType(38 - scale, 0)) * n).cast(T.DecimalType(37 - scale, 0)) \
        + (fraction * n).cast(T.DecimalType(min(37, scale + 19), scale))
    return total.cast(T.DecimalType(38, scale))


def copies(col: str = MULTIPLICITY) -> Column:
    """Copies of the matched dimension row, 1 when nothing matched (left join)."""
    return F.coalesce(F.col(col), F.lit(1))
