"""The six inputs as one bundle of lazy DataFrames, and ways to load them.

Nothing here reads data: every loader returns a lazily planned DataFrame whose
scan Catalyst prunes to the columns and rows the query needs.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SCHEMAS, conform


BUYER = "dynamo_customer_id"


@dataclass(frozen=True)
class Sources:
    """Sales lines, store portfolio, portfolio size, buyers, store tiers, stores."""

    sales: DataFrame
    portfolio: DataFrame
    portfolio_size: DataFrame
    buyers: DataFrame
    tier: DataFrame
    stores: DataFrame
    _sizes: dict = field(default_factory=dict, compare=False, repr=False)

    def size_bounds(self, *names: str) -> list[tuple[int, int]]:
        """(rows, bytes) of the named inputs, each measured once per bundle, missing ones together in one job.

        Any filter, projection or duplicate collapse of an input is no larger, so
        every query built on this bundle reuses the measurement to decide its
        broadcasts. Only inputs that a query joins are measured.
        """
        from ..operators.joins import measure_many

        missing = [n for n in names if n not in self._sizes]
        if missing:
            self._sizes.update(measure_many({n: getattr(self, n) for n in missing}))
        return [self._sizes[n] for n in names]

    def size_bound(self, name: str) -> tuple[int, int]:
        return self.size_bounds(name)[0]

    def conformed(self, sales_month_col: str | None = None, zone: str | None = None,
                  allow_float: bool = False) -> "Sources":
        from ..operators.sales import month_columns

        keep = {"sales": tuple(month_columns(sales_month_col))}
        frames = {f.name: conform(getattr(self, f.name), f.name, keep.get(f.name, ()), zone, allow_float)
                  for f in fields(self) if f.init and not f.name.startswith("_")}
        # one type for the buyer's id, whatever join is chosen later: text if either side has text
        kinds = {n: frames[n].schema[BUYER].dataType for n in ("sales", "buyers")}
        if kinds["sales"] != kinds["buyers"]:
            one = T.StringType() if any(isinstance(k, T.StringType) for k in kinds.values()) else T.LongType()
            for n in kinds:
                frames[n] = frames[n].withColumn(BUYER, F.col(BUYER).cast(one))
        return Sources(**frames)


def from_tables(spark: SparkSession, names: dict[str, str], sales_month_col: str | None = None,
                zone: str | None = None, allow_float: bool = False) -> Sources:
    """Load from catalog tables, e.g. ``{"sales": "shop.sale_lines", ...}``.

    ``sales_month_col`` names a month partition column of the sales table (a date, the
    first of the month; a whole number yyyymm; a text; or two columns "year,month"); set
    the same name in ``Params.sales_month_col`` so the month filters prune whole
    partitions. ``zone``, ``allow_float``: see ``schemas.conform``.
    """
    return Sources(**{k: spark.table(names[k]) for k in SCHEMAS}).conformed(sales_month_col, zone, allow_float)


def from_parquet(spark: SparkSession, paths: dict[str, str], sales_month_col: str | None = None,
                 zone: str | None = None, allow_float: bool = False) -> Sources:
    """Load from parquet paths (a file or a directory, possibly partitioned).

    No schema inference pass: parquet carries its schema in the footer, and
    ``conform`` checks it against the expected one.
    """
    return Sources(**{k: spark.read.parquet(paths[k]) for k in SCHEMAS}).conformed(sales_month_col, zone, allow_float)


def from_files(spark: SparkSession, paths: dict[str, str], fmt: str, options: dict[str, str] | None = None,
               sales_month_col: str | None = None, zone: str | None = None, allow_float: bool = False,
               sales_month_type: str = "date") -> Sources:
    """Load from files of one format: parquet, orc, csv or json (one path per input).

    Text formats are read with the expected schema (no inference pass over the
    data), and a line that does not fit it fails the read. csv expects a header row
    whose names are checked against the schema; ``sales_month_type`` is the type of its month
    column (of two, year and month, int). Columnar formats carry their own schema.
    """
    if fmt not in ("parquet", "orc", "csv", "json"):
        raise ValueError(f"unsupported input format {fmt!r}")
    from ..operators.sales import month_columns

    frames = {}
    for name, schema in SCHEMAS.items():
        reader = spark.read.format(fmt).options(**(options or {}))
        if fmt in ("csv", "json"):
            months = month_columns(sales_month_col) if name == "sales" else []
            for c in months:
                schema = T.StructType(schema.fields).add(c, "int" if len(months) == 2 else sales_month_type)
            reader = reader.schema(schema).option("mode", "FAILFAST")
            if fmt == "csv":
                reader = reader.option("header", True).option("enforceSchema", False)
        frames[name] = reader.load(paths[name])
    return Sources(**frames).conformed(sales_month_col, zone, allow_float)


def from_frames(zone: str | None = None, allow_float: bool = False, sales_month_col: str | None = None, **frames: DataFrame) -> Sources:
    """Bundle ready DataFrames (tests, or sources built by other jobs)."""
    return Sources(**frames).conformed(sales_month_col, zone, allow_float)


# key of each dimension as the joins use it; a repeated key multiplies the facts it meets
DIMENSION_KEYS: dict[str, tuple[str, ...]] = {
    "portfolio": ("emprendedor",),
    "portfolio_size": ("orientador",),
    "buyers": ("dynamo_customer_id",),
    "tier": ("store_url", "calendar_month"),
    "stores": ("store_url",),
}


def dimension_duplicates(src: Sources) -> DataFrame:
    """Keys that occur more than once in a dimension: (table, key, copies).

    The joins keep the original's semantics, where a repeated key multiplies the
    sales it meets; this lazy, distributed check shows where that happens.
    """
    out = None
    for name, keys in DIMENSION_KEYS.items():
        df = getattr(src, name)
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys])
        d = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
             .select(F.lit(name).alias("dimension"), key.alias("key"), "copies"))
        out = d if out is None else out.unionByName(d)
    return out


class DuplicateKeyError(ValueError):
    pass


def require_unique_dimensions(src: Sources) -> None:
    """Raise if any dimension repeats a key (opt-in; the default keeps the fan-out)."""
    dup = dimension_duplicates(src).limit(5).collect()
    if dup:
        raise DuplicateKeyError("repeated dimension keys: " + ", ".join(f"{r.dimension}[{r.key}] x{r.copies}"
                                                                      for r in dup))
