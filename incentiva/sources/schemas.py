"""Schemas of the six source tables and a load-time conformance check.

Types are what the queries need: wall-clock timestamps (``timestamp_ntz``) so a
sale's day never moves with the session zone, decimal money, and string keys.
Money keeps its stored scale through every sum. Buyer and order ids are
``bigint`` here; a string id works as well. A load never narrows a value: a
stored type that does not fit losslessly raises ``SchemaError``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
#: The largest scale of amounts: their products with copy counts stay exact up to it.
MOST_SCALE = 18
#: Raw instant of a zoned sale time, kept beside its wall clock so that a range on it reaches the scan.
INSTANT = "__create_instant"


def sum_money(df: DataFrame, column: str) -> T.DecimalType:
    """Type of a sum of ``column``: all digits, at the stored scale."""
    return T.DecimalType(38, df.schema[column].dataType.scale)

SALES = T.StructType(
    [
        T.StructField("create_date_time_tz", T.TimestampNTZType(), True),
        T.StructField("create_date_time", T.TimestampNTZType(), True),
        T.StructField("cancel_date_time_tz", T.TimestampNTZType(), True),
        T.StructField("order_status", T.StringType(), True),
        T.StructField("store_url", T.StringType(), True),
        T.StructField("leader_name", T.StringType(), True),
        T.StructField("dynamo_customer_id", T.LongType(), True),
        T.StructField("order_number", T.LongType(), True),
        T.StructField("net_value", MONEY, True),
    ]
)

PORTFOLIO = T.StructType(
    [
        T.StructField("emprendedor", T.StringType(), True),
        T.StructField("mentora", T.StringType(), True),
        T.StructField("orientador", T.StringType(), True),
        T.StructField("flag_retencion", T.IntegerType(), True),
        T.StructField("flag_emprendedor", T.StringType(), True),
    ]
)

PORTFOLIO_SIZE = T.StructType(
    [
        T.StructField("orientador", T.StringType(), True),
        T.StructField("cartera", T.IntegerType(), True),
        T.StructField("cartera_nuevos", T.IntegerType(), True),
    ]
)

BUYERS = T.StructType(
    [
        T.StructField("dynamo_customer_id", T.LongType(), True),
        T.StructField("customer_name", T.StringType(), True),
    ]
)

TIER = T.StructType(
    [
        T.StructField("store_url", T.StringType(), True),
        T.StructField("calendar_month", T.DateType(), True),
        T.StructField("tier_net_lm", T.StringType(), True),
    ]
)

STORES = T.StructType(
    [
        T.StructField("store_url", T.StringType(), True),
        T.StructField("create_date_tz", T.TimestampNTZType(), True),
    ]
)

SCHEMAS: dict[str, T.StructType] = {
    "sales": SALES,
    "portfolio": PORTFOLIO,
    "portfolio_size": PORTFOLIO_SIZE,
    "buyers": BUYERS,
    "tier": TIER,
    "stores": STORES,
}

# ids may be strings in a warehouse; any of these is accepted as is
_ID_COLUMNS = {"dynamo_customer_id", "order_number"}


class SchemaError(ValueError):
    pass


def wall_clock(ts: Column, zone: str) -> Column:
    """A zoned instant as the wall-clock time (``timestamp_ntz``) it shows in ``zone``.

    No session zone is involved: the instant's epoch microseconds are added to a
    zone-free epoch (its UTC wall clock), which is then moved from UTC to ``zone``.
    """
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of ``have`` is a value of ``want``."""
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(have) in order and type(want) in order:
        return order.index(type(have)) <= order.index(type(want))
    if isinstance(want, T.StringType):
        return isinstance(have, (T.CharType, T.VarcharType))
    return isinstance(want, T.TimestampNTZType) and isinstance(have, T.DateType)


def _money(have: T.DataType, where: str, allow_float: bool) -> T.DecimalType:
    """The decimal type in which a stored amount is kept."""
    if isinstance(have, T.DecimalType):
        if have.scale > MOST_SCALE:
            raise SchemaError(f"{where} is {have.simpleString()}; amounts of more than {MOST_SCALE} decimal places are not supported")
        return have
    if isinstance(have, T.IntegralType):
        return T.DecimalType(21, 2)
    if isinstance(have, (T.FloatType, T.DoubleType)) and allow_float:
        return T.DecimalType(24, 6)
    raise SchemaError(f"{where} is {have.simpleString()}, which is not exact money; store a decimal"
                      + (" or ask for it (allow_float=True)" if isinstance(have, (T.FloatType, T.DoubleType)) else ""))


#: Largest value of each whole type.
_LARGEST = {"int": (1 << 31) - 1, "bigint": (1 << 63) - 1}


def whole_number(col: Column, have: T.DecimalType, want: T.DataType, where: str) -> Column:
    """A ``decimal(p,0)`` as int or bigint; a value out of range fails the job, whatever the session's ANSI setting."""
    kind = want.simpleString()
    largest = _LARGEST[kind]
    if have.precision < len(str(largest)):
        return col.cast(want)
    fits = col.between(F.lit(Decimal(-largest - 1)), F.lit(Decimal(largest)))
    error = F.raise_error(F.concat(F.lit(f"{where}: "), col.cast("string"), F.lit(f" is out of the range of {kind}")))
    return F.when(col.isNull(), F.lit(None).cast(want)).when(fits, col.cast(want)).otherwise(error.cast(want))


def conform(df: DataFrame, name: str, keep: tuple[str, ...] = (), zone: str | None = None,
            allow_float: bool = False) -> DataFrame:
    """Select the source's columns in order and cast them to the expected types.

    Missing columns raise ``SchemaError``; extra columns are dropped (except those
    in ``keep``, e.g. a partition column) so the scan reads only what the queries
    use. Stored types are kept or widened, never narrowed; amounts keep their scale,
    and floating amounts are refused unless ``allow_float``. Whole numbers stored as
    ``decimal(p,0)`` become int or bigint, and a value that does not fit fails the job. Zoned timestamps
    are refused unless ``zone`` names the zone whose wall clock dates the sales.
    """
    schema = SCHEMAS[name]
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise SchemaError(f"{name}: missing columns {missing}; has {sorted(present)}")
    cols = []
    for f in schema.fields:
        have = present[f.name]
        if f.name in _ID_COLUMNS and isinstance(have, (T.StringType, T.IntegralType)):
            cols.append(F.col(f.name))
        elif have == f.dataType:
            cols.append(F.col(f.name))
        elif isinstance(have, T.DecimalType) and have.scale == 0 and isinstance(f.dataType, (T.IntegerType, T.LongType)):
            cols.append(whole_number(F.col(f.name), have, f.dataType, f"{name}.{f.name}").alias(f.name))
        elif f.dataType == MONEY:
            cols.append(F.col(f.name).cast(_money(have, f"{name}.{f.name}", allow_float)).alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType) and isinstance(have, T.TimestampType):
            if zone is None:
                raise SchemaError(
                    f"{name}.{f.name} is a zoned timestamp; store local wall-clock time as "
                    "timestamp_ntz, or name the zone whose wall clock dates the sales (zone=...)"
                )
            cols.append(wall_clock(F.col(f.name), zone).alias(f.name))
            if name == "sales" and f.name == "create_date_time_tz":
                cols.append(F.col(f.name).alias(INSTANT))
        elif _widens(have, f.dataType):
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            raise SchemaError(f"{name}.{f.name} is {have.simpleString()}; {f.dataType.simpleString()} is needed, "
                              "and a cast could lose values")
    extra = [c for c in keep if c in present and c not in schema.fieldNames()]
    return df.select(*cols, *extra)
