"""Report sinks: overwrite a named report table with upper-case headers.

The original pushes each result to a spreadsheet tab from the client. Here a
report is a directory written by the executors (``mode('overwrite')`` replaces
the whole table, so a shorter result leaves no stale rows). Parquet by default,
also orc and json; CSV writes a header row and marks null as ``\\N`` so that
null and the empty text stay apart on read-back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_NULL = "\\N"


def shape_report(df: DataFrame, date_text: bool = False, missing_date_text: str | None = None) -> DataFrame:
    """Upper-case the column names; optionally render date columns as ``yyyy-MM-dd`` text.

    ``missing_date_text`` is the text for a missing date (null by default).
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if date_text and isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
            if missing_date_text is not None:
                c = F.coalesce(c, F.lit(missing_date_text))
        cols.append(c.alias(f.name.upper()))
    return df.select(*cols)


FORMATS = ("parquet", "orc", "json", "csv")


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite the report at ``path`` (parquet, orc, json or csv)."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported report format {fmt!r}")
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("nullValue", CSV_NULL)
    w.save(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Read a report back. Parquet and orc carry their schema; json and csv need
    ``schema`` (no inference pass over the data)."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported report format {fmt!r}")
    r = spark.read.format(fmt)
    if fmt in ("json", "csv"):
        if schema is None:
            raise ValueError(f"reading a {fmt} report needs its schema")
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("nullValue", CSV_NULL).option("enforceSchema", False)
    if fmt in ("json", "csv"):
        r = r.option("mode", "FAILFAST")
    return r.load(path)
