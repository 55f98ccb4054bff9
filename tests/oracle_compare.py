"""Compare a Spark query with its DuckDB oracle: rows, schema, order-free value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import re

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    "DOUBLE": "double", "BOOLEAN": "boolean", "SMALLINT": "smallint", "FLOAT": "float",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _duck_type(t: str) -> str:
    m = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", t.replace(" ", ""))
    if m:
        return f"decimal({m.group(1)},{m.group(2)})"
    return _DUCK_TO_SPARK.get(t, t.lower())


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _hash(rows, names) -> str:
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_names = spark_df.columns
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = {n: _duck_type(str(t)) for n, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    return {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "rows_match": len(s_rows) == len(d_rows),
        "names_match": sorted(s_names) == sorted(d_names),
        "schema_match": s_types == d_types,
        "schema_diff": {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types)
                        if s_types.get(k) != d_types.get(k)},
        "hash_match": _hash(s_rows, s_names) == _hash(d_rows, d_names),
    }
