"""Read facts off a physical plan: pushed filters, read schema, join strategies, exchanges."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` lists of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[(.*)\]\s*$", explain_string(df, "formatted"), flags=re.MULTILINE)


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)\s*$", explain_string(df, "formatted"), flags=re.MULTILINE)


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator (e.g. ``Exchange``, ``BroadcastHashJoin``)."""
    plan = explain_string(df, "simple")
    return len(re.findall(rf"\b{re.escape(name)}\b", plan))
