"""Print the condensed physical plans of the headline results (the body of PLANS.md).

    python -m incentiva.plans.print_plans /root/testdata/sf0.01 > plans.md

The test-data inputs are first stored as parquet tables (sales partitioned by
month) in a fresh scratch folder, so scans show their partition and pushed filters.
"""

from __future__ import annotations

import re
import sys
import tempfile

from pyspark.sql import functions as F

from ..operators import commission as C
from ..operators import portfolio as P
from ..params import DEFAULT
from ..sources import testdata
from ..sources.tables import from_parquet
from .inspect import explain_string
from .session import local_session

_KEEP = re.compile(r"(Exchange|Join|HashAggregate|Window|Sort |Scan|Union|Broadcast)")
_NAMES = ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")


def condense(plan: str) -> str:
    out = []
    for line in plan.split("\n"):
        if not _KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Batched: true, ", "", line)
        if "FileScan parquet" in line and "PushedFilters: " in line:
            head = line[:line.index("]", line.index("FileScan parquet [")) + 1]
            part = line[line.index("PartitionFilters: ") + 18:line.index(", PushedFilters: ")]
            pushed = line[line.index("PushedFilters: ") + 15:line.index(", ReadSchema: ")]
            pad = " " * (len(head) - len(head.lstrip(" :+-")) + 4)
            out.append(head)
            if part != "[]":
                out.append(pad + "PartitionFilters: " + part)
            out.append(pad + "PushedFilters: " + pushed)
            continue
        out.append(line.rstrip()[:230])
    return "\n".join(out)


def main(sf_dir: str) -> None:
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scratch = tempfile.mkdtemp(prefix="incentiva-plans-")
    src = testdata.load(spark, sf_dir)
    for n in _NAMES:
        df = getattr(src, n)
        if n == "sales":
            df = df.withColumn("sale_month", F.trunc(F.to_date("create_date_time_tz"), "month"))
            df.write.partitionBy("sale_month").parquet(f"{scratch}/{n}")
        else:
            df.write.parquet(f"{scratch}/{n}")
    stored = from_parquet(spark, {n: f"{scratch}/{n}" for n in _NAMES}, sales_month_col="sale_month")
    base = DEFAULT.with_(sales_month_col="sale_month")
    for label, params, threshold in [("measured broadcasts (dimensions small)", base, "10485760"),
                                     ("every dimension large (broadcast off)", base.with_(broadcast_max_rows=0),
                                      "-1")]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for q, f in [("bonus_detail(old)", lambda: P.bonus_detail(stored, "old", params)),
                     ("portfolio_totals(old)", lambda: P.portfolio_totals(stored, "old", params)),
                     ("commission_tracker", lambda: C.commission_tracker(stored, params))]:
            print(f"### {q} — {label}\n\n```")
            print(condense(explain_string(f(), "simple")))
            print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
