"""Write the physical plans of the headline queries to docs/PLANS.md.

Runs on a stored warehouse built from the sf0.01 tables, with automatic
broadcast turned off so the plans show the shuffles a large cluster would
run (size-checked broadcasts of date and branch remain).

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillhouse.plans import etl, kpi, validate  # noqa: E402
from tillhouse.session import local_session  # noqa: E402
from tillhouse.sources import readers, testdata  # noqa: E402
from tillhouse.sources.store import WarehouseStore  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?ReadSchema: .*", text)
    details = []
    for block in scans:
        keep = [ln for ln in block.splitlines() if ln.startswith(("(", "PartitionFilters", "PushedFilters",
                                                                   "ReadSchema"))]
        details.append("\n".join(keep))
    return tree + "\n\n" + "\n\n".join(details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    root = tempfile.mkdtemp(prefix="plans-")
    readers.write_op(testdata.op_tables(spark, sf_dir), f"{root}/op")
    op = readers.read_op_parquet(spark, f"{root}/op")
    store = WarehouseStore(f"{root}/dw")
    store.run(op, dt.datetime(2002, 1, 1), initial_mark=dt.datetime(1990, 1, 1))
    dw = store.read(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    d0, d1 = dt.date(2000, 8, 1), dt.date(2001, 8, 1)
    sections = [
        ("Fact load source (sales x dims x items x products)",
         etl.fact_source(op, dw, dt.datetime(1998, 1, 1), dt.datetime(2002, 1, 1))),
        ("Daily KPI, one-year window (month partitions pruned)", kpi.kpi_daily_range(dw, d0, d1)),
        ("Monthly KPI by category", kpi.kpi_monthly_branch_category(dw)),
        ("V3 daily differences (sale-grain sides, full outer join)", validate.daily_diffs(op, dw)),
        ("V5 surplus items (bad sales found at sale grain)", validate.surplus_items(op, dw)),
    ]
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plan_report.py` on the {os.path.basename(sf_dir)} tables, stored warehouse, "
           "`spark.sql.autoBroadcastJoinThreshold=-1` (as for tables too large to broadcast).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
