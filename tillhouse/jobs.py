"""Command-line jobs (spark-submit entry points).

    python -m tillhouse.jobs seed      --out OP_ROOT [--as-of TS] [--customers N] [--sales N]
    python -m tillhouse.jobs extract   --sf-dir DIR --out OP_ROOT [--category p_type]
    python -m tillhouse.jobs etl       --op OP_ROOT --warehouse DW_ROOT [--as-of TS] [--initial-mark TS]
    python -m tillhouse.jobs validate  --op OP_ROOT --warehouse DW_ROOT      (exit 1 when a check fails)
    python -m tillhouse.jobs reports   --warehouse DW_ROOT --out DIR [--as-of DATE] [--days N]
    python -m tillhouse.jobs quality   --op OP_ROOT --warehouse DW_ROOT      (exit 1 on violations)

The session comes from the environment (spark-submit); the checkpoint folder
is ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tillhouse import schemas as S
from tillhouse.session import ensure_checkpoint_dir

LISTED = 50      # rows of each finding that a failing validation lists


def _ts(s: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(s) if s else dt.datetime.now().replace(microsecond=0)


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("tillhouse").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def cmd_seed(a) -> int:
    from tillhouse.sources import readers, seed

    spark = _session()
    op = seed.seed(spark, _ts(a.as_of), n_customers=a.customers, n_sales=a.sales)
    readers.write_op(op, a.out)
    return 0


def cmd_extract(a) -> int:
    from tillhouse.sources import readers, testdata

    spark = _session()
    readers.write_op(testdata.op_tables(spark, a.sf_dir, a.category), a.out)
    return 0


def cmd_etl(a) -> int:
    from tillhouse.sources.readers import read_op_parquet
    from tillhouse.sources.store import WarehouseStore

    spark = _session()
    run = WarehouseStore(a.warehouse).run(read_op_parquet(spark, a.op), _ts(a.as_of),
                                          initial_mark=_ts(a.initial_mark) if a.initial_mark else S.DEFAULT_LAST_RUN)
    span = "no changed sales" if not run.loaded else f"sales sold {run.changed[0]} to {run.changed[1]}"
    print(f"etl from mark {run.last_run}: {span}")
    return 0


def cmd_validate(a) -> int:
    from tillhouse.plans import validate
    from tillhouse.sources.readers import read_op_parquet
    from tillhouse.sources.store import WarehouseStore

    spark = _session()
    op, dw = read_op_parquet(spark, a.op), WarehouseStore(a.warehouse).read(spark)
    ok, rows = validate.run_checks(op, dw)
    for r in rows:
        print(json.dumps({"check": r["check"], "passed": r["passed"], "bad": r["n_bad"], "detail": str(r["detail"])}))
    findings = {} if ok else {"missing_items": validate.missing_items, "surplus_items": validate.surplus_items,
                              "daily_diffs": validate.daily_diffs}
    for name, finding in findings.items():
        for line in finding(op, dw).limit(LISTED).toJSON().collect():
            print(f"{name}: {line}")
    return 0 if ok else 1


def cmd_reports(a) -> int:
    from tillhouse.plans import reports
    from tillhouse.sources.store import WarehouseStore

    spark = _session()
    as_of = dt.date.fromisoformat(a.as_of) if a.as_of else dt.date.today()
    dw = WarehouseStore(a.warehouse).read(spark)
    for path in reports.write_reports(reports.report_datasets(dw, as_of, a.days), a.out):
        print(path)
    return 0


def cmd_quality(a) -> int:
    from tillhouse.operators import quality
    from tillhouse.sources.readers import read_op_parquet
    from tillhouse.sources.store import WarehouseStore

    spark = _session()
    op, dw = read_op_parquet(spark, a.op), WarehouseStore(a.warehouse).read(spark)
    bad = 0
    for df in (quality.row_rules(op, dw), quality.duplicate_keys(op, dw), quality.orphans(op, dw)):
        for r in df.filter("n_bad > 0").collect():
            bad += 1
            print(json.dumps({"table": r["table"], "rule": r["rule"], "bad": r["n_bad"]}))
    return 0 if not bad else 1


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tillhouse")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("seed")
    s.add_argument("--out", required=True)
    s.add_argument("--as-of")
    s.add_argument("--customers", type=int, default=20)
    s.add_argument("--sales", type=int, default=60)
    s = sub.add_parser("extract")
    s.add_argument("--sf-dir", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--category", default="p_type")
    s = sub.add_parser("etl")
    s.add_argument("--op", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--as-of")
    s.add_argument("--initial-mark")
    for name in ("validate", "quality"):
        s = sub.add_parser(name)
        s.add_argument("--op", required=True)
        s.add_argument("--warehouse", required=True)
    s = sub.add_parser("reports")
    s.add_argument("--warehouse", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--as-of")
    s.add_argument("--days", type=int, default=S.DEFAULT_REPORT_DAYS)
    a = p.parse_args(argv)
    return {"seed": cmd_seed, "extract": cmd_extract, "etl": cmd_etl, "validate": cmd_validate,
            "reports": cmd_reports, "quality": cmd_quality}[a.cmd](a)


if __name__ == "__main__":
    sys.exit(main())
