"""Benchmark: the warehouse flow at one scale, one JSON line on stdout.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Steps (each timed, wall seconds):
  op_extract        derive the five operational tables from the driver tables, write parquet
  etl_full          first load of the whole source into an empty store (version 1)
  etl_run1          incremental scenario, run 1: sales updated before 1998-01-01 (new store)
  etl_run2          run 2 after status flips and category changes, from the 1998-01-01 mark
  etl_noop          a run with nothing changed since the mark (control row only)
  kpi_daily, kpi_monthly, kpi_daily_range, kpi_monthly_range, report_*  over the stored warehouse
  checks_verdict    reconciliation suite V1-V7 (verdict rows)
  dq_all            data-quality rules C1-C4 over source and warehouse
Queries are forced with the ``noop`` sink (full execution, nothing collected)
except where the result is a handful of rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillhouse import schemas as S  # noqa: E402
from tillhouse.functions.dates import ntz  # noqa: E402
from tillhouse.model import OpTables  # noqa: E402
from tillhouse.operators import quality  # noqa: E402
from tillhouse.plans import kpi, reports, validate  # noqa: E402
from tillhouse.session import ensure_checkpoint_dir  # noqa: E402
from tillhouse.sources import testdata  # noqa: E402
from tillhouse.sources.store import WarehouseStore  # noqa: E402

FIRST_MARK = dt.datetime(1990, 1, 1)
MARK = dt.datetime(1998, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)
REPORT_AS_OF, REPORT_DAYS = dt.date(2001, 8, 1), 365


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tillhouse-bench")
             .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * int(cpus)))))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.local.dir", os.path.join(scratch, "local"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # only where the platform names none
        spark.conf.set("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
    ensure_checkpoint_dir(spark)
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="tillhouse-bench-")
    spark = session(cpus, scratch)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # warm-up: JVM, parquet reader
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()

    op_root = os.path.join(scratch, "op")

    def extract():
        op = testdata.op_tables(spark, sf_dir)
        for name in S.OP_SCHEMAS:
            getattr(op, name).write.mode("overwrite").parquet(f"{op_root}/{name}")

    timed("op_extract", extract)
    op = OpTables(**{n: spark.read.schema(s).parquet(f"{op_root}/{n}") for n, s in S.OP_SCHEMAS.items()})

    full = WarehouseStore(os.path.join(scratch, "wh_full"))
    timed("etl_full", lambda: full.run(op, AS_OF, initial_mark=FIRST_MARK))
    timed("etl_noop", lambda: full.run(op, AS_OF + dt.timedelta(days=1)))

    incr = WarehouseStore(os.path.join(scratch, "wh_incr"))
    sale1 = op.sale.filter(F.col("updated_at") < ntz(MARK))
    op1 = op.with_(sale=sale1, sale_item=op.sale_item.join(sale1.select("sale_id"), "sale_id", "left_semi"))
    timed("etl_run1", lambda: incr.run(op1, MARK, initial_mark=FIRST_MARK))
    flip = (F.col("sale_id") % 17 == 0) & (F.col("status") == S.STATUS_COMPLETED)
    op2 = op.with_(
        sale=op.sale.withColumn("updated_at", F.when(flip, F.greatest("updated_at", ntz(MARK)))
                                .otherwise(F.col("updated_at")))
        .withColumn("status", F.when(flip, F.lit(S.STATUS_CANCELLED)).otherwise(F.col("status"))),
        product=op.product.withColumn("category", F.when(F.col("product_id") % 10 == 0, F.lit("NEW"))
                                      .otherwise(F.col("category"))))
    timed("etl_run2", lambda: incr.run(op2, AS_OF))

    dw = full.read(spark)
    d0, d1 = kpi.report_window(REPORT_AS_OF, REPORT_DAYS)
    daily = kpi.kpi_daily_range(dw, d0, d1)
    monthly = kpi.kpi_monthly_range(dw, d0.year, d0.month, d1.year, d1.month)
    timed("kpi_daily", lambda: noop(kpi.kpi_daily_branch(dw)))
    timed("kpi_monthly", lambda: noop(kpi.kpi_monthly_branch_category(dw)))
    timed("kpi_daily_range", lambda: daily.collect())
    timed("kpi_monthly_range", lambda: monthly.collect())
    branches = reports.branch_labels(dw)
    timed("report_daily_pivot", lambda: reports.daily_net_pivot(daily, branches).collect())
    timed("report_weekday_matrix", lambda: reports.weekday_matrix(daily, dw.dim_date, branches).collect())
    timed("report_top_categories", lambda: reports.top_category_matrix(monthly, branches).collect())
    timed("sales_by_branch", lambda: kpi.sales_by_branch(op).collect())
    verdict = timed("checks_verdict", lambda: validate.run_checks(op, dw)[1])
    timed("check_missing_items", lambda: validate.missing_items(op, dw).collect())
    timed("check_surplus_items", lambda: validate.surplus_items(op, dw).collect())
    timed("dq_all", lambda: [quality.row_rules(op, dw).collect(), quality.duplicate_keys(op, dw).collect(),
                             quality.orphans(op, dw).collect()])
    if not all(r["passed"] for r in verdict):
        print(f"warning: reconciliation failed: {verdict}", file=sys.stderr)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "warehouse_flow_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
