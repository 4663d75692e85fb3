"""Command-line jobs end to end on the seed (shared session)."""

import datetime as dt
import glob
import os

from tillhouse import jobs
from tillhouse.plans import kpi, views
from tillhouse.sources.readers import append_rows, read_op_parquet
from tillhouse.sources.store import WarehouseStore


def test_jobs_seed_etl_validate_reports(spark, scratch):
    root = os.path.join(scratch, "jobs")
    op_root, dw_root, out = f"{root}/op", f"{root}/dw", f"{root}/reports"
    assert jobs.main(["seed", "--out", op_root, "--as-of", "2024-03-10T12:00:00"]) == 0
    assert jobs.main(["etl", "--op", op_root, "--warehouse", dw_root, "--as-of", "2024-03-10T13:00:00",
                      "--initial-mark", "2000-01-01T00:00:00"]) == 0
    assert jobs.main(["validate", "--op", op_root, "--warehouse", dw_root]) == 0
    assert jobs.main(["quality", "--op", op_root, "--warehouse", dw_root]) == 0
    assert jobs.main(["reports", "--warehouse", dw_root, "--out", out, "--as-of", "2024-03-10"]) == 0
    assert len({os.path.dirname(f) for f in glob.glob(f"{out}/*/*.csv")}) == 7

    # a late item on a completed sale is not picked up (the mark lives on the sale)
    item = spark.createDataFrame([(10_000, 7, 1, 1)], "item_id long, sale_id long, product_id long, qty int")
    append_rows(item.selectExpr("*", "CAST(59.90 AS DECIMAL(12,2)) AS unit_price"), op_root, "sale_item",
                dt.datetime(2024, 3, 11))
    assert jobs.main(["etl", "--op", op_root, "--warehouse", dw_root, "--as-of", "2024-03-11T00:00:00"]) == 0
    assert jobs.main(["validate", "--op", op_root, "--warehouse", dw_root]) == 1

    # SQL surface over the stored warehouse
    dw = WarehouseStore(dw_root).read(spark)
    views.register(spark, dw, read_op_parquet(spark, op_root))
    sql = views.load_daily(spark, dt.date(2024, 2, 19), dt.date(2024, 3, 10))
    api = kpi.kpi_daily_range(dw, dt.date(2024, 2, 19), dt.date(2024, 3, 10))
    assert sql.collect() == api.collect()
    assert views.load_monthly(spark, 2024, 2, 2024, 3).count() == 45
    assert views.item_count_sql(spark).first()["items"] == 151
