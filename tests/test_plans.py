"""Physical plan shapes that matter at scale."""

import datetime as dt
import os

from tillhouse.plans import kpi, validate
from tillhouse.sources.store import WarehouseStore


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_kpi_plans(spark, scratch, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "plan_store"))
    st.run(sf001_op, dt.datetime(2002, 1, 1), initial_mark=dt.datetime(1990, 1, 1))
    dw = st.read(spark)
    daily = kpi.kpi_daily_range(dw, dt.date(2000, 8, 1), dt.date(2001, 8, 1))
    text = _formatted(daily)
    # date and branch dimensions broadcast, the fact scan prunes month partitions
    assert "BroadcastHashJoin" in text
    assert "PartitionFilters: [isnotnull(sale_month" in text and "sale_month#" in text
    # only the needed fact columns are read
    scan = [ln for ln in text.splitlines() if ln.startswith("ReadSchema") and "sale_id" in ln][0]
    assert "loaded_at" not in scan and "customer_sk" not in scan
    # missing-items list is a distributed top-k, not a global sort
    assert "TakeOrderedAndProject" in _formatted(validate.missing_items(sf001_op, dw))


def test_cluster_like_plan_shapes(spark, sf001_op, sf001_dw):
    """With automatic broadcast off (as for large tables), check shuffle shapes."""
    from tillhouse.plans import etl

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dw = sf001_dw
        fact = etl.fact_source(sf001_op, dw, dt.datetime(1990, 1, 1), dt.datetime(2002, 1, 1))
        plans = {
            "fact": _formatted(fact),
            "daily": _formatted(kpi.kpi_daily_branch(dw)),
            "monthly": _formatted(kpi.kpi_monthly_branch_category(dw)),
            "suite": _formatted(validate.verdict(sf001_op, dw)),
        }
        for name, text in plans.items():
            assert "EvalPython" not in text, name               # no Python UDFs
            if name != "suite":  # the suite's global aggregates gather one partial row per task
                assert "SinglePartition" not in text, name      # no global sort / window over data
        # the fact load shuffles items once on sale_id (one exchange per join side)
        assert plans["fact"].count("hashpartitioning(sale_id") == 2
        # with automatic broadcast off, only the calendar is broadcast (one row per day)
        assert plans["daily"].split("\n\n")[0].count("BroadcastExchange") == 1
        assert "TakeOrderedAndProject" in _formatted(validate.surplus_items(sf001_op, dw))
        # totals need no per-sale rows of the fact, and two distinct counts must not multiply its rows
        for check in (validate.item_counts, validate.money_totals):
            assert "hashpartitioning(date_sk" not in _formatted(check(sf001_op, dw))
        assert "Expand" not in _formatted(validate.sanity(sf001_op, dw))
        assert "Expand" not in _formatted(validate.daily_diffs(sf001_op, dw))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
