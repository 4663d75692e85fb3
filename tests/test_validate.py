"""Reconciliation suite: clean load passes, each defect fails its checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.plans import drift, validate

AS_OF = dt.datetime(2002, 1, 1)


def _item():
    return F.col("item_id")


def verdict(op, dw):
    return {r["check"]: (r["passed"], r["n_bad"]) for r in validate.verdict(op, dw).collect()}


def test_clean_load_passes(sf001_op, sf001_dw):
    ok, rows = validate.run_checks(sf001_op, sf001_dw)
    assert ok, rows
    r = validate.item_counts(sf001_op, sf001_dw).first()
    assert r["op_items_completed"] == r["dw_items"] == 1995
    s = validate.sanity(sf001_op, sf001_dw).first()
    assert s["dw_net_total"] == s["op_net_total"] and s["dw_avg_ticket"] == s["op_avg_ticket"]


def test_missing_facts(sf001_op, sf001_dw):
    item = _item()
    dw = drift.drop_facts(sf001_dw, item % 97 == 0)
    v = verdict(sf001_op, dw)
    assert v["item_counts"] == (False, 21)
    assert not v["money_totals"][0] and not v["daily_diffs"][0]
    assert v["missing_items"] == (False, 21)
    assert v["surplus_items"][0] and v["dim_key_check"][0]
    listed = validate.missing_items(sf001_op, dw).collect()
    assert len(listed) == 21 and [r["item_id"] % 97 for r in listed] == [0] * 21
    assert [r["sold_at"] for r in listed] == sorted(r["sold_at"] for r in listed)


def test_wrong_amounts(sf001_op, sf001_dw):
    item = _item()
    dw = drift.bump_amounts(sf001_dw, (item % 89 == 0) & (item % 97 != 0))
    v = verdict(sf001_op, dw)
    assert v["item_counts"][0] and not v["money_totals"][0] and not v["daily_diffs"][0]
    m = validate.money_totals(sf001_op, dw).first()
    assert float(m["diff_gross"]) == -26.0 and float(m["diff_net"]) == -26.0 and float(m["diff_discount"]) == 0


def test_surplus_non_completed(sf001_op, sf001_dw):
    item = _item()
    dw = drift.add_foreign_status(sf001_dw, sf001_op, S.STATUS_PENDING, item % 101 == 0, AS_OF)
    v = verdict(sf001_op, dw)
    assert v["item_counts"] == (False, 22)
    assert v["surplus_items"] == (False, 22)
    assert not v["daily_diffs"][0]


def test_surplus_unknown_items(sf001_op, sf001_dw):
    item = _item()
    dw = drift.add_unknown_copies(sf001_dw, item % 107 == 0)
    n = sf001_dw.fact_sale_item.filter(item % 107 == 0).count()
    v = verdict(sf001_op, dw)
    assert v["surplus_items"] == (False, n) and v["item_counts"] == (False, n)
    listed = validate.surplus_items(sf001_op, dw).collect()
    assert all(r["item_id"] < 0 for r in listed)


def test_broken_dimension_key(sf001_op, sf001_dw):
    item = _item()
    dw = drift.break_product_key(sf001_dw, (item % 83 == 0) & (item % 97 != 0))
    v = verdict(sf001_op, dw)
    assert v["dim_key_check"] == (False, 24)
    r = validate.dim_key_check(dw).first()
    assert (r["no_dim_date"], r["no_dim_branch"], r["no_dim_product"]) == (0, 0, 24)


@pytest.mark.parametrize("limit", [5])
def test_lists_are_bounded(sf001_op, sf001_dw, limit):
    item = _item()
    dw = drift.drop_facts(sf001_dw, item % 97 == 0)
    assert validate.missing_items(sf001_op, dw, limit=limit).count() == limit


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_clean_load_moves_no_item_row(sf001_op, sf001_dw):
    from tillhouse.sources.store import parquet_stage

    sides = validate.Sides.staged_by(sf001_op, sf001_dw, parquet_stage)
    assert sides.cells.count() == 0
    for check in (validate.missing_items, validate.surplus_items):
        plan = final_plan(check(sf001_op, sf001_dw, sides=sides))
        assert "Exchange" not in plan and "EmptyRelation" in plan, plan


def test_differing_cells_are_few_and_enough(sf001_op, sf001_dw):
    lost = drift.drop_facts(sf001_dw, _item() == sf001_dw.fact_sale_item.agg(F.min("item_id")).scalar())
    sides = validate.Sides.of(sf001_op, lost)
    assert sides.cells.count() == 1 and validate.missing_items(sf001_op, lost, sides=sides).count() == 1
    # an item under another month: both cells differ, yet it is neither missing nor surplus
    moved = sf001_dw.with_(fact_sale_item=sf001_dw.fact_sale_item.withColumn(
        "sale_month", F.when(_item() % 97 == 0, F.lit(199001)).otherwise(F.col("sale_month"))))
    sides = validate.Sides.of(sf001_op, moved)
    assert sides.cells.count() > 21
    assert validate.missing_items(sf001_op, moved, sides=sides).count() == 0
    assert validate.surplus_items(sf001_op, moved, sides=sides).count() == 0
    # an item under another, completed sale is stored; under a sale of another status it is surplus
    item = sf001_dw.fact_sale_item.agg(F.min("item_id")).first()[0]
    for status, surplus in ((S.STATUS_COMPLETED, 0), (S.STATUS_PENDING, 1)):
        other = sf001_op.sale.where(F.col("status") == status).agg(F.max("sale_id")).first()[0]
        dw = sf001_dw.with_(fact_sale_item=sf001_dw.fact_sale_item.withColumn(
            "sale_id", F.when(_item() == item, F.lit(other)).otherwise(F.col("sale_id"))))
        assert validate.missing_items(sf001_op, dw).count() == 0 and validate.surplus_items(sf001_op, dw).count() == surplus


def test_rows_in_question_grow_with_the_defects(spark, sf001_op, sf001_dw):
    """One defect in every hundredth of many sales of a month: only those sales' rows are in question."""
    n, hit = 5000, F.col("sale_id") % 100 == 0
    day = F.lit("1995-03-15 10:00:00").cast(S.NTZ)
    sale = spark.range(n).select(F.col("id").alias("sale_id"), F.lit(1).alias("branch_id"), day.alias("sold_at"), F.lit(S.STATUS_COMPLETED).alias("status"))
    item = spark.range(2 * n).select(F.col("id").alias("item_id"), F.floor(F.col("id") / 2).alias("sale_id"), F.lit(1).alias("qty"),
                                     F.lit("1.00").cast(S.MONEY).alias("unit_price"), F.lit("0.00").cast(S.MONEY).alias("discount"))
    fact = item.select("item_id", "sale_id", F.lit(199503).alias("sale_month")).where(~(hit & (F.col("item_id") % 2 == 1)))
    cells = validate.differing_cells(validate.op_sales_frame(sf001_op.with_(sale=sale, sale_item=item)), fact)
    rows = validate._in_cells(fact, cells, F.col("sale_month"))
    assert rows.count() == n // 100 and rows.where(~hit).isEmpty()
