"""Rows in question: both sides' rows of differing cells are read once for V4 and V5, and no more than they need."""

from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.plans import drift, validate
from tillhouse.sources.store import parquet_stage


def tables(df):
    return {f.split("/tables/")[1].rsplit("-", 5)[0] for f in df.inputFiles() if "/tables/" in f}


def test_lists_read_the_rows_in_question_not_the_fact(sf001_op, sf001_dw):
    facts = drift.drop_facts(sf001_dw, F.col("item_id") % 97 == 0)
    facts = drift.add_unknown_copies(facts, F.col("item_id") % 107 == 0).fact_sale_item
    dw = sf001_dw.with_(fact_sale_item=parquet_stage("whole_fact", facts))
    op = sf001_op.with_(sale=parquet_stage("whole_sale", sf001_op.sale), sale_item=parquet_stage("whole_item", sf001_op.sale_item))
    sides = validate.Sides.of_lists(op, dw, parquet_stage)
    missing, surplus = (f(op, dw, sides) for f in (validate.missing_items_all, validate.surplus_items_all))
    assert not tables(missing) & {"whole_fact", "whole_sale", "whole_item"}, tables(missing)
    assert not tables(surplus) & {"whole_fact", "whole_sale"}, "source ids alone are read, for ids under other sales"
    strange = sides.question.strange.count()
    assert 0 < strange == surplus.count() < sides.question.facts.count() < dw.fact_sale_item.count()
    want = validate.Sides.of(op, dw)
    for got, check in ((missing, validate.missing_items_all), (surplus, validate.surplus_items_all)):
        plain = check(op, dw, want)
        assert got.count() > 0 and got.exceptAll(plain).count() == 0 == plain.exceptAll(got).count()


def test_items_of_other_sales_are_not_summed(sf001_op):
    """Items meet the COMPLETED sales before they are summed."""
    plan = validate.op_sales_frame(sf001_op)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join")
    rows = validate.op_sales_frame(sf001_op)
    items = sf001_op.sale_item.join(sf001_op.sale.where(F.col("status") == S.STATUS_COMPLETED), "sale_id")
    assert rows.agg(F.sum("n_items")).first()[0] == items.count()
    assert rows.count() == items.select("sale_id").distinct().count()
