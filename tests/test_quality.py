"""Data-quality rules."""

from pyspark.sql import functions as F

from tillhouse.operators import quality
from tillhouse.plans import drift


def _bad(df):
    return {(r["table"], r["rule"]): r["n_bad"] for r in df.collect() if r["n_bad"]}


def test_row_rules_combine_both(sf001_op, sf001_dw):
    combined = {(r["table"], r["rule"]) for r in quality.row_rules(sf001_op, sf001_dw).collect()}
    separate = {(r["table"], r["rule"]) for r in quality.domain_violations(sf001_op, sf001_dw)
                .unionByName(quality.null_violations(sf001_op, sf001_dw)).collect()}
    assert combined == separate
    nulls = sf001_op.sale.withColumn("status", F.when(F.col("sale_id") < 10, F.lit(None))
                                     .otherwise(F.col("status")))
    bad = _bad(quality.row_rules(sf001_op.with_(sale=nulls)))
    assert bad == {("sale", "status not null"): 10, ("sale", "status in domain"): 10}


def test_clean_tables(sf001_op, sf001_dw):
    assert _bad(quality.domain_violations(sf001_op, sf001_dw)) == {}
    assert _bad(quality.null_violations(sf001_op, sf001_dw)) == {}
    assert _bad(quality.duplicate_keys(sf001_op, sf001_dw)) == {}
    assert _bad(quality.orphans(sf001_op, sf001_dw)) == {}


def test_injected_violations(sf001_op, sf001_dw):
    sale = sf001_op.sale.withColumn("channel", F.when(F.col("sale_id") % 100 == 0, F.lit("FAX"))
                                    .otherwise(F.col("channel")))
    item = sf001_op.sale_item.unionByName(sf001_op.sale_item.limit(3))
    op = sf001_op.with_(sale=sale, sale_item=item)
    assert _bad(quality.domain_violations(op)) == {("sale", "channel in domain"): 15}
    assert _bad(quality.duplicate_keys(op)) == {("sale_item", "unique item_id"): 3}
    dw = drift.break_product_key(sf001_dw, (F.col("item_id") % 83 == 0) & (F.col("item_id") % 97 != 0))
    assert _bad(quality.orphans(sf001_op, dw)) == {("fact_sale_item", "product_sk -> dim_product"): 24}
    nulls = sf001_op.sale.withColumn("status", F.when(F.col("sale_id") < 10, F.lit(None))
                                     .otherwise(F.col("status")))
    assert _bad(quality.null_violations(sf001_op.with_(sale=nulls)))[("sale", "status not null")] == 10


def test_duplicate_keys_per_rule(sf001_op):
    p = sf001_op.product
    same_sku = p.limit(2).withColumn("product_id", F.col("product_id") + 1_000_000)
    same_row = p.limit(1)
    bad = _bad(quality.duplicate_keys(sf001_op.with_(product=p.unionByName(same_sku).unionByName(same_row))))
    assert bad == {("product", "unique sku"): 2, ("product", "unique product_id"): 1}
