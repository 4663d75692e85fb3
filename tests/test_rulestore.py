"""Stored rule counts: equal to the rules over the whole fact, brought forward by what a load changed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.dates import ntz
from tillhouse.operators import quality
from tillhouse.sources import rulestore
from tillhouse.sources.rulestore import RuleStore
from tillhouse.sources.store import WarehouseStore

FIRST = dt.datetime(1990, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)


def full(op, dw):
    frames = [quality.domain_violations(op, dw), quality.null_violations(op, dw), quality.duplicate_keys(op, dw), quality.orphans(op, dw)]
    return {r["rule"]: r["n_bad"] for f in frames for r in f.collect() if r["table"] == "fact_sale_item"}


def stored(rules, spark, version):
    rows = rules.counts(spark, version).collect()
    assert {r["table"] for r in rows} == {"fact_sale_item"}
    return {r["rule"]: r["n_bad"] for r in rows}


@pytest.fixture(scope="module")
def loaded(spark, scratch, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "rules"), dim_bucket_rows=50)
    st.run(sf001_op, AS_OF, initial_mark=FIRST)
    rules = RuleStore(st)
    with pytest.raises(ValueError):
        rules.counts(spark, 1)
    done = rules.refresh(spark, 1)
    months = sorted(r["sale_month"] for r in st.manifest(spark, 1).collect())
    assert done == {"rows": months, "references": months, "keys": months}
    return st, rules


def test_counts_follow_each_version(spark, loaded, sf001_op):
    st, rules = loaded
    clean = st.read(spark, 1)
    assert stored(rules, spark, 1) == full(sf001_op, clean) and not any(stored(rules, spark, 1).values())
    fact = clean.fact_sale_item

    # Defects of every kind in one month; some ids of two other months stand a second time in a new one.
    april = F.col("sale_month") == 199904
    bad = (fact.where(april).withColumn("product_sk", F.when(F.col("item_id") % 3 == 0, -1).otherwise(F.col("product_sk")).cast("long"))
           .withColumn("customer_sk", F.when(F.col("item_id") % 2 == 0, -5).cast("long")).withColumn("qty", (F.col("qty") * -1).cast("int")))
    copies = fact.where(F.col("sale_month").isin(199701, 199702) & (F.col("item_id") % 4 == 0)).withColumn("sale_month", F.lit(209901))
    assert st.replace_months(bad.unionByName(copies).unionByName(copies.limit(2)), AS_OF + dt.timedelta(days=1)) == 2
    asked = []
    holding = st.holding
    st.holding = lambda ids, kept: asked.append(holding(ids, kept)) or asked[-1]
    assert rules.refresh(spark, 2, 1) == {"rows": [199904, 209901], "references": [199904, 209901], "keys": [199904, 209901]}
    now = stored(rules, spark, 2)
    assert now == full(sf001_op, st.read(spark, 2)) and now["unique item_id"] == copies.count() > 0
    assert now["product_sk -> dim_product"] > 0 < now["customer_sk -> dim_customer"] and now["qty > 0"] == bad.count()
    assert {m for m, _ in asked[-1]} >= {199701, 199702} and len(asked[-1]) <= 6, "the locator names few kept folders"

    # One of the two months loses some of the copied ids; April stays as it is, and is counted again for its orphans.
    fewer = fact.where((F.col("sale_month") == 199701) & (F.col("item_id") % 8 != 0))
    st.replace_months(fewer, AS_OF + dt.timedelta(days=2))
    done = rules.refresh(spark, 3, 2)
    assert done["rows"] == [199701] and done["references"] == [199701, 199904]
    assert stored(rules, spark, 3) == full(sf001_op, st.read(spark, 3)) != now
    # Rows corrected again, the new month left with rows of its own.
    st.replace_months(fact.where(april | (F.col("sale_month") == 199701)).unionByName(
        copies.limit(1).withColumn("item_id", F.lit(10**9).cast("long"))), AS_OF + dt.timedelta(days=3))
    rules.refresh(spark, 4, 3)
    assert stored(rules, spark, 4) == full(sf001_op, st.read(spark, 4)) and not any(stored(rules, spark, 4).values())
    assert stored(rules, spark, 2) == now, "older versions keep their counts"


def test_load_after_a_correction(spark, loaded, sf001_op):
    st, rules = loaded
    version = st.versions(spark)[-1]
    rules.refresh(spark, version, None)
    moved = F.col("sale_id") % 31 == 0
    stamp = AS_OF + dt.timedelta(days=9)
    sale = (sf001_op.sale.withColumn("sold_at", F.when(moved, F.col("sold_at") + F.expr("INTERVAL 35 DAYS")).otherwise(F.col("sold_at")))
            .withColumn("updated_at", F.when(moved, ntz(stamp)).otherwise(F.col("updated_at"))))
    op = sf001_op.with_(sale=sale)
    st.run(op, AS_OF + dt.timedelta(days=10))
    done = rules.refresh(spark, version + 1, version)
    assert 0 < len(done["rows"]) and stored(rules, spark, version + 1) == full(op, st.read(spark, version + 1))


def test_keys_that_a_dimension_lost(spark, loaded):
    st, rules = loaded
    version = st.versions(spark)[-1]
    rules.refresh(spark, version, None)
    dw = st.read(spark, version)
    gone = dw.fact_sale_item.agg(F.min("date_sk")).first()[0]
    month = dw.fact_sale_item.where(F.col("date_sk") == gone).first()["sale_month"]
    later = st.replace_months(dw.fact_sale_item.where(F.col("sale_month") == 199904), AS_OF + dt.timedelta(days=20))
    st.write_table("dim_date", dw.dim_date.where(F.col("date_sk") != gone), later)
    done = rules.refresh(spark, later, version)
    assert done["rows"] == [199904] and done["references"] == sorted({month, 199904})
    assert stored(rules, spark, later)["date_sk -> dim_date"] == dw.fact_sale_item.where(F.col("date_sk") == gone).count()


def test_references_meet_the_dimensions_as_distinct_keys(spark, loaded, monkeypatch):
    """Only lost keys are staged, and a first count stages no ids."""
    st, rules = loaded
    dw, staged = st.read(spark, 1), {}
    stage = rulestore.parquet_stage
    monkeypatch.setattr(rulestore, "parquet_stage", lambda name, df: staged.setdefault(name, stage(name, df)))
    names = list(quality.FACT_REFERENCES)
    assert rulestore.orphan_counts(dw.fact_sale_item, dw, names).isEmpty() and staged.pop("lost-keys").isEmpty()
    broken = dw.fact_sale_item.withColumn("product_sk", F.when(F.col("item_id") % 3 == 0, -1).otherwise(F.col("product_sk")))
    want = {r["sale_month"]: r["count"] for r in broken.where("product_sk = -1").groupBy("sale_month").count().collect()}
    got = rulestore.orphan_counts(broken, dw, names).collect()
    assert {r["sale_month"]: r["n_bad"] for r in got} == want and {r["rule"] for r in got} == {"product_sk -> dim_product"}
    assert [(r["rule"], r["k"]) for r in staged.pop("lost-keys").collect()] == [("product_sk -> dim_product", -1)]
    written = sorted((r["sale_month"], r["fv"]) for r in st.manifest(spark, 1).collect())
    assert rules._repeated(spark, written, [], []) == 0 and not staged
