"""Defect injection for the reconciliation suite.

Each function returns a warehouse with one kind of defect, selected by a
predicate on the fact (or source) rows.  The suite must fail on each of them:

* ``drop_facts``           facts missing             -> V1, V2, V3, V4
* ``bump_amounts``         gross and net changed     -> V2, V3
* ``add_foreign_status``   facts of non-COMPLETED sales inserted -> V1, V2, V3, V5
* ``add_unknown_copies``   copies under item ids the source lacks -> V1, V2, V3, V5
* ``break_product_key``    product key without dimension row -> V6
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.model import DwTables, OpTables, conform
from tillhouse.plans.etl import fact_source


def drop_facts(dw: DwTables, which: Column) -> DwTables:
    return dw.with_(fact_sale_item=dw.fact_sale_item.filter(~which))


def bump_amounts(dw: DwTables, which: Column, delta: str = "1.00") -> DwTables:
    d = F.lit(Decimal(delta)).cast(S.FACT_MONEY)
    f = dw.fact_sale_item
    f = f.withColumn("gross", F.when(which, F.col("gross") + d).otherwise(F.col("gross")).cast(S.FACT_MONEY))
    f = f.withColumn("net", F.when(which, F.col("net") + d).otherwise(F.col("net")).cast(S.FACT_MONEY))
    return dw.with_(fact_sale_item=conform(f, S.FACT_SALE_ITEM))


def add_foreign_status(dw: DwTables, op: OpTables, status: str, which_item: Column,
                       as_of: dt.datetime) -> DwTables:
    """Insert fact rows built from items of sales in ``status`` (not COMPLETED)."""
    extra = fact_source(op.with_(sale_item=op.sale_item.filter(which_item)), dw, dt.datetime(1900, 1, 1), as_of,
                        status=status)
    return dw.with_(fact_sale_item=dw.fact_sale_item.unionByName(extra))


def add_unknown_copies(dw: DwTables, which: Column) -> DwTables:
    f = dw.fact_sale_item
    copies = f.filter(which).withColumn("item_id", -F.col("item_id"))
    return dw.with_(fact_sale_item=f.unionByName(copies))


def break_product_key(dw: DwTables, which: Column) -> DwTables:
    f = dw.fact_sale_item.withColumn(
        "product_sk", F.when(which, F.lit(-1).cast("long")).otherwise(F.col("product_sk")))
    return dw.with_(fact_sale_item=conform(f, S.FACT_SALE_ITEM))
