"""Edge cases: rounding, calendar attributes, homonymous branches, NULL customer."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.functions.money import guarded_ratio, scaled_price
from tillhouse.model import OpTables, literal_rows
from tillhouse.plans import etl, kpi

AS_OF = dt.datetime(2024, 4, 2, 12, 0)
T0 = dt.datetime(2024, 1, 1)


def test_half_cent_rounds_up(spark):
    df = spark.range(1).select(
        # 10.30 * 0.95 = 9.785 -> 9.79 (half-even would give 9.78)
        scaled_price(F.lit("10.30").cast(S.MONEY), F.lit(7)).alias("p"),
        # 1.00 / 800.00 * 100 = 0.125 -> 0.13
        guarded_ratio(F.lit("1.00").cast("decimal(18,2)"), F.lit("800.00").cast("decimal(18,2)"), 2, 100)
        .alias("pct"),
        guarded_ratio(F.lit("1.00").cast("decimal(18,2)"), F.lit("0.00").cast("decimal(18,2)"), 2, 100)
        .alias("zero"))
    r = df.first()
    assert (r["p"], r["pct"], r["zero"]) == (Decimal("9.79"), Decimal("0.13"), Decimal("0.00"))


def test_calendar_attributes(spark):
    rows = {r["date"]: r for r in etl.date_rows(spark, dt.date(2024, 3, 10), dt.date(2024, 4, 1)).collect()}
    assert len(rows) == 23
    sun, mon = rows[dt.date(2024, 3, 10)], rows[dt.date(2024, 3, 11)]
    assert (sun["weekday"], mon["weekday"]) == (7, 1)
    assert rows[dt.date(2024, 3, 31)]["quarter"] == 1 and rows[dt.date(2024, 4, 1)]["quarter"] == 2
    assert rows[dt.date(2024, 3, 31)]["month_name"] == "March"
    assert rows[dt.date(2024, 4, 1)]["month_name"] == "April"
    dec = etl.date_rows(spark, dt.date(2023, 12, 31), dt.date(2023, 12, 31)).first()
    assert (dec["quarter"], dec["month"], dec["day"], dec["year"]) == (4, 12, 31, 2023)


def _op(spark):
    branch = literal_rows(spark, [
        (1, "Loja A", "Cidade 1", "AA", True, T0, T0),
        (2, "Loja A", "Cidade 1", "AA", True, T0, T0),   # same name and city: merges in both views
        (3, "Loja A", "Cidade 2", "BB", True, T0, T0),   # same name, other city: own daily row
    ], S.BRANCH)
    customer = literal_rows(spark, [(1, "C1", None, "Cidade 1", "AA", T0, T0)], S.CUSTOMER)
    product = literal_rows(spark, [
        (1, "S1", "P1", "X", Decimal("10.00"), True, T0, T0),
        (2, "S2", "P2", "Y", Decimal("20.00"), True, T0, T0),
    ], S.PRODUCT)
    day = dt.datetime(2024, 3, 10, 10, 0)
    sale = literal_rows(spark, [
        (1, 1, 1, day, "COMPLETED", "STORE", None, T0, T0),
        (2, 2, None, day, "COMPLETED", "ONLINE", None, T0, T0),   # no customer
        (3, 3, 1, day, "COMPLETED", "STORE", None, T0, T0),
    ], S.SALE)
    item = literal_rows(spark, [
        (1, 1, 1, 1, Decimal("10.00"), Decimal("0.00"), T0, T0),
        (2, 1, 2, 2, Decimal("20.00"), Decimal("1.00"), T0, T0),  # sale 1 spans two categories
        (3, 2, 1, 3, Decimal("10.00"), Decimal("0.00"), T0, T0),
        (4, 3, 2, 1, Decimal("20.00"), Decimal("0.00"), T0, T0),
    ], S.SALE_ITEM)
    return OpTables(branch=branch, customer=customer, product=product, sale=sale, sale_item=item)


def test_homonymous_branches_and_null_customer(spark):
    dw = etl.first_load(_op(spark), AS_OF).dw
    f = dw.fact_sale_item
    assert f.count() == 4
    assert f.filter(F.col("sale_id") == 2).select("customer_sk").first()[0] is None
    daily = {(r["branch"], r["city"]): r for r in kpi.kpi_daily_branch(dw).collect()}
    assert set(daily) == {("Loja A", "Cidade 1"), ("Loja A", "Cidade 2")}
    a1 = daily[("Loja A", "Cidade 1")]
    assert (a1["n_sales"], a1["units_sold"], a1["gross"], a1["net"]) == (2, 6, Decimal("80.00"), Decimal("79.00"))
    assert a1["avg_ticket"] == Decimal("39.50") and a1["units_per_sale"] == Decimal("3.00")
    assert a1["discount_pct"] == Decimal("1.25")
    monthly = kpi.kpi_monthly_branch_category(dw).collect()
    by_cat = {r["category"]: r["n_sales"] for r in monthly}
    # one monthly row per category for the merged name; sale 1 counts in both categories
    assert len(monthly) == 2 and by_cat == {"X": 2, "Y": 2}


def test_literal_rows_are_one_literal(spark, monkeypatch):
    """The plan of literal rows does not grow with them, and every type comes back as given."""
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType()), T.StructField("n", T.LongType()),
                           T.StructField("d", T.DecimalType(38, 2)), T.StructField("t", S.NTZ)])
    odd = [('a "quoted" \\ line\n', True, -2**63, Decimal("123456789012345678901234567890.12"), dt.datetime(2002, 1, 1, 3, 4, 5, 678901)),
           ("", False, 2**63 - 1, Decimal("-0.01"), dt.datetime(1, 1, 1)), ("é\u2581\U0001f600 ", None, 0, None, None), (None, None, None, None, None)]
    assert sorted(map(repr, literal_rows(spark, odd, schema).collect())) == sorted(repr(Row(s=r[0], b=r[1], n=r[2], d=r[3], t=r[4])) for r in odd)
    made, lit = [], F.lit
    monkeypatch.setattr(F, "lit", lambda v: made.append(v) or lit(v))
    few = literal_rows(spark, odd, schema) and len(made)
    many = literal_rows(spark, odd * 1000, schema)
    assert len(made) - few == few and many.count() == 4000
