"""Golden values of the seed dataset (hand-derived totals, see FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import etl, kpi, reports
from tillhouse.sources import seed

AS_OF = dt.datetime(2024, 3, 10, 12, 0)
BRANCH = {i + 1: name for i, (name, _, _) in enumerate(seed.SEED_BRANCHES)}


@pytest.fixture(scope="module")
def seeded(spark):
    op = seed.seed(spark, AS_OF)
    return op, etl.first_load(op, AS_OF).dw


def test_seed_shapes(seeded):
    op, _ = seeded
    assert dict(op.sale.groupBy("status").count().collect()) == {"COMPLETED": 48, "PENDING": 6, "CANCELLED": 6}
    assert dict(op.sale.groupBy("channel").count().collect()) == {"STORE": 42, "ONLINE": 12, "PHONE": 6}
    items = op.sale_item.join(op.sale, "sale_id").groupBy("status").count().collect()
    assert dict(items) == {"COMPLETED": 120, "PENDING": 18, "CANCELLED": 12}
    ids = op.sale_item.agg(F.min("item_id"), F.max("item_id"), F.countDistinct("item_id")).first()
    assert tuple(ids) == (1, 150, 150)
    assert (op.branch.count(), op.product.count(), op.customer.count()) == (5, 12, 20)


def test_seed_first_load_totals(seeded):
    _, dw = seeded
    f = dw.fact_sale_item.agg(F.count(F.lit(1)), F.countDistinct("sale_id"), F.sum("qty"), F.sum("gross"),
                              F.sum("discount"), F.sum("net"), F.min("net")).first()
    assert tuple(f) == (120, 48, 240, Decimal("46299.85"), Decimal("560.00"), Decimal("45739.85"),
                        Decimal("18.91"))
    assert (dw.dim_date.count(), dw.dim_branch.count(), dw.dim_product.count(), dw.dim_customer.count()) == (
        20, 5, 12, 20)


def test_seed_daily_kpi(seeded):
    _, dw = seeded
    daily = kpi.kpi_daily_branch(dw)
    rows = daily.orderBy("date").collect()
    assert len(rows) == 16
    assert rows[0]["date"] == dt.date(2024, 2, 20) and rows[-1]["date"] == dt.date(2024, 3, 8)
    missing = {dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 9), dt.date(2024, 3, 10)}
    assert not missing & {r["date"] for r in rows}
    assert missing <= {r["date"] for r in dw.dim_date.collect()}
    per_branch = {r["branch"]: r["net"] for r in daily.groupBy("branch").agg(F.sum("net").alias("net")).collect()}
    assert per_branch == {BRANCH[1]: Decimal("6912.55"), BRANCH[2]: Decimal("4500.26"),
                          BRANCH[3]: Decimal("11410.74"), BRANCH[4]: Decimal("11475.21"),
                          BRANCH[5]: Decimal("11441.09")}
    assert all(r["n_sales"] == 3 for r in rows)


def test_seed_ticket_is_exact(seeded):
    _, dw = seeded
    f = dw.fact_sale_item.agg(F.sum("net").alias("n"), F.countDistinct("sale_id").alias("k")).first()
    from tillhouse.functions.money import ratio
    from pyspark.sql import Row
    spark = dw.fact_sale_item.sparkSession
    t = spark.createDataFrame([Row(n=f["n"], k=f["k"])]).select(ratio(F.col("n"), F.col("k")).alias("t")).first()
    assert t["t"] == Decimal("952.91")


def test_seed_monthly_kpi_and_categories(seeded):
    _, dw = seeded
    m = kpi.kpi_monthly_branch_category(dw)
    assert m.count() == 45
    assert m.filter("month = 2").count() == 22 and m.filter("month = 3").count() == 23
    r = m.filter((F.col("month") == 2) & (F.col("branch") == BRANCH[4]) & (F.col("category") == "Calçados")).first()
    assert (r["net"], r["n_sales"], r["units_sold"]) == (Decimal("2676.16"), 3, 9)
    r = m.filter((F.col("month") == 3) & (F.col("branch") == BRANCH[3]) & (F.col("category") == "Vestuário")).first()
    assert (r["net"], r["n_sales"], r["units_sold"]) == (Decimal("2453.02"), 4, 12)
    # categories recomputed from the fact: distinct sales are not additive over categories
    fact = dw.fact_sale_item.join(dw.dim_product, "product_sk")
    cats = {r["category"]: (r["net"], r["n"], r["u"]) for r in fact.groupBy("category").agg(
        F.sum("net").alias("net"), F.countDistinct("sale_id").alias("n"), F.sum("qty").alias("u")).collect()}
    assert cats == {"Acessórios": (Decimal("4432.76"), 28, 52), "Calçados": (Decimal("17711.69"), 20, 60),
                    "Eletrônicos": (Decimal("8036.32"), 16, 48), "Utilidades": (Decimal("929.22"), 12, 12),
                    "Vestuário": (Decimal("14629.86"), 24, 68)}
    assert sum(v[1] for v in cats.values()) == 100


def test_seed_weekday_matrix(seeded):
    _, dw = seeded
    daily = kpi.kpi_daily_range(dw, dt.date(2024, 2, 19), dt.date(2024, 3, 10))
    mat = {r["weekday"]: r.asDict() for r in reports.weekday_matrix(daily, dw.dim_date, reports.branch_labels(dw)).collect()}
    assert sorted(mat) == [1, 2, 3, 4, 5, 6, 7]
    assert mat[1][BRANCH[2]] == Decimal("3241.66") and mat[1][BRANCH[1]] == 0
    assert mat[2][BRANCH[1]] == Decimal("2558.32") and mat[2][BRANCH[5]] == Decimal("4405.03")
    assert mat[6][BRANCH[4]] == Decimal("1235.02") and mat[7][BRANCH[5]] == Decimal("3230.26")


def test_seed_top_categories_keeps_all_five(seeded):
    _, dw = seeded
    monthly = kpi.kpi_monthly_range(dw, 2024, 2, 2024, 3)
    assert reports.top_categories(monthly).count() == 5
    cells = reports.stack_cells(monthly, reports.branch_labels(dw))
    # the first branch of each bar starts at 0, bases grow within a bar
    first = cells.filter(F.col("branch") == BRANCH[3]).select("base").distinct().collect()
    assert [r[0] for r in first] == [0]
