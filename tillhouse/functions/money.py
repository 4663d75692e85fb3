"""Exact money arithmetic on decimals.

PostgreSQL ``ROUND(numeric, 2)`` rounds half away from zero; Spark's ``round``
on a decimal is HALF_UP, the same thing.  Ratios are taken on sums cast to
``decimal(18,2)`` so the quotient keeps 20 fractional digits before the final
rounding (never ``double``, never ``bround``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse import schemas as S

# Fixed values of the seed's price and discount rules.
PRICE_FACTOR_BASE = 95          # unit price = list * (0.95 + 0.01 * (k % 7))
PRICE_FACTOR_CYCLE = 7
DISCOUNT_CYCLE = 6              # discount by k % 6 on COMPLETED sales
DISCOUNT_BY_REMAINDER = {0: "15.00", 1: "10.00", 2: "5.00"}


def money(col: Column, dtype=S.MONEY) -> Column:
    return col.cast(dtype)


def scaled_price(list_price: Column, k: Column) -> Column:
    """round(list_price * (0.95 + 0.01 * (k % 7)), 2), exact; multiplied only, as a decimal division is far slower."""
    percent = (F.lit(PRICE_FACTOR_BASE) + k % PRICE_FACTOR_CYCLE).cast("decimal(3,0)")
    factor = (percent * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(3,2)")
    return F.round(list_price * factor, 2).cast(S.MONEY)


def seed_discount(completed: Column, k: Column) -> Column:
    rem = k % DISCOUNT_CYCLE
    expr = None
    for r, value in DISCOUNT_BY_REMAINDER.items():
        cond = completed & (rem == r)
        val = F.lit(value).cast(S.MONEY)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit("0.00").cast(S.MONEY))


def line_gross(qty: Column, unit_price: Column) -> Column:
    """ROUND(qty * unit_price, 2) as the fact's decimal(14,2)."""
    return F.round(qty.cast("decimal(10,0)") * unit_price, 2).cast(S.FACT_MONEY)


def line_net(qty: Column, unit_price: Column, discount: Column) -> Column:
    return F.round(qty.cast("decimal(10,0)") * unit_price - discount, 2).cast(S.FACT_MONEY)


def sum_money(col: Column) -> Column:
    """SUM of a money column in the contract type decimal(18,2)."""
    return F.sum(col).cast(S.SUM_MONEY)


def ratio(num: Column, den: Column, scale: int = 2, factor: int = 1) -> Column:
    """ROUND(num / den * factor, scale) in exact decimals; NULL when den is 0/NULL."""
    n = num.cast("decimal(18,2)")
    d = den.cast("decimal(18,2)")
    q = n / F.nullif(d, F.lit(0).cast("decimal(18,2)"))
    if factor != 1:
        q = q * F.lit(factor).cast("decimal(5,0)")
    return F.round(q, scale)


def guarded_ratio(num: Column, den: Column, scale: int = 2, factor: int = 1) -> Column:
    """CASE WHEN den > 0 THEN ROUND(num / den * factor, scale) ELSE 0 END."""
    return F.when(den > 0, ratio(num, den, scale, factor)).otherwise(F.lit(0)).cast(S.SUM_MONEY)
