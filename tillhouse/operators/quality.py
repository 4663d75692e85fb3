"""Table constraints as data-quality jobs.

The operational / dimensional DDL declares NOT NULL, CHECK, primary/unique
keys and foreign keys.  Parquet enforces none of them, so each rule becomes a
violation count:

* ``domain_violations``   CHECK rules, one aggregate pass per table
* ``null_violations``     NOT NULL columns, one aggregate pass per table
* ``row_rules``           both of the above in one pass per table (the quality job)
* ``duplicate_keys``      primary / unique keys: keys seen more than once
* ``orphans``             foreign keys (and the sale -> item cascade) via anti joins

Each returns a long frame ``(table, rule, n_bad)``.  Key and orphan counts
aggregate map-side before their shuffle, so a hot duplicated key or a hot
missing parent reduces to one partial row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.model import DwTables, OpTables


def _long(table: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count rows violating each rule in one pass, return (table, rule, n_bad)."""
    wide = df.agg(*[F.count_if(F.coalesce(~ok, F.lit(True))).alias(name) for name, ok in rules.items()])
    return wide.unpivot([], list(rules), "rule", "n_bad").select(
        F.lit(table).alias("table"), "rule", F.col("n_bad").cast("long").alias("n_bad"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def between(c: str, lo: int, hi: int) -> Column:
    return F.col(c).between(lo, hi)


def domain_rules_op(op: OpTables) -> list[tuple[str, DataFrame, dict[str, Column]]]:
    return [
        ("product", op.product, {"list_price >= 0": F.col("list_price") >= 0}),
        ("sale", op.sale, {"status in domain": F.col("status").isin(*S.STATUSES),
                           "channel in domain": F.col("channel").isin(*S.CHANNELS)}),
        ("sale_item", op.sale_item, {"qty > 0": F.col("qty") > 0,
                                     "unit_price >= 0": F.col("unit_price") >= 0,
                                     "discount >= 0": F.col("discount") >= 0}),
    ]


def fact_checks() -> dict[str, Column]:
    return {"qty > 0": F.col("qty") > 0, "gross >= 0": F.col("gross") >= 0,
            "discount >= 0": F.col("discount") >= 0, "net >= 0": F.col("net") >= 0}


def fact_row_rules(fact: DataFrame) -> dict[str, Column]:
    """NOT NULL and CHECK rules of the fact."""
    not_null = {f"{c} not null": F.col(c).isNotNull() for c in _not_null_columns(S.FACT_SALE_ITEM) if c in fact.columns}
    return not_null | fact_checks()


def domain_rules_dw(dw: DwTables) -> list[tuple[str, DataFrame, dict[str, Column]]]:
    return [
        ("dim_date", dw.dim_date, {"month 1-12": between("month", 1, 12), "day 1-31": between("day", 1, 31),
                                   "quarter 1-4": between("quarter", 1, 4),
                                   "weekday 1-7": between("weekday", 1, 7)}),
        ("fact_sale_item", dw.fact_sale_item, fact_checks()),
    ]


def domain_violations(op: OpTables, dw: DwTables | None = None) -> DataFrame:
    specs = domain_rules_op(op) + (domain_rules_dw(dw) if dw is not None else [])
    return _union([_long(t, df, rules) for t, df, rules in specs])


def _not_null_columns(schema) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def null_violations(op: OpTables, dw: DwTables | None = None) -> DataFrame:
    tables = [(n, getattr(op, n), S.OP_SCHEMAS[n]) for n in S.OP_SCHEMAS]
    if dw is not None:
        tables += [(n, getattr(dw, n), S.DW_SCHEMAS[n]) for n in S.DW_SCHEMAS]
    frames = []
    for name, df, schema in tables:
        rules = {f"{c} not null": F.col(c).isNotNull() for c in _not_null_columns(schema)}
        frames.append(_long(name, df, rules))
    return _union(frames)


def row_rules(op: OpTables, dw: DwTables | None = None) -> DataFrame:
    """NOT NULL and CHECK rules together: one aggregate pass per table."""
    rules: dict[str, tuple[DataFrame, dict[str, Column]]] = {}
    tables = [(n, getattr(op, n), S.OP_SCHEMAS[n]) for n in S.OP_SCHEMAS]
    if dw is not None:
        tables += [(n, getattr(dw, n), S.DW_SCHEMAS[n]) for n in S.DW_SCHEMAS]
    for name, df, schema in tables:
        rules[name] = (df, {f"{c} not null": F.col(c).isNotNull() for c in _not_null_columns(schema)})
    specs = domain_rules_op(op) + (domain_rules_dw(dw) if dw is not None else [])
    for name, df, checks in specs:
        rules[name][1].update(checks)
    return _union([_long(name, df, r) for name, (df, r) in rules.items()])


# Primary / unique keys of the model.
KEYS = {
    "branch": ["branch_id"], "customer": ["customer_id"], "product": ["product_id"], "product.sku": ["sku"],
    "sale": ["sale_id"], "sale_item": ["item_id"],
    "etl_control": ["process"], "dim_date": ["date_sk"], "dim_date.date": ["date"],
    "dim_branch": ["branch_sk"], "dim_branch.branch_id": ["branch_id"],
    "dim_product": ["product_sk"], "dim_product.product_id": ["product_id"],
    "dim_customer": ["customer_sk"], "dim_customer.customer_id": ["customer_id"],
    "fact_sale_item": ["item_id"],
}


def _grouping_id(all_cols: list[str], key: list[str]) -> int:
    """grouping_id() of a grouping set: bit set for every column not in it (first column = high bit)."""
    n = len(all_cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in key)


def duplicate_keys(op: OpTables, dw: DwTables | None = None) -> DataFrame:
    """(table, rule, n_bad) with n_bad = number of key values seen more than once.

    The key rules of one table share one shuffle: grouping sets count every
    key at once (map-side partial counts, so a hot duplicated key reduces to
    one row per task), then one pass counts the keys seen more than once.
    """
    by_table: dict[str, list[list[str]]] = {}
    for name, key in KEYS.items():
        by_table.setdefault(name.split(".")[0], []).append(key)
    frames = []
    for table, keys in by_table.items():
        src = op if table in S.OP_SCHEMAS else dw
        if src is None:
            continue
        df = getattr(src, table)
        labels = {f"unique {', '.join(k)}": k for k in keys}
        if len(keys) == 1:
            dup = df.groupBy(*keys[0]).count().filter(F.col("count") > 1)
            wide = dup.agg(F.count(F.lit(1)).alias(next(iter(labels))))
        else:
            cols = list(dict.fromkeys(c for k in keys for c in k))
            counts = df.groupingSets([list(k) for k in keys], *cols).agg(
                F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
            wide = counts.filter(F.col("_n") > 1).agg(
                *[F.count_if(F.col("_gid") == _grouping_id(cols, k)).alias(label) for label, k in labels.items()])
        frames.append(wide.unpivot([], list(labels), "rule", "n_bad").select(
            F.lit(table).alias("table"), "rule", F.col("n_bad").cast("long").alias("n_bad")))
    return _union(frames)


def _orphan_count(table: str, rule: str, child: DataFrame, parent: DataFrame, ckey: str, pkey: str) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row.

    Child keys are counted first (map-side partial aggregation), so a hot
    reference reaches the anti join as one row per key.
    """
    c = (child.select(F.col(ckey).alias("_k")).filter(F.col("_k").isNotNull())
         .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
    p = parent.select(F.col(pkey).alias("_k"))
    return c.join(p, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_bad")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), "n_bad")


# References of the fact: rule -> (dimension, key column of both).
FACT_REFERENCES = {f"{key} -> {dim}": (dim, key) for dim, key in (
    ("dim_date", "date_sk"), ("dim_branch", "branch_sk"), ("dim_product", "product_sk"), ("dim_customer", "customer_sk"))}


def orphans(op: OpTables, dw: DwTables | None = None) -> DataFrame:
    """Foreign-key violations; a NULL reference is allowed (sale.customer_id)."""
    frames = [
        _orphan_count("sale", "branch_id -> branch", op.sale, op.branch, "branch_id", "branch_id"),
        _orphan_count("sale", "customer_id -> customer", op.sale, op.customer, "customer_id", "customer_id"),
        _orphan_count("sale_item", "sale_id -> sale", op.sale_item, op.sale, "sale_id", "sale_id"),
        _orphan_count("sale_item", "product_id -> product", op.sale_item, op.product, "product_id", "product_id"),
    ]
    if dw is not None:
        frames += [_orphan_count("fact_sale_item", rule, dw.fact_sale_item, getattr(dw, dim), key, key)
                   for rule, (dim, key) in FACT_REFERENCES.items()]
    return _union(frames)
