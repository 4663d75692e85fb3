"""Reading and appending operational tables.

* ``read_op_parquet``  - the five tables from ``<root>/<table>`` with their fixed schemas
* ``read_op_jdbc``     - the same from a live OLTP database, partitioned reads
* ``append_rows``      - append with the column defaults of the model filled in

The JDBC reader splits each table on its integer key into ``num_partitions``
range queries; the high-water-mark predicate on ``updated_at`` is pushed into
the database query (``pushDownPredicate``) so an incremental run only pulls
changed sales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.dates import ntz
from tillhouse.model import OpTables, conform

# Key column used to split each table into parallel JDBC reads.
JDBC_SPLIT_COLUMN = {"branch": "branch_id", "customer": "customer_id", "product": "product_id",
                     "sale": "sale_id", "sale_item": "item_id"}


def read_op_parquet(spark: SparkSession, root: str) -> OpTables:
    return OpTables(**{name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
                       for name, schema in S.OP_SCHEMAS.items()})


def read_op_jdbc(spark: SparkSession, url: str, tables: dict[str, str], properties: dict[str, str],
                 bounds: dict[str, tuple[int, int]], num_partitions: int = 64) -> OpTables:
    """Operational tables over JDBC.

    ``tables`` maps our table names to database table names, ``bounds`` the
    (lower, upper) key range per table for the partitioned read.
    """
    frames = {}
    for name, schema in S.OP_SCHEMAS.items():
        lo, hi = bounds[name]
        df = spark.read.jdbc(url, tables[name], column=JDBC_SPLIT_COLUMN[name], lowerBound=lo, upperBound=hi,
                             numPartitions=num_partitions, properties={**properties, "pushDownPredicate": "true"})
        frames[name] = conform(df, schema)
    return OpTables(**frames)


# Column defaults of the operational model (filled when a row omits them).
DEFAULTS = {"active": True, "discount": "0.00"}


def with_defaults(df: DataFrame, schema, now: dt.datetime) -> DataFrame:
    """Add missing columns: ``active`` TRUE, ``discount`` 0, timestamps = now, others NULL."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("created_at", "updated_at"):
            cols.append(ntz(now).alias(f.name))
        elif f.name in DEFAULTS:
            cols.append(F.lit(DEFAULTS[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(cols)


def append_rows(df: DataFrame, root: str, table: str, now: dt.datetime) -> None:
    """INSERT with a column list: defaults filled, rows appended to ``<root>/<table>``."""
    with_defaults(df, S.OP_SCHEMAS[table], now).write.mode("append").parquet(f"{root.rstrip('/')}/{table}")


def write_op(op: OpTables, root: str, mode: str = "overwrite") -> None:
    for name, df in [("branch", op.branch), ("customer", op.customer), ("product", op.product),
                     ("sale", op.sale), ("sale_item", op.sale_item)]:
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
