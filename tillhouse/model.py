"""Containers for the two table sets: operational (source) and warehouse."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast ``df`` to the column order and types of ``schema``."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def literal_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small frame of literal rows, built JVM-side (no Python workers).

    The rows are one JSON literal, so the plan does not grow with them.
    """
    if not rows:
        return empty(spark, schema)

    def text(v) -> str | None:
        if v is None or isinstance(v, str):
            return v
        if isinstance(v, bool):
            return "true" if v else "false"
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else str(v)

    names = [f.name for f in schema.fields]
    texts = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in names]))
    literal = json.dumps([dict(zip(names, map(text, row), strict=True)) for row in rows])
    read = spark.range(1).select(F.inline(F.from_json(F.lit(literal), texts)))
    return conform(read, schema)


def empty(spark: SparkSession, schema) -> DataFrame:
    """An empty frame of ``schema``, built JVM-side.

    Written as a filter that is always false, so the optimizer turns it into
    an empty relation and prunes joins and unions against it.
    """
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))


@dataclass(frozen=True)
class OpTables:
    """Operational (OLTP) tables."""

    branch: DataFrame
    customer: DataFrame
    product: DataFrame
    sale: DataFrame
    sale_item: DataFrame

    def conformed(self) -> "OpTables":
        return OpTables(**{f.name: conform(getattr(self, f.name), S.OP_SCHEMAS[f.name]) for f in fields(self)})

    def with_(self, **kw) -> "OpTables":
        return replace(self, **kw)


@dataclass(frozen=True)
class DwTables:
    """Warehouse tables: control row, four dimensions and the fact."""

    etl_control: DataFrame
    dim_date: DataFrame
    dim_branch: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    fact_sale_item: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> "DwTables":
        return DwTables(**{name: empty(spark, schema) for name, schema in S.DW_SCHEMAS.items()})

    def with_(self, **kw) -> "DwTables":
        return replace(self, **kw)

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
