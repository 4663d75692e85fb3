"""Staged items in buckets of their sale, and joins hashed by size."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import validate
from tillhouse.session import HASH_JOIN, sized_hash_joins
from tillhouse.sources import testdata
from tillhouse.sources.store import persist_op

SF001 = "/root/testdata/sf0.001"


@pytest.fixture()
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_are_grouped_where_they_lie(spark, sf001_op, shuffled):
    op = persist_op(testdata.op_tables(spark, SF001, item_buckets=8), 8)
    assert op.sale_item.schema == sf001_op.sale_item.schema
    assert op.sale_item.exceptAll(sf001_op.sale_item).count() == 0 == sf001_op.sale_item.exceptAll(op.sale_item).count()
    files = [f.removeprefix("file:") for f in op.sale_item.inputFiles()]
    assert len(files) == 8, "the rows lay in their buckets before they were written"
    assert glob.glob(os.path.dirname(files[0]) + "/part-*"), "the files stay"
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("sale_item")], "no catalog entry is left behind"
    per_sale, plain = validate.op_sales_frame(op), validate.op_sales_frame(sf001_op)
    assert plan(per_sale).count("Exchange hashpartitioning(sale_id") == 1, "only the sales are dealt out"
    assert plan(plain).count("Exchange hashpartitioning(sale_id") == 2
    assert per_sale.exceptAll(plain).count() == 0 == plain.exceptAll(per_sale).count()


def test_lines_of_unknown_parts_count_for_positions(spark):
    t = {name: testdata.read_table(spark, SF001, name) for name in ("lineitem", "part", "orders")}
    known = t["part"].where("p_partkey % 5 <> 0")
    want = testdata.sale_items(t["lineitem"], t["part"], t["orders"]).where("product_id % 5 <> 0")
    for buckets in (None, 8):
        got = testdata.sale_items(t["lineitem"], known, t["orders"], buckets)
        assert got.count() > 0 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_joins_are_hashed_by_size(spark, shuffled):
    a, b = (spark.range(5000).select((F.col("id") * k).alias("id")) for k in (2, 3))

    def joined():
        df = a.join(b, "id")
        assert len(df.collect()) == 1667
        return plan(df)

    before = spark.conf.get(HASH_JOIN)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    try:
        assert "SortMergeJoin" in joined()
        with sized_hash_joins(spark):
            assert "ShuffledHashJoin" in joined()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert spark.conf.get(HASH_JOIN) == before
