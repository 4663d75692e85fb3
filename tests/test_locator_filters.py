"""The locator's filters are built with one row an item, not one a probe."""

from pyspark.sql import functions as F

from tillhouse.sources import locator


def test_filters_hold_every_probe(spark):
    items = spark.range(20000).select((F.col("id") % 3 + 199801).cast("int").alias("sale_month"), F.lit(1).cast("long").alias("fv"), F.col("id").alias("item_id"))
    made = locator.filters(items)
    sized = items.join(items.groupBy("sale_month", "fv").agg(locator._blocks(F.count("*"))), ["sale_month", "fv"])
    want = (sized.select("sale_month", "fv", locator._block(F.col("item_id"), F.col("blocks")).alias("block"),
                         F.explode(F.array(*locator._positions(F.col("item_id")))).alias("at"))
            .groupBy("sale_month", "fv", "block").agg(F.bitmap_construct_agg("at").alias("bits")))
    assert made.count() > 3 and made.exceptAll(want).count() == 0 == want.exceptAll(made).count()
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.index("bitmap_or_agg") < text.index("Generate") < text.rindex("bitmap_construct_agg"), "items are not multiplied by their probes"
