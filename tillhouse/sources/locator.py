"""Item locator: which month folders of the fact may hold given item ids.

A load that brings back old sales must find the months where their items are
stored (an item moves when its sale date changes).  Per fact folder, that is
per (sale_month, fv), a load keeps

* a summary: number of items and at most RANGES id ranges, cut at the largest
  gaps between the ids;
* a blocked Bloom filter: an id's hash names one block of BLOCK_BITS bits and
  PROBES positions in it, BITS_PER_ITEM bits an item on average.

Folders are never rewritten, so neither are their summaries and filters: they
are written once, by the load that writes the folder.  Everything here is
built from Spark's bitmap aggregates and ordinary expressions.

A lookup meets each id with the ranges of each month by an equi-join on id
zones, tests the one block of the filter that would hold it, and so names the
folders worth reading.  It has no false negatives; a false positive (about
one id in a hundred) costs the reading of one column of one month.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.model import literal_rows

RANGES = 16             # id ranges kept per folder
CELLS = 256             # equal cells of a folder's id span that the ranges are made of
BLOCK_BITS = 32768      # bits of one bitmap (fixed by the bitmap functions)
BITS_PER_ITEM = 10
PROBES = 4
ZONES = 4096            # zones of the whole id span in a lookup

SUMMARY = T.StructType([
    T.StructField("sale_month", T.IntegerType(), False),
    T.StructField("fv", T.LongType(), False),
    T.StructField("n_items", T.LongType(), False),
    T.StructField("blocks", T.LongType(), False),
    T.StructField("ranges", T.ArrayType(T.StructType([
        T.StructField("lo", T.LongType(), False), T.StructField("hi", T.LongType(), False)]), False), False),
])
ENTRY = T.StructType(SUMMARY.fields[:2])
FILTER = T.StructType([
    T.StructField("sale_month", T.IntegerType(), False),
    T.StructField("fv", T.LongType(), False),
    T.StructField("block", T.LongType(), False),
    T.StructField("bits", T.BinaryType(), False),
])


def summaries(items: DataFrame) -> DataFrame:
    """From rows (sale_month, fv, item_id): one row (SUMMARY) per folder.

    Ids fall into CELLS equal cells of the folder's span; the ranges join
    neighbouring cells except across the RANGES - 1 widest gaps.  All windows
    run over at most CELLS rows of a folder.
    """
    folder = ["sale_month", "fv"]
    span = items.groupBy(*folder).agg(F.min("item_id").alias("first"), F.max("item_id").alias("last"))
    width = F.greatest(F.lit(1).cast("long"), F.floor((F.col("last") - F.col("first")) / CELLS) + 1)
    cell = F.floor((F.col("item_id") - F.col("first")) / width)
    cells = (items.join(F.broadcast(span), folder)      # one row per folder written by this load
             .groupBy(*folder, cell.alias("cell"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("lo"), F.max("item_id").alias("hi")))
    in_order = Window.partitionBy(*folder).orderBy("cell")
    cells = cells.withColumn("gap", F.col("lo") - F.lag("hi").over(in_order))
    widest = F.row_number().over(Window.partitionBy(*folder).orderBy(F.desc_nulls_last("gap"), "cell"))
    cells = cells.withColumn("cut", (F.col("gap").isNotNull() & (F.col("gap") > 1) & (widest < RANGES)).cast("int"))
    cells = cells.withColumn("part", F.sum("cut").over(in_order))
    parts = cells.groupBy(*folder, "part").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return parts.groupBy(*folder).agg(
        F.sum("n").alias("n_items"), F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges")).select(
        *folder, "n_items", _blocks(F.col("n_items")), "ranges")


def _block(item_id: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), item_id), blocks)


def _positions(item_id: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), item_id), F.lit(BLOCK_BITS).cast("long")) for k in range(PROBES)]


def _blocks(n_items: Column) -> Column:
    return F.ceil(n_items * BITS_PER_ITEM / BLOCK_BITS).cast("long").alias("blocks")


def filters(items: DataFrame) -> DataFrame:
    """From rows (sale_month, fv, item_id): the blocks (FILTER) of each folder's Bloom filter."""
    folders = items.groupBy("sale_month", "fv").agg(_blocks(F.count(F.lit(1))))
    sized = items.join(F.broadcast(folders), ["sale_month", "fv"])      # one row per folder written by this load
    at = [f"at{k}" for k in range(PROBES)]
    placed = sized.select("sale_month", "fv", _block(F.col("item_id"), F.col("blocks")).alias("block"),
                          *[c.alias(name) for name, c in zip(at, _positions(F.col("item_id")), strict=True)])
    # A bitmap per probe, united block by block: an item is one row of the (sorting) aggregate, not one per probe.
    of_probes = placed.groupBy("sale_month", "fv", "block").agg(*[F.bitmap_construct_agg(name).alias(name) for name in at])
    bits = of_probes.select("sale_month", "fv", "block", F.explode(F.array(*at)).alias("bits"))
    return bits.groupBy("sale_month", "fv", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(at, F.lit(8)).cast("int"))) != 0


def candidates(ids: DataFrame, summary: DataFrame, blocks: DataFrame) -> DataFrame:
    """From rows (item_id, sale_month): rows (item_id, sale_month, fv) of the *other* months that may hold the id.

    ``summary`` and ``blocks`` are those of the folders in question.  The id
    span is dealt into ZONES zones; a folder stands in the zones its ranges
    touch, so ids meet only folders near them, by an equi-join.
    """
    ranges = summary.select("sale_month", "fv", "blocks", F.explode("ranges").alias("r")).select(
        "sale_month", "fv", "blocks", "r.lo", "r.hi")
    span = summary.select(F.explode("ranges").alias("r")).agg(
        F.min("r.lo").alias("first"), F.max("r.hi").alias("last")).select(
        "first", (F.floor((F.col("last") - F.col("first")) / ZONES) + 1).cast("long").alias("width"))
    first, width = span.select("first").scalar(), span.select("width").scalar()

    def zone(of: Column) -> Column:
        return F.floor((of - first) / width)

    near = ranges.select("*", F.explode(F.sequence(zone(F.col("lo")), zone(F.col("hi")))).alias("zone"))
    asked = ids.select("item_id", F.col("sale_month").alias("own"), zone(F.col("item_id")).alias("zone"))
    met = (asked.join(near, "zone")
           .where(F.col("item_id").between(F.col("lo"), F.col("hi")) & (F.col("own") != F.col("sale_month")))
           .select("item_id", "sale_month", "fv", _block(F.col("item_id"), F.col("blocks")).alias("block")))
    held = met.join(blocks, ["sale_month", "fv", "block"])
    for at in _positions(F.col("item_id")):
        held = held.where(_is_set(F.col("bits"), at))
    return held.select("item_id", "sale_month", "fv")


class Locator:
    """The stored locator of a fact: ``fact_summary/v=N`` and ``fact_filter/v=N`` for the folders that load N wrote."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def write(self, items: DataFrame, version: int) -> None:
        """Summaries and filters of the folders of ``items`` (sale_month, fv, item_id), all written by load ``version``."""
        def summary() -> None:
            summaries(items).coalesce(1).write.mode("overwrite").parquet(self._path("fact_summary", version))

        def blocks() -> None:
            (filters(items).sortWithinPartitions("sale_month", "block")
             .write.mode("overwrite").option("compression", "zstd").parquet(self._path("fact_filter", version)))

        with ThreadPoolExecutor(2) as both:     # two jobs over the same files, side by side
            for job in [both.submit(summary), both.submit(blocks)]:
                job.result()

    def _read(self, spark: SparkSession, table: str, schema: T.StructType, entries: list[tuple[int, int]]) -> DataFrame:
        """Rows of the given (sale_month, fv) folders."""
        paths = [self._path(table, v) for v in sorted({v for _, v in entries})]
        keys = literal_rows(spark, entries, ENTRY)
        return spark.read.schema(schema).parquet(*paths).join(F.broadcast(keys), ["sale_month", "fv"], "left_semi")

    def summary(self, spark: SparkSession, entries: list[tuple[int, int]]) -> DataFrame:
        return self._read(spark, "fact_summary", SUMMARY, entries)

    def lookup(self, ids: DataFrame, entries: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The (sale_month, fv) folders among ``entries`` that may hold an id of ``ids`` (item_id, sale_month) from another month."""
        spark = ids.sparkSession
        found = candidates(ids, self.summary(spark, entries), self._read(spark, "fact_filter", FILTER, entries))
        return sorted((r["sale_month"], r["fv"]) for r in found.select("sale_month", "fv").distinct().collect())
