"""Stored rule counts of the fact, kept up by the difference between two versions of the warehouse.

Layout under the store's root::

    fact_rules/v=<N>/    (rule, sale_month, n_bad): one row without month for each rule (the key rule's
                         count, else 0), and one for each month with violations

``refresh`` looks only at what a load changed:

* NOT NULL and CHECK rules are counted per month; a month whose folder is the
  same as before keeps its counts.
* References are counted per month too.  A kept month is counted again if it
  had orphans (the dimension may know them by now), or if it holds a key that
  the dimension has lost; the latter are looked for only if any key is gone.
* The key rule is not a sum over months: an item may stand in a new folder and
  in a kept one.  Only ids that new and replaced folders hold in different
  numbers can change the count.  The item locator (id ranges and Bloom blocks)
  names the kept folders that may hold such ids, a join confirms them, and the
  count moves by the ids repeated now less those repeated before.

The counts equal those of ``operators.quality`` over the whole fact (item ids
are not null, by the table's own rule).
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.model import DwTables, empty, literal_rows
from tillhouse.operators import quality
from tillhouse.sources.store import FACT, WarehouseStore, parquet_stage

UNIQUE = "unique item_id"
STATE = T.StructType([
    T.StructField("rule", T.StringType(), False), T.StructField("sale_month", T.IntegerType(), True),
    T.StructField("n_bad", T.LongType(), False),
])
Folder = tuple[int, int]        # (sale_month, fv)


def row_counts(fact: DataFrame) -> DataFrame:
    """Rows (rule, sale_month, n_bad) of the fact's NOT NULL and CHECK rules: one pass."""
    rules = quality.fact_row_rules(fact)
    bad = [F.count_if(F.coalesce(~ok, F.lit(True))).alias(name) for name, ok in rules.items()]
    return fact.groupBy("sale_month").agg(*bad).unpivot(["sale_month"], list(rules), "rule", "n_bad").select(
        "rule", "sale_month", F.col("n_bad").cast("long").alias("n_bad"))


def orphan_counts(fact: DataFrame, dw: DwTables, rules: list[str]) -> DataFrame:
    """Rows (rule, sale_month, n_bad) of the given references, months without orphans left out.

    All references are looked up together: their distinct keys meet the
    dimensions first, and the lost ones, of known size once written, say which
    fact rows are counted by month.  Without lost keys the fact is read once.
    """
    held = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(quality.FACT_REFERENCES[r][1]).cast("long").alias("k")) for r in rules])
    refs = fact.select("sale_month", F.explode(held).alias("h")).where("h.k is not null").select("sale_month", "h.rule", "h.k")
    known = reduce(DataFrame.unionByName, [getattr(dw, quality.FACT_REFERENCES[r][0]).select(
        F.lit(r).alias("rule"), F.col(quality.FACT_REFERENCES[r][1]).cast("long").alias("k")) for r in rules])
    lost = parquet_stage("lost-keys", refs.select("rule", "k").distinct().join(known, ["rule", "k"], "left_anti"))
    return refs.join(lost, ["rule", "k"], "left_semi").groupBy("rule", "sale_month").agg(F.count(F.lit(1)).alias("n_bad"))


class RuleStore:
    def __init__(self, store: WarehouseStore):
        self.store, self.root = store, store.root

    def _path(self, version: int) -> str:
        return f"{self.root}/fact_rules/v={version}"

    def _state(self, spark: SparkSession, version: int) -> dict[str, dict[int | None, int]]:
        """rule -> sale_month -> n_bad; bounded by rules x months."""
        out: dict[str, dict[int | None, int]] = {}
        for r in spark.read.schema(STATE).parquet(self._path(version)).collect():
            out.setdefault(r["rule"], {})[r["sale_month"]] = r["n_bad"]
        return out

    def _folders(self, spark: SparkSession, version: int | None) -> set[Folder]:
        return set() if version is None else {(r["sale_month"], r["fv"]) for r in self.store.manifest(spark, version).collect()}

    def _lost_months(self, spark: SparkSession, dw: DwTables, before: DwTables, rule: str, kept: list[Folder],
                     version: int, previous: int) -> set[int]:
        """Months among ``kept`` that hold a key which the rule's dimension no longer has."""
        table, key = quality.FACT_REFERENCES[rule]
        if table in self.store.dims:
            then, now = (self.store.dims[table].manifest(spark, v) for v in (previous, version))
            if then is not None and now is not None and then.entries == now.entries:
                return set()
        lost = getattr(before, table).select(key).join(getattr(dw, table).select(key), key, "left_anti")
        if lost.isEmpty():
            return set()
        rows = self.store._fact_from(spark, kept).select("sale_month", key).join(lost, key, "left_semi")
        return {r["sale_month"] for r in rows.select("sale_month").distinct().collect()}

    def _repeated(self, spark: SparkSession, written: list[Folder], gone: list[Folder], kept: list[Folder]) -> int:
        """By how much the number of repeated item ids grows when ``gone`` gives way to ``written`` beside ``kept``."""
        def held(folders: list[Folder], new: int, old: int) -> DataFrame:
            return self.store._fact_from(spark, folders).select("item_id", F.lit(new).alias("new"), F.lit(old).alias("old"))

        ids = held(written, 1, 0).unionByName(held(gone, 0, 1)).groupBy("item_id").agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
        if not kept:        # nothing to look up: counted as they are
            row = ids.agg(F.count_if(F.col("new") > 1).alias("now"), F.count_if(F.col("old") > 1).alias("then")).first()
            return row["now"] - row["then"]
        ids = parquet_stage("rule-ids", ids.where("new <> old"))
        asked = ids.select("item_id", F.lit(0).alias("sale_month"))
        folders = self.store.holding(asked, kept)
        beside = (self.store._fact_from(spark, folders).select("item_id").join(ids.select("item_id"), "item_id", "left_semi")
                  .groupBy("item_id").agg(F.count(F.lit(1)).alias("kept")))
        total = ids.join(beside, "item_id", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
        row = total.agg(F.count_if(F.col("new") + F.col("kept") > 1).alias("now"), F.count_if(F.col("old") + F.col("kept") > 1).alias("then")).first()
        return row["now"] - row["then"]

    def refresh(self, spark: SparkSession, version: int, previous: int | None = None) -> dict[str, list[int]]:
        """Bring the counts from version ``previous`` (refreshed before) to ``version``; returns the months counted per kind of rule."""
        dw = self.store.read(spark, version)
        now, then = self._folders(spark, version), self._folders(spark, previous)
        written, gone, kept = sorted(now - then), sorted(then - now), sorted(now & then)
        state = self._state(spark, previous) if previous is not None else {}
        months = {m for m, _ in kept}
        counts = {rule: {m: n for m, n in by_month.items() if m in months} for rule, by_month in state.items()}
        at = {m: (m, v) for m, v in now}

        for r in row_counts(self.store._fact_from(spark, written)).collect() if written else []:     # rules x months
            counts.setdefault(r["rule"], {})[r["sale_month"]] = r["n_bad"]

        recount: dict[str, set[int]] = {}
        before = self.store.read(spark, previous) if kept else None
        for rule in quality.FACT_REFERENCES:
            again = {m for m, n in counts.get(rule, {}).items() if n}
            if kept:
                again |= self._lost_months(spark, dw, before, rule, kept, version, previous)
            recount[rule] = again | {m for m, _ in written}
        for rule, again in recount.items():
            counts.setdefault(rule, {}).update(dict.fromkeys(again, 0))
        if any(recount.values()):
            part = self.store._fact_from(spark, [at[m] for m in sorted(set().union(*recount.values()))])
            for r in orphan_counts(part, dw, list(recount)).collect():      # rules x months
                counts[r["rule"]][r["sale_month"]] = r["n_bad"]

        repeated = state.get(UNIQUE, {}).get(None, 0)
        if written or gone:
            repeated += self._repeated(spark, written, gone, kept)
        counts[UNIQUE] = {None: repeated}
        rules = [*quality.fact_row_rules(empty(spark, dw.fact_sale_item.schema)), *quality.FACT_REFERENCES, UNIQUE]
        rows = [(rule, m, n) for rule in rules for m, n in ({None: 0} | counts.get(rule, {})).items() if n or m is None]
        literal_rows(spark, rows, STATE).coalesce(1).write.mode("overwrite").parquet(self._path(version))
        return {"rows": [m for m, _ in written], "references": sorted(set().union(*recount.values())) if recount else [],
                "keys": sorted({m for m, _ in written + gone})}

    def counts(self, spark: SparkSession, version: int) -> DataFrame:
        """(table, rule, n_bad) of a version, without reading the fact."""
        try:
            rows = spark.read.schema(STATE).parquet(self._path(version))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                raise ValueError(f"no rule counts of version {version}: refresh it first") from e
            raise
        return rows.groupBy("rule").agg(F.sum("n_bad").alias("n_bad")).select(F.lit(FACT).alias("table"), "rule", "n_bad")
