"""tillhouse — a retail sales warehouse written as Spark DataFrame jobs.

Operational tables (branch, customer, product, sale, sale_item) are loaded
incrementally and idempotently into a star schema (date, branch, product and
customer dimensions plus a fact at sale-item grain).  KPI views, report
datasets, a reconciliation suite and data-quality rules run on top of it.

Every transform is a ``DataFrame -> DataFrame`` function; Catalyst and AQE
choose the physical plan.
"""

from tillhouse.model import DwTables, OpTables

__all__ = ["DwTables", "OpTables"]
