"""Ledger: usage-billing analytics as plain Spark DataFrame plans.

Layout
------
``sources``    schemas of the source and gold tables, readers, derived test views
``functions``  column expressions (price precedence, classification, money, dates)
``operators``  reusable plan pieces (temporal join, upsert)
``plans``      the pipelines: pricing, daily cost, VM cost, alerts, reports
"""

from ledger.params import RunParams

__all__ = ["RunParams"]
__version__ = "0.1.0"
