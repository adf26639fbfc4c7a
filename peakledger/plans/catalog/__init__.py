"""The registered queries: name -> (Spark query, equivalent SQL). One module per area."""

from __future__ import annotations

from peakledger.plans.catalog.base import ORACLE, QUERIES  # noqa: F401
from peakledger.plans.catalog import backtest, files, metrics, parsing, quality, signals, tables  # noqa: F401
