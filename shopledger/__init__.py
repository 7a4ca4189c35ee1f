"""Retail and delivery dashboard analytics as Spark DataFrame plans."""

from shopledger.params import Period, ReportParams
from shopledger.sources.tables import Tables

__all__ = ["Period", "ReportParams", "Tables"]
