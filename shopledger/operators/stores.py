"""Attaching the store dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.operators.scope import keep_ids
from shopledger.params import ReportParams


def store_ids(stores: DataFrame, p: ReportParams | None = None, live: Column | None = None) -> DataFrame:
    """Ids of the stores in the wanted regions, optionally only the live ones."""
    if p is not None:
        stores = keep_ids(stores, "region_id", p.region_ids)
    if live is not None:
        stores = stores.where(live)
    return stores.select(F.col("id").alias("store_id"))


def in_regions(frame: DataFrame, stores: DataFrame, p: ReportParams) -> DataFrame:
    """Rows of stores in the wanted regions; every row when no region is asked for."""
    return with_store(frame, store_ids(stores, p)) if p.region_ids else frame


def with_store(frame: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose store is in ``ids``.

    A semi join: the dashboard joins stores only to drop rows without one. Reports
    that can, call this on a frame already summed per store, so a store with very
    many invoices reaches the join as a handful of rows. Spark broadcasts ``ids``
    when its size is below the session's limit and shuffles otherwise.
    """
    return frame.join(ids, "store_id", "left_semi")
