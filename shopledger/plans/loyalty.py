"""New and existing customers among the buyers of a period.

The buyers come first: one aggregate over the invoices of the period, so customers (or
walk-in sales without a customer) that hold a large part of them are no burden. Then those
are looked for in the history. The history's rows of other customers are dropped right
above the scan; or the history is a table with one row per customer and store, kept up to
date month by month (``plans/history.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import signed
from shopledger.functions.calendar import ntz
from shopledger.operators.keyfilter import may_match
from shopledger.operators.ranking import largest_first
from shopledger.operators.scope import before, companies_of, company_scope, in_periods, scope, scoped_invoices, takes
from shopledger.operators.stores import store_ids, with_store
from shopledger.params import ReportParams
from shopledger.plans.views import customer_loyalty
from shopledger.sources.tables import Tables


def _label(existing: Column) -> Column:
    return F.when(existing, F.lit("Existing Customer")).otherwise(F.lit("New Customer"))


def _buyers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("customer_id").agg(F.sum(signed(F.col("net_amount"))).alias("sales"))


def _with_earlier(buyers: DataFrame, sold: DataFrame, earlier: DataFrame, keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Buyers with ``had_earlier``: a row of ``earlier`` has their keys; never for a NULL key.

    ``sold`` has the rows that the buyers were summed from, and may have more.
    """
    held = may_match(earlier.select(*keys), keys, sold).distinct()
    return buyers.join(held.withColumn("had_earlier", F.lit(True)), list(keys), "left")


def _labelled(buyers: DataFrame) -> DataFrame:
    existing = F.coalesce(F.col("had_earlier"), F.lit(False))
    return buyers.select("customer_id", "sales", _label(existing).alias("customertype"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def pie_by_earlier_invoice(t: Tables, p: ReportParams) -> DataFrame:
    """Existing if there is an earlier invoice in the same scope; never for a NULL customer."""
    stores = store_ids(t.stores, p)
    sold = scoped_invoices(t.invoices, p)
    earlier = with_store(before(scope(t.invoices, p), "invoice_date_time", p.period), stores)
    return _labelled(_with_earlier(_buyers(with_store(sold, stores)), sold, earlier)).select("customer_id", "customertype", "sales")


@takes("legal_entity_ids", "store_ids", "region_ids")
def pie_by_earlier_invoice_loose(t: Tables, p: ReportParams) -> DataFrame:
    """As above, but the earlier invoice need not have a store or the legal entity."""
    sold = scoped_invoices(t.invoices, p)
    earlier = before(company_scope(t.invoices, p), "invoice_date_time", p.period)
    return _labelled(_with_earlier(_buyers(with_store(sold, store_ids(t.stores, p))), sold, earlier))


@takes("region_ids")
def pie_by_first_date(t: Tables, p: ReportParams, first: DataFrame | None = None) -> DataFrame:
    """Existing if the customer's first invoice in any company or tenant is earlier.

    Invoices without a customer count as one customer here. Only company and period
    restrict the buyers; history is read over every scope. ``first`` is the history as
    one row per customer and store (``history.first_purchases``); without it the
    invoices before the period are read.
    """
    stores = store_ids(t.stores, p)
    sold = in_periods(t.invoices, "invoice_date_time", p.period).where(companies_of(p))
    if first is None:
        earlier = before(t.invoices, "invoice_date_time", p.period)
    else:
        earlier = first.where(F.col("first_purchase_date") < ntz(p.period.start))
    # The one customer that NULL stands for is a key like the others.
    nobody, somebody = F.col("customer_id").isNull().alias("_nobody"), F.coalesce("customer_id", F.lit(0).cast("bigint")).alias("_customer")
    buyers = _buyers(with_store(sold, stores)).withColumns({"_nobody": nobody, "_customer": somebody})
    found = _with_earlier(
        buyers, sold.select(nobody, somebody), with_store(earlier, stores).select(nobody, somebody), ("_nobody", "_customer")
    )
    return _labelled(found).orderBy(largest_first("customer_id"))


def invoice_first_dates(t: Tables) -> DataFrame:
    return customer_loyalty(t.invoices, t.stores)
