"""Customer counts and sales per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import is_sale_or_return, signed
from shopledger.functions.calendar import within
from shopledger.functions.flags import full_name, known_live
from shopledger.functions.ratios import rate_or_zero
from shopledger.operators.ranking import largest_first, smallest_first, top
from shopledger.operators.scope import all_of, among, companies_of, company_scope, in_periods, keep_ids, scoped_invoices, settled, takes
from shopledger.operators.stores import store_ids, with_store
from shopledger.operators.totals import top_with_totals
from shopledger.params import ReportParams
from shopledger.sources.tables import Tables


# --- counts -----------------------------------------------------------------------


def _buyers(invoices: DataFrame) -> DataFrame:
    """Distinct customers with a settled invoice; repeated ones merge before the shuffle."""
    return settled(invoices).where(F.col("customer_id").isNotNull()).select(F.col("customer_id").alias("id")).distinct()


def _scoped_buyers(t: Tables, p: ReportParams) -> DataFrame:
    """Buyers under the invoice's company and tenant."""
    return _buyers(in_periods(company_scope(t.invoices, p), "invoice_date_time", p.period))


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


class _Marks:
    """Conditions on a customer row."""

    def __init__(self, p: ReportParams):
        self.in_scope = all_of([companies_of(p), among("tenant_id", p.tenant_ids)])
        self.live = known_live(F.col("is_deleted"))
        self.is_new = within(F.col("customer_created_on"), p.period)
        self.bought = F.coalesce(F.col("_bought"), F.lit(False))


def _marked(t: Tables, buyers: DataFrame) -> DataFrame:
    """All customers, those in ``buyers`` marked. Both sides are unique per customer."""
    return t.customers.join(buyers.withColumn("_bought", F.lit(True)), "id", "left")


@takes()
def conversion(t: Tables, p: ReportParams) -> DataFrame:
    """Total, active, new and converted customers and the conversion rate.

    Active customers are judged by the invoice's company, converted ones by the
    customer's too; deletion counts for total and new only.
    """
    m = _Marks(p)
    counts = _marked(t, _scoped_buyers(t, p)).agg(
        _count_if(m.in_scope & m.live).alias("total_customer"),
        _count_if(m.bought).alias("active_customer"),
        _count_if(m.in_scope & m.live & m.is_new).alias("new_customer"),
        _count_if(m.bought & m.in_scope & m.is_new).alias("converted_customer"),
    )
    return counts.select(
        "*",
        F.col("new_customer").alias("total_visitors"),
        rate_or_zero(F.col("converted_customer"), F.col("new_customer")).alias("conversion_rate"),
    )


@takes()
def base_counts(t: Tables, p: ReportParams) -> DataFrame:
    m = _Marks(p)
    return company_scope(t.customers, p).agg(
        _count_if(m.live).alias("totalCustomer"),
        _count_if(m.live & m.is_new).alias("newCustomer"),
    )


@takes()
def activity_counts(t: Tables, p: ReportParams) -> DataFrame:
    """Active and converted customers; the invoice's company decides for both."""
    m = _Marks(p)
    return t.customers.join(_scoped_buyers(t, p), "id", "left_semi").agg(
        F.count(F.lit(1)).alias("activeCustomer"),
        _count_if(m.is_new).alias("convertedCustomer"),
    )


@takes()
def counts_from_activity(t: Tables, p: ReportParams) -> DataFrame:
    """The four counts over the customer activity view, in the customer's own scope.

    The view has a row per invoice; here each customer is marked once as a buyer, so
    nothing is counted distinctly.
    """
    m = _Marks(p)
    buyers = _buyers(in_periods(t.invoices, "invoice_date_time", p.period))
    return _marked(t, buyers).where(m.in_scope).agg(
        _count_if(m.live).alias("totalCustomer"),
        _count_if(m.bought).alias("activeCustomer"),
        _count_if(m.live & m.is_new).alias("newCustomer"),
        _count_if(m.bought & m.is_new).alias("convertedCustomer"),
    )


@takes()
def counts_side_by_side(t: Tables, p: ReportParams) -> DataFrame:
    """Base counts in the customer's scope beside activity counts in the invoice's."""
    m = _Marks(p)
    return _marked(t, _scoped_buyers(t, p)).agg(
        _count_if(m.in_scope & m.live).alias("totalCustomer"),
        _count_if(m.in_scope & m.live & m.is_new).alias("newCustomer"),
        _count_if(m.bought).alias("activeCustomer"),
        _count_if(m.bought & m.is_new).alias("convertedCustomer"),
    )


# --- sales per customer -----------------------------------------------------------


def _sales_per_customer(t: Tables, p: ReportParams, invoices: DataFrame) -> DataFrame:
    """``id, amount``: summed before customers are attached, so no customer is hot later.

    Summed per customer and store first: the store list meets these sums, so that a store
    with very many invoices is merged before any shuffle.
    """
    per_store = (
        settled(invoices)
        .groupBy(F.col("customer_id").alias("id"), "store_id")
        .agg(F.sum(signed(F.col("net_amount"))).alias("amount"))
    )
    return with_store(per_store, store_ids(t.stores, p)).groupBy("id").agg(F.sum("amount").alias("amount"))


def _names(t: Tables) -> DataFrame:
    return t.customers.select("id", full_name(F.col("first_name"), F.col("last_name")).alias("name"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def all_sales(t: Tables, p: ReportParams) -> DataFrame:
    """Every customer with a sale or return, largest amount first."""
    invoices = scoped_invoices(t.invoices, p).where(is_sale_or_return())
    return (
        _sales_per_customer(t, p, invoices)
        .join(_names(t), "id")
        .select("id", "name", F.round("amount", 2).cast("double").alias("amount"))
        .orderBy(largest_first("amount"), smallest_first("id"))
    )


def _best(t: Tables, sales: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of ``sales`` with their names, beside the total of all."""
    order = [largest_first("amount"), smallest_first("id")]
    best = top_with_totals(sales, k, order, {"totalSum": "amount"})
    # At most k rows are broadcast; a limit sorts them without the sampling pass of a full sort.
    named = _names(t).join(F.broadcast(best), "id").select("id", "name", "amount", "totalSum")
    return top(named, k, *order)


@takes("legal_entity_ids", "store_ids", "region_ids", "customer_class_ids")
def top_sales(t: Tables, p: ReportParams, k: int = 5) -> DataFrame:
    """The best customers beside the total of all; other invoice types count as 0.

    Known customers are kept by a semi join on ids; names are fetched for ``k`` rows.
    """
    known = keep_ids(t.customers, "customer_class_id", p.customer_class_ids).select("id")
    sales = _sales_per_customer(t, p, scoped_invoices(t.invoices, p)).join(known, "id", "left_semi")
    return _best(t, sales, k)


@takes("legal_entity_ids", "store_ids", "region_ids")
def top_sales_inline(t: Tables, p: ReportParams, k: int = 5) -> DataFrame:
    """The same report without the customer view and its class filter."""
    sales = _sales_per_customer(t, p, scoped_invoices(t.invoices, p)).join(t.customers.select("id"), "id", "left_semi")
    return _best(t, sales, k)
