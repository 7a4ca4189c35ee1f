"""Payment-method shares and payment checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.functions.amounts import RETURNS, or_zero
from shopledger.functions.ratios import percent
from shopledger.operators.keyfilter import may_match
from shopledger.operators.ranking import largest_first, smallest_first
from shopledger.operators.scope import of_scoped_invoices, scoped_invoices, settled, takes
from shopledger.operators.stores import in_regions, store_ids, with_store
from shopledger.operators.totals import with_totals
from shopledger.params import ReportParams
from shopledger.plans.views import with_display
from shopledger.sources.tables import Tables

_METHOD = ("payment_method_type", "payment_method_id", "sub_payment_method_id")


def _cash() -> Column:
    return F.col("payment_method_type") == "CASH"


def _paid(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("transaction_status") == "PAID")


def _payments_of(t: Tables, p: ReportParams) -> DataFrame:
    """Payments that may belong to the invoices in the scope and period.

    A layout tells them by their directories. On plain files a scope is selective as a rule, so
    payments that cannot meet its invoices are dropped right above the scan and are not
    exchanged. Neither groups payments, so an invoice with very many of them is still summed
    map-side. Without a scope every payment is needed, or may be.
    """
    payments = of_scoped_invoices(t.payments, p)
    if payments is not t.payments or not any((p.company_ids, p.tenant_ids, p.legal_entity_ids, p.store_ids, p.allowed_company_ids is not None)):
        return payments
    ids = scoped_invoices(t.invoices, p).select(F.col("id").alias("sales_invoice_header_id"))
    return may_match(payments, ["sales_invoice_header_id"], ids)


def _for_invoices(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    header = invoices.select(F.col("id").alias("sales_invoice_header_id"), "invoice_type", "change_amount")
    return header.join(payments, "sales_invoice_header_id")


def _share(t: Tables, effective: DataFrame) -> DataFrame:
    """Amount and percentage per displayed method from rows with an ``amount``.

    Rows are summed per method id first, so the lookups meet a few rows and not the
    payments, most of which share a NULL sub-method.
    """
    per_method = effective.groupBy(*_METHOD).agg(F.sum("amount").alias("amount"))
    shown = with_display(per_method, t.payment_methods, t.sub_payment_methods)
    per_name = shown.groupBy("name", "image").agg(F.sum("amount").alias("amount"))
    return (
        with_totals(per_name, {"_all": "amount"})
        .select("name", "image", "amount", percent(F.col("amount"), F.col("_all")).alias("percentage"))
        .orderBy(largest_first("amount"), smallest_first("name"), smallest_first("image"))
    )


def _less_change(amount: Column) -> Column:
    return amount - or_zero(F.col("change_amount"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def share_per_group(t: Tables, p: ReportParams) -> DataFrame:
    """Change comes off once per invoice and cash method, after its payments are added up."""
    grouped = _paid(_payments_of(t, p)).groupBy("sales_invoice_header_id", *_METHOD).agg(F.sum("amount").alias("paid"))
    invoices = with_store(settled(scoped_invoices(t.invoices, p)), store_ids(t.stores, p))
    amount = F.when(_cash(), _less_change(F.col("paid"))).otherwise(F.col("paid"))
    return _share(t, _for_invoices(invoices, grouped).select(*_METHOD, amount.alias("amount")))


@takes("legal_entity_ids", "store_ids", "region_ids")
def share_every_cash_row(t: Tables, p: ReportParams, *, settled_only: bool) -> DataFrame:
    """Change comes off every cash payment (the first view version, and its raw form)."""
    invoices = in_regions(scoped_invoices(t.invoices, p), t.stores, p)
    if settled_only:
        invoices = settled(invoices)
    amount = F.when(_cash(), _less_change(F.col("amount"))).otherwise(F.col("amount"))
    payments = _paid(_payments_of(t, p))
    return _share(t, _for_invoices(invoices, payments).select(*_METHOD, amount.alias("amount")))


@takes("legal_entity_ids", "store_ids", "region_ids")
def share_first_cash_row(t: Tables, p: ReportParams, *, negative_returns: bool) -> DataFrame:
    """Change comes off the invoice's first cash payment, if that one was paid.

    "First" is over payments of every status. Payments are reduced to one row per
    invoice and method before anything else, so an invoice with very many payments
    is merged map-side; the window then sees one row per method of an invoice.
    """
    paid = F.col("transaction_status") == "PAID"
    per_method = _payments_of(t, p).groupBy("sales_invoice_header_id", *_METHOD).agg(
        F.sum(F.when(paid, F.col("amount"))).alias("paid"),
        F.sum(F.when(paid, F.abs(F.col("amount")))).alias("paid_size"),
        F.count(F.when(paid, F.lit(1))).alias("paid_rows"),
        F.min(F.when(_cash(), F.col("id"))).alias("first_cash"),
        F.min(F.when(_cash() & paid & F.col("amount").isNotNull(), F.col("id"))).alias("first_paid_cash"),
    )
    of_invoice = Window.partitionBy("sales_invoice_header_id")
    invoices = in_regions(scoped_invoices(t.invoices, p), t.stores, p)
    ranked = _for_invoices(invoices, per_method).withColumn(
        "invoice_first_cash", F.min("first_cash").over(of_invoice)
    )
    amount = F.when(
        F.col("first_paid_cash") == F.col("invoice_first_cash"), _less_change(F.col("paid"))
    ).otherwise(F.col("paid"))
    if negative_returns:
        amount = F.when(F.col("invoice_type") == RETURNS, -F.col("paid_size")).otherwise(amount)
    return _share(t, ranked.where(F.col("paid_rows") > 0).select(*_METHOD, amount.alias("amount")))


def mismatches(invoices: DataFrame, payments: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
    """``gap, change_amount`` of the invoices whose amount with tax differs from their payments by more than a cent.

    An unknown tax makes the difference unknown, and the invoice is left out.
    """
    paid = _paid(payments).groupBy(F.col("sales_invoice_header_id").alias("id")).agg(F.sum("amount").alias("paid"))
    gap = F.col("net_amount") + F.col("tax") - F.col("paid")
    compared = invoices.join(paid, "id").select(gap.alias("gap"), "change_amount", *also)
    return compared.where(F.abs(F.col("gap")) > F.lit("0.01").cast("decimal(3,2)"))


def reconciliation(t: Tables) -> DataFrame:
    """How many invoices differ from their payments, and by how much."""
    return mismatches(t.invoices, t.payments).agg(
        F.count(F.lit(1)).alias("total_mismatches"),
        F.sum("gap").alias("total_gap_amount"),
        F.sum("change_amount").alias("total_change_given"),
    )


def _collected(t: Tables, p: ReportParams) -> DataFrame:
    return _for_invoices(scoped_invoices(t.invoices, p), _paid(_payments_of(t, p)))


@takes("legal_entity_ids", "store_ids")
def net_cash(t: Tables, p: ReportParams) -> DataFrame:
    """Cash less change. Equal change amounts count once: that is the report's rule."""
    total = F.sum("amount") - F.sum_distinct("change_amount")
    return _collected(t, p).where(_cash()).agg(total.alias("total_cash_collected"))


@takes("legal_entity_ids", "store_ids")
def collection_breakdown(t: Tables, p: ReportParams) -> DataFrame:
    method, amount = F.col("payment_method_type"), F.col("amount")

    def part(condition: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(F.lit(0)))

    change = F.sum_distinct("change_amount")
    return _collected(t, p).agg(
        (part(_cash()) - change).alias("net_cash_amount"),
        part(method == "CARD").alias("card_amount"),
        part(~method.isin("CASH", "CARD")).alias("other_amount"),
        (F.sum("amount") - change).alias("total_collected"),
    )
