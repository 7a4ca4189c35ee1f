"""Sales per product and per product category.

Invoice lines are summed per product right after they meet their invoices, and the
product table joins that sum. A product that holds a large part of all lines is
merged map-side, and the product table never meets the lines, however large it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import is_sale_or_return, signed
from shopledger.operators.ranking import largest_first, smallest_first, top
from shopledger.operators.scope import of_scoped_invoices, scoped_invoices, settled, takes
from shopledger.operators.stores import in_regions, store_ids, with_store
from shopledger.operators.totals import top_with_totals
from shopledger.params import ReportParams
from shopledger.sources.tables import Tables


def _per_product(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Sums per product over the sales and returns among ``invoices``.

    ``line_amount`` signs the line's amount, ``header_amount`` repeats the invoice's
    on each of its lines, ``moved`` counts returned pieces off, ``pieces`` does not.
    """
    sold = invoices.where(is_sale_or_return()).select(
        F.col("id").alias("invoice_id"), "invoice_type", F.col("net_amount").alias("header_net")
    )
    return (
        sold.join(lines, "invoice_id")
        .groupBy("product_id")
        .agg(
            F.sum(signed(F.col("net_amount"))).alias("line_amount"),
            F.sum(signed(F.col("header_net"))).alias("header_amount"),
            F.sum(signed(F.col("quantity"), F.col("return_quantity"))).alias("moved"),
            F.sum("quantity").alias("pieces"),
        )
    )


def _per_category(t: Tables, per_product: DataFrame, amount: str) -> DataFrame:
    standard = t.products.where(F.col("product_classification") == "STANDARD_PRODUCT").select(
        F.col("id").alias("product_id"), F.col("product_category_id").alias("id")
    )
    per_id = (
        per_product.join(standard, "product_id")
        .groupBy("id")
        .agg(F.sum(amount).alias("amount"), F.sum("moved").alias("qty"))
    )
    return per_id.join(t.categories, "id")


@takes("store_ids", "region_ids")
def category_header_amounts(t: Tables, p: ReportParams) -> DataFrame:
    """Invoice amount counted once per line, over invoices of known stores."""
    invoices = with_store(settled(scoped_invoices(t.invoices, p, legal_entity=False)), store_ids(t.stores, p))
    return (
        _per_category(t, _per_product(invoices, of_scoped_invoices(t.lines, p)), "header_amount")
        .select(
            "id",
            "name",
            F.col("alt_name").alias("altName"),
            F.round("amount", 2).cast("double").alias("amount"),
            "qty",
        )
        .orderBy(largest_first("qty"), smallest_first("id"))
    )


@takes("store_ids", "region_ids")
def top_categories(t: Tables, p: ReportParams, k: int = 5) -> DataFrame:
    """Line amounts of the best-selling categories beside the totals over all."""
    invoices = in_regions(settled(scoped_invoices(t.invoices, p, legal_entity=False)), t.stores, p)
    rows = _per_category(t, _per_product(invoices, of_scoped_invoices(t.lines, p)), "line_amount")
    ranked = top_with_totals(
        rows,
        k,
        [largest_first("qty"), smallest_first("id")],
        {"totalQty": "qty", "totalAmount": "amount"},
    )
    return ranked.select(
        "id",
        "name",
        F.col("alt_name").alias("altname"),
        F.round("amount", 2).cast("double").alias("amount"),
        "qty",
        "totalQty",
        "totalAmount",
    )


@takes("legal_entity_ids", "store_ids", "region_ids")
def top_products(t: Tables, p: ReportParams, classification: str, k: int = 5) -> DataFrame:
    """Best products of one classification by signed amount; returned pieces still add up."""
    invoices = in_regions(settled(scoped_invoices(t.invoices, p)), t.stores, p)
    wanted = t.products.where(F.col("product_classification") == classification).select(
        F.col("id").alias("product_id"),
        F.col("short_name").alias("name"),
        F.col("alt_short_name").alias("altName"),
        "code",
        F.col("image").alias("productImage"),
        F.col("hex_code").alias("productHexCode"),
    )
    rows = (
        _per_product(invoices, of_scoped_invoices(t.lines, p))
        .join(wanted, "product_id")
        .select(
            F.col("product_id").alias("id"),
            *wanted.columns[1:],
            F.round("line_amount", 2).cast("double").alias("amount"),
            F.col("pieces").alias("qty"),
        )
    )
    return top(rows, k, largest_first("amount"), smallest_first("id"))
