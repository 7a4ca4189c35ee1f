"""The shared derived tables.

Each takes base frames and returns a frame; a caller that has a scope or a period
filters the base frame first. ``keep`` names further columns of the base rows that come last.
``register`` publishes them as temporary views.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.functions.amounts import (
    RETURNS,
    SALES,
    is_sale_or_return,
    only_on,
    or_zero,
    signed,
    with_tax,
)
from shopledger.functions.calendar import month_start
from shopledger.functions.flags import full_name
from shopledger.operators.ranking import PLACE, first_rows
from shopledger.operators.stores import store_ids, with_store
from shopledger.sources.tables import Tables

SCOPE_COLUMNS = ("company_id", "tenant_id", "legal_entity_id", "store_id")
LOST = "LOST_SALES"


def _no_money() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _net() -> Column:
    return F.col("net_amount")


# --- invoice header only ------------------------------------------------------


def monthly_sales(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        *SCOPE_COLUMNS,
        "customer_id",
        "invoice_date_time",
        month_start(F.col("invoice_date_time")).alias("month_date"),
        only_on(SALES, _net()).alias("raw_sales"),
        only_on(RETURNS, _net()).alias("raw_returns"),
        signed(_net()).alias("net_amount"),
    )


def invoice_amounts(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        F.col("id").alias("invoice_id"),
        "invoice_type",
        "store_id",
        "company_id",
        "tenant_id",
        "legal_entity_id",
        "customer_id",
        "invoice_date_time",
        "payment_status",
        "net_amount",
        signed(_net()).alias("effective_net_amount"),
        or_zero(F.col("tax")).alias("tax_amount"),
        or_zero(F.col("total_discount")).alias("discount_amount"),
        signed(F.col("total_discount")).alias("effective_discount"),
    )


def lost_sales(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_type") == LOST).select(
        F.col("net_amount").alias("lost_sale_amount"),
        F.col("order_date_time").alias("event_date"),
        *SCOPE_COLUMNS,
    )


def sales_summary(invoices: DataFrame) -> DataFrame:
    """Amounts with tax, so that they can be reconciled with payments."""
    return invoices.select(
        *SCOPE_COLUMNS,
        "customer_id",
        F.col("invoice_date_time").alias("event_date"),
        "payment_status",
        only_on(SALES, with_tax()).alias("sale_amount"),
        only_on(RETURNS, with_tax()).alias("return_amount"),
        signed(with_tax()).alias("net_amount"),
        signed(F.col("total_discount")).alias("net_discount"),
        signed(F.col("tax")).alias("net_tax"),
        F.when(F.col("invoice_type") == SALES, F.col("id")).alias("sale_order_id"),
    )


def master(invoices: DataFrame) -> DataFrame:
    return sales_summary(invoices).withColumn("lost_sale_amount", _no_money())


def master_with_lost(invoices: DataFrame, orders: DataFrame) -> DataFrame:
    """The summary rows followed by one row per lost order."""
    sales = master(invoices)
    lost = lost_sales(orders)
    padding = {
        "customer_id": F.lit(None).cast("bigint"),
        "payment_status": F.lit("PAID"),
        "sale_order_id": F.lit(None).cast("bigint"),
        **{c: _no_money() for c in ("sale_amount", "return_amount", "net_amount", "net_discount", "net_tax")},
    }
    return sales.unionByName(lost.withColumns(padding))


# --- invoice lines --------------------------------------------------------------


def _invoice_lines(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    sold = invoices.where(is_sale_or_return()).select(
        F.col("id").alias("invoice_id"),
        *SCOPE_COLUMNS,
        "customer_id",
        "invoice_date_time",
        "payment_status",
        "invoice_type",
    )
    return sold.join(lines, "invoice_id")


_LINE_SCOPE = ("store_id", "invoice_date_time", "company_id", "tenant_id", "legal_entity_id", "payment_status", "customer_id")


# The order in which the category and payment views list the invoice's columns.
_HEADER_ORDER = ("store_id", "customer_id", "invoice_date_time", "payment_status", "company_id", "tenant_id", "legal_entity_id")


def service_product_sales(invoices: DataFrame, lines: DataFrame, products: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per invoice line of a service product; returned quantities stay positive."""
    services = products.where(F.col("product_classification") == "SERVICE_PRODUCT").select(
        F.col("id").alias("product_id"),
        F.col("short_name").alias("name"),
        F.col("alt_short_name").alias("altName"),
        "code",
        F.col("image").alias("productImage"),
        F.col("hex_code").alias("productHexCode"),
    )
    return (
        _invoice_lines(invoices, lines)
        .join(services, "product_id")
        .select(*services.columns, *_LINE_SCOPE, signed(_net()).alias("net_amount"), "quantity", *keep)
    )


def category_sales(
    invoices: DataFrame, lines: DataFrame, products: DataFrame, categories: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per invoice line of a standard product; a return takes its returned quantity off."""
    standard = products.where(F.col("product_classification") == "STANDARD_PRODUCT").select(
        F.col("id").alias("product_id"), F.col("product_category_id").alias("category_id")
    )
    named = categories.select(
        F.col("id").alias("category_id"),
        F.col("name").alias("category_name"),
        F.col("alt_name").alias("category_alt_name"),
    )
    return (
        _invoice_lines(invoices, lines)
        .join(standard.join(named, "category_id"), "product_id")
        .select(
            *named.columns,
            *_HEADER_ORDER,
            signed(_net()).alias("net_amount"),
            signed(F.col("quantity"), F.col("return_quantity")).alias("quantity"),
            *keep,
        )
    )


# --- customers ------------------------------------------------------------------


def customer_sales(invoices: DataFrame, customers: DataFrame, stores: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per invoice with a known customer and store, of whatever invoice type."""
    people = customers.select(
        F.col("id").alias("customer_id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        "customer_class_id",
    )
    places = stores.select(F.col("id").alias("store_id"), "region_id")
    sold = invoices.select(
        "customer_id", *SCOPE_COLUMNS, "pos_id", "invoice_date_time", "payment_status", signed(_net()).alias("amount"), *keep
    )
    return (
        sold.join(places, "store_id")
        .join(people, "customer_id")
        .select(
            F.col("customer_id").alias("id"),
            "name",
            *SCOPE_COLUMNS,
            "pos_id",
            "invoice_date_time",
            "payment_status",
            "amount",
            "customer_class_id",
            "region_id",
            *keep,
        )
    )


def customer_loyalty(
    invoices: DataFrame, stores: DataFrame, history: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Every stored invoice with the customer's first invoice time over all companies.

    The first time comes from an aggregate joined back, not from a window: walk-in
    sales share one (NULL) customer, and a window would sort all of them in one
    task, while the aggregate combines them before the shuffle and the join can be
    split. Invoices without a customer share one first time (null-safe join). ``history``
    has the invoices that decide the first time, if ``invoices`` are not all.
    """
    sold = with_store(invoices, store_ids(stores)).select(
        "customer_id", *SCOPE_COLUMNS, "invoice_date_time", signed(_net()).alias("effective_amount"), *keep
    )
    past = sold if history is None else with_store(history, store_ids(stores))
    first = past.groupBy(F.col("customer_id").alias("_customer")).agg(
        F.min("invoice_date_time").alias("first_purchase_date")
    )
    return sold.join(first, F.col("customer_id").eqNullSafe(F.col("_customer"))).select(
        "customer_id", *SCOPE_COLUMNS, "invoice_date_time", "effective_amount", "first_purchase_date", *keep
    )


def customer_activity(customers: DataFrame, invoices: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every customer beside each of their invoices (one row of NULLs if there is none).

    Company and tenant are the customer's: customers without invoices count too. An
    inner join plus the customers it leaves out, because an outer join could not be
    split where one customer has very many invoices.
    """
    visits = invoices.select("customer_id", "invoice_date_time", "payment_status").where(F.col("customer_id").isNotNull())
    people = customers.select(
        F.col("id").alias("customer_id"), "is_deleted", "customer_created_on", "company_id", "tenant_id", *keep
    )
    idle = people.join(visits.select("customer_id").distinct(), "customer_id", "left_anti")
    return people.join(visits, "customer_id").unionByName(idle, allowMissingColumns=True)


# --- payments -------------------------------------------------------------------


def display_name(sub_name: Column) -> Column:
    """Sub-method for cards that have one, else the method; an unknown method reads CARD."""
    method = F.col("payment_method_type")
    return (
        F.when((method == "CARD") & sub_name.isNotNull(), sub_name).when(method != "CARD", method).otherwise(F.lit("CARD"))
    )


def display_image(sub_name: Column, sub_image: Column, method_image: Column) -> Column:
    method = F.col("payment_method_type")
    return (
        F.when((method == "CARD") & sub_name.isNotNull(), sub_image)
        .when(method != "CARD", method_image)
        .otherwise(F.lit(""))
    )


def with_display(frame: DataFrame, methods: DataFrame, sub_methods: DataFrame) -> DataFrame:
    """Add ``name`` and ``image`` by looking both method ids up."""
    subs = sub_methods.select(
        F.col("id").cast("bigint").alias("sub_payment_method_id"),
        F.col("name").alias("_sub_name"),
        F.col("image").alias("_sub_image"),
    )
    mains = methods.select(F.col("id").alias("payment_method_id"), F.col("image").alias("_image"))
    return (
        frame.join(subs, "sub_payment_method_id", "left")
        .join(mains, "payment_method_id", "left")
        .withColumn("name", display_name(F.col("_sub_name")))
        .withColumn("image", display_image(F.col("_sub_name"), F.col("_sub_image"), F.col("_image")))
    )


def payment_rows(
    invoices: DataFrame,
    payments: DataFrame,
    methods: DataFrame,
    sub_methods: DataFrame,
    version: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per payment with its effective amount.

    ``v1`` takes the change off every cash payment; ``v2`` off the first cash payment
    of the invoice, by payment id, whatever its status; ``v3`` is ``v2`` with every
    payment of a return counted as negative.

    The first cash payment is a minimum per invoice, put on the invoice and compared with
    each payment's id. Payments move once, to meet their invoices; that join stands between
    two exchanges, so an invoice with very many payments can be split.
    """
    cash = F.col("payment_method_type") == "CASH"
    sold = invoices.select(
        F.col("id").alias("sales_invoice_header_id"),
        "invoice_type",
        "change_amount",
        *SCOPE_COLUMNS,
        "customer_id",
        "invoice_date_time",
        "payment_status",
    )
    takes_change = cash
    if version != "v1":
        first_cash = payments.where(cash).groupBy("sales_invoice_header_id").agg(F.min("id").alias("_first_cash"))
        # A computed key: only between two exchanges of its own does the planner split a skewed join.
        same_id = F.col("sales_invoice_header_id").bitwiseOR(F.lit(0).cast("bigint"))
        sold = sold.join(first_cash, "sales_invoice_header_id", "left").withColumn("sales_invoice_header_id", same_id)
        takes_change = F.coalesce(F.col("payment_id") == F.col("_first_cash"), F.lit(False))
    after_change = F.when(takes_change, F.col("amount") - or_zero(F.col("change_amount"))).otherwise(F.col("amount"))
    if version == "v3":
        after_change = F.when(F.col("invoice_type") == RETURNS, -F.abs(F.col("amount"))).otherwise(after_change)
    joined = sold.join(payments.withColumnRenamed("id", "payment_id"), "sales_invoice_header_id")
    return with_display(joined, methods, sub_methods).select(
        "name",
        "image",
        after_change.alias("amount"),
        "store_id",
        "customer_id",
        "invoice_date_time",
        "company_id",
        "tenant_id",
        "legal_entity_id",
        "payment_status",
        "transaction_status",
        *keep,
    )


# --- registry -------------------------------------------------------------------


def _payments(version: str) -> Callable[[Tables], DataFrame]:
    return lambda t: payment_rows(t.invoices, t.payments, t.payment_methods, t.sub_payment_methods, version)


# View name -> frame, the summary before the master that is built on it.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "v_product_sales_enriched": lambda t: service_product_sales(t.invoices, t.lines, t.products),
    "view_sales_graph_analytics": lambda t: monthly_sales(t.invoices),
    "view_sales_invoice_analytics": lambda t: invoice_amounts(t.invoices),
    "view_dashboard_lost_sales": lambda t: lost_sales(t.orders),
    "view_sales_by_customer_rows": lambda t: customer_sales(t.invoices, t.customers, t.stores),
    "view_category_sales_rows": lambda t: category_sales(t.invoices, t.lines, t.products, t.categories),
    "view_customer_loyalty_analytics": lambda t: customer_loyalty(t.invoices, t.stores),
    "view_customer_activity_summary": lambda t: customer_activity(t.customers, t.invoices),
    "view_sales_by_payment_rows_v1": _payments("v1"),
    "view_sales_by_payment_rows_v2": _payments("v2"),
    "view_sales_by_payment_rows_v3": _payments("v3"),
    "view_dashboard_sales_summary": lambda t: sales_summary(t.invoices),
    "view_dashboard_master_analytics": lambda t: master(t.invoices),
    "view_dashboard_master_analytics_with_lost": lambda t: master_with_lost(t.invoices, t.orders),
}

_LINE = ("invoice_id", "product_id", "net_amount", "quantity", "return_quantity")


def _of_these(invoices: DataFrame, rows: DataFrame, customer: str) -> DataFrame:
    """The invoices of the customers of a few held rows; no customer counts as one."""
    wanted = F.broadcast(rows.select(F.col(customer).alias("_wanted")).distinct())
    return invoices.join(wanted, F.col("customer_id").eqNullSafe(F.col("_wanted")), "left_semi")


def _first_payments(version: str) -> Callable[[Tables], DataFrame]:
    # The smallest payment ids hold the first cash payment of each invoice of which they hold one.
    return lambda t: first_rows(
        t.payments,
        ("id",),
        lambda rows: payment_rows(t.invoices, rows, t.payment_methods, t.sub_payment_methods, version, keep=(PLACE,)),
    )


# A look at each view that joins: its first rows by the keys of the table whose rows it lists.
FIRST: dict[str, Callable[[Tables], DataFrame]] = {
    "v_product_sales_enriched": lambda t: first_rows(
        t.lines.select(*_LINE), _LINE, lambda rows: service_product_sales(t.invoices, rows, t.products, keep=(PLACE,))
    ),
    "view_category_sales_rows": lambda t: first_rows(
        t.lines.select(*_LINE), _LINE, lambda rows: category_sales(t.invoices, rows, t.products, t.categories, keep=(PLACE,))
    ),
    "view_sales_by_customer_rows": lambda t: first_rows(
        t.invoices, ("id",), lambda rows: customer_sales(rows, t.customers, t.stores, keep=(PLACE,))
    ),
    "view_customer_loyalty_analytics": lambda t: first_rows(
        t.invoices,
        ("id",),
        lambda rows: customer_loyalty(rows, t.stores, _of_these(t.invoices, rows, "customer_id"), keep=(PLACE,)),
    ),
    "view_customer_activity_summary": lambda t: first_rows(
        t.customers, ("id",), lambda rows: customer_activity(rows, _of_these(t.invoices, rows, "id"), keep=(PLACE,))
    ),
    "view_sales_by_payment_rows_v1": _first_payments("v1"),
    "view_sales_by_payment_rows_v2": _first_payments("v2"),
    "view_sales_by_payment_rows_v3": _first_payments("v3"),
}

# The name without a version stands for the definition in force.
CURRENT = {"view_sales_by_payment_rows": "view_sales_by_payment_rows_v2"}


def register(spark: SparkSession, tables: Tables) -> list[str]:
    """Create or replace every view as a temporary view; returns their names."""
    for name, build in VIEWS.items():
        build(tables).createOrReplaceTempView(name)
    for alias, name in CURRENT.items():
        VIEWS[name](tables).createOrReplaceTempView(alias)
    return [*VIEWS, *CURRENT]


def drop(spark: SparkSession) -> None:
    """Drop the views that exist, dependants first."""
    for name in reversed([*VIEWS, *CURRENT]):
        spark.catalog.dropTempView(name)
