"""Every registered query: the report, its parameters, and (by key) its oracle."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger_checks import params as P
from shopledger_checks.fixtures import fixture_tables, source
from shopledger import ReportParams, Tables
from shopledger.functions.calendar import ntz
from shopledger.operators.ranking import preview
from shopledger.operators.upsert import insert_if_absent, insert_published, update_published, update_touch
from shopledger.plans import catalog, cities, customers, delivery, history, loyalty, payments, querylog, sales, views
from shopledger.sources.published import Published
from shopledger.sources.schemas import SCHEMAS

Report = Callable[[Tables, ReportParams], DataFrame]

# Key -> (report, parameters over the whole tables, narrower parameters for `<key>_scoped`).
REPORTS: dict[str, tuple[Report, ReportParams, ReportParams]] = {
    "sales_data_invoice_rows": (sales.invoice_rows, P.WHOLE, P.DEFAULT),
    "sales_data_kpis": (sales.kpis, P.WHOLE, P.DEFAULT),
    "sales_data_kpis_settled": (partial(sales.kpis, settled_only=True), P.WHOLE, P.STORE),
    "sales_data_kpis_region": (sales.kpis, P.WHOLE_REGION, P.REGION),
    "sales_data_kpis_avg": (sales.kpis_with_average, P.WHOLE, P.DEFAULT),
    "sales_data_kpis_avg_with_lost": (partial(sales.kpis_with_average, with_lost=True), P.WHOLE, P.SHIFTED),
    "sales_data_year_over_year": (sales.kpis_year_over_year, P.WHOLE, P.STORE),
    "sales_data_net_raw": (sales.net_totals, P.WHOLE, P.DEFAULT),
    "lost_sales_total": (sales.lost_total, P.WHOLE, P.DEFAULT),
    "gross_sales_total": (sales.gross_total, P.WHOLE, P.ONE_STORE),
    "gross_returns_net": (sales.gross_returns_net, P.WHOLE, P.ONE_STORE),
    "sales_graph_monthly": (sales.monthly_graph, P.WHOLE, P.REGION),
    "sales_graph_monthly_view": (sales.monthly_graph_signed, P.WHOLE, P.DEFAULT),
    "payment_share_preagg": (payments.share_per_group, P.WHOLE, P.DEFAULT),
    "payment_share_view_v1": (partial(payments.share_every_cash_row, settled_only=False), P.WHOLE, P.DEFAULT),
    "payment_share_view_v2": (partial(payments.share_first_cash_row, negative_returns=False), P.WHOLE, P.DEFAULT),
    "payment_share_view_v3": (partial(payments.share_first_cash_row, negative_returns=True), P.WHOLE, P.DEFAULT),
    "payment_share_view_v2_region": (
        partial(payments.share_first_cash_row, negative_returns=False),
        P.WHOLE_REGION,
        P.REGION,
    ),
    "payment_share_raw": (partial(payments.share_every_cash_row, settled_only=True), P.WHOLE, P.DEFAULT),
    "net_cash_collected": (payments.net_cash, P.WHOLE, P.ONE_STORE),
    "collection_breakdown": (payments.collection_breakdown, P.WHOLE, P.ONE_STORE),
    "customer_pie_exists": (loyalty.pie_by_earlier_invoice, P.SPLIT, P.DEFAULT),
    "customer_pie_exists_loose": (loyalty.pie_by_earlier_invoice_loose, P.SPLIT, P.DEFAULT),
    "customer_pie_first_date": (loyalty.pie_by_first_date, P.SPLIT, P.WIDE),
    "customer_counts_cte": (customers.conversion, P.SPLIT, P.TENANT),
    "customer_base_counts": (customers.base_counts, P.SPLIT, P.TENANT),
    "customer_activity_counts": (customers.activity_counts, P.SPLIT, P.TENANT),
    "customer_counts_activity_view": (customers.counts_from_activity, P.SPLIT, P.TENANT),
    "customer_counts_subqueries": (customers.counts_side_by_side, P.SPLIT, P.TENANT),
    "customer_sales_all": (customers.all_sales, P.WHOLE, P.DEFAULT),
    "customer_sales_top5": (customers.top_sales, P.WHOLE, P.CLASSES),
    "customer_sales_top5_raw": (customers.top_sales_inline, P.WHOLE, P.DEFAULT),
    "category_sales_header_amount": (catalog.category_header_amounts, P.WHOLE, P.TENANT),
    "category_sales_top5": (catalog.top_categories, P.WHOLE, P.TENANT),
    "category_sales_top5_region": (catalog.top_categories, P.WHOLE_REGION, P.TENANT_REGION),
    "top_products_standard_region": (
        partial(catalog.top_products, classification="STANDARD_PRODUCT"),
        P.WHOLE_REGION,
        P.REGION,
    ),
    "top_products_standard": (partial(catalog.top_products, classification="STANDARD_PRODUCT"), P.WHOLE, P.DEFAULT),
    "top_products_service": (partial(catalog.top_products, classification="SERVICE_PRODUCT"), P.WHOLE, P.DEFAULT),
    "avg_delivery_time_json": (delivery.delivery_time_document, P.SPLIT, P.DRIVER),
    "avg_delivery_time_hourly": (delivery.delivery_time_hourly, P.SPLIT, P.DRIVER),
    "financial_summary_json": (delivery.financial_document, P.WHOLE, P.DEFAULT),
    "financial_summary_weekday": (delivery.financial_weekdays, P.WHOLE, P.DEFAULT),
    "total_deliveries_weekday": (delivery.deliveries_per_weekday, P.SPLIT, P.REGION),
    "top_cities_monthly": (cities.monthly_rows, P.WHOLE, P.DEFAULT),
    "top_cities_monthly_json": (cities.monthly_document, P.WHOLE, P.DEFAULT),
    "top_cities_monthly_json_strict": (
        partial(cities.monthly_document, form=cities.Form(strict=True, empty_list=False)),
        P.WHOLE,
        P.DEFAULT,
    ),
    "top_cities_monthly_json_paid": (
        partial(cities.monthly_document, form=cities.Form(strict=True, settled_only=True)),
        P.WHOLE,
        P.DEFAULT,
    ),
}


# --- keyed writes over derived tables -----------------------------------------------


def _brand_flags(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    """The flag table after one flag per part brand was inserted."""
    brand = F.col("p_brand")
    per_brand = (
        source(spark, directory, "part")
        .select(
            (F.regexp_extract(brand, r"(\d+)$", 1).cast("int") + 100).alias("id"),
            brand.alias("feature_name"),
            F.lit(False).alias("enabled"),
            F.lit("from part").alias("description"),
        )
        .distinct()
    )
    return insert_if_absent(t["feature_flags"], per_brand, ["feature_name"])


def _enable_busy_brands(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    """Switch on the flags of brands whose parts are at least a sixth PROMO."""
    parts = source(spark, directory, "part").groupBy(F.col("p_brand").alias("feature_name"))
    promo = F.count(F.when(F.col("p_type") == "PROMO", 1))
    busy = parts.agg((promo * 6 >= F.count(F.lit(1))).alias("enabled")).where("enabled")
    flags = _brand_flags(t, spark, directory).withColumn("updated_at", ntz(P.CREATED))
    return update_touch(flags, busy, ["feature_name"], P.TOUCHED)


def _named_stores(t: Tables) -> DataFrame:
    """The stores that invoices name."""
    return t.invoices.select(F.col("store_id").alias("id"), F.lit("from invoices").alias("name")).distinct()


def _missing_stores(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    """Add the stores that invoices name and the store table lacks."""
    return insert_if_absent(t.stores, _named_stores(t), ["id"])


def _returns_per_customer(t: Tables) -> DataFrame:
    returns = t.invoices.where(F.col("invoice_type") == "RETURNS").groupBy(F.col("customer_id").alias("id"))
    return returns.agg(F.count(F.lit(1)).cast("int").alias("customer_class_id"))


def _reclass_buyers(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    """Set the class of every customer to their number of returns, where there is one."""
    customers_ = t.customers.withColumn("updated_at", ntz(P.CREATED))
    return update_touch(customers_, _returns_per_customer(t), ["id"], P.TOUCHED)


# --- the same writes, and history, through published tables --------------------------------


def _published(spark: SparkSession, schema: str, *partitions: str) -> Published:
    """A new table in the folder that driver and executors share; a temporary one on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="shopledger-")
    return Published(spark, f"{root.rstrip('/')}/{uuid.uuid4().hex}", schema, partitions)


def _publish_missing_stores(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    table = _published(spark, SCHEMAS["ent_stores"])
    table.replace(t.stores)
    insert_published(table, _named_stores(t), ["id"], job="stores of invoices")
    return table.read()


def _publish_reclassed_buyers(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    table = _published(spark, SCHEMAS["ent_customer"] + ", updated_at timestamp_ntz", "company_id", "tenant_id")
    table.replace(t.customers.withColumn("updated_at", ntz(P.CREATED)))
    update_published(table, _returns_per_customer(t), ["id"], P.TOUCHED, job="classes of buyers")
    return table.read()


def _pie_over_folded_history(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    """History folded in two steps, the later one first; the report reads it and its period."""
    table = _published(spark, history.FIRST_SCHEMA, "bucket")
    start = ntz(P.SPLIT.period.start)
    history.fold_first_purchases(table, t.invoices.where(F.col("invoice_date_time") >= start), job="period")
    history.fold_first_purchases(table, t.invoices.where(F.col("invoice_date_time") < start), job="before")
    return loyalty.pie_by_first_date(t, P.SPLIT, first=history.read_first(table))


def _reconciliation_by_month(t: Tables, spark: SparkSession, directory: str) -> DataFrame:
    table = _published(spark, history.MISMATCH_SCHEMA, "month_part")
    history.refresh_mismatches(table, t)
    return history.reconciliation_total(table.read())


WRITES = {
    "feature_flags_insert_if_absent": _brand_flags,
    "feature_flags_update_touch": _enable_busy_brands,
    "stores_insert_if_absent": _missing_stores,
    "customers_update_touch": _reclass_buyers,
    "stores_insert_published": _publish_missing_stores,
    "customers_update_published": _publish_reclassed_buyers,
    "customer_pie_folded_history": _pie_over_folded_history,
    "payment_reconciliation_monthly": _reconciliation_by_month,
}

UNSCOPED: dict[str, Callable[[Tables], DataFrame]] = {
    "payment_reconciliation": payments.reconciliation,
    "customer_invoice_first_date": loyalty.invoice_first_dates,
    "log_cache_hit": querylog.cache_hits,
    "log_temp_spill": querylog.temp_spill,
    "log_total_time": querylog.total_time,
    "log_io_wait": querylog.io_wait,
    "log_rows_per_call": querylog.rows_per_call,
    "log_db_cache": querylog.database_cache,
    "log_db_cache_one": lambda t: querylog.database_cache(t, P.DATABASE),
    "log_scan": querylog.statements,
    **views.VIEWS,
    **{f"preview_{name}": (lambda t, build=build: preview(build(t))) for name, build in views.VIEWS.items()},
    **{f"first_{name}": look for name, look in views.FIRST.items()},
}


def plain_numbers(frame: DataFrame) -> DataFrame:
    """Decimals as doubles: what both engines hand over alike. Reports themselves stay exact."""
    return frame.select(
        *[
            F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c)
            for c, kind in frame.dtypes
        ]
    )


_open: dict[tuple[str, int, str], tuple[SparkSession, Tables]] = {}


def tables_of(spark: SparkSession, directory: str) -> Tables:
    """The tables of a directory, opened once per session as an application would.

    Only plans are kept, no rows. The session is held too, so that its id stays its own.
    """
    key = (spark.sparkContext.applicationId, id(spark), directory)
    if key not in _open:
        _open[key] = (spark, fixture_tables(spark, directory))
    return _open[key][1]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    def add(key: str, build: Callable[[Tables, SparkSession, str], DataFrame]) -> None:
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return plain_numbers(build(tables_of(spark, directory), spark, directory))

        found[key] = run

    for key, (report, whole, narrow) in REPORTS.items():
        add(key, lambda t, s, d, report=report, p=whole: report(t, p))
        add(f"{key}_scoped", lambda t, s, d, report=report, p=narrow: report(t, p))
    for key, plan in UNSCOPED.items():
        add(key, lambda t, s, d, plan=plan: plan(t))
    for key, write in WRITES.items():
        add(key, write)
    return found
