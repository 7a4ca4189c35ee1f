"""Facts that hold between reports, views and their naive forms."""

import pytest
from conftest import at
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopledger_checks import params as P
from shopledger_checks.registry import REPORTS
from shopledger.operators.scope import scoped_invoices, settled
from shopledger.operators.stores import store_ids, with_store
from shopledger.plans import cities, customers, delivery, payments, sales, views


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_kpis_equal_the_master_view_with_distinct_orders(small):
    for with_lost, name in ((False, "view_dashboard_master_analytics"), (True, "view_dashboard_master_analytics_with_lost")):
        naive = views.VIEWS[name](small).agg(
            F.sum("sale_amount"), F.sum("return_amount"), F.sum("net_amount"), F.sum("net_discount"), F.sum("net_tax"),
            F.count_distinct("sale_order_id"), F.count_distinct("store_id"), F.sum("lost_sale_amount"),
        )
        assert tuple(sales.kpis(small, P.WHOLE, with_lost=with_lost).first()) == tuple(naive.first())


def test_first_date_by_aggregate_equals_the_window(small):
    sold = with_store(small.invoices, store_ids(small.stores))
    window = F.min("invoice_date_time").over(Window.partitionBy("customer_id"))
    naive = sold.select("id", "customer_id", window.alias("first_purchase_date")).groupBy("customer_id", "first_purchase_date").count()
    ours = views.customer_loyalty(small.invoices, small.stores).groupBy("customer_id", "first_purchase_date").count()
    assert same_rows(ours, naive)


@pytest.mark.parametrize("version", ["v2", "v3"])
def test_payment_shares_equal_the_ranked_rows(small, version):
    rank = F.row_number().over(Window.partitionBy("sales_invoice_header_id", "payment_method_type").orderBy("pid"))
    joined = small.invoices.join(
        small.payments.withColumnRenamed("id", "pid"), F.col("id") == F.col("sales_invoice_header_id")
    ).withColumn("rn", rank)
    change = F.coalesce("change_amount", F.lit(0))
    amount = F.when((F.col("payment_method_type") == "CASH") & (F.col("rn") == 1), F.col("amount") - change).otherwise(F.col("amount"))
    if version == "v3":
        amount = F.when(F.col("invoice_type") == "RETURNS", -F.abs("amount")).otherwise(amount)
    naive = joined.where("transaction_status = 'PAID'").agg(F.sum(amount)).first()[0]
    report = payments.share_first_cash_row(small, P.WHOLE, negative_returns=version == "v3")
    assert report.agg(F.sum("amount")).first()[0] == naive
    view = views.VIEWS[f"view_sales_by_payment_rows_{version}"](small).where("transaction_status = 'PAID'")
    assert view.agg(F.sum("amount")).first()[0] == naive


def test_filter_below_the_ranking_equals_filter_above(small):
    above = views.payment_rows(small.invoices, small.payments, small.payment_methods, small.sub_payment_methods, "v2").where(
        "company_id = 1 and tenant_id = 1"
    )
    below = views.payment_rows(
        small.invoices.where("company_id = 1 and tenant_id = 1"), small.payments, small.payment_methods, small.sub_payment_methods, "v2"
    )
    assert same_rows(above, below)


def test_first_two_payment_versions_agree_without_repeated_cash(small):
    once = (
        small.payments.where("payment_method_type = 'CASH'").groupBy("sales_invoice_header_id").count().where("count > 1")
        .select(F.col("sales_invoice_header_id").alias("id"))
    )
    invoices = small.invoices.join(once, "id", "left_anti")
    v1, v2 = (views.payment_rows(invoices, small.payments, small.payment_methods, small.sub_payment_methods, v) for v in ("v1", "v2"))
    assert same_rows(v1, v2)


def test_months_add_up_to_the_net_amount(small):
    months = sales.monthly_graph_signed(small, P.WHOLE).agg(F.sum("totalSales")).first()[0]
    assert months == views.invoice_amounts(small.invoices).agg(F.sum("effective_net_amount")).first()[0]


def test_days_add_up_to_the_total(small):
    rows = delivery.deliveries_per_weekday(small, P.SPLIT).collect()
    assert {r.total_current for r in rows if r.daily_deliveries} == {sum(r.daily_deliveries for r in rows)}


def test_top_cities_are_at_most_five(small):
    assert 1 <= cities.monthly_rows(small, P.WHOLE).select("city_id").distinct().count() <= 5


def test_lost_orders_are_added_to_the_summary(small):
    lost = small.orders.where("order_type = 'LOST_SALES'").count()
    both = views.master_with_lost(small.invoices, small.orders)
    assert both.count() == small.invoices.count() + lost
    assert both.dtypes == views.master(small.invoices).dtypes


def test_customer_counts_side_by_side_are_the_two_halves(small):
    p = P.TENANT
    both = customers.counts_side_by_side(small, p).first()
    assert (both.totalCustomer, both.newCustomer) == tuple(customers.base_counts(small, p).first())
    assert (both.activeCustomer, both.convertedCustomer) == tuple(customers.activity_counts(small, p).first())


def test_top_customers_agree_in_both_forms(small):
    assert customers.top_sales(small, P.DEFAULT).collect() == customers.top_sales_inline(small, P.DEFAULT).collect()


def test_activity_view_counts_equal_the_report(small):
    p = P.TENANT
    view = views.VIEWS["view_customer_activity_summary"](small).where("company_id = 1 and tenant_id = 1")
    active = (
        F.col("invoice_date_time").between(F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1998-12-31 23:59:59").cast("timestamp_ntz"))
        & F.col("payment_status").isNotNull()
    )
    naive = view.agg(
        F.count_distinct(F.when(F.col("is_deleted") == F.lit(False), F.col("customer_id"))),
        F.count_distinct(F.when(active, F.col("customer_id"))),
    ).first()
    got = customers.counts_from_activity(small, p).first()
    assert (got.totalCustomer, got.activeCustomer) == tuple(naive)


def test_security_rule_cuts_the_requested_companies(small):
    both = scoped_invoices(small.invoices, P.DEFAULT.but(company_ids=(1, 2), allowed_company_ids=(1,)))
    assert both.count() == scoped_invoices(small.invoices, P.DEFAULT).count()
    assert scoped_invoices(small.invoices, P.DEFAULT.but(company_ids=(2,), allowed_company_ids=(1,))).isEmpty()
    assert scoped_invoices(small.invoices, P.DEFAULT.but(company_ids=(), allowed_company_ids=())).isEmpty()


def test_long_id_lists_are_one_predicate(small):
    p = P.DEFAULT.but(legal_entity_ids=tuple([1, 2, 3, *range(100, 2000)]))
    long_list = scoped_invoices(small.invoices, p)
    assert long_list.count() == scoped_invoices(small.invoices, P.DEFAULT).count() == 1374


def test_default_scope_keeps_the_documented_rows(small):
    kept = scoped_invoices(small.invoices, P.DEFAULT)
    keys = kept.select(F.col("id").alias("sales_invoice_header_id"))
    assert small.payments.join(keys, "sales_invoice_header_id", "left_semi").count() == 990
    assert settled(kept).count() < kept.count()


# --- nothing in the period ------------------------------------------------------------------

NOTHING = P.WHOLE.but(from_ts=at("2050-01-01 00:00:00"), to_ts=at("2050-12-31 23:59:59"))
# A global aggregate or a calendar spine always answers; grouped reports have no rows.
ROWS = {
    **{k: 1 for k in REPORTS if k.startswith(("sales_data_kpis", "gross_", "customer_counts", "customer_base", "customer_activity"))},
    **{k: 1 for k in REPORTS if k.endswith(("_json", "_json_strict", "_json_paid"))},
    "sales_data_net_raw": 1, "lost_sales_total": 1, "net_cash_collected": 1, "collection_breakdown": 1,
    "sales_data_year_over_year": 2, "financial_summary_weekday": 7, "total_deliveries_weekday": 7,
}


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_empty_period(small, key):
    assert REPORTS[key][0](small, NOTHING).count() == ROWS.get(key, 0)


def test_empty_period_values(small):
    kpis = sales.kpis_with_average(small, NOTHING).first()
    assert (kpis.totalSales, kpis.orders, kpis.avgSale) == (None, 0, 0)
    document = delivery.delivery_time_document(small, NOTHING).first()
    assert (document.avg_delivery_time, document.percentage_change, document.hourly_trend) == (0, 0, "[]")
    money = delivery.financial_document(small, NOTHING).first()
    assert (money.total_order_value, money.average_order_value) == (None, 0)
    assert {r.total_order_value for r in delivery.financial_weekdays(small, NOTHING).collect()} == {0}
    assert cities.monthly_document(small, NOTHING).first().result == '{"cities":null,"monthly_data":[]}'
    assert sales.lost_total(small, NOTHING).first()[0] == 0
