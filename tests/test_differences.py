"""Reports that look alike but answer differently: each difference is pinned."""

from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from shopledger_checks import params as P
from shopledger import ReportParams
from shopledger.functions import flags
from shopledger.plans import catalog, cities, customers, delivery, loyalty, payments, sales, views

JAN = ReportParams(at("2024-01-01 00:00:00"), at("2024-01-31 23:59:59"))


def invoice(id, type="SALES", net="100.00", **more):
    return {
        "id": id,
        "invoice_type": type,
        "net_amount": Decimal(net),
        "invoice_amount": Decimal(net),
        "store_id": 1,
        "customer_id": 1,
        "company_id": 1,
        "tenant_id": 1,
        "legal_entity_id": 1,
        "payment_status": "PAID",
        "invoice_date_time": at("2024-01-10 10:00:00"),
        **more,
    }


def payment(id, invoice_id, amount, method="CASH", status="PAID", **more):
    return {
        "id": id,
        "sales_invoice_header_id": invoice_id,
        "amount": Decimal(amount),
        "payment_method_type": method,
        "transaction_status": status,
        **more,
    }


STORE = {"id": 1, "region_id": 1, "city_id": 1, "is_deleted": False}


def shares(frame):
    return {r["name"]: r["amount"] for r in frame.collect()}


# --- flagship ------------------------------------------------------------------------


def test_flagship_figures(small):
    p = P.WHOLE.but(company_ids=(1,), tenant_ids=(1,), legal_entity_ids=(1,))
    row = sales.kpis_with_average(small, p).first()
    assert (row.totalSales, row.orders, row.activeStores, row.avgSale) == (
        Decimal("166199825.63"), 591, 100, Decimal("113532.46"),
    )


def test_lost_sales_come_with_one_master_view_only(made):
    t = made(
        sales_invoice_header=[invoice(1)],
        sales_order_header=[
            {"id": 5, "order_type": "LOST_SALES", "net_amount": Decimal("7.00"), "store_id": 9, "order_date_time": at("2024-01-02")},
            {"id": 6, "order_type": "NORMAL", "net_amount": Decimal("8.00"), "store_id": 8, "order_date_time": at("2024-01-02")},
        ],
    )
    with_lost, without = sales.kpis(t, JAN).first(), sales.kpis(t, JAN, with_lost=False).first()
    assert (with_lost.lostSaledata, with_lost.activeStores) == (Decimal("7.00"), 2)
    assert (without.lostSaledata, without.activeStores) == (Decimal("0.00"), 1)


def test_gross_needs_no_status_but_net_does(made):
    t = made(sales_invoice_header=[invoice(1, tax=Decimal("15.00")), invoice(2, payment_status=None)])
    assert sales.kpis(t, JAN).first().totalSales == Decimal("215.00")
    assert sales.kpis(t, JAN, settled_only=True).first().totalSales == Decimal("115.00")
    assert sales.net_totals(t, JAN).first().totalSales == Decimal("100.00")


# --- payments ---------------------------------------------------------------------------


def test_change_figures_on_the_test_data(small):
    def total(frame):
        return sum(r["amount"] for r in frame.collect())

    got = [
        total(payments.share_every_cash_row(small, P.WHOLE, settled_only=False)),
        total(payments.share_first_cash_row(small, P.WHOLE, negative_returns=False)),
        total(payments.share_first_cash_row(small, P.WHOLE, negative_returns=True)),
    ]
    assert got == [Decimal("420445.94"), Decimal("430028.94"), Decimal("122124.90")]


CHANGE = {"change_amount": Decimal("10.00")}


def test_change_off_each_row_the_first_row_or_each_group(made):
    t = made(
        sales_invoice_header=[invoice(1, **CHANGE)],
        payment_transactions=[payment(1, 1, "60.00"), payment(2, 1, "50.00")],
        ent_stores=[STORE],
    )
    assert shares(payments.share_every_cash_row(t, JAN, settled_only=False)) == {"CASH": Decimal("90.00")}
    assert shares(payments.share_first_cash_row(t, JAN, negative_returns=False)) == {"CASH": Decimal("100.00")}
    assert shares(payments.share_per_group(t, JAN)) == {"CASH": Decimal("100.00")}


def test_a_failed_first_cash_row_keeps_the_change(made):
    t = made(
        sales_invoice_header=[invoice(1, **CHANGE)],
        payment_transactions=[payment(1, 1, "60.00", status="FAILED"), payment(2, 1, "50.00")],
    )
    assert shares(payments.share_first_cash_row(t, JAN, negative_returns=False)) == {"CASH": Decimal("50.00")}
    rows = views.VIEWS["view_sales_by_payment_rows_v2"](t).where("transaction_status = 'PAID'")
    assert [r.amount for r in rows.collect()] == [Decimal("50.00")]


def test_two_cash_methods_share_one_first_row(made):
    t = made(
        sales_invoice_header=[invoice(1, **CHANGE)],
        payment_transactions=[payment(1, 1, "60.00", payment_method_id=2), payment(2, 1, "50.00", payment_method_id=1)],
        ent_payment_methods=[{"id": 1, "name": "CASH", "image": "one"}, {"id": 2, "name": "TILL", "image": "two"}],
    )
    rows = payments.share_first_cash_row(t, JAN, negative_returns=False).collect()
    assert {r["image"]: r["amount"] for r in rows} == {"two": Decimal("50.00"), "one": Decimal("50.00")}
    assert {r["percentage"] for r in rows} == {Decimal("50.00")}


def test_returns_turn_negative_in_the_third_version(made):
    t = made(
        sales_invoice_header=[invoice(1, "RETURNS", **CHANGE)],
        payment_transactions=[payment(1, 1, "60.00"), payment(2, 1, "-5.00", method="CARD")],
    )
    assert shares(payments.share_first_cash_row(t, JAN, negative_returns=True)) == {
        "CASH": Decimal("-60.00"), "CARD": Decimal("-5.00"),
    }


def test_an_unknown_method_reads_card_without_image(made):
    t = made(sales_invoice_header=[invoice(1)], payment_transactions=[payment(1, 1, "5.00", method=None)])
    rows = payments.share_every_cash_row(t, JAN, settled_only=False).collect()
    assert [(r["name"], r["image"]) for r in rows] == [("CARD", "")]


def test_only_the_raw_form_needs_a_payment_status(made):
    t = made(sales_invoice_header=[invoice(1, payment_status=None)], payment_transactions=[payment(1, 1, "5.00")])
    assert shares(payments.share_every_cash_row(t, JAN, settled_only=False)) == {"CASH": Decimal("5.00")}
    assert shares(payments.share_every_cash_row(t, JAN, settled_only=True)) == {}


def test_equal_change_counts_once(made):
    t = made(
        sales_invoice_header=[invoice(1, **CHANGE), invoice(2, **CHANGE), invoice(3)],
        payment_transactions=[payment(1, 1, "60.00"), payment(2, 2, "60.00"), payment(3, 3, "5.00", method="CARD")],
    )
    assert payments.net_cash(t, JAN).first()[0] == Decimal("110.00")
    row = payments.collection_breakdown(t, JAN).first()
    assert tuple(row) == (Decimal("110.00"), Decimal("5.00"), Decimal("0.00"), Decimal("115.00"))


def test_no_change_at_all_gives_null(made):
    t = made(sales_invoice_header=[invoice(1)], payment_transactions=[payment(1, 1, "60.00")])
    assert payments.net_cash(t, JAN).first()[0] is None


def test_reconciliation_leaves_unknown_tax_out(small, made):
    assert payments.reconciliation(small).first().total_mismatches == 2963
    t = made(sales_invoice_header=[invoice(1), invoice(2, tax=Decimal("0.00"))], payment_transactions=[payment(1, 1, "1.00"), payment(2, 2, "99.99")])
    assert payments.reconciliation(t).first().total_mismatches == 0


# --- loyalty ------------------------------------------------------------------------------


def test_history_in_scope_or_everywhere(small):
    def existing(frame):
        return frame.where("customertype = 'Existing Customer' and customer_id is not null").count()

    assert existing(loyalty.pie_by_first_date(small, P.WIDE)) == 1129
    assert existing(loyalty.pie_by_earlier_invoice(small, P.WIDE)) == 754


def test_walk_in_sales_are_new_by_invoice_and_existing_by_first_date(made):
    t = made(
        sales_invoice_header=[invoice(1, customer_id=None), invoice(2, customer_id=None, invoice_date_time=at("2023-05-05"))],
        ent_stores=[STORE],
    )
    assert loyalty.pie_by_earlier_invoice(t, JAN).first().customertype == "New Customer"
    assert loyalty.pie_by_first_date(t, JAN).first().customertype == "Existing Customer"


def test_loose_history_needs_neither_store_nor_legal_entity(made):
    earlier = invoice(2, store_id=77, legal_entity_id=5, invoice_date_time=at("2023-05-05"))
    t = made(sales_invoice_header=[invoice(1), earlier], ent_stores=[STORE])
    p = JAN.but(legal_entity_ids=(1,))
    assert loyalty.pie_by_earlier_invoice(t, p).first().customertype == "New Customer"
    assert loyalty.pie_by_earlier_invoice_loose(t, p).first().customertype == "Existing Customer"


# --- customers -----------------------------------------------------------------------------


def person(id, **more):
    return {
        "id": id, "first_name": "A", "last_name": "B", "company_id": 1, "tenant_id": 1, "is_deleted": False,
        "customer_created_on": at("2024-01-05"), "customer_class_id": 1, **more,
    }


def test_who_counts_as_converted(made):
    t = made(
        sales_invoice_header=[invoice(1, customer_id=1), invoice(2, customer_id=2), invoice(3, customer_id=3), invoice(4, customer_id=99)],
        ent_customer=[person(1), person(2, company_id=2), person(3, is_deleted=True), person(4, is_deleted=None)],
    )
    p = JAN.but(company_ids=(1,))
    row = customers.conversion(t, p).first()
    assert (row.total_customer, row.active_customer, row.new_customer, row.converted_customer) == (1, 3, 1, 2)
    assert row.conversion_rate == Decimal("200.00")
    assert tuple(customers.activity_counts(t, p).first()) == (3, 3)


def test_zero_amount_customers_show_in_the_view_form_only(made):
    t = made(sales_invoice_header=[invoice(1, "QUOTE")], ent_customer=[person(1)], ent_stores=[STORE])
    assert [r.amount for r in customers.top_sales(t, JAN).collect()] == [Decimal("0.00")]
    assert customers.all_sales(t, JAN).count() == 0


def test_total_is_taken_before_the_limit(made):
    t = made(
        sales_invoice_header=[invoice(i, customer_id=i, net=f"{i}.00") for i in range(1, 9)],
        ent_customer=[person(i) for i in range(1, 9)],
        ent_stores=[STORE],
    )
    for report in (customers.top_sales, customers.top_sales_inline):
        rows = report(t, JAN).collect()
        assert [r.id for r in rows] == [8, 7, 6, 5, 4]
        assert {r.totalSum for r in rows} == {Decimal("36.00")}


# --- products --------------------------------------------------------------------------------


def test_header_amount_fans_out_over_lines(small):
    p = P.WHOLE
    lines = views.VIEWS["view_category_sales_rows"](small).where("payment_status is not null")
    total = catalog.top_categories(small, p).first().totalAmount
    assert total == lines.agg(F.sum("net_amount")).first()[0]
    header = catalog.category_header_amounts(small, p).agg(F.sum("amount")).first()[0]
    assert header > 3 * float(total)


def product_tables(made, **stores):
    def line(invoice_id, product_id, net, quantity, back=0):
        return {"invoice_id": invoice_id, "product_id": product_id, "net_amount": Decimal(net), "quantity": quantity, "return_quantity": back}

    return made(
        sales_invoice_header=[invoice(1), invoice(2, "RETURNS", store_id=50), invoice(3, "QUOTE")],
        sales_invoice_lines=[line(1, 1, "40.00", 4), line(1, 2, "60.00", 6), line(2, 1, "10.00", 3, 1), line(3, 1, "99.00", 9)],
        prd_products=[
            {"id": 1, "short_name": "pen", "product_classification": "STANDARD_PRODUCT", "product_category_id": 1},
            {"id": 2, "short_name": "fix", "product_classification": "SERVICE_PRODUCT", "product_category_id": 1},
        ],
        prd_product_categories=[{"id": 1, "name": "all"}],
        ent_stores=[STORE],
    )


def test_classification_and_quantity_rules(made):
    t = product_tables(made)
    pen = catalog.top_products(t, JAN, "STANDARD_PRODUCT").first()
    assert (pen["name"], pen.amount, pen.qty) == ("pen", 30.0, 7)
    assert catalog.top_products(t, JAN, "SERVICE_PRODUCT").first()["name"] == "fix"
    assert catalog.top_categories(t, JAN).first().qty == 3


def test_only_the_header_form_needs_a_store(made):
    t = product_tables(made)
    assert catalog.category_header_amounts(t, JAN).first().amount == 100.0
    assert catalog.top_categories(t, JAN).first().amount == 30.0


# --- delivery and cities ------------------------------------------------------------------------


def test_live_stores_by_either_rule(small):
    flag = F.col("is_deleted")
    assert small.stores.where(flags.live_unless_deleted(flag)).count() == 94
    assert small.stores.where(flags.known_live(flag)).count() == 76


def delivered(id, day, **more):
    return invoice(
        id, fulfilment_type="DELIVERY", fulfilment_status="DELIVERED", invoice_date_time=at(f"{day} 10:00:00"),
        on_in_transit_time=at(f"{day} 10:00:00"), on_delivered_time=at(f"{day} 10:30:00"), **more,
    )


def test_total_shows_zero_on_a_day_without_deliveries(made):
    t = made(sales_invoice_header=[delivered(1, "2024-01-08"), delivered(2, "2024-01-15"), delivered(3, "2023-12-20")], ent_stores=[STORE])
    rows = delivery.deliveries_per_weekday(t, JAN).collect()
    assert [(r.daily_deliveries, r.total_current, r.total_previous) for r in rows] == [(2, 2, 1)] + [(0, 0, 1)] * 6


def test_document_ignores_deletion_and_rows_do_not(made):
    t = made(sales_invoice_header=[delivered(1, "2024-01-08")], ent_stores=[{**STORE, "is_deleted": True}])
    row = delivery.delivery_time_document(t, JAN).first()
    assert (row.avg_delivery_time, row.total_completed_deliveries, row.hourly_trend) == (30, 1, '[{"hour":10,"avg_time":30.00}]')
    assert delivery.delivery_time_hourly(t, JAN).count() == 0


def test_delivery_before_departure_does_not_count(made):
    wrong = {**delivered(1, "2024-01-08"), "on_delivered_time": at("2024-01-08 09:00:00")}
    t = made(sales_invoice_header=[wrong, delivered(2, "2024-01-08")], ent_stores=[STORE])
    assert [(r.hour, r.hour_avg_time, r.total_completed_deliveries) for r in delivery.delivery_time_hourly(t, JAN).collect()] == [(10, 30.0, 1)]


def test_weekday_money_covers_home_delivery_and_totals_do_not(made):
    t = made(
        sales_invoice_header=[delivered(1, "2024-01-08"), invoice(2, fulfilment_type="HOME_DELIVERY", invoice_date_time=at("2024-01-08"))],
        ent_stores=[STORE],
    )
    monday = delivery.financial_weekdays(t, JAN).first()
    assert (monday.sales_value, monday.total_order_value, monday.total_orders) == (Decimal("200.00"), Decimal("100.00"), 1)
    row = delivery.financial_document(t, JAN).first()
    assert (row.total_order_value, row.average_order_value) == (Decimal("100.00"), Decimal("100.00"))
    assert '{"day_of_week":"Mon","sales_value":200.00}' in row.weekly_data


def test_cities_of_one_name_share_a_member(made):
    t = made(
        sales_invoice_header=[delivered(1, "2024-01-08"), delivered(2, "2024-01-09", store_id=2)],
        ent_stores=[STORE, {**STORE, "id": 2, "city_id": 2}],
        ent_city=[{"id": 1, "code": "A", "name": "Town"}, {"id": 2, "code": "B", "name": "Town"}],
    )
    assert cities.monthly_document(t, JAN).first().result == (
        '{"cities":[{"id":1,"code":"A","name":"Town","total_orders":1},{"id":2,"code":"B","name":"Town","total_orders":1}],'
        '"monthly_data":[{"month":"Jan","date":"2024-01-01T00:00:00","orders":{"Town":2}}]}'
    )
    assert cities.monthly_rows(t, JAN).count() == 2


@pytest.mark.parametrize("strict, n", [(False, 1), (True, 0)])
def test_unknown_deletion_of_a_city(made, strict, n):
    t = made(
        sales_invoice_header=[delivered(1, "2024-01-08")], ent_stores=[STORE], ent_city=[{"id": 1, "code": "A", "name": "Town"}]
    )
    document = cities.monthly_document(t, JAN, cities.Form(strict=strict, empty_list=False)).first().result
    assert document.count('"month"') == n
    if not n:
        assert document == '{"cities":null,"monthly_data":null}'
