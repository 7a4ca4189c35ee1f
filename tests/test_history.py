"""History kept in tables: folds in any order, months computed again, and what the reports then read."""

import re
from datetime import date
from pathlib import Path

import pytest
from conftest import at, frame_of
from pyspark.sql import functions as F
from test_plans import plan_of

from shopledger import ReportParams, Tables
from shopledger.functions.calendar import ntz
from shopledger.plans import history, loyalty, payments
from shopledger.sources.layout import write_months, write_tables
from shopledger.sources.published import Published

P97 = ReportParams(at("1997-02-01 00:00:00"), at("1997-03-31 23:59:59"), company_ids=(1,))


@pytest.fixture
def first(spark, tmp_path):
    return Published(spark, str(tmp_path / "first"), history.FIRST_SCHEMA, ["bucket"])


@pytest.fixture(scope="module")
def written(spark, small, tmp_path_factory):
    """Invoices of 1996 and 1997 and their payments as plain files."""
    folder = str(tmp_path_factory.mktemp("plain"))
    cut = small.invoices.where("year(invoice_date_time) in (1996, 1997)")
    for name in ("sales_invoice_header", "payment_transactions", "ent_stores", "ent_payment_methods", "ent_sub_payment_method"):
        (cut if name == "sales_invoice_header" else small[name]).write.parquet(f"{folder}/{name}")
    return Tables.from_parquet(spark, folder)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_folds_in_any_order_and_twice(spark, written, first):
    month = F.month("invoice_date_time")
    for part in (2, 0, 1, 2):
        history.fold_first_purchases(first, written.invoices.where(month % 3 == part))
    want = rows(history.first_purchases(written.invoices).drop("bucket"))
    assert rows(history.read_first(first)) == want and any(r[0] is None for r in want)
    # A fold that brings nothing earlier writes nothing.
    number = first.version().number
    history.fold_first_purchases(first, written.invoices.where(month == 5))
    assert first.read().count() >= len(want) and first.version().number == number
    history.compact(first)
    assert rows(first.read().drop("bucket")) == want


@pytest.mark.parametrize("p", [P97, P97.but(region_ids=(0, 1)), P97.but(company_ids=())])
def test_same_pie_from_the_table(written, first, p):
    history.fold_first_purchases(first, written.invoices)
    got = loyalty.pie_by_first_date(written, p, first=history.read_first(first))
    want = rows(loyalty.pie_by_first_date(written, p))
    assert rows(got) == want and {r[2] for r in want} == {"Existing Customer", "New Customer"}
    naive = rows(
        written.invoices.join(written.stores.where(F.col("region_id").isin(*p.region_ids) if p.region_ids else F.lit(True)), F.col("store_id") == written.stores.id)
        .withColumn("first", F.expr("min(invoice_date_time) over (partition by customer_id)"))
        .where(F.col("invoice_date_time").between(ntz(p.from_ts), ntz(p.to_ts)))
        .where(written.invoices.company_id == 1 if p.company_ids else F.lit(True))
        .select("customer_id", F.when(F.col("first") < ntz(p.from_ts), "Existing Customer").otherwise("New Customer"))
        .distinct()
    )
    assert sorted(((r[0], r[2]) for r in want), key=str) == sorted(naive, key=str)


def test_pie_from_the_table_reads_the_period_only(written, first):
    history.fold_first_purchases(first, written.invoices)
    plan = plan_of(loyalty.pie_by_first_date(written, P97, first=history.read_first(first)))
    scans = re.findall(r"sales_invoice_header\].*?PushedFilters: \[(.*?)\]\n", plan, re.S)
    assert scans and all("GreaterThanOrEqual(invoice_date_time,1997-02-01" in s for s in scans)


@pytest.mark.parametrize("report", [loyalty.pie_by_earlier_invoice, loyalty.pie_by_earlier_invoice_loose, loyalty.pie_by_first_date])
def test_history_of_other_customers_is_dropped_at_the_scan(written, report):
    plan = plan_of(report(written, P97))
    tests = re.findall(r"Filter.*\n.*\n.*Condition : .*getbit", plan)
    assert tests and "LessThan(invoice_date_time,1997-02-01" in plan


def test_payments_of_others_are_dropped_at_the_scan(written):
    for report in (payments.share_per_group, lambda t, p: payments.share_first_cash_row(t, p, negative_returns=True)):
        scoped = report(written, P97.but(tenant_ids=(1,)))
        assert "getbit" in plan_of(scoped)
        assert "getbit" not in plan_of(report(written, P97.but(company_ids=())))
        without = written.payments.join(written.invoices.where("company_id = 1 and tenant_id = 1").select(F.col("id").alias("sales_invoice_header_id")), "sales_invoice_header_id", "left_semi")
        alone = Tables(lambda name, w=without: w if name == "payment_transactions" else written[name])
        assert rows(scoped) == rows(report(alone, P97.but(tenant_ids=(1,))))


def test_one_changed_month_is_computed_alone(spark, written, tmp_path):
    write_tables(Tables(lambda n: written[n] if n in ("sales_invoice_header", "payment_transactions") else frame_of(spark, n, [])), str(tmp_path / "layout"))
    laid = Tables.from_layout(spark, str(tmp_path / "layout"))
    table = Published(spark, str(tmp_path / "months"), history.MISMATCH_SCHEMA, ["month_part"])
    history.refresh_mismatches(table, laid)
    assert rows(history.reconciliation_total(table.read())) == rows(payments.reconciliation(laid)) != []
    may = date(1997, 5, 1)
    renewed = written.invoices.where("year(invoice_date_time) = 1997 and month(invoice_date_time) = 5").withColumn("net_amount", (F.col("net_amount") + 1).cast("decimal(18,2)"))
    sources = {"sales_invoice_header": renewed.select(written.invoices.columns), "payment_transactions": written.payments}
    changed = Tables(lambda n: sources[n] if n in sources else frame_of(spark, n, []))
    write_months(changed, str(tmp_path / "layout"))
    laid = Tables.from_layout(spark, str(tmp_path / "layout"))
    before = {p: p.read_bytes() for p in Path(table.root, "data").rglob("*.parquet")}
    old = set(table.version().directories)
    new = set(history.refresh_mismatches(table, laid, [may]).directories)
    assert {d.split("/")[0] for d in old ^ new} == {"month_part=1997-05-01"} and all(p.read_bytes() == b for p, b in before.items())
    assert rows(history.reconciliation_total(table.read())) == rows(payments.reconciliation(laid))
    scan = plan_of(history.monthly_mismatches(laid, [may]))
    assert len(re.findall(r"PartitionFilters: \[.*month_part#\d+ (?:= 1997-05-01|IN)", scan)) >= 2
    # All months again, invoices without a time too.
    history.refresh_mismatches(table, laid)
    assert rows(history.reconciliation_total(table.read())) == rows(payments.reconciliation(laid))


def test_nothing_yet(spark, made, first, tmp_path):
    history.fold_first_purchases(first, made().invoices)
    assert rows(history.read_first(first)) == []
    table = Published(spark, str(tmp_path / "m"), history.MISMATCH_SCHEMA, ["month_part"])
    history.refresh_mismatches(table, made())
    assert rows(history.reconciliation_total(table.read())) == rows(payments.reconciliation(made())) == [(0, None, None)]
