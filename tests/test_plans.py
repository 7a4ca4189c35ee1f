"""What the physical plans look like: pushdown, pruning, and no step that gathers rows."""

import re

import pytest
from conftest import SMALL, at
from pyspark.sql import functions as F

from shopledger_checks import params as P
from shopledger_checks.registry import REPORTS, all_queries
from shopledger import Tables
from shopledger.operators.scope import scoped_invoices
from shopledger.plans import catalog, sales, views
from shopledger.sources.layout import write_monthly, write_months, write_tables
from shopledger.sources.schemas import SCHEMAS


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def half_year(small):
    """The tables with invoices and orders of six months, so that few directories are written."""
    cut = {"sales_invoice_header": "invoice_date_time", "sales_order_header": "order_date_time"}
    months = "{} >= timestamp_ntz'1997-01-01 00:00:00' and {} < timestamp_ntz'1997-07-01 00:00:00'"
    return Tables(lambda name: small[name].where(months.format(cut[name], cut[name])) if name in cut else small[name])


@pytest.fixture(scope="module")
def stored(spark, half_year, tmp_path_factory):
    """The business tables as plain parquet and in the partitioned layout."""
    plain, laid_out = (str(tmp_path_factory.mktemp(n)) for n in ("plain", "layout"))
    for name in SCHEMAS:
        half_year[name].write.parquet(f"{plain}/{name}")
    write_tables(half_year, laid_out)
    return plain, laid_out


@pytest.fixture(scope="module")
def plain(spark, stored):
    return Tables.from_parquet(spark, stored[0])


@pytest.fixture(scope="module")
def partitioned(spark, stored):
    """The layout's directory alone."""
    return Tables.from_layout(spark, stored[1])


@pytest.mark.parametrize("key", sorted(k for k in all_queries() if not k.endswith("_scoped")))
def test_no_python_no_gathering_window_no_pairs(spark, key):
    plan = plan_of(all_queries()[key](spark, SMALL))
    assert not re.search(r"Python|ArrowEval|MapInPandas", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in re.findall(r"Arguments: \[.*windowspecdefinition\((.*?),", plan):
        assert "specifiedwindowframe" not in line, "window without partition"


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_no_sort_based_aggregate(plain, key):
    report, _, narrow = REPORTS[key]
    assert "SortAggregate" not in plan_of(report(plain, narrow))


def test_scope_and_period_reach_the_scan(plain):
    plan = plan_of(sales.kpis(plain, P.STORE, with_lost=False))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for column in ("company_id", "tenant_id", "store_id", "legal_entity_id", "invoice_date_time"):
        assert column in pushed
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert "fulfilment_type" not in read and "gross_amount" not in read


def test_join_reports_push_the_scope_too(plain):
    plan = plan_of(catalog.top_products(plain, P.DEFAULT, "SERVICE_PRODUCT"))
    assert any("GreaterThanOrEqual(invoice_date_time" in p for p in re.findall(r"PushedFilters: \[(.*)\]", plan))


def test_layout_prunes_companies_and_months(half_year, partitioned):
    period = P.DEFAULT.but(from_ts=at("1997-03-10 00:00:00"), to_ts=at("1997-04-20 23:59:59"))
    frame = scoped_invoices(partitioned.invoices, period)
    plan = plan_of(frame)
    filters = re.search(r"PartitionFilters: \[(.*?)\]\n", plan).group(1)
    assert all(c in filters for c in ("company_id", "tenant_id", "month_part"))
    assert frame.count() == scoped_invoices(half_year.invoices, period).count() > 0


OVER_LINES_OR_PAYMENTS = tuple(k for k in REPORTS if k.startswith(("payment_share", "category_", "top_products", "net_cash", "collection")))
OTHERS = ("sales_data_kpis", "customer_pie_first_date", "customer_sales_top5", "total_deliveries_weekday", "top_cities_monthly")


@pytest.mark.parametrize("key", [*OVER_LINES_OR_PAYMENTS, *OTHERS])
def test_same_rows_on_any_layout(half_year, plain, partitioned, key):
    report, _, narrow = REPORTS[key]
    narrow = narrow.but(from_ts=at("1997-04-01 00:00:00"), to_ts=at("1997-05-31 23:59:59"))
    expected = sorted(report(half_year, narrow).collect(), key=str)
    assert sorted(report(partitioned, narrow).collect(), key=str) == expected
    if key in ("sales_data_kpis", "payment_share_view_v2", "category_sales_top5"):
        assert sorted(report(plain, narrow).collect(), key=str) == expected


SHORT = P.DEFAULT.but(from_ts=at("1997-04-01 00:00:00"), to_ts=at("1997-04-30 23:59:59"))


@pytest.mark.parametrize("key", OVER_LINES_OR_PAYMENTS)
def test_layout_prunes_lines_and_payments(partitioned, key):
    p = SHORT.but(legal_entity_ids=()) if key.startswith("category") else SHORT
    plan = plan_of(REPORTS[key][0](partitioned, p))
    table = "sales_invoice_lines" if key.startswith(("category", "top_products")) else "payment_transactions"
    scans = [s for s in plan.split("\n\n") if re.search(rf"Location: .*{table}\]", s)]
    assert scans
    for scan in scans:
        filters = re.search(r"PartitionFilters: \[(.*?)\]\n", scan)[1]
        assert all(c in filters for c in ("invoice_company_id", "invoice_tenant_id", "month_part"))


def test_long_id_list_still_prunes(partitioned):
    p = SHORT.but(tenant_ids=tuple([1, *range(1000, 2000)]))
    plan = plan_of(scoped_invoices(partitioned.invoices, p))
    assert "tenant_id" in re.search(r"PartitionFilters: \[(.*?)\]\n", plan)[1]
    assert scoped_invoices(partitioned.invoices, p).count() == scoped_invoices(partitioned.invoices, SHORT).count() > 0


def test_payments_move_once_in_the_payment_view(spark, plain):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        view = views.payment_rows(plain.invoices, plain.payments, plain.payment_methods, plain.sub_payment_methods, "v3")
        plan = view._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, .*\n.*Project \[id#\d+L AS payment_id", plan)
    assert moved == ["sales_invoice_header_id"]


def test_a_month_is_added_and_replaced_alone(spark, half_year, tmp_path):
    def only(first, last):
        inside = "{0} >= timestamp_ntz'1997-{1} 00:00:00' and {0} < timestamp_ntz'1997-{2} 00:00:00'"
        cut = {"sales_invoice_header": "invoice_date_time", "sales_order_header": "order_date_time"}
        return Tables(lambda n: half_year[n].where(inside.format(cut[n], first, last)) if n in cut else half_year[n])

    folder = str(tmp_path / "t")
    write_tables(only("02-01", "03-01"), folder)
    files = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    write_months(only("03-01", "04-01"), folder)
    write_months(only("03-01", "04-01"), folder)
    left = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    assert all(left.get(name) == when for name, when in files.items())
    both = Tables.from_layout(spark, folder)
    assert both.invoices.count() == only("02-01", "04-01").invoices.count()
    march = only("03-01", "04-01").invoices.select(F.col("id").alias("invoice_id"))
    written = both.lines.where("month_part = date'1997-03-01'")
    assert written.count() == half_year.lines.join(march, "invoice_id", "left_semi").count() > 0


def test_rows_survive_the_layout(half_year, partitioned):
    for name in ("sales_invoice_header", "sales_invoice_lines", "payment_transactions"):
        columns = half_year[name].columns
        assert half_year[name].exceptAll(partitioned[name].select(columns)).isEmpty()
        assert half_year[name].count() == partitioned[name].count()


def _executed(tree):
    """The lines of a plan without the first drafts that the adaptive planner keeps beside the final ones."""
    draft = None
    for line in tree.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if draft is not None and depth >= draft:
            continue
        draft = depth if "== Initial Plan ==" in line else None
        if draft is None:
            yield line


@pytest.mark.parametrize("key", ["category_sales_top5", "customer_sales_top5", "customer_sales_top5_raw", "payment_share_view_v2"])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_grand_totals_read_the_facts_once(spark, plain, key, broadcast):
    """The totals' subquery takes the exchange that the rows have made."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, broadcast)
    try:
        report, whole, _ = REPORTS[key]
        frame = report(plain, whole)
        frame.collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    tree = frame._jdf.queryExecution().executedPlan().toString()
    executed = "\n".join(_executed(tree))
    assert "ReusedExchange" in tree and "Expand" not in tree
    assert "ReusedExchange" in executed
    assert len(re.findall(r"FileScan parquet \[[^\]]*invoice_date_time[^\]]*\]", executed)) == 1


def test_product_table_never_meets_the_lines(plain, spark):
    """The lines' only join is with invoices; products join the per-product sums."""
    plan = plan_of(catalog.top_products(plain, P.WHOLE, "STANDARD_PRODUCT"))
    tree = plan.split("\n\n")[0]
    # Read from the result down: product join, per-product sum, line join.
    assert re.search(r"Join.*HashAggregate.*HashAggregate.*Join", tree, re.S) and tree.count("Join") == 2


def test_layout_splits_a_large_company_month(spark, tmp_path):
    """One company-month with most of the rows is written by several tasks, each file sorted."""
    rows = spark.range(60_000).selectExpr(
        "id", "1L as company_id", "1L as tenant_id", "id % 5 as legal_entity_id", "repeat(uuid(), 4) as source",
        "timestamp_ntz'2024-01-01 00:00:00' + (id % 28) * interval '1' day as invoice_date_time",
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "500KB")
    try:
        write_monthly(rows.repartition(16), "invoice_date_time", str(tmp_path / "t"))
    finally:
        spark.conf.unset(key)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert written.count() == 60_000
    per_file = written.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect()
    assert len(per_file) > 3 and max(r.n for r in per_file) < 60_000 / 2
