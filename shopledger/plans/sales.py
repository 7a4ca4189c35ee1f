"""Sales totals: the dashboard's headline figures and the monthly graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import RETURNS, SALES, is_sale_or_return, only_on, or_zero, signed, with_tax
from shopledger.functions.calendar import month_start, within
from shopledger.functions.ratios import quotient
from shopledger.operators.scope import in_periods, scope, scoped_invoices, settled, takes
from shopledger.operators.stores import in_regions, store_ids, with_store
from shopledger.operators.totals import few_in_order
from shopledger.params import ReportParams
from shopledger.plans.views import LOST, lost_sales
from shopledger.sources.tables import Tables

_WIDE = "decimal(28,2)"


@takes("legal_entity_ids", "store_ids", "region_ids")
def invoice_rows(t: Tables, p: ReportParams) -> DataFrame:
    """The settled invoices themselves, for callers that add them up on their own."""
    return in_regions(settled(scoped_invoices(t.invoices, p)), t.stores, p).select(
        "id", "tax", "invoice_type", "net_amount", "source", "total_discount", "invoice_amount", "gross_amount", "store_id"
    )


def _per_store(invoices: DataFrame, *keys: str) -> DataFrame:
    """Unsigned sums per store and invoice type (and ``keys``).

    The type decides the sign, so signs wait until the rows are few: one decimal sum
    per measure and invoice row instead of one per reported figure.
    """
    return invoices.groupBy(*keys, "store_id", "invoice_type").agg(
        F.sum("net_amount").alias("net"),
        F.sum(with_tax()).alias("gross"),
        F.sum("total_discount").alias("discount"),
        F.sum("tax").alias("tax"),
        F.count("id").alias("invoices"),
        F.lit(0).cast(_WIDE).alias("lost"),
    )


def _lost_per_store(orders: DataFrame, *keys: str) -> DataFrame:
    """Lost orders in the shape of ``_per_store``: zeros and a type of their own."""
    zero = F.lit(0).cast(_WIDE)
    per_store = orders.where(F.col("order_type") == LOST).groupBy(*keys, "store_id")
    return per_store.agg(F.sum("net_amount").alias("lost")).select(
        *keys,
        "store_id",
        F.lit(LOST).alias("invoice_type"),
        *[zero.alias(c) for c in ("net", "gross", "discount", "tax")],
        F.lit(0).cast("bigint").alias("invoices"),
        "lost",
    )


def _figures(sold: str) -> list[Column]:
    """The figures from per-store sums, ``sold`` naming the amount that counts.

    An invoice id occurs once, so orders are a count of sales invoices.
    """
    amount = F.col(sold)
    return [
        F.sum(only_on(SALES, amount)).alias("totalSales"),
        F.sum(only_on(RETURNS, amount)).alias("totalReturns"),
        F.sum(signed(amount)).alias("netSales"),
        F.sum(signed(F.col("discount"))).alias("totalDiscount"),
        F.sum(signed(F.col("tax"))).alias("tax"),
        or_zero(F.sum(only_on(SALES, F.col("invoices")))).alias("orders"),
        F.count_distinct("store_id").alias("activeStores"),
    ]


def _kpi_columns() -> list[Column]:
    return [*_figures("gross"), F.sum("lost").alias("lostSaledata")]


@takes("legal_entity_ids", "store_ids", "region_ids")
def kpis(t: Tables, p: ReportParams, *, with_lost: bool = True, settled_only: bool = False) -> DataFrame:
    """Sales, returns, discount and tax (amounts with tax), orders, stores, lost sales.

    The figures of the master view, with or without its lost orders.
    """
    invoices = scoped_invoices(t.invoices, p)
    rows = _per_store(settled(invoices) if settled_only else invoices)
    if with_lost:
        rows = rows.unionByName(_lost_per_store(in_periods(scope(t.orders, p), "order_date_time", p.period)))
    return in_regions(rows, t.stores, p).agg(*_kpi_columns())


@takes("legal_entity_ids", "store_ids", "region_ids")
def kpis_with_average(t: Tables, p: ReportParams, *, with_lost: bool = False) -> DataFrame:
    average = F.round(or_zero(quotient(F.col("netSales"), F.col("orders"))), 2)
    return kpis(t, p, with_lost=with_lost).withColumn("avgSale", average)


@takes("legal_entity_ids", "store_ids", "region_ids")
def kpis_year_over_year(t: Tables, p: ReportParams) -> DataFrame:
    """The figures of settled invoices for the period and the year before, from one scan.

    The two may overlap (a period longer than a year). Rows are summed by the set of
    periods they lie in, and only those sums are repeated for each of them.
    """
    spans = {"current": p.period, "previous": p.year_before}

    def tagged(frame: DataFrame, time_column: str) -> DataFrame:
        ts = F.col(time_column)
        hits = F.array(*[F.when(within(ts, span), F.lit(tag)) for tag, span in spans.items()])
        rows = in_periods(scope(frame, p), time_column, *spans.values())
        return rows.withColumn("periods", F.array_compact(hits))

    rows = _per_store(settled(tagged(t.invoices, "invoice_date_time")), "periods")
    rows = rows.unionByName(_lost_per_store(tagged(t.orders, "order_date_time"), "periods"))
    figures = in_regions(rows, t.stores, p).withColumn("period", F.explode("periods")).groupBy("period").agg(*_kpi_columns())
    spine = figures.sparkSession.range(0, len(spans), 1, 1).select(
        F.element_at(F.array(*[F.lit(tag) for tag in spans]), F.col("id").cast("int") + 1).alias("period")
    )
    # Two rows at most on the broadcast side; a period without rows still shows up.
    return spine.join(F.broadcast(figures), "period", "left").fillna(0, ["orders", "activeStores"])


@takes("legal_entity_ids", "store_ids", "region_ids")
def net_totals(t: Tables, p: ReportParams) -> DataFrame:
    """Totals of the settled invoices without tax."""
    return in_regions(_per_store(settled(scoped_invoices(t.invoices, p))), t.stores, p).agg(*_figures("net"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def lost_total(t: Tables, p: ReportParams) -> DataFrame:
    orders = in_periods(scope(t.orders, p), "order_date_time", p.period)
    return in_regions(lost_sales(orders), t.stores, p).agg(or_zero(F.sum("lost_sale_amount")).alias("lostSaledata"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def gross_total(t: Tables, p: ReportParams) -> DataFrame:
    return in_regions(settled(scoped_invoices(t.invoices, p)), t.stores, p).agg(F.sum(signed(with_tax())).alias("total_sales"))


@takes("legal_entity_ids", "store_ids", "region_ids")
def gross_returns_net(t: Tables, p: ReportParams) -> DataFrame:
    invoices = in_regions(settled(scoped_invoices(t.invoices, p)), t.stores, p)
    per_type = invoices.groupBy("invoice_type").agg(F.sum(with_tax()).alias("gross"))
    gross = F.col("gross")
    return per_type.agg(
        F.sum(only_on(SALES, gross)).alias("gross_sales"),
        F.sum(only_on(RETURNS, gross)).alias("total_returns"),
        F.sum(signed(gross)).alias("net_sales"),
    )


@takes("legal_entity_ids", "store_ids", "region_ids")
def monthly_graph(t: Tables, p: ReportParams) -> DataFrame:
    """Net, returned and sold amount per month over stores in the wanted regions.

    Summed per store, month and type first: the store table meets that small frame only.
    """
    per_store = (
        settled(scoped_invoices(t.invoices, p))
        .where(is_sale_or_return())
        .groupBy("store_id", month_start(F.col("invoice_date_time")).alias("month"), "invoice_type")
        .agg(F.sum("net_amount").alias("net"))
    )
    net = F.col("net")
    figures = {"netSales": signed(net), "returns": only_on(RETURNS, net), "totalSales": only_on(SALES, net)}
    per_month = (
        with_store(per_store, store_ids(t.stores, p))
        .groupBy("month")
        .agg(*[F.round(F.sum(x), 2).alias(name) for name, x in figures.items()])
    )
    return few_in_order(per_month, ["month"])


@takes("legal_entity_ids", "store_ids")
def monthly_graph_signed(t: Tables, p: ReportParams) -> DataFrame:
    """Signed amount per month; no store or payment condition."""
    per_month = (
        scoped_invoices(t.invoices, p)
        .groupBy(month_start(F.col("invoice_date_time")).alias("month"))
        .agg(F.round(F.sum(signed(F.col("net_amount"))), 2).alias("totalSales"))
    )
    return few_in_order(per_month, ["month"])
