"""Delivery reports: times, weekday money and weekday counts.

Each is one scan of the invoices, summed per store and hour or weekday; that small
frame meets the store table, and the rest works on at most 24 rows. Both the period
and the previous one come from the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import RETURNS, SALES, is_sale_or_return, only_on, or_zero, signed
from shopledger.functions.calendar import iso_weekday, seconds_between, within
from shopledger.functions.flags import live_unless_deleted
from shopledger.functions.ratios import average_or_zero
from shopledger.operators.documents import as_json, list_by
from shopledger.operators.scope import in_periods, keep_ids, scope, scoped_invoices, takes
from shopledger.operators.stores import store_ids, with_store
from shopledger.operators.totals import few_in_order
from shopledger.operators.weekdays import on_every_weekday
from shopledger.params import ReportParams
from shopledger.sources.tables import Tables


def _live() -> Column:
    return live_unless_deleted(F.col("is_deleted"))


def _time() -> Column:
    return F.col("invoice_date_time")


def _of_drivers(invoices: DataFrame, p: ReportParams) -> DataFrame:
    return keep_ids(invoices, "delivery_partner_id", p.driver_ids)


def _deliveries(t: Tables, p: ReportParams) -> DataFrame:
    """Delivered sales of the period and of the previous one, flagged ``current``."""
    both = in_periods(_of_drivers(scope(t.invoices, p), p), "invoice_date_time", p.period, p.previous_period)
    delivered = (
        (F.col("fulfilment_type") == "DELIVERY")
        & (F.col("invoice_type") == SALES)
        & (F.col("fulfilment_status") == "DELIVERED")
    )
    return both.where(delivered).withColumn("current", within(_time(), p.period))


# --- delivery time ------------------------------------------------------------------


def _per_hour(t: Tables, p: ReportParams, live: Column | None) -> DataFrame:
    """Seconds on the road and deliveries per hour of day, for both periods.

    Only deliveries that arrived after they left count; at most 24 rows.
    """
    left, arrived = F.col("on_in_transit_time"), F.col("on_delivered_time")
    timed = _deliveries(t, p).where(arrived > left).withColumn("seconds", seconds_between(left, arrived))
    now = F.col("current")
    per_store = timed.groupBy("store_id", F.hour(_time()).alias("hour")).agg(
        F.sum(F.when(now, F.col("seconds"))).alias("seconds"),
        F.count(F.when(now, F.lit(1))).alias("n"),
        F.sum(F.when(~now, F.col("seconds"))).alias("old_seconds"),
        F.count(F.when(~now, F.lit(1))).alias("old_n"),
    )
    columns = ("seconds", "n", "old_seconds", "old_n")
    return (
        with_store(per_store, store_ids(t.stores, p, live))
        .groupBy("hour")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )


def _minutes(seconds: str, n: str) -> Column:
    """Exact average minutes, NULL without deliveries."""
    minutes = F.col(seconds).cast("decimal(24,6)") / (F.nullif(F.col(n), F.lit(0)) * 60).cast("decimal(20,0)")
    return minutes.cast("decimal(20,10)")


def _minutes_double(seconds: str, n: str) -> Column:
    return F.col(seconds).cast("double") / F.nullif(F.col(n) * 60, F.lit(0)).cast("double")


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def delivery_time_document(t: Tables, p: ReportParams) -> DataFrame:
    """Average minutes, change on the previous period, and the hourly trend as JSON.

    One row always. Stores count whether or not they are deleted.
    """
    hours = _per_hour(t, p, live=None).withColumn("_minutes", _minutes("seconds", "n"))
    trend = list_by(F.col("hour"), F.col("hour"), F.round("_minutes", 2).alias("avg_time"))
    sums = hours.agg(
        *[F.sum(c).alias(c) for c in ("seconds", "n", "old_seconds", "old_n")],
        trend.alias("trend"),
    ).withColumns({"now": _minutes("seconds", "n"), "before": _minutes("old_seconds", "old_n")})
    now, before = F.col("now"), F.col("before")
    change = F.round((now - before).cast("decimal(20,10)") / F.nullif(before, F.lit(0)) * 100, 2)
    with_average = F.filter("trend", lambda h: h["avg_time"].isNotNull())
    return sums.select(
        F.round(or_zero(now), 0).alias("avg_delivery_time"),
        F.when((before > 0) & now.isNotNull(), change).otherwise(F.lit(0)).alias("percentage_change"),
        or_zero(F.col("n")).alias("total_completed_deliveries"),
        as_json(with_average).alias("hourly_trend"),
    )


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def delivery_time_hourly(t: Tables, p: ReportParams) -> DataFrame:
    """A row per hour with deliveries, beside the overall and the previous average.

    Live stores only; no rows if nothing was delivered in the period.
    """
    hours = _per_hour(t, p, _live())
    sums = {f"all_{c}": F.sum(c) for c in ("seconds", "n", "old_seconds", "old_n")}
    return (
        few_in_order(hours, ["hour"], **sums)
        .where(F.col("n") > 0)
        .select(
            "hour",
            _minutes_double("seconds", "n").alias("hour_avg_time"),
            _minutes_double("all_seconds", "all_n").alias("total_avg_time"),
            F.col("all_n").alias("total_completed_deliveries"),
            _minutes_double("all_old_seconds", "all_old_n").alias("prev_avg_time"),
        )
    )


# --- money per weekday ----------------------------------------------------------------


def _per_weekday_money(t: Tables, p: ReportParams, live: Column | None) -> DataFrame:
    """Sales of all delivery types, and figures of plain deliveries, per weekday.

    One sum per store, day, invoice type and delivery type; the figures split it up.
    """
    per_store = (
        _of_drivers(scoped_invoices(t.invoices, p), p)
        .where(is_sale_or_return() & F.col("fulfilment_type").isin("DELIVERY", "HOME_DELIVERY"))
        .groupBy("store_id", iso_weekday(_time()).alias("day_num"), "invoice_type", "fulfilment_type")
        .agg(F.sum("invoice_amount").alias("amount"), F.count("id").alias("invoices"))
    )
    amount = F.col("amount")
    plain = F.col("fulfilment_type") == "DELIVERY"
    per_day = (
        with_store(per_store, store_ids(t.stores, p, live))
        .groupBy("day_num")
        .agg(
            F.sum(only_on(SALES, amount)).alias("sales"),
            F.sum(F.when(plain, only_on(SALES, amount))).alias("delivered"),
            F.sum(F.when(plain, only_on(SALES, F.col("invoices")))).alias("orders"),
            F.sum(F.when(plain, only_on(RETURNS, amount))).alias("returned"),
            F.sum(F.when(plain, signed(amount))).alias("net"),
        )
    )
    return on_every_weekday(per_day)


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def financial_document(t: Tables, p: ReportParams) -> DataFrame:
    """Totals of plain deliveries and the weekday sales as JSON; totals over nothing are NULL."""
    days = _per_weekday_money(t, p, live=None)
    value = F.round(or_zero(F.col("sales")), 2).cast("decimal(38,2)")
    week = list_by(F.col("day_num"), F.col("day_name").alias("day_of_week"), value.alias("sales_value"))
    sums = days.agg(
        *[F.sum(c).alias(c) for c in ("delivered", "orders", "returned", "net")],
        week.alias("week"),
    )
    return sums.select(
        F.round("delivered", 2).alias("total_order_value"),
        average_or_zero(F.col("delivered"), F.col("orders")).alias("average_order_value"),
        F.round("returned", 2).alias("returns_value"),
        F.round("net", 2).alias("total_sale_value"),
        as_json(F.col("week")).alias("weekly_data"),
    )


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def financial_weekdays(t: Tables, p: ReportParams) -> DataFrame:
    """Seven rows, Monday first, with the totals of live stores repeated; totals over nothing are 0."""
    days = _per_weekday_money(t, p, _live())
    totals = {
        "total_order_value": "delivered",
        "total_orders": "orders",
        "total_returns_value": "returned",
        "total_sale_value": "net",
    }
    sums = {name: or_zero(F.sum(c)) for name, c in totals.items()}
    return few_in_order(days, ["day_num"], **sums).select(
        "day_num",
        F.col("day_name").alias("day_of_week"),
        F.round(or_zero(F.col("sales")), 2).alias("sales_value"),
        *totals,
    )


# --- deliveries per weekday -------------------------------------------------------------


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def deliveries_per_weekday(t: Tables, p: ReportParams) -> DataFrame:
    """Seven rows with the day's deliveries, the period's total and the previous total.

    The period's total shows 0 on a day without deliveries: that is the report's rule.
    """
    now = F.col("current")
    per_store = (
        _deliveries(t, p)
        .groupBy("store_id", iso_weekday(_time()).alias("day_num"))
        .agg(F.count(F.when(now, F.col("id"))).alias("n"), F.count(F.when(~now, F.col("id"))).alias("old_n"))
    )
    per_day = (
        with_store(per_store, store_ids(t.stores, p, _live()))
        .groupBy("day_num")
        .agg(F.sum("n").alias("n"), F.sum("old_n").alias("old_n"))
    )
    daily = or_zero(F.col("n"))
    sums = {"_all": F.sum("n"), "_old": or_zero(F.sum("old_n"))}
    return few_in_order(on_every_weekday(per_day), ["day_num"], **sums).select(
        "day_num",
        F.col("day_name").alias("day_of_week"),
        daily.alias("daily_deliveries"),
        F.when(daily > 0, F.col("_all")).otherwise(F.lit(0)).alias("total_current"),
        F.col("_old").alias("total_previous"),
    )
