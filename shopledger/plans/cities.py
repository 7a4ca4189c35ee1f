"""Delivery orders per city and month, for the five cities with the most orders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.amounts import SALES
from shopledger.functions.calendar import iso_text, month_name, month_start
from shopledger.functions.flags import known_live, live_unless_deleted
from shopledger.operators.documents import as_json, list_by, null_if_empty
from shopledger.operators.ranking import largest_first, smallest_first, top
from shopledger.operators.scope import keep_ids, scoped_invoices, settled, takes
from shopledger.params import ReportParams
from shopledger.sources.tables import Tables

TOP_CITIES = 5


@dataclass(frozen=True)
class Form:
    """What sets the forms of the report apart."""

    strict: bool = False  # an unknown deletion flag drops the store or city
    settled_only: bool = False
    empty_list: bool = True  # no month gives [] rather than null


def _live(form: Form) -> Column:
    flag = F.col("is_deleted")
    return known_live(flag) if form.strict else live_unless_deleted(flag)


def _city_months(t: Tables, p: ReportParams, form: Form) -> DataFrame:
    """Orders per city and month.

    Counted per store and month first, so that stores and cities join counts only.
    """
    invoices = keep_ids(scoped_invoices(t.invoices, p), "delivery_partner_id", p.driver_ids).where(
        (F.col("fulfilment_type") == "DELIVERY") & (F.col("invoice_type") == SALES)
    )
    if form.settled_only:
        invoices = settled(invoices)
    per_store = invoices.groupBy("store_id", month_start(F.col("invoice_date_time")).alias("order_month")).agg(
        F.count("id").alias("orders")
    )
    stores = keep_ids(t.stores, "region_id", p.region_ids).where(_live(form))
    cities = t.cities.where(_live(form)).select(
        F.col("id").alias("city_id"), F.col("code").alias("city_code"), F.col("name").alias("city_name")
    )
    located = stores.select(F.col("id").alias("store_id"), "city_id").join(cities, "city_id")
    return (
        per_store.join(located, "store_id")
        .groupBy("city_id", "city_code", "city_name", "order_month")
        .agg(F.sum("orders").alias("order_count"))
    )


def _top_cities(months: DataFrame) -> DataFrame:
    """The cities with the most orders, each with its months (as many as the calendar has)."""
    totals = months.groupBy("city_id", "city_code", "city_name").agg(
        F.sum("order_count").alias("total_orders"),
        F.collect_list(F.struct("order_month", "order_count")).alias("months"),
    )
    return top(totals, TOP_CITIES, largest_first("total_orders"), smallest_first("city_id"))


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def monthly_rows(t: Tables, p: ReportParams) -> DataFrame:
    """A row per month and top city."""
    rows = _top_cities(_city_months(t, p, Form())).select("city_id", "city_code", "city_name", F.inline("months"))
    return rows.select(
        "city_id",
        "city_code",
        "city_name",
        iso_text(F.col("order_month")).alias("order_month_str"),
        F.col("order_month").alias("order_month_raw"),
        "order_count",
    ).orderBy("order_month_raw", "city_id")


@takes("legal_entity_ids", "store_ids", "region_ids", "driver_ids")
def monthly_document(t: Tables, p: ReportParams, form: Form = Form()) -> DataFrame:
    """The same as one JSON document: the cities, and per month a city-to-orders object.

    Cities of the same name share one member of that object.
    """
    city = F.struct(
        F.col("city_id").alias("id"), F.col("city_code").alias("code"), F.col("city_name").alias("name"), "total_orders"
    )
    rank = F.struct(-F.col("total_orders"), F.col("city_id"))
    named = F.transform("months", lambda m: F.struct(m["order_month"].alias("month"), F.col("city_name").alias("name"), m["order_count"].alias("n")))
    # Five rows, each with its months: one aggregate folds both lists.
    folded = _top_cities(_city_months(t, p, form)).agg(
        null_if_empty(F.transform(list_by(rank, city.alias("city")), lambda c: c["city"])).alias("cities"),
        F.flatten(F.collect_list(named)).alias("counts"),
    )
    months = F.sort_array(F.array_distinct(F.transform("counts", lambda c: c["month"])))
    listed = F.transform(
        months,
        lambda month: F.struct(
            month_name(month).alias("month"), iso_text(month).alias("date"), _orders_by_name(month).alias("orders")
        ),
    )
    if not form.empty_list:
        listed = null_if_empty(listed)
    return folded.select(as_json(F.struct("cities", listed.alias("monthly_data"))).alias("result"))


def _orders_by_name(month: Column) -> Column:
    """Orders of a month by city name, names in order; five at most."""
    own = F.filter("counts", lambda c: c["month"] == month)
    names = F.sort_array(F.array_distinct(F.transform(own, lambda c: c["name"])))

    def total(name: Column) -> Column:
        counts = F.filter("counts", lambda c: (c["month"] == month) & c["name"].eqNullSafe(name))
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c["n"])

    return F.map_from_entries(F.transform(names, lambda name: F.struct(name, total(name))))
