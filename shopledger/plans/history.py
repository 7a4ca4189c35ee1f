"""What earlier months come to, kept as published tables that each new or changed month is folded into."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.calendar import month_start
from shopledger.plans.payments import mismatches
from shopledger.sources.layout import MONTH_COLUMN
from shopledger.sources.published import Published, Version
from shopledger.sources.tables import Tables

# Buckets of customers: a month's fold rewrites only those that its new customers fall into.
BUCKETS = 64
FIRST_SCHEMA = "customer_id bigint, store_id bigint, first_purchase_date timestamp_ntz, bucket int"
MISMATCH_SCHEMA = "month_part date, total_mismatches bigint, total_gap_amount decimal(38,2), total_change_given decimal(38,2)"


def first_purchases(invoices: DataFrame) -> DataFrame:
    """The time of the first invoice of each customer at each store; NULL is a customer too."""
    first = invoices.groupBy("customer_id", "store_id").agg(F.min("invoice_date_time").alias("first_purchase_date"))
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)).cast("int")
    return first.where(F.col("first_purchase_date").isNotNull()).withColumn("bucket", bucket)


def fold_first_purchases(table: Published, invoices: DataFrame, job: str | None = None) -> Version:
    """Folds some invoices, such as those of a month, into a table of ``FIRST_SCHEMA`` partitioned by ``bucket``.

    Only rows that come first are written, beside what is there; the first time is the least
    of them. Folding the same invoices again changes no result, and with ``job`` it writes
    nothing. ``compact`` brings the table back to one row each.
    """

    def earlier(old: Version) -> tuple[DataFrame, tuple]:
        arriving = first_purchases(invoices)
        held = read_first(table, old).select("customer_id", "store_id", F.col("first_purchase_date").alias("_held"))
        same = [arriving[c].eqNullSafe(held[c]) for c in ("customer_id", "store_id")]
        late = arriving.join(held, [*same, F.col("_held") <= F.col("first_purchase_date")], "left_anti")
        return late, ()

    return table.change(earlier, job)


def read_first(table: Published, version: Version | None = None) -> DataFrame:
    """One row per customer and store."""
    rows = table.read(version)
    return rows.groupBy("customer_id", "store_id").agg(F.min("first_purchase_date").alias("first_purchase_date"))


def compact(table: Published) -> Version:
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)).cast("int")
    return table.change(lambda old: (read_first(table, old).withColumn("bucket", bucket), old.directories))


def _month():
    return F.to_date(month_start(F.col("invoice_date_time")))


def monthly_mismatches(t: Tables, months: Iterable[date] | None = None) -> DataFrame:
    """The payment reconciliation per month of the invoice, over all months or some.

    With the layout only these months' directories are read; invoices without a time are
    the month NULL, which is among them when ``months`` is not given.
    """
    chosen = t.invoices, t.payments
    if months is not None:
        wanted = sorted(set(months))
        invoices = chosen[0].where(_month().isin(wanted))
        chosen = tuple(f.where(F.col(MONTH_COLUMN).isin(wanted)) if MONTH_COLUMN in f.columns else f for f in (invoices, chosen[1]))
    found = mismatches(*chosen, also=[_month().alias(MONTH_COLUMN)])
    return found.groupBy(MONTH_COLUMN).agg(
        F.count(F.lit(1)).alias("total_mismatches"),
        F.sum("gap").cast("decimal(38,2)").alias("total_gap_amount"),
        F.sum("change_amount").cast("decimal(38,2)").alias("total_change_given"),
    )


def refresh_mismatches(table: Published, t: Tables, months: Iterable[date] | None = None, job: str | None = None) -> Version:
    """Computes some months again, or all, into a table of ``MISMATCH_SCHEMA`` partitioned by ``month_part``."""
    wanted = None if months is None else sorted(set(months))

    def renewed(old: Version) -> tuple[DataFrame, list[str]]:
        if wanted is None:
            return monthly_mismatches(t), list(old.directories)
        names = {f"{MONTH_COLUMN}={m.isoformat()}" for m in wanted}
        return monthly_mismatches(t, wanted), [d for d in old.directories if d.split("/")[0] in names]

    return table.change(renewed, job)


def reconciliation_total(monthly: DataFrame) -> DataFrame:
    """The whole reconciliation from its months."""
    return monthly.agg(
        F.coalesce(F.sum("total_mismatches"), F.lit(0)).alias("total_mismatches"),
        F.sum("total_gap_amount").alias("total_gap_amount"),
        F.sum("total_change_given").alias("total_change_given"),
    )
