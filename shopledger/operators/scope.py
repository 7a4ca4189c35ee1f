"""Turning report parameters into predicates on the big tables.

Predicates go straight on the base frame, below every join, window and aggregate,
so that they reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.calendar import ntz, within
from shopledger.params import Period, ReportParams
from shopledger.sources.layout import INVOICE_COMPANY, INVOICE_TENANT, MONTH_COLUMN

# Lists beside company and tenant, which every report with a scope takes.
OPTIONAL_LISTS = ("legal_entity_ids", "store_ids", "region_ids", "customer_class_ids", "driver_ids")


def takes(*lists: str) -> Callable:
    """Marks a report with the optional lists it applies; a call with any other list is refused."""

    def mark(report: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(report)
        def checked(t, p: ReportParams, *args, **kwargs) -> DataFrame:
            for name in OPTIONAL_LISTS:
                if getattr(p, name) and name not in lists:
                    raise ValueError(f"{report.__name__} does not take {name}")
            return report(t, p, *args, **kwargs)

        checked.takes = lists
        return checked

    return mark


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def among(column: str, ids: tuple[int, ...]) -> Column:
    """``column`` is in ``ids``; always true when ``ids`` is empty.

    One predicate at every length, so that a long list prunes partitions like a short
    one; it is handed over as text, not id by id.
    """
    return _in(column, ids) if ids else F.lit(True)


def _in(column: str, ids: Iterable[int]) -> Column:
    return F.expr(f"`{column}` in ({', '.join(str(int(i)) for i in sorted(set(ids)))})")


def keep_ids(frame: DataFrame, column: str, ids: tuple[int, ...]) -> DataFrame:
    """Rows whose ``column`` is in ``ids``; every row when ``ids`` is empty."""
    return frame.where(among(column, ids)) if ids else frame


def companies_of(p: ReportParams, column: str = "company_id") -> Column:
    """The requested companies, cut down to the allowed ones."""
    if p.allowed_company_ids is None:
        return among(column, p.company_ids)
    allowed = _in(column, p.allowed_company_ids) if p.allowed_company_ids else F.lit(False)
    return among(column, p.company_ids) & allowed


def company_scope(frame: DataFrame, p: ReportParams) -> DataFrame:
    return keep_ids(frame.where(companies_of(p)), "tenant_id", p.tenant_ids)


def scope(frame: DataFrame, p: ReportParams, *, legal_entity: bool = True) -> DataFrame:
    """Company, tenant, store and (unless switched off) legal entity."""
    scoped = keep_ids(company_scope(frame, p), "store_id", p.store_ids)
    return keep_ids(scoped, "legal_entity_id", p.legal_entity_ids) if legal_entity else scoped


def of_scoped_invoices(frame: DataFrame, p: ReportParams) -> DataFrame:
    """Lines or payments of invoices in the scope and period, where the layout tells.

    Only skips what the join with the scoped invoices would drop; a frame of another
    layout comes back as it is.
    """
    if INVOICE_COMPANY not in frame.columns:
        return frame
    kept = keep_ids(frame.where(companies_of(p, INVOICE_COMPANY)), INVOICE_TENANT, p.tenant_ids)
    return kept.where(_months(F.col(MONTH_COLUMN), p.period))


def in_periods(frame: DataFrame, time_column: str, *periods: Period) -> DataFrame:
    """Rows inside any of the periods; also prunes month partitions where there are any."""
    ts = F.col(time_column)
    kept = frame.where(any_of([within(ts, period) for period in periods]))
    if MONTH_COLUMN in frame.columns:
        month = F.col(MONTH_COLUMN)
        kept = kept.where(any_of([_months(month, period) for period in periods]))
    return kept


def before(frame: DataFrame, time_column: str, period: Period) -> DataFrame:
    """Rows from before the period, however old."""
    kept = frame.where(F.col(time_column) < ntz(period.start))
    if MONTH_COLUMN in frame.columns:
        kept = kept.where(F.col(MONTH_COLUMN) <= F.lit(period.start.date().replace(day=1)))
    return kept


def _months(month: Column, period: Period) -> Column:
    first, last = (d.date().replace(day=1) for d in (period.start, period.end))
    return month.between(F.lit(first), F.lit(last))


def scoped_invoices(invoices: DataFrame, p: ReportParams, *, legal_entity: bool = True) -> DataFrame:
    return in_periods(scope(invoices, p, legal_entity=legal_entity), "invoice_date_time", p.period)


def settled(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("payment_status").isNotNull())
