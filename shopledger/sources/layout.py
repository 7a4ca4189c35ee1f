"""Writing the big tables so that scope and period filters skip data.

Invoices and orders are partitioned by company, tenant and month and sorted by legal
entity and time inside each file. Lines and payments are partitioned by the company,
tenant and month of their invoice and sorted by its id, so that a scoped report skips
them too. Optional: reports give the same rows on any layout.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.calendar import month_start

if TYPE_CHECKING:
    from shopledger.sources.tables import Tables

MONTH_COLUMN = "month_part"
INVOICE_COMPANY = "invoice_company_id"
INVOICE_TENANT = "invoice_tenant_id"

# Table -> its event time.
MONTHLY_TABLES = {
    "sales_invoice_header": "invoice_date_time",
    "sales_order_header": "order_date_time",
}

# Table of rows that belong to an invoice -> the column that holds its id.
INVOICE_KEYS = {
    "sales_invoice_lines": "invoice_id",
    "payment_transactions": "sales_invoice_header_id",
}

_PARTITIONS = ("company_id", "tenant_id", MONTH_COLUMN)
_OF_INVOICE = (INVOICE_COMPANY, INVOICE_TENANT, MONTH_COLUMN)


def _month(time_column: str):
    return F.to_date(month_start(F.col(time_column)))


def _write(frame: DataFrame, partitions: Sequence[str], order: Sequence[str], path: str, replace_all: bool) -> None:
    """One directory per value of ``partitions``.

    ``rebalance`` lets the adaptive planner cut a large directory into several files and
    merge small ones, so no single task writes a hot tenant.
    """
    (
        frame.hint("rebalance", *[F.col(c) for c in partitions])
        .sortWithinPartitions(*partitions, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_monthly(frame: DataFrame, time_column: str, path: str, *, replace_all: bool = True) -> None:
    """One directory per company, tenant and month; ``replace_all=False`` leaves other directories alone."""
    dated = frame.withColumn(MONTH_COLUMN, _month(time_column))
    _write(dated, _PARTITIONS, ["legal_entity_id", time_column], path, replace_all)


def write_of_invoices(
    frame: DataFrame, invoice_key: str, invoices: DataFrame, path: str, *, replace_all: bool = True
) -> None:
    """Rows of ``invoices`` by the company, tenant and month of their invoice.

    Rows without a known invoice go to a directory of their own (null values). With
    ``replace_all=False`` the directories written are replaced and others left alone, so
    ``frame`` must then hold all rows of each month it touches.
    """
    of_invoice = invoices.select(
        F.col("id").alias("_invoice"),
        F.col("company_id").alias(INVOICE_COMPANY),
        F.col("tenant_id").alias(INVOICE_TENANT),
        _month("invoice_date_time").alias(MONTH_COLUMN),
    )
    # An inner join, which can split an invoice with very many rows, and the rows it leaves out.
    known = frame.join(of_invoice, F.col(invoice_key) == F.col("_invoice")).drop("_invoice")
    ids = of_invoice.select("_invoice")
    unknown = frame.join(ids, F.col(invoice_key) == F.col("_invoice"), "left_anti")
    placed = known.unionByName(unknown, allowMissingColumns=True)
    _write(placed, _OF_INVOICE, [invoice_key], path, replace_all)


def write_tables(tables: Tables, directory: str) -> None:
    """All tables, so that the directory stands alone."""
    from shopledger.sources.schemas import SCHEMAS

    for name in SCHEMAS:
        path = f"{directory}/{name}"
        if name in MONTHLY_TABLES:
            write_monthly(tables[name], MONTHLY_TABLES[name], path)
        elif name in INVOICE_KEYS:
            write_of_invoices(tables[name], INVOICE_KEYS[name], tables.invoices, path)
        else:
            tables[name].write.mode("overwrite").parquet(path)


def write_months(tables: Tables, directory: str) -> None:
    """Adds or replaces the directories of the months that ``tables`` holds, and no others.

    Invoices, orders and the rows of these invoices; rows of no known invoice are left out,
    since their directory is shared by all months. Dimensions are not touched.
    """
    for name, time_column in MONTHLY_TABLES.items():
        write_monthly(tables[name], time_column, f"{directory}/{name}", replace_all=False)
    ids = tables.invoices.select(F.col("id").alias("_invoice"))
    for name, key in INVOICE_KEYS.items():
        own = tables[name].join(ids, F.col(key) == F.col("_invoice"), "left_semi")
        write_of_invoices(own, key, tables.invoices, f"{directory}/{name}", replace_all=False)


def write_bucketed(tables: Tables, database: str, buckets: int) -> None:
    """Invoices, lines and payments as catalog tables bucketed and sorted by invoice, the others as they are.

    A join of invoices with their lines or payments then needs no exchange. That has a price: a
    join without an exchange is not split by the adaptive planner, so an invoice with very many
    lines or payments is one task's work again. Meant for data known to have no such invoice;
    nothing uses it by itself. Read with ``Tables.from_catalog``.
    """
    from shopledger.sources.schemas import SCHEMAS

    keys = {"sales_invoice_header": "id", **INVOICE_KEYS}
    for name in SCHEMAS:
        writer = tables[name].write.mode("overwrite").format("parquet")
        if name in keys:
            # One task per bucket writes one file per bucket.
            writer = tables[name].repartition(buckets, keys[name]).write.mode("overwrite").format("parquet")
            writer = writer.bucketBy(buckets, keys[name]).sortBy(keys[name])
        writer.saveAsTable(f"{database}.{name}")
