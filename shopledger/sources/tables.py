"""Named access to the business tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopledger.sources.layout import INVOICE_COMPANY, INVOICE_KEYS, INVOICE_TENANT, MONTH_COLUMN, MONTHLY_TABLES
from shopledger.sources.schemas import SCHEMAS


class Tables:
    """The business tables, each loaded on first use."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, directory: str) -> Tables:
        """Tables stored as ``<directory>/<table>``, with fixed schemas (no inference job)."""

        def load(name: str) -> DataFrame:
            return spark.read.schema(SCHEMAS[name]).parquet(f"{directory}/{name}")

        return cls(load)

    @classmethod
    def from_layout(cls, spark: SparkSession, directory: str) -> Tables:
        """Tables written by ``layout.write_tables``: the big ones carry scope and month partitions."""

        def load(name: str) -> DataFrame:
            schema = SCHEMAS[name]
            if name in MONTHLY_TABLES:
                schema += f", {MONTH_COLUMN} date"
            if name in INVOICE_KEYS:
                schema += f", {INVOICE_COMPANY} bigint, {INVOICE_TENANT} bigint, {MONTH_COLUMN} date"
            return spark.read.schema(schema).parquet(f"{directory}/{name}")

        return cls(load)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Tables:
        """Tables of a catalog database."""
        return cls(lambda name: spark.table(f"{database}.{name}"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    @property
    def invoices(self) -> DataFrame:
        return self["sales_invoice_header"]

    @property
    def lines(self) -> DataFrame:
        return self["sales_invoice_lines"]

    @property
    def orders(self) -> DataFrame:
        return self["sales_order_header"]

    @property
    def payments(self) -> DataFrame:
        return self["payment_transactions"]

    @property
    def customers(self) -> DataFrame:
        return self["ent_customer"]

    @property
    def stores(self) -> DataFrame:
        return self["ent_stores"]

    @property
    def cities(self) -> DataFrame:
        return self["ent_city"]

    @property
    def payment_methods(self) -> DataFrame:
        return self["ent_payment_methods"]

    @property
    def sub_payment_methods(self) -> DataFrame:
        return self["ent_sub_payment_method"]

    @property
    def products(self) -> DataFrame:
        return self["prd_products"]

    @property
    def categories(self) -> DataFrame:
        return self["prd_product_categories"]
