"""Tables bucketed by invoice: joins without an exchange, and what that costs where one invoice is hot."""

import re

import pytest
from conftest import at
from pyspark.sql import functions as F
from test_plans import plan_of
from test_skew import hot, tight  # noqa: F401

from shopledger import ReportParams, Tables
from shopledger.plans import catalog, payments
from shopledger.sources.layout import write_bucketed

YEAR = ReportParams(at("1997-01-01 00:00:00"), at("1997-12-31 23:59:59"))


@pytest.fixture(scope="module")
def bucketed(spark, small):
    spark.sql("create database if not exists bucketed")
    write_bucketed(small, "bucketed", 4)
    yield Tables.from_catalog(spark, "bucketed")
    spark.sql("drop database bucketed cascade")


@pytest.mark.parametrize(
    "report", [lambda t: catalog.top_products(t, YEAR, "STANDARD_PRODUCT"), lambda t: payments.share_every_cash_row(t, YEAR, settled_only=True)]
)
def test_no_exchange_under_the_fact_join(tight, small, bucketed, report):  # noqa: F811
    frame = report(bucketed)
    rows = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [id" in plan or "SortMergeJoin [sales_invoice_header_id" in plan or "SortMergeJoin [invoice_id" in plan
    assert not re.search(r"Exchange hashpartitioning\((id|invoice_id|sales_invoice_header_id)#", plan)
    assert len(re.findall(r"SelectedBucketsCount: 4 out of 4", plan_of(frame))) >= 2
    assert rows == report(small).collect() != []


def test_a_hot_invoice_is_not_split_there(tight, hot):  # noqa: F811
    """Why the layout stays off by default: no exchange, so nothing to split."""
    tight.sql("create database if not exists hot_bucketed")
    try:
        for name, key in (("sales_invoice_header", "id"), ("sales_invoice_lines", "invoice_id")):
            hot[name].repartition(4, key).write.mode("overwrite").bucketBy(4, key).sortBy(key).saveAsTable(f"hot_bucketed.{name}")
        t = Tables(lambda name: tight.table(f"hot_bucketed.{name}") if name in ("sales_invoice_header", "sales_invoice_lines") else hot[name])
        year = ReportParams(at("2024-01-01 00:00:00"), at("2024-12-31 23:59:59"))
        over_buckets, over_files = (catalog.top_products(x, year, "STANDARD_PRODUCT") for x in (t, hot))
        assert over_buckets.collect() == over_files.collect()
        assert "skew=true" in plan_of(over_files) and "skew=true" not in plan_of(over_buckets)
        per_task = t.lines.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task * 3 >= t.lines.count()
    finally:
        tight.sql("drop database hot_bucketed cascade")
