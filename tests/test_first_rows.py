"""A look at a view by its smallest base rows: whole results, whatever the joins drop, and bounded joins."""

import re

import pytest
from pyspark.sql import functions as F

from shopledger import Tables
from shopledger.operators.ranking import PLACE, first_rows
from shopledger.plans import views
from shopledger.sources.schemas import SCHEMAS


def shown(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture(scope="module")
def plain(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plain"))
    for name in SCHEMAS:
        small[name].write.parquet(f"{folder}/{name}")
    return Tables.from_parquet(spark, folder)


# The joins keep every 2nd, 100th, 4000th or none of 10,000 base rows: found at once, wider, or in the whole view.
@pytest.mark.parametrize("step", [2, 100, 4000, 20000])
def test_rows_that_the_joins_drop(spark, step):
    base = spark.range(1, 10_001).select((F.lit(10_001) - F.col("id")).alias("key"), (F.col("id") % 7).alias("x"))
    kept = spark.range(0, 10_001, step).where("id > 0").select(F.col("id").alias("key"))
    found = first_rows(base, ("key",), lambda rows: rows.join(kept, "key").select("x", "key", PLACE), widths=(64, 1024))
    assert shown(found) == [((10_001 - key) % 7, key) for key in range(step, 10_001, step)][:10]


def test_several_rows_of_a_base_row(spark):
    base = spark.createDataFrame([(2,), (1,), (None,)], "key long")
    many = spark.range(1000).select((F.col("id") % 2 + 1).alias("key"), F.col("id").alias("n"))
    found = first_rows(base, ("key",), lambda rows: rows.join(many, "key").select("key", "n", PLACE))
    assert shown(found) == [(1, n) for n in range(0, 20, 2)]


def test_nulls_last_repeated_rows_and_nothing(spark):
    base = spark.createDataFrame([(None, 1), (3, None), (3, None), (3, 0), (1, 5)], "a long, b long")
    look = lambda rows: rows.select("a", "b", PLACE)
    assert shown(first_rows(base, ("a", "b"), look, 4)) == [(1, 5), (3, 0), (3, None), (3, None)]
    assert shown(first_rows(base, ("a", "b"), look, 9))[-1] == (None, 1)
    assert shown(first_rows(base.limit(0), ("a", "b"), look)) == []


def test_one_invoice_with_most_lines(spark, plain):
    """Lines of one invoice are told apart by their own columns, so a hot one is cut too."""
    low = plain.invoices.where(views.is_sale_or_return()).agg(F.min("id")).first()[0]
    extra = spark.range(20_000).select(
        F.lit(low).alias("invoice_id"), (F.col("id") % 2000 + 1).alias("product_id"),
        (F.col("id") % 97).cast("decimal(18,2)").alias("net_amount"), F.lit(1).alias("quantity"), F.lit(0).alias("return_quantity"),
    )
    hot = Tables(lambda name: plain[name].unionByName(extra) if name == "sales_invoice_lines" else plain[name])
    whole = views.service_product_sales(
        hot.invoices, hot.lines.withColumn("_line", F.struct(*views._LINE)), hot.products, keep=("_line",)
    )
    want = shown(whole.orderBy("_line").limit(10).drop("_line"))
    assert shown(views.FIRST["v_product_sales_enriched"](hot)) == want


@pytest.mark.parametrize("name", sorted(views.FIRST))
def test_listed_table_is_held_and_others_are_not_shuffled(plain, name):
    frame = views.FIRST[name](plain)
    assert frame.columns == views.VIEWS[name](plain).columns
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "LocalTableScan" in final
    listed = "sales_invoice_lines" if "product" in name or "category" in name else "payment_transactions" if "payment" in name else None
    if listed:
        assert listed not in final
        # Invoices are read once and meet the held rows where they are read.
        assert len(re.findall(r"FileScan[^\n]*sales_invoice_header", final)) <= 2
        assert "Exchange hashpartitioning(id" not in final and "Exchange hashpartitioning(invoice_id" not in final
