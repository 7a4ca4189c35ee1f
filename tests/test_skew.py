"""One key holding a third of all rows: results stay right and the work is spread."""

from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F
from test_plans import plan_of

from shopledger import ReportParams, Tables
from shopledger.plans import catalog, loyalty, payments, views

N = 60_000
YEAR = ReportParams(at("2024-01-01 00:00:00"), at("2024-12-31 23:59:59"))

# Thresholds that make a few kilobytes count as large.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    for key, value in SMALL_SCALE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark, tmp_path):
    """Tables in which invoice 7, product 7, customer NULL and store 7 hold a third each."""
    i = F.col("id")
    third = i % 3 == 0
    money = (i % 100 + 1).cast("decimal(18,2)")
    invoices = spark.range(N).select(
        i,
        F.when(third, 7).otherwise(i % 500).cast("bigint").alias("store_id"),
        F.when(~third, i % 1000).cast("bigint").alias("customer_id"),
        F.lit(1).cast("bigint").alias("company_id"),
        F.lit(1).cast("bigint").alias("tenant_id"),
        F.lit(1).cast("bigint").alias("legal_entity_id"),
        F.lit("SALES").alias("invoice_type"),
        F.lit("PAID").alias("payment_status"),
        money.alias("net_amount"),
        F.lit(1).cast("decimal(18,2)").alias("change_amount"),
        F.expr("timestamp_ntz'2023-12-01 00:00:00' + (id % 300) * interval '1' day").alias("invoice_date_time"),
    )
    lines = spark.range(N).select(
        F.when(third, 7).otherwise(i).cast("bigint").alias("invoice_id"),
        F.when(i % 3 == 1, 7).otherwise(i % 1000).cast("bigint").alias("product_id"),
        money.alias("net_amount"),
        F.lit(1).alias("quantity"),
        F.lit(0).alias("return_quantity"),
    )
    paid = spark.range(N).select(
        i,
        F.when(third, 7).otherwise(i).cast("bigint").alias("sales_invoice_header_id"),
        F.when(i % 2 == 0, "CASH").otherwise("CARD").alias("payment_method_type"),
        F.when(i % 2 == 0, 1).cast("int").alias("payment_method_id"),
        F.lit(None).cast("bigint").alias("sub_payment_method_id"),
        money.alias("amount"),
        F.lit("PAID").alias("transaction_status"),
    )
    stores = spark.range(500).select(i, F.lit(1).alias("region_id"), F.lit(1).alias("city_id"), F.lit(False).alias("is_deleted"))
    products = spark.range(1000).select(
        i, F.lit("STANDARD_PRODUCT").alias("product_classification"), F.lit(1).alias("product_category_id"),
        *[F.lit("x").alias(c) for c in ("short_name", "alt_short_name", "code", "image", "hex_code")],
    )
    lookup = spark.sql("select 1 as id, 'CASH' as name, 'c' as image")
    frames = {
        "sales_invoice_header": invoices, "sales_invoice_lines": lines, "payment_transactions": paid, "ent_stores": stores,
        "prd_products": products, "prd_product_categories": spark.sql("select 1 as id, 'all' as name, 'a' as alt_name"),
    }
    for name, frame in frames.items():
        frame.repartition(16).write.parquet(f"{tmp_path}/{name}")
    stored = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in frames}
    return Tables(lambda name: stored.get(name, lookup))


def test_hot_invoice_is_split_in_the_line_join(tight, hot):
    frame = catalog.top_products(hot, YEAR, "STANDARD_PRODUCT")
    rows = frame.collect()
    assert "skew=true" in plan_of(frame)
    day = F.col("id") % 300
    in_year = tight.range(N).where((day >= 31))  # December 2023 is outside
    assert rows[0].id == 7
    lines = hot.lines.join(in_year.select(F.col("id").alias("invoice_id")), "invoice_id")
    naive = lines.where("product_id = 7").agg(F.sum("net_amount"), F.sum("quantity")).first()
    # Invoice 7 itself falls on 8 December 2023, so its lines are outside too.
    assert (rows[0].amount, rows[0].qty) == (float(naive[0]), naive[1])


def test_hot_invoice_is_split_in_the_payment_view(tight, hot):
    everything = views.payment_rows(hot.invoices, hot.payments, hot.payment_methods, hot.payment_methods, "v2")
    total = everything.agg(F.sum("amount")).first()[0]
    first_cash = hot.payments.where("payment_method_type = 'CASH'").select("sales_invoice_header_id").distinct().count()
    assert total == hot.payments.agg(F.sum("amount")).first()[0] - first_cash
    everything.write.format("noop").mode("overwrite").save()
    frame = everything.agg(F.sum("amount"))
    frame.collect()
    assert "skew=true" in plan_of(frame)


def test_hot_invoice_is_merged_before_the_payment_window(tight, hot):
    whole = YEAR.but(from_ts=at("2020-01-01 00:00:00"))
    rows = payments.share_first_cash_row(hot, whole, negative_returns=False).collect()
    cash = hot.payments.where("payment_method_type = 'CASH'")
    expected = cash.agg(F.sum("amount")).first()[0] - cash.select("sales_invoice_header_id").distinct().count()
    assert {r["name"]: r["amount"] for r in rows}["CASH"] == expected


def test_walk_in_customers_are_split_in_the_first_date_join(tight, hot):
    view = views.customer_loyalty(hot.invoices, hot.stores)
    frame = view.groupBy("first_purchase_date").agg(F.count("*").alias("n"))
    assert sum(r.n for r in frame.collect()) == N
    assert "skew=true" in plan_of(frame)


def test_walk_in_customers_in_the_pie(tight, hot):
    frame = loyalty.pie_by_first_date(hot, YEAR)
    rows = {r.customer_id: r for r in frame.collect()}
    # Store 7 holds a third of the invoices, and its semi join is split.
    assert "skew=true" in plan_of(frame)
    assert rows[None].customertype == "Existing Customer"
    naive = hot.invoices.where("customer_id is null and invoice_date_time >= timestamp_ntz'2024-01-01 00:00:00'")
    assert rows[None].sales == naive.agg(F.sum("net_amount")).first()[0] > Decimal(0)


def test_busy_customer_is_split_in_the_activity_view(tight, hot):
    i = F.col("id")
    busy = hot.invoices.withColumn("customer_id", F.coalesce("customer_id", F.lit(7).cast("bigint")))
    people = tight.range(2000).select(
        i, F.lit(False).alias("is_deleted"), F.lit(None).cast("timestamp_ntz").alias("customer_created_on"),
        F.lit(1).alias("company_id"), F.lit(1).alias("tenant_id"),
    )
    frame = views.customer_activity(people, busy).groupBy("payment_status").agg(F.count("*").alias("n"))
    idle = 2000 - busy.select("customer_id").distinct().count()
    assert {r.payment_status: r.n for r in frame.collect()} == {"PAID": N, None: idle}
    assert "skew=true" in plan_of(frame)
