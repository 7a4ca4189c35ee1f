import pytest

from shopledger import Tables
from shopledger.plans import querylog, views
from shopledger_checks.oracle import VIEW_COLUMNS


def test_register_replace_and_drop(spark, small):
    names = views.register(spark, small)
    assert names == views.register(spark, small)
    for name in names:
        assert spark.catalog.tableExists(name)
    current = spark.table("view_sales_by_payment_rows")
    assert current.columns == spark.table("view_sales_by_payment_rows_v2").columns
    got = spark.sql("select sum(net_amount) from view_dashboard_master_analytics").first()[0]
    assert got == spark.sql("select sum(net_amount) from view_dashboard_sales_summary").first()[0]
    views.drop(spark)
    views.drop(spark)
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_every_view_has_rows(small):
    for name, build in views.VIEWS.items():
        assert not build(small).isEmpty(), name


def test_own_table_is_not_load(made):
    t = made(
        query_stats=[
            {"query": "select pg_stat_statements", "calls": 1, "shared_blks_hit": 9, "shared_blks_read": 9, "rows": 1},
            {"query": "a", "calls": 2, "shared_blks_hit": 1, "shared_blks_read": 2, "rows": 5},
            {"query": "b", "calls": 2, "shared_blks_hit": 0, "shared_blks_read": 0, "rows": 3},
        ],
        db_stats=[{"datname": "x", "blks_hit": 2, "blks_read": 1, "tup_returned": 9, "tup_fetched": 4}, {"datname": "y"}],
    )
    rows = querylog.cache_hits(t).collect()
    assert [(r["query"], r.hit_ratio_pct if r.hit_ratio_pct is None else float(r.hit_ratio_pct)) for r in rows] == [("a", 33.33), ("b", None)]
    assert [(r["query"], r.rows_per_call) for r in querylog.rows_per_call(t).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in querylog.database_cache(t, "x").collect()] == [("x", 66, 9, 4, 5)]


def test_tables_of_a_catalog(spark, small):
    spark.sql("create database if not exists shop")
    small.cities.write.mode("overwrite").saveAsTable("shop.ent_city")
    assert Tables.from_catalog(spark, "shop").cities.count() == 25
    spark.sql("drop database shop cascade")


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_columns_come_in_the_documented_order(small, name):
    assert views.VIEWS[name](small).columns == VIEW_COLUMNS[name]
