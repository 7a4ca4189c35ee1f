"""The business tables derived from the test tables, as SQL that Spark and DuckDB share.

Money is cast to ``decimal(18,2)`` before any arithmetic. ``TSNTZ`` stands for the
zone-free timestamp type, which the two engines name differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopledger import Tables

# The test tables' own columns, given so that reading them needs no inference job.
SOURCES: dict[str, str] = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Business table -> the test tables it reads. Those without one are short fixed lookups.
READS: dict[str, tuple[str, ...]] = {
    "sales_invoice_header": ("orders",),
    "sales_invoice_lines": ("lineitem",),
    "sales_order_header": ("orders",),
    "payment_transactions": ("events",),
    "ent_customer": ("customer",),
    "ent_stores": ("supplier", "nation"),
    "ent_city": ("nation",),
    "ent_payment_methods": (),
    "ent_sub_payment_method": (),
    "prd_products": ("part",),
    "prd_product_categories": (),
    "feature_flags": (),
    "query_stats": ("events",),
    "db_stats": ("events",),
}

DERIVATIONS: dict[str, str] = {
    "sales_invoice_header": """
        select o_orderkey as id, o_custkey % 100 as store_id,
        case when o_orderkey % 23 = 0 then null else o_custkey end as customer_id, o_orderkey % 2 + 1 as company_id,
        o_orderkey % 3 % 2 + 1 as tenant_id, o_orderkey % 5 + 1 as legal_entity_id, o_orderkey % 6 as pos_id,
        case when o_custkey % 8 = 0 then null else o_custkey % 30 end as delivery_partner_id,
        case when o_orderstatus = 'P' then 'RETURNS' when o_orderkey % 11 = 0 then 'QUOTE' else 'SALES' end as invoice_type,
        case when o_orderkey % 7 = 0 then null else 'PAID' end as payment_status,
        case when o_orderpriority in ('1-URGENT','2-HIGH') then 'DELIVERY' when o_orderpriority = '3-MEDIUM' then 'HOME_DELIVERY' else 'PICKUP' end as fulfilment_type,
        case when o_orderkey % 3 = 0 then 'PENDING' else 'DELIVERED' end as fulfilment_status,
        cast(o_totalprice as decimal(18,2)) as net_amount,
        cast(case when o_orderkey % 9 = 0 then null else cast(o_totalprice as decimal(18,2)) * cast(0.15 as decimal(3,2)) end as decimal(18,2)) as tax,
        cast(cast(o_totalprice as decimal(18,2)) * cast(0.05 as decimal(3,2)) as decimal(18,2)) as total_discount,
        cast(case when o_orderkey % 4 = 0 then null else o_orderkey % 20 end as decimal(18,2)) as change_amount,
        cast(o_totalprice as decimal(18,2)) as gross_amount,
        case when o_orderkey % 2 = 0 then 'POS' else 'WEB' end as source,
        cast(cast(o_totalprice as decimal(18,2)) * cast(1.15 as decimal(3,2)) as decimal(18,2)) as invoice_amount,
        o_orderdate + (o_orderkey * 37 % 1440) * interval '1' minute as invoice_date_time,
        case when o_orderkey % 13 = 0 then null else o_orderdate + (o_orderkey * 37 % 1440 + 10) * interval '1' minute end as on_in_transit_time,
        o_orderdate + (o_orderkey * 37 % 1440 + 5 + o_orderkey % 90) * interval '1' minute as on_delivered_time from orders""",
    "sales_invoice_lines": """
        select l_orderkey as invoice_id, l_partkey as product_id,
        cast(l_extendedprice as decimal(18,2)) as net_amount, cast(l_quantity as int) as quantity,
        case when l_returnflag = 'R' then cast(l_quantity as int) else 0 end as return_quantity from lineitem""",
    "sales_order_header": """
        select o_orderkey as id, o_orderkey % 2 + 1 as company_id, o_orderkey % 3 % 2 + 1 as tenant_id,
        o_orderkey % 5 + 1 as legal_entity_id, o_custkey % 100 as store_id,
        case when o_orderkey % 10 = 3 then 'LOST_SALES' else 'NORMAL' end as order_type,
        cast(o_totalprice as decimal(18,2)) as net_amount,
        o_orderdate + (o_orderkey * 53 % 1440) * interval '1' minute as order_date_time from orders""",
    "payment_transactions": """
        select event_id as id, cast((event_id - event_id % 3) / 3 as bigint) as sales_invoice_header_id,
        case event_type when 'view' then 'CASH' when 'purchase' then 'CASH' when 'click' then 'CARD' when 'signup' then 'ON_ACCOUNT' else case when event_id % 40 = 0 then null else 'BANK_TRANSFER' end end as payment_method_type,
        case event_type when 'view' then 1 when 'purchase' then 1 when 'click' then 2 when 'signup' then 3 else null end as payment_method_id,
        case when event_type = 'click' and event_id % 4 <> 0 then event_id % 4 else null end as sub_payment_method_id,
        cast(value as decimal(18,2)) as amount,
        case when event_id % 10 = 0 then 'FAILED' else 'PAID' end as transaction_status from events""",
    "ent_customer": """
        select c_custkey as id, substring(c_name, 1, 8) as first_name,
        case when c_custkey % 6 = 0 then null else substring(c_name, 10, 9) end as last_name,
        c_custkey % 2 + 1 as company_id, c_custkey % 3 % 2 + 1 as tenant_id,
        case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2 when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 else 5 end as customer_class_id,
        case when c_custkey % 19 = 0 then null else c_acctbal < 0 end as is_deleted,
        cast('1994-06-01 00:00:00' as TSNTZ) + (c_custkey % 2500) * interval '1' day as customer_created_on from customer""",
    "ent_stores": """
        select s_suppkey as id, s_name as name,
        case when s_suppkey % 29 = 7 then null else s_nationkey end as city_id, n_regionkey as region_id,
        case when s_suppkey % 17 = 0 then true when s_suppkey % 5 = 0 then null else false end as is_deleted from supplier join nation on s_nationkey = n_nationkey""",
    "ent_city": """
        select n_nationkey as id, concat('C', cast(n_nationkey as varchar(8))) as code, n_name as name,
        case when n_nationkey = 4 then true when n_nationkey % 6 = 5 then null else false end as is_deleted from nation""",
    "ent_payment_methods": """
        select * from (values (1,'CASH','cash.png'),(2,'CARD','card.png'),(3,'ON_ACCOUNT','acct.png')) as t(id,name,image)""",
    "ent_sub_payment_method": """
        select * from (values (1,'VISA','visa.png'),(2,'MASTERCARD','mc.png')) as t(id,name,image)""",
    "prd_products": """
        select p_partkey as id, p_name as short_name,
        case when p_partkey % 4 = 0 then null else p_brand end as alt_short_name,
        concat('P', cast(p_partkey as varchar(12))) as code, concat(p_brand, '.png') as image,
        case when p_partkey % 9 = 0 then null else '#00FF00' end as hex_code,
        case when p_size % 5 = 0 then 'SERVICE_PRODUCT' else 'STANDARD_PRODUCT' end as product_classification,
        case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 when 'PROMO' then 4 when 'SMALL' then 5 else 6 end as product_category_id from part""",
    "prd_product_categories": """
        select * from (values (1,'ECONOMY','Eco'),(2,'LARGE',null),(3,'MEDIUM','Med'),(4,'PROMO','Pro'),(5,'SMALL','Sml'),(6,'STANDARD','Std')) as t(id,name,alt_name)""",
    "feature_flags": """
        select * from (values (1,'dashboard_v2_enabled',true,'seed'),(2,'Brand#1',false,'seed')) as t(id,feature_name,enabled,description)""",
    "query_stats": """
        select concat(event_type, '-', cast(user_id as varchar(12))) as query, count(*) as calls,
        sum(event_id % 1000) as shared_blks_hit,
        sum(case when event_type = 'view' then 0 else event_id % 17 end) as shared_blks_read,
        sum(event_id % 5) as temp_blks_read,
        sum(case when event_id % 50 = 0 then event_id % 31 else 0 end) as temp_blks_written,
        cast(sum(cast(value as decimal(18,2))) as double) as total_exec_time,
        cast(sum(cast(value as decimal(18,2))) as double) / count(*) as mean_exec_time,
        cast(sum(event_id % 11) as double) as blk_read_time, cast(sum(event_id % 3) as double) as blk_write_time,
        sum(event_id % 97) as rows from events group by event_type, user_id""",
    "db_stats": """
        select event_type as datname, sum(event_id % 100) as blks_hit, sum(event_id % 7) as blks_read,
        sum(event_id % 1000) as tup_returned, sum(event_id % 500) as tup_fetched from events group by event_type""",
}


def in_duckdb(name: str) -> str:
    return DERIVATIONS[name].replace("TSNTZ", "timestamp")


def source(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{directory}/{name}.parquet")


def fixture_tables(spark: SparkSession, directory: str) -> Tables:
    """The business tables over the test parquet in ``directory``."""

    def load(name: str) -> DataFrame:
        sources = {s: source(spark, directory, s) for s in READS[name]}
        sql = DERIVATIONS[name].replace("TSNTZ", "timestamp_ntz")
        for table in sources:
            sql = sql.replace(f"from {table}", f"from {{{table}}}").replace(f"join {table}", f"join {{{table}}}")
        return spark.sql(sql, **sources)

    return Tables(load)
