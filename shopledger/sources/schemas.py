"""Column types of the business tables, as DDL text.

Money is ``decimal(18,2)`` (a bare ``decimal`` would drop the cents) and every
time is ``timestamp_ntz``, so the session time zone never takes part.
"""

SCHEMAS: dict[str, str] = {
    "sales_invoice_header": """
        id bigint, invoice_num string, store_id bigint, region_id int, customer_id bigint,
        company_id bigint, tenant_id bigint, legal_entity_id bigint, pos_id bigint,
        delivery_partner_id bigint, invoice_type string, payment_status string,
        fulfilment_type string, fulfilment_status string, source string,
        net_amount decimal(18,2), tax decimal(18,2), total_discount decimal(18,2),
        change_amount decimal(18,2), gross_amount decimal(18,2), invoice_amount decimal(18,2),
        invoice_date_time timestamp_ntz, on_in_transit_time timestamp_ntz,
        on_delivered_time timestamp_ntz""",
    "sales_invoice_lines": """
        invoice_id bigint, product_id bigint, net_amount decimal(18,2),
        quantity int, return_quantity int""",
    "sales_order_header": """
        id bigint, company_id bigint, tenant_id bigint, legal_entity_id bigint, store_id bigint,
        order_type string, net_amount decimal(18,2), order_date_time timestamp_ntz""",
    "payment_transactions": """
        id bigint, sales_invoice_header_id bigint, payment_method_type string,
        payment_method_id int, sub_payment_method_id bigint, amount decimal(18,2),
        transaction_status string""",
    "ent_customer": """
        id bigint, first_name string, last_name string, company_id bigint, tenant_id bigint,
        customer_class_id int, is_deleted boolean, customer_created_on timestamp_ntz""",
    "ent_stores": "id bigint, name string, city_id int, region_id int, is_deleted boolean",
    "ent_city": "id int, code string, name string, is_deleted boolean",
    "ent_payment_methods": "id int, name string, image string",
    "ent_sub_payment_method": "id int, name string, image string",
    "prd_products": """
        id bigint, short_name string, alt_short_name string, code string, image string,
        hex_code string, product_classification string, product_category_id int""",
    "prd_product_categories": "id int, name string, alt_name string",
    "feature_flags": """
        id int, feature_name string, enabled boolean, description string,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "query_stats": """
        query string, calls bigint, shared_blks_hit bigint, shared_blks_read bigint,
        temp_blks_read bigint, temp_blks_written bigint, total_exec_time double,
        mean_exec_time double, blk_read_time double, blk_write_time double, rows bigint""",
    "db_stats": """
        datname string, blks_hit bigint, blks_read bigint, tup_returned bigint,
        tup_fetched bigint""",
}
