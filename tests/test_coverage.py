
from shopledger_checks.registry import all_queries
from shopledger.plans.views import FIRST, VIEWS

COVERED = {
    # scans, sources, sinks
    "S1": "sales_data_kpis category_sales_top5 payment_share_preagg customer_counts_cte top_cities_monthly",
    "S2": "sales_data_invoice_rows", "S3": " ".join([*(f"preview_{v}" for v in VIEWS), *(f"first_{v}" for v in FIRST)]), "S4": "financial_summary_weekday",
    "S5": "financial_summary_json total_deliveries_weekday", "S6": "feature_flags_insert_if_absent stores_insert_if_absent stores_insert_published",
    # views
    "V1": "v_product_sales_enriched", "V2": "view_sales_graph_analytics", "V3": "view_sales_invoice_analytics",
    "V4": "view_dashboard_lost_sales", "V5": "view_sales_by_customer_rows", "V6": "view_category_sales_rows",
    "V7": "view_customer_loyalty_analytics", "V8a": "view_sales_by_payment_rows_v1",
    "V8b": "view_sales_by_payment_rows_v2", "V8c": "view_sales_by_payment_rows_v3",
    "V9": "view_dashboard_sales_summary", "V10a": "view_dashboard_master_analytics",
    "V10b": "view_dashboard_master_analytics_with_lost", "V11": " ".join(VIEWS),
    # reports
    "R1a": "sales_data_kpis sales_data_kpis_settled", "R1b": "sales_data_kpis_avg sales_data_kpis_avg_with_lost",
    "R1c": "sales_data_net_raw", "R1d": "lost_sales_total", "R1e": "gross_sales_total", "R1f": "gross_returns_net",
    "R1g": "sales_data_year_over_year", "R2a": "payment_share_preagg",
    "R2b": "payment_share_view_v1 payment_share_view_v2 payment_share_view_v3", "R2c": "payment_share_raw",
    "R2d": "payment_reconciliation payment_reconciliation_monthly", "R2e": "net_cash_collected", "R2f": "collection_breakdown",
    "R3a": "customer_pie_exists", "R3b": "customer_pie_first_date customer_pie_folded_history", "R3c": "customer_pie_exists_loose",
    "R3d": "customer_invoice_first_date", "R4a": "customer_counts_cte", "R4b1": "customer_base_counts",
    "R4b2": "customer_activity_counts", "R4c": "customer_counts_activity_view view_customer_activity_summary",
    "R4d": "customer_counts_subqueries", "R5a": "category_sales_header_amount", "R5b": "category_sales_top5",
    "R6a": "customer_sales_all", "R6b": "customer_sales_top5", "R6c": "customer_sales_top5_raw",
    "R7a": "top_products_standard", "R7b": "top_products_service", "R8a": "sales_graph_monthly",
    "R8b": "sales_graph_monthly_view", "R9a": "avg_delivery_time_json", "R9b": "avg_delivery_time_hourly",
    "R10a": "financial_summary_json", "R10b": "financial_summary_weekday", "R11a": "top_cities_monthly_json",
    "R11b": "top_cities_monthly", "R11c": "top_cities_monthly_json_strict", "R11d": "top_cities_monthly_json_paid",
    "R12": "total_deliveries_weekday", "R13": "financial_summary_weekday total_deliveries_weekday",
    # parameters
    "P1": "sales_data_kpis_scoped", "P2": "sales_data_kpis", "P3": "sales_data_kpis_region payment_share_view_v2_region category_sales_top5_region top_products_standard_region sales_data_kpis_settled_scoped avg_delivery_time_json_scoped customer_sales_top5_scoped",
    "P4": "sales_data_kpis_avg_with_lost_scoped", "P5": "financial_summary_json_scoped", "P6": "sales_data_kpis_avg_with_lost_scoped",
    "P7": "avg_delivery_time_hourly_scoped total_deliveries_weekday_scoped", "P8": "sales_data_year_over_year_scoped",
    "P9": "category_sales_top5_scoped", "P10": "top_cities_monthly",
    # projections and predicates
    "F1": "view_sales_invoice_analytics", "F2": "view_sales_graph_analytics", "F3": "total_deliveries_weekday",
    "F4": "customer_base_counts top_cities_monthly_json_strict", "F5": "sales_data_invoice_rows", "F6": "collection_breakdown financial_summary_json",
    "F7": "customer_pie_exists avg_delivery_time_json", "F8": "sales_data_kpis_scoped", "F9": "log_cache_hit",
    "F10": "view_sales_by_payment_rows_v2", "F11": "sales_data_kpis", "F12": "top_products_standard",
    "F13": "view_dashboard_master_analytics_with_lost", "F14": "view_dashboard_sales_summary", "F15": "avg_delivery_time_json",
    # joins
    "J1": "category_sales_top5 payment_share_raw", "J2": "view_sales_by_customer_rows top_cities_monthly",
    "J3": "total_deliveries_weekday", "J4": "customer_pie_exists financial_summary_json", "J5": "top_cities_monthly_json",
    "J6": "payment_share_raw", "J7": "financial_summary_weekday", "J8": "payment_reconciliation",
    "J9": "customer_counts_cte avg_delivery_time_json", "J10": "financial_summary_json", "J11": "total_deliveries_weekday avg_delivery_time_hourly",
    "J12": "avg_delivery_time_json", "J13": "customer_counts_cte top_cities_monthly", "J14": "customer_pie_exists customer_pie_exists_loose",
    # aggregates
    "A1": "category_sales_top5", "A2": "sales_data_kpis_avg", "A3": "gross_returns_net", "A4": "customer_counts_cte top_cities_monthly",
    "A5": "sales_data_kpis", "A6": "customer_counts_activity_view", "A7": "net_cash_collected collection_breakdown",
    "A8": "avg_delivery_time_json", "A9": "customer_pie_first_date", "A10": "customer_base_counts customer_activity_counts",
    "A11": "financial_summary_json top_cities_monthly_json payment_share_preagg", "A12": "sales_graph_monthly avg_delivery_time_hourly",
    "A13": "payment_share_raw", "A14": "top_products_standard", "A15": "top_cities_monthly_json financial_summary_json",
    "A16": "top_cities_monthly_json", "A17": "sales_data_kpis_avg customer_counts_cte",
    # windows
    "W1": "payment_share_view_v2 view_sales_by_payment_rows_v2", "W2": "customer_invoice_first_date",
    "W3": "payment_share_view_v1 financial_summary_weekday", "W4": "category_sales_top5 customer_sales_top5",
    "W5": "total_deliveries_weekday",
    # order, limit, sets, subqueries
    "O1": "sales_graph_monthly customer_pie_first_date", "O2": "top_products_service log_total_time", "O3": "top_cities_monthly",
    "O4": "customer_pie_exists", "O5": "customer_pie_exists_loose", "O6": "view_dashboard_master_analytics_with_lost",
    "Q1": "financial_summary_json", "Q2": "top_cities_monthly", "Q3": "top_cities_monthly_json customer_counts_subqueries", "Q4": "payment_share_view_v1",
    # scalar functions
    "C1": "view_sales_invoice_analytics", "C2": "payment_share_raw", "C3": "payment_share_raw", "C4": "avg_delivery_time_json",
    "C5": "payment_reconciliation", "C6": "customer_sales_all", "C7": "payment_share_preagg", "C8": "customer_counts_cte",
    "C9": "avg_delivery_time_json_scoped", "C10": "sales_graph_monthly_view", "C11": "financial_summary_json", "C12": "total_deliveries_weekday",
    "C13": "avg_delivery_time_hourly", "C14": "avg_delivery_time_hourly", "C15": "financial_summary_json top_cities_monthly_json",
    "C16": "top_cities_monthly", "C17": "top_cities_monthly_json", "C18": "avg_delivery_time_json", "C19": "log_rows_per_call log_db_cache",
    "C20": "log_db_cache_one feature_flags_update_touch",
    # writes and query log
    "M1": "feature_flags_insert_if_absent stores_insert_if_absent stores_insert_published",
    "M2": "feature_flags_update_touch customers_update_touch customers_update_published",
    "H1": "log_cache_hit", "H2": "log_temp_spill", "H3": "log_total_time", "H4": "log_io_wait", "H5": "log_rows_per_call",
    "H6": "log_db_cache log_db_cache_one", "H7": "log_scan",
}


def test_every_row_names_registered_queries():
    registered = set(all_queries())
    for row, keys in COVERED.items():
        assert keys and set(keys.split()) <= registered, row


def test_every_query_belongs_to_a_row():
    named = {key for keys in COVERED.values() for key in keys.split()}
    assert {k for k in all_queries() if not k.endswith("_scoped")} <= named
