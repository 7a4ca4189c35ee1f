"""The fixed parameter sets of the registered queries, in one place."""

from __future__ import annotations

from datetime import datetime

from shopledger import ReportParams

# Whole tables: no scope, and a period around all the data.
WHOLE = ReportParams(datetime(1970, 1, 1), datetime(2026, 1, 5, 23, 59, 59))
# Whole tables, cut in two periods: what lies before 1998 is the history or the previous period.
SPLIT = WHOLE.but(from_ts=datetime(1998, 1, 1))
# Whole tables, stores of three regions.
WHOLE_REGION = WHOLE.but(region_ids=(0, 1, 2))

DEFAULT = ReportParams(
    datetime(1996, 1, 1),
    datetime(1998, 12, 31, 23, 59, 59),
    company_ids=(1,),
    tenant_ids=(1,),
    legal_entity_ids=(1, 2, 3),
)
# Reports that take no legal entity refuse one.
TENANT = DEFAULT.but(legal_entity_ids=())
STORE = DEFAULT.but(store_ids=(7,))
ONE_STORE = STORE.but(company_ids=(), tenant_ids=(), legal_entity_ids=())
WIDE = ReportParams(datetime(1996, 1, 1), datetime(2100, 12, 31, 23, 59, 59), company_ids=(1,))
REGION = DEFAULT.but(region_ids=(0, 1, 2))
TENANT_REGION = TENANT.but(region_ids=(0, 1, 2))
DRIVER = REGION.but(driver_ids=tuple(range(1, 30)))
# Local bounds three hours ahead of UTC, and a security rule beside the requested companies.
SHIFTED = DEFAULT.but(utc_offset_hours=3, company_ids=(1, 2), allowed_company_ids=(1,))
CLASSES = DEFAULT.but(customer_class_ids=(1, 2, 3))

# The database of the query-log report over one of them.
DATABASE = "purchase"

# The job time of the keyed updates.
TOUCHED = datetime(2025, 1, 1)
CREATED = datetime(2024, 1, 1)
