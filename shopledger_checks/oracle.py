"""DuckDB SQL for every registered query, written from the report rules.

Parity rules: money sums leave as doubles; ratios are integer half-up divisions (so
neither engine rounds a double); every limit has a total order with explicit NULL
placement; wide integers are cast back to ``bigint``.
"""

from __future__ import annotations

import re

from shopledger_checks import params as P
from shopledger_checks.fixtures import DERIVATIONS, in_duckdb
from shopledger_checks.registry import REPORTS, UNSCOPED, WRITES
from shopledger import Period, ReportParams

# Invoices with a sign and the amount with tax.
_INV = """inv as (
    select *, case invoice_type when 'SALES' then 1 when 'RETURNS' then -1 else 0 end as sgn,
           net_amount + coalesce(tax, 0) as gross
    from sales_invoice_header)"""
_DAYS = "days as (select * from (values (1,'Mon'),(2,'Tue'),(3,'Wed'),(4,'Thu'),(5,'Fri'),(6,'Sat'),(7,'Sun')) v(day_num, day))"


def build(final: str, *ctes: str) -> str:
    """``final`` behind the CTEs it needs, the derived tables first."""
    text = " ".join([*ctes, final])
    if re.search(r"\binv\b", text):
        ctes = (_INV, *ctes)
        text += _INV
    if re.search(r"\bdays\b", text):
        ctes = (_DAYS, *ctes)
    used = [n for n in DERIVATIONS if re.search(rf"\b(?:from|join)\s+{n}\b", text)]
    parts = [f"{n} as ({in_duckdb(n)})" for n in used] + list(ctes)
    return "with " + ",\n".join(parts) + "\n" + final


# --- expressions ------------------------------------------------------------------


def signed(x: str, refund: str | None = None) -> str:
    return f"(case sgn when 1 then {x} when -1 then -{refund or x} else 0 end)"


def sales(x: str) -> str:
    return f"(case when sgn = 1 then {x} else 0 end)"


def returns(x: str) -> str:
    return f"(case when sgn = -1 then {x} else 0 end)"


def num(x: str) -> str:
    return f"cast({x} as double)"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def cents(x: str) -> str:
    return f"cast(cast({x} as decimal(30,2)) * 100 as hugeint)"


def half_up(part: str, whole: str, digits: int) -> str:
    """``part / whole`` rounded half away from zero, both integers; NULL over 0."""
    p, w, scale = f"cast({part} as hugeint)", f"cast({whole} as hugeint)", 10**digits
    size = f"((2 * abs({p}) * {scale} + abs({w})) // (2 * abs(nullif({w}, 0))))"
    return f"(sign({p}) * sign({w}) * cast({size} as double) / {scale})"


def ts(moment) -> str:
    return f"timestamp '{moment:%Y-%m-%d %H:%M:%S}'"


def inside(column: str, period: Period) -> str:
    return f"({column} >= {ts(period.start)} and {column} <= {ts(period.end)})"


def ids(column: str, values) -> list[str]:
    return [f"{column} in ({', '.join(map(str, values))})"] if values else []


def company(p: ReportParams, at: str = "") -> list[str]:
    found = ids(f"{at}company_id", p.company_ids)
    if p.allowed_company_ids is not None:
        found += ids(f"{at}company_id", p.allowed_company_ids)
    return found


def scope(p: ReportParams, *, legal: bool = True) -> list[str]:
    found = company(p) + ids("tenant_id", p.tenant_ids) + ids("store_id", p.store_ids)
    return found + (ids("legal_entity_id", p.legal_entity_ids) if legal else [])


def both(conditions: list[str]) -> str:
    return " and ".join(conditions) if conditions else "true"


def invoices(p: ReportParams, *more: str, legal: bool = True, time: bool = True, drivers: bool = True) -> str:
    """CTE ``sc``: the invoices in scope."""
    conditions = scope(p, legal=legal) + regions(p) + list(more)
    if drivers:
        conditions += ids("delivery_partner_id", p.driver_ids)
    if time:
        conditions.append(inside("invoice_date_time", p.period))
    return f"sc as (select * from inv where {both(conditions)})"


def stored(p: ReportParams, rule: str = "true") -> str:
    """The invoice's store exists, in the wanted regions, under ``rule``."""
    return f"store_id in (select id from ent_stores where {both(ids('region_id', p.region_ids) + [rule])})"


def regions(p: ReportParams) -> list[str]:
    return [stored(p)] if p.region_ids else []


PAID_UP = "payment_status is not null"
LIVE = "(is_deleted is null or not is_deleted)"
KNOWN_LIVE = "is_deleted = false"


# --- sales ---------------------------------------------------------------------------


def kpi_rows(p: ReportParams, period: Period, lost: bool, *more: str) -> str:
    rows = f"""select store_id, {sales('gross')} as s, {returns('gross')} as r, {signed('gross')} as n,
        {signed('total_discount')} as d, {signed('tax')} as t, case when sgn = 1 then id end as o, 0 as l
        from inv where {both(scope(p) + regions(p) + [inside('invoice_date_time', period), *more])}"""
    if lost:
        rows += f""" union all select store_id, 0, 0, 0, 0, 0, null, net_amount from sales_order_header
        where order_type = 'LOST_SALES' and {both(scope(p) + regions(p) + [inside('order_date_time', period)])}"""
    return rows


KPIS = f"""{num('sum(s)')} as "totalSales", {num('sum(r)')} as "totalReturns", {num('sum(n)')} as "netSales",
    {num('sum(d)')} as "totalDiscount", {num('sum(t)')} as tax, count(distinct o) as orders,
    count(distinct store_id) as "activeStores", {num('sum(l)')} as "lostSaledata" """


def sales_data_kpis(p, lost=True, more=()):
    return build(f"select {KPIS} from k", f"k as ({kpi_rows(p, p.period, lost, *more)})")


def sales_data_kpis_avg(p, lost=False):
    average = f"coalesce({half_up(cents('sum(n)'), 'count(distinct o) * 100', 2)}, 0)"
    return build(f'select {KPIS}, {num(average)} as "avgSale" from k', f"k as ({kpi_rows(p, p.period, lost)})")


def sales_data_year_over_year(p):
    def one(tag, period):
        return f"select '{tag}' as period, {KPIS} from ({kpi_rows(p, period, True, PAID_UP)})"

    return build(f"{one('current', p.period)} union all {one('previous', p.year_before)}")


def sales_data_invoice_rows(p):
    money = ("tax", "net_amount", "total_discount", "invoice_amount", "gross_amount")
    columns = ", ".join(f"{num(c)} as {c}" for c in money)
    return build(f"select id, invoice_type, source, store_id, {columns} from sc", invoices(p, PAID_UP))


def sales_data_net_raw(p):
    return build(
        f"""select {num(f'sum({sales("net_amount")})')} as "totalSales", {num(f'sum({returns("net_amount")})')} as "totalReturns",
        {num(f'sum({signed("net_amount")})')} as "netSales", {num(f'sum({signed("total_discount")})')} as "totalDiscount",
        {num(f'sum({signed("tax")})')} as tax, count(distinct case when sgn = 1 then id end) as orders,
        count(distinct store_id) as "activeStores" from sc""",
        invoices(p, PAID_UP),
    )


def lost_sales_total(p):
    where = both(scope(p) + regions(p) + [inside("order_date_time", p.period), "order_type = 'LOST_SALES'"])
    return build(f'select {num("coalesce(sum(net_amount), 0)")} as "lostSaledata" from sales_order_header where {where}')


def gross_sales_total(p):
    return build(f"select {num(f'sum(sgn * gross)')} as total_sales from sc", invoices(p, PAID_UP))


def gross_returns_net(p):
    return build(
        f"""select {num(f'sum({sales("gross")})')} as gross_sales, {num(f'sum({returns("gross")})')} as total_returns,
        {num(f'sum({signed("gross")})')} as net_sales from sc""",
        invoices(p, PAID_UP),
    )


def sales_graph_monthly(p):
    return build(
        f"""select date_trunc('month', invoice_date_time)::timestamp as month, {num('sum(sgn * net_amount)')} as "netSales",
        {num(f'sum({returns("net_amount")})')} as "returns", {num(f'sum({sales("net_amount")})')} as "totalSales"
        from sc group by all""",
        invoices(p, PAID_UP, "sgn <> 0", stored(p)),
    )


def sales_graph_monthly_view(p):
    return build(
        f"""select date_trunc('month', invoice_date_time)::timestamp as month, {num('sum(sgn * net_amount)')} as "totalSales"
        from sc group by all""",
        invoices(p),
    )


# --- payments --------------------------------------------------------------------------

_LABELS = """lab as (
    select x.*, coalesce(case when x.kind = 'CARD' then sp.name else x.kind end, 'CARD') as name,
           case when x.kind = 'CARD' and sp.name is not null then sp.image
                when x.kind <> 'CARD' then pm.image else '' end as image
    from eff x left join ent_sub_payment_method sp on sp.id = x.sub left join ent_payment_methods pm on pm.id = x.main)"""


def share(eff: str, *ctes: str) -> str:
    return build(
        f"""select name, image, {num('amount')} as amount,
        {half_up(cents('amount') + ' * 100', '(select sum(' + cents('amount') + ') from g)', 2)} as percentage from g""",
        *ctes,
        f"eff as ({eff})",
        _LABELS,
        "g as (select name, image, sum(amount) as amount from lab group by name, image)",
    )


_PAY = """select t.id as pid, t.payment_method_type as kind, t.sub_payment_method_id as sub, t.payment_method_id as main,
    t.amount as raw, t.transaction_status as status, coalesce(c.change_amount, 0) as change, c.sgn, c.id as inv_id
    from sc c join payment_transactions t on t.sales_invoice_header_id = c.id"""


def payment_share_preagg(p):
    return share(
        "select kind, sub, main, case when kind = 'CASH' then paid - change else paid end as amount from grouped",
        invoices(p, PAID_UP, stored(p)),
        f"grouped as (select kind, sub, main, inv_id, change, sum(raw) as paid from ({_PAY}) where status = 'PAID' group by all)",
    )


def payment_share_every(p, *more):
    return share(
        f"""select kind, sub, main, case when kind = 'CASH' then raw - change else raw end as amount
        from ({_PAY}) where status = 'PAID'""",
        invoices(p, *more),
    )


def _ranked(source: str) -> str:
    return f"""ranked as (select *, row_number() over (partition by inv_id, kind order by pid) as rn from ({source}))"""


def _effective(version: str) -> str:
    once = {"v1": "kind = 'CASH'"}.get(version, "kind = 'CASH' and rn = 1")
    amount = f"case when {once} then raw - change else raw end"
    return f"case when sgn = -1 then -abs(raw) else {amount} end" if version == "v3" else amount


def payment_share_first(p, version):
    return share(
        f"select kind, sub, main, {_effective(version)} as amount from ranked where status = 'PAID'",
        invoices(p),
        _ranked(_PAY),
    )


def payment_reconciliation():
    return build(
        f"""select count(*) as total_mismatches, {num('sum(gap)')} as total_gap_amount, {num('sum(change_amount)')} as total_change_given
        from (select s.change_amount, s.net_amount + s.tax - pay.paid as gap from sales_invoice_header s join pay on pay.k = s.id)
        where gap > 0.01 or gap < -0.01""",
        """pay as (select sales_invoice_header_id as k, sum(amount) as paid from payment_transactions
        where transaction_status = 'PAID' group by 1)""",
    )


def _collected(p):
    return invoices(p), f"got as (select x.*, sc.change_amount from ({_PAY}) x join sc on sc.id = x.inv_id where status = 'PAID')"


def net_cash_collected(p):
    return build(
        f"select {num('sum(raw) - sum(distinct change_amount)')} as total_cash_collected from got where kind = 'CASH'", *_collected(p)
    )


def collection_breakdown(p):
    def part(kinds):
        return f"sum(case when {kinds} then raw else 0 end)"

    change = "sum(distinct change_amount)"
    return build(
        f"""select {num(part("kind = 'CASH'") + ' - ' + change)} as net_cash_amount, {num(part("kind = 'CARD'"))} as card_amount,
        {num(part("kind <> 'CASH' and kind <> 'CARD'"))} as other_amount, {num('sum(raw) - ' + change)} as total_collected from got""",
        *_collected(p),
    )


# --- customers ---------------------------------------------------------------------------


def _label(existing: str) -> str:
    return f"case when {existing} then 'Existing Customer' else 'New Customer' end as customertype"


def _pie(p, earlier: str):
    return build(
        f"""select customer_id, {num('sum(sgn * net_amount)')} as sales,
        {_label("customer_id in (select customer_id from inv where customer_id is not null and " + earlier + ")")}
        from sc group by customer_id""",
        invoices(p, stored(p)),
    )


def customer_pie_exists(p):
    return _pie(p, both(scope(p) + [stored(p), f"invoice_date_time < {ts(p.period.start)}"]))


def customer_pie_exists_loose(p):
    return _pie(p, both(company(p) + ids("tenant_id", p.tenant_ids) + [f"invoice_date_time < {ts(p.period.start)}"]))


_LOYAL = """loyal as (
    select customer_id, company_id, tenant_id, legal_entity_id, store_id, invoice_date_time, sgn * net_amount as amount,
           min(invoice_date_time) over (partition by customer_id) as first_purchase_date
    from inv where store_id in (select id from ent_stores))"""


def customer_pie_first_date(p):
    return build(
        f"""select customer_id, {num('sum(amount)')} as sales, {_label(f"min(first_purchase_date) < {ts(p.period.start)}")}
        from loyal where {both(company(p) + [inside('invoice_date_time', p.period)])} group by customer_id""",
        _LOYAL,
    )


def loyalty_rows():
    return build(f"select * exclude (amount), {num('amount')} as effective_amount from loyal", _LOYAL)


def _buyers(p, extra="true"):
    """Customers of invoices in the invoice's scope and the period, counted distinctly."""
    where = company(p, "s.") + ids("s.tenant_id", p.tenant_ids) + [inside("s.invoice_date_time", p.period), "s.payment_status is not null"]
    return f"(select count(distinct s.customer_id) from inv s join ent_customer c on s.customer_id = c.id where {both([*where, extra])})"


def _own(p, at="c."):
    return both(company(p, at) + ids(f"{at}tenant_id", p.tenant_ids))


def _fresh(p):
    return inside("c.customer_created_on", p.period)


def _customers(p, extra="true"):
    return f"(select count(*) from ent_customer c where c.is_deleted = false and {_own(p)} and {extra})"


def customer_counts_cte(p):
    rate = f"coalesce({half_up('converted_customer * 100', 'new_customer', 2)}, 0)"
    return build(
        f"""select *, new_customer as total_visitors, {num(rate)} as conversion_rate from (
        select {_customers(p)} as total_customer, {_buyers(p)} as active_customer, {_customers(p, _fresh(p))} as new_customer,
        {_buyers(p, f"{_own(p)} and {_fresh(p)}")} as converted_customer)""",
    )


def customer_base_counts(p):
    return build(f"""select {_customers(p)} as "totalCustomer", {_customers(p, _fresh(p))} as "newCustomer" """)


def customer_activity_counts(p):
    return build(f"""select {_buyers(p)} as "activeCustomer", {_buyers(p, _fresh(p))} as "convertedCustomer" """)


def customer_counts_subqueries(p):
    return build(
        f"""select {_customers(p)} as "totalCustomer", {_customers(p, _fresh(p))} as "newCustomer",
        {_buyers(p)} as "activeCustomer", {_buyers(p, _fresh(p))} as "convertedCustomer" """
    )


_ACTIVITY = """activity as (
    select c.id as customer_id, c.is_deleted, c.customer_created_on, c.company_id, c.tenant_id, s.invoice_date_time, s.payment_status
    from ent_customer c left join sales_invoice_header s on s.customer_id = c.id)"""


def customer_counts_activity_view(p):
    active = f"({inside('invoice_date_time', p.period)} and {PAID_UP})"
    fresh = inside("customer_created_on", p.period)

    def n(condition, name):
        return f'count(distinct case when {condition} then customer_id end) as "{name}"'

    return build(
        f"""select {n('is_deleted = false', 'totalCustomer')}, {n(active, 'activeCustomer')},
        {n(fresh + ' and is_deleted = false', 'newCustomer')}, {n(fresh + ' and ' + active, 'convertedCustomer')}
        from activity where {both(company(p) + ids('tenant_id', p.tenant_ids))}""",
        _ACTIVITY,
    )


_NAMED = """named as (select id, customer_class_id, coalesce(first_name, '') || ' ' || coalesce(last_name, '') as name from ent_customer)"""


def customer_sales_all(p):
    return build(
        f"select n.id, n.name, {num('sum(sgn * net_amount)')} as amount from sc join named n on n.id = sc.customer_id group by all",
        invoices(p, PAID_UP, "sgn <> 0", stored(p)),
        _NAMED,
    )


def customer_sales_top5(p):
    return build(
        f"""select id, name, {num('amount')} as amount, {num('(select sum(amount) from g)')} as "totalSum"
        from g order by g.amount desc nulls first, id limit 5""",
        invoices(p, PAID_UP, stored(p)),
        _NAMED,
        f"""g as (select n.id, n.name, sum(sgn * net_amount) as amount from sc join named n on n.id = sc.customer_id
        where {both(ids('customer_class_id', p.customer_class_ids))} group by all)""",
    )


# --- products ---------------------------------------------------------------------------------


def _sold(kind: str) -> str:
    return f"""sold as (
    select sc.*, l.net_amount as line_net, l.quantity, l.return_quantity, pr.* exclude (id), pr.id as product_id
    from sc join sales_invoice_lines l on l.invoice_id = sc.id join prd_products pr on pr.id = l.product_id
    where sc.sgn <> 0 and pr.product_classification = '{kind}')"""


_MOVED = "case when sgn = 1 then quantity else -return_quantity end"


def category_sales_header_amount(p):
    return build(
        f"""select c.id, c.name, c.alt_name as "altName", {num('sum(sgn * net_amount)')} as amount, {big(f'sum({_MOVED})')} as qty
        from sold join prd_product_categories c on c.id = product_category_id group by all""",
        invoices(p, PAID_UP, stored(p), legal=False),
        _sold("STANDARD_PRODUCT"),
    )


def category_sales_top5(p):
    return build(
        f"""select id, name, alt_name as altname, {num('amount')} as amount, qty, {big('(select sum(qty) from g)')} as "totalQty",
        {num('(select sum(amount) from g)')} as "totalAmount" from g order by qty desc nulls first, id limit 5""",
        invoices(p, PAID_UP, legal=False),
        _sold("STANDARD_PRODUCT"),
        f"""g as (select c.id, c.name, c.alt_name, sum(sgn * line_net) as amount, {big(f'sum({_MOVED})')} as qty
        from sold join prd_product_categories c on c.id = product_category_id group by all)""",
    )


def top_products(p, kind):
    return build(
        f"""select product_id as id, short_name as name, alt_short_name as "altName", code, image as "productImage",
        hex_code as "productHexCode", {num('sum(sgn * line_net)')} as amount, {big('sum(quantity)')} as qty
        from sold group by all order by amount desc nulls first, id limit 5""",
        invoices(p, PAID_UP),
        _sold(kind),
    )


# --- delivery -----------------------------------------------------------------------------------

_DELIVERED = "fulfilment_type = 'DELIVERY' and sgn = 1 and fulfilment_status = 'DELIVERED'"


def _timed(p, rule):
    """CTEs ``cur`` and ``prev``: microseconds of each delivery in either period."""

    def one(name, period):
        where = [_DELIVERED, "on_delivered_time > on_in_transit_time", stored(p, rule), inside("invoice_date_time", period)]
        where += scope(p) + ids("delivery_partner_id", p.driver_ids)
        return f"""{name} as (select hour(invoice_date_time) as h, date_diff('microsecond', on_in_transit_time, on_delivered_time) as us
        from inv where {both(where)})"""

    return one("cur", p.period), one("prev", p.previous_period)


def avg_delivery_time_json(p):
    minute = 60_000_000
    per_hour = half_up("sum(us)", f"count(*) * {minute}", 2)
    change = half_up("(a * m - b * n) * 100", "b * n", 2)
    return build(
        f"""select coalesce({half_up('a', f'n * {minute}', 0)}, 0) as avg_delivery_time,
        case when b > 0 and n > 0 then {change} else 0 end as percentage_change, n as total_completed_deliveries,
        cast(coalesce(to_json((select list({{'hour': h, 'avg_time': t}} order by h) from trend)), '[]') as varchar) as hourly_trend
        from (select sum(us) as a, count(*) as n from cur), (select sum(us) as b, count(*) as m from prev)""",
        *_timed(p, "true"),
        f"trend as (select h, cast({per_hour} as decimal(18,2)) as t from cur group by h)",
    )


def avg_delivery_time_hourly(p):
    def minutes(us, n):
        return f"({us}::double / 1000000) / ({n} * 60)::double"

    return build(
        f"""select cast(h as integer) as hour, {minutes('sum(us)', 'count(*)')} as hour_avg_time,
        (select {minutes('sum(us)', 'count(*)')} from cur) as total_avg_time, (select count(*) from cur) as total_completed_deliveries,
        (select {minutes('sum(us)', 'nullif(count(*), 0)')} from prev) as prev_avg_time from cur group by h""",
        *_timed(p, LIVE),
    )


def _money_rows(p, rule):
    return invoices(p, "sgn <> 0", "fulfilment_type in ('DELIVERY', 'HOME_DELIVERY')", stored(p, rule))


_PLAIN = "fulfilment_type = 'DELIVERY'"
_WEEK = f"""week as (select day_num, day, coalesce(sum({sales('invoice_amount')}), 0) as v
    from days left join sc on isodow(invoice_date_time) = day_num group by all)"""


def financial_summary_json(p):
    return build(
        f"""select {num(f'sum({sales("invoice_amount")})')} as total_order_value,
        coalesce({half_up(cents(f'sum({sales("invoice_amount")})'), 'count(*) filter (sgn = 1) * 100', 2)}, 0) as average_order_value,
        {num(f'sum({returns("invoice_amount")})')} as returns_value, {num('sum(sgn * invoice_amount)')} as total_sale_value,
        (select cast(to_json(list({{'day_of_week': day, 'sales_value': v}} order by day_num)) as varchar) from week) as weekly_data
        from sc where {_PLAIN}""",
        _money_rows(p, "true"),
        _WEEK,
    )


def financial_summary_weekday(p):
    def total(x):
        return f"(select coalesce(sum({x}), 0) from sc where {_PLAIN})"

    return build(
        f"""select day_num, day as day_of_week, {num('v')} as sales_value, {num(total(sales('invoice_amount')))} as total_order_value,
        (select count(*) from sc where {_PLAIN} and sgn = 1) as total_orders,
        {num(total(returns('invoice_amount')))} as total_returns_value, {num(total('sgn * invoice_amount'))} as total_sale_value from week""",
        _money_rows(p, LIVE),
        _WEEK,
    )


def total_deliveries_weekday(p):
    def rows(period):
        where = [_DELIVERED, stored(p, LIVE), inside("invoice_date_time", period)]
        return f"from inv where {both(where + scope(p) + ids('delivery_partner_id', p.driver_ids))}"

    return build(
        """select day_num, day as day_of_week, coalesce(n, 0) as daily_deliveries,
        case when n > 0 then (select cast(sum(n) as bigint) from cur) else 0 end as total_current, total_previous
        from days left join cur on d = day_num, prev""",
        f"cur as (select isodow(invoice_date_time) as d, count(distinct id) as n {rows(p.period)} group by 1)",
        f"prev as (select count(distinct id) as total_previous {rows(p.previous_period)})",
    )


# --- cities ----------------------------------------------------------------------------------------


def _city_ctes(p, rule=LIVE, *more):
    def live(alias):
        return rule.replace("is_deleted", f"{alias}.is_deleted")

    return (
        invoices(p, _PLAIN, "sgn = 1", *more),
        f"""cm as (select c.id as city_id, c.code as city_code, c.name as city_name,
        date_trunc('month', invoice_date_time)::timestamp as m, count(distinct sc.id) as n
        from sc join ent_stores st on st.id = sc.store_id and {live('st')} and {both(ids('st.region_id', p.region_ids))}
        join ent_city c on c.id = st.city_id and {live('c')} group by all)""",
        """best as (select city_id, city_code, city_name, cast(sum(n) as bigint) as total from cm group by all
        order by total desc, city_id limit 5)""",
    )


_ISO = "strftime(m, '%Y-%m-%dT%H:%M:%S')"


def top_cities_monthly(p):
    return build(
        f"""select city_id, city_code, city_name, {_ISO} as order_month_str, m as order_month_raw, n as order_count
        from cm where city_id in (select city_id from best)""",
        *_city_ctes(p),
    )


def top_cities_json(p, rule=LIVE, more=(), empty="[]"):
    default = f"coalesce(x, {empty})" if empty else "x"
    return build(
        f"""select cast(to_json({{'cities': (select list({{'id': city_id, 'code': city_code, 'name': city_name, 'total_orders': total}}
        order by total desc, city_id) from best), 'monthly_data': (select {default} from (select
        list({{'month': strftime(m, '%b'), 'date': {_ISO}, 'orders': o}} order by m) as x from per_month))}}) as varchar) as result""",
        *_city_ctes(p, rule, *more),
        """per_month as (select m, map_from_entries(list({'k': city_name, 'v': n} order by city_name)) as o
        from (select m, city_name, cast(sum(n) as bigint) as n from cm where city_id in (select city_id from best) group by all)
        group by m)""",
    )


# --- views --------------------------------------------------------------------------------------------

_SCOPED = "company_id, tenant_id, legal_entity_id, store_id, customer_id"

_LINE_VIEW = f"{_SCOPED}, invoice_date_time, payment_status, {num(signed('line_net'))} as net_amount"
_ALL_INVOICES = "sc as (select * from inv)"

_SUMMARY = f"""select {_SCOPED}, invoice_date_time as event_date, payment_status, {num(sales('gross'))} as sale_amount,
    {num(returns('gross'))} as return_amount, {num(signed('gross'))} as net_amount, {num(signed('total_discount'))} as net_discount,
    {num(signed('tax'))} as net_tax, case when sgn = 1 then id end as sale_order_id"""


def _payment_view(version):
    return build(
        f"""select name, image, {num('amount')} as amount, l.store_id, l.customer_id, l.invoice_date_time, l.company_id, l.tenant_id,
        l.legal_entity_id, l.payment_status, l.status as transaction_status from lab l""",
        _ALL_INVOICES,
        _ranked(_PAY),
        f"""eff as (select r.kind, r.sub, r.main, {_effective(version).replace('sgn', 'r.sgn')} as amount, r.status, s.* exclude (change_amount)
        from ranked r join sc s on s.id = r.inv_id)""",
        _LABELS,
    )


VIEWS = {
    "v_product_sales_enriched": build(
        f"""select product_id, short_name as name, alt_short_name as "altName", code, image as "productImage",
        hex_code as "productHexCode", {_LINE_VIEW}, quantity from sold""",
        _ALL_INVOICES,
        _sold("SERVICE_PRODUCT"),
    ),
    "view_sales_graph_analytics": build(
        f"""select {_SCOPED}, invoice_date_time, date_trunc('month', invoice_date_time)::timestamp as month_date,
        {num(sales('net_amount'))} as raw_sales, {num(returns('net_amount'))} as raw_returns, {num(signed('net_amount'))} as net_amount
        from inv"""
    ),
    "view_sales_invoice_analytics": build(
        f"""select id as invoice_id, invoice_type, {_SCOPED}, invoice_date_time, payment_status, {num('net_amount')} as net_amount,
        {num(signed('net_amount'))} as effective_net_amount, {num('coalesce(tax, 0)')} as tax_amount,
        {num('coalesce(total_discount, 0)')} as discount_amount, {num(signed('total_discount'))} as effective_discount from inv"""
    ),
    "view_dashboard_lost_sales": build(
        f"""select {num('net_amount')} as lost_sale_amount, order_date_time as event_date, company_id, tenant_id, legal_entity_id, store_id
        from sales_order_header where order_type = 'LOST_SALES'"""
    ),
    "view_sales_by_customer_rows": build(
        f"""select n.id, n.name, i.company_id, i.tenant_id, i.legal_entity_id, i.store_id, i.pos_id, i.invoice_date_time, i.payment_status,
        {num(signed('net_amount'))} as amount, n.customer_class_id, st.region_id
        from inv i join named n on n.id = i.customer_id join ent_stores st on st.id = i.store_id""",
        _NAMED,
    ),
    "view_category_sales_rows": build(
        f"""select c.id as category_id, c.name as category_name, c.alt_name as category_alt_name, {_LINE_VIEW},
        {_MOVED} as quantity from sold join prd_product_categories c on c.id = product_category_id""".replace("company_id", "sold.company_id"),
        _ALL_INVOICES,
        _sold("STANDARD_PRODUCT"),
    ),
    "view_customer_loyalty_analytics": loyalty_rows(),
    "view_customer_activity_summary": build("select * from activity", _ACTIVITY),
    "view_sales_by_payment_rows_v1": _payment_view("v1"),
    "view_sales_by_payment_rows_v2": _payment_view("v2"),
    "view_sales_by_payment_rows_v3": _payment_view("v3"),
    "view_dashboard_sales_summary": build(f"{_SUMMARY} from inv"),
    "view_dashboard_master_analytics": build(f"{_SUMMARY}, 0::double as lost_sale_amount from inv"),
    "view_dashboard_master_analytics_with_lost": build(
        f"""{_SUMMARY}, 0::double as lost_sale_amount from inv union all
        select company_id, tenant_id, legal_entity_id, store_id, null, order_date_time, 'PAID', 0, 0, 0, 0, 0, null, {num('net_amount')}
        from sales_order_header where order_type = 'LOST_SALES'"""
    ),
}


# --- first rows of the views that join, by the keys of the table whose rows they list -----------------

_FIRST_LINES = "order by sold.id, sold.product_id, line_net, sold.quantity, sold.return_quantity"


def _first_payments(version):
    cash = "p.payment_method_type = 'CASH'"
    if version != "v1":
        cash += """ and p.id = (select min(f.id) from payment_transactions f
            where f.sales_invoice_header_id = p.sales_invoice_header_id and f.payment_method_type = 'CASH')"""
    refund = "when invoice_type = 'RETURNS' then -abs(p.amount)" if version == "v3" else ""
    return build(
        f"""select case when p.payment_method_type = 'CARD' and b.name is not null then b.name
            when p.payment_method_type <> 'CARD' then p.payment_method_type else 'CARD' end as name,
        case when p.payment_method_type = 'CARD' and b.name is not null then b.image
            when p.payment_method_type <> 'CARD' then m.image else '' end as image,
        {num(f"case {refund} when {cash} then p.amount - coalesce(change_amount, 0) else p.amount end")} as amount,
        store_id, customer_id, invoice_date_time, company_id, tenant_id, legal_entity_id, payment_status, transaction_status
        from payment_transactions p join sales_invoice_header s on s.id = p.sales_invoice_header_id
        left join ent_payment_methods m on m.id = p.payment_method_id
        left join ent_sub_payment_method b on b.id = p.sub_payment_method_id order by p.id limit 10"""
    )


FIRST = {
    "v_product_sales_enriched": f"{VIEWS['v_product_sales_enriched']} {_FIRST_LINES} limit 10",
    "view_category_sales_rows": f"{VIEWS['view_category_sales_rows']} {_FIRST_LINES} limit 10",
    "view_sales_by_customer_rows": f"{VIEWS['view_sales_by_customer_rows']} order by i.id limit 10",
    "view_customer_loyalty_analytics": build(
        f"select * exclude (id, amount), {num('amount')} as effective_amount from loyal order by id limit 10",
        _LOYAL.replace("select customer_id", "select id, customer_id"),
    ),
    "view_customer_activity_summary": f"""{VIEWS["view_customer_activity_summary"]} order by customer_id, is_deleted nulls last, customer_created_on nulls last,
        company_id, tenant_id, invoice_date_time nulls last, payment_status nulls last limit 10""",
    **{f"view_sales_by_payment_rows_{v}": _first_payments(v) for v in ("v1", "v2", "v3")},
}


def preview(sql: str, columns: list[str]) -> str:
    order = ", ".join(f'"{c}" asc nulls last' for c in columns)
    return f"select * from ({sql}) order by {order} limit 10"


# Column order of each view, which is the preview's sort order.
_S4 = ["company_id", "tenant_id", "legal_entity_id", "store_id"]
_LINE = ["store_id", "invoice_date_time", "company_id", "tenant_id", "legal_entity_id", "payment_status", "customer_id", "net_amount", "quantity"]
_INVOICE = ["store_id", "company_id", "tenant_id", "legal_entity_id", "customer_id", "invoice_date_time", "payment_status"]
_CATEGORY = ["store_id", "customer_id", "invoice_date_time", "payment_status", "company_id", "tenant_id", "legal_entity_id", "net_amount", "quantity"]
_SUM = [*_S4, "customer_id", "event_date", "payment_status", "sale_amount", "return_amount", "net_amount", "net_discount", "net_tax", "sale_order_id"]
_PAYMENT = [
    "name", "image", "amount", "store_id", "customer_id", "invoice_date_time", "company_id", "tenant_id", "legal_entity_id",
    "payment_status", "transaction_status",
]
VIEW_COLUMNS = {
    "v_product_sales_enriched": ["product_id", "name", "altName", "code", "productImage", "productHexCode", *_LINE],
    "view_sales_graph_analytics": [*_S4, "customer_id", "invoice_date_time", "month_date", "raw_sales", "raw_returns", "net_amount"],
    "view_sales_invoice_analytics": [
        "invoice_id", "invoice_type", *_INVOICE, "net_amount",
        "effective_net_amount", "tax_amount", "discount_amount", "effective_discount",
    ],
    "view_dashboard_lost_sales": ["lost_sale_amount", "event_date", *_S4],
    "view_sales_by_customer_rows": [
        "id", "name", *_S4, "pos_id", "invoice_date_time", "payment_status", "amount", "customer_class_id", "region_id",
    ],
    "view_category_sales_rows": ["category_id", "category_name", "category_alt_name", *_CATEGORY],
    "view_customer_loyalty_analytics": ["customer_id", *_S4, "invoice_date_time", "effective_amount", "first_purchase_date"],
    "view_customer_activity_summary": [
        "customer_id", "is_deleted", "customer_created_on", "company_id", "tenant_id", "invoice_date_time", "payment_status",
    ],
    "view_sales_by_payment_rows_v1": _PAYMENT,
    "view_sales_by_payment_rows_v2": _PAYMENT,
    "view_sales_by_payment_rows_v3": _PAYMENT,
    "view_dashboard_sales_summary": _SUM,
    "view_dashboard_master_analytics": [*_SUM, "lost_sale_amount"],
    "view_dashboard_master_analytics_with_lost": [*_SUM, "lost_sale_amount"],
}


# --- query log -------------------------------------------------------------------------------------------

_LOAD = "from query_stats where not contains(query, 'pg_stat_statements')"


def _seconds(ms_cents: str, n: str = "1") -> str:
    return half_up(ms_cents, f"100000 * {n}", 2)


LOGS = {
    "log_cache_hit": build(
        f"""select query, calls, {big('shared_blks_hit')} as ram_hits, {big('shared_blks_read')} as disk_reads,
        {half_up('100 * shared_blks_hit', 'shared_blks_hit + shared_blks_read', 2)} as hit_ratio_pct
        {_LOAD} order by disk_reads desc nulls first, query limit 10"""
    ),
    "log_temp_spill": build(
        f"""select query, calls, {big('temp_blks_read')} as temp_blks_read, {big('temp_blks_written')} as temp_blks_written
        from query_stats where temp_blks_written > 0 order by query_stats.temp_blks_written desc, query limit 10"""
    ),
    "log_total_time": build(
        f"""select query, calls, {_seconds('round(total_exec_time * 100)')} as total_seconds,
        {_seconds('round(total_exec_time * 100)', 'calls')} as avg_seconds
        {_LOAD} order by total_exec_time desc nulls first, query limit 10"""
    ),
    "log_io_wait": build(
        f"""select query, {_seconds('round(total_exec_time * 100)')} as total_sec,
        {_seconds('(blk_read_time + blk_write_time) * 100')} as io_wait_sec,
        {half_up('(blk_read_time + blk_write_time) * 10000', 'round(total_exec_time * 100)', 2)} as io_wait_percent
        {_LOAD} and total_exec_time > 0 order by io_wait_sec desc nulls first, query limit 10"""
    ),
    "log_rows_per_call": build(
        f"""select query, calls, {big('rows')} as rows, {big('rows // calls')} as rows_per_call
        {_LOAD} order by rows_per_call desc nulls first, query limit 10"""
    ),
    "log_db_cache": build(
        f"""select datname, {big('100 * blks_hit // nullif(blks_hit + blks_read, 0)')} as global_cache_hit_ratio,
        {big('tup_returned')} as tup_returned, {big('tup_fetched')} as tup_fetched, {big('tup_returned - tup_fetched')} as inefficient_full_scans
        from db_stats"""
    ),
    "log_db_cache_one": build(
        f"""select datname, {big('100 * blks_hit // nullif(blks_hit + blks_read, 0)')} as global_cache_hit_ratio,
        {big('tup_returned')} as tup_returned, {big('tup_fetched')} as tup_fetched, {big('tup_returned - tup_fetched')} as inefficient_full_scans
        from db_stats where datname = '{P.DATABASE}'"""
    ),
    "log_scan": build(
        "select query, calls, "
        + ", ".join(
            f"{big(c)} as {c}" for c in ("shared_blks_hit", "shared_blks_read", "temp_blks_read", "temp_blks_written", "rows")
        )
        + ", total_exec_time, mean_exec_time, blk_read_time, blk_write_time from query_stats"
    ),
}


# --- keyed writes ------------------------------------------------------------------------------------------

_FLAGS = """flags as (
    select id, feature_name, enabled, description from feature_flags union all
    select distinct cast(regexp_extract(p_brand, '[0-9]+$') as integer) + 100, p_brand, false, 'from part'
    from part where p_brand not in (select feature_name from feature_flags))"""

KEYED = {
    "feature_flags_insert_if_absent": build("select * from flags", _FLAGS),
    "feature_flags_update_touch": build(
        f"""select f.id, f.feature_name, f.enabled or b.p_brand is not null as enabled, f.description,
        case when b.p_brand is null then {ts(P.CREATED)} else {ts(P.TOUCHED)} end as updated_at
        from flags f left join (select p_brand from part group by 1 having 6 * count(*) filter (p_type = 'PROMO') >= count(*)) b
        on b.p_brand = f.feature_name""",
        _FLAGS,
    ),
    "stores_insert_if_absent": build(
        """select * from ent_stores union all select distinct store_id, 'from invoices', null::integer, null::integer, null::boolean
        from sales_invoice_header where store_id not in (select id from ent_stores)"""
    ),
    "customers_update_touch": build(
        f"""select c.* exclude (customer_class_id), coalesce(r.n, c.customer_class_id) as customer_class_id,
        case when r.n is null then {ts(P.CREATED)} else {ts(P.TOUCHED)} end as updated_at
        from ent_customer c left join (select customer_id, cast(count(*) as integer) as n from inv where sgn = -1 group by 1) r
        on r.customer_id = c.id"""
    ),
}


# --- by key ---------------------------------------------------------------------------------------------------

SCOPED = {
    "sales_data_invoice_rows": sales_data_invoice_rows,
    "sales_data_kpis": sales_data_kpis,
    "sales_data_kpis_settled": lambda p: sales_data_kpis(p, more=(PAID_UP,)),
    "sales_data_kpis_region": sales_data_kpis,
    "payment_share_view_v2_region": lambda p: payment_share_first(p, "v2"),
    "category_sales_top5_region": category_sales_top5,
    "top_products_standard_region": lambda p: top_products(p, "STANDARD_PRODUCT"),
    "sales_data_kpis_avg": sales_data_kpis_avg,
    "sales_data_kpis_avg_with_lost": lambda p: sales_data_kpis_avg(p, lost=True),
    "sales_data_year_over_year": sales_data_year_over_year,
    "sales_data_net_raw": sales_data_net_raw,
    "lost_sales_total": lost_sales_total,
    "gross_sales_total": gross_sales_total,
    "gross_returns_net": gross_returns_net,
    "sales_graph_monthly": sales_graph_monthly,
    "sales_graph_monthly_view": sales_graph_monthly_view,
    "payment_share_preagg": payment_share_preagg,
    "payment_share_view_v1": payment_share_every,
    "payment_share_view_v2": lambda p: payment_share_first(p, "v2"),
    "payment_share_view_v3": lambda p: payment_share_first(p, "v3"),
    "payment_share_raw": lambda p: payment_share_every(p, PAID_UP),
    "net_cash_collected": net_cash_collected,
    "collection_breakdown": collection_breakdown,
    "customer_pie_exists": customer_pie_exists,
    "customer_pie_exists_loose": customer_pie_exists_loose,
    "customer_pie_first_date": customer_pie_first_date,
    "customer_counts_cte": customer_counts_cte,
    "customer_base_counts": customer_base_counts,
    "customer_activity_counts": customer_activity_counts,
    "customer_counts_activity_view": customer_counts_activity_view,
    "customer_counts_subqueries": customer_counts_subqueries,
    "customer_sales_all": customer_sales_all,
    "customer_sales_top5": customer_sales_top5,
    "customer_sales_top5_raw": customer_sales_top5,
    "category_sales_header_amount": category_sales_header_amount,
    "category_sales_top5": category_sales_top5,
    "top_products_standard": lambda p: top_products(p, "STANDARD_PRODUCT"),
    "top_products_service": lambda p: top_products(p, "SERVICE_PRODUCT"),
    "avg_delivery_time_json": avg_delivery_time_json,
    "avg_delivery_time_hourly": avg_delivery_time_hourly,
    "financial_summary_json": financial_summary_json,
    "financial_summary_weekday": financial_summary_weekday,
    "total_deliveries_weekday": total_deliveries_weekday,
    "top_cities_monthly": top_cities_monthly,
    "top_cities_monthly_json": top_cities_json,
    "top_cities_monthly_json_strict": lambda p: top_cities_json(p, KNOWN_LIVE, empty=""),
    "top_cities_monthly_json_paid": lambda p: top_cities_json(p, KNOWN_LIVE, (PAID_UP,)),
}


def all_oracles() -> dict[str, str]:
    found = {
        "payment_reconciliation": payment_reconciliation(),
        "customer_invoice_first_date": loyalty_rows(),
        **VIEWS,
        **{f"preview_{name}": preview(sql, VIEW_COLUMNS[name]) for name, sql in VIEWS.items()},
        **{f"first_{name}": sql for name, sql in FIRST.items()},
        **LOGS,
        **KEYED,
    }
    # Published tables hold what the plain writes and reports give.
    found["stores_insert_published"] = KEYED["stores_insert_if_absent"]
    found["customers_update_published"] = KEYED["customers_update_touch"]
    found["customer_pie_folded_history"] = customer_pie_first_date(REPORTS["customer_pie_first_date"][1])
    found["payment_reconciliation_monthly"] = payment_reconciliation()
    for key, oracle in SCOPED.items():
        _, whole, narrow = REPORTS[key]
        found[key] = oracle(whole)
        found[f"{key}_scoped"] = oracle(narrow)
    missing = (set(REPORTS) | set(UNSCOPED) | set(WRITES)) - set(found)
    assert not missing, missing
    return found
