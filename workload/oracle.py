"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

import re

from workload.feeds import PRODUCT_LAG_DAYS

AS_OF = "2002-01-01 00:00:00"

# Amounts are added as whole numbers of ten-thousandths: the order of adding does not matter.


def _title(column: str) -> str:
    words = f"list_transform(string_split({column}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"list_aggregate({words}, 'string_agg', ' ')"


def _pad(column: str) -> str:
    return f"lpad(cast(cast({column} as bigint) as varchar), 12, '0')"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _units(column: str) -> str:
    return f"cast(sum(cast(round({column} * 10000) as bigint)) as double)"


def _total(column: str) -> str:
    return f"{_units(column)} / 10000"


def _mean(column: str) -> str:
    return f"{_units(column)} / count({column}) / 10000"


_SEQ = ["_event_ts", "_ingest_ts", "_file_mod_time", "_source_file"]


def _versions(source: str, key: str, delete: str | None = None) -> str:
    """Versions with the fields of the end position as ``_end1`` to ``_end4``."""
    window = f"(partition by {key} order by {', '.join(_SEQ)})"
    ends = ", ".join(f"lead({c}) over {window} as _end{i + 1}" for i, c in enumerate(_SEQ))
    keep = f" and not ({delete})" if delete else ""
    return (
        f"select * from (select *, {ends} from {source} where {key} is not null)"
        f" where (_end4 is null or ({', '.join(_SEQ)}) is distinct from (_end1, _end2, _end3, _end4)){keep}"
    )


def _valid(version: str, fact: str) -> str:
    start = ", ".join(f"{version}.{c}" for c in _SEQ)
    end = ", ".join(f"{version}._end{i}" for i in range(1, 5))
    at = ", ".join(f"{fact}.{c}" for c in _SEQ)
    return f"({start}) <= ({at}) and ({version}._end4 is null or ({end}) > ({at}))"


def _valid_event(version: str, fact: str) -> str:
    return (
        f"{version}._event_ts <= {fact}._event_ts"
        f" and ({version}._end4 is null or {version}._end1 > {fact}._event_ts)"
    )


_REVENUE = "order_status in ('completed', 'shipped')"

_PIT_SELECT = """
select o.order_sk, o.order_id, o.order_date, o._event_ts as order_event_ts, o.customer_id, o.product_id,
  o.order_status, o.payment_method, o.shipping_city, o.quantity, o.unit_price as order_unit_price,
  o.quantity * o.unit_price as line_amount, c.customer_sk, c.customer_name, c.tier,
  c.city as customer_city, c.signup_date, p.product_sk, p.product_name, p.category, p.brand,
  p.unit_price as catalog_unit_price, p.stock_quantity,
  o.unit_price - p.unit_price as catalog_price_delta,
  case when abs(o.unit_price - p.unit_price) <= 0.01 then 'MATCH' else 'MISMATCH' end as price_match_flag,
  case when date_diff('day', c.signup_date, o.order_date) < 30 then 'NEW'
    when date_diff('day', c.signup_date, o.order_date) < 180 then 'GROWING'
    else 'ESTABLISHED' end as tenure_bucket,
  case when p.stock_quantity <= 0 then 'OOS' when p.stock_quantity < 20 then 'LOW' else 'OK' end
    as stock_risk_flag
from cur_orders o
left join ver_customers c on o.customer_id = c.customer_id and {customer}
left join ver_products p on o.product_id = p.product_id and {product}
where o.{revenue}"""


def _staged_orders(feed: str) -> str:
    return f"""
select sha256(concat_ws('||', order_id, cast(cast(order_date as timestamp) as varchar),
    cast(_ingest_ts as varchar))) as order_sk,
  order_id, customer_id, product_id, quantity, unit_price, quantity * unit_price as total_amount,
  lower(trim(order_status)) as order_status, order_date, cast(year(order_date) as integer) as order_year,
  cast(month(order_date) as integer) as order_month, lower(trim(payment_method)) as payment_method,
  {_title('trim(shipping_city)')} as shipping_city, cast(order_date as timestamp) as _event_ts, _ingest_ts,
  _ingest_ts as _updated_at, timestamp '{AS_OF}' as _inserted_at, _file_mod_time, _source_file
from {feed}"""


def _staged_customers(feed: str) -> str:
    return f"""
select sha256(concat_ws('||', customer_id, cast(event_ts as varchar), cast(_ingest_ts as varchar)))
    as customer_sk,
  customer_id, {_title('trim(customer_name)')} as customer_name, lower(trim(email)) as email, signup_date,
  upper(trim(tier)) as tier, {_title('trim(city)')} as city, is_active, event_ts as _event_ts, _ingest_ts,
  _ingest_ts as _updated_at, timestamp '{AS_OF}' as _inserted_at, _file_mod_time, _source_file
from (select *, coalesce(cast(signup_date as timestamp), _ingest_ts) as event_ts from {feed})"""


CTES: dict[str, str] = {
    "feed_orders": f"""
select 'ORD-' || l_orderkey || '-' || l_linenumber as order_id, 'CUST-' || o_custkey as customer_id,
  'PROD-' || l_partkey as product_id, cast(l_quantity as integer) as quantity,
  case when l_discount < 0.05 then p_retailprice / 10 else p_retailprice / 10 - 5 end as unit_price,
  case l_returnflag when 'N' then ' Completed ' when 'A' then 'SHIPPED' else 'returned' end as order_status,
  cast(l_shipdate as date) as order_date, ' ' || o_orderpriority as payment_method,
  n_name as shipping_city, o_orderdate as _ingest_ts, o_orderdate as _file_mod_time,
  {_pad('l_partkey')} || '-' || {_pad('l_suppkey')} || '-' || {_pad('l_quantity')} as _source_file
from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey left join part on l_partkey = p_partkey""",
    "feed_customers": f"""
select 'CUST-' || o_custkey as customer_id, c_name as customer_name, c_name || '@Example.com ' as email,
  date '1995-01-01' + cast(o_custkey % 730 as integer) as signup_date,
  case when o_orderkey % 2 = 1 then c_mktsegment else o_orderpriority end as tier,
  ' ' || n_name as city, c_acctbal >= 0 as is_active, o_orderdate as _ingest_ts,
  o_orderdate as _file_mod_time, {_pad('o_orderkey')} as _source_file
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""",
    "feed_products": f"""
select case l_returnflag when 'R' then ' delete' when 'A' then 'Update' else 'INSERT' end as operation,
  l_shipdate + interval {PRODUCT_LAG_DAYS} day as cdc_timestamp, 'PROD-' || l_partkey as product_id,
  p_name as product_name, p_type as category, p_brand as brand,
  case when l_tax < 0.04 then p_retailprice / 10 else p_retailprice / 10 + 5 end as unit_price,
  cast(l_quantity as integer) - 5 as stock_quantity, l_returnflag <> 'R' as is_active,
  l_shipdate + interval {PRODUCT_LAG_DAYS} day as _ingest_ts,
  l_shipdate + interval {PRODUCT_LAG_DAYS} day as _file_mod_time,
  {_pad('l_orderkey')} || '-' || {_pad('l_linenumber')} || '-' || {_pad('l_suppkey')} as _source_file
from lineitem left join part on l_partkey = p_partkey""",
    "feed_dirty_orders": """
select * replace (case quantity when 1 then 0 when 2 then null when 3 then null else quantity end as quantity,
  case when quantity not in (4, 5) then order_date end as order_date,
  case quantity when 6 then -1.5 when 8 then null else unit_price end as unit_price,
  case when quantity <> 7 then order_id end as order_id)
from feed_orders""",
    "feed_dirty_customers": """
select * replace (case when tier = '1-URGENT' then replace(email, '@', '.') when tier <> 'BUILDING' then email end
    as email,
  case when tier not in ('2-HIGH', '3-MEDIUM') then signup_date end as signup_date)
from feed_customers""",
    "st_orders": _staged_orders("feed_orders"),
    "st_dirty_orders": _staged_orders("feed_dirty_orders"),
    "st_customers": _staged_customers("feed_customers"),
    "st_dirty_customers": _staged_customers("feed_dirty_customers"),
    "ch_customers": """
select * replace (_ingest_ts as _event_ts,
  sha256(concat_ws('||', customer_id, cast(_ingest_ts as varchar), cast(_ingest_ts as varchar)))
    as customer_sk)
from st_customers""",
    "st_products": f"""
select sha256(concat_ws('||', product_id, cast(cdc_timestamp as varchar), cast(_ingest_ts as varchar)))
    as product_sk,
  product_id, {_title('trim(product_name)')} as product_name, {_title('trim(category)')} as category,
  upper(trim(brand)) as brand, unit_price, stock_quantity, is_active, upper(trim(operation)) as operation,
  cdc_timestamp, cdc_timestamp as _event_ts, _ingest_ts, _ingest_ts as _updated_at,
  timestamp '{AS_OF}' as _inserted_at, _file_mod_time, _source_file
from feed_products""",
    "ver_orders": _versions("st_orders", "order_id"),
    "ver_customers": _versions("ch_customers", "customer_id"),
    # Sign-up dates as event times: changes of a customer are told apart by their ingest time.
    "ver_signups": _versions("st_customers", "customer_id"),
    "ver_products": _versions("st_products", "product_id", "operation = 'DELETE'"),
    "cur_orders": "select * from ver_orders where _end4 is null",
    "cur_customers": "select * from ver_customers where _end4 is null",
    "cur_products": "select * from ver_products where _end4 is null",
    "fact_oc": """
select o.order_sk, o.order_id, o.customer_id, o.product_id, o.quantity, o.unit_price, o.total_amount,
  o.order_status, o.order_date, o.order_year, o.order_month, o.payment_method, o.shipping_city,
  c.customer_sk, c.customer_name, c.email, c.signup_date, c.tier, c.city as customer_city,
  c.is_active as customer_is_active,
  case when o.total_amount >= 1000 then 'HIGH' when o.total_amount >= 300 then 'MEDIUM' else 'LOW' end
    as order_amount_band,
  cast(date_diff('day', c.signup_date, o.order_date) as integer) as customer_tenure_days,
  o.total_amount >= 1000 as is_high_value_order
from cur_orders o left join cur_customers c on o.customer_id = c.customer_id""",
    "fact_ocp": """
select o.order_sk, c.customer_sk, p.product_sk, o.order_id, o.customer_id, o.product_id, o.order_date,
  o.order_status, o.quantity, o.unit_price as order_unit_price, o.quantity * o.unit_price as line_amount,
  c.customer_name, c.tier, c.city as customer_city, p.product_name, p.category, p.brand,
  p.unit_price as product_unit_price, p.stock_quantity,
  case when p.stock_quantity <= 0 then 'OUT_OF_STOCK' when p.stock_quantity < 20 then 'LOW_STOCK'
    else 'IN_STOCK' end as product_stock_status,
  abs(o.unit_price - p.unit_price) > 0.01 as is_price_mismatch
from cur_orders o left join cur_customers c on o.customer_id = c.customer_id
  left join cur_products p on o.product_id = p.product_id""",
    "metrics": f"""
select customer_id, count(distinct order_id) as total_orders, {_total('total_amount')} as lifetime_value,
  {_mean('total_amount')} as avg_order_value, min(order_date) as first_order_date,
  max(order_date) as last_order_date, count(*) filter (where is_high_value_order) as high_value_order_count
from fact_oc where order_status = 'completed' group by customer_id""",
    "pit": _PIT_SELECT.format(
        customer=_valid("c", "o"), product=_valid("p", "o"), revenue=_REVENUE
    ),
    "pit_event": _PIT_SELECT.format(
        customer=_valid_event("c", "o"), product=_valid_event("p", "o"), revenue=_REVENUE
    ),
    "daily": f"""
select order_date, shipping_city, payment_method, {_total('total_amount')} as daily_revenue,
  count(distinct order_id) as order_count, {_mean('total_amount')} as avg_order_value,
  cast(sum(quantity) as bigint) as total_items_sold
from fact_oc where {_REVENUE} group by order_date, shipping_city, payment_method""",
    "ch_events": f"""
select 'USER-' || user_id as user_id, event_id, event_type, value, ts as _event_ts, ts as _ingest_ts,
  ts as _file_mod_time, {_pad('event_id')} as _source_file from events""",
}


def with_ctes(body: str) -> str:
    """The body preceded by the shared parts it uses."""

    def used_by(text: str) -> set[str]:
        return {name for name in CTES if re.search(rf"\b{name}\b", text)}

    needed, queue = set(), used_by(body)
    while queue:
        name = queue.pop()
        needed.add(name)
        queue |= used_by(CTES[name]) - needed
    parts = [f"{name} as ({CTES[name]})" for name in CTES if name in needed]
    return f"with {', '.join(parts)} {body}" if parts else body


_AUDIT = (
    f"{_ts('_event_ts')} as _event_ts, {_ts('_ingest_ts')} as _ingest_ts,"
    f" {_ts('_updated_at')} as _updated_at, {_ts('_inserted_at')} as _inserted_at,"
    f" {_ts('_file_mod_time')} as _file_mod_time, _source_file"
)
_ORDER_COLUMNS = (
    "order_sk, order_id, customer_id, product_id, quantity, unit_price, total_amount, order_status,"
    f" {_day('order_date')} as order_date, order_year, order_month, payment_method, shipping_city"
)
_CUSTOMER_COLUMNS = (
    f"customer_sk, customer_id, customer_name, email, {_day('signup_date')} as signup_date, tier, city,"
    " is_active"
)
_PRODUCT_COLUMNS = (
    "product_sk, product_id, product_name, category, brand, unit_price, stock_quantity, is_active,"
    f" operation, {_ts('cdc_timestamp')} as cdc_timestamp"
)
_SPAN = (
    f"{_ts('_event_ts')} as start_event_ts, _source_file as start_source_file,"
    f" {_ts('_end1')} as end_event_ts, {_ts('_end2')} as end_ingest_ts, _end4 as end_source_file"
)
_EVENT_COLUMNS = f"user_id, event_id, event_type, value, {_SPAN}"


def _report(source: str, rules: list[tuple[str, str, str]]) -> str:
    lines = [
        f"select '{name}' as rule, '{action}' as action,"
        f" count(*) filter (where not coalesce({condition}, false)) as failed_rows,"
        f" count(*) as total_rows from {source}"
        for action, name, condition in rules
    ]
    return " union all ".join(lines)


_WARN, _DROP, _FAIL = "expect", "expect_or_drop", "expect_or_fail"
_RULES_ORDERS = [
    (_WARN, "valid_order_id", "order_id is not null"),
    (_WARN, "valid_date", "order_date is not null"),
    (_DROP, "positive_quantity", "quantity > 0"),
    (_DROP, "positive_price", "unit_price > 0"),
]
_RULES_CUSTOMERS = [
    (_WARN, "valid_email", "email like '%@%'"),
    (_FAIL, "customer_id_not_null", "customer_id is not null"),
]
_RULES_DAILY = [
    (_WARN, "has_revenue", "daily_revenue > 0"),
    (_WARN, "valid_order_date", "order_date is not null"),
]
_RULES_PIT = [
    (_WARN, "has_order_id", "order_id is not null"),
    (_WARN, "has_customer_dim", "customer_sk is not null"),
    (_WARN, "has_product_dim", "product_sk is not null"),
]
_RULES_PRODUCTS = [
    (_WARN, "valid_product_id", "product_id is not null"),
    (_WARN, "valid_event_ts", "_event_ts is not null"),
    (_WARN, "non_negative_price", "unit_price >= 0"),
    (_WARN, "non_negative_stock", "stock_quantity >= 0"),
]



def _covered(source: str) -> str:
    """How many versions of each customer start before an earlier one has ended."""
    starts = [", ".join(f"{side}.{c}" for c in _SEQ) for side in "ab"]
    ends = ", ".join(f"a._end{i}" for i in range(1, 5))
    return f"""select b.customer_id, count(distinct b.customer_sk || b._source_file) as overlaps
  from ({source}) a join ({source}) b on a.customer_id = b.customer_id and ({starts[0]}) < ({starts[1]})
    and (a._end4 is null or ({ends}) > ({starts[1]})) group by b.customer_id"""


_PIT_OUT = f"""* replace ({_day('order_date')} as order_date, {_ts('order_event_ts')} as order_event_ts,
  {_day('signup_date')} as signup_date)"""
_RAW_ORDERS = (
    "order_id, customer_id, product_id, quantity, unit_price, trim(order_status) as order_status,"
    f" {_day('order_date')} as order_date, trim(payment_method) as payment_method, shipping_city"
)

BODIES: dict[str, str] = {
    "stage_orders": f"select {_ORDER_COLUMNS}, {_AUDIT} from st_orders",
    "stage_customers": f"select {_CUSTOMER_COLUMNS}, {_AUDIT} from st_customers",
    "stage_products": f"select {_PRODUCT_COLUMNS}, {_AUDIT} from st_products",
    "surrogate_key": "select order_id, order_sk from st_orders",
    "filter_completed_shipped": f"select order_sk, order_status from st_orders where {_REVENUE}",
    "scd2_orders": f"select {_ORDER_COLUMNS}, {_SPAN} from ver_orders",
    "scd2_customers": f"select {_CUSTOMER_COLUMNS}, {_SPAN} from ver_customers",
    "scd2_products": f"select {_PRODUCT_COLUMNS}, {_SPAN} from ver_products",
    "scd2_current_customers": f"select {_CUSTOMER_COLUMNS} from cur_customers",
    "scd2_current_products": f"select {_PRODUCT_COLUMNS} from cur_products",
    "scd2_late_arrival": f"select {_CUSTOMER_COLUMNS}, {_SPAN} from ver_customers",
    "scd2_replay": f"select {_PRODUCT_COLUMNS}, {_SPAN} from ver_products",
    "dedup_orders_latest": f"""select {_ORDER_COLUMNS}, cast(_record_number as integer) as _record_number from (
  select *, row_number() over (partition by order_id, _event_ts
    order by _ingest_ts desc, _file_mod_time desc, _source_file desc) as _record_number from st_orders)
  where _record_number = 1""",
    "check_scd2_overlap": _covered("select * from ver_customers"),
    "check_overlap_nested": _covered("""select * replace (
    case when tier = 'BUILDING' then _end1 + interval 400 day else _end1 end as _end1) from ver_customers"""),
    "fact_order_customer": f"""select * replace ({_day('order_date')} as order_date,
  {_day('signup_date')} as signup_date) from fact_oc""",
    "fact_order_customer_product": f"select * replace ({_day('order_date')} as order_date) from fact_ocp",
    "fact_append_new": "select order_sk, order_id, customer_sk, order_amount_band from fact_oc",
    "amount_band": "select order_sk, order_amount_band, is_high_value_order from fact_oc",
    "stock_status": "select product_sk, stock_quantity, case when stock_quantity <= 0 then 'OUT_OF_STOCK'"
    " when stock_quantity < 20 then 'LOW_STOCK' else 'IN_STOCK' end as stock_status from st_products",
    "tenure_bucket": "select order_sk, customer_tenure_days, case when customer_tenure_days < 30 then 'NEW'"
    " when customer_tenure_days < 180 then 'GROWING' else 'ESTABLISHED' end as tenure_bucket from fact_oc",
    "price_match": "select order_sk, order_unit_price, product_unit_price, is_price_mismatch,"
    " case when abs(order_unit_price - product_unit_price) <= 0.01 then 'MATCH' else 'MISMATCH' end"
    " as price_match_flag from fact_ocp",
    "pit_fact": f"select {_PIT_OUT} from pit",
    "pit_join_event_time": f"select {_PIT_OUT} from pit_event",
    "pit_join_customer": f"""select o.order_sk, c.customer_sk, c.tier from cur_orders o
  left join ver_customers c on o.customer_id = c.customer_id and {_valid('c', 'o')}""",
    "pit_join_product": f"""select o.order_sk, p.product_sk, p.unit_price as catalog_unit_price
  from cur_orders o left join ver_products p on o.product_id = p.product_id and {_valid('p', 'o')}""",
    "pit_join_from_changes": f"""select o.order_sk, p.product_sk, p.unit_price as catalog_unit_price
  from cur_orders o left join ver_products p on o.product_id = p.product_id and {_valid('p', 'o')}""",
    "pit_revenue_by_tier": f"""select tier, category, count(*) as order_lines,
  {_total('line_amount')} as revenue, cast(sum(quantity) as bigint) as quantity
  from pit group by tier, category""",
    "check_pit_unique": """select order_id, customer_id, product_id, count(*) as cnt from pit
  group by order_id, customer_id, product_id having count(*) > 1""",
    "check_pit_missing_dims": """select count(*) filter (where customer_sk is null) as missing_customer_dim,
  count(*) filter (where product_sk is null) as missing_product_dim, count(*) as total_rows,
  greatest(count(*) filter (where customer_sk is null), count(*) filter (where product_sk is null))
    <= 0.5 * count(*) as within_threshold from pit""",
    "check_negative_values": "select order_sk, quantity, stock_quantity from pit"
    " where quantity < 0 or order_unit_price < 0 or stock_quantity < 0",
    "check_freshness": f"""select case when count(*) > 0 then '{AS_OF}.000000' end as newest_load_ts,
  count(*) > 0 as is_fresh from pit""",
    "mart_daily_revenue": f"select * replace ({_day('order_date')} as order_date) from daily",
    "published_daily_revenue": f"select * replace ({_day('order_date')} as order_date) from daily",
    "mart_daily_revenue_maintained": f"""select {_day('order_date')} as order_date, shipping_city,
  payment_method, cast(sum(cast(round(total_amount * 10000) as bigint)) as double) / 10000 as daily_revenue,
  count(*) as order_count, cast(sum(cast(round(total_amount * 10000) as bigint)) as double) / 10000
    / count(total_amount) as avg_order_value, cast(sum(quantity) as bigint) as total_items_sold
  from cur_orders where {_REVENUE} group by all""",
    "agg_customer_metrics": f"""select * replace ({_day('first_order_date')} as first_order_date,
  {_day('last_order_date')} as last_order_date) from metrics""",
    "mart_customer_360": f"""select c.customer_id, c.customer_sk, c.customer_name, c.email,
  {_day('c.signup_date')} as signup_date, c.tier, c.city, c.is_active,
  coalesce(total_orders, 0) as total_orders, coalesce(lifetime_value, 0.0) as lifetime_value,
  coalesce(avg_order_value, 0.0) as avg_order_value,
  {_day('first_order_date')} as first_order_date, {_day('last_order_date')} as last_order_date,
  coalesce(high_value_order_count, 0) as high_value_order_count,
  cast(date_diff('day', last_order_date, date '{AS_OF[:10]}') as integer) as days_since_last_order,
  case when lifetime_value > 5000 then 'high_value' when lifetime_value > 1000 then 'medium_value'
    when lifetime_value > 0 then 'low_value' else 'no_purchases' end as customer_segment
  from cur_customers c left join metrics m on c.customer_id = m.customer_id""",
    "mart_top_products": f"""select *, cast(dense_rank() over (order by total_revenue desc nulls last)
    as integer) as revenue_rank
  from (select product_id, product_name, category, brand, count(distinct order_id) as total_orders,
    {_total('line_amount')} as total_revenue, cast(sum(quantity) as bigint) as total_quantity,
    {_mean('order_unit_price')} as avg_selling_price,
    {_mean('product_unit_price')} as avg_catalog_price,
    count(distinct customer_id) as unique_buyers, max(stock_quantity) as latest_stock_quantity
    from fact_ocp where {_REVENUE} group by product_id, product_name, category, brand)""",
    "mart_executive_kpis": f"""select count(distinct order_id) as orders_count,
  {_total('line_amount')} as gross_revenue, {_mean('line_amount')} as avg_order_value,
  count(distinct customer_id) as active_customers, count(distinct product_id) as active_products,
  count(*) filter (where product_stock_status = 'OUT_OF_STOCK') as out_of_stock_order_lines,
  '{AS_OF}.000000' as kpi_computed_at from fact_ocp where {_REVENUE}""",
    "scd2_customers_by_signup": f"select {_CUSTOMER_COLUMNS}, {_SPAN} from ver_signups",
    "pit_join_customer_by_signup": f"""select o.order_sk, c.customer_sk, c.tier from cur_orders o
  left join ver_signups c on o.customer_id = c.customer_id and {_valid('c', 'o')}""",
    "hot_scd2_products": f"select {_PRODUCT_COLUMNS}, {_SPAN} from ver_products",
    "hot_pit_join_product": f"""select o.order_sk, p.product_sk, p.unit_price as catalog_unit_price
  from cur_orders o left join ver_products p on o.product_id = p.product_id and {_valid('p', 'o')}""",
    "hot_fact_order_customer": f"""select * replace ({_day('order_date')} as order_date,
  {_day('signup_date')} as signup_date) from fact_oc""",
    "stored_current_products": f"select {_PRODUCT_COLUMNS} from cur_products",
    "stage_dirty_orders": f"select {_ORDER_COLUMNS}, {_AUDIT} from st_dirty_orders",
    "stage_dirty_customers": f"select {_CUSTOMER_COLUMNS}, {_AUDIT} from st_dirty_customers",
    "scd2_dirty_customers": "select {}, {} from ({})".format(
        _CUSTOMER_COLUMNS, _SPAN, _versions("st_dirty_customers", "customer_id")
    ),
    "dq_drop_dirty_orders": """select order_sk, quantity, unit_price from st_dirty_orders
  where quantity > 0 and unit_price > 0""",
    "dq_report_dirty": " union all ".join(
        f"select '{name}' as table_name, * from ({_report(source, rules)})"
        for name, source, rules in (
            ("orders", "st_dirty_orders", _RULES_ORDERS),
            ("customers", "st_dirty_customers", _RULES_CUSTOMERS),
        )
    ),
    "dq_report_stream": _report("st_dirty_orders", _RULES_ORDERS),
    "check_overlap_found": f"""select customer_id, count(*) as overlaps from (
    select customer_id, {", ".join(
        f"case when tier <> 'BUILDING' then _end{i} end as e{i}, lead({c}) over w as n{i}"
        for i, c in enumerate(_SEQ, 1)
    )}
    from ver_customers window w as (partition by customer_id order by {', '.join(_SEQ)}))
  where n4 is not null and (e4 is null or (e1, e2, e3, e4) > (n1, n2, n3, n4)) group by customer_id""",
    "check_pit_duplicates": """select order_id, customer_id, product_id, count(*) as cnt
  from (select order_id, customer_id, product_id from pit union all
    select order_id, customer_id, product_id from pit where price_match_flag = 'MATCH')
  group by order_id, customer_id, product_id having count(*) > 1""",
    "check_freshness_by_customer": f"""select customer_id, {_ts('max(_ingest_ts)')} as newest_load_ts,
  epoch(timestamp '{AS_OF}') - epoch(max(_ingest_ts)) <= 365 * 24 * 3600 as is_fresh
  from st_customers group by customer_id""",
    "dq_warn_email": "select customer_sk, email from st_customers",
    "dq_drop_orders": "select order_sk, quantity, unit_price from st_orders where quantity > 0 and unit_price > 0",
    "dq_drop_products": "select product_sk, stock_quantity from st_products where stock_quantity >= 0",
    "dq_fail_customers": "select customer_sk, customer_id from st_customers",
    "dq_report": " union all ".join(
        f"select '{name}' as table_name, * from ({_report(source, rules)})"
        for name, source, rules in (
            ("orders", "st_orders", _RULES_ORDERS),
            ("customers", "st_customers", _RULES_CUSTOMERS),
            ("daily_revenue", "daily", _RULES_DAILY),
            ("pit_fact", "pit", _RULES_PIT),
        )
    ),
    "dq_products": _report("st_products", _RULES_PRODUCTS),
    "csv_roundtrip": f"select {_RAW_ORDERS} from feed_orders",
    "stream_ingest_csv": f"select {_RAW_ORDERS}, true as has_lineage from feed_orders",
    "ingest_infer_types": f"""select customer_id, customer_name, trim(email) as email,
  {_day('signup_date')} as signup_date, tier, trim(city) as city, is_active,
  {_ts('_ingest_ts')} as change_ts from feed_customers""",
    "schema_add_columns": f"""select customer_id, tier,
  case when _ingest_ts >= timestamp '1999-01-01' then trim(city) end as city,
  {_day('signup_date')} as signup_date, {_ts('_ingest_ts')} as change_ts from feed_customers""",
    "backfill_then_stream": f"""select product_id, trim(operation) as operation, unit_price,
  {_ts('cdc_timestamp')} as cdc_timestamp, _source_file as feed_position from feed_products""",
    "stream_stage_orders": f"select {_ORDER_COLUMNS}, {_AUDIT} from st_orders",
    "stream_scd2_upsert": f"select {_EVENT_COLUMNS} from ({_versions('ch_events', 'user_id')})",
    "stream_scd2_upkeep": f"select {_EVENT_COLUMNS} from ({_versions('ch_events', 'user_id')})",
    "flows_with_one_failing": """select 'orders' as flow, order_id as id, count(*) as rows
  from feed_orders group by all union all
  select 'products' as flow, product_id as id, count(*) as rows from feed_products group by all""",
    "stream_scd2_deletes": "select {} from ({})".format(
        _EVENT_COLUMNS, _versions("ch_events", "user_id", "event_type = 'error'")
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
