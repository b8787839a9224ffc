"""Oracle SQL for the registered queries, written for DuckDB over the raw sample tables.

Derived tables are named ``x_...``; a query pulls in the ones it mentions, and theirs.
"""

from __future__ import annotations

import re

# Cents-exact scaling of a price column.
def _money(price: str, divisor: int) -> str:
    return f"CAST(CAST(floor(CAST(round({price} * 100) AS BIGINT) / {divisor}.0) AS BIGINT) * 0.01 AS DECIMAL(18,2))"


def _cents(price: str, divisor: int) -> str:
    return f"CAST(floor(CAST(round({price} * 100) AS BIGINT) / {divisor}.0) AS BIGINT)"


def _as_money(cents: str) -> str:
    return f"CAST(({cents}) * 0.01 AS DECIMAL(18,2))"


_TRAFFIC = (
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'direct' WHEN o_orderpriority = '5-LOW' THEN '' "
    "WHEN o_orderpriority = '3-MEDIUM' THEN 'facebook' ELSE 'google' END"
)
_K = "json_extract_string(props, '$.k')"
_ASOF = "DATE '2001-08-02'"
_EVENT_ASOF = "DATE '2024-01-31'"


def _dim_order(divisor: int) -> str:
    return f"""
SELECT o_orderkey AS order_id, '#' || o_orderkey AS order_name, l.shop_id, CAST(s_nationkey AS BIGINT) AS merchant_id,
  o_orderdate AS order_created_at, CASE WHEN o_totalprice < 2000 THEN 1 ELSE 0 END AS is_test,
  CASE WHEN o_custkey % 10 < 4 THEN 'Guest' || o_orderkey WHEN o_custkey % 10 < 7 THEN 'Agent'
    ELSE 'Buyer' || o_custkey END || CASE o_orderpriority WHEN '1-URGENT' THEN '@Mailinator.example' WHEN '2-HIGH' THEN '@mail'
    ELSE '@Buyers.example' END AS buyer_email,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Stripe' WHEN '2-HIGH' THEN 'PayPal' ELSE 'Airwallex' END AS payment_gateway,
  {_TRAFFIC} AS source,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN NULL ELSE {_as_money('g')} END AS gmv,
  CASE WHEN wd <> 6 THEN {_as_money('g - CAST(floor(g * (103 - dom * 3) / 100.0) AS BIGINT)')} END AS merchant_profit,
  base_cost_margin, total_quantity, lines,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN floor(top_price / 60.0) END AS miles,
  wd, o_orderstatus AS status, o_orderpriority AS priority, {_as_money('top_line_cents')} AS top_line, last_ship
FROM (SELECT *, {_cents('o_totalprice', divisor)} AS g, isodow(o_orderdate) - 1 AS wd, day(o_orderdate) AS dom FROM orders) o
LEFT JOIN x_lines l ON l.order_id = o.o_orderkey
LEFT JOIN supplier ON s_suppkey = l.shop_id"""


_ROLES = {
    "x_shops": """
SELECT c_custkey AS shop_id, CAST(1000 + c_nationkey AS BIGINT) AS user_id,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 0 ELSE 1 END AS is_public_domain, n_name AS merchant_country
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "x_sales": f"""
SELECT o_orderkey AS order_id, o_custkey AS shop_id, o_orderdate >= DATE '1996-01-01' AS recent, {_as_money('g')} AS gmv,
  {_as_money('g - CAST(floor(g * (103 - day(o_orderdate)) / 100.0) AS BIGINT)')} AS profit,
  {_TRAFFIC} IN ('direct', '') AS direct, month(o_orderdate) IN (11, 12, 1) AS peak, isodow(o_orderdate) = 7 AS abroad
FROM (SELECT *, {_cents('o_totalprice', 400)} AS g FROM orders)""",
    "x_disputed_lines": "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.1 AND l_tax >= 0.07",
    "x_disputes": f"""
SELECT o_custkey AS shop_id, l_orderkey AS order_id, {_money('l_extendedprice', 400)} AS amount
FROM x_disputed_lines JOIN orders ON o_orderkey = l_orderkey""",
    "x_consolidated": """
SELECT s.*, coalesce(total_orders, 0) AS total_orders, coalesce(CAST(total_gmv AS DOUBLE), 0) AS total_gmv,
  coalesce(CAST(total_profit AS DOUBLE), 0) AS total_profit, coalesce(avg_profit_3d, 0) AS avg_profit_3d,
  coalesce(max_gmv_3d, 0) AS max_gmv_3d, coalesce(direct_orders_3d, 0) AS direct_orders_3d,
  coalesce(high_attempt_orders, 0) AS high_attempt_orders, coalesce(geo_mismatch_orders, 0) AS geo_mismatch_orders,
  coalesce(distinct_session_ips, 0) AS distinct_session_ips, coalesce(total_disputes, 0) AS total_disputes,
  coalesce(CAST(total_dispute_amount AS DOUBLE), 0) AS total_dispute_amount, coalesce(total_events, 0) AS total_events,
  coalesce(coalesce(total_disputes, 0) / total_orders, 0) AS dispute_rate,
  coalesce(direct_orders_3d / total_orders, 0) AS direct_traffic_ratio
FROM x_shops s
LEFT JOIN x_sales_totals USING (shop_id) LEFT JOIN x_session_totals USING (shop_id)
LEFT JOIN x_dispute_totals USING (shop_id)""",
    "x_sales_totals": """
SELECT shop_id, count(*) AS total_orders, sum(gmv) AS total_gmv, sum(profit) AS total_profit,
  CAST(sum(profit) FILTER (recent) AS DOUBLE) / nullif(count(*) FILTER (recent), 0) AS avg_profit_3d,
  CAST(max(gmv) FILTER (recent) AS DOUBLE) AS max_gmv_3d, count(*) FILTER (recent AND direct) AS direct_orders_3d,
  count(*) FILTER (peak) AS high_attempt_orders, count(*) FILTER (abroad) AS geo_mismatch_orders,
  count(*) FILTER (recent) AS recent_orders
FROM x_sales GROUP BY shop_id""",
    "x_session_totals": f"""
SELECT user_id AS shop_id, count(DISTINCT {_K}) AS distinct_session_ips, count(event_id) AS total_events
FROM events GROUP BY user_id""",
    "x_dispute_totals": """
SELECT shop_id, count(*) AS total_disputes, sum(amount) AS total_dispute_amount FROM x_disputes GROUP BY shop_id""",
    "x_action": """
SELECT *, CASE WHEN dispute_rate > 0.035 OR high_attempt_orders >= 5 THEN 'Hold for Ledger Audit'
  WHEN total_gmv >= 10000 OR geo_mismatch_orders >= 3 THEN 'Tier-2 Signoff Required'
  WHEN is_public_domain = 0 AND direct_traffic_ratio > 0.8 THEN 'Hold for Catalog Audit'
  ELSE 'Auto-Disburse Approved' END AS suggested_action FROM x_consolidated""",
    "x_lines": f"""
SELECT l_orderkey AS order_id, min(l_suppkey) AS shop_id, CAST(sum(l_quantity) AS BIGINT) AS total_quantity,
  count(*) AS lines, max(l_discount + l_tax) AS base_cost_margin, max(floor(l_extendedprice)) AS top_price,
  max({_cents('l_extendedprice', 8)}) AS top_line_cents, max(l_shipdate) AS last_ship,
  max(CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END) AS has_return
FROM lineitem GROUP BY l_orderkey""",
    "x_order": _dim_order(400),
    "x_order_large": _dim_order(8),
    "x_merchant": """
SELECT CAST(n_nationkey AS BIGINT) AS merchant_id, CASE n_name WHEN 'NATION_3' THEN 'nation_3@internal-testing.com'
  WHEN 'NATION_7' THEN NULL ELSE lower(n_name) || '@merchant.example' END AS email,
  DATE '2024-01-31' - n_nationkey * 3 AS created_at FROM nation""",
    "x_store": """
SELECT s_suppkey AS shop_id, CAST(s_nationkey AS BIGINT) AS merchant_id, n AS total_order_count,
  bad AS total_disputed_orders, CASE WHEN s_acctbal >= 5000 THEN 'enterprise' ELSE 'standard' END AS store_segment
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n,
  count(*) FILTER (l_returnflag = 'R' AND l_discount >= 0.09 AND l_tax >= 0.03) AS bad FROM lineitem GROUP BY l_suppkey)
  ON l_suppkey = s_suppkey""",
    "x_codes": """
SELECT * FROM (VALUES ('gateway_a', 'deliver in person', 'DECLINE_INSUFFICIENT'), ('gateway_a', 'collect cod', 'RETRY_LATER'),
  ('gateway_a', 'collect cod', 'SOFT_FAILURE'), ('gateway_a', 'none', 'DO_NOT_HONOR'),
  ('gateway_b', 'return requested', 'SOFT_FAILURE'), ('gateway_b', 'return requested', 'RETRY_LATER'),
  ('gateway_b', 'accepted', 'OK'), ('gateway_b', 'not returned', 'HARD_DECLINE'),
  ('paypal', 'open  line', 'INSTRUMENT_OPEN'), ('paypal', 'open line', 'PENDING'), ('paypal', 'filled line', 'SETTLED'),
  ('stripe', 'card_declined', 'CARD_DECLINE'), ('stripe', 'expired_card', 'EXPIRED'), ('stripe', 'incorrect_cvc', 'CVC'))
  AS c(gateway, reason, signal_code)""",
    "x_response": """
SELECT l_orderkey AS checkout_id, 'gateway_a' AS gateway, CASE WHEN l_tax >= 0.08 THEN 'deliver in person'
  WHEN l_tax >= 0.02 THEN 'collect cod' END AS reason FROM lineitem WHERE l_returnflag = 'A'
UNION ALL
SELECT l_orderkey, 'gateway_b', CASE WHEN l_tax >= 0.08 THEN 'not returned' WHEN l_tax >= 0.03 THEN 'return requested'
  ELSE 'unmapped' END FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, 'paypal', CASE l_linestatus WHEN 'O' THEN 'open line' ELSE 'filled line' END
  FROM lineitem WHERE l_returnflag = 'N'
UNION ALL
SELECT l_orderkey, 'stripe', CASE WHEN l_discount >= 0.1 THEN 'card_declined' WHEN l_discount >= 0.05 THEN 'expired_card'
  ELSE 'incorrect_cvc' END FROM lineitem WHERE l_linestatus = 'F'""",
    "x_coded": "SELECT checkout_id, r.gateway, signal_code FROM x_response r LEFT JOIN x_codes c USING (gateway, reason)",
    "x_routed": """
SELECT o.*, m.email AS merchant_email, coalesce(gmv, 0) AS gmv0, coalesce(merchant_profit, 0) AS profit0,
  coalesce(abs(CAST(merchant_profit AS DOUBLE)) / nullif(CAST(gmv AS DOUBLE), 0), 0) AS margin,
  coalesce(lines, 0) AS attempts, coalesce(CAST(floor(total_quantity / 2) AS INTEGER), 0) AS latency,
  coalesce(miles, 0) AS distance, coalesce(base_cost_margin, 0) AS unit_margin,
  CASE priority WHEN '5-LOW' THEN 0 WHEN '2-HIGH' THEN 1 END AS public_domain,
  EXISTS (SELECT 1 FROM x_coded c WHERE c.checkout_id = o.order_id AND signal_code LIKE '%DECLINE%') AS declined
FROM x_order o LEFT JOIN x_merchant m USING (merchant_id) WHERE is_test = 0""",
    "x_rules": """
SELECT *, (declined OR attempts >= 12 OR latency >= 75) AS fallback,
  coalesce(unit_margin <= 0.10 AND public_domain = 0, FALSE) AS unlisted,
  (margin >= 0.80 OR (unit_margin <= 0.10 AND gmv0 >= 250)) AS pricing,
  ((status = 'F' AND distance > 1000) OR gmv0 >= 1000) AS second_look
FROM x_routed""",
    "x_decided": """
SELECT *, CASE WHEN fallback THEN 'Route to Fallback Gateway' WHEN unlisted THEN 'Hold for Catalog Audit'
  WHEN pricing THEN 'Hold for Margin Reconciliation' WHEN second_look THEN 'Route to Secondary Validation'
  ELSE 'Auto-Route to Primary Gateway' END AS prescribed_routing_action,
  concat_ws(' ', CASE WHEN declined THEN 'GATEWAY_DECLINE' END, CASE WHEN attempts >= 12 THEN 'RETRY_BURST' END,
    CASE WHEN latency >= 75 THEN 'GATEWAY_LATENCY' END, CASE WHEN distance > 1000 THEN 'GEO_DISTANCE_OUTLIER' END,
    CASE WHEN source IN ('direct', '') THEN 'DIRECT_TRAFFIC' END, CASE WHEN gmv0 >= 1000 THEN 'HIGH_ORDER_VALUE' END,
    CASE WHEN unit_margin <= 0.10 THEN 'LOW_UNIT_MARGIN' END) AS routing_telemetry_codes
FROM x_rules""",
    "x_buyer_day": """
SELECT lower(buyer_email) AS buyer, CAST(order_created_at AS DATE) AS day, count(*) AS n FROM x_order GROUP BY ALL""",
    "x_buyer_total": """
SELECT lower(buyer_email) AS buyer, count(*) AS n, count(*) FILTER (status IN ('F', 'P')) AS returned
FROM x_order GROUP BY ALL""",
    "x_active": f"""
SELECT shop_id, o.merchant_id, max(email) AS merchant_email, max(CAST(order_created_at AS DATE)) AS latest_active_date
FROM x_order o LEFT JOIN x_merchant m USING (merchant_id)
WHERE is_test = 0 AND CAST(order_created_at AS DATE) >= {_ASOF} - 14 GROUP BY ALL""",
    "x_payout": """
SELECT CAST(n_nationkey AS BIGINT) AS merchant_id, lower(n_name) || '@payout.example' AS mail FROM nation
UNION ALL SELECT n_nationkey, 'shared@payout.example' FROM nation WHERE n_name IN ('NATION_5', 'NATION_9')""",
    "x_restricted": """
SELECT merchant_id, 1 AS is_matched, string_agg(DISTINCT entry, ', ' ORDER BY entry) AS flagged_destination_emails
FROM x_payout JOIN (VALUES (' Nation_5@Payout.Example'), ('nation_17@payout.example'), ('extra@payout.example'),
  ('Shared@Payout.example')) r(entry) ON mail = lower(trim(entry)) GROUP BY merchant_id""",
    "x_windowed": f"""
SELECT coalesce(s.shop_id, f.shop_id) AS shop_id, s.* EXCLUDE (shop_id), f.* EXCLUDE (shop_id) FROM (
  SELECT shop_id,
    CAST(sum(merchant_profit) FILTER (d <= 4) AS DOUBLE) / nullif(count(merchant_profit) FILTER (d <= 4), 0) AS avg_profit_l3d,
    CAST(sum(merchant_profit) FILTER (d <= 8) AS DOUBLE) / nullif(count(merchant_profit) FILTER (d <= 8), 0) AS avg_profit_l7d,
    CAST(sum(merchant_profit) AS DOUBLE) / nullif(count(merchant_profit), 0) AS avg_profit_l30d,
    CAST(sum(gmv) FILTER (d <= 4) AS DOUBLE) / nullif(count(gmv) FILTER (d <= 4), 0) AS avg_gmv_l3d,
    CAST(sum(gmv) FILTER (d <= 8) AS DOUBLE) / nullif(count(gmv) FILTER (d <= 8), 0) AS avg_gmv_l7d,
    CAST(sum(gmv) AS DOUBLE) / nullif(count(gmv), 0) AS avg_gmv_l30d,
    CAST(max(top_line) FILTER (d <= 4) AS DOUBLE) AS max_lineitem_gmv_l3d,
    CAST(max(top_line) FILTER (d <= 8) AS DOUBLE) AS max_lineitem_gmv_l7d,
    count(*) FILTER (d <= 4 AND direct) / nullif(count(*) FILTER (d <= 4), 0) AS pct_direct_traffic_l3d,
    count(*) FILTER (d <= 8 AND direct) / nullif(count(*) FILTER (d <= 8), 0) AS pct_direct_traffic_l7d,
    count(*) FILTER (direct) / count(*) AS pct_direct_traffic_l30d,
    count(*) FILTER (source = 'facebook') / count(*) AS pct_social_traffic_l30d
  FROM (SELECT *, date_diff('day', CAST(order_created_at AS DATE), {_ASOF}) AS d, source IN ('direct', '') AS direct
        FROM x_order_large) WHERE d BETWEEN 1 AND 31 GROUP BY shop_id) s
FULL JOIN (
  SELECT user_id AS shop_id,
    count(*) FILTER (d <= 4 AND event_type = 'purchase') / nullif(count(*) FILTER (d <= 4 AND event_type = 'view'), 0) AS cr_view_to_purchase_l3d,
    count(*) FILTER (d <= 8 AND event_type = 'purchase') / nullif(count(*) FILTER (d <= 8 AND event_type = 'view'), 0) AS cr_view_to_purchase_l7d,
    count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'view'), 0) AS cr_view_to_purchase_l30d
  FROM (SELECT *, date_diff('day', CAST(ts AS DATE), {_EVENT_ASOF}) AS d FROM events)
  WHERE d BETWEEN 1 AND 31 GROUP BY user_id) f ON f.shop_id = s.shop_id""",
    "x_mail_quality": r"""
SELECT shop_id, count(*) FILTER (split_part(mail, '@', 2) IN ('mailinator.example', 'tempmail.example')) / count(*) AS disposable_email_rate,
  count(*) FILTER (NOT regexp_full_match(mail, '[a-z0-9._%+-]+@[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,}')) / count(*) AS invalid_email_rate
FROM (SELECT shop_id, lower(trim(buyer_email)) AS mail FROM x_order) GROUP BY shop_id""",
    "x_roaming": """
SELECT shop_id, count(*) AS buyer_count, CAST(sum(roams) AS BIGINT) AS multi_store_buyers, sum(roams) / count(*) AS multi_store_buyer_rate
FROM (SELECT shop_id, CASE WHEN count(*) OVER (PARTITION BY buyer) >= 2 THEN 1 ELSE 0 END AS roams
      FROM (SELECT DISTINCT shop_id, lower(buyer_email) AS buyer FROM x_order WHERE shop_id IS NOT NULL))
GROUP BY shop_id""",
    "x_metrics": """
SELECT s.shop_id, s.merchant_id, s.total_disputed_orders, t.*  EXCLUDE (shop_id), q.* EXCLUDE (shop_id), multi_store_buyer_rate,
  unique_ip_location_count, f.primary_rate AS payment_failure_rate_primary_gateway, w.* EXCLUDE (shop_id),
  r_name AS merchant_country, n_name AS merchant_city,
  total_refunded_orders / nullif(total_order_count, 0) AS dispute_order_ratio
FROM (SELECT shop_id, merchant_id, total_disputed_orders FROM x_store) s
LEFT JOIN (SELECT shop_id, count(*) AS total_order_count, count(*) FILTER (status = 'P' OR shop_id % 9 = 0) AS total_refunded_orders FROM x_order GROUP BY 1) t
  ON t.shop_id = s.shop_id
LEFT JOIN x_mail_quality q ON q.shop_id = s.shop_id LEFT JOIN x_roaming r ON r.shop_id = s.shop_id
LEFT JOIN (SELECT shop_id, distinct_session_ips AS unique_ip_location_count FROM x_session_totals) i ON i.shop_id = s.shop_id
LEFT JOIN (SELECT user_id AS shop_id, count(*) FILTER (event_type = 'error' OR (user_id % 7 = 0 AND event_type IN ('signup', 'click'))) / count(*)
  AS primary_rate FROM events GROUP BY 1) f
  ON f.shop_id = s.shop_id
LEFT JOIN x_windowed w ON w.shop_id = s.shop_id
LEFT JOIN nation ON n_nationkey = s.merchant_id LEFT JOIN region ON r_regionkey = n_regionkey""",
    "x_health": """
SELECT m.*, a.merchant_email, coalesce(is_matched, 0) AS is_disbursement_restricted, flagged_destination_emails
FROM x_metrics m JOIN x_active a ON a.shop_id = m.shop_id LEFT JOIN x_restricted r ON r.merchant_id = m.merchant_id""",
    "x_request": f"""
SELECT o_orderkey AS settlement_id, CAST(c_nationkey AS BIGINT) AS merchant_id, lower(c_mktsegment) AS store_segment,
  {_money('o_totalprice', 30)} AS requested, {_money('o_totalprice', 300)} AS reserve, o_orderdate AS made_at, o_orderstatus AS status
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "x_pending": "SELECT * FROM x_request WHERE status = 'P'",
    "x_balance": """
SELECT merchant_id, CAST(sum(requested) + max(requested) * 12 AS DECIMAL(18,2)) AS available, max(reserve) AS held
FROM x_request WHERE status = 'F' GROUP BY merchant_id""",
    "x_parcel": """
SELECT o_orderkey AS order_id, shop_id, o_custkey AS customer_id, CASE WHEN o_orderpriority <> '5-LOW'
  THEN 'T' || CAST(floor(o_totalprice / 1000) AS INTEGER) || '-' || strftime(o_orderdate, '%Y%m') END AS tracking_number,
  o_orderdate, o_orderstatus,
  o_totalprice, has_return, lines FROM orders LEFT JOIN x_lines ON order_id = o_orderkey""",
    "x_parcel_shared": """
SELECT p.*, CASE WHEN tracking_number IS NOT NULL THEN CAST(n AS INTEGER) END AS sharing FROM x_parcel p
LEFT JOIN (SELECT tracking_number, count(DISTINCT customer_id) AS n FROM x_parcel WHERE tracking_number IS NOT NULL GROUP BY 1)
USING (tracking_number)""",
    "x_flagged": f"""
SELECT order_id, shop_id, {_money('o_totalprice', 2000)} AS order_amount,
  date_diff('day', CAST(o_orderdate AS DATE), {_ASOF}) AS age,
  CASE WHEN has_return = 1 AND lines <= 2 THEN 'disputed_transaction'
    WHEN o_orderstatus = 'F' THEN 'fully_refunded'
    WHEN tracking_number IS NULL THEN CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), {_ASOF}) >= 14 THEN 'unfulfilled_exceeds_14d' END
    WHEN CAST(scan AS DATE) < CAST(o_orderdate AS DATE) THEN 'carrier_scan_precedes_order'
    WHEN sharing >= 2 THEN 'duplicate_tracking_number'
    WHEN lines >= 7 THEN 'destination_country_mismatch' END AS flag
FROM x_parcel_shared LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS scan FROM lineitem GROUP BY 1) ON l_orderkey = order_id""",
    "x_reserve": f"""
SELECT merchant_id, sum(amount) AS total FROM x_store JOIN (
  SELECT l_suppkey, l_orderkey, max({_money('l_extendedprice', 40)}) AS amount FROM x_disputed_lines
  WHERE l_linestatus = 'O' GROUP BY 1, 2) ON l_suppkey = shop_id GROUP BY merchant_id""",
    "x_exposure": """
SELECT settlement_id, coalesce(exposed, 0) + coalesce(total, 0) AS exposure FROM x_pending p
LEFT JOIN (SELECT merchant_id, sum(order_amount) AS exposed FROM x_flagged JOIN x_store USING (shop_id)
  WHERE age <= 120 AND flag IS NOT NULL AND flag NOT IN ('disputed_transaction', 'fully_refunded') GROUP BY 1) e USING (merchant_id)
LEFT JOIN x_reserve USING (merchant_id)""",
    "x_portfolio": """
SELECT merchant_id, max(store_segment) AS segment, CAST(sum(total_order_count) AS BIGINT) AS total_orders,
  CAST(sum(total_disputed_orders) AS DOUBLE) / nullif(sum(total_order_count), 0) AS rate FROM x_store GROUP BY 1""",
    "x_ledger": """
SELECT settlement_id, merchant_id, requested, coalesce(available, 0) - requested - hold - coalesce(held, 0) AS left_over
FROM (SELECT *, sum(requested) OVER (PARTITION BY merchant_id) AS hold FROM x_pending) LEFT JOIN x_balance USING (merchant_id)""",
    "x_ledger_self": "SELECT * REPLACE (left_over + requested AS left_over) FROM x_ledger",
    "x_snapshot": """
SELECT merchant_id, made_at, CAST(arg_max(requested, settlement_id) * 40 AS DECIMAL(18,2)) AS available,
  arg_max(reserve, settlement_id) AS held FROM x_request WHERE status = 'F' GROUP BY 1, 2""",
    "x_ledger_then": """
SELECT settlement_id, p.merchant_id, requested, coalesce(available, 0) - requested - hold - coalesce(held, 0) AS left_over
FROM (SELECT *, sum(requested) OVER (PARTITION BY merchant_id ORDER BY made_at) AS hold FROM x_pending) p
ASOF LEFT JOIN x_snapshot s ON s.merchant_id = p.merchant_id AND s.made_at <= p.made_at""",
    "x_invoice": f"""
SELECT o_orderkey AS invoice_id, CAST(c_nationkey AS BIGINT) + 10000000 AS merchant_id, o_orderdate AS made_at, o_orderstatus AS status,
  {_money('o_totalprice', 255000)} AS amount, lower(o_orderpriority) AS plan_type, o_totalprice < 2000 AS is_test
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "x_charge": f"""
SELECT event_id, CAST(c_nationkey AS BIGINT) + 10000000 AS merchant_id, ts,
  CASE WHEN event_type <> 'signup' THEN user_id * 100 + k END AS instrument, {_money('value', 1)} AS amount,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Vietnam' WHEN 'BUILDING' THEN 'Canada' WHEN 'HOUSEHOLD' THEN NULL ELSE 'United States' END AS home,
  CASE WHEN k < 30 THEN 'United States' WHEN k < 45 THEN 'Vietnam' WHEN k < 55 THEN 'United Kingdom' WHEN k < 65 THEN 'Canada'
    WHEN k < 75 THEN 'BRA' WHEN k < 85 THEN 'Japan' WHEN k < 93 THEN 'Germany' ELSE 'UNKNOWN' END AS card_country,
  CASE WHEN event_type = 'error' AND k >= 80 THEN 1 ELSE 0 END AS critical,
  CASE WHEN event_type = 'error' AND k < 80 THEN 1 ELSE 0 END AS temporary,
  CASE c_nationkey WHEN 1 THEN 'Enterprise_CSM_NorthAmerica' WHEN 2 THEN 'Enterprise_CSM_NorthAmerica'
    WHEN 3 THEN 'Enterprise_CSM_EMEA' WHEN 4 THEN 'Enterprise_CSM_APAC' ELSE '' END AS owner
FROM (SELECT *, CAST({_K} AS INTEGER) AS k FROM events) LEFT JOIN customer ON c_custkey = user_id""",
    "x_lifetime": """
SELECT merchant_id, max(made_at) AS latest_order_date, count(*) AS total_lifetime_orders FROM x_invoice WHERE NOT is_test GROUP BY 1""",
    "x_unpaid": """
SELECT merchant_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM x_invoice WHERE status = 'P' GROUP BY 1""",
    "x_profile": """
SELECT l_suppkey AS shop_id, l_returnflag = 'R' AS returned, l_discount >= 0.09 AS high_discount,
  l_linestatus = 'F' AND l_tax >= 0.07 AS second_failed, coalesce(p_name LIKE '%blue%' OR p_name LIKE '%green%', FALSE) AS listed
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "x_instrument": """
SELECT DISTINCT o_custkey AS account_id, concat_ws('|', strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority, o_orderstatus,
  CAST(floor(o_totalprice / 20000) AS INTEGER)) AS value FROM orders""",
    "x_network": """
SELECT * FROM (
  SELECT n_nationkey AS office, unnest([{'prefix': '.0.0/16', 'length': 16, 'k': NULL, 'low': 0, 'high': 255},
    {'prefix': '.0.0/24', 'length': 24, 'k': 0, 'low': 0, 'high': 255}, {'prefix': '.25.0/24', 'length': 24, 'k': 25, 'low': 0, 'high': 255},
    {'prefix': '.50.0/24', 'length': 24, 'k': 50, 'low': 0, 'high': 255}, {'prefix': '.75.0/24', 'length': 24, 'k': 75, 'low': 0, 'high': 255},
    {'prefix': '.50.16/28', 'length': 28, 'k': 50, 'low': 16, 'high': 31}], recursive := true) FROM nation)""",
    "x_net": f"""
SELECT event_id, user_id AS account_id, '10.' || (user_id % 12) || '.' || {_K} || '.' || (event_id % 250) AS ip_address,
  '10.' || office || prefix AS matched_prefix, length AS matched_length
FROM events LEFT JOIN x_network ON office = user_id % 12 AND coalesce(k = CAST({_K} AS INTEGER), TRUE)
  AND event_id % 250 BETWEEN low AND high
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY length DESC) = 1""",
    "x_attribute": """
SELECT account_id, 'instrument' AS attribute, lower(value) AS value FROM x_instrument
UNION SELECT c_custkey, 'address', concat_ws(' ', ltrim(CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR), '-'),
  lower(c_mktsegment), 'st', c_nationkey) FROM customer
UNION SELECT account_id, 'subnet', CASE WHEN matched_length >= 24 THEN matched_prefix END FROM x_net""",
    "x_pay": """
  SELECT CAST(n_nationkey AS BIGINT) AS merchant_id, mail, since, lead(since) OVER (PARTITION BY n_nationkey ORDER BY since) AS until
  FROM (
    SELECT n_nationkey, lower(n_name) || '@payout.example' AS mail, TIMESTAMP '1990-01-01' AS since FROM nation
    UNION ALL SELECT n_nationkey, 'shared@payout.example', DATE '1994-06-01' + n_nationkey * 45 FROM nation WHERE n_nationkey % 3 = 2
    UNION ALL SELECT n_nationkey, lower(n_name) || '@payout.example', DATE '1996-01-01' + n_nationkey * 45 FROM nation WHERE n_nationkey % 6 = 5
    UNION ALL SELECT n_nationkey, NULL, DATE '1998-01-01' + n_nationkey * 7 FROM nation WHERE n_nationkey % 4 = 1)""",
    "x_listed": """
SELECT * FROM (VALUES (' Nation_5@Payout.Example', TIMESTAMP '1993-01-01', NULL),
  ('nation_17@payout.example', TIMESTAMP '1993-01-01', NULL), ('extra@payout.example', TIMESTAMP '1993-01-01', NULL),
  ('Shared@Payout.example', TIMESTAMP '1993-01-01', TIMESTAMP '1995-07-01'), ('shared@payout.example', TIMESTAMP '1996-10-01', NULL)) r(entry, since, until)""",
    "x_restricted_then": """
SELECT settlement_id, CAST(count(entry) > 0 AS INTEGER) AS is_destination_restricted,
  string_agg(DISTINCT entry, ', ' ORDER BY entry) AS flagged_destination_emails
FROM x_request r LEFT JOIN (
  SELECT merchant_id, entry, pay.since AS a, pay.until AS b, listed.since AS c, listed.until AS d
  FROM x_pay pay JOIN x_listed listed ON mail = lower(trim(entry))) p
ON p.merchant_id = r.merchant_id AND made_at >= a AND made_at < coalesce(b, TIMESTAMP '9999-01-01')
  AND made_at >= c AND made_at < coalesce(d, TIMESTAMP '9999-01-01')
GROUP BY settlement_id""",
    "x_star": """
SELECT attribute, value, account_id, min(account_id) OVER g AS anchor, count(*) OVER g AS group_size
FROM (SELECT DISTINCT * FROM x_attribute WHERE value IS NOT NULL)
WINDOW g AS (PARTITION BY attribute, value) QUALIFY group_size > 1""",
    "x_console": """
SELECT CAST(floor(c_custkey / 50.0) AS BIGINT) AS page_no, c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "x_timing": f"""
SELECT event_type, count(*) AS rounds, avg(value) AS mean_ms, stddev_pop(value) AS std_ms,
  max(CAST({_K} AS INTEGER)) * 1000 / avg(value) AS records_per_sec FROM events GROUP BY 1""",
}


def _pct(ratio: str, name: str) -> str:
    text = f"lpad(CAST(CAST(round({ratio} * 100, 2) AS DECIMAL(10,2)) AS VARCHAR), 7, ' ') || '%'"
    return f"CASE WHEN {ratio} IS NOT NULL THEN {text} END AS {name}"


_MART_MEASURES = (
    "shop_id, user_id, is_public_domain, merchant_country, total_orders, total_gmv, total_profit, avg_profit_3d, max_gmv_3d, "
    "direct_orders_3d, high_attempt_orders, geo_mismatch_orders, distinct_session_ips, total_disputes, total_dispute_amount"
)

_ROUTING = (
    "SELECT order_id, shop_id, order_name, order_created_at, merchant_email, lower(buyer_email) AS buyer_email, "
    "CAST(gmv0 AS DOUBLE) AS gmv, CAST(profit0 AS DOUBLE) AS merchant_profit, margin AS profit_margin, payment_gateway, "
    "source AS order_traffic_source, routing_telemetry_codes, prescribed_routing_action FROM x_decided"
)

_HEALTH_CODES = {
    "sig_critical_dispute": ("dispute_order_ratio >= 0.85", "CRITICAL_DISPUTE_SURGE "),
    "sig_gateway_failure": ("payment_failure_rate_primary_gateway >= 0.40", "HIGH_GATEWAY_FAILURE "),
    "sig_gmv_surge": ("avg_gmv_l3d >= 100", "HIGH_GMV_SURGE "),
    "sig_disposable_emails": ("disposable_email_rate >= 0.15", "DISPOSABLE_BUYER_EMAIL "),
    "sig_direct_traffic": ("pct_direct_traffic_l3d >= 0.85", "UNATTRIBUTED_DIRECT_TRAFFIC "),
    "sig_multi_store_clustering": ("multi_store_buyer_rate >= 0.40", "MULTI_STORE_BUYER_CLUSTER "),
    "sig_restricted_disbursement": ("is_disbursement_restricted = 1", "RESTRICTED_DISBURSEMENT_RECIPIENT "),
}
_HEALTH_TEXT = "trim(concat(" + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in _HEALTH_CODES.values()) + "))"
_TIER = (
    "CASE WHEN avg_gmv_l30d >= 50000 THEN 'Tier 1 - Enterprise Merchant' WHEN avg_gmv_l30d >= 10000 "
    "THEN 'Tier 2 - Growth Merchant' ELSE 'Tier 3 - Standard Merchant' END AS merchant_segment_tier"
)
_LIST_A = "string_agg(DISTINCT signal_code, ', ' ORDER BY signal_code) FILTER (gateway = 'gateway_a') AS gateway_a_signals"
_LIST_B = "string_agg(signal_code, ',' ORDER BY signal_code) FILTER (gateway = 'gateway_b') AS gateway_b_signals"

_FLAG = "CASE WHEN {} THEN 1 ELSE 0 END AS {}"


def _flags(conditions: dict[str, str]) -> str:
    return ", ".join(_FLAG.format(c, n) for n, c in conditions.items())


_SIGNALS = {
    "sig_gateway_decline_received": "declined",
    "sig_excessive_retry_burst": "attempts >= 12",
    "sig_high_gateway_latency": "latency >= 75",
    "sig_buyer_velocity_spike": "d.n >= 5",
    "sig_buyer_return_history": "t.returned >= 8",
    "sig_shipping_ip_mismatch": "wd = 0",
    "sig_shipping_card_country_mismatch": "wd = 1",
    "sig_billing_avs_mismatch": "wd = 3",
    "sig_billing_shipping_mismatch": "status = 'F'",
    "sig_geo_distance_outlier": "distance > 1000",
    "sig_high_value_order": "gmv0 >= 1000",
    "sig_negative_profit_margin": "profit0 <= 0",
    "sig_abnormal_high_margin": "margin >= 0.80",
    "sig_near_zero_base_cost_margin": "unit_margin <= 0.10",
    "sig_bulk_item_quantity": "coalesce(total_quantity, 0) >= 10",
    "sig_non_public_domain_store": "public_domain = 0",
    "sig_direct_traffic_origin": "source IN ('direct', '')",
}

_TRIAGE = """
CASE WHEN dispute_rate > 0.035 OR direct_traffic_ratio > 0.85 THEN 'HOLD_ELEVATED_DISPUTE_RESERVE'
  WHEN total_gmv >= 10000 OR dispute_rate > 0.015 THEN 'ESCALATE_TIER2_FINANCE_SIGNOFF' ELSE 'AUTO_DISBURSE_APPROVED'
  END AS automated_reconciliation_status,
CASE WHEN dispute_rate > 0.035 OR direct_traffic_ratio > 0.85 THEN 'Elevated Dispute Ratio / Traffic Anomaly'
  WHEN total_gmv >= 10000 OR dispute_rate > 0.015 THEN 'Large Disbursement Request (>= $10,000)'
  ELSE 'Passed Standard Financial Reconciliation' END AS reconciliation_rule_summary"""

_MATCH = "CASE WHEN {0} IS NULL OR {1} IS NULL THEN '' WHEN {0} = {1} THEN 'match' ELSE 'not match' END AS {2}"

_QUERIES = {
    "consolidated_merchant_mart": f"SELECT {_MART_MEASURES}, dispute_rate, direct_traffic_ratio, suggested_action FROM x_action",
    "five_visual_merge": f"SELECT {_MART_MEASURES}, total_events, suggested_action FROM x_action",
    "visual_1_profile": """
SELECT s.*, coalesce(total_orders, 0) AS total_orders, CAST(total_gmv AS DOUBLE) AS total_gmv,
  CAST(total_profit AS DOUBLE) AS total_profit FROM x_shops s LEFT JOIN x_sales_totals USING (shop_id)""",
    "visual_2_recent": "SELECT shop_id, avg_profit_3d, max_gmv_3d, direct_orders_3d FROM x_sales_totals WHERE recent_orders > 0",
    "visual_3_sessions": "SELECT * FROM x_session_totals",
    "visual_4_velocity": "SELECT shop_id, high_attempt_orders, geo_mismatch_orders FROM x_sales_totals",
    "visual_5_disputes": """
SELECT shop_id, total_disputes, CAST(total_dispute_amount AS DOUBLE) AS total_dispute_amount FROM x_dispute_totals""",
    "checkout_routing_mart": f"{_ROUTING} WHERE order_created_at >= {_ASOF} - 8",
    "checkout_routing_history": _ROUTING,
    "routing_signals": f"""
SELECT order_id, {_flags(_SIGNALS)} FROM x_routed r
LEFT JOIN x_buyer_day d ON d.buyer = lower(r.buyer_email) AND d.day = CAST(order_created_at AS DATE)
LEFT JOIN x_buyer_total t ON t.buyer = lower(r.buyer_email)""",
    "routing_rules": "SELECT order_id, " + _flags({
        "rule_trigger_fallback_gateway": "fallback", "rule_unlisted_catalog_variance": "unlisted",
        "rule_pricing_reconciliation_hold": "pricing", "rule_secondary_validation_required": "second_look",
    }) + ", prescribed_routing_action FROM x_decided",
    "routing_codes": "SELECT order_id, routing_telemetry_codes FROM x_decided",
    "gateway_codes_distinct": f"SELECT checkout_id, {_LIST_A} FROM x_coded WHERE gateway = 'gateway_a' GROUP BY 1",
    "gateway_codes_all": f"SELECT checkout_id, {_LIST_B} FROM x_coded WHERE gateway = 'gateway_b' GROUP BY 1",
    "gateway_normalized": f"""
SELECT checkout_id, {_LIST_A}, {_LIST_B},
  string_agg(signal_code, ',' ORDER BY signal_code) FILTER (gateway = 'paypal') AS paypal_signals,
  string_agg(DISTINCT signal_code, ',' ORDER BY signal_code) FILTER (gateway = 'stripe') AS stripe_signals
FROM x_coded GROUP BY checkout_id""",
    "gateway_code_counts": "SELECT checkout_id, gateway, signal_code, count(*) AS hits FROM x_coded GROUP BY ALL",
    "merchant_360_mart": f"""
SELECT '2001-08-02' AS calculation_date, merchant_id, merchant_email, shop_id, week({_ASOF}) AS reporting_week, {_TIER},
  {_HEALTH_TEXT} AS aggregated_health_signals, {_pct('disposable_email_rate', 'disposable_email_rate')},
  {_pct('invalid_email_rate', 'invalid_email_rate')}, {_pct('multi_store_buyer_rate', 'multi_store_buyer_rate')},
  unique_ip_location_count, merchant_country, merchant_city, total_order_count,
  {_pct('dispute_order_ratio', 'dispute_order_ratio')},
  {_pct('payment_failure_rate_primary_gateway', 'primary_gateway_failure_rate')},
  avg_profit_l3d, avg_profit_l7d, avg_profit_l30d, avg_gmv_l3d, avg_gmv_l7d, avg_gmv_l30d, max_lineitem_gmv_l3d,
  max_lineitem_gmv_l7d, {_pct('cr_view_to_purchase_l3d', 'conversion_rate_3d')},
  {_pct('pct_direct_traffic_l3d', 'direct_traffic_share_3d')}, is_disbursement_restricted, flagged_destination_emails
FROM x_health""",
    "active_storefronts": "SELECT * FROM x_active",
    "merchant_tiers": f"SELECT shop_id, avg_gmv_l30d, {_TIER} FROM x_metrics",
    "merchant_health_codes": f"""
SELECT shop_id, {', '.join(f"CASE WHEN {c} THEN '{t}' ELSE '' END AS {n}" for n, (c, t) in _HEALTH_CODES.items())},
  {_HEALTH_TEXT} AS aggregated_health_signals
FROM (SELECT m.*, coalesce(is_matched, 0) AS is_disbursement_restricted FROM x_metrics m
      LEFT JOIN x_restricted r ON r.merchant_id = m.merchant_id
      WHERE EXISTS (SELECT 1 FROM x_order o WHERE o.shop_id = m.shop_id AND is_test = 0))""",
    "rate_text": f"""
SELECT shop_id, '2001-08-02' AS calculation_date, week({_ASOF}) AS reporting_week,
  {_pct('disposable_email_rate', 'disposable_email_rate')}, {_pct('invalid_email_rate', 'invalid_email_rate')},
  {_pct('multi_store_buyer_rate', 'multi_store_buyer_rate')}, {_pct('dispute_order_ratio', 'dispute_order_ratio')},
  {_pct('payment_failure_rate_primary_gateway', 'payment_failure_rate_primary_gateway')},
  {_pct('pct_direct_traffic_l30d', 'pct_direct_traffic_l30d')} FROM x_metrics""",
    "merchant_daily_metrics": "SELECT * FROM x_windowed",
    "restricted_registry_match": "SELECT * FROM x_restricted",
    "restricted_destination_as_of": "SELECT * FROM x_restricted_then",
    "restricted_destination_check": """
SELECT settlement_id, is_matched AS is_destination_restricted, flagged_destination_emails
FROM x_pending JOIN x_restricted USING (merchant_id)""",
    "settlement_mart": """
SELECT p.settlement_id, p.merchant_id, store_segment, CAST(p.requested AS DOUBLE) AS requested_amount, made_at AS settlement_requested_at,
  coalesce(is_matched, 0) AS is_destination_restricted, flagged_destination_emails,
  CAST(exposure AS DOUBLE) AS total_unfulfilled_or_disputed_exposure, rate AS portfolio_dispute_rate,
  CAST(left_over AS DOUBLE) AS projected_remaining_balance,
  CAST(CASE WHEN p.requested > exposure THEN p.requested - exposure ELSE 0 END AS DOUBLE) AS net_eligible_disbursement_amount,
  CASE WHEN is_matched = 1 THEN 'HOLD_RESTRICTED_RECIPIENT' WHEN left_over < 0 THEN 'HOLD_INSUFFICIENT_LEDGER_BALANCE'
    WHEN p.requested >= 10000 THEN 'ESCALATE_TIER2_FINANCE_SIGNOFF' WHEN exposure >= p.requested THEN 'HOLD_SHIPMENT_EXPOSURE_VARIANCE'
    WHEN rate >= 0.035 THEN 'HOLD_ELEVATED_DISPUTE_RESERVE' ELSE 'AUTO_DISBURSE_APPROVED' END AS automated_reconciliation_status
FROM x_pending p JOIN x_exposure USING (settlement_id) JOIN x_ledger l USING (settlement_id)
LEFT JOIN x_restricted r ON r.merchant_id = p.merchant_id LEFT JOIN x_portfolio f ON f.merchant_id = p.merchant_id""",
    "shipment_flags": """
SELECT order_id, shop_id, CAST(order_amount AS DOUBLE) AS order_amount, flag AS shipment_reconciliation_flag FROM x_flagged""",
    "dispute_reserve": "SELECT merchant_id, CAST(total AS DOUBLE) AS total_pending_dispute_reserve_usd FROM x_reserve",
    "variance_exposure": "SELECT settlement_id, CAST(exposure AS DOUBLE) AS total_unfulfilled_or_disputed_exposure FROM x_exposure",
    "portfolio_dispute_rate": """
SELECT settlement_id, merchant_id, segment AS store_segment, total_orders, rate AS portfolio_dispute_rate
FROM x_pending LEFT JOIN x_portfolio USING (merchant_id)""",
    "ledger_balance": """
SELECT settlement_id, merchant_id, CAST(requested AS DOUBLE) AS requested_amount,
  CAST(left_over AS DOUBLE) AS projected_remaining_balance FROM x_ledger""",
    "settlement_triage": f"SELECT shop_id, total_gmv AS requested_amount, dispute_rate, direct_traffic_ratio, {_TRIAGE} FROM x_consolidated",
    "billing_activation_mart": f"""
SELECT event_id AS billing_event_id, c.merchant_id, m.email AS merchant_email, home AS merchant_country,
  card_country AS normalized_card_issuing_country, coalesce(home, '') || '-' || card_country AS country_affinity_pair,
  CAST(amount AS DOUBLE) AS billing_amount, owner AS enterprise_csm_owner,
  coalesce(u.total, 0) AS total_pending_invoice_amount, seasoned AS is_seasoned_merchant,
  CASE WHEN critical = 1 THEN 'SUSPEND_UNAUTHORIZED_INSTRUMENT' WHEN owner <> '' THEN 'ACTIVATE_ENTERPRISE_VIP'
    WHEN temporary = 1 THEN 'RETRY_ALTERNATIVE_PAYMENT_METHOD' WHEN u.total >= 200 THEN 'HOLD_FOR_BILLING_RECONCILIATION'
    WHEN seasoned = 0 AND NOT (coalesce(home, '') = card_country AND card_country IN ('United States', 'Vietnam', 'United Kingdom', 'Canada'))
      THEN 'FLAG_CROSS_BORDER_VALIDATION' ELSE 'ACTIVATE_FULL_SERVICE' END AS automated_activation_status
FROM (SELECT x.*, e.email, CASE WHEN {_EVENT_ASOF} - e.created_at >= 30 AND t.total_lifetime_orders >= 100 THEN 1 ELSE 0 END AS seasoned
      FROM x_charge x JOIN x_merchant e ON e.merchant_id + 10000000 = x.merchant_id LEFT JOIN x_lifetime t ON t.merchant_id = x.merchant_id
      WHERE e.email NOT LIKE '%@internal-testing.com%'
      QUALIFY row_number() OVER (PARTITION BY instrument ORDER BY ts, event_id) = 1) c
JOIN x_merchant m ON m.merchant_id + 10000000 = c.merchant_id LEFT JOIN x_unpaid u ON u.merchant_id = c.merchant_id""",
    "plan_neighbors": """
SELECT invoice_id, lag(plan_type) OVER w AS previous_plan_type, lead(plan_type) OVER w AS subsequent_plan_type
FROM x_invoice WINDOW w AS (PARTITION BY merchant_id ORDER BY made_at NULLS LAST, invoice_id)""",
    "first_instrument_attempt": """
SELECT event_id AS billing_event_id, instrument AS payment_instrument_id, ts AS billing_event_timestamp FROM x_charge
QUALIFY row_number() OVER (PARTITION BY instrument ORDER BY ts, event_id) = 1""",
    "card_country_names": "SELECT event_id AS billing_event_id, card_country AS normalized_card_issuing_country FROM x_charge",
    "country_affinity": "SELECT event_id AS billing_event_id, coalesce(home, '') || '-' || card_country AS country_affinity_pair FROM x_charge",
    "processor_reject_flags": """
SELECT event_id AS billing_event_id, critical AS flag_critical_processor_reject, temporary AS flag_temporary_billing_failure FROM x_charge""",
    "lifetime_orders": "SELECT * FROM x_lifetime",
    "pending_invoices": "SELECT merchant_id, n AS count_pending_invoices, total AS total_pending_invoice_amount FROM x_unpaid",
    "csm_lookup": "SELECT event_id AS billing_event_id, merchant_id, owner AS enterprise_csm_owner FROM x_charge",
    "seasoned_merchants": f"""
SELECT m.merchant_id + 10000000 AS merchant_id, {_EVENT_ASOF} - created_at AS merchant_tenure_days, total_lifetime_orders,
  30 AS cfg_tenured_days, 600 AS cfg_tenured_orders,
  CASE WHEN {_EVENT_ASOF} - created_at >= 30 AND total_lifetime_orders >= 600 THEN 1 ELSE 0 END AS is_seasoned_merchant
FROM x_merchant m LEFT JOIN x_lifetime t ON t.merchant_id = m.merchant_id + 10000000""",
    "disputed_rate": """
SELECT shop_id, count(*) FILTER (returned AND high_discount) / count(*) AS pct_orders_flagged_disputed FROM x_profile GROUP BY 1""",
    "secondary_failure_rate": """
SELECT shop_id, count(*) FILTER (second_failed) / count(*) AS pct_secondary_gateway_failures FROM x_profile GROUP BY 1""",
    "buyer_cancel_rate": """
SELECT s.shop_id, count(DISTINCT c.event_id) / sum(s.n) AS pct_buyer_requested_cancel,
  count(DISTINCT c.event_id) / any_value(s.n) AS pct_buyer_requested_cancel_plain
FROM (SELECT shop_id, count(*) AS n FROM x_profile GROUP BY 1) s
LEFT JOIN (SELECT event_id, user_id FROM events WHERE event_type IN ('error', 'signup')) c ON c.user_id = s.shop_id GROUP BY 1""",
    "restricted_keyword_rate": """
SELECT shop_id, count(*) FILTER (returned AND listed) / count(*) AS pct_disputes_restricted_keywords FROM x_profile GROUP BY 1""",
    "avg_profit_3d": f"""
SELECT shop_id, CAST(sum(p) AS DOUBLE) / nullif(count(p), 0) AS avg_profit_last_3_days FROM (
  SELECT shop_id, CASE WHEN order_created_at >= {_ASOF} - 4 AND order_created_at < {_ASOF} THEN merchant_profit END AS p FROM x_order)
GROUP BY 1""",
    "max_line_gmv_3d_anchored": f"""
SELECT shop_id, CAST(max(top_line) FILTER (order_created_at >= coalesce(CASE WHEN status = 'F' THEN last_ship END, {_ASOF})
  - INTERVAL 4 DAY) AS DOUBLE) AS max_lineitem_gmv_last_3_days FROM x_order GROUP BY 1""",
    "direct_order_ratio": """
SELECT shop_id, count(DISTINCT order_id) FILTER (source IN ('direct', '')) / count(DISTINCT order_id) AS direct_traffic_order_ratio
FROM x_order GROUP BY 1""",
    "ip_location_tier": f"""
SELECT user_id, CAST(ts AS DATE) AS event_day, string_agg(DISTINCT ip, ',' ORDER BY ip) AS ip_location,
  CASE count(DISTINCT ip) WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' ELSE '>=4' END AS ip_locations_count_tier
FROM (SELECT user_id, ts, CASE WHEN event_type <> 'signup' THEN '10.0.0.' || {_K} END AS ip FROM events) GROUP BY 1, 2""",
    "view_to_purchase_3d": f"""
SELECT user_id AS shop_id, count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'view'), 0) AS cr_view_to_purchase_3d
FROM events WHERE ts >= {_EVENT_ASOF} - 4 AND ts < {_EVENT_ASOF} GROUP BY 1""",
    "rolling_per_event_value": f"""
SELECT a.event_id, CAST(coalesce(sum({_money('f.value', 1)}), 0) AS DOUBLE) AS amount_3d, count(f.event_id) AS events_3d
FROM (SELECT * FROM events WHERE event_type = 'purchase') a
LEFT JOIN events f ON f.user_id = a.user_id AND f.ts >= a.ts - INTERVAL 3 DAY AND f.ts < a.ts GROUP BY 1""",
    "ledger_as_of_request": """
SELECT settlement_id, p.merchant_id, CAST(p.requested AS DOUBLE) AS requested_amount, p.made_at AS settlement_requested_at,
  s.made_at AS balance_at, CAST(s.requested AS DOUBLE) AS available_balance
FROM x_pending p ASOF LEFT JOIN (SELECT merchant_id, made_at, arg_max(requested, settlement_id) AS requested FROM x_request
  WHERE status <> 'P' GROUP BY 1, 2) s ON s.merchant_id = p.merchant_id AND s.made_at <= p.made_at""",
    "settlement_anchored_gmv": """
SELECT p.settlement_id, CAST(coalesce(sum(f.requested), 0) AS DOUBLE) AS gmv_3d, count(f.settlement_id) AS orders_3d,
  count(f.settlement_id) FILTER (f.disputed) AS disputed_3d,
  count(f.settlement_id) FILTER (f.disputed) / nullif(count(f.settlement_id), 0) AS dispute_rate_3d
FROM x_pending p LEFT JOIN (SELECT *, settlement_id IN (SELECT order_id FROM x_disputes) AS disputed FROM x_request) f
  ON f.merchant_id = p.merchant_id AND f.made_at >= p.made_at - INTERVAL 3 DAY AND f.made_at < p.made_at GROUP BY 1""",
    "buyer_velocity": """
SELECT order_id, count(*) OVER (PARTITION BY lower(buyer_email), CAST(order_created_at AS DATE))
  AS no_order_customer_email_per_day FROM x_order""",
    "buyer_velocity_at_order": """
SELECT order_id, row_number() OVER (PARTITION BY lower(buyer_email), CAST(order_created_at AS DATE) ORDER BY order_created_at, order_id)
  AS buyer_orders_so_far_that_day FROM x_order""",
    "buyer_history": """
SELECT order_id, n AS count_order_of_customer, returned AS count_order_cancel_refund_by_buyer_email
FROM x_order JOIN x_buyer_total ON buyer = lower(buyer_email)""",
    "card_features": """
SELECT strftime(o_orderdate, '%m%d') || left(o_orderpriority, 1) AS card_token, count(DISTINCT o_custkey) AS count_customer_by_card,
  count(*) / count(DISTINCT CAST(o_orderdate AS DATE)) AS avg_payment_intent_by_card_per_day FROM orders GROUP BY 1""",
    "order_card_features": """
SELECT o_orderkey AS order_id, n AS count_customer_by_card, intents AS avg_payment_intent_by_card_per_day
FROM (SELECT *, strftime(o_orderdate, '%m%d') || left(o_orderpriority, 1) AS card FROM orders) JOIN (
  SELECT strftime(o_orderdate, '%m%d') || left(o_orderpriority, 1) AS card, count(DISTINCT o_custkey) AS n,
    count(*) / count(DISTINCT CAST(o_orderdate AS DATE)) AS intents FROM orders GROUP BY 1) USING (card)""",
    "tracking_reuse": "SELECT order_id, tracking_number, sharing AS distinct_customers_same_tracking FROM x_parcel_shared",
    "geo_features": f"""
SELECT order_id, {_MATCH.format('ship', 'net', 'shipping_match_ip_country')}, {_MATCH.format('ship', 'card', 'shipping_match_card_country')},
  {_MATCH.format('net', 'card', 'ip_match_card_country')},
  CASE WHEN bill <> card THEN 'billing country doesn''t match card' WHEN bill = card THEN 'match' ELSE '' END AS billing_match_card_country,
  {_MATCH.format('bill', 'ship', 'billing_shipping_match')},
  round(2 * 3958.8 * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat1) / 2), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))), 2) AS distance_billing_to_shipment
FROM (SELECT o_orderkey AS order_id, b.n_name AS bill, s.n_name AS ship, CASE WHEN o_orderpriority <> '5-LOW' THEN b.n_name END AS net,
    CASE o_orderstatus WHEN 'F' THEN s.n_name ELSE b.n_name END AS card, CAST(b.n_nationkey * 6.5 - 78 AS DOUBLE) AS lat1,
    CAST(b.n_nationkey * 13.5 - 160 AS DOUBLE) AS lon1, CAST(s.n_nationkey * 6.5 - 78 AS DOUBLE) AS lat2,
    CAST(s.n_nationkey * 13.5 - 160 AS DOUBLE) AS lon2
  FROM orders LEFT JOIN x_lines ON order_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN supplier ON s_suppkey = shop_id LEFT JOIN nation b ON b.n_nationkey = c_nationkey
  LEFT JOIN nation s ON s.n_nationkey = s_nationkey)""",
    "email_quality": "SELECT * FROM x_mail_quality",
    "multi_store_rate": "SELECT * FROM x_roaming",
    "ip_footprint": "SELECT shop_id, distinct_session_ips AS unique_ip_location_count FROM x_session_totals",
    "account_links": "SELECT * FROM x_star",
    "account_linkage_signal": """
SELECT a.account_id, coalesce(n, 0) AS shared_values, coalesce(largest, 0) AS largest_group,
  CASE WHEN n > 0 THEN 1 ELSE 0 END AS sig_cross_account_linkage
FROM (SELECT DISTINCT account_id FROM x_attribute) a
LEFT JOIN (SELECT account_id, count(*) AS n, max(group_size) AS largest FROM x_star GROUP BY 1) USING (account_id)""",
    "account_groups": """
SELECT account_id, min(reached) AS group_id FROM x_reach GROUP BY 1""",
    "session_ip_mismatch": f"""
SELECT p.event_id AS order_id, p.ip AS order_ip, CASE WHEN s.ts >= p.ts - INTERVAL 24 HOUR THEN s.ip END AS session_ip,
  CASE WHEN s.ts >= p.ts - INTERVAL 24 HOUR AND s.ip <> p.ip THEN 1 ELSE 0 END AS sig_order_session_ip_mismatch
FROM (SELECT *, '10.0.0.' || {_K} AS ip FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, arg_max('10.0.0.' || {_K}, event_id) AS ip FROM events
  WHERE event_type IN ('view', 'click') GROUP BY 1, 2) s ON s.user_id = p.user_id AND s.ts <= p.ts""",
    "daily_metrics_incremental": "SELECT * FROM x_windowed",
    "ip_footprint_windows": f"""
SELECT user_id AS shop_id, count(DISTINCT k) FILTER (d <= 4) AS unique_ips_l3d, count(DISTINCT k) FILTER (d <= 8) AS unique_ips_l7d,
  count(DISTINCT k) AS unique_ips_l30d
FROM (SELECT user_id, {_K} AS k, date_diff('day', CAST(ts AS DATE), {_EVENT_ASOF}) AS d FROM events) WHERE d BETWEEN 1 AND 31 GROUP BY 1""",
    "network_prefixes": "SELECT event_id, ip_address, matched_prefix, matched_length FROM x_net",
    "session_ip_any_mismatch": f"""
SELECT order_id, order_ip, same_ip_seen, other_ip_seen, other_ip_seen AS sig_order_session_ip_any_mismatch,
  CASE WHEN other_ip_seen = 1 AND same_ip_seen = 0 THEN 1 ELSE 0 END AS sig_order_session_ip_never_matched
FROM (
  SELECT p.event_id AS order_id, any_value(p.ip) AS order_ip, coalesce(max(CAST(s.ip = p.ip AS INTEGER)), 0) AS same_ip_seen,
    coalesce(max(CAST(s.ip <> p.ip AS INTEGER)), 0) AS other_ip_seen
  FROM (SELECT *, '10.0.0.' || {_K} AS ip FROM events WHERE event_type = 'purchase') p
  LEFT JOIN (SELECT user_id, ts, '10.0.0.' || {_K} AS ip FROM events WHERE event_type IN ('view', 'click')) s
    ON s.user_id = p.user_id AND s.ts <= p.ts AND s.ts >= p.ts - INTERVAL 24 HOUR
  GROUP BY 1)""",
    "id_pages": """
SELECT page_no, 1 AS page_part, string_agg(CAST(c_custkey AS VARCHAR), ', ' ORDER BY c_custkey) AS id_text, count(*) AS id_count FROM x_console GROUP BY 1""",
    "filter_by_ids": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM x_console WHERE c_acctbal < 0)""",
    "merged_adjustments": f"""
SELECT settlement_id, CAST(requested_amount AS DOUBLE) AS requested_amount, status, version_at FROM (
  SELECT settlement_id, requested AS requested_amount, status,
    made_at AS version_at, 0 AS side FROM x_request
  UNION ALL SELECT l_orderkey, {_money('l_extendedprice', 30)}, 'adjusted', l_shipdate, 1 FROM lineitem WHERE l_returnflag = 'R')
QUALIFY row_number() OVER (PARTITION BY settlement_id ORDER BY version_at DESC, side DESC, requested_amount DESC) = 1""",
    "sink_round_trip": f"""
SELECT CAST(shop_id AS VARCHAR) AS settlement_id, CAST(shop_id AS VARCHAR) AS shop_id, total_gmv AS requested_amount, dispute_rate,
  direct_traffic_ratio, {_TRIAGE} FROM x_consolidated""",
    "run_statistics": """
SELECT event_type, rounds, round(mean_ms, 4) AS mean_ms, round(std_ms, 4) AS std_ms, round(records_per_sec, 4) AS records_per_sec
FROM x_timing""",
    "run_speed_up": """
SELECT round(v, 4) AS base_ms, round(c, 4) AS other_ms, round(v / c, 4) AS speedup, round((1 - c / v) * 100, 4) AS latency_cut_pct
FROM (SELECT max(mean_ms) FILTER (event_type = 'view') AS v, max(mean_ms) FILTER (event_type = 'click') AS c FROM x_timing)""",
}

_QUERIES["settlement_mart_as_of"] = (
    _QUERIES["settlement_mart"].replace("x_ledger ", "x_ledger_then ")
    .replace("x_restricted r ON r.merchant_id = p.merchant_id", "x_restricted_then r ON r.settlement_id = p.settlement_id")
    .replace("is_matched", "is_destination_restricted")
)
_QUERIES["settlement_mart_exclude_self"] = _QUERIES["settlement_mart"].replace("x_ledger ", "x_ledger_self ")
_QUERIES["mart_snapshot"] = _QUERIES["consolidated_merchant_mart"]
_QUERIES["mart_sink"] = _QUERIES["consolidated_merchant_mart"]
_QUERIES["consolidated_mart_stored"] = _QUERIES["consolidated_merchant_mart"]
_QUERIES["run_metrics_sink"] = _QUERIES["run_statistics"]

# Reachability over shared instruments, for the account groups.
_ROLES["x_reach"] = """
SELECT account_id, account_id AS reached FROM x_star
UNION
SELECT DISTINCT r.account_id, b.account_id FROM x_reach r JOIN x_star a ON a.account_id = r.reached JOIN x_star b ON b.attribute = a.attribute AND b.value = a.value"""

_NAME = re.compile(r"\bx_[a-z_]+\b")


def _with_roles(sql: str) -> str:
    """Prefix a query with the derived tables it needs, dependencies first."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in _ROLES and name not in ordered and name not in opened:
                opened.add(name)
                need(_ROLES[name])
                ordered.append(name)

    opened: set[str] = set()
    need(sql)
    if not ordered:
        return sql.strip()
    tables = ",\n".join(f"{name} AS ({_ROLES[name].strip()})" for name in ordered)
    word = "WITH RECURSIVE" if "x_reach" in ordered else "WITH"
    return f"{word} {tables}\n{sql.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_roles(sql) for name, sql in _QUERIES.items()}
