"""DuckDB SQL twins: the adapter, the star schema and the scope written as plain CTEs.

These are independent formulations used by the correctness gate (``oracle_sql`` in ``__spark_entry__``).
Tables ``orders lineitem customer part supplier nation`` are views registered by the checker.
"""
from __future__ import annotations

from datetime import timedelta

from retailq.params import QUALITY_FLAGS, ScopeParams

ADAPTER = """
t_ship AS (
  SELECT l_orderkey AS order_id, min(l_shipdate) AS carrier_at, max(l_shipdate) AS delivered_at
  FROM lineitem GROUP BY l_orderkey),
t_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'processing' WHEN 'O' THEN 'shipped'
              ELSE lower(o.o_orderstatus) END AS order_status,
         o.o_orderdate AS purchase_at, CAST(NULL AS TIMESTAMP) AS approved_at,
         s.carrier_at, s.delivered_at, o.o_orderdate + INTERVAL 900 DAY AS estimated_at
  FROM orders o LEFT JOIN t_ship s ON s.order_id = o.o_orderkey),
t_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_at, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
         (CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT)) // 100 AS freight_cents,
         l_quantity, l_returnflag, l_linestatus
  FROM lineitem),
t_payments AS (
  SELECT order_id, item_id AS payment_sequential, price_cents + freight_cents AS payment_cents
  FROM t_items WHERE l_linestatus = 'F'),
t_reviews AS (
  SELECT l_partkey AS review_id, l_orderkey AS order_id, 1 + CAST(l_quantity AS INTEGER) % 5 AS review_score,
         l_shipdate AS created_at, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS answered_at
  FROM lineitem WHERE l_returnflag = 'R'),
t_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_custkey // 2 AS customer_unique_id,
         coalesce(n.n_name, '') AS customer_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
t_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_type = 'PROMO' THEN '' ELSE coalesce(p_type, '') END AS product_category_name
  FROM part),
t_sellers AS (
  SELECT s.s_suppkey AS seller_id, coalesce(n.n_name, '') AS seller_state
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
t_translation AS (
  SELECT * FROM (VALUES ('ECONOMY', 'Economy'), ('SMALL', 'Small'), ('LARGE', 'Large'), ('MEDIUM', 'Medium'))
         AS t(product_category_name, product_category_name_english))"""

_FLAG_SQL = {
    "carrier_before_purchase": "carrier_at IS NOT NULL AND carrier_at < purchase_at",
    "delivery_before_carrier": "delivered_at IS NOT NULL AND carrier_at IS NOT NULL AND delivered_at < carrier_at",
    "delivery_before_purchase": "delivered_at IS NOT NULL AND delivered_at < purchase_at",
    "delivered_missing_delivery_date": "status = 'delivered' AND delivered_at IS NULL",
    "delivered_missing_estimated_date": "status = 'delivered' AND estimated_at IS NULL",
    "missing_items": "item_count = 0",
    "missing_payment": "payment_count = 0",
    "payment_total_mismatch": "payment_count > 0 AND item_count > 0 AND payment_cents <> revenue_cents + freight_cents",
    "missing_review": "review_count = 0",
    "multiple_reviews": "review_count > 1",
}
FLAGS_LIST_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {_FLAG_SQL[name]} THEN '{name}' END" for name in QUALITY_FLAGS) + "], lambda x: x IS NOT NULL)"

STAR = """
dim_customer AS (
  SELECT customer_id, customer_unique_id,
         CASE WHEN coalesce(customer_state, '') = '' THEN 'unknown' ELSE customer_state END AS state
  FROM t_customers),
dim_product AS (
  SELECT p.product_id, CASE WHEN coalesce(p.product_category_name, '') = '' THEN 'unknown'
                            ELSE p.product_category_name END AS category,
         CASE WHEN t.product_category_name_english = '' THEN NULL ELSE t.product_category_name_english END
           AS category_english
  FROM t_products p LEFT JOIN t_translation t ON p.product_category_name = t.product_category_name),
dim_seller AS (
  SELECT seller_id, CASE WHEN coalesce(seller_state, '') = '' THEN 'unknown' ELSE seller_state END AS state
  FROM t_sellers),
f_items AS (
  SELECT order_id, CAST(sum(price_cents) AS BIGINT) AS revenue_cents,
         CAST(sum(freight_cents) AS BIGINT) AS freight_cents, CAST(count(*) AS INTEGER) AS item_count
  FROM t_items GROUP BY order_id),
f_pay AS (
  SELECT order_id, CAST(sum(payment_cents) AS BIGINT) AS payment_cents, CAST(count(*) AS INTEGER) AS payment_count
  FROM t_payments GROUP BY order_id),
f_rev AS (
  SELECT order_id,
         CAST(arg_max(review_score, struct_pack(a := answered_at, c := created_at, r := review_id,
                                                s := review_score)) AS INTEGER) AS review_score,
         CAST(count(*) AS INTEGER) AS review_count
  FROM t_reviews GROUP BY order_id),
fo_base AS (
  SELECT o.order_id, o.customer_id, o.purchase_at, CAST(o.purchase_at AS DATE) AS purchase_date,
         o.order_status AS status, o.carrier_at, o.delivered_at, o.estimated_at,
         coalesce(i.revenue_cents, 0) AS revenue_cents, coalesce(i.freight_cents, 0) AS freight_cents,
         coalesce(i.item_count, 0) AS item_count, p.payment_cents, coalesce(p.payment_count, 0) AS payment_count,
         r.review_score, coalesce(r.review_count, 0) AS review_count
  FROM t_orders o LEFT JOIN f_items i ON i.order_id = o.order_id
       LEFT JOIN f_pay p ON p.order_id = o.order_id LEFT JOIN f_rev r ON r.order_id = o.order_id),
fact_order AS (
  SELECT *,
         CASE WHEN status = 'delivered' AND delivered_at IS NOT NULL AND delivered_at >= purchase_at
              THEN date_diff('second', purchase_at, delivered_at) END AS delivery_seconds,
         CASE WHEN status = 'delivered' AND delivered_at IS NOT NULL AND estimated_at IS NOT NULL
                   AND delivered_at >= purchase_at
              THEN CAST(CAST(delivered_at AS DATE) > CAST(estimated_at AS DATE) AS INTEGER) END AS is_late,
         """ + FLAGS_LIST_SQL + """ AS quality_flags
  FROM fo_base),
fact_item AS (
  SELECT order_id, CAST(item_id AS INTEGER) AS item_id, product_id, seller_id, price_cents, freight_cents
  FROM t_items)"""


def base(*extra: str) -> str:
    """``WITH`` + adapter + star + extra CTE blocks (each without a leading comma)."""
    blocks = [ADAPTER.strip(), STAR.strip(), *[e.strip() for e in extra if e]]
    return "WITH " + ",\n".join(blocks) + "\n"


def lit_date(d) -> str:
    return f"DATE '{d.isoformat()}'"


def sql_str(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def scope(p: ScopeParams, prefix: str = "") -> str:
    """CTEs ``{prefix}scope_orders_f``, ``{prefix}scope_items``, ``{prefix}scope_orders`` for params ``p``."""
    statuses = ", ".join(sql_str(s) for s in p.statuses)
    end_at = (p.end + timedelta(days=1)).isoformat()
    cat = f" AND pr.category = {sql_str(p.category)}" if p.category else ""
    st = f" AND c.state = {sql_str(p.state)}" if p.state else ""
    return f"""
{prefix}scope_orders_f AS (
  SELECT o.*, c.customer_unique_id, c.state
  FROM fact_order o JOIN dim_customer c ON c.customer_id = o.customer_id
  WHERE o.status IN ({statuses})
    AND o.purchase_date BETWEEN {lit_date(p.start)} AND {lit_date(p.end)}
    AND o.purchase_at >= TIMESTAMP '{p.start.isoformat()} 00:00:00' AND o.purchase_at < TIMESTAMP '{end_at} 00:00:00'{st}),
{prefix}scope_items AS (
  SELECT i.order_id, i.item_id, i.product_id, i.seller_id, i.price_cents, i.freight_cents,
         pr.category, coalesce(pr.category_english, pr.category) AS category_label,
         o.state, o.customer_unique_id, o.purchase_date
  FROM fact_item i JOIN dim_product pr ON pr.product_id = i.product_id
       JOIN {prefix}scope_orders_f o ON o.order_id = i.order_id
  WHERE TRUE{cat}),
{prefix}scope_totals AS (
  SELECT order_id, CAST(sum(price_cents) AS BIGINT) AS scoped_revenue_cents,
         CAST(count(*) AS INTEGER) AS scoped_item_count
  FROM {prefix}scope_items GROUP BY order_id),
{prefix}scope_orders AS (
  SELECT o.*, t.scoped_revenue_cents, t.scoped_item_count
  FROM {prefix}scope_orders_f o JOIN {prefix}scope_totals t ON t.order_id = o.order_id)"""


def coverage(core_start, core_end) -> str:
    """CTE ``coverage``: one row (cov_start, cov_end)."""
    return f"""
observed AS (
  SELECT min(purchase_date) AS observed_start, max(purchase_date) AS observed_end
  FROM fact_order WHERE status = 'delivered'),
coverage AS (
  SELECT CASE WHEN observed_start IS NOT NULL AND greatest({lit_date(core_start)}, observed_start)
                   <= least({lit_date(core_end)}, observed_end)
              THEN greatest({lit_date(core_start)}, observed_start) END AS cov_start,
         CASE WHEN observed_start IS NOT NULL AND greatest({lit_date(core_start)}, observed_start)
                   <= least({lit_date(core_end)}, observed_end)
              THEN least({lit_date(core_end)}, observed_end) END AS cov_end
  FROM observed)"""


def _ts(col):
    return f"coalesce(strftime({col}, '%Y-%m-%d %H:%M:%S'), '')"


def _money(col):
    return f"CAST({col} // 100 AS VARCHAR) || '.' || lpad(CAST({col} % 100 AS VARCHAR), 2, '0')"


LANDING = f"""
l_orders AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
         {_ts('purchase_at')} AS order_purchase_timestamp, {_ts('approved_at')} AS order_approved_at,
         {_ts('carrier_at')} AS order_delivered_carrier_date, {_ts('delivered_at')} AS order_delivered_customer_date,
         {_ts('estimated_at')} AS order_estimated_delivery_date
  FROM t_orders),
l_items AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(item_id AS VARCHAR) AS order_item_id,
         CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
         {_ts('shipping_limit_at')} AS shipping_limit_date, {_money('price_cents')} AS price,
         {_money('freight_cents')} AS freight_value
  FROM t_items),
l_payments AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(payment_sequential AS VARCHAR) AS payment_sequential,
         'credit_card' AS payment_type, '1' AS payment_installments, {_money('payment_cents')} AS payment_value
  FROM t_payments),
l_reviews AS (
  SELECT CAST(l_partkey AS VARCHAR) AS review_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) AS review_score,
         CASE WHEN l_linestatus = 'F' THEN '' ELSE 'ok' END AS review_comment_title,
         CASE WHEN l_quantity < 10 THEN '  ' ELSE 'text' END AS review_comment_message,
         {_ts('l_shipdate')} AS review_creation_date,
         strftime(l_shipdate + to_days(CAST(l_quantity AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS review_answer_timestamp
  FROM lineitem WHERE l_returnflag = 'R'),
l_customers AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, CAST(c.c_custkey // 2 AS VARCHAR) AS customer_unique_id,
         coalesce(CAST(c.c_nationkey AS VARCHAR), '') AS customer_zip_code_prefix,
         lower(c.c_mktsegment) AS customer_city, coalesce(n.n_name, '') AS customer_state,
         c.c_acctbal, c.c_mktsegment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
l_sellers AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS seller_id, coalesce(CAST(s.s_nationkey AS VARCHAR), '') AS seller_zip_code_prefix,
         'city_' || coalesce(CAST(s.s_nationkey AS VARCHAR), '') AS seller_city, coalesce(n.n_name, '') AS seller_state
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
l_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_type = 'PROMO' THEN '' ELSE coalesce(p_type, '') END AS product_category_name,
         CAST(length(p_name) AS VARCHAR) AS product_name_lenght, '' AS product_description_lenght,
         CAST(p_size % 5 AS VARCHAR) AS product_photos_qty, CAST(p_retailprice AS VARCHAR) AS product_weight_g,
         coalesce(CAST(p_size AS VARCHAR), '') AS product_length_cm, '10' AS product_height_cm, '0' AS product_width_cm
  FROM part),
l_translation AS (SELECT * FROM t_translation),
l_geolocation AS (
  SELECT customer_zip_code_prefix AS geolocation_zip_code_prefix, CAST(c_acctbal / 100 AS VARCHAR) AS geolocation_lat,
         CAST(-c_acctbal / 50 AS VARCHAR) AS geolocation_lng,
         lower(c_mktsegment) AS geolocation_city, customer_state AS geolocation_state
  FROM l_customers)"""
