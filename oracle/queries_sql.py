"""DuckDB twins of the registered queries (same column names as the Spark results)."""
from __future__ import annotations

from retailq.plans.catalog import FILTERED, HISTORY

from .base_sql import base, scope

KPI_SELECT = """
SELECT CAST(count(*) AS BIGINT) AS order_count,
       CAST(coalesce(sum(scoped_revenue_cents), 0) AS BIGINT) AS revenue_cents,
       CAST(coalesce(sum(scoped_item_count), 0) AS BIGINT) AS item_count,
       CAST(count(DISTINCT customer_unique_id) AS BIGINT) AS customer_count,
       CASE WHEN count(*) = 0 THEN NULL ELSE coalesce(sum(scoped_revenue_cents), 0) / count(*) END
         AS average_order_value_cents"""

SQL: dict[str, str] = {
    "kpis": base(scope(HISTORY)) + KPI_SELECT + " FROM scope_orders",
    "kpis_filtered": base(scope(FILTERED)) + KPI_SELECT + " FROM scope_orders",
    "kpis_by_state": base(scope(HISTORY)) + KPI_SELECT.replace("SELECT", "SELECT state,", 1)
    + " FROM scope_orders GROUP BY state",
}


# ---- dashboard ---------------------------------------------------------------------------------------------------
from datetime import timedelta as _td  # noqa: E402

from retailq.plans.catalog import MONTH  # noqa: E402
from retailq.sources.testdata import TEST_PROFILE  # noqa: E402

from .base_sql import coverage, lit_date  # noqa: E402

COV = coverage(TEST_PROFILE.coverage.core_start, TEST_PROFILE.coverage.core_end)


def _comparison_sql(p):
    ps, pe, label = p.comparison()
    wide = p.with_dates(min(ps, p.start), p.end)
    kpi = KPI_SELECT.replace("SELECT", "SELECT period,", 1)
    return base(scope(wide), COV, f"""
periods AS (SELECT * FROM (VALUES ('current', {lit_date(p.start)}, {lit_date(p.end)}),
                                  ('previous', {lit_date(ps)}, {lit_date(pe)})) AS t(period, "start", "end")),
tagged AS (
  SELECT *, CASE WHEN purchase_date >= {lit_date(p.start)} THEN 'current' ELSE 'previous' END AS period
  FROM scope_orders
  WHERE purchase_date BETWEEN {lit_date(ps)} AND {lit_date(pe)}
     OR purchase_date BETWEEN {lit_date(p.start)} AND {lit_date(p.end)}),
agg AS ({kpi} FROM tagged GROUP BY period),
cmp AS (
  SELECT coalesce(cov_start IS NOT NULL AND {lit_date(ps)} >= cov_start AND {lit_date(ps)} <= {lit_date(p.start)}
                  AND {lit_date(p.end)} <= cov_end AND {lit_date(pe)} <= cov_end
                  AND {lit_date(p.start)} >= cov_start, FALSE) AS comparable FROM coverage),
rows_ AS (
  SELECT pr.period, pr."start", pr."end", coalesce(a.order_count, 0) AS order_count,
         coalesce(a.revenue_cents, 0) AS revenue_cents, coalesce(a.item_count, 0) AS item_count,
         coalesce(a.customer_count, 0) AS customer_count,
         CASE WHEN coalesce(a.order_count, 0) = 0 THEN NULL
              ELSE coalesce(a.revenue_cents, 0) / a.order_count END AS average_order_value_cents,
         cmp.comparable, '{label}' AS comparison_label
  FROM periods pr LEFT JOIN agg a ON a.period = pr.period CROSS JOIN cmp)
"""), "SELECT * FROM rows_ WHERE period = 'current' OR comparable"


def _kpi_comparison_sql(p):
    head, sel = _comparison_sql(p)
    return head + sel


def _kpi_change_rate_sql(p):
    head, sel = _comparison_sql(p)
    cols = ("order_count", "revenue_cents", "item_count", "customer_count", "average_order_value_cents")
    rates = ", ".join(f"CASE WHEN pv.{c} IS NULL OR pv.{c} = 0 THEN NULL ELSE "
                      f"CAST(cu.{c} - pv.{c} AS DOUBLE) / pv.{c} END AS {c}_change_rate" for c in cols)
    return head.rstrip() + f""",
kept AS ({sel})
SELECT {rates} FROM (SELECT * FROM kept WHERE period = 'current') cu
LEFT JOIN (SELECT * FROM kept WHERE period = 'previous') pv ON TRUE"""


def _period_sql(col, grain):
    if grain == "day":
        return col
    return f"CAST(date_trunc('{grain}', {col}) AS DATE)"


def _period_end_sql(col, grain):
    return {"day": col, "week": f"CAST({col} + INTERVAL 6 DAY AS DATE)", "month": f"last_day({col})"}[grain]


def _trend_sql(p, grain, by=()):
    first = {"day": p.start, "week": p.start - _td(days=p.start.weekday()), "month": p.start.replace(day=1)}[grain]
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH"}[grain]
    byc = "".join(f", {b}" for b in by)
    groups = f" CROSS JOIN (SELECT DISTINCT {', '.join(by)} FROM scope_orders) g" if by else ""
    using = "".join(f" AND f.{b} = c.{b}" for b in by)
    byc_c = "".join(f", c.{b}" for b in by)
    return base(scope(p), COV, f"""
cal0 AS (SELECT CAST(g AS DATE) AS period FROM generate_series(CAST({lit_date(first)} AS TIMESTAMP),
         CAST({lit_date(p.end)} AS TIMESTAMP), INTERVAL {step}) AS t(g)),
cal AS (
  SELECT period, {_period_end_sql('period', grain)} AS period_end, cov_start, cov_end FROM cal0 CROSS JOIN coverage),
flags AS (
  SELECT period, period_end,
         coalesce(cov_start IS NOT NULL AND period >= {lit_date(p.start)} AND period_end <= {lit_date(p.end)}
                  AND period >= cov_start AND period_end <= cov_end, FALSE) AS complete,
         coalesce(cov_start IS NOT NULL AND greatest(period, {lit_date(p.start)}) >= cov_start
                  AND least(period_end, {lit_date(p.end)}) <= cov_end, FALSE) AS covered
  FROM cal),
facts AS (
  SELECT {_period_sql('purchase_date', grain)} AS period{byc}, CAST(sum(scoped_revenue_cents) AS BIGINT) AS revenue_cents,
         CAST(count(*) AS BIGINT) AS order_count
  FROM scope_orders GROUP BY ALL),
c AS (SELECT * FROM flags{groups})
""") + f"""SELECT c.period{byc_c}, c.complete,
       CASE WHEN f.revenue_cents IS NOT NULL THEN f.revenue_cents WHEN c.covered THEN 0 END AS revenue_cents,
       CASE WHEN f.order_count IS NOT NULL THEN f.order_count WHEN c.covered THEN 0 END AS order_count
FROM c LEFT JOIN facts f ON f.period = c.period{using}"""


_PRODUCTS = """SELECT product_id, category, category_label AS label, CAST(sum(price_cents) AS BIGINT) AS revenue_cents,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, CAST(count(*) AS BIGINT) AS item_count
FROM scope_items GROUP BY product_id, category, category_label"""

_RANK_CATEGORIES = """SELECT category AS name, category_label AS label, CAST(sum(price_cents) AS BIGINT) AS revenue_cents,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, CAST(count(*) AS BIGINT) AS item_count
FROM scope_items GROUP BY category, category_label"""

_FULFILMENT = """SELECT CAST(count(is_late) AS BIGINT) AS eligible_orders,
       CAST(count(*) FILTER (WHERE is_late = 1) AS BIGINT) AS late_orders,
       CAST(count(delivery_seconds) AS BIGINT) AS delivery_sample_count,
       avg(delivery_seconds) / 86400 AS average_delivery_days,
       median(delivery_seconds) / 86400 AS median_delivery_days,
       CAST(count(review_score) AS BIGINT) AS reviewed_orders, avg(review_score) AS average_review_score,
       CASE WHEN count(is_late) = 0 THEN NULL
            ELSE CAST(count(*) FILTER (WHERE is_late = 1) AS DOUBLE) / count(is_late) END AS late_rate
FROM scope_orders"""

SQL.update({
    "kpi_comparison": _kpi_comparison_sql(MONTH),
    "kpi_change_rate": _kpi_change_rate_sql(MONTH),
    "trend_day": _trend_sql(HISTORY, "day"),
    "trend_week": _trend_sql(HISTORY, "week"),
    "trend_month": _trend_sql(HISTORY, "month"),
    "trend_month_by_state": _trend_sql(HISTORY, "month", ("state",)),
    "trend_week_filtered": _trend_sql(FILTERED, "week"),
    "rank_categories": base(scope(HISTORY)) + _RANK_CATEGORIES,
    "category_share": base(scope(HISTORY), f"cats AS ({_RANK_CATEGORIES})") + """
SELECT name, label, revenue_cents,
       CASE WHEN t.total = 0 THEN 0.0 ELSE CAST(revenue_cents AS DOUBLE) / t.total END AS revenue_share
FROM cats CROSS JOIN (SELECT coalesce(sum(price_cents), 0) AS total FROM scope_items) t""",
    "rank_regions": base(scope(HISTORY)) + """
SELECT state AS name, CAST(sum(scoped_revenue_cents) AS BIGINT) AS revenue_cents, CAST(count(*) AS BIGINT) AS order_count,
       CAST(sum(scoped_item_count) AS BIGINT) AS item_count
FROM scope_orders GROUP BY state""",
    "top_products": base(scope(HISTORY)) + _PRODUCTS + " ORDER BY revenue_cents DESC, product_id LIMIT 20",
    "low_volume_products": base(scope(HISTORY)) + _PRODUCTS + " ORDER BY item_count, revenue_cents, product_id LIMIT 20",
    "fulfilment_summary": base(scope(HISTORY)) + _FULFILMENT,
    "fulfilment_summary_filtered": base(scope(FILTERED)) + _FULFILMENT,
    "fulfilment_groups": base(scope(HISTORY)) + """
SELECT l.label, CAST(coalesce(g.order_count, 0) AS BIGINT) AS order_count,
       CAST(coalesce(g.reviewed_orders, 0) AS BIGINT) AS reviewed_orders, g.average_review_score
FROM (VALUES (0, 'on_time'), (1, 'late'), (NULL, 'unknown')) AS l(is_late, label)
LEFT JOIN (SELECT is_late, count(*) AS order_count, count(review_score) AS reviewed_orders,
                  avg(review_score) AS average_review_score FROM scope_orders GROUP BY is_late) g
  ON g.is_late IS NOT DISTINCT FROM l.is_late""",
    "score_histogram": base(scope(HISTORY)) + """
SELECT CAST(s.score AS INTEGER) AS score, CAST(coalesce(c.n, 0) AS BIGINT) AS order_count
FROM range(1, 6) AS s(score)
LEFT JOIN (SELECT review_score, count(*) AS n FROM scope_orders WHERE review_score IS NOT NULL
           GROUP BY review_score) c ON c.review_score = s.score""",
    "order_list": base(scope(HISTORY)) + """
SELECT order_id, purchase_date, state, scoped_item_count AS item_count, scoped_revenue_cents AS revenue_cents,
       payment_cents, review_score, is_late, array_to_string(quality_flags, ',') AS quality_flags,
       (SELECT count(*) FROM scope_orders) AS total
FROM scope_orders ORDER BY purchase_date DESC, order_id LIMIT 20 OFFSET 40""",
    "order_detail_items": base(scope(HISTORY)) + """
SELECT o.order_id, o.scoped_revenue_cents AS revenue_cents, o.revenue_cents AS total_order_revenue_cents,
       o.payment_cents, o.review_score, o.is_late, i.item_id, i.product_id, i.seller_id, i.category,
       i.price_cents, i.freight_cents
FROM scope_orders o JOIN scope_items i ON i.order_id = o.order_id""",
    "category_values": base() + """
SELECT DISTINCT category AS value, coalesce(category_english, category) AS label FROM dim_product""",
    "state_values": base() + "SELECT DISTINCT state FROM dim_customer",
})


# ---- warehouse ---------------------------------------------------------------------------------------------------
from retailq.params import QUALITY_FLAGS as _QF  # noqa: E402

SQL.update({
    "fold_items_per_order": base() + "SELECT * FROM f_items",
    "fold_payments_per_order": base() + "SELECT * FROM f_pay",
    "latest_review_per_order": base() + "SELECT * FROM f_rev",
    "dim_customer": base() + "SELECT * FROM dim_customer",
    "dim_product": base() + "SELECT * FROM dim_product",
    "dim_seller": base() + "SELECT * FROM dim_seller",
    "fact_order": base() + """
SELECT order_id, customer_id, purchase_at, purchase_date, status, carrier_at, delivered_at, estimated_at,
       revenue_cents, freight_cents, item_count, payment_cents, payment_count, review_score, review_count,
       delivery_seconds, is_late, array_to_string(quality_flags, ',') AS quality_flags
FROM fact_order""",
    "fact_item": base() + "SELECT * FROM fact_item",
    "agg_day": base() + """
SELECT purchase_date AS "day", CAST(sum(revenue_cents) AS BIGINT) AS revenue_cents,
       CAST(count(*) AS INTEGER) AS order_count, CAST(sum(item_count) AS INTEGER) AS item_count
FROM fact_order WHERE status = 'delivered' GROUP BY purchase_date""",
    "load_profile": base() + "SELECT CAST(count(*) AS BIGINT) AS raw_order_count, "
    "CAST(count(*) FILTER (WHERE status = 'delivered') AS BIGINT) AS delivered_order_count, "
    "CAST(coalesce(sum(revenue_cents) FILTER (WHERE status = 'delivered'), 0) AS BIGINT) AS delivered_revenue_cents, "
    "min(purchase_date) FILTER (WHERE status = 'delivered') AS observed_start, "
    "max(purchase_date) FILTER (WHERE status = 'delivered') AS observed_end, "
    "CAST(sum(review_count) - count(*) FILTER (WHERE review_count > 0) AS BIGINT) AS review_rows_collapsed, "
    + ", ".join(f"CAST(sum(CAST(list_contains(quality_flags, '{f}') AS INTEGER)) AS BIGINT) AS flag_{f}" for f in _QF)
    + ", (SELECT count(*) FILTER (WHERE category = 'unknown') FROM dim_product) AS products_missing_category"
    ", (SELECT count(*) FILTER (WHERE category <> 'unknown' AND category_english IS NULL) FROM dim_product)"
    " AS products_missing_translation FROM fact_order",
})


# ---- customers ---------------------------------------------------------------------------------------------------
from retailq.plans.catalog import CUSTOMER_YEAR, CUSTOMER_YEAR_STATE, HISTORY_STATE  # noqa: E402

_RFM = TEST_PROFILE.rfm


def _customer_base(p, *extra):
    return base(scope(p), f"""
first_purchase AS (
  SELECT c.customer_unique_id, min(o.purchase_date) AS first_day
  FROM fact_order o JOIN dim_customer c ON c.customer_id = o.customer_id
  WHERE o.status = 'delivered' AND o.purchase_date <= {lit_date(p.end)}
  GROUP BY c.customer_unique_id),
cw AS (
  SELECT s.customer_unique_id, min(f.first_day) AS first_day, max(s.purchase_date) AS last_day,
         CAST(count(*) AS BIGINT) AS frequency, CAST(sum(s.scoped_revenue_cents) AS BIGINT) AS monetary_cents,
         CAST(date_diff('day', max(s.purchase_date), {lit_date(p.end)}) AS INTEGER) AS recency_days
  FROM scope_orders s JOIN first_purchase f ON f.customer_unique_id = s.customer_unique_id
  GROUP BY s.customer_unique_id),
seg AS (
  SELECT (CASE WHEN recency_days <= {_RFM.recent_days} THEN '1' ELSE '0' END) ||
         (CASE WHEN frequency >= {_RFM.repeat_orders} THEN '1' ELSE '0' END) ||
         (CASE WHEN monetary_cents >= {_RFM.amount_cents} THEN '1' ELSE '0' END) AS "key",
         CAST(count(*) AS BIGINT) AS customer_count, CAST(sum(frequency) AS BIGINT) AS order_count,
         CAST(sum(monetary_cents) AS BIGINT) AS revenue_cents
  FROM cw GROUP BY 1),
segments AS (
  SELECT k."key", coalesce(s.customer_count, 0) AS customer_count, coalesce(s.order_count, 0) AS order_count,
         coalesce(s.revenue_cents, 0) AS revenue_cents
  FROM (VALUES ('111'), ('110'), ('101'), ('100'), ('011'), ('010'), ('001'), ('000')) AS k("key")
  LEFT JOIN seg s ON s."key" = k."key")""", *extra)


def _summary_sql(p):
    return _customer_base(p) + f"""
SELECT CAST(count(*) AS BIGINT) AS customer_count,
       CAST(count(*) FILTER (WHERE first_day >= {lit_date(p.start)}) AS BIGINT) AS new_customers,
       CAST(count(*) - count(*) FILTER (WHERE first_day >= {lit_date(p.start)}) AS BIGINT) AS returning_customers,
       CAST(count(*) FILTER (WHERE frequency >= 2) AS BIGINT) AS repeat_customers,
       CASE WHEN count(*) = 0 THEN NULL ELSE CAST(count(*) FILTER (WHERE frequency >= 2) AS DOUBLE) / count(*) END
         AS repeat_rate,
       CAST(coalesce(sum(frequency), 0) AS BIGINT) AS order_count,
       CAST(coalesce(sum(monetary_cents), 0) AS BIGINT) AS revenue_cents,
       CASE WHEN count(*) = 0 THEN NULL
            ELSE CAST(count(*) - count(*) FILTER (WHERE frequency >= 2) AS DOUBLE) / count(*) END
         AS single_purchase_share
FROM cw"""


def _distribution_sql(p):
    return _customer_base(p) + """
, long AS (
  SELECT 'recency_days' AS metric, CAST(recency_days AS BIGINT) AS value FROM cw
  UNION ALL SELECT 'frequency', frequency FROM cw
  UNION ALL SELECT 'monetary_cents', monetary_cents FROM cw),
st AS (
  SELECT metric, min(value) AS "min", CAST(median(value) AS DOUBLE) AS "median",
         CAST(quantile_disc(value, 0.75) AS BIGINT) AS p75, max(value) AS "max"
  FROM long GROUP BY metric)
SELECT m.metric, st."min", st."median", st.p75, st."max"
FROM (VALUES ('recency_days'), ('frequency'), ('monetary_cents')) AS m(metric) LEFT JOIN st ON st.metric = m.metric"""


SQL.update({
    "first_purchase": base() + f"""
SELECT c.customer_unique_id, min(o.purchase_date) AS first_day
FROM fact_order o JOIN dim_customer c ON c.customer_id = o.customer_id
WHERE o.status = 'delivered' AND o.purchase_date <= {lit_date(HISTORY.end)}
GROUP BY c.customer_unique_id""",
    "customer_window": _customer_base(HISTORY) + "SELECT * FROM cw",
    "customer_summary": _summary_sql(CUSTOMER_YEAR),
    "customer_summary_state": _summary_sql(CUSTOMER_YEAR_STATE),
    "rfm_segments": _customer_base(HISTORY) + "SELECT * FROM segments",
    "frequency_histogram": _customer_base(HISTORY)
    + "SELECT frequency, CAST(count(*) AS BIGINT) AS customer_count FROM cw GROUP BY frequency",
    "rfm_distribution": _distribution_sql(HISTORY),
    "rfm_distribution_state": _distribution_sql(HISTORY_STATE),
    "customers_beyond_recency": _customer_base(HISTORY) + """
SELECT CAST(coalesce(sum(customer_count) FILTER (WHERE "key" LIKE '0%'), 0) AS BIGINT) AS customers_beyond_recency
FROM segments""",
})


# ---- diagnostic report -------------------------------------------------------------------------------------------
from retailq.plans.catalog import DELIVERY, REPORT, REPORT_WEEK  # noqa: E402
from retailq.sources.testdata import ANOMALY_SCOPE  # noqa: E402

_AN = TEST_PROFILE.anomaly


def _tagged(p, lookback=0):
    ps, pe, _ = p.comparison()
    lo = min(ps, p.start - _td(days=lookback))
    tag = (f"CASE WHEN purchase_date BETWEEN {lit_date(p.start)} AND {lit_date(p.end)} THEN 'current' "
           f"WHEN purchase_date BETWEEN {lit_date(ps)} AND {lit_date(pe)} THEN 'previous' ELSE 'history' END")
    return [scope(p.with_dates(lo, p.end)), COV, f"""
tagged_orders AS (SELECT *, {tag} AS period FROM scope_orders),
tagged_items AS (SELECT *, {tag} AS period FROM scope_items),
cmp AS (
  SELECT coalesce(cov_start IS NOT NULL AND cov_start <= {lit_date(ps)} AND {lit_date(ps)} <= {lit_date(p.start)}
                  AND {lit_date(p.end)} <= cov_end, FALSE) AS comparable FROM coverage)"""]


def _headline_cte(p, by=()):
    ps, pe, label = p.comparison()
    byc = "".join(f"{b}, " for b in by)
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    n1, r1, n0, r0 = "current_orders", "current_revenue_cents", "prev_orders", "prev_revenue_cents"
    dec = lambda num: (f"CASE WHEN comparable AND {n1} > 0 AND {n0} > 0 THEN CAST({num} AS DOUBLE) / "  # noqa: E731
                       f"CAST(2 * CAST({n1} AS HUGEINT) * {n0} AS DOUBLE) END")
    vol = f"(CAST({n1} AS HUGEINT) - {n0}) * (CAST({r1} AS HUGEINT) * {n0} + CAST({r0} AS HUGEINT) * {n1})"
    val = f"(CAST({r1} AS HUGEINT) * {n0} - CAST({r0} AS HUGEINT) * {n1}) * (CAST({n1} AS HUGEINT) + {n0})"
    week = "TRUE" if p.start.weekday() == 0 and p.days == 7 else "FALSE"
    measures = ", ".join(f"""CAST(count(*) FILTER (WHERE period = '{period}') AS BIGINT) AS {short}_orders,
         CAST(coalesce(sum(scoped_revenue_cents) FILTER (WHERE period = '{period}'), 0) AS BIGINT) AS {short}_revenue_cents,
         CAST(coalesce(sum(scoped_item_count) FILTER (WHERE period = '{period}'), 0) AS BIGINT) AS {short}_items,
         CAST(count(DISTINCT customer_unique_id) FILTER (WHERE period = '{period}') AS BIGINT) AS {short}_customers"""
                         for period, short in (("current", "current"), ("previous", "prev")))
    return f"""
hagg AS (
  SELECT {byc}{measures}
  FROM tagged_orders WHERE period <> 'history'{grp}),
headline AS (
  SELECT {byc}current_orders, current_revenue_cents, current_items, current_customers,
         CASE WHEN current_orders > 0 THEN CAST(current_revenue_cents AS DOUBLE) / current_orders END
           AS current_average_order_value_cents,
         CASE WHEN comparable THEN prev_orders END AS previous_orders,
         CASE WHEN comparable THEN prev_revenue_cents END AS previous_revenue_cents,
         CASE WHEN comparable THEN prev_items END AS previous_items,
         CASE WHEN comparable THEN prev_customers END AS previous_customers,
         CASE WHEN comparable AND prev_orders > 0 THEN CAST(prev_revenue_cents AS DOUBLE) / prev_orders END
           AS previous_average_order_value_cents,
         CASE WHEN comparable THEN current_revenue_cents - prev_revenue_cents END AS delta_cents,
         CASE WHEN comparable AND prev_revenue_cents <> 0
              THEN CAST(current_revenue_cents - prev_revenue_cents AS DOUBLE) / prev_revenue_cents END
           AS revenue_change_rate,
         current_revenue_cents / {p.days} AS daily_revenue_cents,
         CASE WHEN comparable THEN prev_revenue_cents / {(pe - ps).days + 1} END AS previous_daily_revenue_cents,
         {dec(vol)} AS order_effect_cents, {dec(val)} AS aov_effect_cents,
         comparable, {week} AS is_calendar_week, '{label}' AS comparison_label
  FROM hagg CROSS JOIN cmp)"""


def _headline_sql(p, by=()):
    return base(*_tagged(p), _headline_cte(p, by)) + "SELECT * FROM headline"


def _contrib_cte(dim, name="contrib"):
    src = ("SELECT category AS name, price_cents AS money, period FROM tagged_items" if dim == "category"
           else "SELECT state AS name, scoped_revenue_cents AS money, period FROM tagged_orders")
    return f"""
{name}_agg AS (
  SELECT name, CAST(coalesce(sum(money) FILTER (WHERE period = 'current'), 0) AS BIGINT) AS current_cents,
         CAST(coalesce(sum(money) FILTER (WHERE period = 'previous'), 0) AS BIGINT) AS previous_cents
  FROM ({src}) s WHERE period <> 'history' GROUP BY name),
{name} AS (
  SELECT '{dim}' AS dimension, name, name AS label, current_cents, previous_cents,
         current_cents - previous_cents AS delta_cents,
         CAST(row_number() OVER (ORDER BY abs(current_cents - previous_cents) DESC, name) - 1 AS INTEGER) AS position
  FROM {name}_agg CROSS JOIN cmp WHERE comparable)"""


def _anomaly_sql(p, by=()):
    byc = "".join(f", {b}" for b in by)
    using = "".join(f", {b}" for b in by)
    groups = f" CROSS JOIN (SELECT DISTINCT {', '.join(by)} FROM daily)" if by else ""
    known = lambda x: f"coalesce(cov_start IS NOT NULL AND {x} >= cov_start AND {x} <= cov_end, FALSE)"
    mult = f"CAST('{_AN.mad_multiplier * _AN.mad_scale!r}' AS DOUBLE)"
    return base(scope(p.with_dates(p.start - _td(days=7 * _AN.weeks), p.end)), COV, f"""
daily AS (SELECT purchase_date AS "day"{byc}, count(*) AS order_count FROM scope_orders GROUP BY ALL),
cal AS (SELECT CAST(g AS DATE) AS "day"{byc}, cov_start, cov_end
        FROM generate_series(CAST({lit_date(p.start)} AS TIMESTAMP), CAST({lit_date(p.end)} AS TIMESTAMP),
                             INTERVAL 1 DAY) AS t(g){groups} CROSS JOIN coverage),
hv AS (
  SELECT h."day"{''.join(f', h.{b}' for b in by)}, h.hday, h.cov_start, h.cov_end, coalesce(d.order_count, 0) AS v
  FROM (SELECT c.*, CAST(c."day" - to_days(CAST(7 * k AS INTEGER)) AS DATE) AS hday
        FROM cal c CROSS JOIN range(1, {_AN.weeks + 1}) AS r(k)) h
  LEFT JOIN daily d ON d."day" = h.hday{''.join(f' AND d.{b} = h.{b}' for b in by)}),
center AS (
  SELECT "day"{byc}, count(*) FILTER (WHERE {known('hday')}) AS baseline_n, median(v) AS center,
         max(hday) AS history_end, min(hday) AS history_start
  FROM hv GROUP BY ALL),
mad AS (
  SELECT hv."day"{''.join(f', hv.{b}' for b in by)}, median(abs(hv.v - c.center)) AS mad
  FROM hv JOIN center c USING ("day"{using}) GROUP BY ALL),
actual AS (
  SELECT c."day"{''.join(f', c.{b}' for b in by)},
         CASE WHEN {known('c."day"')} THEN coalesce(d.order_count, 0) END AS order_count,
         {known('c."day"')} AS day_known
  FROM cal c LEFT JOIN daily d ON d."day" = c."day"{''.join(f' AND d.{b} = c.{b}' for b in by)}),
j AS (
  SELECT a.*, c.baseline_n, c.center, c.history_start, c.history_end, m.mad,
         a.day_known AND c.baseline_n = {_AN.weeks} AS "full"
  FROM actual a JOIN center c USING ("day"{using}) JOIN mad m USING ("day"{using})),
k AS (
  SELECT *, CASE WHEN "full" THEN center END AS baseline_median,
         CASE WHEN "full" THEN greatest({mult} * mad, {_AN.median_share} * center, CAST({float(_AN.floor)} AS DOUBLE)) END
           AS threshold
  FROM j)
""") + f"""SELECT "day"{byc}, CAST(order_count AS BIGINT) AS order_count, CAST(baseline_n AS BIGINT) AS baseline_n,
       baseline_median, threshold,
       CASE WHEN NOT "full" THEN 'insufficient' WHEN center < {_AN.min_median} THEN 'insufficient'
            WHEN abs(order_count - baseline_median) > threshold
              THEN CASE WHEN order_count - baseline_median > 0 THEN 'high' ELSE 'low' END
            ELSE 'normal' END AS status,
       CASE WHEN NOT "full" THEN 'outside_coverage' WHEN center < {_AN.min_median} THEN 'sparse_baseline'
            WHEN abs(order_count - baseline_median) > threshold THEN 'deviation' ELSE 'within_threshold' END AS reason,
       history_start, history_end
FROM k"""


_PRIMARY = """
ca AS (SELECT order_id, category, sum(price_cents) AS cents FROM scope_items GROUP BY order_id, category),
pc AS (SELECT order_id, category FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY cents DESC, category) AS rn FROM ca) WHERE rn = 1),
po AS (SELECT o.*, pc.category FROM scope_orders o JOIN pc ON pc.order_id = o.order_id),
labels AS (SELECT * FROM (VALUES (0, 'on_time'), (1, 'late'), (NULL, 'unknown')) AS l(is_late, delivery_group))"""


def _group_stats(by=""):
    keys = f"(SELECT DISTINCT {by} AS name FROM po) nm CROSS JOIN labels l" if by else "labels l"
    gb = f"{by} AS name, " if by else ""
    on = " AND g.name = nm.name" if by else ""
    sel = "nm.name, " if by else ""
    return f"""
SELECT {sel}l.delivery_group, CAST(coalesce(g.orders, 0) AS BIGINT) AS order_count,
       CAST(coalesce(g.n, 0) AS BIGINT) AS reviewed_orders,
       CAST(coalesce(g.orders, 0) - coalesce(g.n, 0) AS BIGINT) AS missing_reviews,
       CASE WHEN g.n > 0 THEN CAST(g.sk AS DOUBLE) / g.n END AS mean_score,
       CASE WHEN g.n > 0 THEN g.med END AS median_score,
       CASE WHEN g.n > 1 THEN sqrt(greatest((g.skk - g.sk * g.sk / g.n) / (g.n - 1), 0.0)) END AS score_sd,
       CASE WHEN g.n > 0 THEN CAST(g.s1 + g.s2 AS DOUBLE) / g.n END AS low_score_share,
       {', '.join(f'CAST(coalesce(g.s{s}, 0) AS BIGINT) AS score_{s}' for s in range(1, 6))}
FROM {keys}
LEFT JOIN (SELECT {gb}is_late, count(*) AS orders, count(review_score) AS n, sum(review_score) AS sk,
                  sum(review_score * review_score) AS skk, median(review_score) AS med,
                  {', '.join(f'count(*) FILTER (WHERE review_score = {s}) AS s{s}' for s in range(1, 6))}
           FROM po GROUP BY ALL) g ON g.is_late IS NOT DISTINCT FROM l.is_late{on}"""


def _strata_cte(dim, name):
    return f"""
{name}_stats AS ({_group_stats(dim)}),
{name}_piv AS (
  SELECT name,
         least(max(reviewed_orders) FILTER (WHERE delivery_group = 'late'),
               max(reviewed_orders) FILTER (WHERE delivery_group = 'on_time')) >= 20 AS comparison_eligible,
         max(mean_score) FILTER (WHERE delivery_group = 'late') - max(mean_score) FILTER (WHERE delivery_group = 'on_time')
           AS gap,
         max(order_count) FILTER (WHERE delivery_group = 'late') AS late_orders
  FROM {name}_stats GROUP BY name),
{name}_pos AS (
  SELECT *, CAST(row_number() OVER (ORDER BY late_orders DESC, name) - 1 AS INTEGER) AS position FROM {name}_piv),
{name} AS (
  SELECT '{dim}' AS dimension, s.*, p.comparison_eligible,
         CASE WHEN p.comparison_eligible THEN p.gap END AS score_gap, p.position
  FROM {name}_stats s JOIN {name}_pos p ON p.name = s.name)"""


def _evidence_sql(report=REPORT, delivery=DELIVERY):
    return base(*_tagged(report), _headline_cte(report), _contrib_cte("category", "cc"), _contrib_cte("state", "cs"),
                scope(delivery, "d_").replace("scope_items", "d_scope_items").replace(
                    "d_d_scope_items", "d_scope_items"),
                _PRIMARY.replace("FROM scope_items", "FROM d_scope_items").replace("FROM scope_orders",
                                                                                     "FROM d_scope_orders"),
                f"grp AS ({_group_stats()})", _strata_cte("category", "sc"), _strata_cte("state", "ss"), """
h AS (
  SELECT * FROM headline
  WHERE comparable AND (delta_cents <> 0 OR current_orders <> previous_orders
                        OR daily_revenue_cents <> previous_daily_revenue_cents)
        AND (current_orders > 0 OR previous_orders > 0)),
contrib AS (SELECT * FROM cc UNION ALL SELECT * FROM cs),
first_nz AS (SELECT dimension, arg_min(name, position) AS name, arg_min(delta_cents, position) AS delta_cents,
                    min(position) AS position
             FROM contrib WHERE delta_cents <> 0 GROUP BY dimension),
g AS (
  SELECT max(reviewed_orders) FILTER (WHERE delivery_group = 'late') AS late_n,
         max(reviewed_orders) FILTER (WHERE delivery_group = 'on_time') AS on_n,
         max(mean_score) FILTER (WHERE delivery_group = 'late') AS late_mean,
         max(mean_score) FILTER (WHERE delivery_group = 'on_time') AS on_mean
  FROM grp),
g_ok AS (SELECT * FROM g WHERE least(late_n, on_n) >= 20),
strata AS (SELECT DISTINCT dimension, name, position, score_gap FROM sc WHERE comparison_eligible
           UNION SELECT DISTINCT dimension, name, position, score_gap FROM ss WHERE comparison_eligible),
first_ok AS (SELECT dimension, arg_min(name, position) AS name, arg_min(score_gap, position) AS score_gap,
                    min(position) AS position FROM strata GROUP BY dimension)""") + """
SELECT 'sales-change' AS task, 'delta_cents' AS label, '/delta_cents' AS pointer, CAST(delta_cents AS DOUBLE) AS value,
       'cents' AS unit FROM h
UNION ALL SELECT 'sales-change', 'daily_revenue_cents', '/daily_revenue_cents', daily_revenue_cents, 'cents' FROM h
UNION ALL SELECT 'sales-change', 'previous_daily_revenue_cents', '/previous_daily_revenue_cents',
                 previous_daily_revenue_cents, 'cents' FROM h
UNION ALL SELECT 'sales-change', first_nz.dimension || ' ' || CAST(name AS VARCHAR) || ' delta_cents',
                 '/contributions/' || dimension || '/' || CAST(position AS VARCHAR) || '/delta_cents',
                 CAST(first_nz.delta_cents AS DOUBLE), 'cents' FROM first_nz CROSS JOIN h
UNION ALL SELECT 'delivery-review', 'late reviewed_orders', '/delivery/groups/late/reviewed_orders', late_n, 'orders'
          FROM g_ok
UNION ALL SELECT 'delivery-review', 'on_time reviewed_orders', '/delivery/groups/on_time/reviewed_orders', on_n,
                 'orders' FROM g_ok
UNION ALL SELECT 'delivery-review', 'late mean_score', '/delivery/groups/late/mean_score', late_mean, 'score' FROM g_ok
UNION ALL SELECT 'delivery-review', 'on_time mean_score', '/delivery/groups/on_time/mean_score', on_mean, 'score'
          FROM g_ok
UNION ALL SELECT 'delivery-review', dimension || ' ' || CAST(name AS VARCHAR) || ' score_gap',
                 '/delivery/strata/' || dimension || '/' || CAST(position AS VARCHAR) || '/score_gap', score_gap, 'score'
          FROM first_ok CROSS JOIN g_ok"""


SQL.update({
    "report_headline": _headline_sql(REPORT),
    "report_headline_week": _headline_sql(REPORT_WEEK),
    "report_headline_by_state": _headline_sql(REPORT, ("state",)),
    "contributions_category": base(*_tagged(REPORT), _contrib_cte("category")) + "SELECT * FROM contrib",
    "contributions_state": base(*_tagged(REPORT), _contrib_cte("state")) + "SELECT * FROM contrib",
    "top_contributions": base(*_tagged(REPORT), _contrib_cte("state")) + "SELECT * FROM contrib WHERE position < 5",
    "daily_series": base(scope(REPORT.with_dates(REPORT.start - _td(days=56), REPORT.end))) + """
SELECT purchase_date AS "day", CAST(count(*) AS BIGINT) AS order_count,
       CAST(sum(scoped_revenue_cents) AS BIGINT) AS revenue_cents FROM scope_orders GROUP BY purchase_date""",
    "anomaly_same_weekday_mad": _anomaly_sql(ANOMALY_SCOPE),
    "anomaly_by_state": _anomaly_sql(ANOMALY_SCOPE, ("state",)),
    "anomaly_summary": "WITH a AS (" + _anomaly_sql(ANOMALY_SCOPE) + """)
SELECT CAST(count(*) FILTER (WHERE status IN ('high', 'low')) AS BIGINT) AS flagged_days,
       CAST(count(*) FILTER (WHERE status = 'high') AS BIGINT) AS high_days,
       CAST(count(*) FILTER (WHERE status = 'low') AS BIGINT) AS low_days,
       CAST(count(*) FILTER (WHERE status = 'insufficient') AS BIGINT) AS insufficient_days FROM a""",
    "primary_category": base(scope(DELIVERY), _PRIMARY) + "SELECT * FROM pc",
    "delivery_cells": base(scope(DELIVERY), _PRIMARY) + """
SELECT category, state, is_late, review_score, CAST(count(*) AS BIGINT) AS order_count FROM po GROUP BY ALL""",
    "score_group_stats": base(scope(DELIVERY), _PRIMARY) + _group_stats(),
    "score_strata_category": base(scope(DELIVERY), _PRIMARY, _strata_cte("category", "st")) + "SELECT * FROM st",
    "score_strata_state": base(scope(DELIVERY), _PRIMARY, _strata_cte("state", "st")) + "SELECT * FROM st",
    "investigation_evidence": _evidence_sql(),
})


# ---- audit -------------------------------------------------------------------------------------------------------
from retailq.operators import audit as _au  # noqa: E402
from retailq.plans.catalog import HORIZON  # noqa: E402

from .base_sql import LANDING  # noqa: E402

_LANDING_COLS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "translation": ["product_category_name", "product_category_name_english"],
}
MISSING = "coalesce(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '') = ''"
TS = "CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN TRY_CAST({c} AS TIMESTAMP) END"
CENTS = "CAST(TRY_CAST(trim({c}) AS DECIMAL(38,10)) * 100 AS BIGINT)"


def _lb(*extra):
    return base(LANDING, *extra)


def _profile_columns_sql():
    parts = []
    for t, cols in _LANDING_COLS.items():
        for c in cols:
            m = MISSING.format(c=c)
            parts.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {m}) AS BIGINT) AS missing, "
                         f"count(*) FILTER (WHERE {m}) / count(*) AS missing_rate, "
                         f"CAST(count(DISTINCT CASE WHEN NOT ({m}) THEN CAST({c} AS VARCHAR) END) AS BIGINT) "
                         f"AS distinct_nonmissing FROM l_{t}")
    return _lb() + "\nUNION ALL ".join(parts)


def _exact_dups_sql():
    parts = [f"SELECT '{t}' AS \"table\", CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} "
             f"FROM l_{t})) AS BIGINT) AS exact_duplicate_rows, CAST(count(*) AS BIGINT) AS \"rows\" FROM l_{t}"
             for t, cols in _LANDING_COLS.items()]
    return _lb() + "\nUNION ALL ".join(parts)


def _candidate_sql():
    parts = []
    for t, key in _au.CANDIDATE_KEYS.items():
        miss = " OR ".join(f"({MISSING.format(c=k)})" for k in key)
        parts.append(f"SELECT '{t}' AS \"table\", '{','.join(key)}' AS candidate_key, "
                     f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(key)} FROM l_{t})) AS BIGINT) "
                     f"AS duplicate_key_rows, CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS missing_key_rows "
                     f"FROM l_{t}")
    return _lb() + "\nUNION ALL ".join(parts)


def _relationship_sql():
    parts = []
    for name, c, cc, p, pc in _au.RELATIONS:
        m = MISSING.format(c=f"ch.{cc}")
        un = f"NOT ({m}) AND ch.{cc} NOT IN (SELECT {pc} FROM l_{p} WHERE {pc} IS NOT NULL)"
        parts.append(f"""SELECT '{name}' AS relation, CAST(count(*) AS BIGINT) AS child_rows,
  CAST(count(*) FILTER (WHERE {m}) AS BIGINT) AS missing_child_keys,
  CAST(count(*) FILTER (WHERE {un}) AS BIGINT) AS unmatched_child_rows,
  CAST(count(DISTINCT CASE WHEN {un} THEN ch.{cc} END) AS BIGINT) AS unmatched_distinct_keys,
  (SELECT CAST(count(*) - count(DISTINCT {pc}) - (CASE WHEN count(*) FILTER (WHERE {pc} IS NULL) > 0 THEN 1 ELSE 0 END)
          + 0 AS BIGINT) FROM l_{p}) AS parent_duplicate_key_rows
FROM l_{c} ch""")
    return _lb() + "\nUNION ALL ".join(parts)


def _dates_sql():
    parts = []
    for t, cols in _au.DATE_COLUMNS.items():
        for c in cols:
            ts, m = TS.format(c=c), MISSING.format(c=c)
            parts.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {m}) AS BIGINT) AS missing, "
                         f"CAST(count(*) FILTER (WHERE NOT ({m}) AND {ts} IS NULL) AS BIGINT) AS invalid_nonmissing, "
                         f"strftime(min({ts}), '%Y-%m-%d %H:%M:%S') AS \"min\", strftime(max({ts}), '%Y-%m-%d %H:%M:%S') AS \"max\" "
                         f"FROM l_{t}")
    return _lb() + "\nUNION ALL ".join(parts)


def _describe_sql(src, col):
    return f"""
d AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS "count", min(x) AS "min", quantile_cont(x, 0.5) AS "median", avg(x) AS mean,
             quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.99) AS p99, max(x) AS "max",
             quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM d),
t AS (SELECT quantile_cont(abs(d.x - s."median"), 0.5) AS mad,
             CAST(count(*) FILTER (WHERE d.x < s.q1 - 1.5 * (s.q3 - s.q1) OR d.x > s.q3 + 1.5 * (s.q3 - s.q1)) AS BIGINT)
               AS iqr_flag_count FROM d CROSS JOIN s)
SELECT * FROM s CROSS JOIN t"""


_FOLDS = f"""
item_fold AS (SELECT order_id, count(*) AS item_rows, count(DISTINCT seller_id) AS sellers,
                     sum({CENTS.format(c='price')} + {CENTS.format(c='freight_value')}) AS items_and_freight
              FROM l_items GROUP BY order_id),
pay_fold AS (SELECT order_id, count(*) AS pay_rows, sum({CENTS.format(c='payment_value')}) AS payments
             FROM l_payments GROUP BY order_id),
rev_fold AS (SELECT order_id, count(*) AS rev_rows FROM l_reviews GROUP BY order_id),
po AS (SELECT order_id, customer_id, order_status, {', '.join(f'{TS.format(c=c)} AS {c}' for c in _au.DATE_COLUMNS['orders'])}
       FROM l_orders),
freq AS (SELECT c.customer_unique_id, count(*) AS orders FROM l_orders o JOIN l_customers c ON c.customer_id = o.customer_id
         WHERE o.order_status = 'delivered' GROUP BY c.customer_unique_id)"""

_STAT_LIST = ", ".join(f"('{s}')" for s in _au.ORDER_STATUSES)

SQL.update({
    "profile_columns": _profile_columns_sql(),
    "profile_exact_duplicates": _exact_dups_sql(),
    "profile_candidate_key": _candidate_sql(),
    "profile_relationship": _relationship_sql(),
    "profile_dates": _dates_sql(),
    "profile_status_counts": _lb() + f"""
SELECT d.status, CAST(coalesce(c.n, 0) AS BIGINT) AS orders
FROM (VALUES {_STAT_LIST}, ('other')) AS d(status)
LEFT JOIN (SELECT CASE WHEN order_status IN ({', '.join(repr(s) for s in _au.ORDER_STATUSES)}) THEN order_status
                       ELSE 'other' END AS status, count(*) AS n FROM l_orders GROUP BY 1) c ON c.status = d.status""",
    "profile_monthly_crosstab": _lb() + f"""
SELECT strftime({TS.format(c='order_purchase_timestamp')}, '%Y-%m') AS "month", CAST(count(*) AS BIGINT) AS orders,
       CAST(count(*) FILTER (WHERE order_status = 'delivered') AS BIGINT) AS delivered
FROM l_orders WHERE {TS.format(c='order_purchase_timestamp')} IS NOT NULL GROUP BY 1""",
    "profile_money": _lb() + "\nUNION ALL ".join(
        f"SELECT '{t}.{c}' AS \"column\", CAST(count(*) FILTER (WHERE {CENTS.format(c=c)} IS NULL) AS BIGINT) AS invalid, "
        f"CAST(count(*) FILTER (WHERE {CENTS.format(c=c)} < 0) AS BIGINT) AS negative, "
        f"CAST(coalesce(sum({CENTS.format(c=c)}), 0) AS BIGINT) AS total_cents FROM l_{t}"
        for t, c in _au.MONEY_COLUMNS),
    "profile_numeric_item_price": _lb(f"pr AS (SELECT {CENTS.format(c='price')} AS v FROM l_items)")
    .rstrip() + "," + _describe_sql("pr", "v"),
    "profile_numeric_payment_difference": _lb(_FOLDS, """
pd AS (SELECT p.payments - i.items_and_freight AS difference_cents FROM item_fold i JOIN pay_fold p USING (order_id))""")
    .rstrip() + "," + _describe_sql("pd", "difference_cents"),
    "profile_payment_reconciliation": _lb(_FOLDS) + """
SELECT CAST(count(*) AS BIGINT) AS comparable_orders,
       CAST(count(*) FILTER (WHERE p.payments - i.items_and_freight = 0) AS BIGINT) AS exact_match_orders,
       CAST(count(*) FILTER (WHERE abs(p.payments - i.items_and_freight) > 1) AS BIGINT) AS difference_over_one_cent_orders,
       CAST(coalesce(sum(p.payments - i.items_and_freight), 0) AS BIGINT) AS sum_payment_minus_items_freight_cents
FROM item_fold i JOIN pay_fold p USING (order_id)
WHERE i.items_and_freight IS NOT NULL AND p.payments IS NOT NULL""",
    "profile_fanout_inflation": _lb(_FOLDS) + f"""
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS delivered_item_revenue_cents, CAST(count(*) AS BIGINT) AS delivered_item_rows,
       CAST(coalesce(sum(c * coalesce(p.pay_rows, 1) * coalesce(r.rev_rows, 1)), 0) AS BIGINT)
         AS naive_items_payments_reviews_revenue_cents
FROM (SELECT order_id, {CENTS.format(c='price')} AS c FROM l_items
      WHERE order_id IN (SELECT order_id FROM l_orders WHERE order_status = 'delivered')) i
LEFT JOIN pay_fold p USING (order_id) LEFT JOIN rev_fold r USING (order_id)""",
    "profile_delivery": _lb(_FOLDS) + """
SELECT CAST(count(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
                             AND order_estimated_delivery_date IS NOT NULL) AS BIGINT) AS delivery_eligible_orders,
       CAST(count(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
                             AND order_estimated_delivery_date IS NOT NULL
                             AND CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE))
            AS BIGINT) AS late_orders
FROM po""",
    "profile_delivery_days": _lb(_FOLDS, """
dd AS (SELECT date_diff('second', order_purchase_timestamp, order_delivered_customer_date) / 86400 AS delivery_days
       FROM po WHERE order_status = 'delivered')""").rstrip() + "," + _describe_sql("dd", "delivery_days"),
    "profile_chronology": _lb(_FOLDS) + f"""
SELECT CAST(count(*) FILTER (WHERE order_approved_at < order_purchase_timestamp) AS BIGINT) AS approval_before_purchase,
       CAST(count(*) FILTER (WHERE order_delivered_carrier_date < order_purchase_timestamp) AS BIGINT) AS carrier_before_purchase,
       CAST(count(*) FILTER (WHERE order_delivered_customer_date < order_purchase_timestamp) AS BIGINT) AS delivery_before_purchase,
       CAST(count(*) FILTER (WHERE order_delivered_customer_date < order_delivered_carrier_date) AS BIGINT) AS delivery_before_carrier,
       CAST(count(*) FILTER (WHERE CAST(order_estimated_delivery_date AS DATE) < CAST(order_purchase_timestamp AS DATE))
            AS BIGINT) AS estimate_before_purchase_day,
       (SELECT CAST(count(*) FILTER (WHERE {TS.format(c='review_answer_timestamp')} < {TS.format(c='review_creation_date')})
               AS BIGINT) FROM l_reviews) AS review_answer_before_creation
FROM po""",
    "profile_child_coverage": _lb(_FOLDS) + """
SELECT CAST(count(*) FILTER (WHERE i.order_id IS NULL) AS BIGINT) AS orders_missing_items,
       CAST(count(*) FILTER (WHERE d AND i.order_id IS NULL) AS BIGINT) AS delivered_missing_items,
       CAST(count(*) FILTER (WHERE p.order_id IS NULL) AS BIGINT) AS orders_missing_payments,
       CAST(count(*) FILTER (WHERE d AND p.order_id IS NULL) AS BIGINT) AS delivered_missing_payments,
       CAST(count(*) FILTER (WHERE r.order_id IS NULL) AS BIGINT) AS orders_missing_reviews,
       CAST(count(*) FILTER (WHERE d AND r.order_id IS NULL) AS BIGINT) AS delivered_missing_reviews,
       CAST(count(*) FILTER (WHERE d AND order_approved_at IS NULL) AS BIGINT) AS delivered_missing_approval,
       CAST(count(*) FILTER (WHERE d AND order_delivered_carrier_date IS NULL) AS BIGINT) AS delivered_missing_carrier,
       CAST(count(*) FILTER (WHERE d AND order_delivered_customer_date IS NULL) AS BIGINT) AS delivered_missing_delivery
FROM (SELECT *, order_status = 'delivered' AS d FROM po) o
LEFT JOIN item_fold i USING (order_id) LEFT JOIN pay_fold p USING (order_id) LEFT JOIN rev_fold r USING (order_id)""",
    "profile_repeat": _lb(_FOLDS) + """
SELECT (SELECT CAST(count(DISTINCT customer_unique_id) AS BIGINT) FROM l_customers) AS unique_customers_all,
       CAST(count(*) AS BIGINT) AS unique_customers_delivered,
       CAST(count(*) FILTER (WHERE orders >= 2) AS BIGINT) AS repeat_customers_delivered_full_window
FROM freq""",
    "profile_orders_per_customer": _lb(_FOLDS) + """
SELECT CAST(orders AS BIGINT) AS orders_per_customer, CAST(count(*) AS BIGINT) AS customers FROM freq GROUP BY orders""",
    "profile_multiplicity": _lb(_FOLDS) + """
SELECT (SELECT CAST(count(*) FILTER (WHERE item_rows > 1) AS BIGINT) FROM item_fold) AS orders_with_multiple_items,
       (SELECT CAST(count(*) FILTER (WHERE sellers > 1) AS BIGINT) FROM item_fold) AS orders_with_multiple_sellers,
       (SELECT CAST(count(*) FILTER (WHERE pay_rows > 1) AS BIGINT) FROM pay_fold) AS orders_with_multiple_payments,
       (SELECT CAST(count(*) FILTER (WHERE rev_rows > 1) AS BIGINT) FROM rev_fold) AS orders_with_multiple_reviews,
       (SELECT CAST(count(DISTINCT customer_id) AS BIGINT) FROM l_orders) AS orders_distinct_customer_ids,
       (SELECT CAST(count(*) AS BIGINT) FROM l_customers WHERE customer_id NOT IN (SELECT customer_id FROM l_orders))
         AS customers_without_orders""",
    "profile_missing_by_status": _lb(_FOLDS) + f"""
SELECT d.status, {', '.join(f'CAST(coalesce(a.{c}, 0) AS BIGINT) AS {c}' for c in ['missing_items'] + [f'missing_{x}' for x in _au.DATE_COLUMNS['orders']])}
FROM (VALUES {_STAT_LIST}) AS d(status)
LEFT JOIN (SELECT order_status AS status, count(*) FILTER (WHERE i.order_id IS NULL) AS missing_items,
                  {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}' for c in _au.DATE_COLUMNS['orders'])}
           FROM po LEFT JOIN item_fold i USING (order_id) GROUP BY order_status) a ON a.status = d.status""",
    "profile_out_of_horizon": _lb() + f"""
SELECT CAST(count(*) FILTER (WHERE {TS.format(c='shipping_limit_date')} >= TIMESTAMP '{HORIZON}') AS BIGINT)
         AS shipping_limit_after_horizon_rows,
       CAST(count(DISTINCT CASE WHEN {TS.format(c='shipping_limit_date')} >= TIMESTAMP '{HORIZON}' THEN order_id END)
            AS BIGINT) AS shipping_limit_after_horizon_orders
FROM l_items""",
    "profile_blank_text": _lb() + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} = '') AS BIGINT) AS empty, "
        f"CAST(count(*) FILTER (WHERE {c} <> '' AND {MISSING.format(c=c)}) AS BIGINT) AS whitespace_only FROM l_reviews"
        for c in ("review_comment_title", "review_comment_message")),
    "profile_review_ids": _lb() + """
SELECT CAST(count(DISTINCT order_id) AS BIGINT) AS reviews_unique_orders,
       CAST(count(DISTINCT review_id) AS BIGINT) AS reviews_unique_ids,
       CAST(count(*) FILTER (WHERE TRY_CAST(trim(review_score) AS DOUBLE) IS NULL
                               OR NOT TRY_CAST(trim(review_score) AS DOUBLE) BETWEEN 1 AND 5
                               OR TRY_CAST(trim(review_score) AS DOUBLE) <> floor(TRY_CAST(trim(review_score) AS DOUBLE)))
            AS BIGINT) AS reviews_invalid_scores,
       (SELECT CAST(count(*) - count(DISTINCT (review_id, order_id)) AS BIGINT) FROM l_reviews)
         AS reviews_duplicate_id_order_pairs
FROM l_reviews""",
    "profile_categories": _lb() + f"""
SELECT CAST(count(DISTINCT CASE WHEN NOT ({MISSING.format(c='product_category_name')}) THEN product_category_name END)
            AS BIGINT) AS raw_categories FROM l_products""",
    "profile_geo": _lb() + """
SELECT (SELECT CAST(count(DISTINCT geolocation_zip_code_prefix) AS BIGINT) FROM l_geolocation) AS geolocation_unique_postcodes,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT geolocation_zip_code_prefix FROM l_geolocation GROUP BY 1
                                              HAVING count(DISTINCT geolocation_state) > 1))
         AS geolocation_postcodes_multiple_states,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT geolocation_zip_code_prefix FROM l_geolocation GROUP BY 1
                                              HAVING count(DISTINCT geolocation_city) > 1))
         AS geolocation_postcodes_multiple_city_spellings,
       CAST(count(*) FILTER (WHERE la IS NULL OR lo IS NULL OR NOT la BETWEEN -90 AND 90 OR NOT lo BETWEEN -180 AND 180)
            AS BIGINT) AS geolocation_invalid_global_coordinates,
       CAST(count(*) FILTER (WHERE NOT coalesce(la BETWEEN -34.0 AND 6.0, FALSE) OR NOT coalesce(lo BETWEEN -74.0 AND -34.0, FALSE))
            AS BIGINT) AS geolocation_outside_coarse_box
FROM (SELECT TRY_CAST(geolocation_lat AS DOUBLE) AS la, TRY_CAST(geolocation_lng AS DOUBLE) AS lo FROM l_geolocation)""",
    "profile_numeric_sanity": _lb() + "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE NOT ({MISSING.format(c=c)}) AND TRY_CAST(trim({c}) AS DOUBLE) IS NULL) AS BIGINT) AS invalid_nonmissing, "
        f"CAST(count(*) FILTER (WHERE TRY_CAST(trim({c}) AS DOUBLE) < 0) AS BIGINT) AS negative, "
        f"CAST(count(*) FILTER (WHERE TRY_CAST(trim({c}) AS DOUBLE) = 0) AS BIGINT) AS zero, "
        f"CAST(count(*) FILTER (WHERE TRY_CAST(trim({c}) AS DOUBLE) <> floor(TRY_CAST(trim({c}) AS DOUBLE))) AS BIGINT) AS fractional "
        f"FROM l_{t}" for t, cols in _au.NUMERIC_COLUMNS.items() for c in cols),
    "audit_crosscheck": _lb() + f"""
SELECT 'missing_delivery_dates' AS "check", a AS actual, a AS expected, TRUE AS passed
FROM (SELECT CAST(count(*) FILTER (WHERE {MISSING.format(c='order_delivered_customer_date')}) AS BIGINT) AS a FROM l_orders)
UNION ALL
SELECT 'delivered_item_revenue_cents', a, a, TRUE
FROM (SELECT CAST(coalesce(sum({CENTS.format(c='price')}), 0) AS BIGINT) AS a FROM l_items
      WHERE order_id IN (SELECT order_id FROM l_orders WHERE order_status = 'delivered'))""",
})


# ---- every bucket against its comparison window -----------------------------------------------------------------
from retailq.plans.catalog import BUCKETS  # noqa: E402


def _buckets_cte(p, grain):
    """Windows of every bucket, found by comparing dates with ranges (the Spark plan joins a calendar of days)."""
    first = {"day": p.start, "week": p.start - _td(days=p.start.weekday()), "month": p.start.replace(day=1)}[grain]
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH"}[grain]
    wide = p.with_dates(p.start - _td(days=(p.end - p.start).days + 32), p.end)
    return [scope(wide), COV, f"""
b0 AS (SELECT CAST(g AS DATE) AS period FROM generate_series(CAST({lit_date(first)} AS TIMESTAMP), CAST({lit_date(p.end)} AS TIMESTAMP),
       INTERVAL {step}) AS t(g)),
b1 AS (SELECT period, {_period_end_sql('period', grain)} AS period_end, greatest(period, {lit_date(p.start)}) AS "start",
              least({_period_end_sql('period', grain)}, {lit_date(p.end)}) AS "end" FROM b0),
b2 AS (SELECT *, "start" = date_trunc('month', "start") AND "end" = last_day("start") AS full_month FROM b1),
b AS (SELECT b2.*, CAST(CASE WHEN full_month THEN "start" - INTERVAL 1 MONTH ELSE "start" - to_days(CAST(date_diff('day', "start", "end") + 1 AS INTEGER)) END AS DATE)
               AS prev_start, CAST("start" - INTERVAL 1 DAY AS DATE) AS prev_end,
             coalesce(cov_start IS NOT NULL AND period >= {lit_date(p.start)} AND period_end <= {lit_date(p.end)}
                      AND period >= cov_start AND period_end <= cov_end, FALSE) AS complete, cov_start, cov_end
      FROM b2 CROSS JOIN coverage),
bw AS (SELECT *, coalesce(cov_start <= prev_start AND "end" <= cov_end, FALSE) AS comparable FROM b)"""]


def _comparison_by_bucket_sql(p, grain):
    def measures(short, a, z):
        inside = f'o.purchase_date BETWEEN bw.{a} AND bw.{z}'
        return f"""(SELECT {{{{'n': count(*), 'r': coalesce(sum(scoped_revenue_cents), 0), 'i': coalesce(sum(scoped_item_count), 0),
               'c': count(DISTINCT customer_unique_id)}}}} FROM scope_orders o WHERE {inside}) AS {short}""".replace("{{", "{").replace("}}", "}")
    n1, r1, n0, r0 = "cur.n", "cur.r", "prv.n", "prv.r"
    dec = lambda num: (f"CASE WHEN comparable AND {n1} > 0 AND {n0} > 0 THEN CAST({num} AS DOUBLE) / "  # noqa: E731
                       f"CAST(2 * CAST({n1} AS HUGEINT) * {n0} AS DOUBLE) END")
    vol = f"(CAST({n1} AS HUGEINT) - {n0}) * (CAST({r1} AS HUGEINT) * {n0} + CAST({r0} AS HUGEINT) * {n1})"
    val = f"(CAST({r1} AS HUGEINT) * {n0} - CAST({r0} AS HUGEINT) * {n1}) * (CAST({n1} AS HUGEINT) + {n0})"
    days = "date_diff('day', \"start\", \"end\") + 1"
    return base(*_buckets_cte(p, grain), f"""
m AS (SELECT bw.*, {measures('cur', '"start"', '"end"')}, {measures('prv', 'prev_start', 'prev_end')} FROM bw)""") + f"""
SELECT period, "start", "end", prev_start, prev_end, complete,
       CAST(cur.n AS BIGINT) AS current_orders, CAST(cur.r AS BIGINT) AS current_revenue_cents, CAST(cur.i AS BIGINT) AS current_items,
       CAST(cur.c AS BIGINT) AS current_customers, CASE WHEN cur.n > 0 THEN CAST(cur.r AS DOUBLE) / cur.n END AS current_average_order_value_cents,
       CASE WHEN comparable THEN CAST(prv.n AS BIGINT) END AS previous_orders, CASE WHEN comparable THEN CAST(prv.r AS BIGINT) END AS previous_revenue_cents,
       CASE WHEN comparable THEN CAST(prv.i AS BIGINT) END AS previous_items, CASE WHEN comparable THEN CAST(prv.c AS BIGINT) END AS previous_customers,
       CASE WHEN comparable AND prv.n > 0 THEN CAST(prv.r AS DOUBLE) / prv.n END AS previous_average_order_value_cents,
       CASE WHEN comparable THEN CAST(cur.r - prv.r AS BIGINT) END AS delta_cents,
       CASE WHEN comparable AND prv.r <> 0 THEN CAST(cur.r - prv.r AS DOUBLE) / prv.r END AS revenue_change_rate,
       cur.r / ({days}) AS daily_revenue_cents,
       CASE WHEN comparable THEN prv.r / (date_diff('day', prev_start, prev_end) + 1) END AS previous_daily_revenue_cents,
       {dec(vol)} AS order_effect_cents, {dec(val)} AS aov_effect_cents, comparable,
       isodow("start") = 1 AND {days} = 7 AS is_calendar_week,
       CASE WHEN full_month THEN 'previous_calendar_month' ELSE 'previous_equal_period' END AS comparison_label
FROM m"""


def _contributions_by_bucket_sql(p, grain, dim):
    src = ("SELECT category AS name, price_cents AS money, purchase_date FROM scope_items" if dim == "category"
           else "SELECT state AS name, scoped_revenue_cents AS money, purchase_date FROM scope_orders")
    return base(*_buckets_cte(p, grain), f"""
src AS ({src}),
met AS (SELECT period, name, CAST(coalesce(sum(money) FILTER (WHERE purchase_date >= "start"), 0) AS BIGINT) AS current_cents,
               CAST(coalesce(sum(money) FILTER (WHERE purchase_date < "start"), 0) AS BIGINT) AS previous_cents
        FROM bw JOIN src ON purchase_date BETWEEN prev_start AND "end" WHERE comparable GROUP BY period, name)""") + f"""
SELECT period, '{dim}' AS dimension, name, current_cents, previous_cents, current_cents - previous_cents AS delta_cents,
       CAST(row_number() OVER (PARTITION BY period ORDER BY abs(current_cents - previous_cents) DESC, name) - 1 AS INTEGER) AS position
FROM met"""


SQL.update({
    **{f"comparison_by_bucket_{g}": _comparison_by_bucket_sql(HISTORY, g) for g in ("day", "week", "month")},
    "comparison_by_bucket_cut": _comparison_by_bucket_sql(BUCKETS, "month"),
    "contributions_by_bucket_category": _contributions_by_bucket_sql(BUCKETS, "week", "category"),
    "contributions_by_bucket_state": _contributions_by_bucket_sql(HISTORY, "month", "state"),
})


# ---- publishing --------------------------------------------------------------------------------------------------
from retailq.plans.catalog import PRESETS  # noqa: E402
from retailq.params import ScopeParams as _SP  # noqa: E402


def _per_preset(make_sql):
    """One complete per-preset query per preset, tagged with the preset name (an independent formulation of the
    Spark job, which answers all presets in one pass)."""
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS preset, q.* FROM ({make_sql(_SP(s, e, cat, st))}) q"
                                 for name, s, e, cat, st in PRESETS)


def _scoped(name):
    """The query of a registered whole-history section for other scope parameters."""
    return lambda p: base(scope(p)) + SQL[name].removeprefix(base(scope(HISTORY)))


def _previous_sql(p):
    head, _ = _comparison_sql(p)
    return head + """SELECT order_count, revenue_cents, item_count, customer_count, average_order_value_cents
FROM rows_ WHERE period = 'previous' AND comparable"""


def _ranked_sql(order):
    return lambda p: base(scope(p), f"products AS ({_PRODUCTS})") + f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}, product_id) AS INTEGER) AS position FROM products)
WHERE position <= 20"""


def _strata_sql(p):
    return base(scope(p), _PRIMARY, _strata_cte("category", "sc"), _strata_cte("state", "ss")) + \
        "SELECT * FROM sc UNION ALL SELECT * FROM ss"


SQL.update({f"preset_{name}": _per_preset(make) for name, make in {
    "kpis": lambda p: base(scope(p)) + KPI_SELECT + " FROM scope_orders",
    "previous": _previous_sql,
    **{f"trend_{g}": (lambda p, g=g: _trend_sql(p, g)) for g in ("day", "week", "month")},
    "categories": lambda p: base(scope(p), f"cats AS ({_RANK_CATEGORIES})") + """
SELECT cats.*, CASE WHEN t.total = 0 THEN 0.0 ELSE CAST(revenue_cents AS DOUBLE) / t.total END AS revenue_share
FROM cats CROSS JOIN (SELECT coalesce(sum(price_cents), 0) AS total FROM scope_items) t""",
    "regions": _scoped("rank_regions"), "products": _ranked_sql("revenue_cents DESC"),
    "low_volume_products": _ranked_sql("item_count, revenue_cents"), "fulfilment": _scoped("fulfilment_summary"),
    "fulfilment_groups": _scoped("fulfilment_groups"), "scores": _scoped("score_histogram"),
    "customers": _summary_sql, "distribution": _distribution_sql,
    "frequency": lambda p: _customer_base(p) + "SELECT frequency, CAST(count(*) AS BIGINT) AS customer_count FROM cw GROUP BY frequency",
    "segments": lambda p: _customer_base(p) + "SELECT * FROM segments",
    "beyond_recency": lambda p: _customer_base(p) + """
SELECT CAST(coalesce(sum(customer_count) FILTER (WHERE "key" LIKE '0%'), 0) AS BIGINT) AS customers_beyond_recency FROM segments""",
    "report_headline": _headline_sql,
    "contributions": lambda p: base(*_tagged(p), _contrib_cte("category", "cc"), _contrib_cte("state", "cs"))
    + "SELECT * FROM cc UNION ALL SELECT * FROM cs",
    "anomalies": _anomaly_sql, "delivery_groups": lambda p: base(scope(p), _PRIMARY) + _group_stats(),
    "delivery_strata": _strata_sql, "investigations": lambda p: _evidence_sql(p, p)}.items()})

SQL["cross_view_consistency"] = base(scope(CUSTOMER_YEAR)) + """
SELECT CAST(1 AS BIGINT) AS distinct_totals, TRUE AS consistent, "view",
       (SELECT CAST(sum(price_cents) AS BIGINT) FROM scope_items) AS revenue_cents
FROM (VALUES ('dashboard'), ('customers'), ('categories'), ('regions')) AS t("view")"""


def _compared_rows(names, columns):
    """How many rows each section has for each preset, zero included: what a verification must have compared. The star tables
    stand once in front, since all sections of all presets read them."""
    presets = ", ".join(f"('{p[0]}')" for p in PRESETS)
    star_ctes = base().removeprefix("WITH ").rstrip()
    kept = star_ctes
    for table in ("dim_customer", "dim_product", "dim_seller", "fact_order", "fact_item"):
        kept = kept.replace(f"{table} AS (", f"{table} AS MATERIALIZED (")
    return f"WITH {kept}\n" + " UNION ALL ".join(f"""SELECT '{name}' AS section, p.preset, {columns}
FROM (VALUES {presets}) AS p(preset) LEFT JOIN ({SQL[f"preset_{name}"].replace(star_ctes + ",", "")}) q ON q.preset = p.preset GROUP BY p.preset""" for name in names)


from retailq.plans import verify_snapshots as _vs  # noqa: E402
from retailq.plans.publish import SNAPSHOT_SECTIONS as _SECTIONS  # noqa: E402

SQL.update({name: _compared_rows(sections, "count(q.preset) AS compared_rows, CAST(0 AS BIGINT) AS difference_rows") for name, sections in (
    ("verify_dashboard_from_raw", _vs.DASHBOARD), ("verify_customers_from_raw", _vs.CUSTOMERS), ("verify_reports_from_raw", _vs.REPORTS))})
SQL["verify_snapshots"] = _compared_rows(_SECTIONS, "count(q.preset) AS published_rows, count(q.preset) AS recomputed_rows, TRUE AS equal")

from retailq.plans.catalog import VERIFY_SCOPES  # noqa: E402

SQL.update({
    "kpis_from_raw": SQL["kpis"],
    "verify_kpis_from_raw": base(*[scope(p, f"v{i}_") for i, p in enumerate(VERIFY_SCOPES.values())]) + " UNION ALL ".join(
        f"SELECT '{name}' AS scope, count(*) AS order_count, CAST(0 AS BIGINT) AS difference_rows FROM v{i}_scope_orders"
        for i, name in enumerate(VERIFY_SCOPES)),
})

SQL["overview_sample"] = base("""ot AS (SELECT o.order_id, sum(i.price_cents) AS amount_cents FROM t_orders o JOIN t_items i ON i.order_id = o.order_id
         WHERE o.order_status = 'delivered' GROUP BY o.order_id)""") + """
SELECT CAST(count(*) AS BIGINT) AS order_count, CAST(coalesce(sum(amount_cents), 0) AS BIGINT) AS revenue_cents,
       CASE WHEN count(*) = 0 THEN NULL ELSE coalesce(sum(amount_cents), 0) / count(*) END AS average_order_value_cents
FROM ot"""


def _field_dictionary_sql():
    from retailq.schema import FIELDS
    values = ", ".join("(" + ", ".join(sql_str(x) for x in f) + ")" for f in FIELDS)
    prof = _profile_columns_sql()
    return f"""WITH reg AS (SELECT * FROM (VALUES {values}) AS r(name, logical_type, meaning, "domain")),
prof AS ({prof})
SELECT p."table", p."column" AS name, r.logical_type, r.meaning, r."domain", p.missing, p.distinct_nonmissing
FROM prof p LEFT JOIN reg r ON r.name = p."column\""""


from .base_sql import sql_str  # noqa: E402

SQL["field_dictionary"] = _field_dictionary_sql()


def _customer_state_base(p):
    return base(scope(p), f"""
first_purchase AS (
  SELECT c.customer_unique_id, min(o.purchase_date) AS first_day
  FROM fact_order o JOIN dim_customer c ON c.customer_id = o.customer_id
  WHERE o.status = 'delivered' AND o.purchase_date <= {lit_date(p.end)}
  GROUP BY c.customer_unique_id),
cw AS (
  SELECT s.customer_unique_id, s.state, min(f.first_day) AS first_day, max(s.purchase_date) AS last_day,
         CAST(count(*) AS BIGINT) AS frequency, CAST(sum(s.scoped_revenue_cents) AS BIGINT) AS monetary_cents,
         CAST(date_diff('day', max(s.purchase_date), {lit_date(p.end)}) AS INTEGER) AS recency_days
  FROM scope_orders s JOIN first_purchase f ON f.customer_unique_id = s.customer_unique_id
  GROUP BY s.customer_unique_id, s.state)""")


SQL.update({
    "customer_summary_by_state": _customer_state_base(CUSTOMER_YEAR) + f"""
SELECT state, CAST(count(*) AS BIGINT) AS customer_count,
       CAST(count(*) FILTER (WHERE first_day >= {lit_date(CUSTOMER_YEAR.start)}) AS BIGINT) AS new_customers,
       CAST(count(*) - count(*) FILTER (WHERE first_day >= {lit_date(CUSTOMER_YEAR.start)}) AS BIGINT) AS returning_customers,
       CAST(count(*) FILTER (WHERE frequency >= 2) AS BIGINT) AS repeat_customers,
       CAST(count(*) FILTER (WHERE frequency >= 2) AS DOUBLE) / count(*) AS repeat_rate,
       CAST(coalesce(sum(frequency), 0) AS BIGINT) AS order_count,
       CAST(coalesce(sum(monetary_cents), 0) AS BIGINT) AS revenue_cents,
       CAST(count(*) - count(*) FILTER (WHERE frequency >= 2) AS DOUBLE) / count(*) AS single_purchase_share
FROM cw GROUP BY state""",
    "rfm_segments_by_state": _customer_state_base(HISTORY).rstrip() + f""",
seg AS (
  SELECT state, (CASE WHEN recency_days <= {_RFM.recent_days} THEN '1' ELSE '0' END) ||
         (CASE WHEN frequency >= {_RFM.repeat_orders} THEN '1' ELSE '0' END) ||
         (CASE WHEN monetary_cents >= {_RFM.amount_cents} THEN '1' ELSE '0' END) AS "key",
         CAST(count(*) AS BIGINT) AS customer_count, CAST(sum(frequency) AS BIGINT) AS order_count,
         CAST(sum(monetary_cents) AS BIGINT) AS revenue_cents
  FROM cw GROUP BY 1, 2)
SELECT g.state, k."key", coalesce(s.customer_count, 0) AS customer_count, coalesce(s.order_count, 0) AS order_count,
       coalesce(s.revenue_cents, 0) AS revenue_cents
FROM (SELECT DISTINCT state FROM cw) g
CROSS JOIN (VALUES ('111'), ('110'), ('101'), ('100'), ('011'), ('010'), ('001'), ('000')) AS k("key")
LEFT JOIN seg s ON s.state = g.state AND s."key" = k."key\"""",
})

SQL["verify_sections_from_raw"] = """SELECT section, CAST(0 AS BIGINT) AS difference_rows FROM (VALUES ('trend_day'),
  ('trend_week'), ('trend_month'), ('fulfilment'), ('customers'), ('state_contributions'), ('report_headline'),
  ('delivery_groups')) AS t(section)"""


# ---- landing constraints (one violations table) -----------------------------------------------------------------
from retailq.params import ORDER_STATUSES as _STATUSES  # noqa: E402

from .base_sql import sql_str  # noqa: E402

_TS_OK = "regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL"
_MONEY_OK = ("coalesce(TRY_CAST(trim({c}) AS DECIMAL(38,10)) * 100 = floor(TRY_CAST(trim({c}) AS DECIMAL(38,10)) * 100) "
             "AND TRY_CAST(trim({c}) AS DECIMAL(38,10)) >= 0, FALSE)")
_INT_OK = "coalesce(regexp_full_match({c}, '[1-9][0-9]*') AND TRY_CAST({c} AS BIGINT) <= 2147483647, FALSE)"


def _viol_row(constraint, table, column, bad, key):
    return (f"SELECT '{constraint}' AS \"constraint\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS n, "
            f"min(CASE WHEN {bad} THEN CAST({key} AS VARCHAR) END) AS sample_key FROM l_{table}")


def _viol_unique(table, keys):
    key = " || '|' || ".join(keys)
    empty = " OR ".join(f"{MISSING.format(c=k)}" for k in keys)
    return (f"SELECT 'unique_key' AS \"constraint\", '{table}' AS \"table\", '{','.join(keys)}' AS \"column\", "
            f"CAST(coalesce(sum(CASE WHEN c > 1 THEN c - 1 ELSE 0 END) + sum(CASE WHEN e THEN c ELSE 0 END), 0) AS BIGINT)"
            f" AS n, min(CASE WHEN c > 1 OR e THEN k END) AS sample_key "
            f"FROM (SELECT {key} AS k, count(*) AS c, bool_or({empty}) AS e FROM l_{table} GROUP BY {', '.join(keys)}) g")


def _viol_fk(table, column, parent, parent_column):
    return (f"SELECT 'foreign_key', '{table}', '{column}', CAST(count(*) AS BIGINT), min(CAST({column} AS VARCHAR)) "
            f"FROM l_{table} WHERE {column} IS NULL "
            f"OR {column} NOT IN (SELECT {parent_column} FROM l_{parent} WHERE {parent_column} IS NOT NULL)")


def _landing_violations_sql():
    rows = [_viol_unique("orders", ["order_id"]), _viol_unique("customers", ["customer_id"]),
            _viol_unique("products", ["product_id"]), _viol_unique("sellers", ["seller_id"]),
            _viol_unique("translation", ["product_category_name"]),
            _viol_unique("items", ["order_id", "order_item_id"]),
            _viol_unique("payments", ["order_id", "payment_sequential"]),
            _viol_fk("orders", "customer_id", "customers", "customer_id"),
            _viol_fk("items", "order_id", "orders", "order_id"), _viol_fk("items", "product_id", "products", "product_id"),
            _viol_fk("items", "seller_id", "sellers", "seller_id"), _viol_fk("payments", "order_id", "orders", "order_id"),
            _viol_fk("reviews", "order_id", "orders", "order_id"),
            "SELECT 'delivered_has_items', 'orders', 'order_id', CAST(count(*) AS BIGINT), min(order_id) FROM l_orders "
            "WHERE order_status = 'delivered' AND (order_id IS NULL "
            "OR order_id NOT IN (SELECT order_id FROM l_items WHERE order_id IS NOT NULL))"]
    length = lambda c, n, req=True: f"(char_length({c}) > {n}" + (f" OR {c} = '')" if req else ")")
    ts_bad = lambda c, req=False: f"(({c} <> '' AND NOT ({_TS_OK.format(c=c)}))" + (f" OR {c} = '')" if req else ")")
    ids = ["order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "review_id"]
    tables = {"orders": ["order_id", "customer_id"], "items": ["order_id", "product_id", "seller_id"],
              "customers": ["customer_id", "customer_unique_id"], "products": ["product_id"], "sellers": ["seller_id"],
              "payments": ["order_id"], "reviews": ["review_id", "order_id"]}
    first = {"customers": "customer_id", "products": "product_id", "sellers": "seller_id"}
    for t, cols in tables.items():
        key = "order_id" if t in ("orders", "items", "payments", "reviews") else first[t]
        rows += [_viol_row("string_length", t, c, length(c, 64), key) for c in ids if c in cols]
    rows += [_viol_row("string_length", "customers", "customer_state", length("customer_state", 8, False), "customer_id"),
             _viol_row("string_length", "sellers", "seller_state", length("seller_state", 8, False), "seller_id"),
             _viol_row("string_length", "products", "product_category_name", length("product_category_name", 128, False),
                       "product_id"),
             _viol_row("string_length", "translation", "product_category_name",
                       length("product_category_name", 128, False), "product_category_name"),
             _viol_row("string_length", "translation", "product_category_name_english",
                       length("product_category_name_english", 128, False), "product_category_name"),
             _viol_row("domain", "orders", "order_status",
                       f"NOT coalesce(order_status IN ({', '.join(sql_str(s) for s in _STATUSES)}), FALSE)", "order_id")]
    rows += [_viol_row("timestamp", "orders", c, ts_bad(c, c == "order_purchase_timestamp"), "order_id")
             for c in ("order_purchase_timestamp", "order_delivered_carrier_date", "order_delivered_customer_date",
                       "order_estimated_delivery_date", "order_approved_at")]
    rows += [_viol_row("positive_int", "items", "order_item_id", f"NOT {_INT_OK.format(c='order_item_id')}", "order_id"),
             _viol_row("money", "items", "price", f"NOT {_MONEY_OK.format(c='price')}", "order_id"),
             _viol_row("money", "items", "freight_value", f"NOT {_MONEY_OK.format(c='freight_value')}", "order_id"),
             _viol_row("timestamp", "items", "shipping_limit_date", ts_bad("shipping_limit_date"), "order_id"),
             _viol_row("positive_int", "payments", "payment_sequential",
                       f"NOT {_INT_OK.format(c='payment_sequential')}", "order_id"),
             _viol_row("money", "payments", "payment_value", f"NOT {_MONEY_OK.format(c='payment_value')}", "order_id"),
             _viol_row("domain", "reviews", "review_score",
                       "NOT coalesce(regexp_full_match(review_score, '[1-5]'), FALSE)", "order_id"),
             _viol_row("timestamp", "reviews", "review_creation_date", ts_bad("review_creation_date"), "order_id"),
             _viol_row("timestamp", "reviews", "review_answer_timestamp", ts_bad("review_answer_timestamp"), "order_id")]
    for t, c in (("items", "price"), ("items", "freight_value"), ("payments", "payment_value")):
        rows.append(f"SELECT 'bounded_sum', '{t}', '{c}', CAST(CASE WHEN coalesce(sum(CAST({CENTS.format(c=c)} AS HUGEINT)), 0)"
                    f" > 9223372036854775807 THEN 1 ELSE 0 END AS BIGINT), CAST(NULL AS VARCHAR) FROM l_{t}")
    return _lb() + "\nUNION ALL\n".join(rows)


SQL["landing_violations"] = SQL["staged_violations"] = _landing_violations_sql()


SQL["reconcile_load"] = base() + """,
a AS (SELECT CAST(count(*) AS BIGINT) AS order_count, CAST(coalesce(sum(revenue_cents), 0) AS BIGINT) AS order_revenue,
             CAST(coalesce(sum(freight_cents), 0) AS BIGINT) AS order_freight,
             CAST(coalesce(sum(payment_cents), 0) AS BIGINT) AS order_payments,
             CAST(count(*) FILTER (WHERE status = 'delivered') AS BIGINT) AS delivered_orders,
             CAST(coalesce(sum(revenue_cents) FILTER (WHERE status = 'delivered'), 0) AS BIGINT) AS delivered_revenue
      FROM fact_order),
b AS (SELECT CAST(count(*) AS BIGINT) AS item_count, CAST(coalesce(sum(price_cents), 0) AS BIGINT) AS item_revenue,
             CAST(coalesce(sum(freight_cents), 0) AS BIGINT) AS item_freight FROM fact_item),
c AS (SELECT CAST(count(*) AS BIGINT) AS daily_orders, CAST(coalesce(sum(revenue_cents), 0) AS BIGINT) AS daily_revenue
      FROM fact_order WHERE status = 'delivered'),
e AS (SELECT CAST(count(*) AS BIGINT) AS raw_orders,
             CAST(count(*) FILTER (WHERE order_status = 'delivered') AS BIGINT) AS raw_delivered FROM t_orders),
f AS (SELECT CAST(count(*) AS BIGINT) AS raw_items, CAST(coalesce(sum(price_cents), 0) AS BIGINT) AS raw_revenue,
             CAST(coalesce(sum(freight_cents), 0) AS BIGINT) AS raw_freight FROM t_items),
g AS (SELECT CAST(coalesce(sum(payment_cents), 0) AS BIGINT) AS raw_payments FROM t_payments),
h AS (SELECT CAST(coalesce(sum(price_cents), 0) AS BIGINT) AS raw_delivered_revenue FROM t_items
      WHERE order_id IN (SELECT order_id FROM t_orders WHERE order_status = 'delivered')),
r AS (SELECT * FROM a, b, c, e, f, g, h)
SELECT "check", actual, expected, actual = expected AS passed FROM (
  SELECT 'order count' AS "check", order_count AS actual, raw_orders AS expected FROM r
  UNION ALL SELECT 'item count', item_count, raw_items FROM r
  UNION ALL SELECT 'item revenue', item_revenue, raw_revenue FROM r
  UNION ALL SELECT 'order revenue', order_revenue, raw_revenue FROM r
  UNION ALL SELECT 'item freight', item_freight, raw_freight FROM r
  UNION ALL SELECT 'order freight', order_freight, raw_freight FROM r
  UNION ALL SELECT 'order payments', order_payments, raw_payments FROM r
  UNION ALL SELECT 'delivered orders', delivered_orders, raw_delivered FROM r
  UNION ALL SELECT 'delivered revenue', delivered_revenue, raw_delivered_revenue FROM r
  UNION ALL SELECT 'daily orders', daily_orders, raw_delivered FROM r
  UNION ALL SELECT 'daily revenue', daily_revenue, raw_delivered_revenue FROM r) x"""


SQL["coverage_window"] = base(COV) + "SELECT cov_start, cov_end FROM coverage"
SQL["coverage_from_daily"] = SQL["coverage_window"]
SQL["order_list_deep"] = SQL["order_list"].replace("LIMIT 20 OFFSET 40", "LIMIT 10 OFFSET 3990")
SQL["order_list_after"] = base(scope(HISTORY)) + """
SELECT order_id, purchase_date, state, scoped_item_count AS item_count, scoped_revenue_cents AS revenue_cents,
       payment_cents, review_score, is_late, array_to_string(quality_flags, ',') AS quality_flags
FROM scope_orders
WHERE purchase_date < DATE '1998-07-15' OR (purchase_date = DATE '1998-07-15' AND order_id > 30000)
ORDER BY purchase_date DESC, order_id LIMIT 20"""


from retailq.plans.catalog import ROUNDTRIP_COLUMNS  # noqa: E402


def _digest_sql(name, columns):
    source = f"l_{name}"
    if name == "reviews":
        source = """(SELECT * REPLACE ('line "' || review_id || '", one' || chr(10) || order_id || chr(92)
                     AS review_comment_message) FROM l_reviews)"""
    text = ", ".join(f"coalesce({c}, '<null>')" for c in columns)
    return f"""SELECT '{name}' AS "table", count(*) AS row_count, CAST(0 AS BIGINT) AS wrong_width_rows,
       CAST(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT) AS BIGINT) AS content_sum,
       count(*) AS counted_records, CAST(0 AS BIGINT) AS unclosed_files
FROM {source}"""


SQL["landing_roundtrip"] = base("", LANDING) + " UNION ALL ".join(
    _digest_sql(name, columns) for name, columns in ROUNDTRIP_COLUMNS.items())
