"""Diagnostic report: headline with exact decomposition, contributions, daily series, same-weekday MAD anomalies,
primary category per order, delivery-versus-rating groups and strata, and traceable evidence rows.

One widened scope ``[min(prior_start, start - lookback), end]`` is tagged with a ``period`` column and every section
is a conditional aggregate over it; optional ``by`` columns (e.g. ``state``) answer all groups in one job.
"""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import STRATA_MIN_REVIEWED, AnomalyRules, ScopeParams
from .scope import Scope, build_scope



def _zero() -> F.Column:
    return F.lit(0).cast("bigint")


# ---- comparability and tagging ----------------------------------------------------------------------------------

def report_comparable(coverage_row: DataFrame, params: ScopeParams) -> DataFrame:
    """One row: cov_start <= prior_start <= start and end <= cov_end."""
    ps, _, _ = params.comparison()
    c = F.col("cov_start").isNotNull() & (F.col("cov_start") <= F.lit(ps)) & (F.lit(ps) <= F.lit(params.start)) \
        & (F.lit(params.end) <= F.col("cov_end"))
    return coverage_row.select(F.coalesce(c, F.lit(False)).alias("comparable"))


def tagged_scope(star: dict[str, DataFrame], params: ScopeParams, lookback_days: int = 0) -> Scope:
    """Scope over the union of current, comparison and look-back days, with a ``period`` tag on both grains."""
    ps, pe, _ = params.comparison()
    lo = min(ps, params.start - timedelta(days=lookback_days))
    wide = build_scope(star, params.with_dates(lo, params.end))
    tag = (F.when(F.col("purchase_date").between(F.lit(params.start), F.lit(params.end)), F.lit("current"))
           .when(F.col("purchase_date").between(F.lit(ps), F.lit(pe)), F.lit("previous")).otherwise(F.lit("history")))
    return Scope(wide.params, wide.items.withColumn("period", tag), wide.orders.withColumn("period", tag))


# ---- headline and decomposition ---------------------------------------------------------------------------------

def _sum_if(period: str, col: str) -> F.Column:
    return F.coalesce(F.sum(F.when(F.col("period") == period, F.col(col))), _zero())


def _count_if(period: str) -> F.Column:
    return F.count_if(F.col("period") == period)


def decompose_columns(n1: str, r1: str, n0: str, r0: str) -> list[F.Column]:  # [order_effect, aov_effect]
    """Symmetric volume/value split, exact: integer numerators over 2*N1*N0, one final division.

    order_effect = (N1-N0)(R1*N0 + R0*N1) / (2 N1 N0); aov_effect = (R1*N0 - R0*N1)(N1+N0) / (2 N1 N0).
    NULL when either side has no orders."""
    d = lambda c: F.col(c).cast("decimal(38,0)")
    den = F.lit(2).cast("decimal(38,0)") * d(n1) * d(n0)
    vol = (d(n1) - d(n0)) * (d(r1) * d(n0) + d(r0) * d(n1))
    val = (d(r1) * d(n0) - d(r0) * d(n1)) * (d(n1) + d(n0))
    ok = F.col(n1).isNotNull() & F.col(n0).isNotNull() & (F.col(n1) > 0) & (F.col(n0) > 0)
    return [F.when(ok, vol.cast("double") / den.cast("double")),
            F.when(ok, val.cast("double") / den.cast("double"))]


def report_headline(star: dict[str, DataFrame], params: ScopeParams, coverage_row: DataFrame,
                    by: list[str] | tuple = (), scope: Scope | None = None) -> DataFrame:
    """Orders, revenue, items, customers and order value of both periods, delta, change rate, per-day revenue,
    decomposition, flags.
    ``scope``: an already built (persisted) ``tagged_scope`` to read instead of building one."""
    ps, pe, label = params.comparison()
    sc = scope or tagged_scope(star, params)
    o = sc.orders.filter(F.col("period") != "history")
    grouped = o.groupBy(*by) if by else o
    agg = grouped.agg(*[c for period in ("current", "previous") for c in (
        _count_if(period).alias(f"{period}_orders"), _sum_if(period, "scoped_revenue_cents").alias(f"{period}_revenue_cents"),
        _sum_if(period, "scoped_item_count").cast("bigint").alias(f"{period}_items"),
        F.countDistinct(F.when(F.col("period") == period, F.col("customer_unique_id"))).alias(f"{period}_customers"))])
    agg = agg.crossJoin(F.broadcast(report_comparable(coverage_row, params))).select(
        "*", F.lit(params.days).alias("days"), F.lit((pe - ps).days + 1).alias("previous_days"),
        F.lit(params.start.weekday() == 0 and params.days == 7).alias("is_calendar_week"), F.lit(label).alias("comparison_label"))
    return headline_columns(agg, by)


HEADLINE_MEASURES = ("orders", "revenue_cents", "items", "customers")


def headline_columns(totals: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """The headline from both periods' measures (``current_*`` and ``previous_*``), ``comparable``, both lengths in days
    and the labels: everything about the previous period is NULL where the periods are not comparable."""
    prev = lambda c: F.when(F.col("comparable"), F.col(c) if isinstance(c, str) else c)
    aov = lambda period: F.try_divide(F.col(f"{period}_revenue_cents").cast("double"), F.col(f"{period}_orders"))
    delta = F.col("current_revenue_cents") - F.col("previous_revenue_cents")
    effects = zip(decompose_columns("current_orders", "current_revenue_cents", "previous_orders", "previous_revenue_cents"),
                  ("order_effect_cents", "aov_effect_cents"))
    return totals.select(
        *by, *[f"current_{m}" for m in HEADLINE_MEASURES], aov("current").alias("current_average_order_value_cents"),
        *[prev(f"previous_{m}").alias(f"previous_{m}") for m in HEADLINE_MEASURES],
        prev(aov("previous")).alias("previous_average_order_value_cents"),
        prev(delta).alias("delta_cents"),
        F.when(F.col("comparable") & (F.col("previous_revenue_cents") != 0), delta / F.col("previous_revenue_cents"))
        .alias("revenue_change_rate"),
        (F.col("current_revenue_cents") / F.col("days")).alias("daily_revenue_cents"),
        prev(F.col("previous_revenue_cents") / F.col("previous_days")).alias("previous_daily_revenue_cents"),
        *[prev(c).alias(name) for c, name in effects], "comparable", "is_calendar_week", "comparison_label")


# ---- contributions ----------------------------------------------------------------------------------------------

def contributions(star: dict[str, DataFrame], params: ScopeParams, coverage_row: DataFrame,
                  dimension: str, scope: Scope | None = None) -> DataFrame:
    """Per category (item money) or customer state (order money): current, previous, delta; every key of either
    period appears once (one pass with conditional sums = full outer join of the two periods). Empty when the
    periods are not comparable. ``position`` is the order by |delta| desc, name."""
    sc = scope or tagged_scope(star, params)
    if dimension == "category":
        src, money = sc.items, "price_cents"
    elif dimension == "state":
        src, money = sc.orders, "scoped_revenue_cents"
    else:
        raise ValueError("dimension must be category or state")
    src = src.filter(F.col("period") != "history")
    agg = src.groupBy(F.col(dimension).alias("name")).agg(
        _sum_if("current", money).alias("current_cents"), _sum_if("previous", money).alias("previous_cents"))
    agg = agg.withColumn("delta_cents", F.col("current_cents") - F.col("previous_cents")) \
        .crossJoin(F.broadcast(report_comparable(coverage_row, params))).filter("comparable").drop("comparable")
    w = Window.partitionBy(F.lit(dimension)).orderBy(F.desc(F.abs(F.col("delta_cents"))), "name")
    return agg.select(F.lit(dimension).alias("dimension"), "name", F.col("name").alias("label"), "current_cents",
                      "previous_cents", "delta_cents", (F.row_number().over(w) - 1).alias("position"))


def top_contributions(contrib: DataFrame, k: int = 5) -> DataFrame:
    return contrib.filter(F.col("position") < k)


# ---- daily series and anomalies ---------------------------------------------------------------------------------

def daily_series(star: dict[str, DataFrame], params: ScopeParams, lookback_days: int = 56,
                 by: list[str] | tuple = (), scope: Scope | None = None) -> DataFrame:
    """Orders and revenue per purchase day from start - lookback to end, same filters."""
    lo = params.start - timedelta(days=lookback_days)
    if scope is not None:
        orders = scope.orders.filter(F.col("purchase_date").between(F.lit(lo), F.lit(params.end)))
    else:
        orders = build_scope(star, params.with_dates(lo, params.end)).orders
    return orders.groupBy(F.col("purchase_date").alias("day"), *by).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("scoped_revenue_cents").alias("revenue_cents"))


def anomaly_same_weekday_mad(daily: DataFrame, params: ScopeParams, coverage_row: DataFrame,
                             rules: AnomalyRules = AnomalyRules(), by: list[str] | tuple = ()) -> DataFrame:
    """For each day: the previous ``weeks`` same weekdays as baseline (never the day itself or the future).

    median and MAD of the baseline counts (absent covered days count 0); threshold = max(k*1.4826*MAD,
    share*median, floor); strictly above -> high/low. Insufficient when the day or any baseline day lies outside
    the coverage, or when the median is below ``min_median``. Calendar x offsets is an equi join on the date."""
    spark = daily.sparkSession
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(params.start), F.lit(params.end))).alias("day"))
    if by:
        cal = cal.crossJoin(daily.select(*by).distinct())
    return anomalies_on(cal, daily, coverage_row, rules, by)


def anomalies_on(calendar: DataFrame, daily: DataFrame, coverage_row: DataFrame, rules: AnomalyRules = AnomalyRules(),
                 by: list[str] | tuple = ()) -> DataFrame:
    """The rule for every (day, *by) of ``calendar``, whose groups may have ranges of their own."""
    cal = calendar.crossJoin(F.broadcast(coverage_row))
    known = lambda c: F.coalesce(F.col("cov_start").isNotNull() & (c >= F.col("cov_start"))
                                 & (c <= F.col("cov_end")), F.lit(False))
    counts = daily.select(F.col("day").alias("hday"), *by, F.col("order_count").alias("v"))
    hist = (cal.select("day", *by, "cov_start", "cov_end",
                       F.explode(F.sequence(F.lit(1), F.lit(rules.weeks))).alias("k"))
            .withColumn("hday", F.date_sub(F.col("day"), F.col("k") * 7))
            .join(counts, ["hday", *by], "left")
            .withColumn("v", F.coalesce("v", _zero())))
    center = hist.groupBy("day", *by).agg(
        F.count_if(known(F.col("hday"))).alias("baseline_n"), F.median("v").alias("center"),
        F.max("hday").alias("history_end"), F.min("hday").alias("history_start"))
    mad = hist.join(center.select("day", *by, "center"), ["day", *by]).groupBy("day", *by).agg(
        F.median(F.abs(F.col("v") - F.col("center"))).alias("mad"))
    actual = cal.join(daily.select("day", *by, F.col("order_count").alias("n")), ["day", *by], "left") \
        .select("day", *by, F.when(known(F.col("day")), F.coalesce("n", _zero())).alias("order_count"),
                known(F.col("day")).alias("day_known"))
    j = actual.join(center, ["day", *by]).join(mad, ["day", *by])
    full = F.col("day_known") & (F.col("baseline_n") == rules.weeks)
    threshold = F.greatest(F.lit(rules.mad_multiplier * rules.mad_scale) * F.col("mad"),
                           F.lit(rules.median_share) * F.col("center"), F.lit(float(rules.floor)))
    delta = F.col("order_count") - F.col("baseline_median")
    j = j.withColumn("baseline_median", F.when(full, F.col("center"))) \
        .withColumn("threshold", F.when(full, threshold))
    status = (F.when(~full, F.lit("insufficient")).when(F.col("center") < rules.min_median, F.lit("insufficient"))
              .when(F.abs(delta) > F.col("threshold"), F.when(delta > 0, F.lit("high")).otherwise(F.lit("low")))
              .otherwise(F.lit("normal")))
    reason = (F.when(~full, F.lit("outside_coverage")).when(F.col("center") < rules.min_median, F.lit("sparse_baseline"))
              .when(F.abs(delta) > F.col("threshold"), F.lit("deviation")).otherwise(F.lit("within_threshold")))
    return j.select("day", *by, "order_count", "baseline_n", "baseline_median", "threshold",
                    status.alias("status"), reason.alias("reason"), "history_start", "history_end")


def anomaly_summary(anomalies: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    g = anomalies.groupBy(*by) if by else anomalies
    return g.agg(F.count_if(F.col("status").isin("high", "low")).alias("flagged_days"),
                 F.count_if(F.col("status") == "high").alias("high_days"),
                 F.count_if(F.col("status") == "low").alias("low_days"),
                 F.count_if(F.col("status") == "insufficient").alias("insufficient_days"))


# ---- delivery versus rating -------------------------------------------------------------------------------------

def primary_category(scope: Scope) -> DataFrame:
    """Exactly one category per order: the largest scoped subtotal, ties by category name (one hash aggregate;
    scope items are already clustered by order id, so no extra shuffle)."""
    per = scope.items.groupBy("order_id", "category").agg(F.sum("price_cents").alias("cents"))
    return per.groupBy("order_id").agg(
        F.min_by("category", F.struct((-F.col("cents")).alias("neg"), F.col("category"))).alias("category"))


def delivery_cells(scope: Scope) -> DataFrame:
    """Order counts per (primary category, state, is_late, review_score)."""
    return (scope.orders.join(primary_category(scope), "order_id")
            .groupBy("category", "state", "is_late", "review_score").agg(F.count(F.lit(1)).alias("order_count")))


GROUPS = [(0, "on_time"), (1, "late"), (None, "unknown")]  # (is_late, delivery_group)


def score_group_stats(cells: DataFrame, by: list[str] | tuple = (), groups: DataFrame | None = None) -> DataFrame:
    """From weighted cells: orders, reviewed, missing, mean, exact median (weighted), sample SD, share of
    scores <= 2 and a 5-bin histogram, for on_time / late / unknown (always three rows per group key). ``groups``: the
    keys that must appear even without orders (default: those in ``cells``)."""
    spark = cells.sparkSession
    w, k = F.col("order_count"), F.col("review_score")
    rev = k.isNotNull()
    agg = cells.groupBy(*by, "is_late").agg(
        F.sum(w).alias("orders"),
        F.sum(F.when(rev, w)).alias("n"),
        F.sum(F.when(rev, w * k)).alias("sk"),
        F.sum(F.when(rev, w * k * k)).alias("skk"),
        F.expr("percentile(review_score, 0.5, order_count)").alias("median_score"),
        *[F.sum(F.when(k == s, w)).alias(f"score_{s}") for s in range(1, 6)])
    labels = spark.createDataFrame(GROUPS, "is_late int, delivery_group string")
    keys = (groups if groups is not None else cells.select(*by).distinct()).crossJoin(F.broadcast(labels)) \
        if by else F.broadcast(labels)
    cond = [keys["is_late"].eqNullSafe(agg["is_late"])] + [keys[b] == agg[b] for b in by]
    j = keys.join(agg, cond, "left").select(*[keys[b] for b in by], "delivery_group", *[
        c for c in ("orders", "n", "sk", "skk", "median_score", "score_1", "score_2", "score_3", "score_4",
                    "score_5")])
    n = F.coalesce(F.col("n"), _zero())
    var = (F.col("skk") - F.col("sk") * F.col("sk") / n) / (n - 1)
    return j.select(
        *by, "delivery_group", F.coalesce("orders", _zero()).alias("order_count"), n.alias("reviewed_orders"),
        (F.coalesce("orders", _zero()) - n).alias("missing_reviews"),
        F.when(n > 0, F.col("sk") / n).alias("mean_score"),
        F.when(n > 0, F.col("median_score")).alias("median_score"),
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("score_sd"),
        F.when(n > 0, (F.coalesce("score_1", _zero()) + F.coalesce("score_2", _zero())) / n).alias("low_score_share"),
        *[F.coalesce(f"score_{s}", _zero()).alias(f"score_{s}") for s in range(1, 6)])


def score_strata(cells: DataFrame, dimension: str, min_reviewed: int = STRATA_MIN_REVIEWED,
                 by: list[str] | tuple = ()) -> DataFrame:
    """Group stats per value of ``dimension`` (category or state); the late - on_time gap only when both groups
    have at least ``min_reviewed`` reviews. ``position`` orders by late order count desc, then name."""
    keys = [*by, "name"]
    stats = score_group_stats(cells.withColumnRenamed(dimension, "name"), by=keys)
    piv = stats.groupBy(*keys).agg(
        F.max(F.when(F.col("delivery_group") == "late", F.col("reviewed_orders"))).alias("late_n"),
        F.max(F.when(F.col("delivery_group") == "on_time", F.col("reviewed_orders"))).alias("on_n"),
        F.max(F.when(F.col("delivery_group") == "late", F.col("mean_score"))).alias("late_mean"),
        F.max(F.when(F.col("delivery_group") == "on_time", F.col("mean_score"))).alias("on_mean"),
        F.max(F.when(F.col("delivery_group") == "late", F.col("order_count"))).alias("late_orders"))
    eligible = F.least("late_n", "on_n") >= min_reviewed
    w = Window.partitionBy(*(by or [F.lit(dimension)])).orderBy(F.desc("late_orders"), "name")
    piv = piv.select(*keys, eligible.alias("comparison_eligible"),
                     F.when(eligible, F.col("late_mean") - F.col("on_mean")).alias("score_gap"),
                     (F.row_number().over(w) - 1).alias("position"))
    return stats.join(piv, keys).select(F.lit(dimension).alias("dimension"), "*")


# ---- evidence ---------------------------------------------------------------------------------------------------

def investigation_evidence(headline: DataFrame, contrib: DataFrame, groups: DataFrame, strata: DataFrame,
                           min_reviewed: int = STRATA_MIN_REVIEWED, by: list[str] | tuple = ()) -> DataFrame:
    """Long table (task, label, pointer, value, unit) of the facts behind each investigation task.

    sales-change: when comparable and something changed (revenue, orders or per-day revenue) and either period has
    orders: delta, both per-day revenues and the first non-zero contribution per dimension.
    delivery-review: when late and on-time groups each have >= ``min_reviewed`` reviews: both counts and means and
    the first eligible stratum per dimension."""
    meet = lambda a, b: a.join(b, list(by)) if by else a.crossJoin(b)
    h = headline.filter(F.col("comparable") & (
        (F.col("delta_cents") != 0) | (F.col("current_orders") != F.col("previous_orders"))
        | (F.col("daily_revenue_cents") != F.col("previous_daily_revenue_cents")))
        & ((F.col("current_orders") > 0) | (F.col("previous_orders") > 0)))
    ev = lambda label, pointer, value, unit: F.struct(
        F.lit(label).alias("label"), pointer.alias("pointer"), value.cast("double").alias("value"),
        F.lit(unit).alias("unit"))
    sales_head = h.select(*by, F.lit("sales-change").alias("task"), F.explode(F.array(
        ev("delta_cents", F.lit("/delta_cents"), F.col("delta_cents"), "cents"),
        ev("daily_revenue_cents", F.lit("/daily_revenue_cents"), F.col("daily_revenue_cents"), "cents"),
        ev("previous_daily_revenue_cents", F.lit("/previous_daily_revenue_cents"),
           F.col("previous_daily_revenue_cents"), "cents"))).alias("e")).select(*by, "task", "e.*")
    first_nz = (contrib.filter(F.col("delta_cents") != 0).groupBy(*by, "dimension")
                .agg(F.min_by(F.struct("position", "name", "delta_cents"), F.col("position")).alias("r"))
                .select(*by, "dimension", "r.*"))
    sales_dims = meet(first_nz, h.select(*by, F.lit(1).alias("_x"))).select(
        *by, F.lit("sales-change").alias("task"), F.concat(F.col("dimension"), F.lit(" "), F.col("name").cast("string"),
                                                       F.lit(" delta_cents")).alias("label"),
        F.concat(F.lit("/contributions/"), F.col("dimension"), F.lit("/"), F.col("position").cast("string"),
                 F.lit("/delta_cents")).alias("pointer"),
        F.col("delta_cents").cast("double").alias("value"), F.lit("cents").alias("unit"))
    g = groups.groupBy(*by).agg(
        F.max(F.when(F.col("delivery_group") == "late", F.col("reviewed_orders"))).alias("late_n"),
        F.max(F.when(F.col("delivery_group") == "on_time", F.col("reviewed_orders"))).alias("on_n"),
        F.max(F.when(F.col("delivery_group") == "late", F.col("mean_score"))).alias("late_mean"),
        F.max(F.when(F.col("delivery_group") == "on_time", F.col("mean_score"))).alias("on_mean"))
    g = g.filter(F.least("late_n", "on_n") >= min_reviewed)
    delivery_head = g.select(*by, F.lit("delivery-review").alias("task"), F.explode(F.array(
        ev("late reviewed_orders", F.lit("/delivery/groups/late/reviewed_orders"), F.col("late_n"), "orders"),
        ev("on_time reviewed_orders", F.lit("/delivery/groups/on_time/reviewed_orders"), F.col("on_n"), "orders"),
        ev("late mean_score", F.lit("/delivery/groups/late/mean_score"), F.col("late_mean"), "score"),
        ev("on_time mean_score", F.lit("/delivery/groups/on_time/mean_score"), F.col("on_mean"), "score")))
        .alias("e")).select(*by, "task", "e.*")
    first_ok = (strata.filter("comparison_eligible").select(*by, "dimension", "name", "position", "score_gap").distinct()
                .groupBy(*by, "dimension").agg(F.min_by(F.struct("position", "name", "score_gap"), F.col("position"))
                                          .alias("r")).select(*by, "dimension", "r.*"))
    delivery_dims = meet(first_ok, g.select(*by, F.lit(1).alias("_x"))).select(
        *by, F.lit("delivery-review").alias("task"),
        F.concat(F.col("dimension"), F.lit(" "), F.col("name").cast("string"), F.lit(" score_gap")).alias("label"),
        F.concat(F.lit("/delivery/strata/"), F.col("dimension"), F.lit("/"), F.col("position").cast("string"),
                 F.lit("/score_gap")).alias("pointer"),
        F.col("score_gap").cast("double").alias("value"), F.lit("score").alias("unit"))
    return sales_head.unionByName(sales_dims).unionByName(delivery_head).unionByName(delivery_dims)
