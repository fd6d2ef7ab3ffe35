"""Comparison of every bucket of a calendar with its own comparison window, all buckets in one aggregate.

A bucket's window is the bucket cut to the scope's range; its comparison window follows the rule of a request: a full
calendar month compares with the month before, anything else with the days of equal number before it. Comparison windows end
where their buckets begin, so a purchase day has at most two roles: a day of its own bucket and a day of a later bucket's
comparison window. Rows meet the calendar of roles by an equi join on the day; a row is copied at most twice.
"""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import ScopeParams
from .diagnosis import HEADLINE_MEASURES, headline_columns
from .scope import build_scope, period_calendar


def bucket_windows(spark, params: ScopeParams, grain: str, coverage_row: DataFrame) -> DataFrame:
    """Per bucket: period, start and end of its window, its comparison window and label, ``complete``, ``comparable``."""
    start = F.greatest("period", F.lit(params.start))
    end = F.least("period_end", F.lit(params.end))
    full_month = (F.dayofmonth("start") == 1) & (F.col("end") == F.last_day("start"))
    before = F.date_sub("start", 1)
    calendar = period_calendar(spark, params.start, params.end, grain, coverage_row).select(
        "period", "complete", start.alias("start"), end.alias("end"))
    windows = calendar.select(
        "*", F.when(full_month, F.trunc(before, "month")).otherwise(F.date_sub(before, F.datediff("end", "start"))).alias("prev_start"),
        before.alias("prev_end"),
        F.when(full_month, "previous_calendar_month").otherwise("previous_equal_period").alias("comparison_label"))
    comparable = (F.col("cov_start").isNotNull() & (F.col("cov_start") <= F.col("prev_start")) & (F.col("end") <= F.col("cov_end")))
    return windows.crossJoin(F.broadcast(coverage_row)).select(
        *windows.columns, F.coalesce(comparable, F.lit(False)).alias("comparable"))


def day_roles(windows: DataFrame) -> DataFrame:
    """(day, period, role): the calendar of both roles; as many rows as the range and its comparison windows have days."""
    days = lambda role, a, b: windows.select(
        "period", F.lit(role).alias("role"), F.explode(F.sequence(F.col(a), F.col(b))).alias("purchase_date"))
    return days("current", "start", "end").unionByName(days("previous", "prev_start", "prev_end"))


def _wide(params: ScopeParams, grain: str) -> ScopeParams:
    """The scope from the first day that a comparison window can reach: one bucket's length, or the whole month, before."""
    reach = params.start - timedelta(days=min(params.days, {"day": 1, "week": 7, "month": 31}[grain]))
    month_before = (params.start.replace(day=1) - timedelta(days=1)).replace(day=1)
    return params.with_dates(min(reach, month_before) if grain == "month" else reach, params.end)


def _money(role: str, column: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("role") == role, F.col(column))), F.lit(0).cast("bigint"))


def comparison_by_bucket(star: dict[str, DataFrame], params: ScopeParams, grain: str, coverage_row: DataFrame) -> DataFrame:
    """The report headline of every bucket: orders, revenue, items, customers and order value of both windows, change, rate
    and the exact volume/value split. Buckets without orders keep their row."""
    scope = build_scope(star, _wide(params, grain))
    windows = bucket_windows(scope.orders.sparkSession, params, grain, coverage_row)
    rows = scope.orders.select("purchase_date", "customer_unique_id", "scoped_revenue_cents", "scoped_item_count").join(
        F.broadcast(day_roles(windows)), "purchase_date")
    # customers first: one row a (bucket, role, customer), then plain sums; no distinct count over order rows
    people = rows.groupBy("period", "role", "customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("scoped_revenue_cents").alias("revenue_cents"),
        F.sum("scoped_item_count").cast("bigint").alias("items"), F.lit(1).cast("bigint").alias("customers"))
    sums = people.groupBy("period").agg(*[_money(role, m).alias(f"{role}_{m}") for role in ("current", "previous") for m in HEADLINE_MEASURES])
    measures = [f"{role}_{m}" for role in ("current", "previous") for m in HEADLINE_MEASURES]
    days = F.datediff("end", "start") + 1
    wide = windows.join(sums, "period", "left").select(
        "period", "complete", "start", "end", "prev_start", "prev_end", "comparable", "comparison_label", days.alias("days"),
        (F.datediff("prev_end", "prev_start") + 1).alias("previous_days"),
        ((F.dayofweek("start") == 2) & (days == 7)).alias("is_calendar_week"),
        *[F.coalesce(m, F.lit(0).cast("bigint")).alias(m) for m in measures])
    return headline_columns(wide, ["period", "start", "end", "prev_start", "prev_end", "complete"])


def contributions_by_bucket(star: dict[str, DataFrame], params: ScopeParams, grain: str, coverage_row: DataFrame,
                            dimension: str) -> DataFrame:
    """Contributions of every comparable bucket per category (item money) or customer state (order money)."""
    if dimension not in ("category", "state"):
        raise ValueError("dimension must be category or state")
    scope = build_scope(star, _wide(params, grain))
    source, money = (scope.items, "price_cents") if dimension == "category" else (scope.orders, "scoped_revenue_cents")
    windows = bucket_windows(source.sparkSession, params, grain, coverage_row).filter("comparable")
    # a day's sums first, so that only (day, name) rows are given their two roles
    daily = source.groupBy("purchase_date", F.col(dimension).alias("name")).agg(F.sum(money).alias("cents"))
    rows = daily.join(F.broadcast(day_roles(windows)), "purchase_date").groupBy("period", "name").agg(
        _money("current", "cents").alias("current_cents"), _money("previous", "cents").alias("previous_cents"))
    delta = F.col("current_cents") - F.col("previous_cents")
    place = F.row_number().over(Window.partitionBy("period").orderBy(F.desc(F.abs(delta)), "name")) - 1
    return rows.select("period", F.lit(dimension).alias("dimension"), "name", "current_cents", "previous_cents",
                       delta.alias("delta_cents"), place.alias("position"))
