"""Buckets against their comparison windows on the hand-counted warehouse; pages of the order list at any depth."""
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from retailq.operators import buckets, dashboard
from retailq.operators.scope import Scope, build_scope
from retailq.params import ScopeParams

from .fixtures import warehouse_star


def coverage(spark, start=date(2017, 1, 1), end=date(2018, 7, 31)):
    return spark.createDataFrame([(start, end)], "cov_start date, cov_end date")


def test_month_buckets(spark):
    star = warehouse_star(spark)
    rows = {r.period: r for r in buckets.comparison_by_bucket(star, ScopeParams("2018-05-01", "2018-08-31"), "month", coverage(spark)).collect()}
    assert sorted(rows) == [date(2018, m, 1) for m in (5, 6, 7, 8)]
    july = rows[date(2018, 7, 1)]
    assert (july.current_orders, july.current_revenue_cents, july.current_items, july.current_customers) == (3, 45001, 5, 2)
    assert (july.previous_orders, july.previous_revenue_cents, july.delta_cents, july.comparable, july.complete) == (1, 10000, 35001, True, True)
    assert july.order_effect_cents + july.aov_effect_cents == pytest.approx(35001)
    assert (july.prev_start, july.prev_end, july.comparison_label) == (date(2018, 6, 1), date(2018, 6, 30), "previous_calendar_month")
    june = rows[date(2018, 6, 1)]
    assert (june.current_revenue_cents, june.previous_revenue_cents, june.revenue_change_rate) == (10000, 0, None)
    august = rows[date(2018, 8, 1)]  # outside the coverage: no comparison, but its own orders
    assert (august.current_revenue_cents, august.previous_revenue_cents, august.comparable, august.complete) == (3000, None, False, False)


def test_cut_buckets_compare_with_days_of_equal_number(spark):
    star = warehouse_star(spark)
    rows = buckets.comparison_by_bucket(star, ScopeParams("2018-07-02", "2018-08-03"), "week", coverage(spark)).orderBy("period").collect()
    first, last = rows[0], rows[-1]
    assert (first.period, first.start, first.prev_start, first.prev_end) == (date(2018, 7, 2), date(2018, 7, 2), date(2018, 6, 25), date(2018, 7, 1))
    assert (first.current_orders, first.previous_orders, first.previous_revenue_cents) == (1, 2, 25001)
    assert (last.start, last.end, last.prev_start, last.prev_end) == (date(2018, 7, 30), date(2018, 8, 3), date(2018, 7, 25), date(2018, 7, 29))
    cut = buckets.comparison_by_bucket(star, ScopeParams("2018-02-01", "2018-03-01"), "month", coverage(spark)).orderBy("period").collect()
    assert [(r.prev_start, r.prev_end) for r in cut] == [(date(2018, 1, 1), date(2018, 1, 31)), (date(2018, 2, 28), date(2018, 2, 28))]


def test_every_day_against_brute_force(spark):
    star = warehouse_star(spark)
    params = ScopeParams("2018-06-28", "2018-07-31")
    scope = build_scope(star, params.with_dates(date(2018, 5, 1), params.end)).orders.collect()
    for grain in ("day", "week", "month"):
        for r in buckets.comparison_by_bucket(star, params, grain, coverage(spark)).collect():
            window = params.with_dates(r.start, r.end)
            for a, z, orders, revenue in ((r.start, r.end, r.current_orders, r.current_revenue_cents),
                                          (*window.comparison()[:2], r.previous_orders, r.previous_revenue_cents)):
                inside = [o for o in scope if a <= o.purchase_date <= z]
                assert (orders, revenue) == (len(inside), sum(o.scoped_revenue_cents for o in inside))


def test_contributions_of_buckets_sum_to_the_change(spark):
    star, params = warehouse_star(spark), ScopeParams("2018-06-01", "2018-07-31")
    heads = {r.period: r.delta_cents for r in buckets.comparison_by_bucket(star, params, "month", coverage(spark)).collect()}
    for dimension in ("category", "state"):
        rows = buckets.contributions_by_bucket(star, params, "month", coverage(spark), dimension).collect()
        assert {p: sum(r.delta_cents for r in rows if r.period == p) for p in heads} == heads
        assert all(sorted(r.position for r in rows if r.period == p) == list(range(sum(r.period == p for r in rows))) for p in heads)
    assert {(r.name, r.current_cents, r.previous_cents) for r in buckets.contributions_by_bucket(
        star, params, "month", coverage(spark), "category").filter(F.col("period") == date(2018, 7, 1)).collect()} == {
        ("cat_a", 34001, 10000), ("cat_b", 11000, 0)}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_pages_at_any_depth(spark, monkeypatch, kind):
    monkeypatch.setattr(dashboard, "LEAF_ROWS", 7)
    first = date(2018, 1, 1)
    rows = [(i * 37 % 1009 - 400, first + timedelta(days=0 if i % 3 else i % 5)) for i in range(600)]  # one day holds most rows
    frame = spark.createDataFrame(rows, "order_id bigint, purchase_date date").select(
        F.col("order_id").cast(kind).alias("order_id"), "purchase_date", F.lit("SP").alias("state"), F.lit(1).alias("scoped_item_count"),
        F.lit(5).alias("scoped_revenue_cents"), F.lit(5).alias("payment_cents"), F.lit(3).alias("review_score"), F.lit(0).alias("is_late"),
        F.array(F.lit("x")).alias("quality_flags")).repartition(5).cache()
    scope = Scope(ScopeParams("2018-01-01", "2018-01-31"), frame, frame)
    ids = [(str(i) if kind == "string" else i, d) for i, d in rows]
    want = sorted(sorted(ids), key=lambda r: r[1], reverse=True)
    for page, size in ((1, 10), (2, 10), (31, 13), (60, 10), (600, 1), (5, 150)):
        got = dashboard.order_list(scope, page, size).collect()
        assert [(r.order_id, r.purchase_date) for r in got] == want[(page - 1) * size:page * size]
        assert all(r.total == 600 for r in got)
    assert dashboard.order_list(scope, 61, 10).collect() == []
    plan = dashboard.order_list(scope, 60, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and "offset" not in plan.lower()


def test_empty_request_answers_every_section(spark):
    from retailq.plans.analyses import dashboard as request
    star, cov = warehouse_star(spark), coverage(spark)
    got = request(star, ScopeParams("2018-07-01", "2018-07-31", state="XX"), cov)
    assert (got["kpis"][0].order_count, got["kpis"][0].revenue_cents, got["kpis"][0].average_order_value_cents) == (0, 0, None)
    assert got["previous"][0].order_count == 0 and len(got["trend"]) == 31 and all(r.revenue_cents == 0 for r in got["trend"])
    assert [len(got[s]) for s in ("categories", "regions", "products", "low_volume_products")] == [0, 0, 0, 0]
    assert got["fulfilment"][0].eligible_orders == 0 and len(got["fulfilment_groups"]) == 3 and [r.order_count for r in got["scores"]] == [0] * 5
    full = request(star, ScopeParams("2018-07-01", "2018-07-31"), cov)
    assert full.keys() == got.keys() and full["kpis"][0].revenue_cents == 45001
