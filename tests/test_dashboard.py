"""Dashboard goldens on the hand-countable warehouse fixture."""
from datetime import date

import pytest

from retailq.operators import dashboard as dash
from retailq.operators.scope import build_scope, coverage_from_observed
from retailq.params import ScopeParams

from .fixtures import OBSERVED, warehouse_star

JULY = ScopeParams(date(2018, 7, 1), date(2018, 7, 31))


@pytest.fixture(scope="module")
def star(spark):
    return warehouse_star(spark)


@pytest.fixture(scope="module")
def cov(spark):
    return coverage_from_observed(spark, *OBSERVED)


def test_kpis(star):
    r = dash.kpis(build_scope(star, JULY)).collect()[0]
    assert (r.revenue_cents, r.order_count, r.item_count, r.customer_count) == (45001, 3, 5, 2)
    assert r.average_order_value_cents == pytest.approx(45001 / 3)


def test_previous_month_and_change(star, cov):
    rows = {r.period: r for r in dash.kpi_comparison(star, JULY, cov).collect()}
    assert rows["previous"].revenue_cents == 10000 and rows["previous"].comparable
    rate = dash.kpi_change_rate(dash.kpi_comparison(star, JULY, cov)).collect()[0]
    assert rate.revenue_cents_change_rate == pytest.approx((45001 - 10000) / 10000)


def test_equal_length_comparison(star, cov):
    p = ScopeParams(date(2018, 7, 2), date(2018, 7, 3))
    rows = {r.period: r for r in dash.kpi_comparison(star, p, cov).collect()}
    assert (rows["previous"].start, rows["previous"].end) == (date(2018, 6, 30), date(2018, 7, 1))
    assert rows["previous"].revenue_cents == 25001


def test_category_filter_keeps_whole_order_fulfilment(star):
    cats = {r.name: r for r in dash.rank_categories(build_scope(star, JULY)).collect()}
    assert (cats["cat_a"].revenue_cents, cats["cat_a"].order_count, cats["cat_a"].item_count) == (34001, 3, 3)
    assert cats["cat_a"].label == "Category A" and cats["cat_b"].label == "cat_b"
    sc = build_scope(star, ScopeParams(date(2018, 7, 1), date(2018, 7, 31), category="cat_b", state="RJ"))
    k = dash.kpis(sc).collect()[0]
    assert (k.revenue_cents, k.order_count) == (6000, 1)
    assert dash.fulfilment_summary(sc).collect()[0].late_rate == 1.0


def test_category_and_region_money_add_up(star):
    sc = build_scope(star, JULY)
    assert sum(r.revenue_cents for r in dash.rank_categories(sc).collect()) == 45001
    assert sum(r.revenue_cents for r in dash.rank_regions(sc).collect()) == 45001


def test_missing_is_not_zero(star):
    f = dash.fulfilment_summary(build_scope(star, JULY)).collect()[0]
    assert f.late_rate == 0.5 and f.eligible_orders == 2
    assert f.average_delivery_days == pytest.approx(1.5) and f.median_delivery_days == pytest.approx(1.5)
    assert f.average_review_score == pytest.approx(3.5) and f.reviewed_orders == 2
    groups = {r.label: r for r in dash.fulfilment_groups(build_scope(star, JULY)).collect()}
    assert set(groups) == {"on_time", "late", "unknown"}
    assert groups["unknown"].order_count == 1 and groups["unknown"].average_review_score is None
    scores = {r.score: r.order_count for r in dash.score_histogram(build_scope(star, JULY)).collect()}
    assert scores == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1}


def test_empty_scope_ratios_are_null(star):
    sc = build_scope(star, ScopeParams(date(2018, 7, 1), date(2018, 7, 31), state="XX"))
    k = dash.kpis(sc).collect()[0]
    assert (k.order_count, k.revenue_cents, k.average_order_value_cents) == (0, 0, None)
    assert dash.fulfilment_summary(sc).collect()[0].late_rate is None
    sc = build_scope(star, ScopeParams(date(2018, 7, 1), date(2018, 7, 31), category="x' OR 1=1--"))
    assert dash.kpis(sc).collect()[0].order_count == 0


def test_weekly_buckets(star, cov):
    rows = dash.trend(build_scope(star, JULY), "week", cov).orderBy("period").collect()
    assert rows[0].period == date(2018, 6, 25) and not rows[0].complete
    assert rows[1].period == date(2018, 7, 2) and rows[1].complete
    assert not rows[-1].complete


def test_monthly_trend_coverage(star, cov):
    p = ScopeParams(date(2016, 11, 1), date(2018, 8, 31))
    rows = {r.period: r for r in dash.trend(build_scope(star, p), "month", cov).collect()}
    assert rows[date(2016, 11, 1)].revenue_cents is None
    assert rows[date(2018, 8, 1)].revenue_cents == 3000 and not rows[date(2018, 8, 1)].complete
    assert rows[date(2018, 5, 1)].revenue_cents == 0  # inside coverage, no orders: an observed zero


def test_order_list_and_detail(star):
    rows = dash.order_list(build_scope(star, JULY), 1, 20).collect()
    assert [r.order_id for r in rows] == ["o2", "o3", "o1"] and rows[0].total == 3
    detail = dash.order_documents(build_scope(star, ScopeParams(date(1900, 1, 1), date(2099, 12, 31),
                                                                  category="cat_a")),
                                  star["fact_order"].sparkSession.createDataFrame([("o1",)], "order_id string"))
    rows = detail.collect()
    assert [(r.revenue_cents, r.total_order_revenue_cents) for r in rows] == [(10001, 15001)]
    assert [r.product_id for r in rows] == ["a"]
