"""Customer analysis and report on the loaded raw fixture."""
import os
import tempfile
from datetime import date

import pytest

from retailq.operators import customers as cu
from retailq.operators import diagnosis as dg
from retailq.operators.scope import build_scope, coverage_window
from retailq.params import ScopeParams
from retailq.plans.load import run_load
from retailq.sources.landing import read_landing
from retailq.sources.warehouse_store import read_star

from .fixtures import write_raw

JULY = ScopeParams(date(2018, 7, 1), date(2018, 7, 31))


@pytest.fixture(scope="module")
def star(spark):
    base = tempfile.mkdtemp(prefix="retailq-test-")
    root = os.path.join(base, "wh")
    run_load(spark, read_landing(spark, write_raw(os.path.join(base, "raw"))), root)
    return read_star(spark, root)


def test_customer_summary(star):
    res = cu.customer_analysis(star, build_scope(star, JULY))
    s = res["summary"].collect()[0]
    assert (s.customer_count, s.new_customers, s.returning_customers, s.repeat_customers) == (2, 2, 0, 1)
    assert (s.repeat_rate, s.order_count, s.revenue_cents) == (0.5, 3, 45000)
    dist = {r.metric: r for r in res["distribution"].collect()}
    assert (dist["recency_days"]["min"], dist["recency_days"]["max"]) == (28, 29)
    seg = res["segments"].collect()
    assert len(seg) == 8 and sum(r.customer_count for r in seg) == 2


def test_first_purchase_ignores_filters_and_future(star):
    p = ScopeParams(date(2018, 7, 2), date(2018, 7, 31), state="SP")
    first = {r.customer_unique_id: r.first_day for r in cu.first_purchase(star, p).collect()}
    assert first["person-ab"] == date(2018, 7, 1)
    s = cu.customer_analysis(star, build_scope(star, p))["summary"].collect()[0]
    assert (s.customer_count, s.new_customers, s.returning_customers) == (1, 0, 1)


def test_report_not_comparable(star):
    cov = coverage_window(star["fact_order"])
    h = dg.report_headline(star, JULY, cov).collect()[0]
    assert h.previous_revenue_cents is None and h.order_effect_cents is None and not h.comparable
    assert dg.contributions(star, JULY, cov, "category").count() == 0
    cells = dg.delivery_cells(build_scope(star, JULY))
    groups = dg.score_group_stats(cells).collect()
    assert sum(g.order_count for g in groups) == 3
    daily = dg.daily_series(star, JULY)
    an = dg.anomaly_same_weekday_mad(daily, JULY, cov).collect()
    assert len(an) == 31 and all(r.status == "insufficient" for r in an)
    strata = dg.score_strata(cells, "category").unionByName(dg.score_strata(cells, "state"))
    ev = dg.investigation_evidence(dg.report_headline(star, JULY, cov),
                                   dg.contributions(star, JULY, cov, "category"), dg.score_group_stats(cells), strata)
    assert ev.count() == 0
