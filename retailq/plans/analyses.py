"""Request-level plans: each analysis builds ONE scope (widened to cover its comparison window), persists it, and
derives every section from it. Sections are independent Spark jobs and are submitted concurrently, so a small
request costs about one job's latency instead of the sum of ten."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import customers as cu
from ..operators import dashboard as dash
from ..operators import diagnosis as dg
from ..operators.scope import Scope, build_scope, comparable_flag
from ..params import AnomalyRules, RfmRules, ScopeParams


def collect_all(frames: dict[str, DataFrame], workers: int = 8) -> dict[str, list]:
    """Run several small result jobs at once (Spark schedules concurrent jobs from separate threads)."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(frames)))) as pool:
        futures = {k: pool.submit(df.collect) for k, df in frames.items()}
        return {k: f.result() for k, f in futures.items()}


def literal_row(df: DataFrame) -> DataFrame:
    """Evaluate a one-row lookup (e.g. coverage) once and keep it as a local literal relation."""
    rows = df.collect()  # one row by construction
    return df.sparkSession.createDataFrame(rows, df.schema)


def materialize(scope: Scope) -> int:
    """Fill both cached grains with ONE job (orders reads the cached items), before concurrent readers start; the orders."""
    return scope.orders.count()


def _without_rows(scope: Scope) -> Scope:
    """The same scope as local relations without rows: plans over it fold away, so an empty request runs no scans."""
    empty = lambda df: df.sparkSession.createDataFrame([], df.schema)
    return Scope(scope.params, empty(scope.items), empty(scope.orders))


def _window(scope: Scope, params: ScopeParams) -> Scope:
    cond = F.col("purchase_date").between(F.lit(params.start), F.lit(params.end))
    return Scope(params, scope.items.filter(cond), scope.orders.filter(cond))


def dashboard_sections(star: dict[str, DataFrame], params: ScopeParams, coverage_row: DataFrame,
                       grain: str = "day") -> tuple[dict[str, DataFrame], Scope]:
    """All dashboard sections over one persisted scope that spans the comparison window too."""
    ps, pe, label = params.comparison()
    coverage_row = literal_row(coverage_row)
    wide = build_scope(star, params.with_dates(min(ps, params.start), params.end)).persist()
    read = wide if materialize(wide) else _without_rows(wide)
    cur, prev = _window(read, params), _window(read, params.with_dates(ps, pe))
    current = dash.kpis(cur).withColumn("period", F.lit("current"))
    previous = dash.kpis(prev).withColumn("period", F.lit("previous")) \
        .crossJoin(F.broadcast(comparable_flag(coverage_row, params))).filter("comparable").drop("comparable")
    sections = {
        "kpis": current, "previous": previous, "trend": dash.trend(cur, grain, coverage_row),
        "categories": dash.rank_categories(cur), "regions": dash.rank_regions(cur),
        "products": dash.top_products(cur), "low_volume_products": dash.low_volume_products(cur),
        "fulfilment": dash.fulfilment_summary(cur), "fulfilment_groups": dash.fulfilment_groups(cur),
        "scores": dash.score_histogram(cur),
    }
    return sections, wide


def dashboard(star, params, coverage_row, grain: str = "day", workers: int = 8) -> dict[str, list]:
    sections, wide = dashboard_sections(star, params, coverage_row, grain)
    try:
        return collect_all(sections, workers)
    finally:
        wide.unpersist()


def customer_report(star, params: ScopeParams, rules: RfmRules = RfmRules(), workers: int = 8) -> dict[str, list]:
    window = cu.customer_window(build_scope(star, params), cu.first_purchase(star, params)).persist()
    window.count()
    sections = cu.customer_analysis_from_window(window, params, rules)
    try:
        return collect_all(sections, workers)
    finally:
        window.unpersist()


def diagnostic_report(star, params: ScopeParams, coverage_row: DataFrame, rules: AnomalyRules = AnomalyRules(),
                      workers: int = 8) -> dict[str, list]:
    """Headline, contributions, anomalies, delivery groups/strata and evidence for one window, all read from ONE
    persisted scope tagged current / previous / history (covering the comparison window and the look-back)."""
    coverage_row = literal_row(coverage_row)
    wide = dg.tagged_scope(star, params, lookback_days=7 * rules.weeks).persist()
    materialize(wide)
    current = Scope(params, wide.items.filter(F.col("period") == "current"),
                    wide.orders.filter(F.col("period") == "current"))
    # Small intermediate tables (bounded by days, or by category x state x 3 x 6 cells) are cached, so the
    # sections that share them -- and the evidence built from the sections -- do not re-run their shuffles.
    cells = dg.delivery_cells(current).persist()
    daily = dg.daily_series(star, params, 7 * rules.weeks, scope=wide).persist()
    head = dg.report_headline(star, params, coverage_row, scope=wide).persist()
    contrib = dg.contributions(star, params, coverage_row, "category", scope=wide).unionByName(
        dg.contributions(star, params, coverage_row, "state", scope=wide)).persist()
    anomalies = dg.anomaly_same_weekday_mad(daily, params, coverage_row, rules).persist()
    groups = dg.score_group_stats(cells).persist()
    strata = dg.score_strata(cells, "category").unionByName(dg.score_strata(cells, "state")).persist()
    cached = [cells, daily, head, contrib, anomalies, groups, strata]
    try:
        out = collect_all({"headline": head, "contributions": contrib, "anomalies": anomalies, "groups": groups,
                           "strata": strata}, workers)
        out.update(collect_all({"anomaly_summary": dg.anomaly_summary(anomalies),
                                "evidence": dg.investigation_evidence(head, contrib, groups, strata)}, workers))
        return out
    finally:
        for df in cached:
            df.unpersist()
        wide.unpersist()
