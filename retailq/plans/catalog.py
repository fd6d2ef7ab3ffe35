"""Registered queries over the driver's test tables: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the star schema from the given tables through the adapter, so its work grows with them.
Parameters come from ``TEST_PROFILE`` (whole history unless the feature itself is a window, e.g. a comparison).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dashboard as dash
from ..operators.scope import build_scope, coverage_from_daily, coverage_window, scope_dimension_values
from ..operators.warehouse import build_star
from ..params import ScopeParams
from ..sources.testdata import TEST_PROFILE, raw_model

# Whole generated history (orders 1995-01-01..2001-08-01).
HISTORY = ScopeParams(date(1995, 1, 1), date(2001, 12, 31))
MONTH = ScopeParams(date(1998, 7, 1), date(1998, 7, 31))
FILTERED = ScopeParams(date(1995, 1, 1), date(2001, 12, 31), category="STANDARD", state="NATION_7")


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build_star(raw_model(spark, sf_dir))


def _scope(spark, sf_dir, params=HISTORY):
    return build_scope(star(spark, sf_dir), params)


def _cov(st):
    return coverage_window(st["fact_order"], TEST_PROFILE.coverage)


def q_kpis(spark, sf_dir):
    return dash.kpis(_scope(spark, sf_dir))


def q_kpis_filtered(spark, sf_dir):
    return dash.kpis(_scope(spark, sf_dir, FILTERED))


def q_kpis_by_state(spark, sf_dir):
    return dash.kpis(_scope(spark, sf_dir), by=["state"])


def q_kpi_comparison(spark, sf_dir):
    st = star(spark, sf_dir)
    return dash.kpi_comparison(st, MONTH, _cov(st))


def q_kpi_change_rate(spark, sf_dir):
    st = star(spark, sf_dir)
    return dash.kpi_change_rate(dash.kpi_comparison(st, MONTH, _cov(st)))


def _trend(grain, params=HISTORY, by=()):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return dash.trend(build_scope(st, params), grain, _cov(st), by=by)
    return run


def _on_scope(fn, params=HISTORY, **kw):
    def run(spark, sf_dir):
        return fn(_scope(spark, sf_dir, params), **kw)
    return run


def q_order_detail_items(spark, sf_dir):
    """Order documents flattened to item rows (header fields repeated) for an order-insensitive check."""
    docs = dash.order_documents(_scope(spark, sf_dir))
    return docs.select("order_id", "revenue_cents", "total_order_revenue_cents", "payment_cents", "review_score",
                       "is_late", "item_id", "product_id", "seller_id", "category", "price_cents", "freight_cents")


def q_category_values(spark, sf_dir):
    cats, _ = scope_dimension_values(star(spark, sf_dir))
    return cats


def q_state_values(spark, sf_dir):
    _, states = scope_dimension_values(star(spark, sf_dir))
    return states


def q_order_list(spark, sf_dir):
    return dash.order_list(_scope(spark, sf_dir), page=3, page_size=20) \
        .withColumn("quality_flags", F.array_join("quality_flags", ","))


def q_order_list_deep(spark, sf_dir):
    """A page behind thousands of rows, found from counts."""
    return dash.order_list(_scope(spark, sf_dir), page=400, page_size=10) \
        .withColumn("quality_flags", F.array_join("quality_flags", ","))


def q_order_list_after(spark, sf_dir):
    """Keyset page: the 20 rows after (1998-07-15, order 30000) in purchase day desc, order id order."""
    return dash.order_list_after(_scope(spark, sf_dir), date(1998, 7, 15), 30000, page_size=20) \
        .withColumn("quality_flags", F.array_join("quality_flags", ","))


def q_coverage_window(spark, sf_dir):
    return _cov(star(spark, sf_dir))


def q_coverage_from_daily(spark, sf_dir):
    return coverage_from_daily(star(spark, sf_dir)["agg_day"], TEST_PROFILE.coverage)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "kpis": q_kpis,
    "coverage_window": q_coverage_window,
    "coverage_from_daily": q_coverage_from_daily,
    "order_list_after": q_order_list_after,
    "kpis_filtered": q_kpis_filtered,
    "kpis_by_state": q_kpis_by_state,
    "kpi_comparison": q_kpi_comparison,
    "kpi_change_rate": q_kpi_change_rate,
    "trend_day": _trend("day"),
    "trend_week": _trend("week"),
    "trend_month": _trend("month"),
    "trend_month_by_state": _trend("month", by=("state",)),
    "trend_week_filtered": _trend("week", FILTERED),
    "rank_categories": _on_scope(dash.rank_categories),
    "category_share": _on_scope(dash.category_share),
    "rank_regions": _on_scope(dash.rank_regions),
    "top_products": _on_scope(dash.top_products),
    "low_volume_products": _on_scope(dash.low_volume_products),
    "fulfilment_summary": _on_scope(dash.fulfilment_summary),
    "fulfilment_groups": _on_scope(dash.fulfilment_groups),
    "score_histogram": _on_scope(dash.score_histogram),
    "fulfilment_summary_filtered": _on_scope(dash.fulfilment_summary, FILTERED),
    "order_list": q_order_list,
    "order_list_deep": q_order_list_deep,
    "order_detail_items": q_order_detail_items,
    "category_values": q_category_values,
    "state_values": q_state_values,
}


# ---- warehouse --------------------------------------------------------------------------------------------------
from ..operators import warehouse as wh  # noqa: E402


def _flags_text(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_flags", F.array_join("quality_flags", ","))


def _raw_op(fn, table):
    def run(spark, sf_dir):
        return fn(raw_model(spark, sf_dir)[table])
    return run


def _star_table(name, post=None):
    def run(spark, sf_dir):
        df = star(spark, sf_dir)[name]
        return post(df) if post else df
    return run


def q_load_profile(spark, sf_dir):
    raw = raw_model(spark, sf_dir)
    return wh.load_profile(raw, build_star(raw))


QUERIES.update({
    "fold_items_per_order": _raw_op(wh.fold_items_per_order, "items"),
    "fold_payments_per_order": _raw_op(wh.fold_payments_per_order, "payments"),
    "latest_review_per_order": _raw_op(wh.latest_review_per_order, "reviews"),
    "dim_customer": _star_table("dim_customer"),
    "dim_product": _star_table("dim_product"),
    "dim_seller": _star_table("dim_seller"),
    "fact_order": _star_table("fact_order", _flags_text),
    "fact_item": _star_table("fact_item"),
    "agg_day": _star_table("agg_day"),
    "load_profile": q_load_profile,
})


# ---- customers --------------------------------------------------------------------------------------------------
from ..operators import customers as cu  # noqa: E402

CUSTOMER_YEAR = ScopeParams(date(1998, 1, 1), date(1998, 12, 31))
CUSTOMER_YEAR_STATE = ScopeParams(date(1998, 1, 1), date(1998, 12, 31), state="NATION_7")
HISTORY_STATE = ScopeParams(HISTORY.start, HISTORY.end, state="NATION_7")


def _customer(section, params=HISTORY):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return cu.customer_analysis(st, build_scope(st, params), TEST_PROFILE.rfm)[section]
    return run


def q_first_purchase(spark, sf_dir):
    return cu.first_purchase(star(spark, sf_dir), HISTORY)


QUERIES.update({
    "first_purchase": q_first_purchase,
    "customer_window": _customer("window"),
    "customer_summary": _customer("summary", CUSTOMER_YEAR),  # new and returning need a window
    "customer_summary_state": _customer("summary", CUSTOMER_YEAR_STATE),
    "rfm_segments": _customer("segments"),
    "frequency_histogram": _customer("frequency"),
    "rfm_distribution": _customer("distribution"),
    "rfm_distribution_state": _customer("distribution", HISTORY_STATE),
    "customers_beyond_recency": _customer("beyond_recency"),
})


# ---- diagnostic report ------------------------------------------------------------------------------------------
from ..operators import diagnosis as dg  # noqa: E402
from ..sources.testdata import ANOMALY_SCOPE  # noqa: E402

REPORT = ScopeParams(date(1998, 7, 1), date(1998, 7, 31))
REPORT_WEEK = ScopeParams(date(1998, 7, 6), date(1998, 7, 12))
DELIVERY = HISTORY


def _headline(params, by=()):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return dg.report_headline(st, params, _cov(st), by=by)
    return run


def _contrib(dimension, params=REPORT):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return dg.contributions(st, params, _cov(st), dimension)
    return run


def q_top_contributions(spark, sf_dir):
    st = star(spark, sf_dir)
    return dg.top_contributions(dg.contributions(st, REPORT, _cov(st), "state"), 5)


def q_daily_series(spark, sf_dir):
    return dg.daily_series(star(spark, sf_dir), REPORT)


def _anomalies(spark, sf_dir, by=()):
    st = star(spark, sf_dir)
    daily = dg.daily_series(st, ANOMALY_SCOPE, 7 * TEST_PROFILE.anomaly.weeks, by=by)
    return dg.anomaly_same_weekday_mad(daily, ANOMALY_SCOPE, _cov(st), TEST_PROFILE.anomaly, by=by)


def q_anomaly_summary(spark, sf_dir):
    return dg.anomaly_summary(_anomalies(spark, sf_dir))


def q_primary_category(spark, sf_dir):
    return dg.primary_category(_scope(spark, sf_dir, DELIVERY))


def _cells(spark, sf_dir):
    return dg.delivery_cells(_scope(spark, sf_dir, DELIVERY))


def q_score_group_stats(spark, sf_dir):
    return dg.score_group_stats(_cells(spark, sf_dir))


def _strata(dimension):
    def run(spark, sf_dir):
        return dg.score_strata(_cells(spark, sf_dir), dimension)
    return run


def q_investigation_evidence(spark, sf_dir):
    st = star(spark, sf_dir)
    cov = _cov(st)
    headline = dg.report_headline(st, REPORT, cov)
    contrib = dg.contributions(st, REPORT, cov, "category").unionByName(dg.contributions(st, REPORT, cov, "state"))
    cells = dg.delivery_cells(build_scope(st, DELIVERY))
    strata = dg.score_strata(cells, "category").unionByName(dg.score_strata(cells, "state"))
    return dg.investigation_evidence(headline, contrib, dg.score_group_stats(cells), strata)


QUERIES.update({
    "report_headline": _headline(REPORT),
    "report_headline_week": _headline(REPORT_WEEK),
    "report_headline_by_state": _headline(REPORT, by=("state",)),
    "contributions_category": _contrib("category"),
    "contributions_state": _contrib("state"),
    "top_contributions": q_top_contributions,
    "daily_series": q_daily_series,
    "anomaly_same_weekday_mad": _anomalies,
    "anomaly_by_state": lambda spark, sf_dir: _anomalies(spark, sf_dir, by=("state",)),
    "anomaly_summary": q_anomaly_summary,
    "primary_category": q_primary_category,
    "delivery_cells": _cells,
    "score_group_stats": q_score_group_stats,
    "score_strata_category": _strata("category"),
    "score_strata_state": _strata("state"),
    "investigation_evidence": q_investigation_evidence,
})


# ---- every bucket against its comparison window -----------------------------------------------------------------
from ..operators import buckets as bk  # noqa: E402

# Starts and ends inside a week and a month, so that cut buckets compare with days of equal number.
BUCKETS = ScopeParams(date(1996, 2, 14), date(2000, 11, 9))


def _bucket(fn, grain, *args, params=BUCKETS):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return fn(st, params, grain, _cov(st), *args)
    return run


QUERIES.update({
    **{f"comparison_by_bucket_{g}": _bucket(bk.comparison_by_bucket, g, params=HISTORY) for g in ("day", "week", "month")},
    "comparison_by_bucket_cut": _bucket(bk.comparison_by_bucket, "month"),
    "contributions_by_bucket_category": _bucket(bk.contributions_by_bucket, "week", "category"),
    "contributions_by_bucket_state": _bucket(bk.contributions_by_bucket, "month", "state", params=HISTORY),
})


# ---- audit ------------------------------------------------------------------------------------------------------
from ..operators import audit as au  # noqa: E402
from ..operators import checks as ck  # noqa: E402
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..schema import FIELD_NAMES  # noqa: E402
from ..sources.landing import AUDIT_FILES, CORRUPT, read_landing, record_counts, write_landing  # noqa: E402
from ..sources.testdata import landing_model  # noqa: E402

HORIZON = "2001-01-01 00:00:00"  # generated ship dates run to 2001-11


def q_reconcile_load(spark, sf_dir):
    """The eleven post-load checks (star aggregates against the typed raw tables)."""
    typed = raw_model(spark, sf_dir)
    return ck.reconcile(build_star(typed), typed)


def _landing(fn):
    def run(spark, sf_dir):
        return fn(landing_model(spark, sf_dir))
    return run


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


QUERIES.update({
    "profile_columns": _landing(lambda L: _union([au.profile_columns(df, name) for name, df in L.items()])),
    "profile_exact_duplicates": _landing(
        lambda L: _union([au.profile_exact_duplicates(df, name) for name, df in L.items()])),
    "profile_candidate_key": _landing(
        lambda L: _union([au.profile_candidate_key(L[t], t, k) for t, k in au.CANDIDATE_KEYS.items()])),
    "profile_relationship": _landing(
        lambda L: _union([au.profile_relationship(L[c], cc, L[p], pc, n) for n, c, cc, p, pc in au.RELATIONS])),
    "profile_dates": _landing(
        lambda L: _union([au.profile_dates(L[t], t, cols) for t, cols in au.DATE_COLUMNS.items()])),
    "profile_status_counts": _landing(lambda L: au.profile_status_counts(L["orders"])),
    "profile_monthly_crosstab": _landing(lambda L: au.profile_monthly_crosstab(L["orders"])),
    "profile_money": _landing(au.profile_money),
    "profile_numeric_item_price": _landing(
        lambda L: au.describe_numeric(L["items"].select(au.money_cents(F.col("price"), True).alias("v")), "v")),
    "profile_numeric_payment_difference": _landing(
        lambda L: au.describe_numeric(au.payment_differences(L), "difference_cents")),
    "profile_payment_reconciliation": _landing(au.profile_payment_reconciliation),
    "profile_fanout_inflation": _landing(au.profile_fanout_inflation),
    "profile_delivery": _landing(lambda L: au.profile_delivery(L["orders"])),
    "profile_delivery_days": _landing(lambda L: au.describe_numeric(au.delivery_days(L["orders"]), "delivery_days")),
    "profile_chronology": _landing(lambda L: au.profile_chronology(L["orders"], L["reviews"])),
    "profile_child_coverage": _landing(au.profile_child_coverage),
    "profile_repeat": _landing(au.profile_repeat),
    "profile_orders_per_customer": _landing(au.profile_orders_per_customer),
    "profile_multiplicity": _landing(au.profile_multiplicity),
    "profile_missing_by_status": _landing(au.profile_missing_by_status),
    "profile_out_of_horizon": _landing(lambda L: au.profile_out_of_horizon(L["items"], HORIZON)),
    "profile_blank_text": _landing(lambda L: au.profile_blank_text(L["reviews"])),
    "profile_review_ids": _landing(lambda L: au.profile_review_ids(L["reviews"])),
    "profile_categories": _landing(lambda L: au.profile_categories(L["products"])),
    "profile_geo": _landing(lambda L: au.profile_geo(L["geolocation"])),
    "profile_numeric_sanity": _landing(au.profile_numeric_sanity),
    "audit_crosscheck": _landing(au.audit_crosscheck),
    # every landing constraint of the load (keys, references, lengths, domains, timestamps, money, bounded sums)
    "landing_violations": _landing(ck.landing_violations),
    "reconcile_load": q_reconcile_load,
})


# ---- publishing -------------------------------------------------------------------------------------------------
from ..plans import publish as pub  # noqa: E402
from ..sources.work_tables import WorkFolder  # noqa: E402

PRESETS = [("history", date(1995, 1, 1), date(2001, 12, 31), "", ""),
           ("month", date(1998, 7, 1), date(1998, 7, 31), "", ""),
           ("month_category_state", date(1998, 7, 1), date(1998, 7, 31), "STANDARD", "NATION_7"),
           ("month_state", date(1998, 6, 1), date(1998, 6, 30), "", "NATION_3"),
           ("no_state", date(1998, 7, 1), date(1998, 7, 31), "", "XX"),
           ("edge", date(1995, 12, 27), date(1996, 3, 5), "", "")]  # begins before the coverage, cuts weeks and months


def _preset_section(name):
    """One published section of all presets; its work tables lie in the shared folder until its owner removes them."""
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        work = WorkFolder(spark, f"preset-{name}")
        return pub.preset_sections(st, pub.preset_table(spark, PRESETS), work, _cov(st), TEST_PROFILE.rfm, TEST_PROFILE.anomaly, [name])[name]
    return run


def q_cross_view_consistency(spark, sf_dir):
    st = star(spark, sf_dir)
    sc = build_scope(st, CUSTOMER_YEAR)
    totals = {"dashboard": dash.kpis(sc).select("revenue_cents"),
              "customers": cu.customer_summary(cu.customer_window(sc, cu.first_purchase(st, CUSTOMER_YEAR)),
                                               CUSTOMER_YEAR).select("revenue_cents"),
              "categories": dash.rank_categories(sc).agg(F.sum("revenue_cents").alias("revenue_cents")),
              "regions": dash.rank_regions(sc).agg(F.sum("revenue_cents").alias("revenue_cents"))}
    return pub.cross_view_consistency(totals).select("distinct_totals", "consistent", F.inline("views"))


QUERIES.update({
    **{f"preset_{name}": _preset_section(name) for name in pub.SNAPSHOT_SECTIONS},
    "cross_view_consistency": q_cross_view_consistency,
})


# ---- verification -----------------------------------------------------------------------------------------------
from ..plans import verify as vf  # noqa: E402

VERIFY_SCOPES = {"history": HISTORY, "month": MONTH, "filtered": FILTERED,
                 "empty_state": ScopeParams(date(1998, 7, 1), date(1998, 7, 31), state="XX"),
                 "quoted_category": ScopeParams(date(1998, 7, 1), date(1998, 7, 31), category="x' OR 1=1--")}


def q_kpis_from_raw(spark, sf_dir):
    return vf.kpis_from_raw(landing_model(spark, sf_dir), HISTORY)


def q_verify_kpis_from_raw(spark, sf_dir):
    """Per scope the warehouse's order count and the number of differences to the raw recomputation."""
    L, st = landing_model(spark, sf_dir), star(spark, sf_dir)
    diffs = vf.verify_kpis_from_raw(L, st, VERIFY_SCOPES).groupBy("scope").agg(F.count(F.lit(1)).alias("difference_rows"))
    counts = _union([dash.kpis(build_scope(st, p)).select(F.lit(name).alias("scope"), "order_count") for name, p in VERIFY_SCOPES.items()])
    return counts.join(diffs, "scope", "left").fillna(0, ["difference_rows"])


QUERIES.update({
    "kpis_from_raw": q_kpis_from_raw,
    "verify_kpis_from_raw": q_verify_kpis_from_raw,
})


from ..plans import verify_snapshots as vs  # noqa: E402


def _verify_sections(names):
    """Published sections of six scopes against a second formulation from landing text, with the rows that were compared."""
    def run(spark, sf_dir):
        st, work = star(spark, sf_dir), WorkFolder(spark, "verify")
        presets, cov = pub.preset_table(spark, PRESETS), _cov(st)
        published = pub.preset_sections(st, presets, work, cov, TEST_PROFILE.rfm, TEST_PROFILE.anomaly, names)
        raw = vs.RawSections(landing_model(spark, sf_dir), presets, cov, work, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
        return vs.verify_from_raw(published, raw, names)
    return run


def q_verify_snapshots(spark, sf_dir):
    """Every section published, read back, and compared with a fresh recomputation by digests."""
    st, work = star(spark, sf_dir), WorkFolder(spark, "verify-published")
    presets, cov = pub.preset_table(spark, PRESETS), _cov(st)
    pub.publish_snapshots(spark, st, presets, f"{work.path}/published", cov, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
    fresh = pub.preset_sections(st, presets, work, cov, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
    written = vs.read_sections(spark, f"{work.path}/published", {name: df.schema for name, df in fresh.items()})
    return vs.verify_published(written, fresh, presets)


QUERIES.update({
    "verify_dashboard_from_raw": _verify_sections(vs.DASHBOARD),
    "verify_customers_from_raw": _verify_sections(vs.CUSTOMERS),
    "verify_reports_from_raw": _verify_sections(vs.REPORTS),
    "verify_snapshots": q_verify_snapshots,
})


# ---- sample pair ------------------------------------------------------------------------------------------------
from ..sources import sample as smp  # noqa: E402


def q_overview_sample(spark, sf_dir):
    """Overview over the orders/items pair in sample form (status + date text, item price text)."""
    L = landing_model(spark, sf_dir)
    orders = L["orders"].select("order_id", F.col("order_status").alias("status"),
                                F.substring("order_purchase_timestamp", 1, 10).alias("purchased_at"))
    items = L["items"].select("order_id", F.col("order_item_id").alias("item_id"), "price")
    return smp.overview(orders, items)


QUERIES["overview_sample"] = q_overview_sample


def q_field_dictionary(spark, sf_dir):
    from ..schema import field_registry
    L = landing_model(spark, sf_dir)
    profiles = _union([au.profile_columns(df, name) for name, df in L.items()])
    return au.field_dictionary(field_registry(spark), profiles)


QUERIES["field_dictionary"] = q_field_dictionary


def _customers_by_state(section):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        params = CUSTOMER_YEAR if section == "summary" else HISTORY
        window = cu.customer_window(build_scope(st, params), cu.first_purchase(st, params), by=["state"])
        if section == "summary":
            return cu.customer_summary(window, params, by=["state"])
        return cu.rfm_segments(window, TEST_PROFILE.rfm, by=["state"])
    return run


QUERIES.update({
    "customer_summary_by_state": _customers_by_state("summary"),
    "rfm_segments_by_state": _customers_by_state("segments"),
})


def q_verify_sections_from_raw(spark, sf_dir):
    st = star(spark, sf_dir)
    return vf.verify_sections_from_raw(landing_model(spark, sf_dir), st, REPORT, _cov(st))


QUERIES["verify_sections_from_raw"] = q_verify_sections_from_raw


# Columns compared after the round trip: every landing column but those whose text is a floating-point number.
ROUNDTRIP_COLUMNS = {
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"),
    "items": ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
    "payments": ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    "reviews": ("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"),
    "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "products": ("product_id", "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty",
                 "product_length_cm", "product_height_cm", "product_width_cm"),
    "translation": ("product_category_name", "product_category_name_english"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"),
}


def _written_landing(spark, sf_dir, folder):
    """The landing tables as CSV, with review messages that hold line breaks, quotes, commas and a final backslash."""
    landing = landing_model(spark, sf_dir)
    landing["reviews"] = landing["reviews"].withColumn("review_comment_message", F.concat(
        F.lit('line "'), F.col("review_id"), F.lit('", one\n'), F.col("order_id"), F.lit("\\")))
    landing["customers"] = landing["customers"].drop("c_acctbal", "c_mktsegment")
    write_landing(landing, folder, AUDIT_FILES)


def q_landing_roundtrip(spark, sf_dir):
    """Every landing table written, read back and digested: rows, rows of a wrong width, records that the independent counter
    finds, files that end inside quotes, and a sum of hashes that ignores the order."""
    folder = f"{ensure_checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"
    _written_landing(spark, sf_dir, folder)
    back = read_landing(spark, folder, AUDIT_FILES, FIELD_NAMES)
    parts = []
    for name, columns in ROUNDTRIP_COLUMNS.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<null>")) for c in columns])
        digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        counted = record_counts(spark, back.paths[name]).agg(
            F.sum(F.col("records") - 1).alias("counted_records"), F.count_if("unclosed").alias("unclosed_files"))
        parts.append(back[name].select(*columns, CORRUPT).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(CORRUPT).isNotNull()).alias("wrong_width_rows"),
            F.sum(digest).alias("content_sum")).crossJoin(counted).select(F.lit(name).alias("table"), "*"))
    return _union(parts)


QUERIES["landing_roundtrip"] = q_landing_roundtrip


def q_staged_violations(spark, sf_dir):
    """The load's constraints as its staging pass finds them: row rules observed while the text is written, keys from one
    aggregate each; the same table as ``landing_violations``."""
    from .load import stage, staged_violations
    work = WorkFolder(spark, "staged")
    staged, observed = stage(spark, {n: df for n, df in landing_model(spark, sf_dir).items() if n != "geolocation"}, work.path)
    rows = [tuple(r[c] for c in ("constraint", "table", "column", "n", "sample_key")) for r in staged_violations(staged, observed)]
    found = spark.createDataFrame(rows, "constraint string, table string, column string, n bigint, sample_key string")
    return found.unionByName(ck.key_violations(staged))


QUERIES["staged_violations"] = q_staged_violations
