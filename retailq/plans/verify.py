"""Independent recomputation checks: the same answers computed from the landing text by a second formulation
(no star schema, no shared scope code), compared with exceptAll in both directions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.parse import money_cents, strict_timestamp
from ..operators import dashboard as dash
from ..operators.scope import build_scope
from ..params import ScopeParams
from .publish import verify_equal


def kpis_from_raw(L: dict[str, DataFrame], params: ScopeParams) -> DataFrame:
    """KPIs straight from landing text: parse, filter, fold items per order, then aggregate."""
    o = L["orders"].select("order_id", "customer_id", "order_status",
                           strict_timestamp(F.col("order_purchase_timestamp")).alias("ts"))
    o = o.filter((F.col("order_status") == "delivered") & (F.to_date("ts") >= F.lit(params.start))
                 & (F.to_date("ts") <= F.lit(params.end)))
    c = L["customers"].select("customer_id", "customer_unique_id",
                              F.when(F.col("customer_state") == "", "unknown").otherwise(F.col("customer_state"))
                              .alias("state"))
    if params.state:
        c = c.filter(F.col("state") == params.state)
    p = L["products"].select("product_id", F.when(F.col("product_category_name") == "", "unknown")
                             .otherwise(F.col("product_category_name")).alias("category"))
    if params.category:
        p = p.filter(F.col("category") == params.category)
    i = L["items"].select("order_id", "product_id", money_cents(F.col("price")).alias("cents")).join(p, "product_id")
    per_order = i.groupBy("order_id").agg(F.sum("cents").alias("rev"), F.count(F.lit(1)).alias("n"))
    j = o.join(c, "customer_id").join(per_order, "order_id")
    out = j.agg(F.count(F.lit(1)).alias("order_count"), F.coalesce(F.sum("rev"), F.lit(0).cast("bigint"))
                .alias("revenue_cents"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("item_count"),
                F.countDistinct("customer_unique_id").alias("customer_count"))
    return out.withColumn("average_order_value_cents",
                          F.try_divide(F.col("revenue_cents").cast("double"), F.col("order_count")))


def verify_kpis_from_raw(L: dict[str, DataFrame], star: dict[str, DataFrame],
                         scopes: dict[str, ScopeParams]) -> DataFrame:
    """Difference rows between the warehouse KPIs and the raw recomputation, for every scope (empty = pass)."""
    diffs = None
    for name, params in scopes.items():
        d = verify_equal(dash.kpis(build_scope(star, params)), kpis_from_raw(L, params)) \
            .withColumn("scope", F.lit(name))
        diffs = d if diffs is None else diffs.unionByName(d)
    return diffs


# ---- second formulations of the other sections (landing text only; window ranking instead of max_by, etc.) -------

def _raw_orders(L: dict[str, DataFrame]) -> DataFrame:
    ts = lambda c: strict_timestamp(F.col(c))
    o = L["orders"].select("order_id", "customer_id", "order_status", ts("order_purchase_timestamp").alias("ts"),
                           ts("order_delivered_customer_date").alias("dts"),
                           ts("order_estimated_delivery_date").alias("ets"))
    c = L["customers"].select("customer_id", "customer_unique_id",
                              F.when(F.col("customer_state") == "", "unknown").otherwise(F.col("customer_state"))
                              .alias("state"))
    return o.join(c, "customer_id").withColumn("day", F.to_date("ts"))


def _raw_item_totals(L: dict[str, DataFrame], category: str = "") -> DataFrame:
    p = L["products"].select("product_id", F.when(F.col("product_category_name") == "", "unknown")
                             .otherwise(F.col("product_category_name")).alias("category"))
    if category:
        p = p.filter(F.col("category") == category)
    i = L["items"].select("order_id", "product_id", money_cents(F.col("price")).alias("cents")).join(p, "product_id")
    return i.groupBy("order_id").agg(F.sum("cents").alias("rev"), F.count(F.lit(1)).alias("n"))


def _raw_scope(L, params: ScopeParams, start=None) -> DataFrame:
    o = _raw_orders(L).filter((F.col("order_status") == "delivered")
                              & F.col("day").between(F.lit(start or params.start), F.lit(params.end)))
    if params.state:
        o = o.filter(F.col("state") == params.state)
    return o.join(_raw_item_totals(L, params.category), "order_id")


def _latest_score(L) -> DataFrame:
    r = L["reviews"].select("order_id", F.col("review_score").cast("int").alias("score"), "review_id",
                            strict_timestamp(F.col("review_creation_date")).alias("c"),
                            strict_timestamp(F.col("review_answer_timestamp")).alias("a"))
    w = Window.partitionBy("order_id").orderBy(F.desc_nulls_last("a"), F.desc_nulls_last("c"),
                                               F.desc("review_id"), F.desc("score"))
    return r.withColumn("rk", F.row_number().over(w)).filter("rk = 1").select("order_id", "score")


def trend_from_raw(L, params: ScopeParams, grain: str) -> DataFrame:
    s = _raw_scope(L, params)
    period = {"day": F.col("day"), "week": F.expr("date_sub(day, (dayofweek(day) + 5) % 7)"),  # back to Monday
              "month": F.trunc("day", "month")}[grain]
    return s.groupBy(period.alias("period")).agg(F.sum("rev").alias("revenue_cents"),
                                                 F.count(F.lit(1)).alias("order_count"))


def fulfilment_from_raw(L, params: ScopeParams) -> DataFrame:
    s = _raw_scope(L, params).join(_latest_score(L), "order_id", "left")
    ok = F.col("dts").isNotNull() & (F.col("dts") >= F.col("ts"))
    late = F.when(ok & F.col("ets").isNotNull(), (F.to_date("dts") > F.to_date("ets")).cast("int"))
    secs = F.when(ok, F.unix_timestamp("dts") - F.unix_timestamp("ts"))
    s = s.select(late.alias("late"), secs.alias("secs"), "score")
    return s.agg(F.count("late").alias("eligible_orders"), F.count_if(F.col("late") == 1).alias("late_orders"),
                 F.count("secs").alias("delivery_sample_count"),
                 F.round(F.avg("secs") / 86400, 9).alias("average_delivery_days"),
                 F.count("score").alias("reviewed_orders"), F.round(F.avg("score"), 9).alias("average_review_score"))


def customers_from_raw(L, params: ScopeParams) -> DataFrame:
    o = _raw_orders(L)
    first = o.filter((F.col("order_status") == "delivered") & (F.col("day") <= F.lit(params.end))) \
        .groupBy("customer_unique_id").agg(F.min("day").alias("first_day"))
    per = _raw_scope(L, params).groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("f"),
                                                                    F.sum("rev").alias("m"))
    j = per.join(first, "customer_unique_id")
    return j.agg(F.count(F.lit(1)).alias("customer_count"),
                 F.count_if(F.col("first_day") >= F.lit(params.start)).alias("new_customers"),
                 F.count_if(F.col("f") >= 2).alias("repeat_customers"),
                 F.coalesce(F.sum("f"), F.lit(0).cast("bigint")).alias("order_count"),
                 F.coalesce(F.sum("m"), F.lit(0).cast("bigint")).alias("revenue_cents"))


def state_contributions_from_raw(L, params: ScopeParams) -> DataFrame:
    ps, pe, _ = params.comparison()
    s = _raw_scope(L, params, start=min(ps, params.start))
    cur = F.col("day").between(F.lit(params.start), F.lit(params.end))
    prv = F.col("day").between(F.lit(ps), F.lit(pe))
    return s.filter(cur | prv).groupBy(F.col("state").alias("name")).agg(
        F.coalesce(F.sum(F.when(cur, F.col("rev"))), F.lit(0).cast("bigint")).alias("current_cents"),
        F.coalesce(F.sum(F.when(prv, F.col("rev"))), F.lit(0).cast("bigint")).alias("previous_cents"))


def headline_from_raw(L, params: ScopeParams) -> DataFrame:
    """Current and comparison orders/revenue and the volume/value split in its textbook form
    (N1-N0)(A1+A0)/2 and (A1-A0)(N1+N0)/2 with A = revenue / orders, rounded to 4 decimals."""
    ps, pe, _ = params.comparison()
    s = _raw_scope(L, params, start=min(ps, params.start))
    cur = F.col("day").between(F.lit(params.start), F.lit(params.end))
    prv = F.col("day").between(F.lit(ps), F.lit(pe))
    z = F.lit(0).cast("bigint")
    a = s.agg(F.count_if(cur).alias("n1"), F.coalesce(F.sum(F.when(cur, F.col("rev"))), z).alias("r1"),
              F.count_if(prv).alias("n0"), F.coalesce(F.sum(F.when(prv, F.col("rev"))), z).alias("r0"))
    a1, a0 = F.col("r1") / F.col("n1"), F.col("r0") / F.col("n0")
    both = (F.col("n1") > 0) & (F.col("n0") > 0)
    return a.select(F.col("n1").alias("current_orders"), F.col("r1").alias("current_revenue_cents"),
                    F.col("n0").alias("previous_orders"), F.col("r0").alias("previous_revenue_cents"),
                    F.round(F.when(both, (F.col("n1") - F.col("n0")) * (a1 + a0) / 2), 4).alias("order_effect_cents"),
                    F.round(F.when(both, (a1 - a0) * (F.col("n1") + F.col("n0")) / 2), 4).alias("aov_effect_cents"))


def delivery_groups_from_raw(L, params: ScopeParams) -> DataFrame:
    """On-time / late / unknown: orders, reviewed orders and mean score (always three rows)."""
    s = _raw_scope(L, params).join(_latest_score(L), "order_id", "left")
    ok = F.col("dts").isNotNull() & (F.col("dts") >= F.col("ts"))
    late = F.when(ok & F.col("ets").isNotNull(), (F.to_date("dts") > F.to_date("ets")).cast("int"))
    g = s.select(late.alias("late"), "score").groupBy("late").agg(
        F.count(F.lit(1)).alias("o"), F.count("score").alias("r"), F.avg("score").alias("m"))
    labels = L["orders"].sparkSession.createDataFrame([(0, "on_time"), (1, "late"), (None, "unknown")],
                                                      "late int, delivery_group string")
    j = F.broadcast(labels).join(g, labels["late"].eqNullSafe(g["late"]), "left")
    z = F.lit(0).cast("bigint")
    return j.select("delivery_group", F.coalesce("o", z).alias("order_count"), F.coalesce("r", z).alias("reviewed_orders"),
                    F.round("m", 9).alias("mean_score"))


def verify_sections_from_raw(L, star, params: ScopeParams, coverage_row: DataFrame) -> DataFrame:
    """(section, difference_rows) for trend buckets (3 grains), fulfilment, customers, state contributions, the
    report headline with its decomposition and the three delivery groups;
    0 everywhere means the warehouse answers equal the second formulation."""
    from ..operators import customers as cu
    from ..operators import diagnosis as dg
    sc = build_scope(star, params)
    checks = {}
    for g in ("day", "week", "month"):
        t = dash.trend(sc, g, coverage_row).filter(F.col("order_count") > 0).select("period", "revenue_cents",
                                                                                  "order_count")
        checks[f"trend_{g}"] = verify_equal(t, trend_from_raw(L, params, g))
    f = dash.fulfilment_summary(sc).select(
        "eligible_orders", "late_orders", "delivery_sample_count",
        F.round("average_delivery_days", 9).alias("average_delivery_days"), "reviewed_orders",
        F.round("average_review_score", 9).alias("average_review_score"))
    checks["fulfilment"] = verify_equal(f, fulfilment_from_raw(L, params))
    cs = cu.customer_summary(cu.customer_window(sc, cu.first_purchase(star, params)), params).select(
        "customer_count", "new_customers", "repeat_customers", "order_count", "revenue_cents")
    checks["customers"] = verify_equal(cs, customers_from_raw(L, params))
    contrib = dg.contributions(star, params, coverage_row, "state").select("name", "current_cents", "previous_cents")
    checks["state_contributions"] = verify_equal(contrib, state_contributions_from_raw(L, params))
    head = dg.report_headline(star, params, coverage_row).select(
        "current_orders", "current_revenue_cents", "previous_orders", "previous_revenue_cents",
        F.round("order_effect_cents", 4).alias("order_effect_cents"),
        F.round("aov_effect_cents", 4).alias("aov_effect_cents"))
    checks["report_headline"] = verify_equal(head, headline_from_raw(L, params))
    groups = dg.score_group_stats(dg.delivery_cells(sc)).select(
        "delivery_group", "order_count", "reviewed_orders", F.round("mean_score", 9).alias("mean_score"))
    checks["delivery_groups"] = verify_equal(groups, delivery_groups_from_raw(L, params))
    out = None
    for name, d in checks.items():
        r = d.agg(F.count(F.lit(1)).alias("difference_rows")).select(F.lit(name).alias("section"), "difference_rows")
        out = r if out is None else out.unionByName(r)
    return out
