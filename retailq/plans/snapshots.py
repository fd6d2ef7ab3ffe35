"""Every section of the published snapshots for every preset at once.

The facts are read once: order rows of all presets, tagged with preset and period (current / previous / history), and the
item lines that meet them are written as two work tables; order totals, folded categories, customers and the cells of one
GROUPING SETS aggregate are derived from those. Sections read work tables only. With the stored first purchase days and the
daily aggregate (coverage) a snapshot takes four scans of stored tables, whatever the number of presets and sections.

Presets are parameters: their table, their months and their calendars are bounded by their spans, never by the data.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import exact_quantiles
from ..operators import customers as cu
from ..operators import diagnosis as dg
from ..operators.dashboard import FULFILMENT_GROUPS
from ..operators.scope import period_end, period_start
from ..operators.warehouse import customer_first
from ..params import AnomalyRules, RfmRules
from ..sources.work_tables import WorkFolder

DASHBOARD_SECTIONS = ("kpis", "previous", "trend_day", "trend_week", "trend_month", "categories", "regions", "products",
                      "low_volume_products", "fulfilment", "fulfilment_groups", "scores")
CUSTOMER_SECTIONS = ("customers", "frequency", "distribution", "segments", "beyond_recency")
REPORT_SECTIONS = ("report_headline", "contributions", "anomalies", "delivery_groups", "delivery_strata", "investigations")
SECTIONS = DASHBOARD_SECTIONS + CUSTOMER_SECTIONS + REPORT_SECTIONS
TOP_PRODUCTS = 20
MEASURES = ("order_count", "revenue_cents", "item_count", "customer_count")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _count(column: str) -> Column:
    return F.coalesce(F.col(column), _zero()).alias(column)


class Snapshots:
    """Sections of ``star`` for ``presets`` (see ``publish.preset_table``); work tables go to ``work``, the caller's folder."""

    def __init__(self, star: dict[str, DataFrame], presets: DataFrame, coverage_row: DataFrame, work: WorkFolder,
                 rfm: RfmRules = RfmRules(), anomaly: AnomalyRules = AnomalyRules()):
        self.star, self.work, self.rfm, self.anomaly = star, work, rfm, anomaly
        self.spark = presets.sparkSession
        self.coverage = work.store(coverage_row, "coverage")
        comparable = (F.col("cov_start").isNotNull() & (F.col("cov_start") <= F.col("prev_start"))
                      & (F.col("prev_start") <= F.col("start")) & (F.col("end") <= F.col("cov_end")))
        self.presets = work.store(presets.crossJoin(F.broadcast(self.coverage)).select(
            *presets.columns, "cov_start", "cov_end", F.coalesce(comparable, F.lit(False)).alias("comparable")), "presets")
        self.names = F.broadcast(self.presets.select("preset"))

    # ---- the tagged scope ---------------------------------------------------------------------------------------

    @cached_property
    def order_rows(self) -> DataFrame:
        """Delivered orders in any preset's current, comparison or look-back days, once for each such preset."""
        lo = F.least("prev_start", F.date_sub("start", 7 * self.anomaly.weeks))
        months = F.broadcast(self.presets.select(
            "preset", "start", "end", "prev_start", "prev_end", lo.alias("_lo"), F.col("state").alias("_state"),
            F.col("category").alias("_want"),
            F.explode(F.sequence(F.trunc(lo, "month"), F.trunc("end", "month"), F.expr("interval 1 month"))).alias("_month")))
        bounds = self.presets.agg(F.min(lo).alias("lo"), F.max("end").alias("hi")).first()  # one row of parameters
        orders = self._in_range(self.star["fact_order"], bounds).filter(F.col("status") == "delivered")
        orders = orders.withColumn("_month", F.col("purchase_month") if "purchase_month" in orders.columns
                                   else F.trunc("purchase_date", "month"))
        buyers = self.star["dim_customer"].select("customer_id", "customer_unique_id", "state")
        period = (F.when(F.col("purchase_date") >= F.col("start"), "current")
                  .when(F.col("purchase_date").between(F.col("prev_start"), F.col("prev_end")), "previous").otherwise("history"))
        rows = orders.select("order_id", "customer_id", "purchase_date", "is_late", "review_score", "delivery_seconds", "_month") \
            .join(months, "_month").filter(F.col("purchase_date").between(F.col("_lo"), F.col("end"))).join(buyers, "customer_id") \
            .filter((F.col("_state") == "") | (F.col("_state") == F.col("state")))
        return self.work.store(rows.select(
            "preset", period.alias("period"), "_want", "order_id", "customer_unique_id", "state", "purchase_date", "start", "end",
            "is_late", "review_score", "delivery_seconds"), "order_rows")

    def _in_range(self, fact: DataFrame, bounds) -> DataFrame:
        """Folders of the presets' overall range, where the fact is stored by month."""
        if bounds["lo"] is not None and "purchase_month" in fact.columns:
            fact = fact.filter(F.col("purchase_month").between(F.lit(bounds["lo"].replace(day=1)), F.lit(bounds["hi"].replace(day=1))))
        return fact

    @cached_property
    def lines(self) -> DataFrame:
        """Scoped items folded to (preset, order, product)."""
        bounds = self.presets.agg(F.min(F.least("prev_start", F.date_sub("start", 7 * self.anomaly.weeks))).alias("lo"),
                                  F.max("end").alias("hi")).first()
        products = self.star["dim_product"].select("product_id", "category", F.coalesce("category_english", "category").alias("label"))
        items = self._in_range(self.star["fact_item"], bounds).select("order_id", "product_id", "price_cents").join(products, "product_id")
        met = items.join(self.order_rows.select("order_id", "preset", "period", "_want"), "order_id")
        met = met.filter((F.col("_want") == "") | (F.col("_want") == F.col("category")))
        return self.work.store(met.groupBy("preset", "period", "order_id", "product_id", "category", "label").agg(
            F.sum("price_cents").alias("cents"), F.count(F.lit(1)).alias("items")), "lines")

    @cached_property
    def order_categories(self) -> DataFrame:
        return self.work.store(self.lines.groupBy("preset", "period", "order_id", "category", "label").agg(
            F.sum("cents").alias("cents"), F.sum("items").alias("items")), "order_categories")

    @cached_property
    def orders(self) -> DataFrame:
        """Order rows with their scoped totals; orders without a scoped item are out of the scope."""
        totals = self.order_categories.groupBy("preset", "order_id").agg(F.sum("cents").alias("cents"), F.sum("items").alias("items"))
        return self.work.store(self.order_rows.drop("_want").join(totals, ["preset", "order_id"]), "orders")

    @cached_property
    def cells(self) -> DataFrame:
        """One GROUPING SETS aggregate over the orders: ``cell`` names the set of a row."""
        base = ["preset", "period"]
        sets = [base, [*base, "purchase_date"], [*base, "state"], [*base, "is_late", "review_score"]]
        cell = (F.when(F.grouping("purchase_date") == 0, "day").when(F.grouping("state") == 0, "state")
                .when(F.grouping("is_late") == 0, "delivery").otherwise("total"))
        return self.work.store(self.orders.groupingSets(sets, *base, "purchase_date", "state", "is_late", "review_score").agg(
            cell.alias("cell"), F.count(F.lit(1)).alias("order_count"), F.sum("cents").alias("revenue_cents"),
            F.sum("items").alias("item_count"), F.count("delivery_seconds").alias("timed"),
            F.sum("delivery_seconds").alias("seconds")), "cells")

    def _cell(self, name: str) -> DataFrame:
        return self.cells.filter(F.col("cell") == name)

    @cached_property
    def buyers(self) -> DataFrame:
        """Per (preset, period, customer): orders, money and last day; the look-back days count for nobody."""
        return self.work.store(self.orders.filter(F.col("period") != "history").groupBy(
            "preset", "period", "customer_unique_id", "start", "end").agg(
            F.max("purchase_date").alias("last_day"), F.count(F.lit(1)).alias("frequency"), F.sum("cents").alias("monetary_cents")), "buyers")

    @cached_property
    def totals(self) -> DataFrame:
        """Measures of both periods of every preset, zero where nothing was bought."""
        people = self.buyers.groupBy("preset", "period").agg(F.count(F.lit(1)).alias("customer_count"))
        periods = self.spark.createDataFrame([("current",), ("previous",)], "period string")
        found = self._cell("total").select("preset", "period", *MEASURES[:3])
        return self.work.store(self.presets.crossJoin(F.broadcast(periods)).join(found, ["preset", "period"], "left").join(
            people, ["preset", "period"], "left").select("preset", "period", "comparable", *[_count(m) for m in MEASURES]), "totals")

    # ---- dashboard ----------------------------------------------------------------------------------------------

    def _kpis(self, period: str) -> DataFrame:
        rows = self.totals.filter((F.col("period") == period) & (F.col("comparable") | F.lit(period == "current")))
        return rows.select("preset", *MEASURES, F.try_divide(F.col("revenue_cents").cast("double"), F.col("order_count"))
                           .alias("average_order_value_cents"))

    def kpis(self) -> DataFrame:
        return self._kpis("current")

    def previous(self) -> DataFrame:
        """The comparison window's measures; no row where it is not comparable."""
        return self._kpis("previous")

    def _trend(self, grain: str) -> DataFrame:
        """Dense calendar of every preset: zero inside the coverage, NULL outside, ``complete`` for whole covered buckets."""
        step = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}[grain]
        calendar = self.presets.select("preset", "start", "end", "cov_start", "cov_end", F.explode(
            F.sequence(period_start("start", grain), F.col("end"), F.expr(step))).alias("period")) \
            .withColumn("bucket_end", period_end("period", grain))
        complete = ((F.col("period") >= F.greatest("start", "cov_start")) & (F.col("bucket_end") <= F.least("end", "cov_end"))
                    & F.col("cov_start").isNotNull())
        covered = ((F.greatest("period", "start") >= F.col("cov_start")) & (F.least("bucket_end", "end") <= F.col("cov_end")))
        days = self._cell("day").filter(F.col("period") == "current").groupBy(
            "preset", period_start("purchase_date", grain).alias("bucket")).agg(
            F.sum("revenue_cents").alias("revenue"), F.sum("order_count").alias("orders"))
        met = calendar.join(days.withColumnRenamed("bucket", "period"), ["preset", "period"], "left")
        fill = lambda c: F.coalesce(F.col(c), F.when(covered, _zero()))
        return met.select("preset", "period", F.coalesce(complete, F.lit(False)).alias("complete"),
                          fill("revenue").alias("revenue_cents"), fill("orders").alias("order_count"))

    def trend_day(self) -> DataFrame:
        return self._trend("day")

    def trend_week(self) -> DataFrame:
        return self._trend("week")

    def trend_month(self) -> DataFrame:
        return self._trend("month")

    @cached_property
    def category_cells(self) -> DataFrame:
        return self.work.store(self.order_categories.groupBy("preset", "period", "category", "label").agg(
            F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("orders"), F.sum("items").alias("items")), "category_cells")

    def categories(self) -> DataFrame:
        """Revenue, orders and items of every category with its share of the preset's revenue."""
        total = self.totals.filter(F.col("period") == "current").select("preset", F.col("revenue_cents").alias("total"))
        rows = self.category_cells.filter(F.col("period") == "current").join(F.broadcast(total), "preset")
        return rows.select("preset", F.col("category").alias("name"), "label", F.col("cents").alias("revenue_cents"),
                           F.col("orders").alias("order_count"), F.col("items").alias("item_count"),
                           F.when(F.col("total") == 0, 0.0).otherwise(F.col("cents") / F.col("total")).alias("revenue_share"))

    def regions(self) -> DataFrame:
        return self._cell("state").filter(F.col("period") == "current").select(
            "preset", F.col("state").alias("name"), "revenue_cents", "order_count", "item_count")

    @cached_property
    def product_totals(self) -> DataFrame:
        return self.work.store(self.lines.filter(F.col("period") == "current").groupBy("preset", "product_id", "category", "label").agg(
            F.sum("cents").alias("revenue_cents"), F.count(F.lit(1)).alias("order_count"), F.sum("items").alias("item_count")), "products")

    def _ranked(self, *order) -> DataFrame:
        """The first rows of each preset; Spark keeps a task's first rows only before it brings a preset's together."""
        place = F.row_number().over(Window.partitionBy("preset").orderBy(*order, "product_id"))
        return self.product_totals.withColumn("position", place).filter(F.col("position") <= TOP_PRODUCTS)

    def products(self) -> DataFrame:
        return self._ranked(F.desc("revenue_cents"))

    def low_volume_products(self) -> DataFrame:
        return self._ranked("item_count", "revenue_cents")

    def fulfilment(self) -> DataFrame:
        cells = self._cell("delivery").filter(F.col("period") == "current")
        n, score = F.col("order_count"), F.col("review_score")
        sums = cells.groupBy("preset").agg(
            F.sum(F.when(F.col("is_late").isNotNull(), n)).alias("eligible_orders"), F.sum(F.when(F.col("is_late") == 1, n)).alias("late_orders"),
            F.sum("timed").alias("delivery_sample_count"), F.sum("seconds").alias("seconds"),
            F.sum(F.when(score.isNotNull(), n)).alias("reviewed_orders"), F.sum(score * n).alias("points"))
        median = exact_quantiles(self.orders.filter(F.col("period") == "current"), "delivery_seconds", {"middle": (0.5, "linear")}, by=["preset"])
        rows = self.names.join(sums, "preset", "left").join(median, "preset", "left").select(
            "preset", *[_count(c) for c in ("eligible_orders", "late_orders", "delivery_sample_count", "reviewed_orders")], "seconds", "points", "middle")
        return rows.select(
            "preset", "eligible_orders", "late_orders", "delivery_sample_count",
            (F.try_divide(F.col("seconds").cast("double"), F.col("delivery_sample_count")) / 86400).alias("average_delivery_days"),
            (F.col("middle") / 86400).alias("median_delivery_days"), "reviewed_orders",
            F.try_divide(F.col("points").cast("double"), F.col("reviewed_orders")).alias("average_review_score"),
            F.try_divide(F.col("late_orders").cast("double"), F.col("eligible_orders")).alias("late_rate"))

    def fulfilment_groups(self) -> DataFrame:
        labels = self.spark.createDataFrame(FULFILMENT_GROUPS, "is_late int, label string")
        score, n = F.col("review_score"), F.col("order_count")
        found = self._cell("delivery").filter(F.col("period") == "current").groupBy(F.col("preset").alias("p"), F.col("is_late").alias("late")).agg(
            F.sum(n).alias("order_count"), F.sum(F.when(score.isNotNull(), n)).alias("reviewed_orders"), F.sum(score * n).alias("points"))
        keys = self.names.crossJoin(F.broadcast(labels))
        return keys.join(found, (F.col("preset") == F.col("p")) & F.col("is_late").eqNullSafe(F.col("late")), "left").select(
            "preset", "label", _count("order_count"), _count("reviewed_orders"),
            F.try_divide(F.col("points").cast("double"), F.col("reviewed_orders")).alias("average_review_score"))

    def scores(self) -> DataFrame:
        scale = self.spark.range(1, 6).select(F.col("id").cast("int").alias("score"))
        found = self._cell("delivery").filter((F.col("period") == "current") & F.col("review_score").isNotNull()).groupBy(
            "preset", F.col("review_score").alias("score")).agg(F.sum("order_count").alias("order_count"))
        return self.names.crossJoin(F.broadcast(scale)).join(found, ["preset", "score"], "left").select("preset", "score", _count("order_count"))

    # ---- customers ----------------------------------------------------------------------------------------------

    @cached_property
    def window(self) -> DataFrame:
        """Per (preset, customer) of the current period. The first purchase is the customer's first of all: who bought
        inside a preset did so on or before its end, so no preset needs a first day of its own."""
        first = self.star["customer_first"] if "customer_first" in self.star else \
            customer_first(self.star["fact_order"], self.star["dim_customer"])
        return self.work.store(self.buyers.filter(F.col("period") == "current").join(first, "customer_unique_id").select(
            "preset", "start", "customer_unique_id", "first_day", "last_day", "frequency", "monetary_cents",
            F.datediff("end", "last_day").alias("recency_days")), "window")

    def customers(self) -> DataFrame:
        found = cu.customer_summary(self.window, None, by=["preset"], is_new=F.col("first_day") >= F.col("start"))
        rates = ("repeat_rate", "single_purchase_share")
        return self.names.join(found, "preset", "left").select(
            "preset", *[F.col(c) if c in rates else _count(c) for c in found.columns if c != "preset"])

    def frequency(self) -> DataFrame:
        return self.window.groupBy("preset", "frequency").agg(F.count(F.lit(1)).alias("customer_count"))

    def distribution(self) -> DataFrame:
        """Minimum, exact median, nearest-rank 75th percentile and maximum of the three metrics; NULL without customers."""
        long = self.window.select("preset", F.expr("stack(3, " + ", ".join(f"'{m}', cast({m} as bigint)" for m in cu.RFM_METRICS) + ") as (metric, value)"))
        ends = long.groupBy("preset", "metric").agg(F.min("value").alias("min"), F.max("value").alias("max"))
        middle = exact_quantiles(long, "value", {"median": (0.5, "linear"), "p75": (0.75, "nearest")}, by=["preset", "metric"])
        metrics = self.spark.createDataFrame([(m,) for m in cu.RFM_METRICS], "metric string")
        return self.names.crossJoin(F.broadcast(metrics)).join(ends, ["preset", "metric"], "left").join(middle, ["preset", "metric"], "left") \
            .select("preset", "metric", "min", "median", F.col("p75").cast("bigint").alias("p75"), "max")

    def segments(self) -> DataFrame:
        return cu.rfm_segments(self.window, self.rfm, by=["preset"], groups=self.names)

    def beyond_recency(self) -> DataFrame:
        older = F.when(F.col("key").startswith("0"), F.col("customer_count"))
        return self.segments().groupBy("preset").agg(F.coalesce(F.sum(older), _zero()).alias("customers_beyond_recency"))

    # ---- report -------------------------------------------------------------------------------------------------

    def report_headline(self) -> DataFrame:
        names = dict(zip(("order_count", "revenue_cents", "item_count", "customer_count"), dg.HEADLINE_MEASURES))
        wide = self.totals.groupBy("preset").agg(*[
            F.max(F.when(F.col("period") == period, F.col(m))).alias(f"{period}_{name}")
            for period in ("current", "previous") for m, name in names.items()])
        days = F.datediff("end", "start") + 1
        return dg.headline_columns(wide.join(F.broadcast(self.presets.select(
            "preset", "comparable", "comparison_label", days.alias("days"), (F.datediff("prev_end", "prev_start") + 1).alias("previous_days"),
            ((F.dayofweek("start") == 2) & (days == 7)).alias("is_calendar_week"))), "preset"), ["preset"])

    def contributions(self) -> DataFrame:
        """Category and state changes of comparable presets, by size of the change."""
        both = self.category_cells.select("preset", "period", F.lit("category").alias("dimension"), F.col("category").alias("name"), "cents") \
            .unionByName(self._cell("state").select("preset", "period", F.lit("state").alias("dimension"), F.col("state").alias("name"),
                                                    F.col("revenue_cents").alias("cents"))).filter(F.col("period") != "history")
        money = lambda period: F.coalesce(F.sum(F.when(F.col("period") == period, F.col("cents"))), _zero())
        rows = both.groupBy("preset", "dimension", "name").agg(
            money("current").alias("current_cents"), money("previous").alias("previous_cents")).join(
            F.broadcast(self.presets.filter("comparable").select("preset")), "preset")
        delta = F.col("current_cents") - F.col("previous_cents")
        place = F.row_number().over(Window.partitionBy("preset", "dimension").orderBy(F.desc(F.abs(delta)), "name")) - 1
        return rows.select("preset", "dimension", "name", F.col("name").alias("label"), "current_cents", "previous_cents",
                           delta.alias("delta_cents"), place.alias("position"))

    def anomalies(self) -> DataFrame:
        calendar = self.presets.select("preset", F.explode(F.sequence("start", "end")).alias("day"))
        daily = self._cell("day").groupBy("preset", F.col("purchase_date").alias("day")).agg(F.sum("order_count").alias("order_count"))
        return dg.anomalies_on(calendar, daily, self.coverage, self.anomaly, by=["preset"])

    @cached_property
    def delivery_cells(self) -> DataFrame:
        """Order counts per (preset, primary category, state, is_late, review_score) of the current period."""
        primary = self.order_categories.filter(F.col("period") == "current").groupBy("preset", "order_id").agg(
            F.min_by("category", F.struct((-F.col("cents")).alias("less"), F.col("category"))).alias("category"))
        return self.work.store(self.orders.select("preset", "order_id", "state", "is_late", "review_score").join(primary, ["preset", "order_id"]).groupBy(
            "preset", "category", "state", "is_late", "review_score").agg(F.count(F.lit(1)).alias("order_count")), "delivery_cells")

    def delivery_groups(self) -> DataFrame:
        return dg.score_group_stats(self.delivery_cells, by=["preset"], groups=self.names)

    def delivery_strata(self) -> DataFrame:
        return dg.score_strata(self.delivery_cells, "category", by=["preset"]).unionByName(
            dg.score_strata(self.delivery_cells, "state", by=["preset"]))

    def investigations(self) -> DataFrame:
        return dg.investigation_evidence(self.report_headline(), self.contributions(), self.delivery_groups(),
                                         self.delivery_strata(), by=["preset"])

    def sections(self, names=SECTIONS) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in names}
