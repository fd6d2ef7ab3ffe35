"""Independent verification of published snapshot sections.

``verify_from_raw`` computes every section a second time from the landing text, with other means than the operators: ranking
windows instead of max_by, calendars counted day by day, zero rows added by union instead of outer joins, quantiles by
counting below a shrinking interval, the anomaly rule on a sliding frame of eight rows a weekday, the volume/value split in
its textbook form. ``verify_published`` compares what was written with a fresh recomputation, by one digest a section
and preset, and by rows only where digests differ. Both return how many rows were compared, so a check that saw nothing shows.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.parse import money_cents, strict_timestamp
from ..params import STRATA_MIN_REVIEWED, AnomalyRules, RfmRules
from ..sources.work_tables import WorkFolder

DASHBOARD = ("kpis", "previous", "trend_day", "trend_week", "trend_month", "categories", "regions", "fulfilment", "fulfilment_groups", "scores")
CUSTOMERS = ("customers", "frequency", "distribution", "segments")
REPORTS = ("report_headline", "contributions", "anomalies", "delivery_groups", "delivery_strata")
DIGITS = 6
WAYS = 64  # parts of the interval in each step of a quantile search


# ---- quantiles by counts below ----------------------------------------------------------------------------------

def kth_smallest(df: DataFrame, by: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """Per group the whole-numbered values at zero-based ranks (columns over ``n``, the group's rows), one column a name.

    An interval that holds the wanted value starts as [minimum, maximum] and is cut into WAYS parts; one count a part tells
    which part goes on. Rows are only ever counted, and a part's count is summed in every task first.
    """
    ends = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.min(value).cast("bigint").alias("lo"), F.max(value).cast("bigint").alias("hi"), F.count(F.lit(1)).alias("n"))
    targets = ends.select(*by, "lo", "hi", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()])).alias("t")) \
        .select(*by, "lo", "hi", "t.name", "t.rank")
    schema, rows = targets.schema, [r.asDict() for r in targets.collect()]  # a few rows a group; groups are presets and metrics
    spark = df.sparkSession
    while any(r["lo"] < r["hi"] for r in rows):
        now = F.broadcast(spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema))
        part = F.when(F.col(value) < F.col("lo"), -1).otherwise(
            F.expr(f"(cast({value} as bigint) - lo) div ((hi - lo) div {WAYS} + 1)")).cast("bigint")
        counts = df.join(now, by).filter(F.col(value) <= F.col("hi")).groupBy(*by, "name", part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
        found: dict[tuple, dict[int, int]] = {}
        for r in counts.collect():  # at most WAYS + 1 rows a group and name
            found.setdefault(tuple(r[b] for b in by) + (r["name"],), {})[r["part"]] = r["c"]
        for r in rows:
            width, left = (r["hi"] - r["lo"]) // WAYS + 1, r["rank"]
            for p, c in sorted(found[tuple(r[b] for b in by) + (r["name"],)].items()):
                if left < c:
                    r["lo"], r["hi"] = r["lo"] + p * width, min(r["hi"], r["lo"] + (p + 1) * width - 1)
                    break
                left -= c
    values = spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)
    return values.groupBy(*by).agg(*[F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in ranks])


def _middle() -> dict[str, Column]:
    return {"below": F.floor((F.col("n") - 1) / 2), "above": F.ceil((F.col("n") - 1) / 2)}


# ---- sections from the landing text -----------------------------------------------------------------------------

class RawSections:
    """Sections of every preset from landing text; column names and rows as published."""

    def __init__(self, landing: dict[str, DataFrame], presets: DataFrame, coverage_row: DataFrame, work: WorkFolder,
                 rfm: RfmRules = RfmRules(), anomaly: AnomalyRules = AnomalyRules()):
        self.landing, self.work, self.rfm, self.anomaly = landing, work, rfm, anomaly
        self.spark = presets.sparkSession
        cov = coverage_row.first()  # one row
        self.cov_start, self.cov_end = cov["cov_start"], cov["cov_end"]
        self.presets = [r.asDict() for r in presets.collect()]  # parameters
        self.frame = F.broadcast(self.spark.createDataFrame(
            [(p["preset"], p["start"], p["end"], p["prev_start"], p["prev_end"], self._comparable(p)) for p in self.presets],
            "preset string, start date, end date, prev_start date, prev_end date, comparable boolean"))

    def _comparable(self, p: dict) -> bool:
        return self.cov_start is not None and self.cov_start <= p["prev_start"] and p["end"] <= self.cov_end

    def _covered(self, day: Column) -> Column:
        return F.lit(False) if self.cov_start is None else day.between(F.lit(self.cov_start), F.lit(self.cov_end))

    @cached_property
    def orders(self) -> DataFrame:
        """Delivered orders with buyer, state, lateness, duration and latest score, parsed once."""
        ts = lambda c: strict_timestamp(F.col(c))
        unknown = lambda c: F.when(F.col(c) == "", "unknown").otherwise(F.col(c))
        at, done, due = ts("order_purchase_timestamp"), ts("order_delivered_customer_date"), ts("order_estimated_delivery_date")
        ok = done.isNotNull() & (done >= at)
        orders = self.landing["orders"].filter(F.col("order_status") == "delivered").select(
            "order_id", "customer_id", F.to_date(at).alias("day"),
            F.when(ok & due.isNotNull(), (F.to_date(done) > F.to_date(due)).cast("int")).alias("late"),
            F.when(ok, F.unix_timestamp(done) - F.unix_timestamp(at)).alias("secs"))
        buyers = self.landing["customers"].select("customer_id", F.col("customer_unique_id").alias("uid"), unknown("customer_state").alias("state"))
        reviews = self.landing["reviews"].select("order_id", F.col("review_score").cast("int").alias("score"), "review_id",
                                                 ts("review_creation_date").alias("c"), ts("review_answer_timestamp").alias("a"))
        newest = Window.partitionBy("order_id").orderBy(F.desc_nulls_last("a"), F.desc_nulls_last("c"), F.desc("review_id"), F.desc("score"))
        scores = reviews.withColumn("rk", F.row_number().over(newest)).filter("rk = 1").select("order_id", "score")
        return self.work.store(orders.join(buyers, "customer_id").join(scores, "order_id", "left"), "raw_orders")

    @cached_property
    def items(self) -> DataFrame:
        category = self.landing["products"].select("product_id", F.when(F.col("product_category_name") == "", "unknown").otherwise(
            F.col("product_category_name")).alias("category"))
        return self.work.store(self.landing["items"].select("order_id", "product_id", money_cents(F.col("price")).alias("cents")).join(
            category, "product_id").select("order_id", "category", "cents"), "raw_items")

    @cached_property
    def lines(self) -> DataFrame:
        """Items in scope, once for each preset whose days, with its comparison and look-back days, hold their order."""
        parts = []
        for p in self.presets:
            own = self.orders.filter((F.col("day") >= F.least(F.lit(p["prev_start"]), F.date_sub(F.lit(p["start"]), 56)))
                                     & (F.col("day") <= F.lit(p["end"])))
            own = own.filter(F.col("state") == p["state"]) if p["state"] else own
            items = self.items.filter(F.col("category") == p["category"]) if p["category"] else self.items
            parts.append(own.join(items, "order_id").withColumn("preset", F.lit(p["preset"])))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        now = F.when(F.col("day") >= F.col("start"), "current").when(F.col("day") >= F.col("prev_start"), "previous").otherwise("history")
        return self.work.store(out.join(self.frame, "preset").withColumn("period", now), "raw_lines")

    @cached_property
    def scope(self) -> DataFrame:
        return self.work.store(self.lines.groupBy(
            "preset", "period", "comparable", "start", "end", "order_id", "day", "late", "secs", "uid", "state", "score").agg(
            F.sum("cents").alias("rev"), F.count(F.lit(1)).alias("n")), "raw_scope")

    @property
    def current(self) -> DataFrame:
        return self.scope.filter(F.col("period") == "current")

    def _each(self, values: list, name: str, kind: str) -> DataFrame:
        return self.spark.createDataFrame([(p["preset"], v) for p in self.presets for v in values], f"preset string, {name} {kind}")

    # ---- dashboard

    def _measures(self, period: str) -> DataFrame:
        rows = self.scope.filter(F.col("period") == period)
        found = rows.groupBy("preset").agg(F.count(F.lit(1)).alias("o"), F.sum("rev").alias("r"), F.sum("n").alias("i"))
        people = rows.select("preset", "uid").distinct().groupBy("preset").agg(F.count(F.lit(1)).alias("c"))
        fill = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
        return self.frame.join(found, "preset", "left").join(people, "preset", "left").select(
            "preset", "comparable", fill("o").alias("order_count"), fill("r").alias("revenue_cents"), fill("i").alias("item_count"),
            fill("c").alias("customer_count"), (F.col("r") / F.col("o")).alias("average_order_value_cents"))

    def kpis(self) -> DataFrame:
        return self._measures("current").drop("comparable")

    def previous(self) -> DataFrame:
        return self._measures("previous").filter("comparable").drop("comparable")

    def _trend(self, grain: str) -> DataFrame:
        """Buckets found from days, and both flags from counting a bucket's days."""
        begin = {"day": F.col("day"), "week": F.date_sub("day", F.weekday("day")), "month": F.date_sub("day", F.dayofmonth("day") - 1)}[grain]
        last = {"day": F.col("period"), "week": F.date_add("period", 6), "month": F.date_sub(F.add_months("period", 1), 1)}[grain]
        buckets = self.frame.select("preset", "start", "end", F.explode(F.sequence("start", "end")).alias("day")).select(
            "preset", "start", "end", begin.alias("period")).distinct()
        days = buckets.select("*", F.explode(F.sequence(F.col("period"), last)).alias("d"))
        inside, known = F.col("d").between(F.col("start"), F.col("end")), self._covered(F.col("d"))
        flags = days.groupBy("preset", "period").agg(F.every(inside & known).alias("complete"), F.every(~inside | known).alias("covered"))
        sums = self.current.groupBy("preset", begin.alias("period")).agg(F.sum("rev").alias("r"), F.count(F.lit(1)).alias("o"))
        zero = F.when(F.col("covered"), F.lit(0).cast("bigint"))
        return flags.join(sums, ["preset", "period"], "left").select(
            "preset", "period", "complete", F.coalesce("r", zero).alias("revenue_cents"), F.coalesce("o", zero).alias("order_count"))

    def trend_day(self) -> DataFrame:
        return self._trend("day")

    def trend_week(self) -> DataFrame:
        return self._trend("week")

    def trend_month(self) -> DataFrame:
        return self._trend("month")

    def categories(self) -> DataFrame:
        rows = self.lines.filter(F.col("period") == "current")
        per = rows.groupBy("preset", F.col("category").alias("name")).agg(
            F.sum("cents").alias("revenue_cents"), F.countDistinct("order_id").alias("order_count"), F.count(F.lit(1)).alias("item_count"))
        whole = rows.groupBy("preset").agg(F.sum("cents").alias("all_cents"))
        return per.join(whole, "preset").select("preset", "name", "revenue_cents", "order_count", "item_count", F.when(
            F.col("all_cents") == 0, 0.0).otherwise(F.col("revenue_cents") / F.col("all_cents")).alias("revenue_share"))

    def regions(self) -> DataFrame:
        return self.lines.filter(F.col("period") == "current").groupBy("preset", F.col("state").alias("name")).agg(
            F.sum("cents").alias("revenue_cents"), F.countDistinct("order_id").alias("order_count"), F.count(F.lit(1)).alias("item_count"))

    def fulfilment(self) -> DataFrame:
        timed = self.current.filter(F.col("secs").isNotNull())
        middle = kth_smallest(timed, ["preset"], "secs", _middle())
        rows = self.current.groupBy("preset").agg(
            F.count("late").alias("e"), F.count_if(F.col("late") == 1).alias("l"), F.count("secs").alias("t"),
            (F.avg("secs") / 86400).alias("average_delivery_days"), F.count("score").alias("v"), F.avg("score").alias("average_review_score"))
        fill = lambda c, name: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(name)
        return self.frame.join(rows, "preset", "left").join(middle, "preset", "left").select(
            "preset", fill("e", "eligible_orders"), fill("l", "late_orders"), fill("t", "delivery_sample_count"), "average_delivery_days",
            ((F.col("below") + F.col("above")) / 2 / 86400).alias("median_delivery_days"), fill("v", "reviewed_orders"), "average_review_score",
            F.when(F.col("e") > 0, F.col("l") / F.col("e")).alias("late_rate"))

    @staticmethod
    def _group(late: Column) -> Column:
        return F.when(late == 1, "late").when(late == 0, "on_time").otherwise("unknown")

    def fulfilment_groups(self) -> DataFrame:
        none = self._each(["on_time", "late", "unknown"], "label", "string").select("preset", "label", F.lit(0).alias("one"), F.lit(None).cast("int").alias("score"))
        rows = self.current.select("preset", self._group(F.col("late")).alias("label"), F.lit(1).alias("one"), "score").unionByName(none)
        return rows.groupBy("preset", "label").agg(F.sum("one").alias("order_count"), F.count("score").alias("reviewed_orders"),
                                                   F.avg("score").alias("average_review_score"))

    def scores(self) -> DataFrame:
        none = self._each([1, 2, 3, 4, 5], "score", "int").withColumn("one", F.lit(0))
        return self.current.filter(F.col("score").isNotNull()).select("preset", "score", F.lit(1).alias("one")).unionByName(none).groupBy(
            "preset", "score").agg(F.sum("one").alias("order_count"))

    # ---- customers

    @cached_property
    def people(self) -> DataFrame:
        first = self.orders.groupBy("uid").agg(F.min("day").alias("first_day"))
        per = self.current.groupBy("preset", "start", "end", "uid").agg(
            F.datediff("end", F.max("day")).cast("bigint").alias("recency_days"), F.count(F.lit(1)).alias("frequency"), F.sum("rev").alias("monetary_cents"))
        return self.work.store(per.join(first, "uid"), "raw_people")

    def customers(self) -> DataFrame:
        one = lambda c: F.sum(F.when(c, 1).otherwise(0))
        found = self.people.groupBy("preset").agg(
            F.count(F.lit(1)).alias("a"), one(F.col("first_day") >= F.col("start")).alias("b"), one(F.col("first_day") < F.col("start")).alias("c"),
            one(F.col("frequency") > 1).alias("d"), one(F.col("frequency") == 1).alias("single"), F.sum("frequency").alias("e"), F.sum("monetary_cents").alias("f"))
        names = {"a": "customer_count", "b": "new_customers", "c": "returning_customers", "d": "repeat_customers", "e": "order_count", "f": "revenue_cents"}
        return self.frame.join(found, "preset", "left").select(
            "preset", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(name) for c, name in names.items()],
            (F.col("d") / F.col("a")).alias("repeat_rate"), (F.col("single") / F.col("a")).alias("single_purchase_share"))

    def frequency(self) -> DataFrame:
        return self.people.select("preset", "frequency", "uid").distinct().groupBy("preset", "frequency").agg(F.count("uid").alias("customer_count"))

    def distribution(self) -> DataFrame:
        metrics = ["recency_days", "frequency", "monetary_cents"]
        long = self.people.select("preset", F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value")) for m in metrics])).alias("x")).select("preset", "x.*")
        last = F.col("n") - 1
        at = kth_smallest(long, ["preset", "metric"], "value", {
            **_middle(), "least": F.lit(0), "p75": F.ceil(F.col("n") * 3 / 4) - 1, "most": last})
        return self._each(metrics, "metric", "string").join(at, ["preset", "metric"], "left").select(
            "preset", "metric", F.col("least").alias("min"), ((F.col("below") + F.col("above")) / 2).alias("median"), "p75", F.col("most").alias("max"))

    def segments(self) -> DataFrame:
        r = self.rfm
        code = (F.when(F.col("recency_days") <= r.recent_days, 4).otherwise(0) + F.when(F.col("frequency") >= r.repeat_orders, 2).otherwise(0)
                + F.when(F.col("monetary_cents") >= r.amount_cents, 1).otherwise(0))
        zero = F.lit(0).cast("bigint")
        none = self._each(list(range(8)), "code", "int").select("preset", "code", zero.alias("people"), zero.alias("orders"), zero.alias("money"))
        rows = self.people.select("preset", code.alias("code"), F.lit(1).cast("bigint").alias("people"), F.col("frequency").alias("orders"),
                                  F.col("monetary_cents").alias("money")).unionByName(none)
        return rows.groupBy("preset", F.lpad(F.bin("code"), 3, "0").alias("key")).agg(
            F.sum("people").alias("customer_count"), F.sum("orders").alias("order_count"), F.sum("money").alias("revenue_cents"))

    # ---- report

    def report_headline(self) -> DataFrame:
        """With (N1 - N0)(A1 + A0)/2 and (A1 - A0)(N1 + N0)/2, A an order's average value."""
        now, old = self._measures("current"), self._measures("previous").drop("comparable")
        short = dict(zip(("order_count", "revenue_cents", "item_count", "customer_count", "average_order_value_cents"),
                         ("orders", "revenue_cents", "items", "customers", "average_order_value_cents")))
        now = now.select("preset", "comparable", *[F.col(c).alias(f"current_{n}") for c, n in short.items()])
        met = self.frame.drop("comparable").join(now, "preset").join(old, "preset")
        before = {n: F.when(F.col("comparable"), F.col(c)) for c, n in short.items()}
        n1, a1, r1 = F.col("current_orders"), F.col("current_average_order_value_cents"), F.col("current_revenue_cents")
        n0, a0, r0 = before["orders"], before["average_order_value_cents"], before["revenue_cents"]
        both = F.col("comparable") & (n1 > 0) & (n0 > 0)
        return met.select(
            "preset", *[f"current_{n}" for n in short.values()], *[c.alias(f"previous_{n}") for n, c in before.items()], (r1 - r0).alias("delta_cents"),
            F.when(r0 != 0, (r1 - r0) / r0).alias("revenue_change_rate"), (r1 / (F.datediff("end", "start") + 1)).alias("daily_revenue_cents"),
            (r0 / (F.datediff("prev_end", "prev_start") + 1)).alias("previous_daily_revenue_cents"),
            F.when(both, (n1 - n0) * (a1 + a0) / 2).alias("order_effect_cents"), F.when(both, (a1 - a0) * (n1 + n0) / 2).alias("aov_effect_cents"), "comparable")

    def contributions(self) -> DataFrame:
        """Both periods apart, joined in full and zero-filled."""
        out = None
        for dimension in ("category", "state"):
            rows = self.lines.filter("comparable").groupBy("preset", F.col(dimension).alias("name"), "period").agg(F.sum("cents").alias("cents"))
            side = lambda period, name: rows.filter(F.col("period") == period).select("preset", "name", F.col("cents").alias(name))
            both = side("current", "current_cents").join(side("previous", "previous_cents"), ["preset", "name"], "full").fillna(0).select(
                "preset", F.lit(dimension).alias("dimension"), "name", "current_cents", "previous_cents",
                (F.col("current_cents") - F.col("previous_cents")).alias("delta_cents"))
            out = both if out is None else out.unionByName(both)
        return out

    def anomalies(self) -> DataFrame:
        """A dense calendar from the look-back on; of each weekday the eight rows before a row are its baseline."""
        rules = self.anomaly
        calendar = self.frame.select("preset", "start", F.explode(F.sequence(F.date_sub("start", 7 * rules.weeks), F.col("end"))).alias("day"))
        counts = self.scope.groupBy("preset", "day").agg(F.count(F.lit(1)).alias("v"))
        dense = calendar.join(counts, ["preset", "day"], "left").fillna(0, ["v"])
        eight = Window.partitionBy("preset", F.dayofweek("day")).orderBy("day").rowsBetween(-rules.weeks, -1)
        known = self._covered(F.col("day"))
        rows = dense.select("preset", "start", "day", "v", known.alias("known"), F.collect_list("v").over(eight).alias("base"),
                            F.sum(F.when(known, 1).otherwise(0)).over(eight).alias("seen"), F.min("day").over(eight).alias("history_start"),
                            F.max("day").over(eight).alias("history_end")).filter(F.col("day") >= F.col("start"))
        half = rules.weeks // 2
        middle = lambda a: (F.element_at(F.array_sort(a), half) + F.element_at(F.array_sort(a), half + 1)) / 2
        rows = rows.withColumn("center", middle(F.col("base")))
        rows = rows.withColumn("mad", middle(F.transform("base", lambda x: F.abs(x - F.col("center")))))
        full = F.col("known") & (F.col("seen") == rules.weeks)
        rows = rows.withColumn("threshold", F.when(full, F.greatest(
            F.lit(rules.mad_multiplier * rules.mad_scale) * F.col("mad"), F.lit(rules.median_share) * F.col("center"), F.lit(float(rules.floor)))))
        off = F.col("v") - F.col("center")
        judged = full & (F.col("center") >= rules.min_median)
        return rows.select(
            "preset", "day", F.when(F.col("known"), F.col("v")).alias("order_count"), F.col("seen").alias("baseline_n"),
            F.when(full, F.col("center")).alias("baseline_median"), "threshold",
            F.when(~judged, "insufficient").when(F.abs(off) <= F.col("threshold"), "normal").when(off > 0, "high").otherwise("low").alias("status"),
            "history_start", "history_end")

    @cached_property
    def rated(self) -> DataFrame:
        """Current orders with their primary category, by rank."""
        sums = self.lines.filter(F.col("period") == "current").groupBy("preset", "order_id", "category").agg(F.sum("cents").alias("cents"))
        first = Window.partitionBy("preset", "order_id").orderBy(F.desc("cents"), "category")
        primary = sums.withColumn("rk", F.row_number().over(first)).filter("rk = 1").select("preset", "order_id", "category")
        return self.work.store(self.current.join(primary, ["preset", "order_id"]).select(
            "preset", "category", "state", self._group(F.col("late")).alias("delivery_group"), "score"), "raw_rated")

    def _stats(self, rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
        score = F.col("score")
        none = keys.select(*by, "delivery_group", F.lit(0).alias("one"), F.lit(None).cast("int").alias("score"))
        every = rows.select(*by, "delivery_group", F.lit(1).alias("one"), "score").unionByName(none)
        return every.groupBy(*by, "delivery_group").agg(
            F.sum("one").alias("order_count"), F.count("score").alias("reviewed_orders"), (F.sum("one") - F.count("score")).alias("missing_reviews"),
            F.avg("score").alias("mean_score"), F.median("score").alias("median_score"),  # five values: a small map in each task
            F.stddev_samp("score").alias("score_sd"), F.avg((score <= 2).cast("int")).alias("low_score_share"),
            *[F.count_if(score == s).alias(f"score_{s}") for s in range(1, 6)])

    def delivery_groups(self) -> DataFrame:
        return self._stats(self.rated, self._each(["on_time", "late", "unknown"], "delivery_group", "string"), ["preset"])

    def delivery_strata(self) -> DataFrame:
        out = None
        groups = self.spark.createDataFrame([("on_time",), ("late",), ("unknown",)], "delivery_group string")
        for dimension in ("category", "state"):
            rows = self.rated.select("preset", F.col(dimension).alias("name"), "delivery_group", "score")
            keys = rows.select("preset", "name").distinct().crossJoin(F.broadcast(groups))
            stats = self._stats(rows, keys, ["preset", "name"])
            own = Window.partitionBy("preset", "name")
            of = lambda group, c: F.max(F.when(F.col("delivery_group") == group, F.col(c))).over(own)
            enough = F.least(of("late", "reviewed_orders"), of("on_time", "reviewed_orders")) >= STRATA_MIN_REVIEWED
            part = stats.select(F.lit(dimension).alias("dimension"), *stats.columns, enough.alias("comparison_eligible"),
                                F.when(enough, of("late", "mean_score") - of("on_time", "mean_score")).alias("score_gap"))
            out = part if out is None else out.unionByName(part)
        return out


# ---- comparison -------------------------------------------------------------------------------------------------

def _comparable_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers as text of one form, fractions at DIGITS digits, so that both sides' types and rounding errors meet."""
    cols = []
    for c in columns:
        kind = df.schema[c].dataType
        value = F.col(c)
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = F.round(value.cast("double"), DIGITS) + F.lit(0.0)
        elif isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        cols.append(value.cast("string").alias(c))
    return df.select(*cols)


def compare_rows(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """(preset, compared_rows, difference_rows): rows of either side that the other lacks, counted with multiplicity."""
    columns = [c for c in recomputed.columns if c in published.columns]
    sides = _comparable_rows(published, columns).withColumn("side", F.lit(1)).unionByName(
        _comparable_rows(recomputed, columns).withColumn("side", F.lit(-1)))
    balance = sides.groupBy(*columns).agg(F.sum("side").alias("off"), F.count_if(F.col("side") == 1).alias("rows"))
    return balance.groupBy("preset").agg(F.sum("rows").alias("compared_rows"), F.sum(F.abs("off")).alias("difference_rows"))


def verify_from_raw(published: dict[str, DataFrame], raw: RawSections, names) -> DataFrame:
    """(section, preset, compared_rows, difference_rows) for every section and preset; the types on both sides may differ."""
    presets = raw.frame.select("preset")
    out = None
    for name in names:
        got = compare_rows(published[name], getattr(raw, name)())
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
        part = presets.join(got, "preset", "left").select(F.lit(name).alias("section"), "preset", zero("compared_rows"), zero("difference_rows"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- published against recomputed -------------------------------------------------------------------------------

def read_sections(spark: SparkSession, path: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Sections as ``publish_snapshots`` wrote them."""
    return {name: spark.read.schema(schema).json(f"{path}/section={name}").select(*schema.names) for name, schema in schemas.items()}


def section_digests(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, preset, rows, digest): a sum of row hashes that ignores the order; one scan a section."""
    out = None
    for name, df in sections.items():
        columns = sorted(df.columns)
        text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])
        part = df.groupBy("preset").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(text).cast("decimal(38,0)")).alias("digest")).select(
            F.lit(name).alias("section"), "preset", "rows", "digest")
        out = part if out is None else out.unionByName(part)
    return out


def verify_published(published: dict[str, DataFrame], recomputed: dict[str, DataFrame], presets: DataFrame) -> DataFrame:
    """(section, preset, published_rows, recomputed_rows, equal) for every section and preset of the contract."""
    names = presets.sparkSession.createDataFrame([(n,) for n in recomputed], "section string")
    side = lambda sections, name: section_digests(sections).select(
        "section", "preset", F.col("rows").alias(f"{name}_rows"), F.col("digest").alias(f"{name}_digest"))
    grid = presets.select("preset").crossJoin(F.broadcast(names))
    met = grid.join(side(published, "published"), ["section", "preset"], "left").join(side(recomputed, "recomputed"), ["section", "preset"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return met.select("section", "preset", zero("published_rows"), zero("recomputed_rows"), (
        F.col("published_rows").eqNullSafe(F.col("recomputed_rows")) & F.col("published_digest").eqNullSafe(F.col("recomputed_digest"))).alias("equal"))


def differing_rows(published: dict[str, DataFrame], recomputed: dict[str, DataFrame], verdict: DataFrame) -> dict[str, DataFrame]:
    """The second level: of sections with an unequal preset, the rows that only one side has, with ``side``."""
    bad: dict[str, list[str]] = {}
    for r in verdict.filter(~F.col("equal")).select("section", "preset").collect():  # at most sections times presets
        bad.setdefault(r["section"], []).append(r["preset"])
    out = {}
    for name, presets in bad.items():
        columns = recomputed[name].columns
        a, b = (side[name].select(*columns).filter(F.col("preset").isin(presets)) for side in (published, recomputed))
        out[name] = a.exceptAll(b).withColumn("side", F.lit("published_only")).unionByName(b.exceptAll(a).withColumn("side", F.lit("recomputed_only")))
    return out
