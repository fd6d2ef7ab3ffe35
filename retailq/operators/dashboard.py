"""Dashboard sections derived from one Scope: KPIs, comparison, dense trend, rankings, fulfilment, order list/detail.

Each function is DataFrame -> DataFrame; optional ``by`` columns answer many groups (e.g. state) in one job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.stats import exact_quantiles
from ..params import ScopeParams
from .scope import Scope, build_scope, comparable_flag, period_calendar, period_start



def _zero() -> F.Column:
    return F.lit(0).cast("bigint")


def _kpi_aggs() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("order_count"),
            F.coalesce(F.sum("scoped_revenue_cents"), _zero()).alias("revenue_cents"),
            F.coalesce(F.sum("scoped_item_count").cast("bigint"), _zero()).alias("item_count"),
            F.countDistinct("customer_unique_id").alias("customer_count")]


def _with_aov(df: DataFrame) -> DataFrame:
    return df.withColumn("average_order_value_cents",
                         F.try_divide(F.col("revenue_cents").cast("double"), F.col("order_count")))


def kpis(scope: Scope, by: list[str] | tuple = ()) -> DataFrame:
    """Orders, revenue (item price only), items, distinct stable customers, AOV (NULL when no orders)."""
    grouped = scope.orders.groupBy(*by) if by else scope.orders
    return _with_aov(grouped.agg(*_kpi_aggs()))


def kpi_comparison(star: dict[str, DataFrame], params: ScopeParams, coverage_row: DataFrame) -> DataFrame:
    """Current and previous period KPIs from ONE widened scope with a ``period`` column (conditional aggregation).

    The previous row exists only when both windows lie inside the coverage; change rates are NULL when the
    previous value is missing or zero."""
    ps, pe, label = params.comparison()
    wide = build_scope(star, params.with_dates(min(ps, params.start), params.end))
    period = F.when(F.col("purchase_date") >= F.lit(params.start), F.lit("current")).otherwise(F.lit("previous"))
    orders = wide.orders.filter(F.col("purchase_date").between(F.lit(ps), F.lit(pe))
                                | F.col("purchase_date").between(F.lit(params.start), F.lit(params.end)))
    periods = orders.sparkSession.createDataFrame(
        [("current", params.start, params.end), ("previous", ps, pe)], "period string, start date, end date")
    agg = orders.withColumn("period", period).groupBy("period").agg(*_kpi_aggs())
    rows = (F.broadcast(periods).join(agg, "period", "left")
            .select("period", "start", "end",
                    F.coalesce("order_count", _zero()).alias("order_count"),
                    F.coalesce("revenue_cents", _zero()).alias("revenue_cents"),
                    F.coalesce("item_count", _zero()).alias("item_count"),
                    F.coalesce("customer_count", _zero()).alias("customer_count")))
    rows = _with_aov(rows).crossJoin(F.broadcast(comparable_flag(coverage_row, params)))
    return rows.filter((F.col("period") == "current") | F.col("comparable")) \
        .withColumn("comparison_label", F.lit(label))


def kpi_change_rate(comparison: DataFrame) -> DataFrame:
    """One row: (current - previous) / previous per KPI; NULL when previous is missing or 0."""
    cur = comparison.filter(F.col("period") == "current")
    prev = comparison.filter(F.col("period") == "previous").select(
        *[F.col(c).alias(f"prev_{c}") for c in ("order_count", "revenue_cents", "item_count", "customer_count",
                                                  "average_order_value_cents")])
    out = cur.join(prev, how="left")  # both sides have at most one row
    cols = []
    for c in ("order_count", "revenue_cents", "item_count", "customer_count", "average_order_value_cents"):
        cols.append(F.try_divide((F.col(c) - F.col(f"prev_{c}")).cast("double"), F.col(f"prev_{c}").cast("double"))
                    .alias(f"{c}_change_rate"))
    return out.select(*cols)


def trend(scope: Scope, grain: str, coverage_row: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """Dense calendar of buckets; observed 0 inside coverage, NULL outside; ``complete`` per bucket."""
    spark: SparkSession = scope.orders.sparkSession
    p = scope.params
    facts = (scope.orders.groupBy(period_start("purchase_date", grain).alias("period"), *by)
             .agg(F.sum("scoped_revenue_cents").alias("revenue_cents"), F.count(F.lit(1)).alias("order_count")))
    cal = period_calendar(spark, p.start, p.end, grain, coverage_row)
    if by:
        groups = scope.orders.select(*by).distinct()
        cal = cal.crossJoin(groups)
    joined = cal.join(facts, ["period", *by], "left")
    fill = lambda c: F.when(F.col(c).isNotNull(), F.col(c)).when(F.col("covered"), F.lit(0).cast("bigint"))
    return joined.select("period", *by, "complete", fill("revenue_cents").alias("revenue_cents"),
                         fill("order_count").alias("order_count"))


def rank_categories(scope: Scope) -> DataFrame:
    return (scope.items.groupBy(F.col("category").alias("name"), F.col("category_label").alias("label"))
            .agg(F.sum("price_cents").alias("revenue_cents"), F.countDistinct("order_id").alias("order_count"),
                 F.count(F.lit(1)).alias("item_count"))
            .orderBy(F.desc("revenue_cents"), "name"))


def category_share(scope: Scope) -> DataFrame:
    """Category revenue over total revenue (0 when the total is 0); the total is a one-row broadcast."""
    cats = rank_categories(scope)
    total = scope.items.agg(F.coalesce(F.sum("price_cents"), _zero()).alias("total_cents"))
    return cats.crossJoin(F.broadcast(total)).select(
        "name", "label", "revenue_cents",
        F.when(F.col("total_cents") == 0, F.lit(0.0))
        .otherwise(F.col("revenue_cents") / F.col("total_cents")).alias("revenue_share"))


def rank_regions(scope: Scope) -> DataFrame:
    return (scope.orders.groupBy(F.col("state").alias("name"))
            .agg(F.sum("scoped_revenue_cents").alias("revenue_cents"), F.count(F.lit(1)).alias("order_count"),
                 F.sum("scoped_item_count").cast("bigint").alias("item_count"))
            .orderBy(F.desc("revenue_cents"), "name"))


def _product_totals(scope: Scope) -> DataFrame:
    return (scope.items.groupBy("product_id", "category", F.col("category_label").alias("label"))
            .agg(F.sum("price_cents").alias("revenue_cents"), F.countDistinct("order_id").alias("order_count"),
                 F.count(F.lit(1)).alias("item_count")))


def top_products(scope: Scope, k: int = 20) -> DataFrame:
    """Top k by revenue, ties by product id (planned as TakeOrderedAndProject: per-partition top-k, then merge)."""
    return _product_totals(scope).orderBy(F.desc("revenue_cents"), "product_id").limit(k)


def low_volume_products(scope: Scope, k: int = 20) -> DataFrame:
    return _product_totals(scope).orderBy("item_count", "revenue_cents", "product_id").limit(k)


def fulfilment_summary(scope: Scope) -> DataFrame:
    """Eligible/late orders, late rate, delivery sample, mean and exact median days, reviews, mean score.

    The exact median works on counts per distinct duration."""
    o = scope.orders
    row = o.agg(F.count("is_late").alias("eligible_orders"),
                F.count_if(F.col("is_late") == 1).alias("late_orders"),
                F.count("delivery_seconds").alias("delivery_sample_count"),
                (F.avg("delivery_seconds") / 86400).alias("average_delivery_days"),
                F.count("review_score").alias("reviewed_orders"),
                F.avg("review_score").alias("average_review_score"))
    med = exact_quantiles(o, "delivery_seconds", {"_median_s": (0.5, "linear")})
    return row.join(med, how="left").select(
        "eligible_orders", "late_orders", "delivery_sample_count", "average_delivery_days",
        (F.col("_median_s") / 86400).alias("median_delivery_days"), "reviewed_orders", "average_review_score",
        F.try_divide(F.col("late_orders").cast("double"), F.col("eligible_orders")).alias("late_rate"))


FULFILMENT_GROUPS = [(0, "on_time"), (1, "late"), (None, "unknown")]


def fulfilment_groups(scope: Scope) -> DataFrame:
    """Always three rows (on time / late / unknown), joined null-safe on ``is_late``."""
    spark = scope.orders.sparkSession
    labels = spark.createDataFrame(FULFILMENT_GROUPS, "is_late int, label string")
    g = scope.orders.groupBy("is_late").agg(F.count(F.lit(1)).alias("order_count"),
                                            F.count("review_score").alias("reviewed_orders"),
                                            F.avg("review_score").alias("average_review_score"))
    return (F.broadcast(labels).join(g, labels["is_late"].eqNullSafe(g["is_late"]), "left")
            .select("label", F.coalesce("order_count", _zero()).alias("order_count"),
                    F.coalesce("reviewed_orders", _zero()).alias("reviewed_orders"), "average_review_score"))


def score_histogram(scope: Scope) -> DataFrame:
    spark = scope.orders.sparkSession
    scores = spark.range(1, 6).select(F.col("id").cast("int").alias("score"))
    counts = scope.orders.filter(F.col("review_score").isNotNull()) \
        .groupBy(F.col("review_score").alias("score")).agg(F.count(F.lit(1)).alias("order_count"))
    return F.broadcast(scores).join(counts, "score", "left").select(
        "score", F.coalesce("order_count", _zero()).alias("order_count"))


def _order_list_columns() -> list:
    return ["order_id", "purchase_date", "state", F.col("scoped_item_count").alias("item_count"),
            F.col("scoped_revenue_cents").alias("revenue_cents"), "payment_cents", "review_score",
            "is_late", "quality_flags"]


LEAF_ROWS = 10_000  # rows of one key prefix that are put in order to find a page's first row


def _order_key(orders: DataFrame) -> F.Column:
    """A text whose code-point order is the order of order_id: the id itself, or fixed-width hexadecimal of a whole number."""
    if isinstance(orders.schema["order_id"].dataType, T.StringType):
        return F.col("order_id")
    from_least = F.col("order_id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
    return F.lpad(F.hex(from_least), 16, "0")


def _covering(counts: DataFrame, name: str, rank: int, descending: bool = False) -> tuple | None:
    """(value, rows before it) of the group that holds the zero-based rank, by prefix sums over one row a group."""
    order = F.desc(name) if descending else F.asc(name)
    upto = F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    row = counts.withColumn("upto", upto).filter(F.col("upto") > rank).orderBy("upto").limit(1).first()
    return None if row is None else (row[name], row["upto"] - row["n"], row["n"])


def _first_of_page(orders: DataFrame, day, rank: int, rows: int) -> object:
    """order_id of the row with this zero-based rank inside a day.

    A prefix of the id grows by a letter or digit at a time: each step counts rows by the next one, one row a letter, and
    keeps the prefix that holds the rank, until few enough rows share it to be ordered. So a day of any size is never
    sorted, and an offset of any depth is found from counts.
    """
    here = orders.filter(F.col("purchase_date") == F.lit(day)).select("order_id", _order_key(orders).alias("key"))
    prefix = ""
    while rows > LEAF_ROWS:
        step = here.filter(F.col("key").startswith(prefix)).groupBy(F.substring("key", len(prefix) + 1, 1).alias("next")).agg(
            F.count(F.lit(1)).alias("n"))
        letter, before, rows = _covering(step, "next", rank)
        if letter == "":  # equal to the prefix, so the same id: any of them
            return here.filter(F.col("key") == prefix).first()["order_id"]
        prefix, rank = prefix + letter, rank - before
    return here.filter(F.col("key").startswith(prefix)).orderBy("key").offset(rank).limit(1).first()["order_id"]


def order_list(scope: Scope, page: int = 1, page_size: int = 20) -> DataFrame:
    """One page ordered by purchase day desc, order id; total rows as a column. Pages at any depth cost the same: prefix sums
    over the day histogram find the day of the page's first row, counts by id prefix find the row, and only days that the
    page touches are read for its rows."""
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size must be positive")
    columns = _order_list_columns()
    days = scope.orders.groupBy("purchase_date").agg(F.count(F.lit(1)).alias("n"))
    total = days.agg(F.coalesce(F.sum("n"), _zero()).alias("total"))
    offset = (page - 1) * page_size
    found = _covering(days, "purchase_date", offset, descending=True)
    if found is None:
        return scope.orders.select(*columns).limit(0).crossJoin(F.broadcast(total))
    day, before, rows = found
    first = _first_of_page(scope.orders, day, offset - before, rows)
    last = _covering(days, "purchase_date", offset + page_size - 1, descending=True)
    touched = (F.col("purchase_date") < F.lit(day)) | ((F.col("purchase_date") == F.lit(day)) & (F.col("order_id") >= F.lit(first)))
    if last is not None:
        touched = touched & (F.col("purchase_date") >= F.lit(last[0]))
    page_rows = scope.orders.select(*columns).filter(touched).orderBy(F.desc("purchase_date"), "order_id").limit(page_size)
    return page_rows.crossJoin(F.broadcast(total))


def order_list_after(scope: Scope, after_date, after_order_id, page_size: int = 20) -> DataFrame:
    """Keyset page (deep paging without an offset scan): rows strictly after the given sort key."""
    base = scope.orders.select(*_order_list_columns())
    after = (F.col("purchase_date") < F.lit(after_date)) | (
        (F.col("purchase_date") == F.lit(after_date)) & (F.col("order_id") > F.lit(after_order_id)))
    return base.filter(after).orderBy(F.desc("purchase_date"), "order_id").limit(page_size)


def order_documents(scope: Scope, order_ids: DataFrame | None = None) -> DataFrame:
    """Whole-order header joined to its scoped items, one row per item (header repeated), clustered by order and
    sorted by item id inside each partition; ``order_ids`` restricts both sides through a semi join. Items are not
    gathered into one array per order, so a huge order never becomes one row in one task."""
    orders, items = scope.orders, scope.items
    if order_ids is not None:
        ids = order_ids.select("order_id").distinct()
        orders = orders.join(ids, "order_id", "left_semi")
        items = items.join(ids, "order_id", "left_semi")
    header = orders.select(
        "order_id", "purchase_date", "state", F.col("scoped_item_count").alias("item_count"),
        F.col("scoped_revenue_cents").alias("revenue_cents"),
        F.col("revenue_cents").alias("total_order_revenue_cents"), "payment_cents", "payment_count",
        "review_score", "review_count", "is_late", "purchase_at", "delivered_at", "estimated_at", "quality_flags")
    lines = items.select("order_id", "item_id", "product_id", "seller_id", "category",
                         F.col("category_label").alias("label"), "price_cents", "freight_cents")
    return header.join(lines, "order_id").sortWithinPartitions("order_id", "item_id")
