"""Customer analytics over a scope: first purchase, per-customer window, summary, RFM segments, distributions.

The per-customer table is one hash aggregate keyed by the stable customer id; every answer after that is a second
small aggregate (no per-customer loop anywhere)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import exact_quantiles
from ..params import RfmRules, ScopeParams
from .scope import Scope



def _zero() -> F.Column:
    return F.lit(0).cast("bigint")


def first_purchase(star: dict[str, DataFrame], params: ScopeParams) -> DataFrame:
    """First counted purchase day per stable customer up to the window end; ignores category/state filters.
    With the stored per-customer table (delivered orders), a filter on it replaces the scan of the order fact."""
    if "customer_first" in star and tuple(params.statuses) == ("delivered",):
        return star["customer_first"].filter(F.col("first_day") <= F.lit(params.end))
    fo = star["fact_order"].filter(F.col("status").isin(list(params.statuses))
                                   & (F.col("purchase_date") <= F.lit(params.end)))
    cust = star["dim_customer"].select("customer_id", "customer_unique_id")
    return fo.join(cust, "customer_id").groupBy("customer_unique_id") \
        .agg(F.min("purchase_date").alias("first_day"))


def customer_window(scope: Scope, first: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """Per customer in scope (and per ``by`` group, e.g. state): first_day, last_day, frequency, monetary and
    recency (days to the window end). The first purchase stays global (never filtered by the group)."""
    per = scope.orders.groupBy("customer_unique_id", *by).agg(
        F.max("purchase_date").alias("last_day"), F.count(F.lit(1)).alias("frequency"),
        F.sum("scoped_revenue_cents").alias("monetary_cents"))
    return per.join(first, "customer_unique_id").select(
        "customer_unique_id", *by, "first_day", "last_day", "frequency", "monetary_cents",
        F.datediff(F.lit(scope.params.end), F.col("last_day")).alias("recency_days"))


def customer_summary(window: DataFrame, params: ScopeParams | None, by: list[str] | tuple = (),
                     is_new: F.Column | None = None) -> DataFrame:
    """Customers, new (first purchase inside the window), returning, repeat (>= 2 orders), rates, orders, revenue.
    ``is_new``: per-row flag for windows that differ by group (e.g. one window per preset) instead of params.start."""
    n = F.count(F.lit(1))
    repeat = F.count_if(F.col("frequency") >= 2)
    new = is_new if is_new is not None else F.col("first_day") >= F.lit(params.start)
    row = (window.groupBy(*by) if by else window).agg(n.alias("customer_count"),
                     F.count_if(new).alias("new_customers"),
                     repeat.alias("repeat_customers"),
                     F.coalesce(F.sum("frequency"), _zero()).alias("order_count"),
                     F.coalesce(F.sum("monetary_cents"), _zero()).alias("revenue_cents"))
    return row.select(*by, "customer_count", "new_customers",
                      (F.col("customer_count") - F.col("new_customers")).alias("returning_customers"),
                      "repeat_customers",
                      F.try_divide(F.col("repeat_customers").cast("double"), F.col("customer_count"))
                      .alias("repeat_rate"),
                      "order_count", "revenue_cents",
                      F.try_divide((F.col("customer_count") - F.col("repeat_customers")).cast("double"),
                                   F.col("customer_count")).alias("single_purchase_share"))


def segment_key(rules: RfmRules = RfmRules()) -> F.Column:
    """3-character key: recent (R <= days), repeat (F >= n), amount (M >= cents)."""
    bit = lambda c: F.when(c, F.lit("1")).otherwise(F.lit("0"))
    return F.concat(bit(F.col("recency_days") <= rules.recent_days),
                    bit(F.col("frequency") >= rules.repeat_orders),
                    bit(F.col("monetary_cents") >= rules.amount_cents))


def rfm_segments(window: DataFrame, rules: RfmRules = RfmRules(), by: list[str] | tuple = (),
                 groups: DataFrame | None = None) -> DataFrame:
    """Always eight rows (keys 111..000) per group, with customers, orders and revenue per segment. ``groups``: the
    group keys that must appear even without customers (default: the groups present in ``window``)."""
    spark = window.sparkSession
    keys = spark.createDataFrame([(f"{r}{f}{m}",) for r in (1, 0) for f in (1, 0) for m in (1, 0)], "key string")
    if by:
        keys = (groups if groups is not None else window.select(*by).distinct()).crossJoin(F.broadcast(keys))
    seg = window.groupBy(*by, segment_key(rules).alias("key")).agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("frequency").alias("order_count"),
        F.sum("monetary_cents").alias("revenue_cents"))
    left = keys if by else F.broadcast(keys)
    return left.join(seg, [*by, "key"], "left").select(
        *by, "key", F.coalesce("customer_count", _zero()).alias("customer_count"),
        F.coalesce("order_count", _zero()).alias("order_count"), F.coalesce("revenue_cents", _zero()).alias("revenue_cents"))


def frequency_histogram(window: DataFrame) -> DataFrame:
    return window.groupBy("frequency").agg(F.count(F.lit(1)).alias("customer_count"))


RFM_METRICS = ("recency_days", "frequency", "monetary_cents")


def rfm_distribution(window: DataFrame) -> DataFrame:
    """Per metric: min, exact median, nearest-rank p75 (= percentile_disc), max; NULLs when there are no rows.
    Quantiles work on counts per distinct value (most customers share frequency 1)."""
    spark = window.sparkSession
    long = window.select(F.expr(
        "stack(3, 'recency_days', cast(recency_days as bigint), 'frequency', cast(frequency as bigint), "
        "'monetary_cents', cast(monetary_cents as bigint)) as (metric, value)"))
    stats = long.groupBy("metric").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", {"median": (0.5, "linear"), "p75": (0.75, "nearest")}, by=["metric"])
    metrics = spark.createDataFrame([(m,) for m in RFM_METRICS], "metric string")
    return F.broadcast(metrics).join(stats, "metric", "left").join(q, "metric", "left").select(
        "metric", "min", "median", F.col("p75").cast("bigint").alias("p75"), "max")


def customers_beyond_recency(segments: DataFrame) -> DataFrame:
    """Customers whose last purchase is older than the recency threshold (segments with key '0..')."""
    return segments.agg(F.coalesce(F.sum(F.when(F.col("key").startswith("0"), F.col("customer_count"))), _zero())
                        .alias("customers_beyond_recency"))


def customer_analysis_from_window(window: DataFrame, params: ScopeParams, rules: RfmRules = RfmRules()) -> dict[str, DataFrame]:
    segments = rfm_segments(window, rules)
    return {"summary": customer_summary(window, params), "segments": segments,
            "frequency": frequency_histogram(window), "distribution": rfm_distribution(window),
            "beyond_recency": customers_beyond_recency(segments)}


def customer_analysis(star: dict[str, DataFrame], scope: Scope, rules: RfmRules = RfmRules()) -> dict[str, DataFrame]:
    """All customer sections from one per-customer window (persist it when several sections are read)."""
    window = customer_window(scope, first_purchase(star, scope.params))
    return {"window": window, **customer_analysis_from_window(window, scope.params, rules)}
