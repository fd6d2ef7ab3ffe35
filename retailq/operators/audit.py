"""Full-table data-quality audit over the string landing tables.

Missing = empty or whitespace only ('NA', 'null', '0' are values). Every profiler is one or two aggregates; nothing is
sampled or capped. Multi-column profiles unpivot first (one scan, one shuffle keyed by column name and value).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import (is_missing, money_cents, money_valid, strict_timestamp, trimmed)
from ..functions.stats import exact_quantiles
from ..params import ORDER_STATUSES



def _zero() -> F.Column:
    return F.lit(0).cast("bigint")

# Fixed values of the audit.
DATE_COLUMNS = {"orders": ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                           "order_delivered_customer_date", "order_estimated_delivery_date"],
                "items": ["shipping_limit_date"],
                "reviews": ["review_creation_date", "review_answer_timestamp"]}
CANDIDATE_KEYS = {"orders": ["order_id"], "items": ["order_id", "order_item_id"], "customers": ["customer_id"],
                  "products": ["product_id"], "sellers": ["seller_id"],
                  "payments": ["order_id", "payment_sequential"], "translation": ["product_category_name"]}
RELATIONS = [
    ("orders.customer_id -> customers.customer_id", "orders", "customer_id", "customers", "customer_id"),
    ("items.order_id -> orders.order_id", "items", "order_id", "orders", "order_id"),
    ("items.product_id -> products.product_id", "items", "product_id", "products", "product_id"),
    ("items.seller_id -> sellers.seller_id", "items", "seller_id", "sellers", "seller_id"),
    ("payments.order_id -> orders.order_id", "payments", "order_id", "orders", "order_id"),
    ("reviews.order_id -> orders.order_id", "reviews", "order_id", "orders", "order_id"),
    ("products.category -> translation.category", "products", "product_category_name", "translation",
     "product_category_name"),
    ("customers.postcode -> geolocation.postcode", "customers", "customer_zip_code_prefix", "geolocation",
     "geolocation_zip_code_prefix"),
    ("sellers.postcode -> geolocation.postcode", "sellers", "seller_zip_code_prefix", "geolocation",
     "geolocation_zip_code_prefix"),
]
NUMERIC_COLUMNS = {"items": ["order_item_id"], "payments": ["payment_sequential", "payment_installments"],
                   "products": ["product_name_lenght", "product_description_lenght", "product_photos_qty",
                                "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]}
MONEY_COLUMNS = [("items", "price"), ("items", "freight_value"), ("payments", "payment_value")]
COARSE_BOX = {"lat": (-34.0, 6.0), "lng": (-74.0, -34.0)}


def _long(df: DataFrame, columns: list[str], value_name: str = "value") -> DataFrame:
    return df.unpivot([], columns, "column", value_name)


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Per column: missing rows, missing rate, distinct non-missing values."""
    cols = df.columns
    long = _long(df.select([F.col(c).cast("string") for c in cols]), cols)
    miss = is_missing(F.col("value"))
    return long.groupBy("column").agg(
        F.count_if(miss).alias("missing"), (F.count_if(miss) / F.count(F.lit(1))).alias("missing_rate"),
        F.count_distinct(F.when(~miss, F.col("value"))).alias("distinct_nonmissing")) \
        .select(F.lit(table).alias("table"), "*")


def profile_exact_duplicates(df: DataFrame, table: str) -> DataFrame:
    dup = df.groupBy(*df.columns).count()
    return dup.agg(F.coalesce(F.sum(F.col("count") - 1), _zero()).alias("exact_duplicate_rows"),
                   F.coalesce(F.sum("count"), _zero()).alias("rows")).select(F.lit(table).alias("table"), "*")


def profile_candidate_key(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Rows repeating an earlier key, and rows with any key part missing."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"),
                                   F.count_if(F.greatest(*[is_missing(F.col(k)) for k in key])
                                              if len(key) > 1 else is_missing(F.col(key[0]))).alias("m"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), _zero()).alias("duplicate_key_rows"),
                       F.coalesce(F.sum("m"), _zero()).alias("missing_key_rows")) \
        .select(F.lit(table).alias("table"), F.lit(",".join(key)).alias("candidate_key"), "*")


def profile_relationship(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                         name: str) -> DataFrame:
    """child rows, missing child keys, unmatched rows and distinct keys, duplicate parent key rows."""
    parents = parent.groupBy(F.col(parent_col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    c = child.groupBy(F.col(child_col).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))  # a hot key is one row
    j = c.join(parents.select("_k", F.lit(True).alias("_hit")), "_k", "left")
    miss = is_missing(F.col("_k"))
    unmatched = ~miss & F.col("_hit").isNull()
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_c"))), _zero())
    row = j.agg(rows(F.lit(True)).alias("child_rows"), rows(miss).alias("missing_child_keys"),
                rows(unmatched).alias("unmatched_child_rows"),
                F.count_if(unmatched & F.col("_k").isNotNull()).alias("unmatched_distinct_keys"))
    dup = parents.agg(F.coalesce(F.sum(F.col("_n") - 1), _zero()).alias("parent_duplicate_key_rows"))
    return row.crossJoin(dup).select(F.lit(name).alias("relation"), "*")


def profile_dates(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Per date column: missing, invalid non-missing, min and max (text form)."""
    # parse once per value in a projection; the aggregate then sees plain columns
    long = _long(df.select(columns), columns).select(
        "column", strict_timestamp(F.col("value")).alias("_ts"), is_missing(F.col("value")).alias("_miss"))
    ts, miss = F.col("_ts"), F.col("_miss")
    return long.groupBy("column").agg(
        F.count_if(miss).alias("missing"), F.count_if(~miss & ts.isNull()).alias("invalid_nonmissing"),
        F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("min"),
        F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("max")).select(F.lit(table).alias("table"), "*")


def profile_status_counts(orders: DataFrame) -> DataFrame:
    spark = orders.sparkSession
    domain = spark.createDataFrame([(s,) for s in ORDER_STATUSES] + [("other",)], "status string")
    counted = orders.select(F.when(F.col("order_status").isin(*ORDER_STATUSES), F.col("order_status"))
                            .otherwise(F.lit("other")).alias("status")).groupBy("status").count()
    return F.broadcast(domain).join(counted, "status", "left").select(
        "status", F.coalesce("count", _zero()).alias("orders"))


def profile_monthly_crosstab(orders: DataFrame) -> DataFrame:
    month = F.date_format(strict_timestamp(F.col("order_purchase_timestamp")), "yyyy-MM")
    return orders.filter(month.isNotNull()).groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("order_status") == "delivered").alias("delivered"))


def profile_money(L: dict[str, DataFrame]) -> DataFrame:
    """Per money column: invalid and negative counts, total cents (exact)."""
    parts = []
    for table, col in MONEY_COLUMNS:
        v = F.col(col)
        cents = money_cents(v, allow_negative=True)
        parts.append(L[table].agg(
            F.count_if(~money_valid(v, allow_negative=True)).alias("invalid"),
            F.count_if(cents < 0).alias("negative"),
            F.coalesce(F.sum(cents), _zero()).alias("total_cents")).select(
            F.lit(f"{table}.{col}").alias("column"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_numeric(df: DataFrame, col: str, by: list[str] | tuple = ()) -> DataFrame:
    """count, min, median, mean, p95, p99, max, q1, q3 (linear interpolation), MAD, Tukey-fence count.
    Quantiles, deviations and fences are exact and work on one row for each distinct value and its count."""
    by = list(by)
    x = F.col(col).cast("double")
    d = df.filter(x.isNotNull()).select(*by, x.alias("x"))
    g = d.groupBy(*by) if by else d
    basic = g.agg(F.count(F.lit(1)).alias("count"), F.min("x").alias("min"), F.avg("x").alias("mean"),
                  F.max("x").alias("max"))
    counts = d.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("n_x"))
    q = exact_quantiles(counts, "x", {"median": (0.5, "linear"), "p95": (0.95, "linear"), "p99": (0.99, "linear"),
                                 "q1": (0.25, "linear"), "q3": (0.75, "linear")}, by, "n_x")
    stats = basic.join(q, by, "left") if by else basic.join(q, how="left")
    center = stats.select(*by, "median", "q1", "q3")
    j = counts.join(center, by) if by else counts.crossJoin(F.broadcast(center))  # one row without groups
    iqr = F.col("q3") - F.col("q1")
    dev = j.select(*by, "n_x", F.abs(F.col("x") - F.col("median")).alias("dev"),
                   ((F.col("x") < F.col("q1") - 1.5 * iqr) | (F.col("x") > F.col("q3") + 1.5 * iqr)).alias("out"))
    mad = exact_quantiles(dev, "dev", {"mad": (0.5, "linear")}, by, "n_x")
    flags = (dev.groupBy(*by) if by else dev).agg(
        F.coalesce(F.sum(F.when(F.col("out"), F.col("n_x"))), _zero()).alias("iqr_flag_count"))
    out = stats.join(mad, by, "left").join(flags, by, "left") if by else \
        stats.join(mad, how="left").join(flags, how="left")
    return out.select(*by, "count", "min", "median", "mean", "p95", "p99", "max", "q1", "q3", "mad", "iqr_flag_count")


def _order_folds(L: dict[str, DataFrame]):
    items, pays, revs = L["items"], L["payments"], L["reviews"]
    item_fold = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_rows"), F.count_distinct("seller_id").alias("sellers"),
        F.sum(money_cents(F.col("price"), True) + money_cents(F.col("freight_value"), True)).alias("items_and_freight"))
    pay_fold = pays.groupBy("order_id").agg(F.count(F.lit(1)).alias("pay_rows"),
                                           F.sum(money_cents(F.col("payment_value"), True)).alias("payments"))
    rev_fold = revs.groupBy("order_id").agg(F.count(F.lit(1)).alias("rev_rows"))
    return item_fold, pay_fold, rev_fold


def profile_payment_reconciliation(L: dict[str, DataFrame]) -> DataFrame:
    """Orders having both item and payment totals: exact matches, > 1 cent differences, summed difference."""
    item_fold, pay_fold, _ = _order_folds(L)
    both = item_fold.join(pay_fold, "order_id").filter(
        F.col("items_and_freight").isNotNull() & F.col("payments").isNotNull())
    diff = F.col("payments") - F.col("items_and_freight")
    return both.agg(F.count(F.lit(1)).alias("comparable_orders"), F.count_if(diff == 0).alias("exact_match_orders"),
                    F.count_if(F.abs(diff) > 1).alias("difference_over_one_cent_orders"),
                    F.coalesce(F.sum(diff), _zero()).alias("sum_payment_minus_items_freight_cents"))


def payment_differences(L: dict[str, DataFrame]) -> DataFrame:
    item_fold, pay_fold, _ = _order_folds(L)
    return item_fold.join(pay_fold, "order_id").select(
        (F.col("payments") - F.col("items_and_freight")).alias("difference_cents"))


def profile_fanout_inflation(L: dict[str, DataFrame]) -> DataFrame:
    """Delivered item revenue, and what a naive items x payments x reviews join would report — computed from
    per-order multiplicities, without performing the fan-out join."""
    _, pay_fold, rev_fold = _order_folds(L)
    delivered = L["orders"].filter(F.col("order_status") == "delivered").select("order_id")
    items = L["items"].join(delivered, "order_id", "left_semi").select(
        "order_id", money_cents(F.col("price"), True).alias("cents"))
    j = items.join(pay_fold.select("order_id", "pay_rows"), "order_id", "left") \
        .join(rev_fold.select("order_id", "rev_rows"), "order_id", "left")
    w = F.coalesce("pay_rows", F.lit(1)) * F.coalesce("rev_rows", F.lit(1))
    return j.agg(F.coalesce(F.sum("cents"), _zero()).alias("delivered_item_revenue_cents"),
                 F.count(F.lit(1)).alias("delivered_item_rows"),
                 F.coalesce(F.sum(F.col("cents") * w), _zero()).alias("naive_items_payments_reviews_revenue_cents"))


def _parsed_orders(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", "order_status",
                         *[strict_timestamp(F.col(c)).alias(c) for c in DATE_COLUMNS["orders"]])


def profile_delivery(orders: DataFrame) -> DataFrame:
    o = _parsed_orders(orders)
    delivered = F.col("order_status") == "delivered"
    dlv, est = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    eligible = delivered & dlv.isNotNull() & est.isNotNull()
    late = F.to_date(dlv) > F.to_date(est)
    return o.agg(F.count_if(eligible).alias("delivery_eligible_orders"),
                 F.count_if(eligible & late).alias("late_orders"))


def delivery_days(orders: DataFrame) -> DataFrame:
    o = _parsed_orders(orders).filter(F.col("order_status") == "delivered")
    return o.select((F.expr("timestampdiff(SECOND, order_purchase_timestamp, order_delivered_customer_date)")
                     / 86400).alias("delivery_days"))


def profile_chronology(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    o = _parsed_orders(orders)
    p = F.col("order_purchase_timestamp")
    row = o.agg(
        F.count_if(F.col("order_approved_at") < p).alias("approval_before_purchase"),
        F.count_if(F.col("order_delivered_carrier_date") < p).alias("carrier_before_purchase"),
        F.count_if(F.col("order_delivered_customer_date") < p).alias("delivery_before_purchase"),
        F.count_if(F.col("order_delivered_customer_date") < F.col("order_delivered_carrier_date"))
        .alias("delivery_before_carrier"),
        F.count_if(F.to_date("order_estimated_delivery_date") < F.to_date(p)).alias("estimate_before_purchase_day"))
    rv = reviews.agg(F.count_if(strict_timestamp(F.col("review_answer_timestamp"))
                                < strict_timestamp(F.col("review_creation_date")))
                     .alias("review_answer_before_creation"))
    return row.crossJoin(rv)


def profile_child_coverage(L: dict[str, DataFrame]) -> DataFrame:
    o = _parsed_orders(L["orders"])
    has = lambda t, name: L[t].select("order_id").distinct().withColumn(name, F.lit(True))
    j = o.join(has("items", "has_items"), "order_id", "left").join(has("payments", "has_pay"), "order_id", "left") \
        .join(has("reviews", "has_rev"), "order_id", "left")
    d = F.col("order_status") == "delivered"
    no = lambda c: F.col(c).isNull()
    return j.agg(
        F.count_if(no("has_items")).alias("orders_missing_items"),
        F.count_if(d & no("has_items")).alias("delivered_missing_items"),
        F.count_if(no("has_pay")).alias("orders_missing_payments"),
        F.count_if(d & no("has_pay")).alias("delivered_missing_payments"),
        F.count_if(no("has_rev")).alias("orders_missing_reviews"),
        F.count_if(d & no("has_rev")).alias("delivered_missing_reviews"),
        F.count_if(d & no("order_approved_at")).alias("delivered_missing_approval"),
        F.count_if(d & no("order_delivered_carrier_date")).alias("delivered_missing_carrier"),
        F.count_if(d & no("order_delivered_customer_date")).alias("delivered_missing_delivery"))


def _delivered_frequency(L: dict[str, DataFrame]) -> DataFrame:
    o = L["orders"].filter(F.col("order_status") == "delivered").select("customer_id")
    c = L["customers"].select("customer_id", "customer_unique_id")
    return o.join(c, "customer_id").groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("orders"))


def profile_repeat(L: dict[str, DataFrame]) -> DataFrame:
    f = _delivered_frequency(L)
    all_c = L["customers"].agg(F.count_distinct("customer_unique_id").alias("unique_customers_all"))
    return all_c.crossJoin(f.agg(F.count(F.lit(1)).alias("unique_customers_delivered"),
                                 F.count_if(F.col("orders") >= 2).alias("repeat_customers_delivered_full_window")))


def profile_orders_per_customer(L: dict[str, DataFrame]) -> DataFrame:
    return _delivered_frequency(L).groupBy(F.col("orders").alias("orders_per_customer")) \
        .agg(F.count(F.lit(1)).alias("customers"))


def profile_multiplicity(L: dict[str, DataFrame]) -> DataFrame:
    item_fold, pay_fold, rev_fold = _order_folds(L)
    a = item_fold.agg(F.count_if(F.col("item_rows") > 1).alias("orders_with_multiple_items"),
                      F.count_if(F.col("sellers") > 1).alias("orders_with_multiple_sellers"))
    b = pay_fold.agg(F.count_if(F.col("pay_rows") > 1).alias("orders_with_multiple_payments"))
    c = rev_fold.agg(F.count_if(F.col("rev_rows") > 1).alias("orders_with_multiple_reviews"))
    d = L["orders"].agg(F.count_distinct("customer_id").alias("orders_distinct_customer_ids"))
    e = L["customers"].join(L["orders"].select("customer_id").distinct(), "customer_id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("customers_without_orders"))
    return a.crossJoin(b).crossJoin(c).crossJoin(d).crossJoin(e)


def profile_missing_by_status(L: dict[str, DataFrame]) -> DataFrame:
    """Per known status: orders without items and per date column the orders missing it."""
    spark = L["orders"].sparkSession
    o = _parsed_orders(L["orders"]).join(
        L["items"].select("order_id").distinct().withColumn("_has", F.lit(True)), "order_id", "left")
    agg = o.groupBy(F.col("order_status").alias("status")).agg(
        F.count_if(F.col("_has").isNull()).alias("missing_items"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in DATE_COLUMNS["orders"]])
    domain = spark.createDataFrame([(s,) for s in ORDER_STATUSES], "status string")
    cols = ["missing_items"] + [f"missing_{c}" for c in DATE_COLUMNS["orders"]]
    return F.broadcast(domain).join(agg, "status", "left").select(
        "status", *[F.coalesce(c, _zero()).alias(c) for c in cols])


def profile_out_of_horizon(items: DataFrame, horizon: str = "2019-01-01 00:00:00") -> DataFrame:
    ts = strict_timestamp(F.col("shipping_limit_date"))
    late = ts >= F.lit(horizon).cast("timestamp_ntz")
    return items.agg(F.count_if(late).alias("shipping_limit_after_horizon_rows"),
                     F.count_distinct(F.when(late, F.col("order_id"))).alias("shipping_limit_after_horizon_orders"))


def profile_blank_text(reviews: DataFrame, columns=("review_comment_title", "review_comment_message")) -> DataFrame:
    long = _long(reviews.select(*columns), list(columns))
    v = F.col("value")
    return long.groupBy("column").agg(F.count_if(v == "").alias("empty"),
                                      F.count_if((v != "") & is_missing(v)).alias("whitespace_only"))


def profile_review_ids(reviews: DataFrame) -> DataFrame:
    score = F.expr("try_cast(trim(review_score) as double)")
    invalid = score.isNull() | ~score.between(1, 5) | (score != F.floor(score))
    pairs = reviews.groupBy("review_id", "order_id").count().agg(
        F.coalesce(F.sum(F.col("count") - 1), _zero()).alias("reviews_duplicate_id_order_pairs"))
    return reviews.agg(F.count_distinct("order_id").alias("reviews_unique_orders"),
                       F.count_distinct("review_id").alias("reviews_unique_ids"),
                       F.count_if(invalid).alias("reviews_invalid_scores")).crossJoin(pairs)


def profile_categories(products: DataFrame) -> DataFrame:
    c = F.col("product_category_name")
    return products.agg(F.count_distinct(F.when(~is_missing(c), c)).alias("raw_categories"))


def profile_geo(geo: DataFrame) -> DataFrame:
    lat = F.expr("try_cast(geolocation_lat as double)")
    lng = F.expr("try_cast(geolocation_lng as double)")
    per = geo.groupBy("geolocation_zip_code_prefix").agg(
        F.count_distinct("geolocation_state").alias("states"), F.count_distinct("geolocation_city").alias("cities"))
    a = per.agg(F.count(F.lit(1)).alias("geolocation_unique_postcodes"),
                F.count_if(F.col("states") > 1).alias("geolocation_postcodes_multiple_states"),
                F.count_if(F.col("cities") > 1).alias("geolocation_postcodes_multiple_city_spellings"))
    (la0, la1), (lo0, lo1) = COARSE_BOX["lat"], COARSE_BOX["lng"]
    b = geo.agg(
        F.count_if(lat.isNull() | lng.isNull() | ~lat.between(-90, 90) | ~lng.between(-180, 180))
        .alias("geolocation_invalid_global_coordinates"),
        F.count_if(~F.coalesce(lat.between(la0, la1), F.lit(False)) | ~F.coalesce(lng.between(lo0, lo1), F.lit(False)))
        .alias("geolocation_outside_coarse_box"))
    return a.crossJoin(b)


def profile_numeric_sanity(L: dict[str, DataFrame]) -> DataFrame:
    """Per numeric column: invalid non-missing, negative, zero and fractional values."""
    out = None
    for table, cols in NUMERIC_COLUMNS.items():
        long = _long(L[table].select(*cols), cols)
        v = F.col("value")
        num = F.expr("try_cast(trim(value) as double)")
        miss = is_missing(v)
        part = long.groupBy("column").agg(
            F.count_if(~miss & num.isNull()).alias("invalid_nonmissing"), F.count_if(num < 0).alias("negative"),
            F.count_if(num == 0).alias("zero"), F.count_if(num.isNotNull() & (num != F.floor(num))).alias("fractional"))
        part = part.select(F.lit(table).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def field_dictionary(registry: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each profiled landing column with its declared meaning, logical type and domain (NULL = undeclared)."""
    return profiles.withColumnRenamed("column", "name").join(F.broadcast(registry), "name", "left").select(
        "table", "name", "logical_type", "meaning", "domain", "missing", "distinct_nonmissing")


def audit_crosscheck(L: dict[str, DataFrame]) -> DataFrame:
    """Independent recount: missingness by a second formulation and delivered money two ways, as
    (check, actual, expected, passed) rows."""
    orders = L["orders"]
    miss_a = orders.agg(F.count_if(trimmed(F.col("order_delivered_customer_date")) == "").alias("n"))
    miss_b = orders.agg(F.sum(F.when(F.length(F.regexp_replace("order_delivered_customer_date", r"\s", "")) == 0, 1)
                              .otherwise(0)).cast("bigint").alias("n"))
    delivered = orders.filter(F.col("order_status") == "delivered").select("order_id")
    cents = money_cents(F.col("price"), True)
    money_a = L["items"].join(delivered, "order_id", "left_semi").agg(F.coalesce(F.sum(cents), _zero()).alias("n"))
    per_order = L["items"].groupBy("order_id").agg(F.sum(cents).alias("c"))
    money_b = per_order.join(delivered, "order_id").agg(F.coalesce(F.sum("c"), _zero()).alias("n"))
    rows = [miss_a.crossJoin(miss_b.withColumnRenamed("n", "e")).select(
        F.lit("missing_delivery_dates").alias("check"), F.col("n").alias("actual"), F.col("e").alias("expected")),
        money_a.crossJoin(money_b.withColumnRenamed("n", "e")).select(
            F.lit("delivered_item_revenue_cents").alias("check"), F.col("n").alias("actual"),
            F.col("e").alias("expected"))]
    return rows[0].unionByName(rows[1]).withColumn("passed", F.col("actual") == F.col("expected"))
