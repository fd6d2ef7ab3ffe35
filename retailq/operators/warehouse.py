"""Warehouse transforms: folds of one-to-many children, order flags, dimensions, facts, daily aggregate.

Every child table is folded to order grain with a hash aggregate (partial aggregation map-side) *before* it meets
the orders, so items x payments x reviews never multiply money. All folds are keyed on ``order_id``; the three left
joins then run on children that are already hash-partitioned by that key.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import QUALITY_FLAGS
from ..sources.landing import RECORD

STAR_TABLES = ("dim_customer", "dim_product", "dim_seller", "fact_order", "fact_item", "agg_day", "customer_first")


# ---- dimensions -------------------------------------------------------------------------------------------------

def _unknown(col: str) -> F.Column:
    return F.when(F.coalesce(F.col(col), F.lit("")) == "", F.lit("unknown")).otherwise(F.col(col))


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", _unknown("customer_state").alias("state"))


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Empty category -> 'unknown'; left join the translation; unmatched or empty english -> NULL."""
    tr = translation.select(F.col("product_category_name").alias("_cat"),
                            F.when(F.col("product_category_name_english") == "", None)
                            .otherwise(F.col("product_category_name_english")).alias("category_english"))
    return (products.join(tr, products["product_category_name"] == tr["_cat"], "left")
            .select("product_id", _unknown("product_category_name").alias("category"), "category_english"))


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", _unknown("seller_state").alias("state"))


# ---- folds ------------------------------------------------------------------------------------------------------

def fold_items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum("price_cents").alias("revenue_cents"),
                                         F.sum("freight_cents").alias("freight_cents"),
                                         F.count(F.lit(1)).cast("int").alias("item_count"))


def fold_payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_cents").alias("payment_cents"),
                                            F.count(F.lit(1)).cast("int").alias("payment_count"))


def latest_review_per_order(reviews: DataFrame) -> DataFrame:
    """Score of the latest review by (answered, created, review_id), of equal ones the last record of the input. Tables
    that carry no record places end on the score."""
    last = RECORD if RECORD in reviews.columns else "review_score"
    rank = F.struct("answered_at", "created_at", "review_id", last)
    return reviews.groupBy("order_id").agg(F.max_by("review_score", rank).cast("int").alias("review_score"),
                                           F.count(F.lit(1)).cast("int").alias("review_count"))


# ---- per-order expressions --------------------------------------------------------------------------------------

def _flag_conditions() -> dict[str, F.Column]:
    purchase, carrier, delivery = F.col("purchase_at"), F.col("carrier_at"), F.col("delivered_at")
    delivered = F.col("status") == "delivered"
    items, pays, revs = F.col("item_count"), F.col("payment_count"), F.col("review_count")
    return {
        "carrier_before_purchase": carrier.isNotNull() & (carrier < purchase),
        "delivery_before_carrier": delivery.isNotNull() & carrier.isNotNull() & (delivery < carrier),
        "delivery_before_purchase": delivery.isNotNull() & (delivery < purchase),
        "delivered_missing_delivery_date": delivered & delivery.isNull(),
        "delivered_missing_estimated_date": delivered & F.col("estimated_at").isNull(),
        "missing_items": items == 0,
        "missing_payment": pays == 0,
        "payment_total_mismatch": (pays > 0) & (items > 0)
        & (F.col("payment_cents") != F.col("revenue_cents") + F.col("freight_cents")),
        "missing_review": revs == 0,
        "multiple_reviews": revs > 1,
    }


def quality_flags_array() -> F.Column:
    """Ordered list of fired flags (fixed order of QUALITY_FLAGS)."""
    cond = _flag_conditions()
    return F.array_compact(F.array(*[F.when(cond[name], F.lit(name)) for name in QUALITY_FLAGS]))


def delivery_duration() -> F.Column:
    judgeable = (F.col("status") == "delivered") & F.col("delivered_at").isNotNull() \
        & (F.col("delivered_at") >= F.col("purchase_at"))
    return F.when(judgeable, F.expr("timestampdiff(SECOND, purchase_at, delivered_at)")).cast("bigint")


def late_flag() -> F.Column:
    """Calendar day of delivery after the estimated day; NULL when not judgeable."""
    judgeable = (F.col("status") == "delivered") & F.col("delivered_at").isNotNull() \
        & F.col("estimated_at").isNotNull() & (F.col("delivered_at") >= F.col("purchase_at"))
    return F.when(judgeable, (F.to_date("delivered_at") > F.to_date("estimated_at")).cast("int"))


# ---- facts ------------------------------------------------------------------------------------------------------

def fact_item(items: DataFrame) -> DataFrame:
    return items.select("order_id", F.col("item_id").cast("int").alias("item_id"), "product_id", "seller_id",
                        "price_cents", "freight_cents")


def fact_order(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """orders left-joined to the three order-grain folds; revenue 0 when no items, payment NULL when none."""
    base = orders.select("order_id", "customer_id", "purchase_at", F.to_date("purchase_at").alias("purchase_date"),
                         F.col("order_status").alias("status"), "carrier_at", "delivered_at", "estimated_at")
    joined = (base.join(fold_items_per_order(items), "order_id", "left")
              .join(fold_payments_per_order(payments), "order_id", "left")
              .join(latest_review_per_order(reviews), "order_id", "left")
              .withColumns({"revenue_cents": F.coalesce("revenue_cents", F.lit(0).cast("bigint")),
                            "freight_cents": F.coalesce("freight_cents", F.lit(0).cast("bigint")),
                            "item_count": F.coalesce("item_count", F.lit(0)),
                            "payment_count": F.coalesce("payment_count", F.lit(0)),
                            "review_count": F.coalesce("review_count", F.lit(0))}))
    return joined.select("order_id", "customer_id", "purchase_at", "purchase_date", "status", "carrier_at",
                         "delivered_at", "estimated_at", "revenue_cents", "freight_cents", "item_count",
                         "payment_cents", "payment_count", "review_score", "review_count",
                         delivery_duration().alias("delivery_seconds"), late_flag().alias("is_late"),
                         quality_flags_array().alias("quality_flags"))


def agg_day(fact_orders: DataFrame) -> DataFrame:
    return (fact_orders.filter(F.col("status") == "delivered").groupBy(F.col("purchase_date").alias("day"))
            .agg(F.sum("revenue_cents").alias("revenue_cents"), F.count(F.lit(1)).cast("int").alias("order_count"),
                 F.sum("item_count").cast("int").alias("item_count")))


def customer_first(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """First delivered purchase day per stable customer over the whole history (one row per customer). For any
    customer with a purchase in a window, this equals the first purchase up to the window's end, so customer
    requests filter this table instead of scanning the order fact."""
    return (fact_orders.filter(F.col("status") == "delivered")
            .join(dim_customers.select("customer_id", "customer_unique_id"), "customer_id")
            .groupBy("customer_unique_id").agg(F.min("purchase_date").alias("first_day")))


def build_star(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed raw model -> star schema (lazy)."""
    fo = fact_order(raw["orders"], raw["items"], raw["payments"], raw["reviews"])
    dc = dim_customer(raw["customers"])
    return {"dim_customer": dc,
            "dim_product": dim_product(raw["products"], raw["translation"]),
            "dim_seller": dim_seller(raw["sellers"]),
            "fact_order": fo, "fact_item": fact_item(raw["items"]), "agg_day": agg_day(fo),
            "customer_first": customer_first(fo, dc)}


# ---- load profile (receipt contents) ----------------------------------------------------------------------------

def load_profile(raw: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """One row: raw/delivered counts, delivered revenue, observed window, per-flag counts, collapsed reviews,
    products missing category / translation."""
    fo = star["fact_order"]
    delivered = F.col("status") == "delivered"
    flag_counts = [F.sum(F.array_contains("quality_flags", name).cast("int")).cast("bigint").alias(f"flag_{name}")
                   for name in QUALITY_FLAGS]
    orders_row = fo.agg(
        F.count(F.lit(1)).alias("raw_order_count"),
        F.count_if(delivered).alias("delivered_order_count"),
        F.coalesce(F.sum(F.when(delivered, F.col("revenue_cents"))), F.lit(0).cast("bigint"))
        .alias("delivered_revenue_cents"),
        F.min(F.when(delivered, F.col("purchase_date"))).alias("observed_start"),
        F.max(F.when(delivered, F.col("purchase_date"))).alias("observed_end"),
        (F.sum("review_count") - F.count_if(F.col("review_count") > 0)).alias("review_rows_collapsed"),
        *flag_counts)
    dp = star["dim_product"]
    products_row = dp.agg(F.count_if(F.col("category") == "unknown").alias("products_missing_category"),
                          F.count_if((F.col("category") != "unknown") & F.col("category_english").isNull())
                          .alias("products_missing_translation"))
    return orders_row.crossJoin(products_row)
