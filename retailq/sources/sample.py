"""The small orders/items sample pair: its own strict checks and the two-level overview aggregate."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import money_cents, money_valid, positive_int_valid
from ..operators.checks import chk_foreign_key, require_clean, row_checks, union_all

# Fixed values of the sample pair.
SAMPLE_STATUSES = ("delivered", "canceled", "processing")
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def sample_violations(orders: DataFrame, items: DataFrame) -> DataFrame:
    o_checks = [("domain", "status", ~F.coalesce(F.col("status").isin(*SAMPLE_STATUSES), F.lit(False)),
                 F.col("order_id")),
                ("date", "purchased_at", ~F.coalesce(F.col("purchased_at").rlike(ISO_DATE)
                                                      & F.col("purchased_at").try_cast("date").isNotNull(),
                                                      F.lit(False)), F.col("order_id"))]
    i_checks = [("positive_int", "item_id", ~positive_int_valid(F.col("item_id")), F.col("order_id")),
                ("money", "price", ~money_valid(F.col("price")), F.col("order_id"))]
    delivered_without_items = orders.filter(F.col("status") == "delivered").join(
        items.select("order_id").distinct(), "order_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("delivered_has_items").alias("constraint"), F.lit("orders").alias("table"),
        F.lit("order_id").alias("column"), "n", F.lit(None).cast("string").alias("sample_key"))
    return union_all([row_checks(orders, "orders", o_checks), row_checks(items, "items", i_checks),
                      chk_foreign_key(items, "items", "order_id", orders, "order_id"), delivered_without_items])


def overview(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders, revenue (item price, cents) and AOV: fold items to orders first, then aggregate."""
    totals = orders.filter(F.col("status") == "delivered").select("order_id").join(
        items.select("order_id", money_cents(F.col("price")).alias("cents")), "order_id") \
        .groupBy("order_id").agg(F.sum("cents").alias("amount_cents"))
    return totals.agg(F.count(F.lit(1)).alias("order_count"),
                      F.coalesce(F.sum("amount_cents"), F.lit(0).cast("bigint")).alias("revenue_cents")) \
        .withColumn("average_order_value_cents",
                    F.try_divide(F.col("revenue_cents").cast("double"), F.col("order_count")))


def checked_overview(orders: DataFrame, items: DataFrame) -> DataFrame:
    require_clean(sample_violations(orders, items))
    return overview(orders, items)
