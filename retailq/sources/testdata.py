"""Adapter: the driver's TPC-H-like parquet tables -> the typed raw retail model.

Mapping (all DataFrame expressions, nothing passes through the driver):
  orders       o_orderkey/o_custkey; status F->delivered, P->processing, O->shipped; purchase = o_orderdate;
               carrier/delivered = min/max l_shipdate of the order; estimate = o_orderdate + 900 days
  items        lineitem; item_id = l_linenumber; price = round(l_extendedprice*100) cents;
               freight = price * round(l_tax*100) div 100
  payments     lineitem rows with l_linestatus = 'F', value = price + freight
  reviews      lineitem rows with l_returnflag = 'R'; id = l_partkey; created = l_shipdate;
               answered = l_shipdate + l_quantity days; score = 1 + int(l_quantity) % 5
  customers    c_custkey; stable identity = c_custkey div 2; state = nation name
  products     p_partkey; category = p_type ('PROMO' counts as missing)
  sellers      s_suppkey; state = nation name
  translation  four fixed rows below (STANDARD stays untranslated)
"""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import AnomalyRules, Coverage, Profile, RfmRules, ScopeParams

# Fixed values of the adapter.
STATUS_MAP = {"F": "delivered", "P": "processing", "O": "shipped"}
TRANSLATION = [("ECONOMY", "Economy"), ("SMALL", "Small"), ("LARGE", "Large"), ("MEDIUM", "Medium")]
ESTIMATE_DAYS = 900
MISSING_CATEGORY = "PROMO"

# Parameters that make the rules meaningful on the generated dates (1995..2001).
TEST_PROFILE = Profile(
    scope=ScopeParams(date(1997, 1, 1), date(1998, 12, 31)),
    coverage=Coverage(date(1996, 1, 1), date(2000, 12, 31)),
    rfm=RfmRules(recent_days=180, repeat_orders=2, amount_cents=40_000_000),
    anomaly=AnomalyRules(floor=3),
)
ANOMALY_SCOPE = ScopeParams(date(1995, 1, 1), date(2001, 12, 31), statuses=tuple(STATUS_MAP.values()))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in names}


def _cents(col: str) -> F.Column:
    return F.round(F.col(col) * 100).cast("bigint")


def _items_base(lineitem: DataFrame) -> DataFrame:
    price = _cents("l_extendedprice")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_at"), price.alias("price_cents"),
        F.expr("cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint) div 100")
        .alias("freight_cents"),
        "l_quantity", "l_returnflag", "l_linestatus")


def raw_model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Typed raw tables (the same shape the CSV landing path produces after its checks)."""
    t = read_tables(spark, sf_dir)
    li = _items_base(t["lineitem"])
    status = F.col("o_orderstatus")
    status_expr = F.when(status == "F", "delivered").when(status == "P", "processing").when(status == "O", "shipped") \
        .otherwise(F.lower(status))
    ship = t["lineitem"].groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("carrier_at"), F.max("l_shipdate").alias("delivered_at"))
    orders = (t["orders"].select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        status_expr.alias("order_status"), F.col("o_orderdate").alias("purchase_at"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.expr(f"timestampadd(DAY, {ESTIMATE_DAYS}, o_orderdate)").alias("estimated_at"))
        .join(ship, "order_id", "left")
        .select("order_id", "customer_id", "order_status", "purchase_at", "approved_at",
                "carrier_at", "delivered_at", "estimated_at"))
    items = li.select("order_id", "item_id", "product_id", "seller_id", "shipping_limit_at",
                      "price_cents", "freight_cents")
    payments = li.filter(F.col("l_linestatus") == "F").select(
        "order_id", F.col("item_id").alias("payment_sequential"),
        (F.col("price_cents") + F.col("freight_cents")).alias("payment_cents"))
    reviews = t["lineitem"].filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("review_id"), F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("review_score"),
        F.col("l_shipdate").alias("created_at"),
        F.expr("timestampadd(DAY, cast(l_quantity as int), l_shipdate)").alias("answered_at"))
    nation = t["nation"].select("n_nationkey", "n_name")
    customers = t["customer"].join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.expr("c_custkey div 2").alias("customer_unique_id"),
        F.coalesce(F.col("n_name"), F.lit("")).alias("customer_state"))
    products = t["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_type") == MISSING_CATEGORY, "").otherwise(F.coalesce(F.col("p_type"), F.lit("")))
        .alias("product_category_name"))
    sellers = t["supplier"].join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"), F.coalesce(F.col("n_name"), F.lit("")).alias("seller_state"))
    translation = spark.createDataFrame(TRANSLATION, "product_category_name string, product_category_name_english string")
    return {"orders": orders, "items": items, "payments": payments, "reviews": reviews, "customers": customers,
            "products": products, "sellers": sellers, "translation": translation}


# ---- landing form (all strings, as the CSV landing path reads them) ----------------------------------------------

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _ts_text(col: str) -> F.Column:
    return F.coalesce(F.date_format(F.col(col), TS_TEXT), F.lit(""))


def _money_text(cents: str) -> F.Column:
    """Exact decimal text of a non-negative integer cents column (no float formatting)."""
    return F.concat(F.expr(f"cast({cents} div 100 as string)"), F.lit("."),
                    F.lpad(F.expr(f"cast({cents} % 100 as string)"), 2, "0"))


def landing_model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """String tables with the declared landing columns (nine files incl. geolocation), derived from the test
    tables. Free-text and geo columns follow fixed rules of the source columns."""
    t = read_tables(spark, sf_dir)
    raw = raw_model(spark, sf_dir)
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    orders = raw["orders"].select(
        s("order_id").alias("order_id"), s("customer_id").alias("customer_id"),
        F.col("order_status"), _ts_text("purchase_at").alias("order_purchase_timestamp"),
        _ts_text("approved_at").alias("order_approved_at"), _ts_text("carrier_at").alias("order_delivered_carrier_date"),
        _ts_text("delivered_at").alias("order_delivered_customer_date"),
        _ts_text("estimated_at").alias("order_estimated_delivery_date"))
    items = raw["items"].select(
        s("order_id").alias("order_id"), s("item_id").alias("order_item_id"), s("product_id").alias("product_id"),
        s("seller_id").alias("seller_id"), _ts_text("shipping_limit_at").alias("shipping_limit_date"),
        _money_text("price_cents").alias("price"), _money_text("freight_cents").alias("freight_value"))
    payments = raw["payments"].select(
        s("order_id").alias("order_id"), s("payment_sequential").alias("payment_sequential"),
        F.lit("credit_card").alias("payment_type"), F.lit("1").alias("payment_installments"),
        _money_text("payment_cents").alias("payment_value"))
    li = t["lineitem"].filter(F.col("l_returnflag") == "R")
    reviews = li.select(
        s("l_partkey").alias("review_id"), s("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("string").alias("review_score"),
        F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(F.lit("ok")).alias("review_comment_title"),
        F.when(F.col("l_quantity") < 10, F.lit("  ")).otherwise(F.lit("text")).alias("review_comment_message"),
        _ts_text("l_shipdate").alias("review_creation_date"),
        F.date_format(F.expr("timestampadd(DAY, cast(l_quantity as int), l_shipdate)"), TS_TEXT)
        .alias("review_answer_timestamp"))
    nation = F.broadcast(t["nation"].select("n_nationkey", "n_name"))
    cust = t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    customers = cust.select(
        s("c_custkey").alias("customer_id"), F.expr("cast(c_custkey div 2 as string)").alias("customer_unique_id"),
        s("c_nationkey").alias("customer_zip_code_prefix"), F.lower(F.col("c_mktsegment")).alias("customer_city"),
        F.coalesce("n_name", F.lit("")).alias("customer_state"))
    sup = t["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    sellers = sup.select(
        s("s_suppkey").alias("seller_id"), s("s_nationkey").alias("seller_zip_code_prefix"),
        F.concat(F.lit("city_"), s("s_nationkey")).alias("seller_city"),
        F.coalesce("n_name", F.lit("")).alias("seller_state"))
    products = t["part"].select(
        s("p_partkey").alias("product_id"),
        F.when(F.col("p_type") == MISSING_CATEGORY, "").otherwise(s("p_type")).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"), F.lit("").alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("string").alias("product_photos_qty"), s("p_retailprice").alias("product_weight_g"),
        s("p_size").alias("product_length_cm"), F.lit("10").alias("product_height_cm"),
        F.lit("0").alias("product_width_cm"))
    translation = raw["translation"]
    geolocation = cust.select(
        s("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 100).cast("string").alias("geolocation_lat"),
        (-F.col("c_acctbal") / 50).cast("string").alias("geolocation_lng"),
        F.lower(F.col("c_mktsegment")).alias("geolocation_city"),
        F.coalesce("n_name", F.lit("")).alias("geolocation_state"))
    return {"orders": orders, "items": items, "customers": customers, "products": products, "sellers": sellers,
            "payments": payments, "reviews": reviews, "geolocation": geolocation, "translation": translation}
