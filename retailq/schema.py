"""Declared landing fields and star-schema types. Landing columns outside the registry are an error in the audit."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 45 declared landing fields as (name, logical type / unit, meaning, domain note).
FIELDS = [
    ("order_id", "identifier", "order key", "non-empty, <= 64 chars"),
    ("customer_id", "identifier", "per-order customer key", "non-empty, <= 64 chars"),
    ("order_status", "enum", "final order status", "8 known statuses"),
    ("order_purchase_timestamp", "timestamp", "purchase time, zone-free", "YYYY-MM-DD HH:MM:SS, required"),
    ("order_approved_at", "timestamp", "payment approval time", "optional"),
    ("order_delivered_carrier_date", "timestamp", "handed to carrier", "optional"),
    ("order_delivered_customer_date", "timestamp", "delivered to customer", "optional"),
    ("order_estimated_delivery_date", "timestamp", "promised delivery day", "optional"),
    ("order_item_id", "sequence", "item position inside the order", "positive integer"),
    ("product_id", "identifier", "product key", "non-empty, <= 64 chars"),
    ("seller_id", "identifier", "seller key", "non-empty, <= 64 chars"),
    ("shipping_limit_date", "timestamp", "seller hand-over deadline", "optional"),
    ("price", "money", "item price", ">= 0, <= 2 decimals"),
    ("freight_value", "money", "item freight", ">= 0, <= 2 decimals"),
    ("customer_unique_id", "identifier", "stable customer identity", "non-empty, <= 64 chars"),
    ("customer_zip_code_prefix", "code", "customer postcode prefix", "text, keep leading zeros"),
    ("customer_city", "text", "customer city", "free spelling"),
    ("customer_state", "code", "customer state", "<= 8 chars, empty = unknown"),
    ("product_category_name", "code", "product category (source language)", "<= 128 chars, empty = unknown"),
    ("product_name_lenght", "count", "characters in the product name", "integer >= 0"),
    ("product_description_lenght", "count", "characters in the description", "integer >= 0"),
    ("product_photos_qty", "count", "number of product photos", "integer >= 0"),
    ("product_weight_g", "measure g", "product weight", ">= 0"),
    ("product_length_cm", "measure cm", "product length", ">= 0"),
    ("product_height_cm", "measure cm", "product height", ">= 0"),
    ("product_width_cm", "measure cm", "product width", ">= 0"),
    ("seller_zip_code_prefix", "code", "seller postcode prefix", "text, keep leading zeros"),
    ("seller_city", "text", "seller city", "free spelling"),
    ("seller_state", "code", "seller state", "<= 8 chars, empty = unknown"),
    ("payment_sequential", "sequence", "payment position inside the order", "positive integer"),
    ("payment_type", "enum", "payment method", "text"),
    ("payment_installments", "count", "number of installments", "integer >= 0"),
    ("payment_value", "money", "amount paid", ">= 0, <= 2 decimals"),
    ("review_id", "identifier", "review key (may repeat)", "non-empty, <= 64 chars"),
    ("review_score", "rating", "review score", "integer 1..5"),
    ("review_comment_title", "text", "review title", "optional free text"),
    ("review_comment_message", "text", "review message", "optional free text"),
    ("review_creation_date", "timestamp", "review sent", "optional"),
    ("review_answer_timestamp", "timestamp", "review answered", "optional"),
    ("geolocation_zip_code_prefix", "code", "postcode prefix", "text"),
    ("geolocation_lat", "degrees", "latitude", "-90..90"),
    ("geolocation_lng", "degrees", "longitude", "-180..180"),
    ("geolocation_city", "text", "city spelling", "free spelling"),
    ("geolocation_state", "code", "state", "text"),
    ("product_category_name_english", "text", "category label in English", "<= 128 chars, optional"),
]
FIELD_NAMES = frozenset(f[0] for f in FIELDS)


def field_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIELDS, "name string, logical_type string, meaning string, domain string")
