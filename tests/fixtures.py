"""Hand-countable fixtures (warehouse F3, raw landing F2) as literal data."""
from __future__ import annotations

import csv
import os
from datetime import date, datetime

from retailq.sources.landing import FILES

TS = lambda s: datetime.fromisoformat(s) if s else None

FACT_ORDER_SCHEMA = ("order_id string, customer_id string, purchase_at timestamp_ntz, purchase_date date, "
                     "status string, carrier_at timestamp_ntz, delivered_at timestamp_ntz, estimated_at timestamp_ntz, "
                     "revenue_cents bigint, freight_cents bigint, item_count int, payment_cents bigint, "
                     "payment_count int, review_score int, review_count int, delivery_seconds bigint, is_late int, "
                     "quality_flags array<string>")


def _order(oid, cid, ts, status, revenue, items, payment, pcount, rcount, score, late, seconds):
    t = TS(ts)
    return (oid, cid, t, t.date(), status, None, None, None, revenue, 1000, items, payment, pcount, score, rcount,
            seconds, late, [])


def warehouse_star(spark):
    orders = [
        _order("o1", "c1", "2018-07-01 00:00:00", "delivered", 15001, 2, 16001, 2, 3, 5, 0, 86400),
        _order("o2", "c2", "2018-07-31 23:59:59", "delivered", 20000, 1, None, 0, 0, None, None, None),
        _order("o3", "c3", "2018-07-02 12:00:00", "delivered", 10000, 2, 11000, 2, 1, 2, 1, 172800),
        _order("o4", "c4", "2018-07-02 00:00:00", "canceled", 99999, 1, 100999, 2, 0, None, None, None),
        _order("o5", "c5", "2018-06-30 23:59:59", "delivered", 10000, 1, 11000, 2, 0, None, None, None),
        _order("o6", "c6", "2018-08-01 00:00:00", "delivered", 3000, 1, 4000, 2, 0, None, None, None),
    ]
    items = [("o1", 1, "a", 10001), ("o1", 2, "b", 5000), ("o2", 1, "a", 20000), ("o3", 1, "a", 4000),
             ("o3", 2, "b", 6000), ("o4", 1, "a", 99999), ("o5", 1, "a", 10000), ("o6", 1, "a", 3000)]
    return {
        "fact_order": spark.createDataFrame(orders, FACT_ORDER_SCHEMA),
        "fact_item": spark.createDataFrame([(o, i, p, "s1", c, 500) for o, i, p, c in items],
                                           "order_id string, item_id int, product_id string, seller_id string, "
                                           "price_cents bigint, freight_cents bigint"),
        "dim_customer": spark.createDataFrame(
            [("c1", "u1", "SP"), ("c2", "u1", "SP"), ("c3", "u3", "RJ"), ("c4", "u4", "SP"), ("c5", "u5", "SP"),
             ("c6", "u6", "SP")], "customer_id string, customer_unique_id string, state string"),
        "dim_product": spark.createDataFrame([("a", "cat_a", "Category A"), ("b", "cat_b", None)],
                                             "product_id string, category string, category_english string"),
        "dim_seller": spark.createDataFrame([("s1", "SP")], "seller_id string, state string"),
    }


OBSERVED = (date(2017, 1, 1), date(2018, 8, 29))

RAW = {
    "orders": [["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
               ["order-a", "customer-a", "delivered", "2018-07-01 12:00:00", "", "2018-06-30 12:00:00",
                "2018-07-03 23:30:00", "2018-07-03 00:00:00"],
               ["order-b", "customer-b", "delivered", "2018-07-02 12:00:00", "", "2018-07-06 12:00:00",
                "2018-07-05 12:00:00", "2018-07-04 00:00:00"],
               ["order-c", "customer-c", "delivered", "2018-07-03 12:00:00", "", "", "", "2018-07-04 00:00:00"],
               ["order-d", "customer-d", "canceled", "2018-07-04 12:00:00", "", "", "", ""],
               ["order-e", "customer-e", "processing", "2018-07-05 12:00:00", "", "", "", ""]],
    "items": [["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
              ["order-a", "1", "product-a", "seller-a", "2018-07-03 12:00:00", "100.00", "10.00"],
              ["order-a", "2", "product-b", "seller-b", "2018-07-03 12:00:00", "50.00", "5.00"],
              ["order-b", "1", "product-a", "seller-a", "2018-07-03 12:00:00", "200.00", "20.00"],
              ["order-c", "1", "product-c", "seller-a", "2018-07-03 12:00:00", "100.00", "10.00"],
              ["order-d", "1", "product-a", "seller-a", "2018-07-03 12:00:00", "999.00", "0.00"]],
    "customers": [["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
                  ["customer-a", "person-ab", "01000", "sao paulo", "SP"],
                  ["customer-b", "person-ab", "01000", "sao paulo", "SP"],
                  ["customer-c", "person-c", "20000", "rio", "RJ"],
                  ["customer-d", "person-d", "30000", "bh", "MG"],
                  ["customer-e", "person-e", "01000", "sao paulo", "SP"]],
    "products": [["product_id", "product_category_name"], ["product-a", "casa"], ["product-b", ""],
                 ["product-c", "sem_traducao"]],
    "sellers": [["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
                ["seller-a", "01000", "sao paulo", "SP"], ["seller-b", "20000", "rio", "RJ"]],
    "payments": [["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
                 ["order-a", "1", "credit_card", "1", "100.00"], ["order-a", "2", "voucher", "1", "65.00"],
                 ["order-c", "1", "credit_card", "1", "110.00"], ["order-d", "1", "credit_card", "1", "999.00"]],
    "reviews": [["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                 "review_creation_date", "review_answer_timestamp"],
                ["review-shared", "order-a", "1", "", "", "2018-07-03 00:00:00", "2018-07-05 00:00:00"],
                ["review-z", "order-a", "2", "", "", "2018-07-04 00:00:00", "2018-07-05 00:00:00"],
                ["review-zz", "order-a", "3", "", "", "2018-07-04 00:00:00", "2018-07-05 00:00:00"],
                ["review-zz", "order-a", "5", "", "", "2018-07-04 00:00:00", "2018-07-05 00:00:00"],
                ["review-shared", "order-b", "4", "", "", "2018-07-04 00:00:00", "2018-07-05 00:00:00"]],
    "translation": [["product_category_name", "product_category_name_english"], ["casa", "home"]],
}


def write_raw(directory: str, raw: dict | None = None) -> str:
    raw = raw or RAW
    os.makedirs(directory, exist_ok=True)
    for name, rows in raw.items():
        with open(os.path.join(directory, FILES[name]), "w", newline="", encoding="utf-8") as fh:
            csv.writer(fh).writerows(rows)
    return directory


def mutate(raw: dict, table: str, row: int, column: str, value: str) -> dict:
    out = {k: [list(r) for r in v] for k, v in raw.items()}
    idx = out[table][0].index(column)
    out[table][row][idx] = value
    return out
