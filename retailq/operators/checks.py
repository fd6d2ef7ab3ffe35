"""Data-quality constraints as violation tables, and the typing of landing text into the raw model.

Each check returns rows ``(constraint, table, column, n, sample_key)``; ``n`` counts offending rows over the whole
table and ``sample_key`` is one offending key (for tracing). ``require_clean`` is the strict wrapper: it runs all
checks as ONE job (a union of one-row aggregates) and raises when any ``n > 0``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import (MAX_CENTS, is_missing, money_cents, money_valid, positive_int_valid,
                               strict_timestamp)
from ..params import ORDER_STATUSES
from ..sources.landing import RECORD



def _zero() -> F.Column:
    return F.lit(0).cast("bigint")


class ConstraintViolation(ValueError):
    def __init__(self, rows):
        self.rows = rows
        super().__init__("; ".join(f"{r['constraint']} {r['table']}.{r['column']}: {r['n']}" for r in rows))


def _row(df: DataFrame, constraint: str, table: str, column: str, bad: F.Column, key: F.Column) -> DataFrame:
    return df.agg(F.count_if(bad).alias("n"), F.min(F.when(bad, key.cast("string"))).alias("sample_key")).select(
        F.lit(constraint).alias("constraint"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        "n", "sample_key")


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key. Built once per parent table and shared by its uniqueness check and every foreign-key check
    against it (same plan -> the shuffle exchange is reused within the violations job)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))


def chk_unique_key(df: DataFrame, table: str, keys: list[str], counts: DataFrame | None = None) -> DataFrame:
    """Key parts non-empty and the key unique (rows beyond the first of each key are counted)."""
    g = counts if counts is not None else key_counts(df, keys)
    empty = F.greatest(*[is_missing(F.col(k)) for k in keys]) if len(keys) > 1 else is_missing(F.col(keys[0]))
    key = F.concat_ws("|", *[F.col(k) for k in keys])
    g = g.filter((F.col("c") > 1) | empty)  # only offending keys reach the (string) sample aggregate
    return g.agg((F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), _zero())
                  + F.coalesce(F.sum(F.when(empty, F.col("c"))), _zero())).alias("n"),
                 F.min(F.when((F.col("c") > 1) | empty, key)).alias("sample_key")).select(
        F.lit("unique_key").alias("constraint"), F.lit(table).alias("table"), F.lit(",".join(keys)).alias("column"),
        "n", "sample_key")


def chk_string_length(df: DataFrame, table: str, column: str, limit: int, required: bool = True,
                      key: str | None = None) -> DataFrame:
    c = F.col(column)
    bad = F.char_length(c) > limit
    if required:
        bad = bad | (c == "")
    return _row(df, "string_length", table, column, bad, F.col(key or column))


def chk_money(df: DataFrame, table: str, column: str, key: str) -> DataFrame:
    return _row(df, "money", table, column, ~money_valid(F.col(column)), F.col(key))


def chk_positive_int(df: DataFrame, table: str, column: str, key: str) -> DataFrame:
    return _row(df, "positive_int", table, column, ~positive_int_valid(F.col(column)), F.col(key))


def chk_timestamp(df: DataFrame, table: str, column: str, key: str, required: bool = False) -> DataFrame:
    c = F.col(column)
    present = c != ""
    bad = present & strict_timestamp(c).isNull()
    if required:
        bad = bad | ~present
    return _row(df, "timestamp", table, column, bad, F.col(key))


def chk_foreign_key(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str,
                    parent_keys: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Child rows without a parent row: the child's row counts per key, anti-joined with the distinct parent keys, so
    that a key which many rows share is one row in the join. ``counts``: ``key_counts`` of the child, where shared."""
    keys = (parent_keys.select(F.col(parent_column).alias("_k")) if parent_keys is not None
            else parent.select(F.col(parent_column).alias("_k")).distinct())
    rows = counts if counts is not None else key_counts(child, [column])
    orphans = rows.withColumnRenamed(column, "_k").join(keys, "_k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("c"), _zero()).alias("n"), F.min("_k").cast("string").alias("sample_key")).select(
        F.lit("foreign_key").alias("constraint"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        "n", "sample_key")


def chk_domain(df: DataFrame, table: str, column: str, key: str, values=None, pattern: str | None = None):
    c = F.col(column)
    ok = c.isin(*values) if values is not None else c.rlike(pattern)
    return _row(df, "domain", table, column, ~F.coalesce(ok, F.lit(False)), F.col(key))


def chk_conditional_child(orders: DataFrame, items: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Delivered orders must have at least one item. ``counts``: the items' ``key_counts`` by order, where shared."""
    rows = counts if counts is not None else key_counts(items, ["order_id"])
    lonely = orders.filter(F.col("order_status") == "delivered").select("order_id").join(
        rows.select("order_id"), "order_id", "left_anti")
    return lonely.agg(F.count(F.lit(1)).alias("n"), F.min("order_id").cast("string").alias("sample_key")).select(
        F.lit("delivered_has_items").alias("constraint"), F.lit("orders").alias("table"),
        F.lit("order_id").alias("column"), "n", "sample_key")


def chk_bounded_sum(df: DataFrame, table: str, column: str) -> DataFrame:
    """The column's total must fit BIGINT (summed in decimal(38,0), so the check itself cannot overflow)."""
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    return df.agg(F.when(F.coalesce(total, F.lit(0)) > F.lit(MAX_CENTS), 1).otherwise(0).cast("bigint").alias("n"))\
        .select(F.lit("bounded_sum").alias("constraint"), F.lit(table).alias("table"), F.lit(column).alias("column"),
                "n", F.lit(None).cast("string").alias("sample_key"))


def chk_conservation(fact_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sum of order revenue equals the sum of raw item prices."""
    a = fact_orders.agg(F.coalesce(F.sum("revenue_cents"), _zero()).alias("a"))
    b = items.agg(F.coalesce(F.sum("price_cents"), _zero()).alias("b"))
    return a.crossJoin(b).select(
        F.lit("conservation").alias("constraint"), F.lit("fact_order").alias("table"),
        F.lit("revenue_cents").alias("column"), (F.col("a") != F.col("b")).cast("bigint").alias("n"),
        F.concat_ws("!=", F.col("a").cast("string"), F.col("b").cast("string")).alias("sample_key"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


ID_COLUMNS = ["order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "review_id"]


Rule = tuple[str, str, F.Column, F.Column]  # constraint, column, bad predicate, key expression


def rule_columns(rules: list[Rule], bounded_sums: list[str] | tuple = ()) -> list[F.Column]:
    """Every predicate (regexes, casts) once, and the key where it holds; money columns as wide decimals."""
    cols = []
    for i, (_, _, bad, key) in enumerate(rules):
        cols += [bad.alias(f"_b{i}"), F.when(bad, key.cast("string")).alias(f"_k{i}")]
    return cols + [money_cents(F.col(col)).cast("decimal(38,0)").alias(f"_s{j}") for j, col in enumerate(bounded_sums)]


def rule_metrics(rules: list[Rule], bounded_sums: list[str] | tuple = ()) -> list[F.Column]:
    """Aggregates over ``rule_columns``: offending rows and one key a rule, and whether a money column's total (summed as
    decimal(38,0), so the check cannot overflow) leaves BIGINT cents."""
    aggs = []
    for i in range(len(rules)):
        aggs += [F.count_if(F.col(f"_b{i}")).alias(f"n{i}"), F.min(f"_k{i}").alias(f"k{i}")]
    return aggs + [F.when(F.coalesce(F.sum(f"_s{j}"), F.lit(0)) > F.lit(MAX_CENTS), 1).otherwise(0).cast("bigint").alias(f"b{j}")
                   for j in range(len(bounded_sums))]


def row_checks(df: DataFrame, table: str, rules: list[Rule], bounded_sums: list[str] | tuple = ()) -> DataFrame:
    """Many per-row predicates of one table in ONE scan: one aggregate, then unpivoted to violation rows."""
    row = df.select(*rule_columns(rules, bounded_sums)).agg(*rule_metrics(rules, bounded_sums))
    parts = [f"'{c}', '{col}', n{i}, k{i}" for i, (c, col, _, _) in enumerate(rules)]
    parts += [f"'bounded_sum', '{col}', b{j}, cast(null as string)" for j, col in enumerate(bounded_sums)]
    return row.select(F.expr(f"stack({len(parts)}, {', '.join(parts)}) as (constraint, column, n, sample_key)"))\
        .select("constraint", F.lit(table).alias("table"), "column", "n", "sample_key")


def observed_violations(metrics: dict, table: str, rules: list[Rule], bounded_sums: list[str] | tuple = ()) -> list[dict]:
    """The rows of ``row_checks`` from metrics that were observed while the table was written."""
    found = [(c, col, metrics[f"n{i}"], metrics[f"k{i}"]) for i, (c, col, _, _) in enumerate(rules)]
    found += [("bounded_sum", col, metrics[f"b{j}"], None) for j, col in enumerate(bounded_sums)]
    return [{"constraint": c, "table": table, "column": col, "n": n, "sample_key": key} for c, col, n, key in found]


def _length(col: str, limit: int, required: bool = True) -> F.Column:
    bad = F.char_length(F.col(col)) > limit
    return bad | (F.col(col) == "") if required else bad


def _ts_bad(col: str, required: bool = False) -> F.Column:
    c = F.col(col)
    bad = (c != "") & strict_timestamp(c).isNull()
    return bad | (c == "") if required else bad


def key_violations(L: dict[str, DataFrame]) -> DataFrame:
    """Uniqueness, references and delivered orders without items: one (key, count) aggregate a key, shared by all checks
    that need it, and one anti join a reference."""
    o, i, c, p, s, pay, r, tr = (L[k] for k in ("orders", "items", "customers", "products", "sellers", "payments",
                                                 "reviews", "translation"))
    ok, ck, pk, sk = (key_counts(o, ["order_id"]), key_counts(c, ["customer_id"]), key_counts(p, ["product_id"]),
                      key_counts(s, ["seller_id"]))
    item_orders = key_counts(i, ["order_id"])
    return union_all([chk_unique_key(o, "orders", ["order_id"], ok), chk_unique_key(c, "customers", ["customer_id"], ck),
              chk_unique_key(p, "products", ["product_id"], pk), chk_unique_key(s, "sellers", ["seller_id"], sk),
              chk_unique_key(tr, "translation", ["product_category_name"]),
              chk_unique_key(i, "items", ["order_id", "order_item_id"]),
              chk_unique_key(pay, "payments", ["order_id", "payment_sequential"]),
              chk_foreign_key(o, "orders", "customer_id", c, "customer_id", ck),
              chk_foreign_key(i, "items", "order_id", o, "order_id", ok, item_orders),
              chk_foreign_key(i, "items", "product_id", p, "product_id", pk),
              chk_foreign_key(i, "items", "seller_id", s, "seller_id", sk),
              chk_foreign_key(pay, "payments", "order_id", o, "order_id", ok),
              chk_foreign_key(r, "reviews", "order_id", o, "order_id", ok),
              chk_conditional_child(o, i, item_orders)])


BOUNDED_SUMS = {"items": ["price", "freight_value"], "payments": ["payment_value"]}


def row_rules(L: dict[str, DataFrame]) -> dict[str, list[Rule]]:
    """Per table the rules that a row tells by itself: lengths, domains, timestamps, numbers and money."""
    o, i, c, p, s, pay, r = (L[k] for k in ("orders", "items", "customers", "products", "sellers", "payments", "reviews"))
    per_table = {name: [] for name in L}
    for name, df in (("orders", o), ("items", i), ("customers", c), ("products", p), ("sellers", s),
                     ("payments", pay), ("reviews", r)):
        for col in ID_COLUMNS:
            if col in df.columns:
                per_table[name].append(("string_length", col, _length(col, 64), F.col(col)))
    per_table["customers"].append(("string_length", "customer_state", _length("customer_state", 8, False),
                                   F.col("customer_id")))
    per_table["sellers"].append(("string_length", "seller_state", _length("seller_state", 8, False),
                                 F.col("seller_id")))
    per_table["products"].append(("string_length", "product_category_name",
                                  _length("product_category_name", 128, False), F.col("product_id")))
    per_table["translation"] += [
        ("string_length", "product_category_name", _length("product_category_name", 128, False),
         F.col("product_category_name")),
        ("string_length", "product_category_name_english", _length("product_category_name_english", 128, False),
         F.col("product_category_name"))]
    oid = F.col("order_id")
    per_table["orders"].append(("domain", "order_status",
                                ~F.coalesce(F.col("order_status").isin(*ORDER_STATUSES), F.lit(False)), oid))
    for col in ("order_purchase_timestamp", "order_delivered_carrier_date", "order_delivered_customer_date",
                "order_estimated_delivery_date", "order_approved_at"):
        if col in o.columns:
            per_table["orders"].append(("timestamp", col, _ts_bad(col, col == "order_purchase_timestamp"), oid))
    per_table["items"] += [("positive_int", "order_item_id", ~positive_int_valid(F.col("order_item_id")), oid),
                           ("money", "price", ~money_valid(F.col("price")), oid),
                           ("money", "freight_value", ~money_valid(F.col("freight_value")), oid)]
    if "shipping_limit_date" in i.columns:
        per_table["items"].append(("timestamp", "shipping_limit_date", _ts_bad("shipping_limit_date"), oid))
    per_table["payments"] += [
        ("positive_int", "payment_sequential", ~positive_int_valid(F.col("payment_sequential")), oid),
        ("money", "payment_value", ~money_valid(F.col("payment_value")), oid)]
    per_table["reviews"] += [
        ("domain", "review_score", ~F.coalesce(F.col("review_score").rlike(r"^[1-5]$"), F.lit(False)), oid),
        ("timestamp", "review_creation_date", _ts_bad("review_creation_date"), oid),
        ("timestamp", "review_answer_timestamp", _ts_bad("review_answer_timestamp"), oid)]
    return per_table


def landing_violations(L: dict[str, DataFrame]) -> DataFrame:
    """All landing constraints of the load as one violations table: key checks, and one scan a table for its row rules."""
    frames = [row_checks(L[name], name, rules, BOUNDED_SUMS.get(name, ())) for name, rules in row_rules(L).items() if rules]
    return union_all([key_violations(L), *frames])


def require_clean(violations: DataFrame) -> None:
    """Strict wrapper: one job; raise with every failing constraint when any count is non-zero."""
    bad = [r.asDict() for r in violations.filter(F.col("n") > 0).collect()]  # at most one row per constraint
    if bad:
        raise ConstraintViolation(bad)


def typed_model(L: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Landing text -> typed raw model (run after ``require_clean`` on ``landing_violations``)."""
    ts = lambda c: strict_timestamp(F.col(c))
    o = L["orders"]
    orders = o.select("order_id", "customer_id", "order_status", ts("order_purchase_timestamp").alias("purchase_at"),
                      (ts("order_approved_at") if "order_approved_at" in o.columns
                       else F.lit(None).cast("timestamp_ntz")).alias("approved_at"),
                      ts("order_delivered_carrier_date").alias("carrier_at"),
                      ts("order_delivered_customer_date").alias("delivered_at"),
                      ts("order_estimated_delivery_date").alias("estimated_at"))
    i = L["items"]
    items = i.select("order_id", F.col("order_item_id").cast("int").alias("item_id"), "product_id", "seller_id",
                     (ts("shipping_limit_date") if "shipping_limit_date" in i.columns
                      else F.lit(None).cast("timestamp_ntz")).alias("shipping_limit_at"),
                     money_cents(F.col("price")).alias("price_cents"),
                     money_cents(F.col("freight_value")).alias("freight_cents"))
    payments = L["payments"].select("order_id", F.col("payment_sequential").cast("int").alias("payment_sequential"),
                                    money_cents(F.col("payment_value")).alias("payment_cents"))
    reviews = L["reviews"].select("review_id", "order_id", F.col("review_score").cast("int").alias("review_score"),
                                  ts("review_creation_date").alias("created_at"),
                                  ts("review_answer_timestamp").alias("answered_at"),
                                  *([RECORD] if RECORD in L["reviews"].columns else []))
    return {"orders": orders, "items": items, "payments": payments, "reviews": reviews,
            "customers": L["customers"].select("customer_id", "customer_unique_id", "customer_state"),
            "products": L["products"].select("product_id", "product_category_name"),
            "sellers": L["sellers"].select("seller_id", "seller_state"),
            "translation": L["translation"].select("product_category_name", "product_category_name_english")}


def reconcile(star: dict[str, DataFrame], typed: dict[str, DataFrame]) -> DataFrame:
    """Eleven actual-vs-expected checks after the load, as rows (check, actual, expected, passed)."""
    fo, fi, ad = star["fact_order"], star["fact_item"], star["agg_day"]
    d = F.col("status") == "delivered"
    s = lambda c: F.coalesce(F.sum(c), _zero())
    orders_raw = typed["orders"]
    items_raw, pays_raw = typed["items"], typed["payments"]
    delivered_ids = orders_raw.filter(F.col("order_status") == "delivered").select("order_id")
    a = fo.agg(F.count(F.lit(1)).alias("order_count"), s("revenue_cents").alias("order_revenue"),
               s("freight_cents").alias("order_freight"), s("payment_cents").alias("order_payments"),
               F.count_if(d).alias("delivered_orders"), s(F.when(d, F.col("revenue_cents"))).alias("delivered_revenue"))
    b = fi.agg(F.count(F.lit(1)).alias("item_count"), s("price_cents").alias("item_revenue"),
               s("freight_cents").alias("item_freight"))
    c = ad.agg(s("order_count").alias("daily_orders"), s("revenue_cents").alias("daily_revenue"))
    e = orders_raw.agg(F.count(F.lit(1)).alias("raw_orders"), F.count_if(F.col("order_status") == "delivered")
                       .alias("raw_delivered"))
    f = items_raw.agg(F.count(F.lit(1)).alias("raw_items"), s("price_cents").alias("raw_revenue"),
                      s("freight_cents").alias("raw_freight"))
    g = pays_raw.agg(s("payment_cents").alias("raw_payments"))
    h = items_raw.join(delivered_ids, "order_id", "left_semi").agg(s("price_cents").alias("raw_delivered_revenue"))
    row = a.crossJoin(b).crossJoin(c).crossJoin(e).crossJoin(f).crossJoin(g).crossJoin(h)
    pairs = [("order count", "order_count", "raw_orders"), ("item count", "item_count", "raw_items"),
             ("item revenue", "item_revenue", "raw_revenue"), ("order revenue", "order_revenue", "raw_revenue"),
             ("item freight", "item_freight", "raw_freight"), ("order freight", "order_freight", "raw_freight"),
             ("order payments", "order_payments", "raw_payments"),
             ("delivered orders", "delivered_orders", "raw_delivered"),
             ("delivered revenue", "delivered_revenue", "raw_delivered_revenue"),
             ("daily orders", "daily_orders", "raw_delivered"),
             ("daily revenue", "daily_revenue", "raw_delivered_revenue")]
    stack = ", ".join(f"'{name}', cast({x} as bigint), cast({y} as bigint)" for name, x, y in pairs)
    return row.select(F.expr(f"stack({len(pairs)}, {stack}) as (check, actual, expected)")) \
        .withColumn("passed", F.col("actual") == F.col("expected"))
