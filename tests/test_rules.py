"""Rule units from the fixture list: decomposition, contributions, anomalies, strata, RFM keys, parsing, audit."""
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from retailq.functions.parse import is_missing, money_cents, money_valid
from retailq.operators import audit as au
from retailq.operators import customers as cu
from retailq.operators import diagnosis as dg
from retailq.operators.scope import coverage_from_observed
from retailq.params import Coverage, ScopeParams
from retailq.plans.publish import SNAPSHOT_SECTIONS, PublishRefused, check_publishable, forbidden_paths


def test_decompose(spark):
    df = spark.createDataFrame([(20, 30000, 10, 10000), (20, 30000, 0, 0)], "n1 long, r1 long, n0 long, r0 long")
    rows = df.select(*dg.decompose_columns("n1", "r1", "n0", "r0")).collect()
    assert tuple(rows[0]) == (12500.0, 7500.0)
    assert tuple(rows[1]) == (None, None)


def _daily(spark, values):
    return spark.createDataFrame([(d, n) for d, n in values], "day date, order_count long")


def test_anomaly_rule(spark):
    cov = coverage_from_observed(spark, date(2017, 1, 1), date(2018, 7, 31))
    target = date(2018, 7, 23)
    base = [(target - timedelta(days=7 * k), 20) for k in range(1, 9)]
    p = ScopeParams(target, target)
    for actual, status in ((100, "high"), (0, "low"), (30, "normal")):
        r = dg.anomaly_same_weekday_mad(_daily(spark, base + [(target, actual)]), p, cov).collect()[0]
        assert r.status == status and r.baseline_median == 20 and r.threshold == 10
    future = base + [(target, 100), (target + timedelta(days=7), 5000)]
    assert dg.anomaly_same_weekday_mad(_daily(spark, future), p, cov).collect()[0].status == "high"
    short = coverage_from_observed(spark, target - timedelta(days=49), date(2018, 7, 31),
                                   Coverage(date(2017, 1, 1), date(2018, 7, 31)))
    assert dg.anomaly_same_weekday_mad(_daily(spark, base + [(target, 100)]), p, short).collect()[0].status \
        == "insufficient"


def test_strata_gate(spark):
    cells = spark.createDataFrame(
        [("a", "SP", 0, 5, 20), ("a", "SP", 1, 1, 20), ("a", "SP", 1, None, 2), ("b", "RJ", 1, 4, 1)],
        "category string, state string, is_late int, review_score int, order_count long")
    late = {r.delivery_group: r for r in dg.score_group_stats(cells).collect()}["late"]
    assert late.missing_reviews == 2 and late.median_score == 1.0
    strata = {(r.name, r.delivery_group): r for r in dg.score_strata(cells, "category").collect()}
    assert strata[("a", "late")].score_gap == -4.0 and strata[("b", "late")].score_gap is None


def test_rfm_keys(spark):
    df = spark.createDataFrame([(30, 2, 20000), (31, 2, 20000), (30, 1, 20000), (30, 2, 19999)],
                               "recency_days int, frequency long, monetary_cents long")
    assert [r.k for r in df.select(cu.segment_key().alias("k")).collect()] == ["111", "011", "101", "110"]


def test_money_and_missing(spark):
    df = spark.createDataFrame([("0.10",), ("0.20",), ("-1.00",), ("0.001",), ("NaN",), ("",)], "v string")
    rows = df.select(money_cents(F.col("v"), True).alias("c"), money_valid(F.col("v"), True).alias("ok")).collect()
    assert [r.c for r in rows[:2]] == [10, 20] and rows[2].c == -100
    assert [r.ok for r in rows[3:]] == [False, False, False]
    m = spark.createDataFrame([("",), ("  ",), ("NA",), ("null",), ("\t",)], "v string")
    assert m.filter(is_missing(F.col("v"))).count() == 3
    strict = spark.createDataFrame([("1e2",), (" 1.5",), ("12.345",)], "v string")
    assert [r.c for r in strict.select(money_cents(F.col("v")).alias("c")).collect()] == [10000, 150, None]


def test_relationship_profile(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("",)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    r = au.profile_relationship(child, "k", parent, "k", "x").collect()[0]
    assert (r.missing_child_keys, r.unmatched_child_rows, r.parent_duplicate_key_rows) == (1, 1, 1)


def test_denylist_any_depth(spark):
    df = spark.createDataFrame([(1, [(2, "x")])], "n int, xs array<struct<k:int, order_id:string>>")
    assert forbidden_paths(df.schema) == ["xs[].order_id"]
    ok = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(PublishRefused):
        check_publishable({name: df if name == "kpis" else ok for name in SNAPSHOT_SECTIONS})
    with pytest.raises(PublishRefused):
        check_publishable({"kpis": ok})


def _builtin(df, probs, by=()):
    from pyspark.sql import functions as F
    aggs = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY v)") if m == "nearest" else F.percentile("v", q)
            for q, m in probs.values()]
    return (df.groupBy(*by) if by else df).agg(*aggs)


def test_distributed_quantiles_match_builtin(spark):
    from retailq.functions.stats import exact_quantiles
    rows = [(g, v) for g in ("a", "b", None) for v in range(0, 97, 3 if g == "a" else 5)] + [("c", 7)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(4)
    probs = {"med": (0.5, "linear"), "p75": (0.75, "nearest"), "p99": (0.99, "linear")}
    a = sorted(map(tuple, exact_quantiles(df, "v", probs, ["g"]).collect()), key=repr)
    b = sorted(map(tuple, _builtin(df.withColumn("v", df.v.cast("double")), probs, ["g"]).collect()), key=repr)
    assert a == b
    assert tuple(exact_quantiles(df, "v", probs).collect()[0]) == tuple(
        _builtin(df.withColumn("v", df.v.cast("double")), probs).collect()[0])


def test_quantiles_of_signed_extreme_and_hot_values(spark):
    from retailq.functions.stats import exact_quantiles
    values = [0.0] * 9800 + [-1e300, -5.5, -1e-300, 5e-324, 1e-9, 0.1 + 0.2, 0.3, 7.0, 1e15, 1e15 + 0.125, 1.7e308] * 18 + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probs = {f"p{i}": (i / 1000, m) for i in (0, 1, 4, 7, 9, 12, 500, 983, 985, 988, 990, 994, 998, 1000)
             for m in ("linear",)} | {"d985": (0.985, "nearest"), "d1": (1.0, "nearest")}
    got = exact_quantiles(df, "v", probs)
    assert tuple(got.collect()[0]) == tuple(_builtin(df, probs).collect()[0])
    weighted = df.groupBy("v").count()
    assert tuple(exact_quantiles(weighted, "v", probs, weight="count").collect()[0]) == tuple(got.collect()[0])
    assert exact_quantiles(df.where("v is null"), "v", {"m": (0.5, "linear")}, by=["v"]).count() == 0


def test_forbidden_names_at_depth_two(spark):
    from pyspark.sql import types as T

    from retailq.plans.publish import DENYLIST, forbidden_paths
    for name in sorted(DENYLIST | {"zip_code_prefix", "seller_city", "Email", "home_address", "work_phone"}):
        inner = T.StructType([T.StructField(name, T.StringType())])
        for nested in (T.ArrayType(inner), T.MapType(T.StringType(), inner), T.MapType(inner, T.StringType())):
            assert forbidden_paths(T.StructType([T.StructField("xs", nested)])), name
    assert not forbidden_paths(T.StructType([T.StructField("product_id", T.StringType())]))


def test_references_count_every_row_of_a_hot_key(spark):
    from retailq.operators.audit import profile_relationship
    from retailq.operators.checks import chk_foreign_key
    child = spark.createDataFrame([("gone",)] * 300 + [("here",)] * 20 + [("lost",), (None,), ("",)], "k string")
    parent = spark.createDataFrame([("here",), ("here",)], "k string")
    row = chk_foreign_key(child, "child", "k", parent, "k").collect()[0]
    assert (row.n, row.sample_key) == (303, "")
    row = profile_relationship(child, "k", parent, "k", "r").collect()[0]
    assert (row.child_rows, row.unmatched_distinct_keys, row.parent_duplicate_key_rows) == (323, 2, 1)
    assert row.missing_child_keys + row.unmatched_child_rows == 303


def test_pointer_swap_replaces_in_one_step(spark, tmp_path):
    from retailq.sources.warehouse_store import current_version, swap_pointer
    root = str(tmp_path)
    for version in ("v1", "v2", "v3"):
        swap_pointer(spark, root, version)
        assert current_version(spark, root) == version
