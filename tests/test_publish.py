"""Preset snapshots: every contract section for every preset from one tagged scope, manifest, denylist, verification."""
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from retailq.operators.scope import coverage_window
from retailq.plans import publish as pub
from retailq.plans import verify_snapshots as vs
from retailq.plans.catalog import star
from retailq.plans.snapshots import Snapshots
from retailq.sources.testdata import TEST_PROFILE, landing_model
from retailq.sources.work_tables import WorkFolder

SF = "/root/testdata/sf0.001"
PRESETS = [("all", date(1995, 1, 1), date(2001, 12, 31), "", ""),
           ("month", date(1997, 7, 1), date(1997, 7, 31), "", ""),
           ("week", date(1997, 7, 7), date(1997, 7, 13), "", ""),
           ("edge", date(1995, 12, 27), date(1996, 3, 5), "SMALL", ""),
           ("nobody", date(1997, 7, 1), date(1997, 7, 31), "", "XX")]
RULES = dict(rules=TEST_PROFILE.rfm, anomaly=TEST_PROFILE.anomaly)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """Stored star, presets, coverage, the published folder and freshly computed sections."""
    base = str(tmp_path_factory.mktemp("publish"))
    for name, df in star(spark, SF).items():
        df.write.parquet(f"{base}/star/{name}")
    st = {name: spark.read.parquet(f"{base}/star/{name}") for name in os.listdir(f"{base}/star")}
    presets = pub.preset_table(spark, PRESETS)
    cov = coverage_window(st["fact_order"], TEST_PROFILE.coverage)
    pub.publish_snapshots(spark, st, presets, f"{base}/snap", cov, **RULES)
    work = WorkFolder(spark, "test-sections")
    sections = {name: df.cache() for name, df in pub.preset_sections(st, presets, work, cov, **RULES).items()}
    yield base, st, presets, cov, sections
    work.remove()


def test_comparison_windows(spark):
    rows = {r.preset: r for r in pub.preset_table(spark, PRESETS).collect()}
    assert (rows["month"].prev_start, rows["month"].prev_end) == (date(1997, 6, 1), date(1997, 6, 30))
    assert rows["month"].comparison_label == "previous_calendar_month"
    assert (rows["week"].prev_start, rows["week"].prev_end) == (date(1997, 6, 30), date(1997, 7, 6))


def test_publish_all_sections(spark, published):
    base, _, _, _, sections = published
    with open(f"{base}/snap/_manifest.json") as fh:
        doc = json.load(fh)
    assert doc["rows"] == {name: df.count() for name, df in sections.items()} and set(doc["rows"]) == set(pub.SNAPSHOT_SECTIONS)
    assert all(f["bytes"] > 0 and len(f["sha256"]) == 64 for f in doc["files"])
    # every preset keeps its rows, even without orders
    for name, per_preset in (("kpis", 1), ("customers", 1), ("report_headline", 1), ("segments", 8), ("fulfilment", 1), ("scores", 5),
                             ("fulfilment_groups", 3), ("delivery_groups", 3), ("distribution", 3), ("beyond_recency", 1)):
        got = sections[name].groupBy("preset").count().collect()
        assert {r.preset: r["count"] for r in got} == {p[0]: per_preset for p in PRESETS}, name
    days = {p[0]: (p[2] - p[1]).days + 1 for p in PRESETS}
    for name in ("trend_day", "anomalies"):
        assert {r.preset: r["count"] for r in sections[name].groupBy("preset").count().collect()} == days
    for df in sections.values():
        assert pub.forbidden_paths(df.schema) == []


def test_views_agree(published):
    """The same revenue in KPIs, customers, headline, categories, regions, trends and contributions of every preset."""
    sections = published[-1]
    money = lambda name, c="revenue_cents": {r.preset: r.m for r in sections[name].groupBy("preset").agg(F.sum(c).alias("m")).collect() if r.m}
    want = money("kpis")
    assert want and "nobody" not in want
    assert all(money(name) == want for name in ("customers", "categories", "regions", "trend_day", "trend_week", "trend_month", "segments"))
    assert money("report_headline", "current_revenue_cents") == want
    heads = {r.preset: r for r in sections["report_headline"].collect()}
    for r in sections["contributions"].groupBy("preset", "dimension").agg(F.sum("delta_cents").alias("d")).collect():
        assert r.d == heads[r.preset].delta_cents
    kpis = {r.preset: r for r in sections["kpis"].collect()}
    assert all((h.current_items, h.current_customers) == (kpis[p].item_count, kpis[p].customer_count) for p, h in heads.items())


def test_sections_read_work_tables_only(spark, published):
    """Two scans of facts and one each of first purchases and days: no section reads the star again."""
    base, st, presets, cov, _ = published
    with WorkFolder(spark, "test-scans") as work:
        snapshots = Snapshots(st, presets, cov, work, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
        for name, df in snapshots.sections().items():
            assert all("/star/" not in f for f in df.inputFiles()), name
        assert all("/star/" not in f for f in snapshots.orders.inputFiles())
    assert not os.path.exists(work.path)


def test_published_equals_recomputed_and_a_wrong_row_is_named(spark, published):
    base, st, presets, cov, sections = published
    written = vs.read_sections(spark, f"{base}/snap", {name: df.schema for name, df in sections.items()})
    verdict = vs.verify_published(written, sections, presets)
    assert verdict.count() == len(sections) * len(PRESETS) and verdict.filter(~F.col("equal")).count() == 0
    assert vs.differing_rows(written, sections, verdict) == {}
    state = sections["regions"].filter(F.col("preset") == "month").first().name
    wrong = {**written, "regions": written["regions"].withColumn("item_count", F.when(
        (F.col("preset") == "month") & (F.col("name") == state), F.col("item_count") + 1).otherwise(F.col("item_count")))}
    verdict = vs.verify_published(wrong, sections, presets)
    assert [(r.section, r.preset) for r in verdict.filter(~F.col("equal")).collect()] == [("regions", "month")]
    found = vs.differing_rows(wrong, sections, verdict)
    assert {(r.name, r.side) for r in found["regions"].collect()} == {(state, "published_only"), (state, "recomputed_only")}


def test_sections_equal_raw_and_an_injected_fault_fails(spark, published):
    base, st, presets, cov, sections = published
    landing = landing_model(spark, SF)
    # one of each kind; the registered verification queries compare every section
    names = ("kpis", "previous", "trend_week", "fulfilment", "distribution", "segments", "report_headline", "contributions", "anomalies", "delivery_strata")
    with WorkFolder(spark, "test-raw") as work:
        raw = vs.RawSections(landing, presets, cov, work, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
        rows = vs.verify_from_raw(sections, raw, names).collect()
        assert len(rows) == len(names) * len(PRESETS) and all(r.difference_rows == 0 for r in rows)
        assert {r.section for r in rows if r.compared_rows == 0 and r.preset == "all"} <= {"previous", "contributions"}
    # the items of one order cost ten times as much in the landing text
    victim = st["fact_order"].filter((F.col("status") == "delivered") & F.col("purchase_date").between(
        F.lit(date(1997, 7, 1)), F.lit(date(1997, 7, 31))) & (F.col("revenue_cents") > 0)).first()
    items = landing["items"].withColumn("price", F.when(
        F.col("order_id") == str(victim.order_id), F.concat("price", F.lit("e1"))).otherwise(F.col("price")))
    with WorkFolder(spark, "test-fault") as work:
        raw = vs.RawSections({**landing, "items": items}, presets, cov, work, TEST_PROFILE.rfm, TEST_PROFILE.anomaly)
        off = {(r.section, r.preset) for r in vs.verify_from_raw(sections, raw, ("kpis", "trend_day", "report_headline", "customers")).collect() if r.difference_rows}
    assert {(s, p) for s in ("kpis", "trend_day", "report_headline", "customers") for p in ("all", "month")} <= off


def test_quantiles_by_counts_below(spark):
    values = {"a": [5, -3, 5, 10 ** 15, 7, 7, 0], "b": [4], "c": list(range(-2000, 3000, 7))}
    df = spark.createDataFrame([(g, v) for g, vs_ in values.items() for v in vs_] + [("a", None), ("d", None)], "g string, v long")
    got = {r.g: (r.lo, r.hi, r.last) for r in vs.kth_smallest(df, ["g"], "v", {
        "lo": F.floor((F.col("n") - 1) / 2), "hi": F.ceil((F.col("n") - 1) / 2), "last": F.col("n") - 1}).collect()}
    assert got == {g: (sorted(v)[(len(v) - 1) // 2], sorted(v)[len(v) // 2], max(v)) for g, v in values.items()}


def test_report_json_keeps_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b", 1.5)], "name string, rate double")
    pub.write_report_json({"headline": rows}, str(tmp_path))
    lines = "".join(open(os.path.join(tmp_path, "headline", f)).read() for f in os.listdir(tmp_path / "headline") if f.endswith(".json"))
    assert {json.loads(x)["name"]: json.loads(x)["rate"] for x in lines.splitlines()} == {"a": None, "b": 1.5}
