"""Raw landing fixture through the strict, versioned load (goldens, rejections, atomicity, idempotence)."""
import os
import tempfile
from datetime import date

import pytest

from retailq.operators.checks import ConstraintViolation
from retailq.plans.load import SourceChanged, run_load
from retailq.sources.landing import LandingError, read_landing
from retailq.sources.warehouse_store import WarehouseNotReady, current_version, read_receipt, read_star

from .fixtures import RAW, mutate, write_raw


@pytest.fixture(scope="module")
def loaded(spark):
    base = tempfile.mkdtemp(prefix="retailq-test-")
    src = write_raw(os.path.join(base, "raw"))
    root = os.path.join(base, "wh")
    receipt = run_load(spark, read_landing(spark, src), root)
    return spark, base, root, receipt


def test_receipt_goldens(loaded):
    _, _, _, r = loaded
    assert (r["raw_order_count"], r["delivered_order_count"], r["delivered_revenue_cents"]) == (5, 3, 45000)
    assert (str(r["observed_start"]), str(r["observed_end"])) == ("2018-07-01", "2018-07-03")
    assert r["review_rows_collapsed"] == 3
    recon = {x["check"]: x for x in r["reconciliation"]}
    assert recon["item revenue"]["actual"] == 144900 and all(x["passed"] for x in r["reconciliation"])


def test_fact_rows(loaded):
    spark, _, root, _ = loaded
    st = read_star(spark, root)
    rows = {x.order_id: x for x in st["fact_order"].collect()}
    a, b, c = rows["order-a"], rows["order-b"], rows["order-c"]
    assert (a.revenue_cents, a.payment_cents, a.payment_count, a.review_count, a.review_score) == (15000, 16500, 2, 4, 5)
    assert (a.is_late, a.delivery_seconds) == (0, 214200) and "carrier_before_purchase" in a.quality_flags
    assert (b.review_score, b.payment_cents, b.payment_count, b.is_late, b.delivery_seconds) == (4, None, 0, 1, 259200)
    assert "delivery_before_carrier" in b.quality_flags
    assert (c.revenue_cents, c.delivery_seconds, c.is_late, c.review_score) == (10000, None, None, None)
    prods = {x.product_id: (x.category, x.category_english) for x in st["dim_product"].collect()}
    assert prods == {"product-a": ("casa", "home"), "product-b": ("unknown", None),
                     "product-c": ("sem_traducao", None)}
    days = {x.day: (x.revenue_cents, x.order_count) for x in st["agg_day"].collect()}
    assert days[date(2018, 7, 1)] == (15000, 1) and sum(v[0] for v in days.values()) == 45000


@pytest.mark.parametrize("table,row,column,value", [
    ("items", 1, "price", "-1.00"), ("items", 1, "price", "1.001"), ("items", 1, "price", "NaN"),
    ("items", 1, "product_id", "product-zzz"), ("items", 1, "order_item_id", "0"),
    ("orders", 1, "order_purchase_timestamp", "not-a-date"), ("orders", 1, "customer_id", "customer-zzz"),
    ("customers", 1, "customer_unique_id", ""), ("reviews", 1, "review_score", "9"),
    ("items", 2, "order_item_id", "1"),
])
def test_rejected_inputs_keep_previous_version(loaded, table, row, column, value):
    spark, base, root, _ = loaded
    before = current_version(spark, root)
    src = write_raw(tempfile.mkdtemp(dir=base), mutate(RAW, table, row, column, value))
    with pytest.raises(ConstraintViolation):
        run_load(spark, read_landing(spark, src), root)
    assert current_version(spark, root) == before
    assert read_star(spark, root)["fact_order"].count() == 5


def test_repeat_load_is_identical_and_failure_is_atomic(loaded):
    spark, base, root, first = loaded
    src = os.path.join(base, "raw")
    before = current_version(spark, root)
    with pytest.raises(RuntimeError):
        run_load(spark, read_landing(spark, src), root, _fail_before_swap=True)
    assert current_version(spark, root) == before
    second = run_load(spark, read_landing(spark, src), root)
    assert second["data_version"] == first["data_version"]
    a = read_star(spark, root, first["version_dir"])["fact_order"].drop("purchase_month")
    b = read_star(spark, root)["fact_order"].drop("purchase_month")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert read_receipt(spark, root)["version_dir"] == second["version_dir"]


def test_not_ready_and_bad_header(spark, tmp_path):
    with pytest.raises(WarehouseNotReady):
        current_version(spark, str(tmp_path / "nothing"))
    src = write_raw(str(tmp_path / "raw"))
    with open(os.path.join(src, "olist_orders_dataset.csv"), "w", encoding="utf-8") as fh:
        fh.write("order_id,order_id\nx,y\n")
    with pytest.raises(LandingError):
        read_landing(spark, src)


def test_non_rectangular_row_is_rejected(spark, tmp_path):
    src = write_raw(str(tmp_path / "raw"))
    with open(os.path.join(src, "olist_order_payments_dataset.csv"), "a", encoding="utf-8") as fh:
        fh.write("order-a,3,credit_card\n")
    with pytest.raises(ConstraintViolation) as err:
        run_load(spark, read_landing(spark, src), str(tmp_path / "wh"))
    assert any(r["constraint"] == "rectangular" for r in err.value.rows)


def test_changed_source_aborts_and_keeps_pointer(spark, tmp_path):
    """An input file rewritten while the load runs: the stability check refuses to publish the version."""
    src = write_raw(str(tmp_path / "raw"))
    root = str(tmp_path / "wh")

    def rewrite():
        with open(os.path.join(src, "olist_sellers_dataset.csv"), "a", encoding="utf-8") as fh:
            fh.write("\n")

    with pytest.raises(SourceChanged):
        run_load(spark, read_landing(spark, src), root, _before_stability=rewrite)
    with pytest.raises(WarehouseNotReady):
        current_version(spark, root)
    receipt = run_load(spark, read_landing(spark, src), root)  # unchanged input now loads
    assert receipt["input_identity"]["files"] == 8
