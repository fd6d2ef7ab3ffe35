"""Independent record counter, record places, undeclared headers; generations, retention and staging of the store."""
import os

import pytest
from pyspark.sql import functions as F

from retailq.operators.warehouse import latest_review_per_order
from retailq.plans.load import run_load
from retailq.sources import sample
from retailq.sources.landing import (FILES, LandingError, RECORD, read_audit_landing, read_csv_strings, read_landing,
                                     record_counts)
from retailq.sources.warehouse_store import (ConcurrentLoad, current_version, generation, generations, pinned_star,
                                             publish_version, read_star, retain_versions, swap_pointer)
from retailq.operators.checks import ConstraintViolation

from .fixtures import RAW, write_raw


def counted(spark, path):
    return sorted((r.records, r.unclosed) for r in record_counts(spark, str(path)).collect())


def test_record_counter_agrees_with_the_parser(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,"two\nlines"\n\n2,"a ""quoted"", word"\n3,"\n\n"\n4,"ends in """\n5,plain', encoding="utf-8")
    assert counted(spark, path) == [(6, False)]
    assert read_csv_strings(spark, str(path)).count() == 5
    path.write_text('id,text\n1,a\n2,"never closed\n3,b\n', encoding="utf-8")
    assert counted(spark, path) == [(2, True)]


def test_large_file_is_counted_in_blocks(spark, tmp_path):
    """Blocks that begin inside quotes: the prefix of parities decides, and several tasks share the file."""
    path = tmp_path / "big.csv"
    rows = [f'{i},"line one\nline ""two"", of {i}\n\n"' if i % 3 else f"{i},plain" for i in range(4000)]
    path.write_text("id,text\n" + "\n".join(rows) + "\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
        assert counted(spark, path) == [(4001, False)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_open_quote_is_refused_by_the_counter(spark, tmp_path):
    src = write_raw(str(tmp_path / "raw"))
    with open(os.path.join(src, FILES["sellers"]), "a", encoding="utf-8") as fh:
        fh.write('seller-c,"SP\n')
    with pytest.raises(ConstraintViolation) as err:
        run_load(spark, read_landing(spark, src), str(tmp_path / "wh"))
    assert any(r["constraint"] == "unclosed_quote" and r["table"] == "sellers" for r in err.value.rows)
    assert not os.path.exists(tmp_path / "wh" / "_staging") or os.listdir(tmp_path / "wh" / "_staging") == []


def test_undeclared_header_is_refused(spark, tmp_path):
    src = write_raw(str(tmp_path / "raw"))
    with open(os.path.join(src, "olist_geolocation_dataset.csv"), "w", encoding="utf-8") as fh:
        fh.write("geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n1,2,3,x,SP\n")
    assert set(read_audit_landing(spark, src)) == {*FILES, "geolocation"}
    path = os.path.join(src, FILES["sellers"])
    lines = open(path, encoding="utf-8").read().splitlines()
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join([lines[0] + ",surprise", *[x + ",1" for x in lines[1:]]]) + "\n")
    with pytest.raises(LandingError, match="surprise"):
        read_audit_landing(spark, src)


def test_last_equal_review_is_the_last_record(spark, tmp_path):
    """Reviews equal in both times and id: the last record of the input wins, however the rows are dealt."""
    src = write_raw(str(tmp_path / "raw"))
    header = RAW["reviews"][0]
    row = dict(review_id="r", order_id="o", review_creation_date="2018-01-01 00:00:00", review_answer_timestamp="2018-01-02 00:00:00")
    scores = [5, 1, 4, 2, 3, 1, 5, 4, 2]
    with open(os.path.join(src, FILES["reviews"]), "w", encoding="utf-8") as fh:
        fh.write(",".join(header) + "\n" + "".join(",".join(str({**row, "review_score": s}.get(c, "")) for c in header) + "\n" for s in scores))
    landed = read_landing(spark, src)["reviews"].select(
        "review_id", "order_id", F.col("review_score").cast("int").alias("review_score"), F.col("review_creation_date").alias("created_at"),
        F.col("review_answer_timestamp").alias("answered_at"), RECORD)
    landed.write.parquet(str(tmp_path / "staged"))
    for seed in range(4):
        dealt = spark.read.parquet(str(tmp_path / "staged")).orderBy(F.rand(seed)).repartition(3)
        got = latest_review_per_order(dealt).first()
        assert (got.review_score, got.review_count) == (scores[-1], len(scores))


def test_of_two_loaders_one_wins(spark, tmp_path):
    src, root = write_raw(str(tmp_path / "raw")), str(tmp_path / "wh")
    run_load(spark, read_landing(spark, src), root, run_id="first")

    def other():
        run_load(spark, read_landing(spark, src), root, run_id="other")

    with pytest.raises(ConcurrentLoad):
        run_load(spark, read_landing(spark, src), root, run_id="late", _before_publish=other)
    assert current_version(spark, root).endswith("-other") and generation(spark, root) == 2
    assert read_star(spark, root)["fact_order"].count() == 5
    assert not any(name.endswith("-late") for name in os.listdir(root))
    assert os.listdir(os.path.join(root, "_staging")) == []
    receipt = run_load(spark, read_landing(spark, src), root, run_id="third", keep=1)
    assert receipt["generation"] == 3 and len(receipt["removed_versions"]) == 2
    assert sorted(n for n in os.listdir(root) if n.startswith("v=")) == [receipt["version_dir"]]
    assert receipt["missing_values"]["products"]["product_category_name"] == 1


def test_generations_and_pins(spark, tmp_path):
    root = str(tmp_path)
    for i in range(1, 6):
        os.makedirs(os.path.join(root, f"v{i}", "dim_customer"))
        assert publish_version(spark, root, f"v{i}", i - 1) == i
    with pytest.raises(ConcurrentLoad):
        publish_version(spark, root, "v9", 3)
    assert current_version(spark, root) == "v5"
    spark.range(1).write.mode("overwrite").parquet(f"{root}/v2/dim_customer")
    for table in ("dim_product", "dim_seller", "fact_order", "fact_item", "agg_day", "customer_first"):
        spark.range(1).write.parquet(f"{root}/v2/{table}")
    with pinned_star(spark, root, "v2"):
        assert retain_versions(spark, root, 2) == ["v1", "v3"]
        assert os.path.isdir(os.path.join(root, "v2"))
    assert retain_versions(spark, root, 2) == ["v2"] and generations(spark, root) == [4, 5]
    swap_pointer(spark, root, "v6")
    assert current_version(spark, root) == "v6"


def test_sample_pair(spark):
    orders = spark.createDataFrame([("demo-001", "delivered", "2018-01-01"), ("demo-002", "canceled", "2018-01-02")], "order_id string, status string, purchased_at string")
    items = spark.createDataFrame([("demo-001", "1", "100.00"), ("demo-001", "2", "50.00"), ("demo-002", "1", "9.99")], "order_id string, item_id string, price string")
    row = sample.checked_overview(orders, items).first()
    assert (row.order_count, row.revenue_cents, row.average_order_value_cents) == (1, 15000, 15000.0)
    bad = orders.withColumn("status", F.lit("lost")).withColumn("purchased_at", F.lit("2018-13-01"))
    with pytest.raises(ConstraintViolation) as err:
        sample.checked_overview(bad, items.withColumn("price", F.lit("-1")))
    assert {(r["constraint"], r["column"]) for r in err.value.rows} == {("domain", "status"), ("date", "purchased_at"), ("money", "price")}
