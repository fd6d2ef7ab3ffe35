"""The streaming daily aggregate equals the batch ``agg_day``, late deliveries included."""
from pyspark.sql import functions as F

from retailq.operators.warehouse import agg_day
from retailq.streaming.daily import read_daily, start_daily_stream

from .fixtures import warehouse_star


def test_stream_matches_batch_with_late_orders(spark, tmp_path):
    fo = warehouse_star(spark)["fact_order"]
    late = fo.withColumn("purchase_date", F.date_sub("purchase_date", 200))
    src, sink, state = (str(tmp_path / n) for n in ("orders", "days", "state"))
    for part in (fo, late):  # the second file's orders were bought long before the first one's
        part.write.mode("append").parquet(src)
        start_daily_stream(spark, src, fo.schema, sink, state).awaitTermination()
    got = {(r.day, r.revenue_cents, r.order_count) for r in read_daily(spark, sink).collect()}
    assert got == {(r.day, r.revenue_cents, r.order_count) for r in agg_day(fo.unionByName(late)).collect()}
