"""Structured Streaming form of the daily aggregate: every micro-batch leaves its per-day sums, reading adds them up.

There is no watermark: an order that is delivered weeks after its purchase counts on its purchase day whenever it comes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_sums(orders: DataFrame) -> DataFrame:
    """Per purchase day of delivered order facts: revenue_cents, order_count, item_count."""
    return orders.where(F.col("status") == "delivered").groupBy(F.col("purchase_date").alias("day")).agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.count(F.lit(1)).alias("order_count"),
        F.sum("item_count").alias("item_count"))


def start_daily_stream(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                       once: bool = True) -> StreamingQuery:
    """File source of order facts -> one folder of per-day sums for each micro-batch. A batch that is run again
    overwrites its own folder, so nothing counts twice. Both folders must be on shared storage."""
    def leave(batch: DataFrame, epoch: int) -> None:
        daily_sums(batch).write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch}")

    writer = spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(leave).option(
        "checkpointLocation", checkpoint_dir)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def read_daily(spark: SparkSession, sink_dir: str) -> DataFrame:
    """day, revenue_cents, order_count, item_count over all batches so far: the numbers of ``agg_day``."""
    return spark.read.parquet(sink_dir).groupBy("day").agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.sum("order_count").alias("order_count"),
        F.sum("item_count").alias("item_count"))
