"""Shared helpers: tables, the cluster's shared work folder, bounded arrow slices."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Unset: a scratch folder on a local master, else an error."""
    configured = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="retailq-llm-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared root, for one written table."""
    return f"{shared_root(spark)}/retailq-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the rows as a Parquet table in the shared folder and read it back.

    A lost executor then costs only its running tasks. Tables stay until the folder's owner removes them.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(column: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo the number of folds (NULL ids: fold of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def letters_only(column: Column) -> Column:
    """Lower case, every run of other characters than letters and marks as one space, trimmed; NULL becomes empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), r"[^\p{L}\p{M}]+", " "))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Re-slice arrow batches so that the named text or binary column holds about ``limit`` bytes at most (one row at least)."""
    for batch in batches:
        values = batch.column(column)
        if batch.num_rows == 0:
            continue
        begin, used = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False)
        for row, size in enumerate(lengths):
            if used and used + size > limit:
                yield batch.slice(begin, row - begin)
                begin, used = row, 0
            used += int(size)
        yield batch.slice(begin)


def sampled_ids(rows: DataFrame, group: str, most: int | Column) -> DataFrame:
    """doc_id and group of up to ``most`` rows of each group: those with the smallest hash of doc_id.

    Each group is first thinned, by its counted size, to about four times that many rows. A histogram of their hashes then
    tells below which place all rows belong to the sample, and only the rows of the one part that holds the last place are
    ranked. So no task orders a group's rows, and there are few groups (languages, classes): PARTS rows each are broadcast.
    """
    most = F.lit(most) if isinstance(most, int) else most
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("group_rows")).select(
        group, (most * 4.0 / F.col("group_rows") * float(2 ** 63)).alias("bound"))
    thin = rows.select("doc_id", group).join(F.broadcast(sizes), group).withColumn("place", place).where(F.col("place") < F.col("bound"))
    thin = thin.select("doc_id", group, "place", F.floor(F.col("place") / F.least("bound", F.lit(float(2 ** 63))) * PARTS).alias("part"))
    counts = thin.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = counts.withColumn("room", most - before).where(F.col("room") > 0).select(group, "part", "room", (F.col("n") <= F.col("room")).alias("whole"))
    met = thin.join(F.broadcast(found), [group, "part"])
    rank = F.row_number().over(Window.partitionBy(group, "part").orderBy("place", "doc_id"))
    last = met.where(~F.col("whole")).withColumn("rank", rank).where(F.col("rank") <= F.col("room"))
    return met.where("whole").select("doc_id", group).unionByName(last.select("doc_id", group))


PARTS = 256
