"""Token counts through a digest cache: stored counts are joined, only distinct missing contents are encoded."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, work_path
from .word_tokens import open_tokenizer

CACHE = "tokenizer binary, content binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file: another version never meets the counts of this one."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised content: runs of ASCII white space as one space, ends trimmed.

    The tokenizer's own normaliser makes any run of white space one space, and its pre-tokenizer drops spaces, so
    contents of one digest have one count. Letter case is kept, since special tokens are matched before lower-casing.
    """
    return F.unhex(F.sha2(F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")), 256))


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def fill_cache(docs: DataFrame, cache_path: str, tokenizer_path: str) -> None:
    """Append the counts of contents that the cache lacks. One writer at a time; Spark's committer adds all rows or none."""
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    if not path_exists(spark, cache_path):
        spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)
    known = stored_counts(spark, cache_path, version).select("content")
    text = F.coalesce("text", F.lit(""))
    misses = (docs.select(content_digest(text).alias("content"), text.alias("text"))
              .groupBy("content").agg(F.first("text").alias("text")).join(known, "content", "left_anti"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = open_tokenizer(tokenizer_path, keep_ids=False)
        for batch in byte_slices(batches, "text", 16 << 20):
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([bytes.fromhex(version)] * n, pa.binary()), batch.column("content"),
                 pa.array(tokenizer.count(batch.column("text")), pa.int64())],
                names=["tokenizer", "content", "n_tokens"])

    misses.mapInArrow(count, CACHE).write.mode("append").parquet(cache_path)


def stored_counts(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    return (spark.read.schema(CACHE).parquet(cache_path)
            .where(F.col("tokenizer") == F.unhex(F.lit(version))).select("content", "n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int, cache_path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    NULL texts count as empty. Repeated rows and NULL ids keep a row each; other columns are ignored. Without a cache
    path, a new cache in the shared folder is used. The last join looks up written counts, so that Spark may split a
    content that many rows share.
    """
    spark = docs.sparkSession
    cache_path = cache_path or work_path(spark, "token-counts")
    fill_cache(docs, cache_path, tokenizer_path)
    counts = stored_counts(spark, cache_path, tokenizer_version(tokenizer_path))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content_digest(text).alias("content"))
    return rows.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
