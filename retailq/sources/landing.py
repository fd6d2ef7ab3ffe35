"""Landing CSV source: declared files read as strings, header and rectangularity checks, fingerprints.

Every column is read as text with an explicit all-string schema (no inference); empty fields become '' again right
after reading; required columns are stripped of surrounding whitespace. Malformed rows are captured in a
``_corrupt`` column and counted on a full-width projection (column pruning would hide them).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.parse import trimmed
from ..schema import FIELD_NAMES

# Landing file names and required columns per table.
FILES = {
    "orders": "olist_orders_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "translation": "product_category_name_translation.csv",
}
AUDIT_FILES = {**FILES, "geolocation": "olist_geolocation_dataset.csv"}
REQUIRED = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_state"],
    "products": ["product_id", "product_category_name"],
    "sellers": ["seller_id", "seller_state"],
    "payments": ["order_id", "payment_sequential", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"],
    "translation": ["product_category_name", "product_category_name_english"],
}
CORRUPT = "_corrupt"
# Where a record stood in the input: (file, block, running number inside it); ties between records end on it.
RECORD = "_record"
ORDERED_TABLES = frozenset({"reviews"})


class LandingError(ValueError):
    """Raised when a landing file is missing, has a bad header or is not rectangular."""


class Landing(dict):
    """Tables by name, and ``paths``: the file or folder of each."""

    def __init__(self, tables: dict[str, DataFrame], paths: dict[str, str]):
        super().__init__(tables)
        self.paths = paths


def read_header(spark: SparkSession, path: str) -> list[str]:
    """First line of a CSV (one-row lookup)."""
    first = spark.read.option("header", False).option("encoding", "UTF-8").csv(path).limit(1).collect()
    if not first:
        raise LandingError(f"{path}: empty file")
    return [("" if v is None else v).lstrip("﻿") for v in first[0]]


def read_csv_strings(spark: SparkSession, path: str, required: list[str] | None = None,
                     declared: frozenset[str] | None = None, ordered: bool = False) -> DataFrame:
    """All-string read with header validation; keeps ``_corrupt`` for the rectangularity check. ``ordered``: also keep
    each record's place in the input; a file of multi-line records is read by one task, so the numbers follow the file."""
    header = read_header(spark, path)
    if len(header) != len(set(header)) or not header:
        raise LandingError(f"{path}: duplicate or empty header")
    if required and not set(required).issubset(header):
        raise LandingError(f"{path}: missing required columns {sorted(set(required) - set(header))}")
    if declared is not None and any(c not in declared for c in header):
        raise LandingError(f"{path}: undeclared columns {[c for c in header if c not in declared]}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                          + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).option("encoding", "UTF-8")
          .option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))
    cols = []
    for c in header:
        v = F.coalesce(F.col(c), F.lit(""))
        cols.append((trimmed(v) if required and c in required else v).alias(c))
    if ordered:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("number")).alias(RECORD))
    return df.select(*cols, CORRUPT)


def rectangular_violations(df: DataFrame, table: str) -> DataFrame:
    """One row: rows whose field count differs from the header. The width of the data columns stands in the condition,
    so that a frame straight from the reader is parsed whole (the reader refuses a scan of the corrupt column alone)."""
    data_cols = [c for c in df.columns if c not in (CORRUPT, RECORD)]
    width = F.length(F.concat_ws("\u0001", *[F.col(c) for c in data_cols]))
    return df.agg(F.count_if(F.col(CORRUPT).isNotNull() & (width >= 0)).alias("n")).select(
        F.lit("rectangular").alias("constraint"), F.lit(table).alias("table"), F.lit("*").alias("column"), "n",
        F.lit(None).cast("string").alias("sample_key"))


def read_landing(spark: SparkSession, directory: str, files: dict[str, str] = FILES,
                 declared: frozenset[str] | None = None) -> Landing:
    """Every table of a landing folder. ``declared``: refuse headers with any other column."""
    paths = {name: f"{directory.rstrip('/')}/{filename}" for name, filename in files.items()}
    return Landing({name: read_csv_strings(spark, path, REQUIRED.get(name), declared, name in ORDERED_TABLES)
                    for name, path in paths.items()}, paths)


def read_audit_landing(spark: SparkSession, directory: str) -> Landing:
    """All nine tables for an audit: every column must be in the field registry, every row as wide as its header, and the
    parser must find as many records as the independent counter."""
    landing = read_landing(spark, directory, AUDIT_FILES, FIELD_NAMES)
    parts = [rectangular_violations(df, name) for name, df in landing.items()]
    parts.append(record_violations(spark, landing.paths, {n: df.count() for n, df in strip_corrupt(landing).items()}))
    bad = [r for part in parts for r in part.filter(F.col("n") > 0).collect()]  # at most two rows a table
    if bad:
        raise LandingError("; ".join(f"{r['table']}: {r['constraint']} {r['n']}" for r in bad))
    return landing


# ---- independent record counter ---------------------------------------------------------------------------------

def record_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file, records, unclosed) without the CSV parser: a record ends at the end of a line that is outside quotes, which the
    number of quote characters before it tells. Headers count; empty lines outside quotes do not.

    Lines are read in blocks, so a file of any size is counted by many tasks. A block does not know whether it begins inside
    quotes: it counts both ways and gives the parity of its quotes; a prefix sum over the blocks of a file (one row a
    block) then picks the way.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, outside, inside, parity = None, 0, 0, 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([outside], pa.int64()), pa.array([inside], pa.int64()),
                 pa.array([parity], pa.int64())], names=["file", "block", "outside", "inside", "parity"])

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
            quotes = batch.column("quotes").to_numpy(zero_copy_only=False)
            filled = batch.column("filled").to_numpy(zero_copy_only=False)
            names = pa.compute.dictionary_encode(files)
            codes = names.indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
            for begin, end in zip(np.r_[0, cuts], np.r_[cuts, len(blocks)]):
                key = (names.dictionary[int(codes[begin])].as_py(), int(blocks[begin]))
                if key != now:
                    if now is not None:
                        yield row()
                    now, outside, inside, parity = key, 0, 0, 0
                after = (parity + np.cumsum(quotes[begin:end])) % 2
                outside += int(((after == 0) & filled[begin:end]).sum())
                inside += int(((after == 1) & filled[begin:end]).sum())
                parity = int(after[-1])
        if now is not None:
            yield row()

    text = F.col("value")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))).alias("quotes"), (text != "").alias("filled"))
    blocks = lines.mapInArrow(count, "file string, block long, outside long, inside long, parity long")
    before = F.coalesce(F.sum("parity").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.withColumn("quoted", before % 2 == 1).groupBy("file").agg(
        F.sum(F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))).alias("records"),
        (F.sum("parity") % 2 == 1).alias("unclosed"))


def record_violations(spark: SparkSession, paths: dict[str, str], parsed: dict[str, int]) -> DataFrame:
    """Two rows a table: files that end inside quotes, and the difference between counted and parsed records."""
    parts = []
    for name, path in paths.items():
        counted = record_counts(spark, path).agg(
            F.count_if("unclosed").alias("unclosed"), F.coalesce(F.sum(F.greatest(F.col("records") - 1, F.lit(0))), F.lit(0)).alias("records"))
        parts.append(counted.select(F.lit(name).alias("table"), F.explode(F.array(
            F.struct(F.lit("unclosed_quote").alias("constraint"), F.col("unclosed").cast("bigint").alias("n")),
            F.struct(F.lit("record_count").alias("constraint"), F.abs(F.col("records") - F.lit(parsed[name])).cast("bigint").alias("n"))))
            .alias("v")).select("v.constraint", "table", F.lit("*").alias("column"), "v.n", F.lit(None).cast("string").alias("sample_key")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_landing(landing: dict[str, DataFrame], directory: str, files: dict[str, str] = FILES) -> None:
    """The landing tables as CSV folders that ``read_landing`` reads back: every value quoted, quotes doubled, white
    space kept. Each table is written as many files, since a file of multi-line records is not split."""
    for name, filename in files.items():
        landing[name].write.option("header", True).option("quoteAll", True).option("escape", '"') \
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
            .csv(f"{directory.rstrip('/')}/{filename}")


def strip_corrupt(landing: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: (v.drop(CORRUPT) if CORRUPT in v.columns else v) for k, v in landing.items()}


# ---- fingerprints -----------------------------------------------------------------------------------------------

def input_identity(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row identifying the files below the landing roots: count plus sum and xor of a 64-bit hash of (path, length,
    modification time). Spark lists the folders, in parallel where there are many; content is never read, so the stability
    check after the load costs a listing instead of a second scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(set(paths.values())))
    h = F.xxhash64("path", "length", "modificationTime")
    return files.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(h.cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("hash_sum"),
        F.coalesce(F.bit_xor(h), F.lit(0).cast("bigint")).alias("hash_xor"))


def fingerprint_metrics(df: DataFrame) -> list:
    """Order-insensitive content fingerprint: row count, sum and xor of a 64-bit row hash."""
    cols = [c for c in df.columns if c not in (CORRUPT, RECORD)]
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
            F.bit_xor(h).alias("hash_xor")]


def row_fingerprint(df: DataFrame, table: str) -> DataFrame:
    return df.agg(*fingerprint_metrics(df)).select(F.lit(table).alias("table"), "*")


def fingerprints(landing: dict[str, DataFrame]) -> DataFrame:
    parts = [row_fingerprint(df, name) for name, df in landing.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def data_version(fingerprint_rows: list) -> str:
    """16 hex characters over the sorted per-table fingerprints (the fingerprint table is one row per table)."""
    text = "|".join(sorted(f"{r['table']}:{r['rows']}:{r['hash_sum']}:{r['hash_xor']}" for r in fingerprint_rows))
    return hashlib.sha256(text.encode()).hexdigest()[:16]
