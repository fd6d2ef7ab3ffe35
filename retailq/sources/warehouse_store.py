"""Versioned warehouse storage: immutable version folders plus one small file a generation, named by its number.

The highest generation is the current version. A loader publishes generation n + 1 by renaming a finished file to that name,
which fails if another loader was first: of two loaders one wins, and nothing that was published is lost. Readers resolve
the current version once per analysis, so a load that fails half-way never changes what they see; a reader that stays longer
pins its version. Paths go through the Hadoop FileSystem API, so the same code works on a shared cluster folder.
"""
from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..operators.warehouse import STAR_TABLES

GENERATIONS, PINS = "_generations", "_pins"
# Fact tables carry a purchase-month partition column so date-range scopes prune files.
PARTITIONS = {"fact_order": ["purchase_month"], "fact_item": ["purchase_month"]}


class WarehouseNotReady(Exception):
    """No load has completed yet under this root."""


class ConcurrentLoad(RuntimeError):
    """Another loader published a version after this one had begun."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own making; nothing happens if it is not there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in one of the store's own small folders (generations, pins), in order."""
    fs, p = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(p)) if fs.exists(p) else []


def generations(spark: SparkSession, root: str) -> list[int]:
    """Published generations that are still kept, oldest first."""
    return [int(name) for name in _names(spark, f"{root}/{GENERATIONS}") if name.isdigit()]


def generation(spark: SparkSession, root: str) -> int:
    """Number of the current generation; 0 before the first load."""
    return max(generations(spark, root), default=0)


def _version(spark: SparkSession, root: str, number: int) -> str:
    return read_text(spark, f"{root}/{GENERATIONS}/{number:010d}").strip()


def publish_version(spark: SparkSession, root: str, version_dir: str, seen: int) -> int:
    """Make ``version_dir`` the generation after ``seen``, the one that the load began with; compare-and-swap.

    The file is complete before it gets its name in one step, and a name that exists is never replaced.
    """
    tmp, target = f"{root}/{GENERATIONS}/_{uuid.uuid4().hex}", f"{root}/{GENERATIONS}/{seen + 1:010d}"
    write_text(spark, tmp, version_dir)
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(_fs(spark, tmp)[0].getUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(files.makeQualified(hadoop.Path(tmp)), files.makeQualified(hadoop.Path(target)), options)
    except Py4JJavaError as error:
        remove_tree(spark, tmp)
        if generation(spark, root) > seen:
            raise ConcurrentLoad(f"{root}: generation {seen + 1} was published by another loader") from error
        raise
    return seen + 1


def swap_pointer(spark: SparkSession, root: str, version_dir: str) -> None:
    """Publish after whatever is current now."""
    publish_version(spark, root, version_dir, generation(spark, root))


def current_version(spark: SparkSession, root: str) -> str:
    number = generation(spark, root)
    if not number:
        raise WarehouseNotReady(root)
    return _version(spark, root, number)


@contextmanager
def pinned_star(spark: SparkSession, root: str, version: str | None = None):
    """Star tables of one version that retention leaves alone until the block ends."""
    version = version or current_version(spark, root)
    pin = f"{root}/{PINS}/{version}/{uuid.uuid4().hex}"
    write_text(spark, pin, "")
    try:
        yield read_star(spark, root, version)
    finally:
        remove_tree(spark, pin)


def retain_versions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove versions older than the last ``keep`` that no reader has pinned; returns them. The current one always stays."""
    removed = []
    for number in generations(spark, root)[:-max(1, keep)]:
        version = _version(spark, root, number)
        if not _names(spark, f"{root}/{PINS}/{version}"):
            remove_tree(spark, f"{root}/{GENERATIONS}/{number:010d}")  # first the name, so nobody resolves to half a version
            remove_tree(spark, f"{root}/{version}")
            removed.append(version)
    return removed


def read_star(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    """Star tables of one version (default: CURRENT). Facts keep ``purchase_month``; the scope filters on it
    next to ``purchase_date`` so date ranges prune partitions."""
    version = version or current_version(spark, root)
    return {name: spark.read.parquet(f"{root}/{version}/{name}") for name in STAR_TABLES}


def read_receipt(spark: SparkSession, root: str) -> dict:
    version = current_version(spark, root)
    return json.loads(read_text(spark, f"{root}/{version}/_receipt.json") or "{}")
