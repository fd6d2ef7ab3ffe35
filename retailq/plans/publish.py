"""Publishing: aggregate snapshots for many preset scopes in one job, identifier denylist at any nesting depth,
declared section contract, manifest (bytes, sha256, rows), report JSON sink, and cross-view consistency."""
from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scope import coverage_from_daily, coverage_window
from ..params import AnomalyRules, RfmRules
from ..sources.warehouse_store import write_text
from ..sources.work_tables import WorkFolder
from .snapshots import SECTIONS, Snapshots

# Keys of persons, orders and free text that must never leave the warehouse in a published aggregate
# (product ids may: rankings name them), and endings that mark more of the kind.
DENYLIST = frozenset({"order_id", "customer_id", "customer_unique_id", "seller_id", "review_id", "customer_zip_code_prefix",
                      "customer_city", "address", "email", "phone", "payment_sequential", "review_text", "review_body",
                      "geolocation_lat", "geolocation_lng", "review_comment_title", "review_comment_message"})
DENIED_ENDINGS = ("zip_code_prefix", "_city", "_address", "_email", "_phone")
SNAPSHOT_SECTIONS = SECTIONS


class PublishRefused(ValueError):
    """A section exposes a forbidden key, or the section set differs from the contract."""


def forbidden_paths(dtype: T.DataType, denylist=DENYLIST, prefix: str = "") -> list[str]:
    """Every field path whose name is in the denylist or has a denied ending, at any depth (structs, arrays, maps)."""
    out = []
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            if f.name.lower() in denylist or f.name.lower().endswith(DENIED_ENDINGS):
                out.append(path)
            out += forbidden_paths(f.dataType, denylist, path)
    elif isinstance(dtype, T.ArrayType):
        out += forbidden_paths(dtype.elementType, denylist, prefix + "[]")
    elif isinstance(dtype, T.MapType):
        out += forbidden_paths(dtype.keyType, denylist, prefix + "{}") + forbidden_paths(dtype.valueType, denylist, prefix + "{}")
    return out


def check_publishable(sections: dict[str, DataFrame], contract=SNAPSHOT_SECTIONS, denylist=DENYLIST) -> None:
    if set(sections) != set(contract):
        raise PublishRefused(f"sections {sorted(sections)} differ from the contract {sorted(contract)}")
    bad = {name: forbidden_paths(df.schema, denylist) for name, df in sections.items()}
    bad = {k: v for k, v in bad.items() if v}
    if bad:
        raise PublishRefused(f"forbidden keys: {bad}")


def write_report_json(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per section; NULLs are kept as explicit nulls (no NaN in JSON)."""
    for name, df in sections.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per written file: relative path, bytes and sha256 (aggregate outputs are small, bounded files)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json") \
        .load(path)
    return files.select(F.regexp_replace("path", r"^.*?/(preset=|section=)", "$1").alias("file"),
                        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


# ---- all presets in one job -------------------------------------------------------------------------------------

PRESET_SCHEMA = "preset string, start date, end date, category string, state string"


def with_comparison(presets: DataFrame) -> DataFrame:
    """Add each preset's comparison window: a full calendar month compares with the previous calendar month,
    anything else with the previous period of equal length (same rule as ``ScopeParams.comparison``)."""
    full_month = ((F.dayofmonth("start") == 1) & (F.trunc("start", "month") == F.trunc("end", "month"))
                  & (F.col("end") == F.last_day("end")))
    prev_end = F.date_sub("start", 1)
    return presets.select(
        "*", F.when(full_month, F.trunc(prev_end, "month"))
        .otherwise(F.date_sub(prev_end, F.datediff("end", "start"))).alias("prev_start"),
        prev_end.alias("prev_end"),
        F.when(full_month, F.lit("previous_calendar_month")).otherwise(F.lit("previous_equal_period"))
        .alias("comparison_label"))


def preset_table(spark: SparkSession, presets: list[tuple]) -> DataFrame:
    return with_comparison(spark.createDataFrame(presets, PRESET_SCHEMA))


def preset_sections(star, presets: DataFrame, work: WorkFolder, coverage_row: DataFrame | None = None,
                    rules: RfmRules = RfmRules(), anomaly: AnomalyRules = AnomalyRules(), names=SECTIONS) -> dict[str, DataFrame]:
    """Published sections for every preset, read from the work tables of one tagged scope (see ``snapshots``)."""
    if coverage_row is None:
        coverage_row = coverage_from_daily(star["agg_day"])
    return Snapshots(star, presets, coverage_row, work, rules, anomaly).sections(names)


def publish_snapshots(spark: SparkSession, star, presets: DataFrame, path: str, coverage_row: DataFrame | None = None,
                      rules: RfmRules = RfmRules(), anomaly: AnomalyRules = AnomalyRules(), workers: int = 8) -> DataFrame:
    """Write every section of every preset (one folder a section and preset), refusing identifiers; returns the manifest.

    Rows are counted while they are written. The work tables are removed at the end, also after an error.
    """
    with WorkFolder(spark, "snapshots") as work:
        sections = preset_sections(star, presets, work, coverage_row, rules, anomaly)
        check_publishable(sections)
        rows = write_sections(sections, path, workers)
    files = manifest(spark, path)
    write_text(spark, f"{path}/_manifest.json", json.dumps(
        {"rows": rows, "files": [r.asDict() for r in files.collect()]}, sort_keys=True))  # one row a section and preset
    return files


def write_sections(sections: dict[str, DataFrame], path: str, workers: int = 8) -> dict[str, int]:
    """Concurrent JSON writes, one file a section and preset; NULLs stay explicit. Returns the rows of each section."""

    def write(name: str) -> int:
        seen = Observation(f"rows-{name}")
        sections[name].observe(seen, F.count(F.lit(1)).alias("rows")).repartition("preset").write.mode("overwrite") \
            .partitionBy("preset").option("ignoreNullFields", "false").json(f"{path}/section={name}")
        return seen.get["rows"]

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(sections)))) as pool:
        return dict(zip(sections, pool.map(write, sections)))


# ---- consistency ------------------------------------------------------------------------------------------------

def cross_view_consistency(totals: dict[str, DataFrame]) -> DataFrame:
    """``totals``: view name -> one-row DataFrame with ``revenue_cents``. One row: distinct totals and pass flag."""
    rows = None
    for name, df in totals.items():
        r = df.select(F.lit(name).alias("view"), F.col("revenue_cents").cast("bigint").alias("revenue_cents"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.agg(F.count_distinct("revenue_cents").alias("distinct_totals"),
                    F.collect_list(F.struct("view", "revenue_cents")).alias("views")) \
        .withColumn("consistent", F.col("distinct_totals") == 1)


def verify_equal(published: DataFrame, recomputed: DataFrame, ignore: tuple = ("generated_at",)) -> DataFrame:
    """Rows present on one side only (both directions of exceptAll); empty means equal."""
    cols = [c for c in recomputed.columns if c not in ignore]
    a, b = published.select(*cols), recomputed.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("published_only")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("recomputed_only")))
