"""Full-refresh load job: landing text -> staged text with observed constraints -> key checks -> typed model -> star ->
versioned write -> reconcile -> stability check -> receipt -> publication. All-or-nothing: a version is published only after
every check passed, so a failed run leaves the previous version readable and removes what it wrote; a rerun of the same input
gives the same rows; of two loaders that began with the same version one wins."""
from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import is_missing
from ..operators.checks import (BOUNDED_SUMS, ConstraintViolation, chk_conservation, key_violations, observed_violations,
                                reconcile, row_rules, rule_columns, rule_metrics, typed_model)
from ..operators.warehouse import agg_day, build_star, customer_first, load_profile
from ..sources.landing import (CORRUPT, RECORD, Landing, data_version, fingerprint_metrics, fingerprints, input_identity,
                               record_violations, strip_corrupt)
from ..sources.warehouse_store import (PARTITIONS, generation, publish_version, read_star, remove_tree, retain_versions,
                                       write_text)


class SourceChanged(RuntimeError):
    """Inputs changed while the load ran."""


def _parallel(jobs: dict, workers: int = 8) -> dict:
    """Run independent Spark actions concurrently (separate threads -> concurrent jobs)."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def _staged_table(df: DataFrame, rules: list, sums: list[str] | tuple, path: str) -> dict:
    """Write one landing table and return what was observed on the way: rule counts, bounded sums, rows of a wrong width,
    the content fingerprint and the missing values of every column. No second scan."""
    data = [c for c in df.columns if c not in (CORRUPT, RECORD)]
    seen = Observation(f"staging-{uuid.uuid4().hex}")
    wrong = F.count_if(F.col(CORRUPT).isNotNull()) if CORRUPT in df.columns else F.lit(0).cast("bigint")
    flagged = df.select("*", *rule_columns(rules, sums)).observe(
        seen, *rule_metrics(rules, sums), *fingerprint_metrics(df), wrong.alias("wrong_width"),
        *[F.count_if(is_missing(F.col(c))).alias(f"m{i}") for i, c in enumerate(data)])
    flagged.select(*df.columns).write.mode("overwrite").parquet(path)
    metrics = seen.get
    return {**metrics, "missing": {c: metrics[f"m{i}"] for i, c in enumerate(data)}}


def stage(spark: SparkSession, landing: dict[str, DataFrame], path: str) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """Parse the landing text once and keep it as string parquet in the shared root: later checks read columnar, pruned data,
    and the lineage to the raw files is cut. Returns the staged tables and what was observed of each while writing."""
    cores = spark.sparkContext.defaultParallelism

    def spread(df: DataFrame) -> DataFrame:
        # at least one staged file per core, so every later check runs in parallel; large inputs already have
        # far more splits than cores and are written as they are (no extra shuffle)
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    rules = row_rules(landing)
    observed = _parallel({name: (lambda df=df, name=name: _staged_table(
        spread(df), rules.get(name, []), BOUNDED_SUMS.get(name, ()), f"{path}/{name}")) for name, df in landing.items()})
    return {name: spark.read.parquet(f"{path}/{name}") for name in landing}, observed


def staged_violations(landing: dict[str, DataFrame], observed: dict[str, dict]) -> list[dict]:
    """The row rules' violations table, one row a rule, from the staging pass."""
    rules = row_rules(landing)
    rows = [row for name, metrics in observed.items()
            for row in observed_violations(metrics, name, rules.get(name, []), BOUNDED_SUMS.get(name, ()))]
    return rows + [{"constraint": "rectangular", "table": name, "column": "*", "n": metrics["wrong_width"], "sample_key": None}
                   for name, metrics in observed.items() if CORRUPT in landing[name].columns]


def write_star_staged(spark: SparkSession, star: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Dimensions and fact_order first (concurrently); then fact_item and agg_day from the STORED fact_order, so
    the order plan runs once. Facts are written through a REBALANCE on purchase_month: AQE coalesces small months
    into few files and splits a hot month over several tasks, without an extra sampling pass."""
    fo = star["fact_order"].withColumn("purchase_month", F.trunc("purchase_date", "month"))
    first = {"dim_customer": star["dim_customer"], "dim_product": star["dim_product"],
             "dim_seller": star["dim_seller"],
             "fact_order": fo.hint("rebalance", "purchase_month")}
    _parallel({k: (lambda k=k, df=df: _write(df, k, f"{path}/{k}")) for k, df in first.items()})
    stored_fo = spark.read.parquet(f"{path}/fact_order")
    months = stored_fo.select("order_id", "purchase_month")
    second = {"fact_item": star["fact_item"].join(months, "order_id", "left")
              .hint("rebalance", "purchase_month"),
              "agg_day": agg_day(stored_fo).repartition(1),  # one row a day, summed by all tasks before
              "customer_first": customer_first(stored_fo, spark.read.parquet(f"{path}/dim_customer"))}
    _parallel({k: (lambda k=k, df=df: _write(df, k, f"{path}/{k}")) for k, df in second.items()})
    return read_star(spark, path.rsplit("/", 1)[0], path.rsplit("/", 1)[1])


def _write(df: DataFrame, name: str, path: str) -> None:
    writer = df.write.mode("errorifexists")
    if name in PARTITIONS:
        writer = writer.partitionBy(*PARTITIONS[name])
    writer.parquet(path)


def run_load(spark: SparkSession, landing: dict[str, DataFrame], root: str, strict: bool = True,
             run_id: str | None = None, keep: int = 3, _fail_before_swap: bool = False, _before_stability=None,
             _before_publish=None) -> dict:
    """Load one landing snapshot into ``root``; returns the receipt. ``strict=False`` records violations in the
    receipt instead of refusing the input (for inputs known to break a rule, e.g. generated test data). ``keep``: published
    versions that stay, besides those that readers have pinned. Staging is removed at the end, and so is the version of a
    run that fails."""
    root, run_id = root.rstrip("/"), run_id or uuid.uuid4().hex[:8]
    staging, written = f"{root}/_staging/{run_id}", []
    try:
        receipt = _run(spark, landing, root, staging, strict, run_id, written, _fail_before_swap, _before_stability, _before_publish)
    except BaseException:
        for path in written:
            remove_tree(spark, path)
        raise
    finally:
        remove_tree(spark, staging)
    receipt["removed_versions"] = retain_versions(spark, root, keep)
    return receipt


def _run(spark, landing, root, staging, strict, run_id, written, fail_before_swap, before_stability, before_publish) -> dict:
    clock = [time.time()]
    phases = {}

    def lap(name):
        now = time.time()
        phases[name] = round(now - clock[0], 3)
        clock[0] = now

    seen = generation(spark, root)
    paths = landing.paths if isinstance(landing, Landing) else None
    identity = lambda: input_identity(spark, paths).first().asDict() if paths else None
    identity_before = identity()  # file-backed sources: a listing, taken before anything is read
    staged, observed = stage(spark, landing, staging)
    lap("stage")
    checks = key_violations(strip_corrupt(staged))
    if paths:
        checks = checks.unionByName(record_violations(spark, paths, {name: m["rows"] for name, m in observed.items()}))
    bad = [r for r in staged_violations(staged, observed) if r["n"] > 0]
    bad += [r.asDict() for r in checks.filter(F.col("n") > 0).collect()]  # at most one row a constraint
    lap("constraints")
    if bad and strict:
        raise ConstraintViolation(bad)
    if any(r["constraint"] == "bounded_sum" for r in bad):
        raise ConstraintViolation([r for r in bad if r["constraint"] == "bounded_sum"])
    prints = [{"table": name, **{k: m[k] for k in ("rows", "hash_sum", "hash_xor")}} for name, m in observed.items()]
    version = data_version(prints)
    typed = typed_model(strip_corrupt(staged))
    version_dir = f"v={version}-{run_id}"
    path = f"{root}/{version_dir}"
    written.append(path)
    stored = write_star_staged(spark, build_star(typed), path)
    lap("write_star")
    checks = reconcile(stored, typed).unionByName(
        chk_conservation(stored["fact_order"], typed["items"]).select(
            F.lit("conservation").alias("check"), F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("expected")).withColumn("passed", F.col("expected") == 0))
    rec = [r.asDict() for r in checks.collect()]  # twelve rows
    lap("reconcile")
    failed = [r for r in rec if not r["passed"]]
    if failed:
        raise ConstraintViolation([{"constraint": "reconcile", "table": "*", "column": r["check"],
                                    "n": r["actual"], "sample_key": str(r["expected"])} for r in failed])
    if before_stability is not None:
        before_stability()
    if paths:
        changed = identity() != identity_before
    else:  # not file-backed: fingerprint the content again
        changed = data_version([r.asDict() for r in fingerprints(strip_corrupt(landing)).collect()]) != version
    if changed:
        raise SourceChanged("landing data changed during the load; nothing published")
    lap("stability")
    profile = load_profile(typed, stored).collect()[0].asDict()
    lap("profile")
    receipt = {
        "etl_schema_version": 2, "data_version": version, "version_dir": version_dir, "generation": seen + 1,
        "imported_at": datetime.now(timezone.utc).isoformat(),
        **{k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in profile.items()},
        "fingerprints": prints, "missing_values": {name: m["missing"] for name, m in observed.items()},
        "input_identity": identity_before, "reconciliation": rec, "violations": bad, "phase_seconds": phases,
    }
    write_text(spark, f"{path}/_receipt.json", json.dumps(receipt, sort_keys=True, default=str))
    if fail_before_swap:
        raise RuntimeError("injected failure before the publication")
    if before_publish is not None:
        before_publish()
    publish_version(spark, root, version_dir, seen)
    return receipt
