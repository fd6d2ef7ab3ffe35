"""Exact quantiles on (value, count) pairs, one algorithm for inputs of every size.

Rows are first folded to one count per distinct value (map-side too, so a value that most rows share costs one row per
task). Distinct values are then put into ordered buckets, about 4096 for each e-fold of the value; a window over a
group's bucket counts tells which bucket holds each wanted rank, and a window over that bucket's distinct values picks
the value. The bucket is a function of the value alone: no sampling, no checkpoint, no driver step, and a lost executor
changes nothing. A window reads a group's buckets, or the distinct values of one bucket, never its rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS_PER_EFOLD = 4096
_FAR = 750 * BUCKETS_PER_EFOLD  # beyond the logarithm of any finite double, either way


def _bucket(value: Column) -> Column:
    """Never falls as the value grows: logarithms are monotone, zero lies between the signs, NaN comes last."""
    step = F.least(F.floor(F.least(F.log(F.abs(value)), F.lit(749.0)) * BUCKETS_PER_EFOLD), F.lit(_FAR - 1)) + _FAR
    return (F.when(F.isnan(value), F.lit(4 * _FAR)).when(value == 0, F.lit(0))
            .when(value > 0, step).otherwise(-step)).cast("bigint")


def _rank(total: Column, q: float, method: str, part: str) -> Column:
    """Zero-based rank below (``lo``) or above (``hi``) the wanted position; both the same for ``nearest``."""
    if method == "nearest":
        return F.greatest(F.ceil(F.lit(q) * total).cast("bigint") - 1, F.lit(0).cast("bigint"))
    position = (total - 1) * F.lit(q)
    return (F.floor(position) if part == "lo" else F.ceil(position)).cast("bigint")


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, tuple[float, str]],
                    by: list[str] | tuple = (), weight: str | None = None) -> DataFrame:
    """One row per group with a column per requested quantile.

    ``probs``: output name -> (q, method); method ``linear`` matches ``percentile`` (interpolation at (n-1)q),
    ``nearest`` matches ``percentile_disc`` (smallest value with cumulative share >= q). ``weight``: a column that tells
    how many rows a row stands for. NULL values are left out; groups without values produce no row."""
    by = list(by)
    rows = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    counts = df.select(*by, F.col(value).cast("double").alias("_v"), rows.alias("_w")).filter(F.col("_v").isNotNull()) \
        .groupBy(*by, "_v").agg(F.sum("_w").alias("_c")).withColumn("_b", _bucket(F.col("_v")))
    group = by or [F.lit(1)]

    def before(window) -> Column:
        return F.coalesce(F.sum("_c").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))

    buckets = counts.groupBy(*by, "_b").agg(F.sum("_c").alias("_c")) \
        .withColumn("_before", before(Window.partitionBy(*group).orderBy("_b"))) \
        .withColumn("_n", F.sum("_c").over(Window.partitionBy(*group)))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(part).alias("part"),
                                _rank(F.col("_n"), q, method, part).alias("rank"))
                       for name, (q, method) in probs.items() for part in ("lo", "hi")])
    here = F.filter(wanted, lambda t: (t["rank"] >= F.col("_before")) & (t["rank"] < F.col("_before") + F.col("_c")))
    located = buckets.withColumn("_wanted", here).filter(F.size("_wanted") > 0).select(
        *[F.col(b).alias(f"_l_{b}") for b in by], F.col("_b").alias("_lb"), F.col("_before").alias("_base"), "_n", "_wanted")
    on = F.col("_b") == F.col("_lb")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_l_{b}"))
    # a few buckets for each group: AQE sees their real size before it picks the join
    near = counts.join(located, on).withColumn(
        "_from", F.col("_base") + before(Window.partitionBy(*by, "_b").orderBy("_v")))
    hits = near.select(*by, "_v", "_n", F.explode(F.filter(
        "_wanted", lambda t: (t["rank"] >= F.col("_from")) & (t["rank"] < F.col("_from") + F.col("_c")))).alias("_t"))
    parts = [F.max(F.when((F.col("_t.name") == name) & (F.col("_t.part") == part), F.col("_v"))).alias(f"_{part}_{i}")
             for i, name in enumerate(probs) for part in ("lo", "hi")]
    found = (hits.groupBy(*by) if by else hits).agg(F.max("_n").alias("_n"), *parts)
    out = []
    for i, (name, (q, method)) in enumerate(probs.items()):
        low, high = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        position = (F.col("_n") - 1) * F.lit(q)
        # same arithmetic as Spark's percentile: (hi_rank - pos) * lo_value + (pos - lo_rank) * hi_value
        linear = F.when(F.floor(position) == F.ceil(position), low).otherwise(
            (F.ceil(position) - position) * low + (position - F.floor(position)) * high)
        out.append((low if method == "nearest" else linear).alias(name))
    return found.select(*by, *out)
