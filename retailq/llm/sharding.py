"""Shards from a hierarchical weighted hash tree (regions, racks, shards).

At each level a document draws u in (0, 1) for every child from a hash of (doc_id, child name) and takes the child with
the smallest -ln(u) / weight. A child's draw depends on its own name and weight only, so a changed weight moves
documents into or out of that subtree and nowhere else. A new shard is hung in as a region of its own: then no weight
of an older subtree changes, and the documents that move all move into the new shard.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def uniform_tree(regions: int, racks: int, shards: int) -> tuple[Shard, ...]:
    """Shards numbered in order over equal regions and racks."""
    return tuple(Shard(f"region{r}", f"region{r}/rack{k}", (r * racks + k) * shards + s)
                 for r in range(regions) for k in range(racks) for s in range(shards))


def with_new_shard(tree: tuple[Shard, ...], weight: float = 1.0) -> tuple[Shard, ...]:
    """The tree with one more shard, in a region and rack of its own."""
    number = max((s.shard for s in tree), default=-1) + 1
    return (*tree, Shard(f"region-of-{number}", f"region-of-{number}/rack", number, weight))


def _pick(key: Column, children: dict[str, tuple[float, object]]) -> Column:
    """The value of the child with the smallest draw, ties to the first name; children of weight 0 never take part."""
    draws = []
    for name, (weight, value) in sorted(children.items()):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("|", key, F.lit(name))), 11)
            draw = -F.log((bits + F.lit(0.5)) * F.lit(2.0 ** -53)) / F.lit(float(weight))
            draws.append(F.struct(draw.alias("draw"), F.lit(name).alias("name"), F.lit(value).alias("value")))
    return F.array_min(F.array(*draws))["value"] if draws else F.lit(None)


def place(rows: DataFrame, key: str, tree: tuple[Shard, ...], name: str) -> DataFrame:
    """The rows with the shard of their key: descend region, rack and shard, one column for each level."""
    regions: dict[str, dict[str, dict[str, tuple[float, int]]]] = {}
    for s in tree:
        regions.setdefault(s.region, {}).setdefault(s.rack, {})[f"{s.rack}/shard{s.shard}"] = (s.weight, s.shard)
    racks = {rack: leaves for inner in regions.values() for rack, leaves in inner.items()}
    weight = {rack: sum(w for w, _ in leaves.values()) for rack, leaves in racks.items()}
    in_region, in_rack = f"{name}_region", f"{name}_rack"
    region = _pick(F.col(key), {r: (sum(weight[k] for k in inner), r) for r, inner in regions.items()})
    rack, shard = F.lit(None).cast("string"), F.lit(None).cast("int")
    for r, inner in regions.items():
        rack = F.when(F.col(in_region) == r, _pick(F.col(key), {k: (weight[k], k) for k in inner})).otherwise(rack)
    for k, leaves in racks.items():
        shard = F.when(F.col(in_rack) == k, _pick(F.col(key), leaves)).otherwise(shard)
    return (rows.withColumn(in_region, region.cast("string")).withColumn(in_rack, rack)
            .withColumn(name, shard.cast("int")).drop(in_region, in_rack))


def assign_shards(docs: DataFrame, tree: tuple[Shard, ...], rows_per_run: int = 100_000) -> DataFrame:
    """Per document: doc_id, size (UTF-8 bytes + 8; NULL text: 8), text_crc32, law 'key', shard, slot, grown_shard.

    NULL ids draw as the text 'null' and so share a shard; repeated ids share theirs. Slots count from 0 within a shard,
    without gaps: a shard is cut into runs by a hash of id and text, runs are numbered each by itself and shifted by the
    rows of the runs before them, so no task orders a whole shard. Other columns are ignored; no rows give no rows.
    """
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("key"),
        (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).cast("long").alias("text_crc32"))
    rows = place(place(rows, "key", tree, "shard"), "key", with_new_shard(tree), "grown_shard").drop("key")
    placed = stored(rows, "shards")
    runs = max(4, -(-placed.count() // (max(1, len(tree)) * rows_per_run)))
    cut = placed.withColumn("run", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(runs)).cast("int"))
    # One row for each shard and run, so about rows / rows_per_run rows, ordered within a shard.
    counts = cut.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")) - 1
    return (cut.withColumn("nth", nth).join(before, ["shard", "run"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("nth") + F.col("before")).cast("long").alias("slot"), "grown_shard"))
