"""Nearest neighbours by vantage-point trees, one tree for each shard of the vectors.

A node takes its first vector as vantage point and parts the others at the median distance to it. By the triangle
inequality no vector of a part is nearer to a query than the gap between the query's own distance to the vantage point
and the part's range of distances. A part is skipped where factor * gap exceeds the distance of the k-th best so far:
factor 1 is exact search, larger factors skip more and may miss neighbours.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEAF = 64


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, dimension by dimension (so sums have one order everywhere)."""
    total = np.zeros((len(queries), len(vectors)))
    for j in range(queries.shape[1]):
        gap = queries[:, j, None] - vectors[None, :, j]
        total += gap * gap
    return np.sqrt(total)


@dataclass
class Tree:
    """Vectors in tree order; ``nodes`` has (begin, middle, end, inner, outer) and ``ranges`` the four bounds of each node."""
    ids: np.ndarray
    vectors: np.ndarray
    nodes: np.ndarray
    ranges: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> "Tree":
        order = np.arange(len(ids))
        nodes: list[list[int]] = []
        ranges: list[list[float]] = []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            begin, end, parent, side = todo.pop()
            number = len(nodes)
            if parent >= 0:
                nodes[parent][side] = number
            if end - begin <= LEAF:
                nodes.append([begin, begin, end, -1, -1])
                ranges.append([0.0] * 4)
                continue
            part = order[begin + 1:end]
            far = distances(vectors[order[begin]][None], vectors[part])[0]
            rank = np.argsort(far, kind="stable")
            order[begin + 1:end] = part[rank]
            far = far[rank]
            half = len(far) // 2
            middle = begin + 1 + half
            nodes.append([begin, middle, end, -1, -1])
            ranges.append([far[0], far[half - 1], far[half], far[-1]])
            todo += [(middle, end, number, 4), (begin + 1, middle, number, 3)]
        return cls(ids[order], vectors[order], np.array(nodes, np.int64).reshape(-1, 5), np.array(ranges).reshape(-1, 4))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the k nearest found for each query, its own id left out; gaps are inf and -1."""
        n = len(queries)
        best = np.full((n, k), np.inf)
        names = np.full((n, k), -1, np.int64)

        def offer(rows: np.ndarray, begin: int, end: int, far: np.ndarray) -> None:
            ids = np.broadcast_to(self.ids[begin:end], far.shape)
            far = np.where(ids == query_ids[rows, None], np.inf, far)
            far, ids = np.concatenate((best[rows], far), axis=1), np.concatenate((names[rows], ids), axis=1)
            ids = np.where(np.isinf(far), -1, ids)
            order = np.lexsort((ids, far), axis=-1)[:, :k]
            best[rows], names[rows] = np.take_along_axis(far, order, 1), np.take_along_axis(ids, order, 1)

        # Each query first visits the leaf that it would lie in, so that the bounds are tight from the start.
        home = np.full(n, -1)
        todo = [(0, np.arange(n))]
        while todo and n:
            number, rows = todo.pop()
            begin, middle, end, inner, outer = self.nodes[number]
            if not len(rows):
                continue
            if inner < 0:
                home[rows] = number
                offer(rows, begin, end, distances(queries[rows], self.vectors[begin:end]))
                continue
            far = distances(queries[rows], self.vectors[begin:begin + 1])[:, 0]
            near = far <= (self.ranges[number, 1] + self.ranges[number, 2]) / 2
            todo += [(inner, rows[near]), (outer, rows[~near])]
        todo = [(0, np.arange(n))]
        while todo and n:
            number, rows = todo.pop()
            begin, middle, end, inner, outer = self.nodes[number]
            if inner < 0:
                rows = rows[home[rows] != number]
                if len(rows):
                    offer(rows, begin, end, distances(queries[rows], self.vectors[begin:end]))
                continue
            far = distances(queries[rows], self.vectors[begin:begin + 1])
            offer(rows, begin, begin + 1, far)
            for part, (low, high) in ((outer, self.ranges[number, 2:]), (inner, self.ranges[number, :2])):
                gap = np.maximum(low - far[:, 0], far[:, 0] - high)
                # A hair of slack, so that rounding never skips a tie.
                stay = rows[factor * gap <= best[rows, -1] * (1 + 1e-9) + 1e-12]
                if len(stay):
                    todo.append((part, stay))
        return best, names


TREE = "dim int, shard int, ids binary, vectors binary, nodes binary, ranges binary"


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def build_trees(vectors: DataFrame, rows_per_shard: int, most_copies: int) -> DataFrame:
    """Written table of trees: every usable row is in one, by a hash of id, vector and copy. Equal rows are counted first; as
    no answer is longer than ``most_copies``, further copies of a row could stand in none."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).groupBy("vec_id", "embedding").agg(
        F.least(F.count(F.lit(1)), F.lit(most_copies)).cast("int").alias("copies"))
    rows = stored(rows.select("vec_id", "embedding", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")), "vectors")
    shards = max(1, -(-rows.count() // rows_per_shard))
    dealt = rows.select("vec_id", "embedding", F.size("embedding").alias("dim"),
                        F.pmod(F.xxhash64("vec_id", "embedding", "copy"), F.lit(shards)).cast("int").alias("shard"))

    def build(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        ids = group.column("vec_id").combine_chunks().to_numpy()
        data = _matrix(group.column("embedding").combine_chunks(), dim)
        order = np.lexsort((*data.T[::-1], ids))  # one order whatever the rows' order was
        tree = Tree.build(np.ascontiguousarray(ids[order]), np.ascontiguousarray(data[order]))
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": group.column("shard")[:1],
            "ids": pa.array([tree.ids.tobytes()], pa.binary()), "vectors": pa.array([tree.vectors.tobytes()], pa.binary()),
            "nodes": pa.array([tree.nodes.tobytes()], pa.binary()), "ranges": pa.array([tree.ranges.tobytes()], pa.binary())})

    return stored(dealt.groupBy("dim", "shard").applyInArrow(build, TREE), "vp-trees")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, factor: float = 1.0, rows_per_shard: int = 4096,
            queries_per_block: int = 1024) -> DataFrame:
    """The k nearest of ``vectors`` for each query: query_id, rank (from 1), vec_id, score; ties to the smaller vec_id.

    Vectors that are NULL, zero or hold NULL or non-finite components take no part, nor do NULL ids; vectors of another
    dimension are no candidates. Equal rows are each a candidate. Rows with a query's id count as its own. A query id that
    is repeated asks once, with its smallest vector (component by component). Other columns are never read. Queries go through every shard in blocks; each block keeps k candidates of a shard.
    """
    trees = build_trees(vectors, rows_per_shard, k)
    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = asked.where(F.col("query_id").isNotNull() & usable(F.col("embedding"))).groupBy("query_id").agg(
        F.min("embedding").alias("embedding"))
    asked = stored(asked.withColumn("dim", F.size("embedding")), "vector-queries")
    blocks = max(1, -(-asked.count() // queries_per_block))

    def gather(group: pa.Table) -> pa.Table:
        data = _matrix(group.column("embedding").combine_chunks(), group.column("dim")[0].as_py())
        return pa.table({"dim": group.column("dim")[:1], "block": group.column("block")[:1],
                         "query_ids": pa.array([group.column("query_id").combine_chunks().to_numpy().tobytes()], pa.binary()),
                         "queries": pa.array([data.tobytes()], pa.binary())})

    packed = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).groupBy("dim", "block").applyInArrow(
        gather, "dim int, block int, query_ids binary, queries binary")
    # Every block meets every shard of its dimension: the stated query set against all rows.
    places = trees.groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    spread = packed.join(places, "dim").withColumn("shard", F.explode("shards")).drop("shards")
    met = spread.join(trees, ["dim", "shard"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                tree = Tree(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(-1, dim),
                            np.frombuffer(row["nodes"], np.int64).reshape(-1, 5), np.frombuffer(row["ranges"]).reshape(-1, 4))
                ids = np.frombuffer(row["query_ids"], np.int64)
                best, names = tree.search(ids, np.frombuffer(row["queries"]).reshape(-1, dim), k, factor)
                found = np.isfinite(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, found.sum(axis=1))), pa.array(names[found]), pa.array(best[found])],
                    names=["query_id", "vec_id", "score"])

    candidates = met.select("dim", "ids", "vectors", "nodes", "ranges", "query_ids", "queries").mapInArrow(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return candidates.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
