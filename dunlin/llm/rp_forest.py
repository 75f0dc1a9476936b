"""Approximate nearest neighbours (cosine) with a forest of random-projection trees.

Each tree splits the space by random directions at the median of a bounded sample, down to a
fixed number of leaves (a query visits a fixed share of them, so more leaves for more rows would
make the scored rows grow with the square); every row of the table is routed to one leaf per
tree. A query
descends all trees with one shared priority queue: the open branch with the smallest distance
to its splitting planes, of whatever tree, is followed next, until the visited leaves hold
``effort`` times as many rows as the table (a row counts once per tree). This share is the same
for tables of every size; ``trees * (k + 1)`` rows are always visited, so that there are ``k``
other candidates. Rows of the visited leaves are scored exactly, leaf by leaf.

The forest is small (trees x leaves x dimension numbers) and broadcast. Leaves and the queries
that visit them are cut into blocks of bounded size, and a pair of blocks is one group, so
neither a large leaf nor a popular one meets in one task; a leaf is copied once per block of
its own visitors. Of equal vectors only the ``k + 1`` smallest ids
enter the leaves: no other can be among the ``k`` nearest, as ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dunlin.llm.common import stage

SAMPLE_ROWS = 20_000
BLOCK_ROWS = 4096


@dataclass
class Forest:
    """``planes[t, node]`` and ``cuts[t, node]``; children of node i are 2i+1 and 2i+2."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree, as tree * leaves + leaf."""
        out = np.empty((len(x), len(self.planes)), np.int32)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            side = x @ planes.T > cuts
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + side[np.arange(len(x)), node]
            out[:, t] = node - (self.leaves - 1) + t * self.leaves
        return out

    def visit(self, x: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """Leaves for one query, nearest branches first, until they hold ``wanted`` rows."""
        margins = np.einsum("tnd,d->tn", self.planes, x) - self.cuts
        inner = self.leaves - 1
        heap = [(0.0, t, 0) for t in range(len(self.planes))]
        out, held = [], 0
        while heap and held < wanted:
            far, t, node = heapq.heappop(heap)
            while node < inner:
                m = margins[t, node]
                right = m > 0
                heapq.heappush(heap, (max(far, abs(m)), t, 2 * node + 1 + (not right)))
                node = 2 * node + 1 + right
            leaf = t * self.leaves + node - inner
            out.append(leaf)
            held += sizes[leaf]
        return out


def grow(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    """Random directions, each cut at the median of the sample rows that reach it."""
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    planes = rng.standard_normal((trees, inner, sample.shape[1]))
    planes /= np.linalg.norm(planes, axis=2, keepdims=True)
    cuts = np.zeros((trees, inner))
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            if len(rows):
                along = sample[rows] @ planes[t, i]
                cuts[t, i] = np.median(along)
                node[rows] = 2 * i + 1 + (along > cuts[t, i])
    return Forest(planes, cuts, depth)


def _scaled(column) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a column of equally long lists, each times the power of two that brings its
    largest component next to 1 (so that no square overflows or vanishes; cosines stay the
    same), and their lengths."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x, np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    """Unit vectors of a column of equally long lists."""
    x, length = _scaled(column)
    return x / length


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not NULL, all finite, not all zero, and of the most common length
    (of lengths equally common the larger)."""
    v = F.col(column)
    good = vectors.where(
        v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    size = good.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return good.where(F.size(column) == (size["size"] if size else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = 4, depth: int = 6,
            effort: float = 1.0, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """The ``k`` nearest found rows of ``vectors`` for each row of ``queries`` (both: id,
    vector): query_id, rank (from 1), vec_id, score (cosine, double). A row with the query's
    own id is no candidate; ties go to the smaller id.

    Vectors that ``usable`` rejects and rows without an id take no part, as queries neither.
    Repeated ids are one candidate (the nearest of them) and one query of each vector. Empty
    tables give no rows. ``sample_rows`` bounds the rows the trees are fitted on (those with
    the smallest hash of the id); every row is routed.
    """
    spark = vectors.sparkSession
    typed = lambda df: df.selectExpr(
        "cast(id as bigint) as id", "cast(vector as array<double>) as vector").where("id is not null")
    base = stage(usable(typed(vectors), "vector"), "vectors")
    same = Window.partitionBy("vector").orderBy("id")
    first = base.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")
    sample = first.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    unit = _matrix(sample.column("vector").combine_chunks())
    forest = spark.sparkContext.broadcast(grow(unit, trees, depth, seed))
    dim = unit.shape[1]

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                cells = forest.value.route(_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vector"), pa.array(cells.tolist(), pa.list_(pa.int32()))],
                    names=["id", "vector", "cells"])

    routed = stage(first.mapInArrow(route, "id bigint, vector array<double>, cells array<int>"), "routed")
    cell = F.explode("cells").alias("cell")
    sizes = np.zeros(trees << depth, np.int64)
    for r in routed.select(cell).groupBy("cell").count().collect():  # trees * leaves rows
        sizes[r.cell] = r["count"]
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))
    wanted = max(effort * sizes.sum() / trees, trees * (k + 1))

    asked = stage(typed(queries).where(F.size("vector") == dim), "queries")
    asked = usable(asked, "vector")
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query"), F.count(F.lit(1)).alias("n"))

    def visit(batches):
        for batch in batches:
            x = _matrix(batch.column("vector")) if batch.num_rows else ()
            cells = [forest.value.visit(row, sizes, wanted) for row in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vector"), pa.array(cells, pa.list_(pa.int32()))],
                names=["query", "vector", "cells"])

    visited = stage(distinct.select("query", "vector").mapInArrow(
        visit, "query bigint, vector array<double>, cells array<int>"), "visits")
    turns = np.zeros(trees << depth, np.int64)
    for r in visited.select(cell).groupBy("cell").count().collect():  # trees * leaves rows
        turns[r.cell] = -(-r["count"] // BLOCK_ROWS)
    of_cell = lambda numbers: F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col("cell") + 1)
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    visits = (
        visited.select("query", "vector", cell).withColumn("part", upto(of_cell(blocks)))
        .withColumn("turn", F.pmod(F.xxhash64("query"), of_cell(turns)).cast("int"))
    )
    held = (
        routed.select("id", "vector", cell)
        .withColumn("part", F.pmod(F.xxhash64("id"), of_cell(blocks)).cast("int"))
        .withColumn("turns", of_cell(turns)).where("turns > 0")
        .withColumn("turn", upto(F.col("turns"))).drop("turns")
    )
    take = k + 1

    def score(left, right):
        """Of each query of one block the ``take`` nearest rows of one block of a leaf."""
        ids, found, scores = [], [], []
        if left.num_rows and right.num_rows:
            x, x_size = _scaled(left.column("vector").combine_chunks())
            y, y_size = _scaled(right.column("vector").combine_chunks())
            unit = x / x_size
            own = left.column("id").to_numpy()
            asks = right.column("query").to_numpy()
            for a in range(0, len(y), 512):
                near = y[a:a + 512] / y_size[a:a + 512] @ unit.T
                cut = min(2 * take, len(x))
                least = np.partition(near, len(x) - cut, axis=1)[:, len(x) - cut] - 1e-9
                q, c = np.nonzero(near >= least[:, None])
                exact = (y[a + q] * x[c]).sum(axis=1) / (y_size[a + q, 0] * x_size[c, 0])
                order = np.lexsort((own[c], -exact, q))
                q, c, exact = q[order], c[order], exact[order]
                nth = np.arange(len(q)) - np.searchsorted(q, q)
                best = nth < take
                ids.append(asks[a + q[best]])
                found.append(own[c[best]])
                scores.append(exact[best])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query": pa.array(cat(ids, np.int64), pa.int64()),
                         "vec_id": pa.array(cat(found, np.int64), pa.int64()),
                         "score": pa.array(cat(scores, np.float64), pa.float64())})

    keys = ["cell", "part", "turn"]
    scored = held.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
        score, "query bigint, vec_id bigint, score double")
    per_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = (
        scored.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("nth", F.row_number().over(per_query)).where(F.col("nth") <= take).drop("nth")
    )
    # back to every query of each vector, without the query itself
    members = asked.select(F.col("id").alias("query_id"), "vector").join(
        distinct.select("vector", "query"), "vector").select("query_id", "query")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(top, "query").where(F.col("query_id") != F.col("vec_id"))
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


