"""Connected components of a graph given by its edges, with large-star and small-star rounds.

Each round rewires edges towards the smallest neighbour; edges never multiply, and after a
number of rounds that grows with the logarithm of a component's size every node hangs on the
smallest id of its component. Rounds are staged, so nothing is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dunlin.llm.common import drop_stage, stage

_BOTH = ["inline(array(struct(u, v), struct(v as u, u as v))) as (u, v)"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.selectExpr(*_BOTH)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(u, v) as u", "least(u, v) as v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Staged table (id, root) of the nodes of ``edges`` (u, v) other than the roots; root is
    the smallest id of the component. Loops, repeated edges and NULL ends are ignored; no
    edges give no rows."""
    now = stage(
        edges.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not seen[0] or seen == mark:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root"))
        mark = seen
        after = stage(_small_star(_large_star(now)), "edges")
        drop_stage(now)
        now = after
