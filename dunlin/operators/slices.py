"""Splitting the ordered rows of very large keys.

A window function sends all rows of one key to one task. That is fine for almost every
key, and fatal for a key that holds a third of the table. ``split_hot`` counts rows per key (a
map-side combined aggregate that reads the key columns only) and cuts the rows of keys above a
row limit into *slices* by row count: ranges of (key, order, row number), so a sparse key, a
key with a single time, or one with many values of the first order column is cut alike. The
slices are staged once, each row with its place; ordered operators work per (key, slice) and
stitch neighbouring slices together from a small per-slice summary. Rows of all other keys go
through the plain window. There are at most total_rows / limit large keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dunlin.sources.checkpoints import cut_lineage

SLICE, PLACE = "__slice", "__place"
HOT_ROWS_CONF = "dunlin.hotKeyRows"
HOT_ROWS_DEFAULT = 2_000_000
HOT_KEYS_COLLECTED = 10_000


def hot_row_limit(spark: SparkSession) -> int:
    """Rows one key may hold before its ordered work is split (session conf, see above)."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


@dataclass(frozen=True)
class Hot:
    """Large keys found by ``find_hot``: ``frame`` holds them (None: there are none) under the
    column names ``keys``. Finding them once on a source table serves every later operator
    whose rows come from it and whose keys include these."""

    frame: DataFrame | None
    keys: tuple


def find_hot(df: DataFrame, keys) -> Hot:
    names = [keys] if isinstance(keys, str) else list(keys)
    return Hot(hot_keys(df, names), tuple(names))


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys with more rows than the limit, or None when there is none.

    Few such keys become a literal frame that is safe to broadcast; beyond
    ``HOT_KEYS_COLLECTED`` the counted frame itself is returned and Spark picks the join.
    """
    limit = hot_row_limit(df.sparkSession)
    hot = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > limit).select(*keys)
    )
    rows = hot.limit(HOT_KEYS_COLLECTED + 1).collect()
    if not rows:
        return None
    if len(rows) > HOT_KEYS_COLLECTED:
        return hot
    return F.broadcast(df.sparkSession.createDataFrame(rows, hot.schema))


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Equi join in which NULL keys match each other, like GROUP BY treats them."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def split_hot(
    df: DataFrame, keys: list[str], order: Sequence[str], bounded: bool = False, hot: Hot | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, staged rows of large keys). The staged rows have ``__slice``, the
    number of the range of (keys, order) they lie in, and ``__place``, their place in it; by
    (slice, place) a key's rows are in the order of a window, NULL first. Rows that are equal
    in keys and order may lie in neighbouring slices; a slice may hold several keys.

    The second frame is None when no key is large, or when the caller knows that rows per key
    are bounded. ``hot`` are the large keys when they are known already; else they are counted
    here. A slice aims at half the row limit, as ranges are cut at sampled bounds.
    """
    if bounded:
        return df, None
    hot = find_hot(df, keys) if hot is None else hot
    if hot.frame is None:
        return df, None
    named = list(hot.keys)
    large = join_null_safe(df, hot.frame, named, "left_semi").withColumn("__hot_row", F.monotonically_increasing_id())
    by = [*dict.fromkeys([*keys, *order]), "__hot_row"]
    per_slice = max(hot_row_limit(df.sparkSession) // 2, 1)
    slices = max(1, -(-large.count() // per_slice))
    cut = cut_lineage(
        large.repartitionByRange(slices, *by).sortWithinPartitions(*by).drop("__hot_row")
        .withColumns({SLICE: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}))
    return join_null_safe(df, hot.frame, named, "left_anti"), cut


def slice_window(keys: list[str]):
    """The rows of one key in one slice, in their order."""
    return Window.partitionBy(*keys, SLICE).orderBy(PLACE)


def earlier_slices(keys: list[str]):
    """Over one row per (key, slice): the slices of the key before this one."""
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def carry_over(sliced: DataFrame, keys: list[str], per_slice: Column, combine, out: str) -> DataFrame:
    """Value carried into each slice from the earlier slices of its key.

    ``per_slice`` aggregates one slice; ``combine(col)`` folds slice values and is applied
    over all earlier slices of the key. One row per (large key, slice)."""
    return (
        sliced.groupBy(*keys, SLICE).agg(per_slice.alias("__part"))
        .select(*keys, SLICE, combine(F.col("__part")).over(earlier_slices(keys)).alias(out))
    )


def shared_edges(sliced: DataFrame, keys: list[str], peer: str, value: Column) -> DataFrame:
    """What rows of equal ``peer`` that lie in several slices share. Per (key, slice):
    ``__first`` and ``__last``, the peers (in a field ``p``) of its first and last row;
    ``__before``, the sum of ``value`` over the rows of earlier slices whose peer is the first
    one; ``__after``, that over the rows of later slices whose peer is the last one (NULL
    without any). Two rows per slice are looked at."""
    ends = sliced.groupBy(*keys, SLICE).agg(
        F.min_by(F.struct(F.col(peer).alias("p")), PLACE).alias("__first"),
        F.max_by(F.struct(F.col(peer).alias("p")), PLACE).alias("__last"))

    def of(end):
        return F.sum(F.when(F.col(peer).eqNullSafe(F.col(f"{end}.p")), value))

    sums = join_null_safe(sliced, ends, [*keys, SLICE], "inner").groupBy(*keys, SLICE, "__first", "__last").agg(
        of("__first").alias("__first_sum"), of("__last").alias("__last_sum"))
    edges = sums.select(*keys, SLICE, F.inline(F.array(*(
        F.struct(F.lit(e == "__first").alias("__is_first"), F.col(f"{e}.p").alias("__peer"), F.col(f"{e}_sum").alias("__sum"))
        for e in ("__first", "__last")))))
    once = edges.groupBy(*keys, SLICE, "__peer").agg(  # both edges of a slice may be one peer
        F.max("__sum").alias("__sum"), F.max("__is_first").alias("__is_first"), F.min("__is_first").alias("__only_first"))
    same = Window.partitionBy(*keys, "__peer").orderBy(SLICE)
    shared = once.select(
        *keys, SLICE, "__is_first", "__only_first",
        F.sum("__sum").over(same.rowsBetween(Window.unboundedPreceding, -1)).alias("__lower"),
        F.sum("__sum").over(same.rowsBetween(1, Window.unboundedFollowing)).alias("__higher"))
    found = shared.groupBy(*keys, SLICE).agg(
        F.max(F.when(F.col("__is_first"), F.col("__lower"))).alias("__before"),
        F.max(F.when(~F.col("__only_first"), F.col("__higher"))).alias("__after"))
    return join_null_safe(ends, found, [*keys, SLICE], "inner")
