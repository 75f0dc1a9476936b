"""Exact percentiles and global deciles without one-task groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dunlin.operators.slices import (
    SLICE, carry_over, find_hot, hot_row_limit, join_null_safe, slice_window, split_hot,
)
from dunlin.sources.checkpoints import cut_lineage


def _value_counts(df, keys, col) -> DataFrame:
    """Rows per (key, value) and the running rank of each value within its key.

    Equal values collapse map-side. Keys that still hold very many distinct values are cut into
    ranges of values by count (``split_hot``), ranked range by range, and shifted by the rows of
    the ranges before. Values keep their type; any that can be ordered will do."""
    counts = (
        df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    )
    hot = find_hot(df, keys)  # rows bound the distinct values of a key
    plain, sliced = split_hot(counts, keys, ["__v"], hot=hot)
    ranked = plain.withColumn("__hi", F.sum("__c").over(Window.partitionBy(*keys).orderBy("__v")))
    if sliced is None:
        return ranked
    local = sliced.withColumn("__hi", F.sum("__c").over(slice_window(keys)))
    carry = carry_over(sliced, keys, F.sum("__c"), F.sum, "__carry")
    return ranked.unionByName(
        join_null_safe(local, carry, [*keys, SLICE])
        .withColumn("__hi", F.col("__hi") + F.coalesce("__carry", F.lit(0))).select(*ranked.columns))


def _is_whole(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def _decimal_of(kind: T.DataType) -> T.DecimalType:
    """A decimal that holds every value of an integer or decimal type, with up to six more
    places for what lies between two values."""
    digits, scale = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (19, 0)
    return T.DecimalType(38, min(scale + 6, 38 - (digits - scale)))


def percentile_by_rank(
    df: DataFrame, keys: Sequence[str], col: str, percents: dict[str, float], method: str = "inc", exact: bool = False,
) -> DataFrame:
    """Percentiles per key by linear interpolation between ranks.

    ``inc``: rank p(n-1)+1. ``exc``: rank p(n+1), NULL when that falls outside 1..n. Results
    are doubles; with ``exact``, percentiles of integers and decimals are decimals, so a value
    at a whole rank is returned as it is, beyond 2**53 too.
    """
    keys = list(keys)
    one = not keys
    if one:
        df, keys = df.withColumn("__all", F.lit(1)), ["__all"]
    ranked = _value_counts(df, keys, col)
    if one:
        both = ranked.withColumn("__n", F.lit(df.agg(F.count(col)).first()[0]))
    else:
        sizes = ranked.groupBy(*keys).agg(F.sum("__c").alias("__n"))
        both = join_null_safe(ranked, sizes, keys, "inner")
    n = F.col("__n")
    aggs = [F.first("__n").alias("__n")]
    for name, p in percents.items():
        pos = p * (n - 1) + 1 if method == "inc" else p * (n + 1)
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            here = (rank > F.col("__hi") - F.col("__c")) & (rank <= F.col("__hi"))
            aggs.append(F.max(F.when(here, F.col("__v"))).alias(f"__{side}_{name}"))
    out = both.groupBy(*keys).agg(*aggs)
    kind = df.schema[col].dataType
    for name, p in percents.items():
        pos = p * (n - 1) + 1 if method == "inc" else p * (n + 1)
        part = pos - F.floor(pos)
        lo, hi = (F.col(f"__{side}_{name}") for side in ("lo", "hi"))
        if exact and _is_whole(kind):
            to = _decimal_of(kind)
            between = F.when(part > 0, part * (hi.cast("double") - lo.cast("double"))).otherwise(0)
            value = (lo.cast(to) + between.cast(to)).cast(to)
        else:
            value = lo.cast("double") + part * (hi.cast("double") - lo.cast("double"))
        out = out.withColumn(name, F.when((pos >= 1) & (pos <= n), value))
    return out.select(*([] if one else keys), *percents)


def percentile_inc(df, keys, col, percents, exact=False) -> DataFrame:
    return percentile_by_rank(df, keys, col, percents, "inc", exact)


def percentile_exc(df, keys, col, percents, exact=False) -> DataFrame:
    return percentile_by_rank(df, keys, col, percents, "exc", exact)


def quartile_band(df: DataFrame, value: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Band 1..4 of each row's value against the inclusive quartiles of its group; integers and
    decimals are compared exactly."""
    levels = {"__q1": 0.25, "__q2": 0.5, "__q3": 0.75}
    kind = df.schema[value].dataType
    cuts = percentile_inc(df, within, value, levels, exact=True)
    if within:
        joined = join_null_safe(df, cuts, list(within))
    else:
        row = cuts.first()  # three numbers
        joined = df.withColumns({q: F.lit(row[q] if row else None).cast(cuts.schema[q].dataType) for q in levels})
    v = F.col(value).cast(_decimal_of(kind)) if _is_whole(kind) else F.col(value)
    label = (
        F.when(v <= F.col("__q1"), 1).when(v <= F.col("__q2"), 2)
        .when(v <= F.col("__q3"), 3).when(v > F.col("__q3"), 4)
    )
    return joined.withColumn(out, label).drop("__q1", "__q2", "__q3")


def global_row_number(
    df: DataFrame, value: str, tie: str, out: str, desc=False, total_out: str | None = None
) -> DataFrame:
    """Exact 1-based position over the whole frame by (value, tie), of any types that can be
    ordered. NULL is the lowest value: first ascending, last descending.

    Rows are cut into ranges of that order by row count, as many as the frame asks for, and
    staged once; each range is numbered on its own and shifted by the rows of the ranges
    before it (one number a range). A range is cut by value and tie together, so a frequent
    value spreads over several.
    """
    v = F.col(value)
    order = [v.desc_nulls_last() if desc else v.asc_nulls_first(), F.col(tie)]
    total = df.count()
    slices = -(-total // max(hot_row_limit(df.sparkSession), 1))
    if slices <= 1:
        ranked = df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    else:
        cut = cut_lineage(df.repartitionByRange(slices, *order).withColumn(SLICE, F.spark_partition_id()))
        before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        starts = cut.groupBy(SLICE).agg(F.count(F.lit(1)).alias("__c")).select(
            SLICE, F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__start"))
        own = Window.partitionBy(SLICE).orderBy(*order)
        ranked = (
            cut.withColumn("__n", F.row_number().over(own)).join(starts, SLICE)
            .withColumn(out, F.col("__n") + F.col("__start")).drop("__n", "__start", SLICE)
        )
    return ranked if total_out is None else ranked.withColumn(total_out, F.lit(total))


def deciles(
    df: DataFrame, value: str, tie: str, out: str, n: int = 10, desc=False, exact=True
) -> DataFrame:
    """NTILE(n) over the whole frame. ``exact=False`` bands by approximate quantiles only."""
    if not exact:
        edges = df.agg(
            F.percentile_approx(
                F.col(value).cast("double"),
                F.array(*[F.lit(i / n) for i in range(1, n)]), 10_000,
            ).alias("e")
        ).first()["e"] or []
        above = sum((F.col(value) > F.lit(e)).cast("int") for e in edges) if edges else F.lit(0)
        tile = above + 1
        return df.withColumn(out, (F.lit(n + 1) - tile) if desc else tile)
    placed = global_row_number(df, value, tie, "__pos", desc, "__total")
    rn, size = F.col("__pos") - 1, F.floor(F.col("__total") / n)
    extra = F.col("__total") % n
    wide = extra * (size + 1)
    tile = F.when(rn < wide, F.floor(rn / (size + 1))).otherwise(
        extra + F.floor((rn - wide) / F.greatest(size, F.lit(1)))
    ) + 1
    return (
        placed.withColumn(out, tile.cast("int"))
        .drop("__pos", "__total")
    )
