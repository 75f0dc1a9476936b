"""Aggregation operators. All reduce to Spark's partial aggregation, so a huge group sends
one partial row per task; distinct counts shuffle on (group, value) first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.functions.text import ratio
from dunlin.operators.slices import join_null_safe


def group_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str], count_as="n_rows"):
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_as), *[F.sum(c).alias(f"sum_{c}") for c in cols]
    )


def distinct_by(df: DataFrame, keys: Sequence[str], col: str, out="n_distinct", approx=False):
    count = F.approx_count_distinct(col) if approx else F.count_distinct(F.col(col))
    return df.groupBy(*keys).agg(count.alias(out))


def sum_where(value, pred: Column, zero: bool = True) -> Column:
    """``SUM(CASE WHEN pred THEN value END)``; ``zero`` adds ``ELSE 0``."""
    value = value if isinstance(value, Column) else F.lit(value)
    hit = F.when(pred, value)
    return F.sum(hit.otherwise(F.lit(0)) if zero else hit)


def distinct_where(col, pred: Column) -> Column:
    return F.count_distinct(F.when(pred, F.col(col) if isinstance(col, str) else col))


def distinct_flags(
    df: DataFrame, keys: Sequence[str], entity: str, flags: Mapping[str, Column],
    sums: Sequence[str] = (), total: str | None = None,
) -> DataFrame:
    """Distinct entities per group for many conditions at once.

    Many conditional distinct counts in one aggregate would copy every row once per count
    before the shuffle. Reducing to one row of flags per (group, entity) first needs no
    copies; the flags are then summed. ``sums`` are carried along. Rows without an entity
    count in the sums only."""
    per_entity = df.groupBy(*keys, entity).agg(
        *[F.max((F.coalesce(c, F.lit(False)) & F.col(entity).isNotNull()).cast("int")).alias(n)
          for n, c in flags.items()],
        *[F.sum(c).alias(c) for c in sums],
    )
    counted = [F.count(entity).alias(total)] if total else []
    return per_entity.groupBy(*keys).agg(
        *counted, *[F.sum(c).alias(c) for c in (*flags, *sums)]
    )


def any_flag(pred: Column) -> Column:
    """1 when any row of the group matches, else 0."""
    return F.max(F.when(pred, 1).otherwise(0))


def daily(df: DataFrame, keys: Sequence[str], ts: str, aggs: Mapping[str, Column], day="day"):
    """Aggregate to the day in one pass (no intermediate grouping by raw timestamp)."""
    return df.groupBy(*keys, F.to_date(ts).alias(day)).agg(
        *[expr.alias(name) for name, expr in aggs.items()]
    )


def group_having(df, keys, aggs: Mapping[str, Column], pred: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()]).where(pred)


def slot_pivot(
    df, keys, slot: str, value: str, n: int, prefix="month_", over="over_range",
    extra: Mapping[str, Column] | None = None,
):
    """Sum ``value`` into slots 1..n plus one overflow slot (n+1); missing slots are 0.

    The slot list is known, so this is one conditional-sum aggregate with no distinct scan;
    ``extra`` aggregates ride along."""
    sums = [sum_where(F.col(value), F.col(slot) == i).alias(f"{prefix}{i}") for i in range(1, n + 1)]
    sums.append(sum_where(F.col(value), F.col(slot) > n).alias(over))
    sums += [agg.alias(name) for name, agg in (extra or {}).items()]
    return df.groupBy(*keys).agg(*sums)


def unpivot_flags(df, ids: Sequence[str], flags: Sequence[str], name="flag", value="occurrence"):
    """One row per positive flag."""
    return df.unpivot(list(ids), list(flags), name, value).where(F.col(value) > 0)


def ratio_of(num: str, den: str) -> Column:
    """Ratio of two sums, blank on zero."""
    return ratio(F.sum(num), F.sum(den))


def share_of(
    df: DataFrame, keys: Sequence[str], col: str, out="share", small_groups: bool = False
) -> DataFrame:
    """Row value over its group total.

    The total is a combined aggregate joined back, so a huge group stays spread out.
    ``small_groups=True`` states that groups are few rows by nature (an aggregated frame with
    a handful of segments): then a window needs one shuffle less."""
    if small_groups:
        total = F.sum(col).over(Window.partitionBy(*keys))
        return df.withColumn(out, ratio(F.col(col), total))
    totals = df.groupBy(*keys).agg(F.sum(col).alias("__total"))
    joined = join_null_safe(df, totals, list(keys), "inner")
    return joined.withColumn(out, ratio(F.col(col), F.col("__total"))).drop("__total")


def yield_index(df: DataFrame, group: Sequence[str], seg: str, num: str, den: str) -> DataFrame:
    """Segment yield over group yield (0 when the group yield is 0 or blank), and the share
    of each index in the group's sum of indexes (0 when that sum is 0 or blank). A group has
    one row per segment here, so its windows are small."""
    whole = Window.partitionBy(*group)
    segs = df.groupBy(*group, seg).agg(F.sum(num).alias("__n"), F.sum(den).alias("__d"))
    yields = segs.withColumns({
        "seg_yield": ratio(F.col("__n"), F.col("__d")),
        "total_yield": ratio(F.sum("__n").over(whole), F.sum("__d").over(whole)),
    })
    index = ratio(F.col("seg_yield"), F.col("total_yield"))
    flat = F.coalesce(F.col("total_yield"), F.lit(0.0)) == 0
    indexed = yields.withColumn("yield_idx", F.when(flat, 0.0).otherwise(index))
    shared = share_of(indexed, group, "yield_idx", "predicted_share", small_groups=True)
    return shared.withColumn(
        "predicted_share", F.coalesce("predicted_share", F.lit(0.0))
    ).drop("__n", "__d")


def total_and_unique(df, keys, cols: Sequence[str], total="total_clicks", unique="unique_clicks"):
    """Raw row count and count of distinct ``cols`` combinations per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total), F.count_distinct(*[F.col(c) for c in cols]).alias(unique)
    )


def priority_score(df, key, col: str, levels: Sequence[tuple], default: float, out="score"):
    """Score of the most severe level present per key. ``levels`` holds (prefix, score) from
    most to least severe; ``default`` when none matches."""
    aggs = [
        F.count_if(F.col(col).startswith(prefix)).alias(f"n_{prefix.lower()}")
        for prefix, _ in levels
    ]
    score = None
    for prefix, value in levels:
        hit = F.col(f"n_{prefix.lower()}") > 0
        score = F.when(hit, value) if score is None else score.when(hit, value)
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*aggs).withColumn(out, score.otherwise(F.lit(default)))


def threshold_flag(df, keys, col: str, limit, out="is_large", yes="Yes", no="No"):
    total = F.sum(col)
    return df.groupBy(*keys).agg(F.when(total >= limit, yes).otherwise(no).alias(out))


def value_list(col: str, max_n: int = 5, sep=", ", more=", etc.") -> Column:
    """Distinct values in alphabetical order, cut after ``max_n`` with a trailing mark.

    The set holds one entry per distinct code; use it for columns with few codes, or
    ``value_lists`` for columns with many."""
    values = F.array_sort(F.collect_set(col))
    text = F.array_join(F.slice(values, 1, max_n), sep)
    return F.when(F.size(values) > max_n, F.concat(text, F.lit(more))).otherwise(text)


def value_lists(df, keys: Sequence[str], col: str, out: str, max_n=5, sep=", ", more=", etc."):
    """``value_list`` for any number of distinct values: distinct (key, value) pairs are
    ranked with a row-number limit, which Spark prunes before the shuffle, so at most
    ``max_n + 1`` values per key and task travel."""
    pairs = df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(col))
    top = pairs.withColumn("__r", rank).where(F.col("__r") <= max_n + 1)
    values = F.array_sort(F.collect_list(col))
    text = F.array_join(F.slice(values, 1, max_n), sep)
    listed = F.when(F.size(values) > max_n, F.concat(text, F.lit(more))).otherwise(text)
    return top.groupBy(*keys).agg(listed.alias(out))


def single_or(col: str, default) -> Column:
    """The only value of the group, or ``default`` when there is none or more than one."""
    lo, hi = F.min(col), F.max(col)
    return F.when((lo == hi) & lo.isNotNull(), lo).otherwise(F.lit(default))


def range_label(ts: str, fmt: str, prefix: str = "") -> Column:
    """``<min> - <max>`` of a date column, for example ``Jan-24 - Mar-24``."""
    lo, hi = F.date_format(F.min(ts), fmt), F.date_format(F.max(ts), fmt)
    return F.concat(F.lit(prefix), lo, F.lit(" - "), hi)


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Mergeable exact distinct counts: per key and bucket of 32,768 numbers a bitmap of those
    seen (4 KB). ``number`` is a whole number, best dense; NULL counts for nothing. Bitmaps
    combine map-side, can be stored, and those of any months can be put together."""
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct numbers per key over all given bitmaps."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))
