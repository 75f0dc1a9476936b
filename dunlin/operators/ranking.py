"""Top-N and rank operators over aggregated entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.percentiles import global_row_number
from dunlin.operators.windows import first_per
from dunlin.sources.checkpoints import cut_lineage


def rank_total(df: DataFrame, entity: str, measure: Column, desc=True, total="total", rank="rnk"):
    """Dense rank of every entity by its total: the position of the total among the distinct
    totals, of any type that can be ordered."""
    totals = cut_lineage(df.groupBy(entity).agg(measure.alias(total)))  # one row per entity
    distinct = totals.select(F.col(total).alias("__t")).distinct()
    ranked = global_row_number(distinct, "__t", "__t", rank, desc)
    return totals.join(ranked, F.col(total).eqNullSafe(F.col("__t"))).drop("__t")


def top_n(
    df: DataFrame, entity: str, measure: Column, n: int, desc=True, other: str | None = "Other",
    total="total",
) -> DataFrame:
    """Totals of the entities whose dense rank is at most ``n`` (ties at the cut all stay).
    ``other`` adds one row that sums the rest; None leaves the rest out.

    The cut is one number from a top-n sort, which keeps n rows per task."""
    totals = cut_lineage(df.groupBy(entity).agg(measure.alias(total)))  # one row per entity
    value = F.col(total)
    best = (
        totals.where(value.isNotNull()).select(total).distinct()
        .orderBy(value.desc() if desc else value.asc()).limit(n)
        .agg((F.min(total) if desc else F.max(total)).alias("cut"))
    )
    cut = F.lit(best.first()["cut"]).cast(totals.schema[total].dataType)
    inside = (value >= cut) if desc else (value <= cut)
    if other is None:
        return totals.where(inside)
    label = F.when(inside, F.col(entity)).otherwise(F.lit(other))
    return totals.groupBy(label.alias(entity)).agg(F.sum(total).alias(total))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """TOP 1 per group."""
    return first_per(df, keys, order)
