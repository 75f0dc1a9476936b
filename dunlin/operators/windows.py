"""Ordered operators per key: neighbours, running values, fill-forward, first and last.

All take ``keys`` (partition), ``ts`` (a timestamp or date column name) and ``tie`` (column
names that make the order total). Very large keys are split as described in ``slices``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.functions.dates import day_diff
from dunlin.operators.slices import (
    PLACE, SLICE, Hot, carry_over, join_null_safe, shared_edges, slice_window, split_hot,
)


def _list(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def neighbours(
    df: DataFrame, keys, ts: str, outs: Mapping[str, tuple], tie: Sequence[str] = (),
    bounded: bool = False, hot: Hot | None = None,
) -> DataFrame:
    """Add the value of a neighbouring row of the same key.

    ``outs`` maps a new column to ``(source column, offset[, default])``: offset 1 is the
    previous row, -1 the next one. For a split key, the rows next to a slice edge (at most
    2k per slice, k = largest offset) are looked at once more across slices.
    ``bounded=True`` states that rows per key are few by construction; ``hot`` passes large
    keys found earlier. ``ts`` and ``tie`` may have any type that can be ordered.
    """
    keys, order = _list(keys), [ts, *tie]
    outs = {name: (*spec, None)[:3] for name, spec in outs.items()}
    k = max(abs(offset) for _, offset, _ in outs.values())

    def shifted(spec, window) -> Column:
        source, offset, default = spec
        if offset > 0:
            return F.lag(source, offset, default).over(window)
        return F.lead(source, -offset, default).over(window)

    plain, sliced = split_hot(df, keys, order, bounded, hot)
    whole = Window.partitionBy(*keys).orderBy(*order)
    done = plain.select("*", *[shifted(s, whole).alias(n) for n, s in outs.items()])
    if sliced is None:
        return done

    local, across = slice_window(keys), Window.partitionBy(*keys).orderBy(SLICE, PLACE)
    step = sliced.select(
        "*",
        *[shifted(spec, local).alias(name) for name, spec in outs.items()],
        F.lag(F.lit(1), k).over(local).isNull().alias("__head"),
        F.lead(F.lit(1), k).over(local).isNull().alias("__tail"),
    )
    at_edge = F.col("__head") | F.col("__tail")

    def resolved(name, spec):
        reach = F.col("__head") if spec[1] > 0 else F.col("__tail")
        return F.when(reach, shifted(spec, across)).otherwise(F.col(name)).alias(name)

    edge = step.where(at_edge).select(*df.columns, *[resolved(n, s) for n, s in outs.items()])
    inner = step.where(~at_edge).select(*df.columns, *outs)
    return done.unionByName(inner).unionByName(edge)


def prev_value(df, keys, ts, col, out, default=None, tie=()) -> DataFrame:
    return neighbours(df, keys, ts, {out: (col, 1, default)}, tie)


def prev_k(df, keys, ts, cols: Sequence[str], k: int, tie=()) -> DataFrame:
    """``{col}_1 .. {col}_k``: the values of the k previous rows."""
    outs = {f"{c}_{i}": (c, i) for c in cols for i in range(1, k + 1)}
    return neighbours(df, keys, ts, outs, tie)


def next_event(df, keys, ts, cols: Sequence[str], tie=()) -> DataFrame:
    """``next_{col}`` of the following row of the key."""
    return neighbours(df, keys, ts, {f"next_{c}": (c, -1) for c in cols}, tie)


def days_since_prev(df, keys, ts, out="days_since_prev", tie=()) -> DataFrame:
    stepped = neighbours(df, keys, ts, {"__prev_ts": (ts, 1)}, tie)
    return stepped.withColumn(out, day_diff(F.col("__prev_ts"), F.col(ts))).drop("__prev_ts")


def running_sum(df, keys, ts, col, out, bounded=False, hot=None) -> DataFrame:
    """Running sum by ``ts``; rows with equal ``ts`` share the sum."""
    keys = _list(keys)
    plain, sliced = split_hot(df, keys, [ts], bounded, hot)
    done = plain.withColumn(out, F.sum(col).over(Window.partitionBy(*keys).orderBy(ts)))
    if sliced is None:
        return done
    own = F.sum(col).over(Window.partitionBy(*keys, SLICE).orderBy(ts))
    carry = carry_over(sliced, keys, F.sum(col), F.sum, "__carry")
    local = join_null_safe(sliced.withColumn("__own", own), carry, [*keys, SLICE])
    local = join_null_safe(local, shared_edges(sliced, keys, ts, F.col(col)), [*keys, SLICE])
    later = F.when(F.col(ts).eqNullSafe(F.col("__last.p")), F.col("__after"))
    parts = [F.col("__own"), F.col("__carry"), later]
    total = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    total = F.when(F.coalesce(*parts).isNotNull(), total)
    return done.unionByName(local.withColumn(out, total.cast(done.schema[out].dataType)).select(*done.columns))


def running_total(df, keys, order, value: Column, out, bounded=False, hot=None) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to this one, row by row in ``order``."""
    keys, order = _list(keys), _list(order)
    plain, sliced = split_hot(df, keys, order, bounded, hot)

    def upto(window):
        return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    done = plain.withColumn(out, upto(Window.partitionBy(*keys).orderBy(*order)))
    if sliced is None:
        return done
    carry = carry_over(sliced, keys, F.sum(value), F.sum, "__carry")
    local = join_null_safe(sliced.withColumn("__own", upto(slice_window(keys))), carry, [*keys, SLICE])
    total = F.col("__own") + F.coalesce("__carry", F.lit(0))
    return done.unionByName(local.withColumn(out, total).select(*done.columns))


def attempt_no(df, keys, ts, tie=(), rank="rank_no", row="row_no", bounded=False, hot=None) -> DataFrame:
    """Rank (ties share) and row number of each row within its key."""
    keys = _list(keys)
    plain, sliced = split_hot(df, keys, [ts, *tie], bounded, hot)
    whole = Window.partitionBy(*keys)
    done = plain.select(
        "*", F.rank().over(whole.orderBy(ts)).alias(rank), F.row_number().over(whole.orderBy(ts, *tie)).alias(row))
    if sliced is None:
        return done
    numbered = sliced.select(
        "*", F.rank().over(Window.partitionBy(*keys, SLICE).orderBy(ts)).alias(rank),
        F.row_number().over(slice_window(keys)).alias(row))
    carry = carry_over(sliced, keys, F.count(F.lit(1)), F.sum, "__carry")
    numbered = join_null_safe(numbered, carry, [*keys, SLICE])
    numbered = join_null_safe(numbered, shared_edges(sliced, keys, ts, F.lit(1)), [*keys, SLICE])
    before = F.coalesce("__carry", F.lit(0))
    peers = F.when(F.col(ts).eqNullSafe(F.col("__first.p")), F.coalesce("__before", F.lit(0))).otherwise(0)
    return done.unionByName(
        numbered.withColumn(rank, (F.col(rank) + before - peers).cast("int"))
        .withColumn(row, (F.col(row) + before).cast("int")).select(*done.columns))


def fill_forward(
    df, keys, ts, col, out, strict=True, tie=(), bounded=False, own_first=False, hot=None,
) -> DataFrame:
    """Last non-null value of ``col`` before each row (``strict``) or up to and including it.

    This is the window form of a correlated "latest earlier non-null row" lookup, so it needs
    one shuffle and no join. ``own_first`` prefers the row's own value.
    """
    keys = _list(keys)
    order = [ts, *tie]
    plain, sliced = split_hot(df, keys, order, bounded, hot)

    def seen(window):
        return F.last(col, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1 if strict else 0))

    def shown(value):
        return F.coalesce(F.col(col), value) if own_first else value

    done = plain.withColumn("__seen", seen(Window.partitionBy(*keys).orderBy(*order)))
    done = done.withColumn(out, shown(F.col("__seen"))).drop("__seen")
    if sliced is None:
        return done
    newest = F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(PLACE)))
    carry = carry_over(sliced, keys, newest, lambda c: F.last(c, ignorenulls=True), "__carry")
    filled = join_null_safe(sliced.withColumn("__seen", seen(slice_window(keys))), carry, [*keys, SLICE])
    return done.unionByName(
        filled.withColumn(out, shown(F.coalesce("__seen", "__carry"))).select(*done.columns))


def first_per(df, keys, order: Sequence, cols: Sequence[str] | None = None) -> DataFrame:
    """First row per key in the given order: ``min_by`` combines map-side, so one huge key
    costs one partial row per task instead of one sorted partition."""
    return _edge_row(df, keys, order, cols, F.min_by)


def last_per(df, keys, order: Sequence, cols: Sequence[str] | None = None) -> DataFrame:
    return _edge_row(df, keys, order, cols, F.max_by)


def _edge_row(df, keys, order, cols, pick) -> DataFrame:
    keys = _list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    row = pick(F.struct(*cols), F.struct(*order)).alias("__row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols])


def first_known(df, keys, ts, col, out, tie=()) -> DataFrame:
    """First non-null value of ``col`` per key, on every row of the key."""
    keys = _list(keys)
    first = (
        df.where(F.col(col).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(col, F.struct(ts, *tie)).alias(out))
    )
    return df.join(first, keys, "left")


def backfill_two_stage(current, full, keys, ts, col, out, tie=()) -> DataFrame:
    """First known value from the current period, else from the full history. Both stages
    come from one aggregate over the stacked frames, which combines map-side, so history rows
    are not shuffled and keys are looked up once."""
    keys = _list(keys)
    cols = [*keys, ts, *tie, col]
    stacked = current.select(*cols, F.lit(True).alias("__now")).unionByName(
        full.select(*cols, F.lit(False).alias("__now"))
    ).where(F.col(col).isNotNull())
    order = F.struct(ts, *tie)
    known = stacked.groupBy(*keys).agg(
        F.min_by(col, F.when(F.col("__now"), order)).alias("__recent"),
        F.min_by(col, order).alias("__older"),
    )
    value = F.coalesce(F.col(col), F.col("__recent"), F.col("__older"))
    return current.join(known, keys, "left").withColumn(out, value).drop("__recent", "__older")


def first_date(df, keys, ts, out="first_date") -> DataFrame:
    return df.groupBy(*_list(keys)).agg(F.min(ts).alias(out))


def first_event(df, keys, ts, pred: Column) -> DataFrame:
    """Rows at the first time of their key among rows matching ``pred``. A group minimum
    joined back keeps all rows that share that time."""
    keys = _list(keys)
    matching = df.where(pred)
    first = matching.groupBy(*keys).agg(F.min(ts).alias("__first"))
    joined = matching.join(first, keys)
    return joined.where(F.col(ts) == F.col("__first")).drop("__first")


def month_slots(df, month_col: str, n: int, out="slot") -> DataFrame:
    """Number the earliest ``n`` distinct months 1..n. Months are few by nature, so the
    single-partition window runs over one row per month."""
    months = df.select(F.col(month_col)).where(F.col(month_col).isNotNull()).distinct()
    numbered = months.withColumn(out, F.row_number().over(Window.orderBy(month_col)))
    return numbered.where(F.col(out) <= n)
