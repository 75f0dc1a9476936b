"""Sinks on plain Parquet: refresh, window replace, append-new, upsert, snapshot, retention.

Every write that replaces rows is idempotent: running it twice with the same input leaves
the same table. A frame that reads the table it replaces is first materialised in the
shared folder (``cut_lineage``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.functions.dates import as_date, month_floor
from dunlin.sources.checkpoints import cut_lineage


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_full(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)


def write_window(df: DataFrame, path: str, part_col: str) -> None:
    """Replace only the partitions (date, month, label) present in ``df``. Rows are
    distributed by the partition value plus a random split, so one large period is written
    by several tasks (AQE sizes them) and small periods do not scatter into many files."""
    spread = df.hint("rebalance", part_col)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        part_col
    ).parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Append the rows whose key is not in the table yet; returns what was new."""
    target = read_table(df.sparkSession, path)
    fresh = df if target is None else df.join(target.select(*keys), list(keys), "left_anti")
    fresh = cut_lineage(fresh)
    fresh.write.mode("append").parquet(path)
    return fresh


def _differs(cols: Sequence[str], null_safe: bool) -> Column:
    def one(c):
        old, new = F.col(f"__old_{c}"), F.col(f"__new_{c}")
        return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))

    return reduce(lambda a, b: a | b, [one(c) for c in cols])


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str],
    compare_cols: Sequence[str] | None = None, null_safe: bool = False,
    stamp: Mapping[str, Column] | None = None, change_as: str | None = None,
) -> DataFrame:
    """New state of ``target``: rows that differ in a compared column are updated, missing
    rows inserted, all others kept.

    ``null_safe=False`` is the plain ``<>`` comparison, which does not see a change from or
    to NULL. ``stamp`` sets columns on updated rows (for example an update date);
    ``change_as`` adds a column with same / update / insert. Keys must be unique per side.
    """
    keys = list(keys)
    values = [c for c in updates.columns if c not in keys]
    compare = list(compare_cols or values)
    kept = [c for c in target.columns if c not in keys]
    old = target.select(
        *keys, F.lit(True).alias("__has_old"), *[F.col(c).alias(f"__old_{c}") for c in kept]
    )
    new = updates.select(
        *keys, F.lit(True).alias("__has_new"), *[F.col(c).alias(f"__new_{c}") for c in values]
    )
    both = old.join(new, keys, "full")
    change = (
        F.when(F.col("__has_old").isNull(), "insert")
        .when(F.col("__has_new").isNull(), "same")
        .when(_differs(compare, null_safe), "update")
        .otherwise("same")
    )
    both = both.withColumn("__change", change)
    out = []
    for c in kept:
        if c in values:
            taken = F.col("__change").isin("insert", "update")
            value = F.when(taken, F.col(f"__new_{c}")).otherwise(F.col(f"__old_{c}"))
        else:
            value = F.col(f"__old_{c}")
        if stamp and c in stamp:
            value = F.when(F.col("__change") == "update", stamp[c]).otherwise(value)
        out.append(value.alias(c))
    tail = [F.col("__change").alias(change_as)] if change_as else []
    return both.select(*keys, *out, *tail)


PRUNED_VALUES = 1_000


def _partitions(target: DataFrame, touched: DataFrame, part_col: str) -> DataFrame:
    """Rows of ``target`` in the partitions of ``touched`` (NULL is one of them). Up to
    ``PRUNED_VALUES`` values become a literal filter, so other partitions are not listed or
    read; more are joined, with the same rows."""
    values = [r[0] for r in touched.limit(PRUNED_VALUES + 1).collect()]
    if len(values) > PRUNED_VALUES:
        wanted = touched.select(F.col(part_col).alias("__touched"))
        return target.join(wanted, F.col(part_col).eqNullSafe(F.col("__touched")), "left_semi")
    listed = F.col(part_col).isin([v for v in values if v is not None])
    return target.where(listed | F.col(part_col).isNull() if None in values else listed)


def _remove_partitions(path: str, emptied: DataFrame, part_col: str) -> None:
    """Delete the folders of the partitions in ``emptied``."""
    jvm = emptied.sparkSession._jvm
    folder = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(emptied.sparkSession._jsc.hadoopConfiguration())
    for (value,) in emptied.select(F.col(part_col).cast("string")).toLocalIterator():
        files.delete(jvm.org.apache.hadoop.fs.Path(path, folder(part_col, value)), True)


def write_upsert(
    path: str, updates: DataFrame, keys: Sequence[str], part_col: str | None = None,
    compare_cols: Sequence[str] | None = None, null_safe: bool = False, stamp=None,
) -> None:
    """Upsert into a stored table.

    With ``part_col`` the changed rows are found first (the target is read for its keys and
    compared columns only), and only partitions that gain, lose or change rows are read whole
    and rewritten; one that loses its last row is deleted. Nothing is written when nothing
    changed."""
    spark, keys = updates.sparkSession, list(keys)
    target = read_table(spark, path)
    if target is None:
        write_full(updates, path, [part_col] if part_col else ())
        return
    if part_col is None:
        state = upsert(target, updates, keys, compare_cols, null_safe, stamp)
        write_full(cut_lineage(state), path)
        return
    compare = list(compare_cols or [c for c in updates.columns if c not in keys])
    old = target.select(
        *keys, F.lit(True).alias("__known"), F.col(part_col).alias("__was"),
        *[F.col(c).alias(f"__old_{c}") for c in compare],
    )
    new = updates.select(*updates.columns, *[F.col(c).alias(f"__new_{c}") for c in compare])
    changed = cut_lineage(
        new.join(old, keys, "left")
        .where(F.col("__known").isNull() | _differs(compare, null_safe))
        .select(*updates.columns, "__was")
    )
    touched = changed.select(part_col).union(
        changed.where(F.col("__was").isNotNull()).select("__was")
    ).distinct()
    touched = cut_lineage(touched)  # one row per partition value
    if touched.isEmpty():
        return
    part = _partitions(target, touched, part_col)
    rows = cut_lineage(
        upsert(part, changed.drop("__was"), keys, compare, null_safe, stamp)
    )
    # a partition that lost its last row: the rows moved are all in ``updates``, so if the job
    # ends between the two steps, running it again puts them back
    left = rows.select(F.col(part_col).alias("__left")).distinct()
    _remove_partitions(path, touched.join(left, F.col(part_col).eqNullSafe(F.col("__left")), "left_anti"), part_col)
    write_window(rows, path, part_col)


def update_from(df: DataFrame, agg: DataFrame, on: Sequence[str], col: str, default) -> DataFrame:
    """Set ``col`` from an aggregate keyed by ``on``; rows without a match get ``default``."""
    found = agg.select(*on, F.col(col).alias("__v"))
    joined = df.drop(col).join(found, list(on), "left")
    return joined.withColumn(col, F.coalesce("__v", F.lit(default))).drop("__v")


def write_back(
    df: DataFrame, scored: DataFrame, keys: Sequence[str], cols: Sequence[str], only: Column | None = None
):
    """Overwrite ``cols`` on rows that were scored and, with ``only``, fulfil it; all other
    rows keep their values."""
    found = scored.select(*keys, F.lit(True).alias("__hit"),
                          *[F.col(c).alias(f"__{c}") for c in cols])
    marked = df if only is None else df.withColumn("__only", F.coalesce(only, F.lit(False)))
    joined = marked.join(found, list(keys), "left")
    hit = F.col("__hit") if only is None else F.col("__hit") & F.col("__only")
    values = {c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in cols}
    return joined.withColumns(values).drop("__hit", "__only", *[f"__{c}" for c in cols])


def export_csv(
    df: DataFrame, folder: str, prefix: str, as_of, order: Sequence[str] = (), files: int | None = None
) -> str:
    """Date-stamped CSV extract with header; ``order`` sorts it across its files, ``files``
    bounds their number (1 only for extracts known to be small)."""
    path = f"{folder.rstrip('/')}/{prefix}_{as_date(as_of):%Y%m%d}"
    out = df.orderBy(*order) if order else df
    if files:
        out = out.coalesce(files)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def last_snapshot(spark: SparkSession, path: str, month_col: str):
    target = read_table(spark, path)
    return None if target is None else target.agg(F.max(month_col)).first()[0]


def snapshot_if_due(df: DataFrame, path: str, as_of, month_col="snapshot_month") -> bool:
    """Store ``df`` as the snapshot of the month of ``as_of`` when no snapshot of that month
    or a later one exists. The gate compares with the calendar month; comparing the table's
    last month with its own successor, as one source does, could never be due."""
    month = month_floor(as_of)
    last = last_snapshot(df.sparkSession, path, month_col)
    if last is not None and as_date(last) >= month:
        return False
    write_window(df.withColumn(month_col, F.lit(str(month)).cast("date")), path, month_col)
    return True


def since_watermark(df: DataFrame, target: DataFrame | None, ts_col: str, default, strict=False,
                    target_col: str | None = None) -> DataFrame:
    """Rows at or after (``strict``: after) the newest time stored in ``target``. The mark is
    one value, read first, so the filter is a literal that reaches the scan."""
    mark = None if target is None else target.agg(F.max(target_col or ts_col)).first()[0]
    bound = F.lit(str(default if mark is None else mark)).cast(df.schema[ts_col].dataType)
    return df.where(F.col(ts_col) > bound if strict else F.col(ts_col) >= bound)


def audit_counts(steps: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per task and stage, for example processed / final / errors."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(task).alias("task"), F.lit(stage).alias("stage"), "n_rows")
        for task, stages in steps.items() for stage, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def freshness_days(df: DataFrame, ts_col: str, as_of, out="days_old") -> DataFrame:
    """Smallest number of days between an import and ``as_of`` (0 = loaded today)."""
    today = F.lit(str(as_date(as_of))).cast("date")
    return df.agg(F.min(F.datediff(today, F.col(ts_col).cast("date"))).alias(out))


def presence_checks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per measure: does any row hold a non-zero value?"""
    flags = df.agg(*[
        F.coalesce(F.max((F.col(c) != 0).cast("int")), F.lit(0)).alias(c) for c in cols
    ])
    return flags.unpivot([], list(cols), "measure", "has_data")


def apply_retention(
    tables: Mapping[str, tuple[DataFrame, str]], config: DataFrame, as_of
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Keep rows not older than the configured number of days.

    ``tables`` maps a name to (frame, date column); ``config`` has (table_name, days,
    is_active, sort). Returns the kept frames in configured order and a log of counts before
    and after. Only config rows of the given tables are read."""
    rows = (
        config.where(F.col("table_name").isin(list(tables)) & F.col("is_active"))
        .orderBy("sort", "table_name").collect()
    )
    kept, log = {}, []
    for row in rows:
        df, day = tables[row["table_name"]]
        limit = F.date_sub(F.lit(str(as_date(as_of))).cast("date"), int(row["days"]))
        keep = F.coalesce(F.col(day).cast("date") >= limit, F.lit(True))
        kept[row["table_name"]] = df.where(keep)
        log.append(df.agg(
            F.lit(row["table_name"]).alias("table_name"),
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(keep).alias("rows_after"),
        ))
    return kept, reduce(DataFrame.unionByName, log)
