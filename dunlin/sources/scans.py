"""Scans: tables, flat files, landed JSON pages, remote queries, literals and calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dunlin.functions.dates import as_date


def load(
    spark: SparkSession, sf_dir: str, name: str, cols: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Table scan; projection and predicate reach the Parquet reader."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if where is not None:
        df = df.where(where)
    return df if cols is None else df.select(*cols)


def range_scan(df: DataFrame, col: str, start, end) -> DataFrame:
    """Half-open range ``[start, end)`` as literals of the column's own type, so that the
    filter is pushed down without a cast on the column."""
    kind = df.schema[col].dataType
    lo, hi = (F.lit(str(v)).cast(kind) for v in (start, end))
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


def read_flat_file(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True
) -> DataFrame:
    """Quoted CSV with every column as text; types are cast later (``typed_load``)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(
        path, schema=schema, header=header, quote='"', escape='"', mode="PERMISSIVE",
        multiLine=False,
    )


def typed_load(raw: DataFrame, casts: Mapping[str, str], as_of, stamp="import_time") -> DataFrame:
    """De-duplicate, cast text to types (bad values become NULL), stamp the import time.

    A cast is a type name, or ``"date:<pattern>"`` for dates in a given format."""
    def typed(name: str, kind: str) -> Column:
        col = F.nullif(F.trim(F.col(name)), F.lit(""))
        if kind.startswith("date:"):
            return F.try_to_timestamp(col, F.lit(kind[5:])).cast("date").alias(name)
        return col.try_cast(kind).alias(name)

    distinct = raw.select(*[typed(n, k) for n, k in casts.items()]).distinct()
    return distinct.withColumn(stamp, F.lit(str(as_of)).cast("timestamp_ntz"))


def read_json_pages(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Landed API pages (one JSON array per file, a bounded number of documents each) to one
    row per document: the raw text and its parsed columns. Empty pages add no rows."""
    pages = spark.read.text(path, wholetext=True)
    raw = pages.select(F.explode(F.from_json("value", "array<string>")).alias("raw"))
    return raw.select("raw", F.from_json("raw", schema).alias("doc")).select("raw", "doc.*")


def read_remote(
    spark: SparkSession, url: str, query: str, props: Mapping[str, str] | None = None,
    split: tuple[str, object, object, int] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Remote query over JDBC. ``split`` is (column, lower, upper, partitions); without it or
    ``predicates`` the database delivers everything through one task, so give one of them
    for anything but a small lookup."""
    table, props = f"({query}) q", dict(props or {})
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **props)
    if split is not None:
        column, lower, upper, n = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(n),
        )
    return reader.load()


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Inline table of literals: small by construction, so it may be broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def date_spine(spark: SparkSession, start, end, grain: str = "day", out: str = "day") -> DataFrame:
    """One row per day or month from ``start`` to ``end``, both included."""
    step = {"day": "interval 1 day", "month": "interval 1 month"}[grain]
    series = f"sequence(date'{as_date(start)}', date'{as_date(end)}', {step})"
    return spark.range(1).select(F.explode(F.expr(series)).alias(out))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """Calendar: day, integer key, year, month and quarter attributes."""
    d = F.col("day")
    return date_spine(spark, start, end).select(
        d,
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.floor((F.month(d) + 2) / 3).cast("int").alias("quarter_no"),
        F.dayofmonth(d).alias("day_no"),
        F.trunc(d, "MM").alias("month_start"),
        (F.year(d) * 100 + F.month(d)).alias("month_id"),
    )


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Pass-through and projecting views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
