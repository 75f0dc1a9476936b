"""Scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog import frames as f
from dunlin.catalog.base import query
from dunlin.functions import dates, text
from dunlin.sources.scans import load


@query(r"""
SELECT doc_id, length(rtrim(text || '   ', ' ')) AS len, left(text, 50) AS head, upper(right(source, 2)) AS tail,
  trim(regexp_replace(text, '[\t\n\x0B\f\r]', ' ', 'g')) AS cleaned, replace(lang, 'e', 'E') AS lang2,
  instr(text, 'the') AS at, coalesce(lang, '') || coalesce(CASE WHEN doc_id % 2 = 0 THEN source END, '') AS joined,
  lang || CASE WHEN doc_id % 2 = 0 THEN source END AS plus FROM documents""")
def string_functions(spark, sf):
    t, source = F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return load(spark, sf, "documents").select(
        "doc_id",
        text.text_len(F.concat(t, F.lit("   "))).cast("bigint").alias("len"),
        F.left(t, F.lit(50)).alias("head"),
        F.upper(F.right(F.col("source"), F.lit(2))).alias("tail"), text.clean_str(t).alias("cleaned"),
        F.replace("lang", F.lit("e"), F.lit("E")).alias("lang2"),
        F.instr(t, "the").cast("bigint").alias("at"),
        text.concat_null_as_empty(F.col("lang"), source).alias("joined"),
        F.concat(F.col("lang"), source).alias("plus"))


@query("""
SELECT guid, ts, substring(email, instr(email, '@') + 1) AS domain, split_part(email, '@', 1) AS local,
  lower(rtrim(upper(letter) || '  ')) AS letter_key FROM msgs""")
def key_text_functions(spark, sf):
    email = F.col("email")
    return f.msgs(spark, sf).select(
        "guid", "ts", text.email_domain(email).alias("domain"), text.strip_suffix(email, "@").alias("local"),
        text.same_text(F.concat(F.upper("letter"), F.lit("  "))).alias("letter_key"))


@query("""
SELECT o_orderkey, last_day(o_orderdate) AS month_end, date_trunc('month', o_orderdate)::DATE AS month_start,
  CAST(o_orderdate AS DATE) + 30 AS plus_30,
  (1998 - year(o_orderdate)) * 12 + 3 - month(o_orderdate) AS months_to,
  DATE '1998-03-01' - CAST(o_orderdate AS DATE) AS days_to, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(o_orderdate AS DATE) AS from_key, strftime(o_orderdate, '%y-%b') AS label, strftime(o_orderdate, '%b-%y') AS label2,
  CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS sort_key, CAST(isodow(o_orderdate) AS INTEGER) AS weekday_no,
  strftime(o_orderdate, '%a') AS weekday FROM orders""")
def date_functions(spark, sf):
    d, to = F.col("o_orderdate"), F.lit("1998-03-01").cast("date")
    return load(spark, sf, "orders").select(
        "o_orderkey", dates.month_end(d).alias("month_end"), dates.month_start(d).alias("month_start"),
        F.date_add(d.cast("date"), 30).alias("plus_30"),
        dates.month_diff(d, to).cast("bigint").alias("months_to"),
        dates.day_diff(d, to).cast("bigint").alias("days_to"), dates.to_date_key(d).alias("date_key"),
        dates.from_date_key(dates.to_date_key(d)).alias("from_key"),
        dates.month_label(d, "yy-MMM").alias("label"), dates.month_label(d).alias("label2"),
        dates.month_sort_key(d).alias("sort_key"), dates.iso_weekday(d).alias("weekday_no"),
        dates.day_name(d).alias("weekday"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS s23, strftime(ts, '%Y.%m.%d') AS s102, strftime(ts, '%d %b %Y') AS s106,
  strftime(ts, '%m-%d-%Y') AS s110, strftime(ts, '%Y%m%d') AS s112, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s120,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS day_seconds FROM events""")
def convert_styles(spark, sf):
    ts = F.col("ts")
    return load(spark, sf, "events", ["event_id", "ts"]).select(
        "event_id", *[dates.convert_date(ts, s).alias(f"s{s}") for s in dates.CONVERT_STYLES],
        dates.seconds_of_day(ts).alias("day_seconds"))


@query("""
SELECT event_id, round(abs(value - 50), 2) AS r1, round(ln(value + 1), 8) AS ln1, CAST(k // 7 AS BIGINT) AS q,
  k % 7 AS m, CAST((event_id * 7 + 1499) // 1000 AS BIGINT) AS sec,
  round(value / nullif(k % 5, 0), 8) AS safe FROM ev""")
def math_functions(spark, sf):
    k, value = F.col("k"), F.col("value")
    return f.ev(spark, sf).select(
        "event_id", F.round(F.abs(value - 50), 2).alias("r1"), F.round(F.ln(value + 1), 8).alias("ln1"),
        F.floor(k / 7).cast("bigint").alias("q"), (k % 7).alias("m"),
        text.whole_seconds(F.col("event_id") * 7 + 1499).alias("sec"),
        F.round(text.ratio(value, k % 5), 8).alias("safe"))


@query("""
SELECT event_id, TRY_CAST(CASE WHEN k % 3 = 0 THEN 'x' || k ELSE CAST(k AS VARCHAR) END AS INTEGER) AS n,
  TRY_CAST(CASE WHEN k % 3 = 0 THEN 'x' || k ELSE CAST(k AS VARCHAR) END AS INTEGER) IS NOT NULL AS is_number,
  split_part('task|' || k || '|' || event_type, '|', 2) AS piece,
  CAST(coalesce(nullif(instr(event_type, 'r'), 0), 0) AS INTEGER) AS at FROM ev""")
def cast_and_parse_functions(spark, sf):
    """Failing casts, delimiter splits and pattern positions, as used to parse run logs."""
    k = F.col("k").cast("string")
    mixed = F.when(F.col("k") % 3 == 0, F.concat(F.lit("x"), k)).otherwise(k)
    line = F.concat_ws("|", F.lit("task"), k, F.col("event_type"))
    return f.ev(spark, sf).select(
        "event_id", mixed.try_cast("int").alias("n"), mixed.try_cast("int").isNotNull().alias("is_number"),
        F.split(line, "\\|")[1].alias("piece"), F.regexp_instr("event_type", F.lit("r")).alias("at"))
