"""Sinks, file sources and streams: each query writes derived data and returns the state."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog import frames as f
from dunlin.catalog.base import cte, query
from dunlin.sources import scans, sinks
from dunlin.sources.checkpoints import new_folder
from dunlin.sources.scans import load
from dunlin.streaming import streams

cte("stored", """
SELECT o_orderkey AS id, o_totalprice AS amount, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS status,
  date_trunc('year', o_orderdate)::DATE AS yr, CAST(NULL AS DATE) AS updated FROM orders
""")
cte("incoming", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS amount,
  o_orderstatus AS status, date_trunc('year', o_orderdate)::DATE AS yr FROM orders WHERE o_orderdate >= '1999-01-01'
UNION ALL SELECT 1000000000 + c_custkey, c_acctbal, c_mktsegment, DATE '2002-01-01' FROM customer
""")


def _stored(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("status"),
        F.trunc(F.col("o_orderdate").cast("date"), "YEAR").alias("yr"), F.lit(None).cast("date").alias("updated"))


def _incoming(spark, sf):
    key = F.col("o_orderkey")
    recent = load(spark, sf, "orders", where=F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    changed = recent.select(
        key.alias("id"), F.when(key % 2 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderstatus").alias("status"), F.trunc(F.col("o_orderdate").cast("date"), "YEAR").alias("yr"))
    new = load(spark, sf, "customer").select(
        (F.lit(1000000000) + F.col("c_custkey")).alias("id"), F.col("c_acctbal").alias("amount"),
        F.col("c_mktsegment").alias("status"), F.lit("2002-01-01").cast("date").alias("yr"))
    return changed.unionByName(new)


def _upsert_sql(differs):
    return f"""
SELECT coalesce(s.id, i.id) AS id, CASE WHEN s.id IS NULL OR ({differs}) THEN round(i.amount, 4) ELSE round(s.amount, 4) END
  AS amount, CASE WHEN s.id IS NULL OR ({differs}) THEN i.status ELSE s.status END AS status,
  CASE WHEN s.id IS NULL OR ({differs}) THEN i.yr ELSE s.yr END AS yr,
  CASE WHEN s.id IS NOT NULL AND ({differs}) THEN DATE '2002-01-05' END AS updated
FROM stored s FULL JOIN incoming i ON s.id = i.id"""


PLAIN = "coalesce(s.amount <> i.amount, false) OR coalesce(s.status <> i.status, false)"
SAFE = "i.id IS NOT NULL AND (s.amount IS DISTINCT FROM i.amount OR s.status IS DISTINCT FROM i.status)"


def _stamp():
    return {"updated": F.lit("2002-01-05").cast("date")}


@query(_upsert_sql(PLAIN))
def upsert_changed(spark, sf):
    return sinks.upsert(_stored(spark, sf), _incoming(spark, sf), ["id"], ["amount", "status"], stamp=_stamp()
                        ).withColumn("amount", F.round("amount", 4))


@query(_upsert_sql(SAFE))
def upsert_null_safe(spark, sf):
    return sinks.upsert(_stored(spark, sf), _incoming(spark, sf), ["id"], ["amount", "status"], null_safe=True,
                        stamp=_stamp()).withColumn("amount", F.round("amount", 4))


@query(_upsert_sql(PLAIN))
def write_upsert(spark, sf):
    """Stored form, twice: the second run changes nothing."""
    path, updates = new_folder(spark, "upsert"), _incoming(spark, sf)
    sinks.write_full(_stored(spark, sf), path, ["yr"])
    for _ in range(2):
        sinks.write_upsert(path, updates, ["id"], "yr", compare_cols=["amount", "status"], stamp=_stamp())
    return sinks.read_table(spark, path).withColumn("amount", F.round("amount", 4))


@query("""
SELECT o_orderkey, o_totalprice * CASE WHEN year(o_orderdate) = 2000 THEN 2 ELSE 1 END AS price,
  CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def write_window(spark, sf):
    """Full refresh by year, then one year replaced, twice."""
    path = new_folder(spark, "window")
    rows = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                            F.year("o_orderdate").alias("y"))
    sinks.write_full(rows, path, ["y"])
    doubled = rows.where(F.col("y") == 2000).withColumn("price", F.col("price") * 2)
    for _ in range(2):
        sinks.write_window(doubled, path, "y")
    return sinks.read_table(spark, path)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def append_new(spark, sf):
    path = new_folder(spark, "append")
    rows = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    sinks.append_new(rows.where(F.col("o_totalprice") > 200000), path, ["o_orderkey"])
    sinks.append_new(rows, path, ["o_orderkey"])
    sinks.append_new(rows, path, ["o_orderkey"])
    return sinks.read_table(spark, path)


@query("""
SELECT c_custkey, coalesce(t, 0) AS total FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 4) AS t FROM orders
  WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def update_from(spark, sf):
    totals = load(spark, sf, "orders", ["o_custkey", "o_totalprice"], F.col("o_orderstatus") == "F").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 4).alias("total"))
    return sinks.update_from(load(spark, sf, "customer", ["c_custkey"]), totals, ["c_custkey"], "total", 0.0)


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN round(c_acctbal * 2, 4) ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_acctbal > 5000 THEN 'scored' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def write_back(spark, sf):
    c = load(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    scored = c.where(F.col("c_acctbal") > 5000).select(
        "c_custkey", F.round(F.col("c_acctbal") * 2, 4).alias("c_acctbal"), F.lit("scored").alias("c_mktsegment"))
    return sinks.write_back(c, scored, ["c_custkey"], ["c_acctbal", "c_mktsegment"])


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def export_csv(spark, sf):
    cols = ["p_partkey", "p_name", "p_brand"]
    path = sinks.export_csv(load(spark, sf, "part", cols), new_folder(spark, "export"), "parts", "2024-01-31", ["p_partkey"])
    return scans.read_flat_file(spark, path, cols)


@query("""
SELECT o_custkey, total, m AS snapshot_month FROM (SELECT o_custkey, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1),
  (VALUES (DATE '2000-06-01'), (DATE '2000-07-01')) v(m)""")
def snapshot_if_due(spark, sf):
    """Three runs in June and July: the second June run is not due."""
    path = new_folder(spark, "snap")
    totals = load(spark, sf, "orders", ["o_custkey", "o_totalprice"]).groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 4).alias("total"))
    for day in ("2000-06-15", "2000-06-20", "2000-07-01"):
        sinks.snapshot_if_due(totals, path, day)
    return sinks.read_table(spark, path)


@query("""
SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'error' AND ts < '2024-01-20')""")
def since_watermark(spark, sf):
    e = load(spark, sf, "events", ["event_id", "ts", "event_type"])
    reported = e.where((F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return sinks.since_watermark(e, reported, "ts", "2023-01-01").select("event_id", "ts")


@query("""
SELECT 'orders' AS task, 'processed' AS stage, count(*) AS n_rows FROM orders
UNION ALL SELECT 'orders', 'final', count(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'orders', 'errors', count(*) FROM orders WHERE o_totalprice < 2000
UNION ALL SELECT 'events', 'processed', count(*) FROM events""")
def audit_counts(spark, sf):
    o = load(spark, sf, "orders")
    return sinks.audit_counts({
        "orders": {"processed": o, "final": o.where(F.col("o_orderstatus") != "P"),
                   "errors": o.where(F.col("o_totalprice") < 2000)},
        "events": {"processed": load(spark, sf, "events")}})


@query("SELECT min(DATE '2024-02-02' - CAST(ts AS DATE)) AS days_old FROM events")
def freshness_days(spark, sf):
    return sinks.freshness_days(load(spark, sf, "events", ["ts"]), "ts", "2024-02-02").select(
        F.col("days_old").cast("bigint").alias("days_old"))


@query("""
SELECT 'events' AS table_name, count(*) AS rows_before, count(*) FILTER (CAST(ts AS DATE) >= DATE '2024-01-16') AS rows_after FROM events
UNION ALL SELECT 'orders', count(*), count(*) FILTER (CAST(o_orderdate AS DATE) >= DATE '2024-01-31' - 9000) FROM orders""")
def retention_purge(spark, sf):
    config = spark.createDataFrame(
        [("events", 15, True, 1), ("orders", 9000, True, 2), ("lineitem", 1, False, 3)],
        "table_name string, days int, is_active boolean, sort int")
    tables = {"events": (load(spark, sf, "events"), "ts"), "orders": (load(spark, sf, "orders"), "o_orderdate"),
              "lineitem": (load(spark, sf, "lineitem"), "l_shipdate")}
    kept, log = sinks.apply_retention(tables, config, "2024-01-31")
    path = new_folder(spark, "kept")
    for name, df in kept.items():
        sinks.write_full(df, f"{path}/{name}")
    return log


@query("""
SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS balance,
  CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS segment, TIMESTAMP '2024-01-31' AS import_time FROM customer""")
def typed_load(spark, sf):
    """All-text CSV with duplicates, bad numbers and blanks, read back typed."""
    key = F.col("c_custkey")
    raw = load(spark, sf, "customer").select(
        key.cast("string").alias("c_custkey"),
        F.when(key % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(key % 4 > 0, F.col("c_mktsegment")).otherwise("  ").alias("segment"))
    path = sinks.export_csv(raw.unionByName(raw), new_folder(spark, "raw"), "customers", "2024-01-31")
    return scans.typed_load(scans.read_flat_file(spark, path, raw.columns),
                            {"c_custkey": "bigint", "balance": "double", "segment": "string"}, "2024-01-31")


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def json_pages(spark, sf):
    """Documents landed as JSON pages of 50, with an empty last page, parsed back to rows."""
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("balance"), F.struct(F.col("c_mktsegment").alias("segment")).alias("meta")))
    pages = load(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(doc), ",\n"), F.lit("]")).alias("value"))
    path = new_folder(spark, "pages")
    pages.repartition("page").write.partitionBy("page").text(path)
    spark.createDataFrame([("[]",)], "value string").write.text(f"{path}/page=-1")
    schema = "id bigint, name string, balance double, meta struct<segment: string>"
    return scans.read_json_pages(spark, path, schema).select("id", "name", "balance", "meta.segment")


# ---- streams ------------------------------------------------------------------------------------


def _event_stream(spark, sf):
    # a glob path streams a single file as well as a folder of part files
    schema = load(spark, sf, "events").schema
    feed = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return feed.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(spark, stream, name):
    folder = new_folder(spark, name)
    streams.run_available(stream, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query("SELECT event_id, user_id, ts FROM events")
def stream_dedupe_sessions(spark, sf):
    """The same feed arrives twice; every session is stored once."""
    feed = _event_stream(spark, sf).select("event_id", "user_id", "ts")
    once = streams.dedupe_sessions(feed.union(feed), "event_id", "ts")
    return _drain(spark, once, "dedupe").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT h AS hour_start, CAST(isodow(h) AS INTEGER) AS weekday_no, CAST(hour(h) AS INTEGER) AS hour_no, event_type,
  count(*) AS n_events FROM (SELECT *, date_trunc('hour', ts) AS h FROM events)
WHERE h + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) GROUP BY ALL""")
def stream_hourly_counts(spark, sf):
    """Hours the watermark has closed (one hour of delay)."""
    counts = streams.hourly_counts(_event_stream(spark, sf), "ts", ["event_type"])
    return _drain(spark, counts, "hourly").withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query("""
SELECT user_id, event_id, ts, days_3 FROM (SELECT *, CAST(ts AS DATE) - CAST(lag(ts, 3) OVER (PARTITION BY user_id
  ORDER BY ts, event_id) AS DATE) AS days_3 FROM events WHERE event_type = 'error') WHERE days_3 < 2""")
def stream_contact_cap(spark, sf):
    errors = _event_stream(spark, sf).where(F.col("event_type") == "error")
    alerts = streams.contact_cap_alerts(errors, "user_id", "ts", "event_id", k=3, days=2)
    return _drain(spark, alerts, "cap").withColumns(
        {"ts": F.col("ts").cast("timestamp_ntz"), "days_3": F.col("days_3").cast("bigint")})


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts >= '2024-01-02' AND ts < '2024-01-05' GROUP BY 1")
def incremental_range(spark, sf):
    """Rows of a refresh range, re-read as the window of a stored daily table."""
    path = new_folder(spark, "daily")
    days = f.ev(spark, sf).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_full(days, path)
    return scans.range_scan(sinks.read_table(spark, path), "day", "2024-01-02", "2024-01-05")
