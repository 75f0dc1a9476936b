"""Scans, filters, joins, windows, aggregates and set operations over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dunlin.catalog import frames as f
from dunlin.catalog.base import query
from dunlin.catalog.frames import r4
from dunlin.functions import dates, labels, text
from dunlin.operators import aggregates as agg
from dunlin.operators import joins, percentiles, ranking, sets, windows
from dunlin.sources import scans
from dunlin.sources.scans import load, lookup


def _big(*names):
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _orders(spark, sf, *cols):
    return load(spark, sf, "orders", list(cols) or None)


def _day(name="o_orderdate"):
    return F.col(name).cast("date")


# ---- scans ------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45")
def table_scan(spark, sf):
    pred = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    return load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], pred)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1997-04-01'")
def range_scan(spark, sf):
    return scans.range_scan(_orders(spark, sf, "o_orderkey", "o_orderdate"), "o_orderdate",
                            "1997-01-01", "1997-04-01")


@query("""
SELECT event_type, direction, count(*) AS n FROM events
JOIN (VALUES ('click', 'IN'), ('view', 'IN'), ('signup', 'OUT')) m(event_type, direction) USING (event_type)
GROUP BY ALL""")
def inline_lookup(spark, sf):
    codes = lookup(spark, [("click", "IN"), ("view", "IN"), ("signup", "OUT")],
                   "event_type string, direction string")
    return load(spark, sf, "events", ["event_type"]).join(codes, "event_type").groupBy(
        "event_type", "direction").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 4) AS balance FROM customer GROUP BY 1""")
def view_scan(spark, sf):
    scans.register_views(spark, {"v_accounts": load(spark, sf, "customer", ["c_mktsegment", "c_acctbal"])})
    return spark.sql("SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 4) AS balance "
                     "FROM v_accounts GROUP BY c_mktsegment")


CALENDAR_SQL = """
SELECT CAST(d AS DATE) AS day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no, strftime(d, '%B') AS month_name,
  CAST((month(d) + 2) // 3 AS INTEGER) AS quarter_no, CAST(day(d) AS INTEGER) AS day_no,
  date_trunc('month', d)::DATE AS month_start, CAST(strftime(d, '%Y%m') AS INTEGER) AS month_id
FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d)"""


@query(f"""
SELECT day, date_key, year, month_no, month_name, quarter_no, day_no, month_start, month_id,
  count(o_orderkey) AS n_orders FROM ({CALENDAR_SQL}) c
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY ALL""")
def calendar_spine(spark, sf):
    calendar = scans.dim_date(spark, "1995-01-01", "2001-12-31")
    per_day = _orders(spark, sf, "o_orderdate").groupBy(_day().alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return calendar.join(per_day, "day", "left").fillna(0, ["n_orders"])


@query(f"""
SELECT year, quarter_no, o_orderstatus, count(*) AS n FROM orders JOIN ({CALENDAR_SQL}) c
ON CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) = date_key GROUP BY ALL""")
def date_key_join(spark, sf):
    keyed = _orders(spark, sf, "o_orderdate", "o_orderstatus").withColumn(
        "k", dates.to_date_key(F.col("o_orderdate")))
    calendar = scans.dim_date(spark, "1995-01-01", "2001-12-31")
    return joins.join_date_key(keyed, "k", calendar).groupBy(
        "year", "quarter_no", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT month_name, event_type, count(*) AS n FROM events LEFT JOIN
  ({CALENDAR_SQL.replace('1995-01-01', '2024-01-10')
    .replace('2001-12-31', '2024-01-20')}) c ON CAST(ts AS DATE) = day GROUP BY ALL""")
def date_part_join(spark, sf):
    calendar = scans.dim_date(spark, "2024-01-10", "2024-01-20")
    return joins.join_on_date(load(spark, sf, "events", ["ts", "event_type"]), "ts", calendar).groupBy(
        "month_name", "event_type").agg(F.count(F.lit(1)).alias("n"))


# ---- periods and predicates -----------------------------------------------------------------------


@query("""
SELECT 'report_month' AS period, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN '1998-02-01' AND '1998-02-28'
UNION ALL SELECT 'prev_month', count(*) FROM orders WHERE o_orderdate >= '1998-02-01' AND o_orderdate < '1998-03-01'
UNION ALL SELECT 'fri_week', count(*) FROM orders WHERE o_orderdate >= '1998-02-20' AND o_orderdate < '1998-02-27'
UNION ALL SELECT 'restated', count(*) FROM orders WHERE o_orderdate >= '1998-02-01' AND o_orderdate < '1998-03-01'""")
def reporting_periods(spark, sf):
    as_of = dt.date(1998, 3, 2)
    start, end = dates.report_month(as_of)
    friday = dates.last_fri_week(as_of)
    restated = dates.restate_prev_month(as_of)
    spans = {
        "report_month": (start, end + dt.timedelta(days=1)), "prev_month": dates.prev_month(as_of),
        "fri_week": friday, "restated": (restated, dates.add_months(restated, 1)),
    }
    o = _orders(spark, sf, "o_orderdate")
    parts = [
        scans.range_scan(o, "o_orderdate", lo, hi).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("period"), "n") for name, (lo, hi) in spans.items()
    ]
    return sets.union_all(*parts)


@query("""
SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW', '2-HIGH')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def in_list_filters(spark, sf):
    o = labels.where_in(_orders(spark, sf), "o_orderstatus", ["F", "O"])
    o = labels.where_in(o, "o_orderpriority", ["5-LOW", "2-HIGH"], negate=True)
    building = load(spark, sf, "customer", ["c_custkey"], F.col("c_mktsegment") == "BUILDING")
    return labels.where_in(o, "o_custkey", building).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%RING%' AND p_brand LIKE 'Brand#1%' AND p_type NOT LIKE '%SMALL%'")
def like_filters(spark, sf):
    p = load(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    return p.where(F.col("p_name").ilike("%RING%") & F.col("p_brand").like("Brand#1%")
                   & ~F.col("p_type").like("%SMALL%")).select("p_partkey")


@query("""
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN '1999-01-31' AND '1999-03-01'
  AND o_totalprice BETWEEN 1000 AND 100000""")
def between_filters(spark, sf):
    day = F.col("o_orderdate").between(F.lit("1999-01-31").cast("timestamp_ntz"),
                                       F.lit("1999-03-01").cast("timestamp_ntz"))
    return _orders(spark, sf).where(day & F.col("o_totalprice").between(1000, 100000)).select("o_orderkey")


@query("""
SELECT CASE WHEN c_acctbal > 0 AND c_acctbal < 500 THEN 'A-0-$499' WHEN c_acctbal >= 500 AND c_acctbal < 1000
    THEN 'B-$500-$999' WHEN c_acctbal >= 1000 AND c_acctbal < 2500 THEN 'C-$1000-$2499'
    WHEN c_acctbal >= 2500 AND c_acctbal < 4999 THEN 'D-$2500-$4999' WHEN c_acctbal >= 5000 THEN 'E-$5000+' END
    AS band, CASE WHEN c_acctbal <= 0 THEN 'none' WHEN c_acctbal <= 5000 THEN 'mid' ELSE 'top' END AS edge,
  count(*) AS n FROM customer GROUP BY ALL""")
def range_bands(spark, sf):
    from dunlin.plans.payments import balance_band

    bal = F.col("c_acctbal")
    edge = labels.upto_bands(bal, [(0, "none"), (5000, "mid")], "top")
    return load(spark, sf, "customer", ["c_acctbal"]).groupBy(
        balance_band(bal).alias("band"), edge.alias("edge")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' AND c_nationkey < 5 THEN 'Series'
  WHEN c_mktsegment <> 'BUILDING' THEN 'Recovery' WHEN c_acctbal > 0 THEN 'Legal' ELSE 'Unknown' END AS segment,
  CAST(substring(c_name, 17, 2) AS INTEGER) > 89 AS is_control FROM customer""")
def segment_and_control(spark, sf):
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    rules = [((seg != "BUILDING") & (F.col("c_nationkey") < 5), "Series"),
             (seg != "BUILDING", "Recovery"), (bal > 0, "Legal")]
    return load(spark, sf, "customer").select(
        "c_custkey", labels.classify(rules, "Unknown").alias("segment"),
        labels.control_split(F.col("c_name"), 17, 2, 89).alias("is_control"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= '1999-01-01' AND o_orderpriority LIKE '%HIGH%'
  THEN replace(o_orderpriority, 'HIGH', 'TOP') ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def recoded_rows(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_orderdate", "o_orderpriority")
    pred = (F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) & F.col(
        "o_orderpriority").contains("HIGH")
    out = labels.recode(o, pred, "o_orderpriority",
                        F.replace("o_orderpriority", F.lit("HIGH"), F.lit("TOP")))
    return out.select("o_orderkey", "o_orderpriority")


@query("""
SELECT event_id, CASE WHEN instr(d, '1') = 0 THEN 0 ELSE 1 END AS one, CASE WHEN instr(d, '5') = 0 THEN 0 ELSE 1 END AS five
FROM (SELECT event_id, CASE WHEN k % 9 <> 0 THEN CAST(k AS VARCHAR) END AS d FROM ev)""")
def decoded_flags(spark, sf):
    e = f.ev(spark, sf).select("event_id", F.when(F.col("k") % 9 != 0, F.col("k").cast("string")).alias("d"))
    return e.withColumns(labels.decode_flags(F.col("d"), {"1": "one", "5": "five"})).drop("d")


@query("""
SELECT s_suppkey, nullif(trim(CASE WHEN s_suppkey % 3 = 0 THEN '  ' ELSE s_name END), '') AS name,
  coalesce(CASE WHEN s_suppkey % 4 > 0 THEN s_nationkey END, -1) AS nation FROM supplier""")
def blank_defaults(spark, sf):
    key = F.col("s_suppkey")
    return load(spark, sf, "supplier").select(
        "s_suppkey",
        text.null_if_blank(F.when(key % 3 == 0, "  ").otherwise(F.col("s_name"))).alias("name"),
        F.coalesce(F.when(key % 4 > 0, F.col("s_nationkey")), F.lit(-1)).alias("nation"))


@query("""
SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < '1998-08-01'
  OR o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'P' GROUP BY ALL""")
def era_predicate(spark, sf):
    rule = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    out = labels.where_by_era(_orders(spark, sf), _day(), dt.date(1998, 8, 1), rule,
                              F.col("o_orderstatus") == "P")
    return out.groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CASE code WHEN 10 THEN 'Delivered' WHEN 5 THEN 'Opened' WHEN 12 THEN 'Clicked' WHEN 6 THEN 'Unsubscribed'
  ELSE 'Other' END AS outcome, count(*) AS n FROM msgs GROUP BY 1""")
def outcome_mapping(spark, sf):
    names = {10: "Delivered", 5: "Opened", 12: "Clicked", 6: "Unsubscribed"}
    return f.msgs(spark, sf).groupBy(labels.map_outcome(F.col("code"), names).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]).distinct()


@query("""
SELECT o_orderpriority, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '1-URGENT' THEN 3 END
  AS INTEGER) AS sort_no, CASE WHEN pr IS NULL THEN '(Blank)' WHEN pr IN ('1-URGENT', '2-HIGH') THEN 'Top'
  WHEN pr IN ('3-MEDIUM') THEN 'Mid' ELSE pr END AS grp, count(*) AS n
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS pr FROM orders) GROUP BY ALL""")
def sort_keys_and_groups(spark, sf):
    pr = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    key = labels.sort_key(F.col("o_orderpriority"), ["5-LOW", "3-MEDIUM", "1-URGENT"])
    group = labels.group_values(pr, {"Top": ["1-URGENT", "2-HIGH"], "Mid": ["3-MEDIUM"]})
    return _orders(spark, sf, "o_orderpriority", "o_orderstatus").groupBy(
        "o_orderpriority", key.alias("sort_no"), group.alias("grp")).agg(F.count(F.lit(1)).alias("n"))


# ---- joins ---------------------------------------------------------------------------------------


def _star(spark, sf, how):
    fact = load(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"])
    dims = [
        (load(spark, sf, "orders", ["o_orderkey", "o_custkey"]), "l_orderkey", "o_orderkey"),
        (load(spark, sf, "customer", ["c_custkey", "c_nationkey"]), "o_custkey", "c_custkey"),
        (load(spark, sf, "nation", ["n_nationkey", "n_regionkey"],
              F.col("n_regionkey").isin(0, 1, 2)), "c_nationkey", "n_nationkey"),
        (load(spark, sf, "part", ["p_partkey", "p_brand"]), "l_partkey", "p_partkey"),
        (load(spark, sf, "supplier", ["s_suppkey", "s_nationkey"]), "l_suppkey", "s_suppkey"),
    ]
    return joins.star_join(fact, dims, how).groupBy("n_regionkey", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), r4(F.sum("l_extendedprice")).alias("price"))


def _star_sql(how):
    return f"""
SELECT n_regionkey, p_brand, count(*) AS n, round(sum(l_extendedprice), 4) AS price FROM lineitem
{how} JOIN orders ON l_orderkey = o_orderkey {how} JOIN customer ON o_custkey = c_custkey
{how} JOIN (SELECT * FROM nation WHERE n_regionkey IN (0, 1, 2)) n ON c_nationkey = n_nationkey
{how} JOIN part ON l_partkey = p_partkey {how} JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""


@query(_star_sql("INNER"))
def star_join_inner(spark, sf):
    return _star(spark, sf, "inner")


@query(_star_sql("LEFT"))
def star_join_left(spark, sf):
    return _star(spark, sf, "left")


@query("""
SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
WHERE c_acctbal > 9000""")
def left_join_turned_inner(spark, sf):
    rich = load(spark, sf, "customer", ["c_custkey", "c_mktsegment"], F.col("c_acctbal") > 9000)
    return joins.star_join(_orders(spark, sf, "o_orderkey", "o_custkey"),
                           [(rich, "o_custkey", "c_custkey")], "inner").select("o_orderkey", "c_mktsegment")


@query("""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '2001-01-01')""")
def anti_rows(spark, sf):
    recent = scans.range_scan(_orders(spark, sf), "o_orderdate", "2001-01-01", "2100-01-01")
    return joins.anti(load(spark, sf, "customer", ["c_custkey"]),
                      recent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_rows(spark, sf):
    good = load(spark, sf, "labels", ["doc_id"], F.col("quality") == 1)
    return joins.semi(load(spark, sf, "documents", ["doc_id", "lang"]), good, "doc_id")


@query("""
SELECT n_nationkey, CAST(d AS DATE) AS month, count(o_orderkey) AS n FROM nation
CROSS JOIN generate_series(DATE '1997-01-01', DATE '1997-06-01', INTERVAL 1 MONTH) t(d)
LEFT JOIN (SELECT o_orderkey, c_nationkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders
  JOIN customer ON o_custkey = c_custkey) o ON c_nationkey = n_nationkey AND m = CAST(d AS DATE)
GROUP BY ALL""")
def dimension_spine(spark, sf):
    spine = joins.dim_spine(load(spark, sf, "nation", ["n_nationkey"]), "1997-01-01", "1997-06-01",
                            "month", "month")
    per = _orders(spark, sf, "o_custkey", "o_orderdate").join(
        load(spark, sf, "customer", ["c_custkey", "c_nationkey"]), F.col("o_custkey") == F.col("c_custkey")
    ).groupBy(F.col("c_nationkey").alias("n_nationkey"), dates.month_start(F.col("o_orderdate")).alias("month")
              ).agg(F.count(F.lit(1)).alias("n"))
    return joins.assemble(spine, [per], ["n_nationkey", "month"], {"n": 0})


@query("""
SELECT e.event_id, (SELECT value FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase'
  AND (p.ts, p.event_id) < (e.ts, e.event_id) ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) AS last_value FROM events e""")
def fill_forward(spark, sf):
    e = load(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value"]).withColumn(
        "bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return windows.fill_forward(e, "user_id", "ts", "bought", "last_value", tie=["event_id"]).select(
        "event_id", "last_value")


@query("""
SELECT e.event_id, m.v AS first_value FROM events e LEFT JOIN (SELECT user_id, first(value ORDER BY ts, event_id) AS v FROM events
  WHERE event_type = 'signup' GROUP BY 1) m USING (user_id)""")
def first_known(spark, sf):
    e = load(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value"]).withColumn(
        "s", F.when(F.col("event_type") == "signup", F.col("value")))
    return windows.first_known(e, "user_id", "ts", "s", "first_value", tie=["event_id"]).select(
        "event_id", "first_value")


@query("""
SELECT session, coalesce(platform, (SELECT first(platform ORDER BY ts, session) FROM texts q WHERE q.account = t.account
   AND q.platform IS NOT NULL AND q.ts >= '2024-01-25'), (SELECT first(platform ORDER BY ts, session) FROM texts q
   WHERE q.account = t.account AND q.platform IS NOT NULL)) AS platform FROM texts t WHERE ts >= '2024-01-25'""")
def backfill_two_stage(spark, sf):
    log = f.texts(spark, sf).select("session", "account", "ts", "platform")
    late = log.where(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    out = windows.backfill_two_stage(late, log, "account", "ts", "platform", "filled", tie=["session"])
    return out.select("session", F.col("filled").alias("platform"))


@query("""
SELECT c.event_id AS click_id, p.event_id AS pay_id FROM events c JOIN events p ON p.user_id = c.user_id
  AND c.event_type = 'click' AND p.event_type = 'purchase'
  AND CAST(p.ts AS DATE) - CAST(c.ts AS DATE) BETWEEN 0 AND 1""")
def interval_pairs(spark, sf):
    e = load(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    side = lambda kind, key, t: e.where(F.col("event_type") == kind).select(
        "user_id", F.col("event_id").alias(key), F.col("ts").alias(t))
    return joins.interval_join(side("click", "click_id", "t1"), side("purchase", "pay_id", "t2"),
                               "user_id", "t1", "t2", 0, 1).select("click_id", "pay_id")


SPAN_SQL = """SELECT call_id, min(start_ms) FILTER (category = 'C9') AS lo,
  max(start_ms) FILTER (category = 'A11') AS hi FROM hits GROUP BY call_id"""


def _spans(spark, sf):
    cat, t = F.col("category"), F.col("start_ms")
    return f.hits(spark, sf).groupBy("call_id").agg(
        F.min(F.when(cat == "C9", t)).alias("lo"), F.max(F.when(cat == "A11", t)).alias("hi"))


@query(f"""
SELECT w.call_id, speaker, count(*) AS n FROM words w JOIN ({SPAN_SQL}) s USING (call_id)
WHERE start_ms BETWEEN lo AND hi GROUP BY ALL""")
def between_offsets(spark, sf):
    out = joins.between_join(f.words(spark, sf), _spans(spark, sf), "call_id", "start_ms", "lo", "hi")
    return out.groupBy("call_id", "speaker").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT w.call_id, count(*) FILTER (start_ms >= lo) AS n_from, count(*) FILTER (start_ms > lo) AS n_after
FROM words w JOIN ({SPAN_SQL}) s USING (call_id) WHERE start_ms >= lo GROUP BY ALL""")
def after_anchor(spark, sf):
    out = joins.after_join(f.words(spark, sf), _spans(spark, sf), "call_id", "start_ms", "lo")
    return out.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_from"),
        F.count_if(F.col("start_ms") > F.col("lo")).alias("n_after"))


@query("""
SELECT pattern, weight, count(*) AS n FROM part JOIN (VALUES ('red%', 1), ('%ring', 2), ('%o%t', 3)) r(pattern, weight)
ON p_name LIKE pattern GROUP BY ALL""")
def pattern_rules(spark, sf):
    rules = spark.createDataFrame([("red%", 1), ("%ring", 2), ("%o%t", 3)], "pattern string, weight int")
    return joins.pattern_join(load(spark, sf, "part", ["p_name"]), rules, "p_name", "pattern").groupBy(
        "pattern", "weight").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT payment_id, min(r.pay_date) AS reversed_on FROM pays p LEFT JOIN revs r ON r.account = p.account
  AND r.crm = p.crm AND abs(r.amount) = abs(p.amount) AND r.pay_date - p.pay_date BETWEEN 0 AND 45
GROUP BY payment_id""")
def reversal_matches(spark, sf):
    out = joins.match_reversals(f.pays(spark, sf), f.revs(spark, sf), ["account", "crm"], "amount",
                                "pay_date", "pay_date", 45)
    return out.select("payment_id", F.col("reversed_on").cast("date").alias("reversed_on"))


@query("""
WITH moves AS (
  SELECT account, crm, floor(abs(amount) / 100) AS a, pay_date AS t, 0 AS kind, CAST(payment_id AS VARCHAR) AS id, payment_id FROM pays
  UNION ALL
  SELECT account, crm, floor(abs(amount) / 100), pay_date + CAST(k % 60 AS INTEGER), 1, CAST(payment_id AS VARCHAR), NULL
  FROM pays WHERE k % 3 = 0),
levels AS (
  SELECT *, kind + sum(1 - 2 * kind) OVER (PARTITION BY account, crm, a ORDER BY t, kind, id ROWS UNBOUNDED PRECEDING) AS level
  FROM moves)
SELECT payment_id, CASE WHEN next_kind = 1 AND next_t - t <= 45 THEN next_id END AS reversal_id FROM (
  SELECT *, lead(kind) OVER w AS next_kind, lead(t) OVER w AS next_t, lead(id) OVER w AS next_id
  FROM levels WINDOW w AS (PARTITION BY account, crm, a, level ORDER BY t, kind, id))
WHERE kind = 0""")
def reversals_once(spark, sf):
    paid = f.pays(spark, sf).withColumn("amount", F.floor(F.abs("amount") / 100))
    back = paid.where(F.col("k") % 3 == 0).withColumn("pay_date", F.date_add("pay_date", F.col("k") % 60))
    out = joins.match_reversals_once(
        paid, back, ["account", "crm"], "amount", "pay_date", "pay_date", 45, "payment_id", "payment_id")
    return out.select("payment_id", "reversal_id")


@query("""
SELECT p.payment_id, round(sum(abs(q.amount)), 4) AS reversed_amount FROM pays p LEFT JOIN pays q
  ON q.account = p.account AND q.k = p.k AND q.payment_id <> p.payment_id AND q.k % 3 = 0
GROUP BY p.payment_id""")
def reference_matches(spark, sf):
    p = f.pays(spark, sf)
    out = joins.match_by_reference(p, p.where(F.col("k") % 3 == 0), "account", "k", "payment_id", "amount")
    return out.select("payment_id", r4("reversed_amount").alias("reversed_amount"))


@query("""
SELECT session, c_mktsegment FROM (SELECT session, 'Med' || account_ref || '  ' AS ref FROM texts)
JOIN customer ON c_custkey = CAST(split_part(replace(trim(ref), 'Med', ''), '-', 1) AS BIGINT)""")
def normalised_key_join(spark, sf):
    rules = ["trim", ("without", "Med"), ("before", "-"), "long"]
    ref = F.concat(F.lit("Med"), F.col("account_ref"), F.lit("  "))
    log = f.texts(spark, sf).select("session", text.norm_key(ref, rules).alias("c_custkey"))
    return log.join(load(spark, sf, "customer", ["c_custkey", "c_mktsegment"]), "c_custkey").select(
        "session", "c_mktsegment")


@query("""
SELECT n_nationkey AS k, coalesce(a.v, b.v) AS v FROM nation
LEFT JOIN (SELECT c_nationkey, round(max(c_acctbal), 4) AS v FROM customer WHERE c_acctbal > 9900 GROUP BY 1) a
  ON a.c_nationkey = n_nationkey
LEFT JOIN (SELECT s_nationkey, round(max(s_acctbal), 4) AS v FROM supplier GROUP BY 1) b ON b.s_nationkey = n_nationkey""")
def dual_source_lookup(spark, sf):
    star = load(spark, sf, "customer", where=F.col("c_acctbal") > 9900).groupBy(
        F.col("c_nationkey").alias("k")).agg(r4(F.max("c_acctbal")).alias("v"))
    legacy = load(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(
        r4(F.max("s_acctbal")).alias("v"))
    base = load(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    return joins.coalesce_join(base, [star, legacy], "k", ["v"])


@query("""
SELECT user_id, event_id FROM events e WHERE event_type = 'click' AND ts = (SELECT min(ts) FROM events q
  WHERE q.user_id = e.user_id AND q.event_type = 'click')""")
def first_event_rows(spark, sf):
    e = load(spark, sf, "events", ["user_id", "event_id", "ts", "event_type"])
    return windows.first_event(e, "user_id", "ts", F.col("event_type") == "click").select("user_id", "event_id")


@query("SELECT s_suppkey, n_name, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def left_expand(spark, sf):
    s = load(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return joins.left_expand(s, load(spark, sf, "nation"), ["n_nationkey"], ["n_name", "n_regionkey"]).select(
        "s_suppkey", "n_name", "n_regionkey")


@query("""
SELECT n_nationkey AS k, coalesce(c, 0) AS customers, coalesce(s, 0) AS suppliers, coalesce(o, 0) AS orders FROM nation
LEFT JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) a ON c_nationkey = n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) b ON s_nationkey = n_nationkey
LEFT JOIN (SELECT c_nationkey AS ck, count(*) AS o FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) d
  ON ck = n_nationkey""")
def assembled_feeds(spark, sf):
    count = lambda df, key, name: df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(name))
    customer = load(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    placed = _orders(spark, sf, "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    feeds = [count(customer, "c_nationkey", "customers"),
             count(load(spark, sf, "supplier", ["s_nationkey"]), "s_nationkey", "suppliers"),
             count(placed, "c_nationkey", "orders")]
    spine = load(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    return joins.assemble(spine, feeds, "k", {"customers": 0, "suppliers": 0, "orders": 0})


@query("""
SELECT event_id, (SELECT max(ts) FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'view' AND v.ts <= e.ts)
  AS view_ts FROM events e WHERE event_type = 'purchase'""")
def asof_matches(spark, sf):
    e = load(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    buys = e.where(F.col("event_type") == "purchase").drop("event_type")
    views = e.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("view_ts"))
    return joins.asof_join(buys, views, "user_id", "ts", "view_ts", []).select("event_id", "view_ts")


# ---- aggregates -----------------------------------------------------------------------------------


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(sum(l_quantity), 4) AS sum_l_quantity,
  round(sum(l_extendedprice), 4) AS sum_l_extendedprice FROM lineitem GROUP BY ALL""")
def group_totals(spark, sf):
    out = agg.group_sum(load(spark, sf, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]),
                        ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    return out.withColumns({c: r4(c) for c in ("sum_l_quantity", "sum_l_extendedprice")})


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_distinct FROM lineitem GROUP BY 1")
def distinct_counts(spark, sf):
    return agg.distinct_by(load(spark, sf, "lineitem", ["l_returnflag", "l_orderkey"]), ["l_returnflag"], "l_orderkey")


@query("""
SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 4) AS closed,
  count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS closed_accounts,
  CAST(max(CASE WHEN o_totalprice > 499000 THEN 1 ELSE 0 END) AS INTEGER) AS has_large FROM orders GROUP BY 1""")
def conditional_aggregates(spark, sf):
    closed = F.col("o_orderstatus") == "F"
    return _orders(spark, sf).groupBy("o_orderpriority").agg(
        r4(agg.sum_where(F.col("o_totalprice"), closed)).alias("closed"),
        agg.distinct_where("o_custkey", closed).alias("closed_accounts"),
        agg.any_flag(F.col("o_totalprice") > 499000).alias("has_large"))


@query("SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY 1")
def first_dates(spark, sf):
    return windows.first_date(_orders(spark, sf, "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate")


@query("""
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL""")
def daily_totals(spark, sf):
    return agg.daily(load(spark, sf, "events", ["event_type", "ts", "value"]), ["event_type"], "ts",
                     {"n": F.count(F.lit(1)), "value": r4(F.sum("value"))})


@query("SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1 HAVING count(*) >= 14")
def having_groups(spark, sf):
    return agg.group_having(_orders(spark, sf, "o_custkey", "o_totalprice"), ["o_custkey"],
                            {"n": F.count(F.lit(1)), "total": r4(F.sum("o_totalprice"))}, F.col("n") >= 14)


@query("""
SELECT p_type, """ + ", ".join(
    f"round(sum(CASE WHEN l_linenumber = {i} THEN l_quantity ELSE 0 END), 4) AS month_{i}" for i in range(1, 6))
    + """, round(sum(CASE WHEN l_linenumber > 5 THEN l_quantity ELSE 0 END), 4) AS over_range
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def slot_pivot(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_linenumber", "l_quantity"]).join(
        load(spark, sf, "part", ["p_partkey", "p_type"]), F.col("l_partkey") == F.col("p_partkey"))
    out = agg.slot_pivot(lines, ["p_type"], "l_linenumber", "l_quantity", 5)
    return out.withColumns({c: r4(c) for c in out.columns if c != "p_type"})


@query("""
SELECT event_id, flag, occurrence FROM (
  SELECT event_id, 'low' AS flag, CAST(k < 50 AS INT) AS occurrence FROM ev
  UNION ALL SELECT event_id, 'odd', CAST(k % 2 AS INT) FROM ev
  UNION ALL SELECT event_id, 'tens', CAST(k % 10 = 0 AS INT) FROM ev) WHERE occurrence > 0""")
def unpivot_flags(spark, sf):
    k = F.col("k")
    e = f.ev(spark, sf).select("event_id", (k < 50).cast("int").alias("low"), (k % 2).alias("odd"),
                               (k % 10 == 0).cast("int").alias("tens"))
    return agg.unpivot_flags(e, ["event_id"], ["low", "odd", "tens"])


@query("""
SELECT l_returnflag, round(sum(l_tax) / nullif(sum(l_discount), 0), 8) AS tax_per_discount,
  CAST(NULL AS DOUBLE) AS undefined FROM lineitem GROUP BY 1""")
def ratios(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_returnflag", "l_tax", "l_discount"]).withColumn("zero", F.lit(0))
    return lines.groupBy("l_returnflag").agg(
        F.round(agg.ratio_of("l_tax", "l_discount"), 8).alias("tax_per_discount"),
        agg.ratio_of("l_tax", "zero").alias("undefined"))


@query("""
SELECT p_type, l_returnflag, round(q, 4) AS q, round(q / sum(q) OVER (PARTITION BY p_type), 8) AS share FROM (
  SELECT p_type, l_returnflag, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""")
def group_shares(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_returnflag", "l_quantity"]).join(
        load(spark, sf, "part", ["p_partkey", "p_type"]), F.col("l_partkey") == F.col("p_partkey"))
    out = agg.share_of(lines.groupBy("p_type", "l_returnflag").agg(F.sum("l_quantity").alias("q")), ["p_type"], "q")
    return out.withColumns({"q": r4("q"), "share": F.round("share", 8)})


@query("""
WITH s AS (SELECT model, score_group, sum(payments) / sum(accounts) AS y FROM volumes GROUP BY ALL),
t AS (SELECT model, sum(payments) / sum(accounts) AS ty FROM volumes GROUP BY ALL)
SELECT model, score_group, round(y, 8) AS seg_yield, round(ty, 8) AS total_yield, round(y / ty, 8) AS yield_idx,
  round((y / ty) / sum(y / ty) OVER (PARTITION BY model), 8) AS predicted_share FROM s JOIN t USING (model)""")
def yield_indexes(spark, sf):
    from dunlin.catalog.reports import _volumes

    out = agg.yield_index(_volumes(spark, sf), ["model"], "score_group", "payments", "accounts")
    return out.withColumns({c: F.round(c, 8) for c in ("seg_yield", "total_yield", "yield_idx", "predicted_share")})


@query("""
SELECT CAST(ts AS DATE) AS day, count(*) AS total_clicks, count(DISTINCT (event_type, user_id)) AS unique_clicks
FROM events GROUP BY 1""")
def total_and_unique(spark, sf):
    e = load(spark, sf, "events", ["ts", "event_type", "user_id"]).withColumn("day", F.to_date("ts"))
    return agg.total_and_unique(e, ["day"], ["event_type", "user_id"])


@query("""
SELECT call_id, count(*) FILTER (phrase LIKE 't%') AS n_t, count(*) FILTER (phrase LIKE 'a%') AS n_a,
  CAST(CASE WHEN count(*) FILTER (phrase LIKE 't%') > 0 THEN 0 WHEN count(*) FILTER (phrase LIKE 'a%') > 0 THEN 0.5
    ELSE 1 END AS DOUBLE) AS score FROM hits WHERE category = 'C9' GROUP BY 1""")
def priority_scores(spark, sf):
    h = f.hits(spark, sf).where(F.col("category") == "C9")
    return agg.priority_score(h, "call_id", "phrase", [("t", 0.0), ("a", 0.5)], 1.0)


@query("SELECT o_custkey, CASE WHEN sum(o_totalprice) >= 2500000 THEN 'Yes' ELSE 'No' END AS is_large FROM orders GROUP BY 1")
def threshold_flags(spark, sf):
    return agg.threshold_flag(_orders(spark, sf, "o_custkey", "o_totalprice"), ["o_custkey"], "o_totalprice", 2500000)


@query("""
SELECT event_type, round(quantile_cont(value, 0.25), 8) AS p25, round(quantile_cont(value, 0.5), 8) AS p50,
  round(quantile_cont(value, 0.75), 8) AS p75 FROM events GROUP BY 1""")
def percentiles_inclusive(spark, sf):
    out = percentiles.percentile_inc(load(spark, sf, "events", ["event_type", "value"]), ["event_type"], "value",
                                     {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return out.withColumns({c: F.round(c, 8) for c in ("p25", "p50", "p75")})


@query("""
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn,
  count(*) OVER (PARTITION BY event_type) AS n FROM events),
p AS (SELECT DISTINCT event_type, n, q, q * (n + 1) AS pos FROM r, (VALUES (0.1::DOUBLE), (0.5), (0.9)) v(q)),
x AS (SELECT p.event_type, q, a.value + (pos - floor(pos)) * (b.value - a.value) AS v FROM p
  JOIN r a ON a.event_type = p.event_type AND a.rn = floor(pos) JOIN r b ON b.event_type = p.event_type AND b.rn = ceil(pos))
SELECT event_type, round(max(v) FILTER (q = 0.1), 8) AS p10, round(max(v) FILTER (q = 0.5), 8) AS p50,
  round(max(v) FILTER (q = 0.9), 8) AS p90 FROM x GROUP BY 1""")
def percentiles_exclusive(spark, sf):
    out = percentiles.percentile_exc(load(spark, sf, "events", ["event_type", "value"]), ["event_type"], "value",
                                     {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return out.withColumns({c: F.round(c, 8) for c in ("p10", "p50", "p90")})


@query("""
WITH t AS (SELECT p_brand, p_type, avg(p_retailprice) AS v FROM part GROUP BY ALL),
q AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c FROM t)
SELECT p_brand, p_type, round(v, 9) AS v, CASE WHEN v <= a THEN 1 WHEN v <= b THEN 2 WHEN v <= c THEN 3 ELSE 4 END AS band
FROM t, q""")
def quartile_bands(spark, sf):
    t = load(spark, sf, "part", ["p_brand", "p_type", "p_retailprice"]).groupBy("p_brand", "p_type").agg(
        F.avg("p_retailprice").alias("v"))
    return percentiles.quartile_band(t, "v", "band").withColumn("v", F.round("v", 9))


@query("""
WITH d AS (SELECT DISTINCT p_type, p_brand FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_brand) AS rn, count(*) OVER (PARTITION BY p_type) AS n FROM d)
SELECT p_type, string_agg(p_brand, ', ' ORDER BY p_brand) || CASE WHEN max(n) > 5 THEN ', etc.' ELSE '' END AS brands
FROM r WHERE rn <= 5 GROUP BY 1""")
def value_lists(spark, sf):
    return agg.value_lists(load(spark, sf, "part", ["p_type", "p_brand"]), ["p_type"], "p_brand", "brands")


@query("""
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) FILTER (rn <= 3) ||
  CASE WHEN count(*) > 3 THEN ', etc.' ELSE '' END AS names,
  CASE WHEN count(DISTINCT n_regionkey) = 1 THEN CAST(min(n_regionkey) AS VARCHAR) ELSE 'many' END AS one,
  CASE WHEN count(DISTINCT n_name) = 1 THEN min(n_name) ELSE 'many' END AS other
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS rn FROM nation) GROUP BY 1""")
def value_list_and_single(spark, sf):
    n = load(spark, sf, "nation").withColumn("key_text", F.col("n_regionkey").cast("string"))
    return n.groupBy("n_regionkey").agg(
        agg.value_list("n_name", 3).alias("names"), agg.single_or("key_text", "many").alias("one"),
        agg.single_or("n_name", "many").alias("other"))


@query("""
SELECT o_orderstatus, strftime(min(o_orderdate), '%b-%y') || ' - ' || strftime(max(o_orderdate), '%b-%y') AS span,
  'Monthly ' || strftime(min(o_orderdate), '%Y-%m-%d') || ' - ' || strftime(max(o_orderdate), '%Y-%m-%d') AS title
FROM orders GROUP BY 1""")
def range_labels(spark, sf):
    return _orders(spark, sf, "o_orderstatus", "o_orderdate").groupBy("o_orderstatus").agg(
        agg.range_label("o_orderdate", "MMM-yy").alias("span"),
        agg.range_label("o_orderdate", "yyyy-MM-dd", "Monthly ").alias("title"))


# ---- windows and ranking ----------------------------------------------------------------------------


@query("""
SELECT user_id, first(event_id ORDER BY ts, event_id) AS first_id, last(event_id ORDER BY ts, event_id) AS last_id
FROM events GROUP BY 1""")
def first_and_last_rows(spark, sf):
    e = load(spark, sf, "events", ["user_id", "event_id", "ts"])
    first = windows.first_per(e, "user_id", ["ts", "event_id"], ["event_id"])
    last = windows.last_per(e, "user_id", ["ts", "event_id"], ["event_id"])
    return first.withColumnRenamed("event_id", "first_id").join(
        last.withColumnRenamed("event_id", "last_id"), "user_id")


@query("""
SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
  CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END, ts, event_id) = 1""")
def first_by_severity(spark, sf):
    kind = F.col("event_type")
    e = load(spark, sf, "events", ["user_id", "event_id", "ts", "event_type"]).withColumn(
        "sev", F.when(kind == "error", 1).when(kind == "purchase", 2).otherwise(3))
    return windows.first_per(e, "user_id", ["sev", "ts", "event_id"], ["event_id"])


@query("""
SELECT event_id, rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS rank_no,
  row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS row_no FROM events""")
def attempt_numbers(spark, sf):
    e = load(spark, sf, "events", ["user_id", "event_id", "ts"]).withColumn("day", F.to_date("ts"))
    return windows.attempt_no(e, "user_id", "day", tie=["event_id"]).select("event_id", *_big("rank_no", "row_no"))


@query("""
SELECT event_id, lag(event_type, 1, 'none') OVER w AS prev_type, lag(event_id, 1) OVER w AS event_id_1,
  lag(event_id, 2) OVER w AS event_id_2, lag(event_id, 3) OVER w AS event_id_3, lead(event_id) OVER w AS next_id,
  date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS gap
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def neighbour_rows(spark, sf):
    e = load(spark, sf, "events", ["user_id", "event_id", "ts", "event_type"])
    outs = {"prev_type": ("event_type", 1, "none"), "prev_ts": ("ts", 1), "next_id": ("event_id", -1),
            **{f"event_id_{i}": ("event_id", i) for i in (1, 2, 3)}}
    out = windows.neighbours(e, "user_id", "ts", outs, tie=["event_id"])
    gap = dates.day_diff(F.col("prev_ts"), F.col("ts")).cast("bigint")
    return out.withColumn("gap", gap).select(
        "event_id", "prev_type", "event_id_1", "event_id_2", "event_id_3", "next_id", "gap")


@query("""
SELECT event_id, date_diff('day', CAST(lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS DATE),
  CAST(ts AS DATE)) AS days_since_prev FROM events""")
def days_since_previous(spark, sf):
    e = load(spark, sf, "events", ["user_id", "event_id", "ts", "event_type"])
    return windows.days_since_prev(e, ["user_id", "event_type"], "ts", tie=["event_id"]).select(
        "event_id", *_big("days_since_prev"))


@query("""
SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), 4) AS running FROM orders""")
def running_sums(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return windows.running_sum(o, "o_custkey", "o_orderdate", "o_totalprice", "running").select(
        "o_orderkey", r4("running").alias("running"))


@query("SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS decile FROM orders")
def score_deciles(spark, sf):
    return percentiles.deciles(_orders(spark, sf, "o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey",
                               "decile", desc=True).select("o_orderkey", "decile")


@query("""
SELECT month, CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS slot FROM (
  SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders WHERE o_orderdate >= '2000-06-14')
QUALIFY row_number() OVER (ORDER BY month) <= 13""")
def month_slots(spark, sf):
    o = scans.range_scan(_orders(spark, sf, "o_orderdate"), "o_orderdate", "2000-06-14", "2100-01-01")
    return windows.month_slots(o.select(dates.month_start(F.col("o_orderdate")).alias("month")), "month", 13)


@query("""
SELECT p_brand, total, dense_rank() OVER (ORDER BY total DESC) AS rnk FROM (
  SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1)""")
def rank_totals(spark, sf):
    out = ranking.rank_total(load(spark, sf, "part", ["p_brand", "p_size"]), "p_brand", F.sum("p_size"))
    return out.select("p_brand", "total", *_big("rnk"))


def _top_sql(order, n):
    return f"""
WITH t AS (SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1),
r AS (SELECT *, dense_rank() OVER (ORDER BY total {order}) AS rnk FROM t)
SELECT CASE WHEN rnk <= {n} THEN p_brand ELSE 'Other' END AS p_brand, CAST(sum(total) AS BIGINT) AS total
FROM r GROUP BY 1"""


@query(_top_sql("DESC", 10))
def top_n_others(spark, sf):
    return ranking.top_n(load(spark, sf, "part", ["p_brand", "p_size"]), "p_brand", F.sum("p_size"), 10)


@query(_top_sql("ASC", 5).replace("FROM r GROUP", "FROM r WHERE rnk <= 5 GROUP"))
def bottom_n(spark, sf):
    return ranking.top_n(load(spark, sf, "part", ["p_brand", "p_size"]), "p_brand", F.sum("p_size"), 5,
                         desc=False, other=None)


# ---- set operations -----------------------------------------------------------------------------------


@query("""
SELECT c_nationkey AS nation, c_mktsegment AS tag FROM customer UNION
SELECT s_nationkey, CASE WHEN s_acctbal > 0 THEN 'BUILDING' ELSE 'OTHER' END FROM supplier""")
def union_distinct(spark, sf):
    a = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("tag"))
    b = load(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") > 0, "BUILDING").otherwise("OTHER").alias("tag"),
        F.col("s_nationkey").alias("nation"))
    return sets.union_distinct(a, b)


@query("SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def union_all(spark, sf):
    return sets.union_all(
        load(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")))


@query("""
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS key, p_name AS col_1, CAST(p_size AS VARCHAR) AS col_2 FROM part
UNION SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""")
def union_as_text(spark, sf):
    return sets.union_as_text(
        [load(spark, sf, "part"), load(spark, sf, "supplier")],
        [["p_partkey", "p_name", "p_size"], ["s_suppkey", "s_name", "s_nationkey"]], ["key", "col_1", "col_2"])
