"""Semantic-model measures over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog import frames as f
from dunlin.catalog.base import cte, query
from dunlin.catalog.frames import r4
from dunlin.catalog.reports import _attribution, _scored_phones, phone_score_performance
from dunlin.operators import measures as m
from dunlin.operators import ranking
from dunlin.operators.aggregates import range_label, single_or, value_lists
from dunlin.operators.joins import asof_join
from dunlin.sources.scans import load


def _round(df, keys=()):
    return df.withColumns({c: F.round(c, 8) for c in df.columns if c not in keys})


COUNTERS = ["calls", "unq_calls", "rpc_calls", "unq_rpc_calls", "letters", "unq_letters", "unq_payers",
            "calls_ob", "calls_ib", "unq_rpc_calls_ib", "unq_rpc_calls_ob", "sms_sent", "unq_sms_sent",
            "emails_sent", "unq_emails_sent"]
cte("inventory", "SELECT p_brand AS client, p_type AS stream, date_trunc('month', l_shipdate)::DATE AS rpt_month, "
    "l_quantity AS accounts, l_extendedprice AS balances, l_extendedprice * l_discount AS payments, "
    + ", ".join(f"(l_orderkey + {i} * l_linenumber) % {i + 2} AS {c}" for i, c in enumerate(COUNTERS))
    + " FROM lineitem JOIN part ON l_partkey = p_partkey")


def _inventory(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
                                         "l_orderkey", "l_linenumber"])
    return lines.join(load(spark, sf, "part", ["p_partkey", "p_brand", "p_type"]),
                      F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("client"), F.col("p_type").alias("stream"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("rpt_month"), F.col("l_quantity").alias("accounts"),
        F.col("l_extendedprice").alias("balances"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("payments"),
        *[((F.col("l_orderkey") + i * F.col("l_linenumber")) % (i + 2)).alias(c) for i, c in enumerate(COUNTERS)])


# The SQL of the measures is written out and shares no table with the Spark side.
INVENTORY_SQL = """
  round(bal / acc, 8) AS avg_balance, round(calls / acc, 8) AS call_penetration,
  round(unq_calls / acc, 8) AS unq_call_penetration, round(rpc_calls / acc, 8) AS rpc_call_penetration,
  round(unq_rpc_calls / acc, 8) AS unq_rpc_call_penetration, round(letters / acc, 8) AS letter_penetration,
  round(unq_letters / acc, 8) AS unq_letter_penetration, round(unq_payers / acc, 8) AS account_conversion,
  round(pay / nullif(calls, 0), 8) AS payments_per_call, round(pay / nullif(bal, 0), 8) AS liquidation,
  round(pay / acc, 8) AS gross_unit_yield, round(calls_ob / acc, 8) AS call_penetration_ob,
  round(calls_ib / acc, 8) AS call_penetration_ib, round(unq_rpc_calls_ib / acc, 8) AS unq_rpc_call_penetration_ib,
  round(unq_rpc_calls_ob / acc, 8) AS unq_rpc_call_penetration_ob, round(sms / acc, 8) AS sms_penetration,
  round(unq_sms / acc, 8) AS unq_sms_penetration, round(emails / acc, 8) AS email_penetration,
  round(unq_emails / acc, 8) AS unq_email_penetration,
  round((calls + sms + emails + letters) / acc, 8) AS channel_penetration"""
INVENTORY_SUMS = """sum(balances)::DOUBLE AS bal, nullif(sum(accounts), 0)::DOUBLE AS acc, sum(payments)::DOUBLE AS pay,
  sum(calls) AS calls, sum(unq_calls) AS unq_calls, sum(rpc_calls) AS rpc_calls, sum(unq_rpc_calls) AS unq_rpc_calls,
  sum(letters) AS letters, sum(unq_letters) AS unq_letters, sum(unq_payers) AS unq_payers, sum(calls_ob) AS calls_ob,
  sum(calls_ib) AS calls_ib, sum(unq_rpc_calls_ib) AS unq_rpc_calls_ib, sum(unq_rpc_calls_ob) AS unq_rpc_calls_ob,
  sum(sms_sent) AS sms, sum(unq_sms_sent) AS unq_sms, sum(emails_sent) AS emails, sum(unq_emails_sent) AS unq_emails"""


@query(f"SELECT client, {INVENTORY_SQL} FROM (SELECT client, {INVENTORY_SUMS} FROM inventory GROUP BY 1)")
def inventory_measures(spark, sf):
    df = _inventory(spark, sf)
    return _round(m.by_dimension(df, "client", m.registry(m.INVENTORY, df.columns), ["client", "stream"]), ["client"])


@query(f"""SELECT {INVENTORY_SQL}, CAST(calls + sms + emails + letters AS BIGINT) AS total_attempts
FROM (SELECT {INVENTORY_SUMS} FROM inventory WHERE rpt_month >= '1999-01-01' AND stream = 'ECONOMY')""")
def inventory_measures_filtered(spark, sf):
    df = _inventory(spark, sf).where(
        (F.col("rpt_month") >= F.lit("1999-01-01").cast("date")) & (F.col("stream") == "ECONOMY"))
    every = {**m.registry(m.INVENTORY), **m.channel_totals(["calls", "sms_sent", "emails_sent", "letters"])}
    return _round(m.by_dimension(df, None, every), ["total_attempts"])


@query("""
SELECT rpt_month, client, round(pay, 4) AS payments, rnk FROM (
  SELECT client, dense_rank() OVER (ORDER BY round(sum(payments), 4) DESC) AS rnk FROM inventory GROUP BY 1)
JOIN (SELECT rpt_month, client, sum(payments) AS pay FROM inventory GROUP BY ALL) USING (client)
WHERE rnk <= 10 AND rpt_month >= '2001-01-01'""")
def top_clients_by_month(spark, sf):
    """Clients ranked over all rows (before the month filter), shown for the filtered months."""
    df = _inventory(spark, sf)
    ranks = ranking.rank_total(df, "client", F.round(F.sum("payments"), 4)).where(F.col("rnk") <= 10)
    shown = df.where(F.col("rpt_month") >= F.lit("2001-01-01").cast("date")).groupBy("rpt_month", "client").agg(
        r4(F.sum("payments")).alias("payments"))
    return shown.join(ranks.select("client", F.col("rnk").cast("bigint").alias("rnk")), "client").select(
        "rpt_month", "client", "payments", "rnk")


def _message_sql(dim):
    return f"""
SELECT {dim}, round(bounced / sent, 8) AS bounce_rate, round(delivered / sent, 8) AS delivered_rate,
  round(opened / nullif(delivered, 0), 8) AS open_rate, round(optouts / nullif(delivered, 0), 8) AS optout_rate,
  round(spam / nullif(delivered, 0), 8) AS spam_rate, round(clicks / nullif(delivered, 0), 8) AS click_rate,
  round(payers / nullif(delivered, 0), 8) AS pay_rate, round(paid / nullif(delivered, 0), 8) AS paid_per_delivered,
  round(scrubbed / nullif(requested, 0), 8) AS scrub_rate, round(opens / nullif(delivered, 0), 8) AS overall_open_rate,
  round(clicks / nullif(opened, 0), 8) AS clicks_to_opens
FROM (SELECT {dim}, sum(bounced)::DOUBLE AS bounced, nullif(sum(sent), 0)::DOUBLE AS sent, sum(delivered)::DOUBLE AS delivered,
    sum(unq_opens)::DOUBLE AS opened, sum(optouts)::DOUBLE AS optouts, sum(marked_as_spam)::DOUBLE AS spam,
    sum(clicks)::DOUBLE AS clicks, count(*) FILTER (has_pay)::DOUBLE AS payers, sum(payments)::DOUBLE AS paid,
    sum(invalid_scrubbed + optout_scrubbed + whitelist_scrubbed)::DOUBLE AS scrubbed,
    sum(requested)::DOUBLE AS requested, sum(total_opens)::DOUBLE AS opens FROM attributed GROUP BY 1)"""


@query(_message_sql("letter"))
def message_rates_by_letter(spark, sf):
    return _rates(spark, sf, "letter")


@query(_message_sql("email_domain"))
def message_rates_by_domain(spark, sf):
    return _rates(spark, sf, "email_domain")


def _rates(spark, sf, dim):
    df = _attribution(spark, sf)
    allowed = ["client", "crm", "letter", "email_domain", "send_domain"]
    return _round(m.by_dimension(df, dim, m.registry(m.MESSAGE, df.columns), allowed), [dim])


@query("""
WITH cohort AS (SELECT client, crm, count(DISTINCT account) FILTER (requested > 0) AS req,
    count(DISTINCT account) FILTER (whitelist_scrubbed > 0) AS white, count(DISTINCT account) FILTER (optout_scrubbed > 0) AS outs,
    count(DISTINCT account) FILTER (invalid_scrubbed > 0) AS inv, count(DISTINCT account) FILTER (sent > 0) AS snt,
    count(DISTINCT account) FILTER (bounced > 0) AS bou, count(DISTINCT account) FILTER (delivered > 0) AS del,
    count(DISTINCT account) FILTER (unq_opens > 0) AS ope, count(DISTINCT account) FILTER (optouts > 0) AS opt,
    count(DISTINCT account) FILTER (marked_as_spam > 0) AS spa, count(DISTINCT account) FILTER (clicks > 0) AS cli,
    count(DISTINCT account) FILTER (has_pay) AS pay, sum(payments) AS paid FROM attributed GROUP BY ALL)
SELECT client, round((sum(inv) + sum(outs) + sum(white)) / nullif(sum(req), 0)::DOUBLE, 8) AS unq_scrub_rate,
  round(sum(bou) / nullif(sum(snt), 0)::DOUBLE, 8) AS unq_bounce_rate,
  round(sum(del) / nullif(sum(snt), 0)::DOUBLE, 8) AS unq_delivered_rate,
  round(sum(ope) / nullif(sum(del), 0)::DOUBLE, 8) AS unq_open_rate,
  round(sum(opt) / nullif(sum(del), 0)::DOUBLE, 8) AS unq_optout_rate,
  round(sum(spa) / nullif(sum(del), 0)::DOUBLE, 8) AS unq_spam_rate,
  round(sum(cli) / nullif(sum(del), 0)::DOUBLE, 8) AS unq_click_rate,
  round(sum(pay) / nullif(sum(del), 0)::DOUBLE, 8) AS unq_pay_rate,
  round(sum(paid)::DOUBLE / nullif(sum(del), 0)::DOUBLE, 8) AS unq_paid_per_delivered
FROM cohort GROUP BY 1""")
def cohort_rates(spark, sf):
    from dunlin.plans.messages import first_month_funnel

    funnel = first_month_funnel(_attribution(spark, sf))
    return _round(m.by_dimension(funnel, "client", m.registry(m.COHORT, funnel.columns)), ["client"])


@query("""
SELECT letter, round(clicks / delivered, 8) AS pct_with_click, round(website / delivered, 8) AS pct_clicked_website,
  round(privacy / delivered, 8) AS pct_clicked_privacy, round(regulator / delivered, 8) AS pct_clicked_regulator
FROM (SELECT letter, nullif(sum(CASE WHEN code = 10 THEN n_events ELSE 0 END), 0)::DOUBLE AS delivered,
    count(*) FILTER (code = 12) AS clicks, count(*) FILTER (code = 12 AND guid % 3 = 0) AS website,
    count(*) FILTER (code = 12 AND guid % 3 = 1) AS privacy, count(*) FILTER (code = 12 AND guid % 3 = 2) AS regulator
  FROM msgs GROUP BY 1)""")
def click_target_rates(spark, sf):
    code, guid = F.col("code"), F.col("guid")
    hit = lambda n: ((code == 12) & (guid % 3 == n)).cast("int")
    clicks = f.msgs(spark, sf).select(
        "letter", ((code == 10).cast("int") * F.col("n_events")).alias("delivered"),
        (code == 12).cast("int").alias("clicks"), hit(0).alias("clicks_website"), hit(1).alias("clicks_privacy"),
        hit(2).alias("clicks_regulator"))
    return _round(m.by_dimension(clicks, "letter", m.registry(m.CLICK_TARGET)), ["letter"])


cte("perf", """
SELECT site, CASE WHEN CAST(substring(consumer, 8, 2) AS INTEGER) > 89 THEN 'Control' ELSE score END AS score,
  account, phone, ts, is_contact, is_wrong FROM scored_phones JOIN attempts USING (account, phone)
WHERE ts >= '2024-01-12' AND ts < '2024-01-19'
""")


@query("""
WITH x AS (SELECT *, min(CASE WHEN is_contact = 1 THEN ts END) OVER w AS fc, min(CASE WHEN is_wrong = 1 THEN ts END) OVER w AS fw,
  FROM perf WINDOW w AS (PARTITION BY account, phone)),
s AS (SELECT p.site, p.score, b.balance_range, b.segment, count(*) AS attempts, count(DISTINCT p.phone) AS phones,
   sum(is_contact) AS contacts, sum(is_wrong) AS wrong, count(*) FILTER (ts = fc) AS unq_contacts,
   count(*) FILTER (ts = fw) AS unq_wrong
  FROM x p JOIN (SELECT c_custkey, CASE WHEN c_acctbal <= 2500 THEN 1 WHEN c_acctbal >= 5000 THEN 3 ELSE 2 END AS balance_range,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'L' WHEN c_acctbal < 0 THEN 'R' ELSE 'S' END AS segment FROM customer) b
  ON c_custkey = account GROUP BY ALL)
SELECT score, round(sum(attempts) / nullif(sum(phones), 0)::DOUBLE, 8) AS intensity,
  round(sum(unq_contacts) / nullif(sum(phones), 0)::DOUBLE, 8) AS contact_pct_per_phone,
  round(sum(unq_wrong) / nullif(sum(phones), 0)::DOUBLE, 8) AS wrong_pct_per_phone,
  round(sum(contacts) / nullif(sum(attempts), 0)::DOUBLE, 8) AS contact_pct_per_attempt,
  round(sum(wrong) / nullif(sum(attempts), 0)::DOUBLE, 8) AS wrong_pct_per_attempt
FROM s GROUP BY 1""")
def contact_rates(spark, sf):
    perf = phone_score_performance(spark, sf)
    return _round(m.by_dimension(perf, "score", m.registry(m.CONTACT)), ["score"])


CURVE_KINDS = ["click", "error", "purchase", "view"]


def _curve_kind(kind):
    bands = ("BETWEEN 0 AND 5 0to5", "BETWEEN 6 AND 10 6to10", "BETWEEN 11 AND 15 11to15", "BETWEEN 16 AND 20 16to20",
             "BETWEEN 21 AND 25 21to25", "BETWEEN 26 AND 30 26to30", "> 30 30plus")
    parts = [f"count(*) FILTER (event_type = '{kind}') AS total_{kind}"]
    for test, name in (band.rsplit(" ", 1) for band in bands):
        n = f"count(*) FILTER (event_type = '{kind}' AND delay {test})"
        parts += [f"{n} AS {kind}_{name}",
                  f"round({n} / nullif(count(*) FILTER (event_type = '{kind}'), 0)::DOUBLE, 8) AS {kind}_{name}_share"]
    return ", ".join(parts)


def _curve_sql():
    return f"""
WITH d AS (SELECT 'C' || (user_id % 4) AS client, event_type, day - (SELECT max(CAST(s.ts AS DATE)) FROM events s
    WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts <= e.ts) AS delay
  FROM ev e WHERE event_type <> 'signup')
SELECT client, {', '.join(_curve_kind(k) for k in CURVE_KINDS)} FROM d WHERE delay IS NOT NULL GROUP BY 1"""


@query(_curve_sql())
def response_curve(spark, sf):
    """Days from a user's latest signup to each response, in the delay bands."""
    e = f.ev(spark, sf)
    sent = e.where(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("sent_at"))
    answers = e.where(F.col("event_type").isin(*CURVE_KINDS)).select("user_id", "ts", "day", "event_type")
    timed = asof_join(answers, sent, "user_id", "ts", "sent_at", []).select(
        F.concat(F.lit("C"), (F.col("user_id") % 4).cast("string")).alias("client"), "event_type",
        F.datediff("day", F.col("sent_at").cast("date")).alias("delay"))
    out = m.response_curve(timed, ["client"], "event_type", "delay", CURVE_KINDS)
    return out.withColumns({c: F.round(c, 8) for c in out.columns if c.endswith("_share")})


def _ranked_sql(dim, order, n):
    return f"""
WITH r AS (SELECT {dim}, sum(sent) AS total, dense_rank() OVER (ORDER BY sum(sent) {order}) AS rnk FROM attributed GROUP BY 1)
SELECT CASE WHEN rnk <= {n} THEN {dim} ELSE 'Other' END AS {dim}, CAST(sum(total) AS BIGINT) AS total FROM r GROUP BY 1"""


@query(_ranked_sql("email_domain", "DESC", 3))
def top_domains(spark, sf):
    return ranking.top_n(_attribution(spark, sf), "email_domain", F.sum("sent"), 3)


@query(_ranked_sql("letter", "ASC", 1))
def bottom_letters(spark, sf):
    return ranking.top_n(_attribution(spark, sf), "letter", F.sum("sent"), 1, desc=False)


@query("""
SELECT client, strftime(min(send_date), '%b-%y') || ' - ' || strftime(max(send_date), '%b-%y') AS span,
  CASE WHEN count(DISTINCT crm) = 1 THEN CAST(min(crm) AS VARCHAR) ELSE 'All' END AS crm,
  string_agg(DISTINCT email_domain, ', ' ORDER BY email_domain) AS domains FROM attributed GROUP BY 1""")
def message_labels(spark, sf):
    report = _attribution(spark, sf).withColumn("crm_text", F.col("crm").cast("string"))
    base = report.groupBy("client").agg(range_label("send_date", "MMM-yy").alias("span"),
                                        single_or("crm_text", "All").alias("crm"))
    return base.join(value_lists(report, ["client"], "email_domain", "domains"), "client")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%b-%y') AS month_label, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_sort,
  date_trunc('month', o_orderdate)::DATE AS month_start, strftime(o_orderdate, '%a') AS day_of_week,
  CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week_no, CAST(round(o_custkey * 0.55, 4) AS DOUBLE) AS savings FROM orders""")
def calculated_columns(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_custkey"])
    out = m.message_calculated_columns(o, "o_orderdate", "o_custkey", 0.55)
    return out.withColumn("savings", r4("savings")).drop("o_orderdate", "o_custkey")


@query("SELECT activity, count(DISTINCT score) AS n_scores, count(*) AS phones FROM "
       "(SELECT nullif(ltrim(activity), '') AS activity, score FROM scored_phones) GROUP BY 1")
def phones_by_activity(spark, sf):
    phones = _scored_phones(spark, sf).withColumn("activity", F.nullif(F.ltrim("activity"), F.lit("")))
    every = {"n_scores": F.count_distinct("score"), "phones": F.count(F.lit(1))}
    return m.by_dimension(phones, "activity", every, ["activity", "site", "score"])


@query("""
WITH p AS (SELECT site, score, phone, account, ts, min(CASE WHEN is_contact = 1 THEN ts END)
  OVER (PARTITION BY account, phone) AS fc, min(CASE WHEN is_wrong = 1 THEN ts END)
  OVER (PARTITION BY account, phone) AS fw FROM perf),
c AS (SELECT p.*, CASE WHEN c_acctbal <= 2500 THEN 1 WHEN c_acctbal >= 5000 THEN 3 ELSE 2 END AS br,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'L' WHEN c_acctbal < 0 THEN 'R' ELSE 'S' END AS sg
  FROM p JOIN customer ON c_custkey = account),
s AS (SELECT site, score, br, sg, count(DISTINCT phone) AS phones, count(*) FILTER (ts = fc) AS uc,
  count(*) FILTER (ts = fw) AS uw FROM c GROUP BY ALL),
e AS (SELECT kind, v, row_number() OVER (PARTITION BY kind ORDER BY v) AS rn, 0.5 * (count(*) OVER (PARTITION BY kind) + 1) AS pos
  FROM (SELECT 'contact' AS kind, uc / nullif(phones, 0)::DOUBLE AS v FROM s
        UNION ALL SELECT 'wrong', uw / nullif(phones, 0)::DOUBLE FROM s) WHERE v IS NOT NULL),
z AS (SELECT kind, max(v) FILTER (rn = floor(pos)) AS lo, max(v) FILTER (rn = ceil(pos)) AS hi, any_value(pos - floor(pos)) AS w
  FROM e GROUP BY 1),
rows AS (SELECT max(lo + w * (hi - lo)) FILTER (kind = 'contact') AS rc, max(lo + w * (hi - lo)) FILTER (kind = 'wrong') AS rw,
  (SELECT quantile_cont(v, 0.75) FROM e WHERE kind = 'contact') AS r75 FROM z),
t AS (SELECT site, score, sum(uc) / nullif(sum(phones), 0)::DOUBLE AS rate FROM s GROUP BY ALL),
q AS (SELECT quantile_cont(rate, 0.25) AS a, quantile_cont(rate, 0.5) AS b, quantile_cont(rate, 0.75) AS d, count(rate) AS n FROM t),
o AS (SELECT rate, row_number() OVER (ORDER BY rate) AS rn FROM t),
m AS (SELECT x.rate + (0.5 * (n + 1) - floor(0.5 * (n + 1))) * (y.rate - x.rate) AS me FROM q
  JOIN o x ON x.rn = floor(0.5 * (n + 1)) JOIN o y ON y.rn = ceil(0.5 * (n + 1)))
SELECT site, score, round(rate, 8) AS rate, CASE WHEN rate <= a THEN 1 WHEN rate <= b THEN 2 WHEN rate <= d THEN 3 ELSE 4 END
  AS quartile, round(me, 8) AS median_exc, round(b, 8) AS median_inc, round(d, 8) AS p75_inc,
  round(rc, 8) AS row_median_exc, round(rw, 8) AS row_wrong_median_exc, round(r75, 8) AS row_p75_inc FROM t, q, m, rows""")
def contact_percentiles(spark, sf):
    return _round(m.contact_percentiles(phone_score_performance(spark, sf), ["site", "score"]), ["site", "score", "quartile"])
