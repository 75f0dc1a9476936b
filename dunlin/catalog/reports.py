"""The reports over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog import frames as f
from dunlin.catalog.base import cte, query
from dunlin.catalog.frames import r4
from dunlin.functions.dates import month_start
from dunlin.functions.labels import classify, control_split
from dunlin.functions.text import strip_suffix
from dunlin.operators.windows import last_per
from dunlin.plans import compliance, messages, payments, scorecard, speech
from dunlin.sources.checkpoints import new_folder
from dunlin.sources.scans import load, lookup
from dunlin.sources.sinks import append_new, export_csv, read_table, write_window

# ---- exceptions ----------------------------------------------------------------------------


@query("""
SELECT user_id, event_id, ts, days_1, days_2, days_3 FROM (
  SELECT *, date_diff('day', CAST(lag(ts, 1) OVER w AS DATE), CAST(ts AS DATE)) AS days_1,
    date_diff('day', CAST(lag(ts, 2) OVER w AS DATE), CAST(ts AS DATE)) AS days_2,
    date_diff('day', CAST(lag(ts, 3) OVER w AS DATE), CAST(ts AS DATE)) AS days_3
  FROM events WHERE event_type = 'error'
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE days_1 < 2 AND days_2 < 2 AND days_3 < 2
""")
def contact_frequency_exceptions(spark, sf):
    contacts = load(spark, sf, "events", ["user_id", "event_id", "ts"],
                    F.col("event_type") == "error")
    return compliance.contact_frequency_exceptions(
        contacts, "user_id", "ts", "event_id", k=3, days=2
    ).select("user_id", "event_id", "ts",
             *[F.col(f"days_{i}").cast("bigint").alias(f"days_{i}") for i in (1, 2, 3)])


@query("""
SELECT user_id, event_id, ts FROM (SELECT *, date_diff('day', CAST(lag(ts, 3) OVER (PARTITION BY user_id
    ORDER BY ts, event_id) AS DATE), CAST(ts AS DATE)) AS d FROM events WHERE event_type = 'error')
WHERE d < 2
""")
def contact_exceptions_incremental(spark, sf):
    """Two overlapping scan windows; the second run stores only new exceptions."""
    path = new_folder(spark, "exceptions")
    errors = load(spark, sf, "events", ["user_id", "event_id", "ts"], F.col("event_type") == "error")
    for as_of in ("2024-01-20", "2024-02-10"):
        known = errors.where(F.col("ts") < F.lit(as_of).cast("timestamp_ntz"))
        found = compliance.contact_frequency_exceptions(
            known, "user_id", "ts", "event_id", k=3, days=2, as_of=as_of)
        append_new(found.select("user_id", "event_id", "ts"), path, ["event_id"])
    return read_table(spark, path)


THRESHOLDS = [("Service 0", 4, 2, True), ("Service 1%", 6, 3, True), ("%2", 5, 1, True),
              ("Service 3", 1, 1, False)]


@query("""
SELECT account, phone, session, service_name, pattern, attempt, gap_days,
  CAST(gap_days > interval_days AS INTEGER) AS interval_exception,
  CAST(attempt > attempt_limit AS INTEGER) AS attempt_exception,
  CAST(attempt = attempt_limit AS INTEGER) AS limit_reached
FROM (SELECT *, row_number() OVER (PARTITION BY account, phone ORDER BY ts, session) AS attempt,
        date_diff('day', CAST(lag(ts) OVER (PARTITION BY account ORDER BY phone, ts, session) AS DATE),
                  day) AS gap_days
      FROM texts WHERE result IN ('Delivered', 'Failed')) m
JOIN (VALUES ('Service 0', 4, 2), ('Service 1%', 6, 3), ('%2', 5, 1))
  r(pattern, attempt_limit, interval_days) ON service_name LIKE pattern
WHERE gap_days IS NOT NULL AND (gap_days > interval_days OR attempt >= attempt_limit)
  AND ts >= TIMESTAMP '2024-01-05'
""")
def message_threshold_exceptions(spark, sf):
    sent = f.texts(spark, sf).where(F.col("result").isin("Delivered", "Failed"))
    rules = lookup(spark, THRESHOLDS,
                   "pattern string, attempt_limit int, interval_days int, is_active boolean")
    return compliance.message_threshold_exceptions(
        sent, rules, "account", "phone", "ts", "service_name", since="2024-01-05", tie=["session"]
    ).select("account", "phone", "session", "service_name", "pattern",
             F.col("attempt").cast("bigint").alias("attempt"),
             F.col("gap_days").cast("bigint").alias("gap_days"),
             "interval_exception", "attempt_exception", "limit_reached")


@query("""
WITH err AS (SELECT user_id AS customer, 'S' || (k % 5) AS status, ts, event_id, k
             FROM ev WHERE event_type = 'error'),
cur AS (SELECT customer, status, ts FROM err
        QUALIFY row_number() OVER (PARTITION BY customer ORDER BY ts DESC, event_id DESC) = 1),
restricted AS (SELECT * FROM cur WHERE status IN ('S0', 'S1', 'S3')),
hist AS (SELECT r.customer, r.status, min(e.ts) AS first_ts FROM restricted r
         JOIN err e ON e.customer = r.customer AND e.status = r.status AND e.k % 2 = 0
         GROUP BY ALL),
anchor AS (SELECT r.customer, r.status, CAST(coalesce(h.first_ts, r.ts) AS DATE) AS restricted_on
           FROM restricted r LEFT JOIN hist h USING (customer, status))
SELECT customer, status, restricted_on,
  CAST(strftime(day, '%Y%m%d') AS INTEGER) AS contact_key, count(*) AS n_exceptions
FROM anchor JOIN texts ON texts.account = customer
WHERE day > restricted_on AND day > DATE '2024-01-05' GROUP BY ALL
""")
def restricted_contact_exceptions(spark, sf):
    errors = f.ev(spark, sf).where(F.col("event_type") == "error").select(
        F.col("user_id").alias("customer"),
        F.concat(F.lit("S"), (F.col("k") % 5).cast("string")).alias("status"), "ts", "event_id", "k",
    )
    current = last_per(errors, "customer", ["ts", "event_id"], ["status", "ts"])
    history = errors.where(F.col("k") % 2 == 0)
    contacts = f.texts(spark, sf).select(F.col("account").alias("customer"), "ts")
    restricted = lookup(spark, [("S0",), ("S1",), ("S3",)], "status string")
    return compliance.restricted_contact_exceptions(
        current, history, contacts, restricted, "2024-01-05", updated="ts", inserted="ts",
        contact_ts="ts",
    )


@query("""
SELECT customer, letter_key, next_letter_key, days_since_initial FROM (
  SELECT customer, letter_key, letter_type, lead(letter_type) OVER w AS next_type,
    lead(letter_key) OVER w AS next_letter_key,
    date_diff('day', CAST(ts AS DATE), CAST(lead(ts) OVER w AS DATE)) AS days_since_initial
  FROM (SELECT user_id AS customer, event_id AS letter_key, ts,
          CASE event_type WHEN 'signup' THEN 'IDN' || (k % 3) WHEN 'purchase' THEN 'EM' || (k % 2)
               ELSE 'XX' END AS letter_type FROM ev)
  WINDOW w AS (PARTITION BY customer ORDER BY ts, letter_key))
WHERE letter_type LIKE 'IDN%' AND next_type LIKE 'EM%' AND days_since_initial <= 50
""")
def letter_sequence_exceptions(spark, sf):
    k, kind = F.col("k").cast("string"), F.col("event_type")
    letters = f.ev(spark, sf).select(
        F.col("user_id").alias("customer"), F.col("event_id").alias("letter_key"),
        F.col("ts").alias("requested"),
        F.when(kind == "signup", F.concat(F.lit("IDN"), (F.col("k") % 3).cast("string")))
        .when(kind == "purchase", F.concat(F.lit("EM"), (F.col("k") % 2).cast("string")))
        .otherwise("XX").alias("letter_type"),
    )
    return compliance.letter_sequence_exceptions(letters, "IDN%", "EM%").select(
        "customer", "letter_key", "next_letter_key",
        F.col("days_since_initial").cast("bigint").alias("days_since_initial"),
    )


@query("""
SELECT client, count(*) AS n_placements FROM sched
WHERE due_date >= DATE '2000-01-01' AND client NOT IN
  (SELECT 'C' || n_nationkey FROM nation WHERE n_regionkey IN (1, 2, 4))
GROUP BY client
""")
def unmapped_keys(spark, sf):
    return compliance.unmapped_keys(
        f.sched(spark, sf), _mapping(spark, sf), "client", "due_date", "2000-12-31"
    )


@query("""
SELECT DISTINCT client, 'Unmapped' AS grp FROM sched
WHERE client NOT IN (SELECT 'C' || n_nationkey FROM nation WHERE n_regionkey IN (1, 2, 4))
""")
def new_mapping_rows(spark, sf):
    return compliance.new_mapping_rows(
        f.sched(spark, sf), _mapping(spark, sf), "client", {"grp": "Unmapped"}
    )


def _mapping(spark, sf):
    """Client mapping that covers three of the regions."""
    mapped = load(spark, sf, "nation", where=F.col("n_regionkey").isin(1, 2, 4))
    return mapped.select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("client"))


# ---- messages -----------------------------------------------------------------------------------

cte("sent_ids", "SELECT DISTINCT guid FROM msgs WHERE code IN (8, 10, 13)")
cte("touched", """
SELECT * FROM (
  SELECT p.payment_id, p.crm, p.account, p.pay_date, p.amount, p.k, o.guid,
    row_number() OVER (PARTITION BY p.payment_id ORDER BY p.pay_date - CAST(o.ts AS DATE),
                       o.ts DESC, o.guid DESC) AS rn
  FROM pays p JOIN msgs o ON o.account = p.account AND o.crm = p.crm AND o.code = 5
   AND o.guid IN (SELECT guid FROM sent_ids)
   AND p.pay_date - CAST(o.ts AS DATE) BETWEEN 0 AND 15
  WHERE p.amount > 0) WHERE rn = 1
""")
cte("attributed", """
SELECT s.guid, s.send_date, s.crm, s.client, s.letter, s.account, s.email_domain, s.send_domain,
  delivered + bounced + wl + oo + inv AS requested, wl AS whitelist_scrubbed,
  oo AS optout_scrubbed, inv AS invalid_scrubbed, delivered + bounced AS sent, bounced, delivered,
  CAST(opens IS NOT NULL AS BIGINT) AS unq_opens, CAST(coalesce(opens, 0) AS BIGINT) AS total_opens,
  CAST(coalesce(optouts, 0) AS BIGINT) AS optouts, CAST(coalesce(spam, 0) AS BIGINT) AS marked_as_spam,
  CAST(CASE WHEN optouts IS NOT NULL OR spam IS NOT NULL THEN 0 ELSE coalesce(clicks, 0) END AS BIGINT)
    AS clicks,
  CAST(opens > 0 AND paid IS NOT NULL AS BIGINT) IS NOT DISTINCT FROM 1 AS has_pay,
  CASE WHEN opens > 0 THEN coalesce(paid, 0) ELSE 0 END AS payments, first_send_date
FROM (SELECT guid, min(ts) FILTER (code IN (8, 10, 13))::DATE AS send_date, min(crm) AS crm,
        min(client) AS client, min(letter) AS letter, min(account) AS account,
        min(split_part(email, '@', 2)) AS email_domain, min(send_domain) AS send_domain,
        CAST(max(CAST(code = 10 AS INT)) AS BIGINT) AS delivered,
        CAST(max(CAST(code = 8 AND (detail = 'Hard-Bounce' OR (value = 'Blocked' AND vendor = 'V1')) AS INT)) AS BIGINT) AS bounced,
        CAST(max(CAST(code = 8 AND detail = 'NotInWhiteList' AS INT)) AS BIGINT) AS wl,
        CAST(max(CAST(code IN (8, 13) AND detail = 'Opt-Out' AS INT)) AS BIGINT) AS oo,
        CAST(max(CAST((code = 8 AND detail = 'Soft-Bounce') OR (code = 13 AND detail IN ('Undeliverable', 'Bad-Record'))
          AS INT)) AS BIGINT) AS inv,
        sum(n_events) FILTER (code = 5) AS opens, sum(n_events) FILTER (code = 12) AS clicks,
        sum(n_events) FILTER (code IN (9, 100)) AS spam, sum(n_events) FILTER (code = 6) AS optouts
      FROM (SELECT * REPLACE (coalesce(detail, '') AS detail, coalesce(value, '') AS value) FROM msgs)
      WHERE guid IN (SELECT guid FROM sent_ids) GROUP BY guid) s
LEFT JOIN (SELECT guid, sum(amount - CASE WHEN crm = 5 THEN coalesce((
             SELECT sum(abs(n.amount)) FROM pays n WHERE n.crm = 5 AND n.k % 10 >= 7 AND n.account = t.account
               AND n.k % 4 = t.k % 4 AND n.payment_id <> t.payment_id), 0)
           WHEN EXISTS (
             SELECT 1 FROM revs r WHERE r.account = t.account AND r.crm = t.crm
               AND abs(r.amount) = abs(t.amount) AND r.pay_date - t.pay_date BETWEEN 0 AND 45)
             THEN abs(t.amount) ELSE 0 END) AS paid
           FROM touched t WHERE crm <> 5 OR k % 10 < 7 GROUP BY guid) p USING (guid)
LEFT JOIN (SELECT crm, client, account, min(CAST(ts AS DATE)) AS first_send_date FROM msgs
           WHERE code IN (8, 10, 13) GROUP BY ALL) fs USING (crm, client, account)
""")


BOUNCING = messages.Codes(bounce_vendor="V1")


def _paid(spark, sf):
    """Payments and reversals of the first source; those of the second, which carry references."""
    first = [df.where("crm <> 5") for df in (f.pays(spark, sf), f.revs(spark, sf))]
    return first, {"referenced": f.by_reference(spark, sf), "codes": BOUNCING}


def _attribution(spark, sf):
    first, second = _paid(spark, sf)
    return messages.message_attribution(f.msgs(spark, sf), *first, "2024-02-10", **second)


@query("""
SELECT * EXCLUDE (has_pay) REPLACE (round(payments, 4) AS payments),
  CAST(has_pay AS BIGINT) AS payers FROM attributed
""")
def message_attribution(spark, sf):
    return _attribution(spark, sf).withColumn("payments", r4("payments"))


@query("""
SELECT * EXCLUDE (has_pay) REPLACE (round(payments, 4) AS payments), CAST(has_pay AS BIGINT) AS payers,
  date_trunc('month', send_date)::DATE AS send_month FROM attributed
""")
def attribution_refresh(spark, sf):
    """Two runs into a stored report by way of the stored state: the events until January 20,
    then those after it."""
    path, state = new_folder(spark, "attribution"), new_folder(spark, "attribution-state")
    first, second = _paid(spark, sf)
    for as_of in ("2024-01-20", "2024-02-10"):
        messages.refresh_attribution(path, f.msgs(spark, sf), *first, as_of, state=state, **second)
    return read_table(spark, path).withColumn("payments", r4("payments"))


@query("""
SELECT payment_id, guid, CAST(pay_date - (SELECT max(CAST(ts AS DATE)) FROM msgs m
  WHERE m.guid = t.guid AND m.code = 5 AND CAST(ts AS DATE) <= t.pay_date) AS BIGINT) AS days
FROM touched t
""")
def last_touch(spark, sf):
    log = f.msgs(spark, sf)
    sent = log.where(F.col("code").isin(8, 10, 13)).select("guid").distinct()
    opens = log.where(F.col("code") == 5).join(sent, "guid", "left_semi")
    paid = f.pays(spark, sf).where(F.col("amount") > 0)
    return messages.last_touch(
        paid, opens.select("crm", "account", "guid", "ts"), ["crm", "account"], "pay_date", "ts",
        "guid", 15,
    ).select("payment_id", "guid", F.col("days_from_touch").cast("bigint").alias("days"))


@query("""
SELECT date_trunc('month', first_send_date)::DATE AS first_send_month, client, crm,
  count(DISTINCT account) AS first_send_accounts,
  count(DISTINCT CASE WHEN requested > 0 THEN account END) AS unq_requested,
  count(DISTINCT CASE WHEN whitelist_scrubbed > 0 THEN account END) AS unq_whitelist_scrubbed,
  count(DISTINCT CASE WHEN optout_scrubbed > 0 THEN account END) AS unq_optout_scrubbed,
  count(DISTINCT CASE WHEN invalid_scrubbed > 0 THEN account END) AS unq_invalid_scrubbed,
  count(DISTINCT CASE WHEN sent > 0 THEN account END) AS unq_sent,
  count(DISTINCT CASE WHEN bounced > 0 THEN account END) AS unq_bounced,
  count(DISTINCT CASE WHEN delivered > 0 THEN account END) AS unq_delivered,
  count(DISTINCT CASE WHEN unq_opens > 0 THEN account END) AS unq_opens,
  count(DISTINCT CASE WHEN optouts > 0 THEN account END) AS unq_optouts,
  count(DISTINCT CASE WHEN marked_as_spam > 0 THEN account END) AS unq_spam,
  count(DISTINCT CASE WHEN clicks > 0 THEN account END) AS unq_clicks,
  count(DISTINCT CASE WHEN has_pay THEN account END) AS payers,
  round(sum(payments), 4) AS payments
FROM attributed GROUP BY ALL
""")
def first_month_funnel(spark, sf):
    return messages.first_month_funnel(_attribution(spark, sf)).withColumn("payments", r4("payments"))


@query("""
WITH rows AS (
  SELECT *, lag(result, 1, '') OVER (PARTITION BY account ORDER BY ts, session) AS prev FROM texts
  WHERE ts >= TIMESTAMP '2024-01-15'),
recent AS (SELECT account, full_name, first(platform ORDER BY ts, session) AS p1 FROM rows
           WHERE platform IS NOT NULL GROUP BY ALL),
old AS (SELECT account, full_name, first(platform ORDER BY ts, session) AS p2 FROM texts
        WHERE platform IS NOT NULL GROUP BY ALL),
kept AS (SELECT rows.* REPLACE (coalesce(platform, p1, p2) AS platform) FROM rows
         LEFT JOIN recent USING (account, full_name) LEFT JOIN old USING (account, full_name)
         WHERE NOT (prev = 'Stop' AND result IN ('Delivered', 'Failed', 'Reply', 'Transfer'))),
sys AS (SELECT DISTINCT account, 'ALPHA' AS s, 'C' || (account % 4) AS known FROM texts
        UNION SELECT DISTINCT account, 'BETA', 'D' || (account % 4) FROM texts WHERE account % 3 <> 0),
named AS (SELECT kept.* EXCLUDE (client), known AS client FROM kept LEFT JOIN sys
          ON sys.account = kept.account
         AND s = CASE WHEN platform = 'A3' THEN 'ALPHA' WHEN platform <> 'A3' THEN 'BETA' END),
clk AS (SELECT day, user_id AS account, CASE WHEN k % 2 = 0 THEN 'C' ELSE 'D' END || (user_id % 4)
          AS client, 'L' || (k % 3) AS letter FROM ev WHERE event_type = 'click'),
agg AS (SELECT n.day, n.account, count(*) AS t, count(DISTINCT (service_name, c.letter)) AS u
        FROM named n JOIN clk c ON c.day = n.day AND c.account = n.account AND c.client = n.client
        GROUP BY ALL)
SELECT session, n.day, n.account, result, platform, n.client, coalesce(t, 0) AS total_clicks,
  coalesce(u, 0) AS unique_clicks,
  CAST(result IN ('Stop', 'Reply', 'Delivered', 'Failed', 'Transfer') AS INTEGER) AS is_dialed,
  CAST(result IN ('Delivered', 'Transfer') AS INTEGER) AS is_connected,
  CAST(result = 'Stop' AS INTEGER) AS is_stop
FROM named n LEFT JOIN agg ON agg.day = n.day AND agg.account = n.account
""")
def click_detail(spark, sf):
    log = f.texts(spark, sf).drop("client")
    month = log.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    user, k = F.col("user_id"), F.col("k")
    clicks = f.ev(spark, sf).where(F.col("event_type") == "click").select(
        "day", user.alias("account"),
        F.concat(F.when(k % 2 == 0, "C").otherwise("D"), (user % 4).cast("string")).alias("client"),
        F.concat(F.lit("L"), (k % 3).cast("string")).alias("letter"),
    )
    people = log.select("account").distinct()
    account = F.col("account")
    known = people.withColumn("__s", F.explode(F.array(F.lit("ALPHA"), F.lit("BETA")))).where(
        (F.col("__s") == "ALPHA") | (account % 3 != 0)
    ).select(
        "account", F.col("__s").alias("source_system"),
        F.concat(F.when(F.col("__s") == "ALPHA", "C").otherwise("D"),
                 (account % 4).cast("string")).alias("client"),
    )
    platform = F.col("platform")
    return messages.message_click_detail(
        month, log, clicks, known, ["Stop"], ["Delivered", "Failed", "Reply", "Transfer"],
        ["Stop", "Reply", "Delivered", "Failed", "Transfer"], ["Delivered", "Transfer"],
        {"ALPHA": platform == "A3", "BETA": platform != "A3"},
    ).select("session", "day", "account", "result", "platform", "client", "total_clicks",
             "unique_clicks", "is_dialed", "is_connected", "is_stop")


@query("""
WITH resp AS (SELECT day, 'Service ' || (k % 5) AS service_name, 1 AS calls, k % 2 AS contacts,
                1 AS payments, value AS amount FROM ev WHERE event_type = 'purchase'),
last AS (SELECT max(day) AS d FROM resp)
SELECT day, service_name, sum(dialed)::BIGINT AS dialed, sum(connected)::BIGINT AS connected,
  sum(stopped)::BIGINT AS stopped, sum(calls)::BIGINT AS calls, sum(contacts)::BIGINT AS contacts,
  sum(payments)::BIGINT AS payments, round(sum(amount), 4) AS amount
FROM (SELECT day, service_name, CAST(result IN ('Delivered', 'Failed', 'Transfer') AS INT) AS dialed,
        CAST(result IN ('Delivered', 'Transfer') AS INT) AS connected,
        CAST(result = 'Stop' AS INT) AS stopped, 0 AS calls, 0 AS contacts, 0 AS payments, 0.0 AS amount
      FROM texts UNION ALL SELECT day, service_name, 0, 0, 0, calls, contacts, payments, amount FROM resp)
WHERE day = (SELECT d FROM last) GROUP BY ALL
""")
def channel_daily_summary(spark, sf):
    k = F.col("k")
    responses = f.ev(spark, sf).where(F.col("event_type") == "purchase").select(
        "day", F.concat(F.lit("Service "), (k % 5).cast("string")).alias("service_name"),
        F.lit(1).alias("calls"), (k % 2).alias("contacts"), F.lit(1).alias("payments"),
        F.col("value").alias("amount"),
    )
    return messages.channel_daily_summary(
        f.texts(spark, sf), responses, ["Delivered", "Failed", "Transfer"],
        ["Delivered", "Transfer"], ["Stop"], ["service_name"],
    ).withColumn("amount", r4("amount"))


cte("monthly", """
SELECT '24-Jan' AS month_label, c.client, coalesce(a, 0) AS email_sent,
  CAST(coalesce(b, 0) AS BIGINT) AS email_delivered, coalesce(c1, 0) AS email_bounced,
  CAST(coalesce(d, 0) AS BIGINT) AS email_opened, CAST(coalesce(e, 0) AS BIGINT) AS email_clicked,
  CAST(coalesce(f, 0) AS BIGINT) AS email_optouts, coalesce(g, 0) AS text_sent,
  coalesce(h, 0) AS text_delivered, coalesce(i, 0) AS text_optouts
FROM (SELECT 'C' || n_nationkey AS client FROM nation) c
LEFT JOIN (SELECT client, count(*) AS a, sum(CASE WHEN code = 10 THEN n_events ELSE 0 END) AS b,
  count(*) FILTER (code = 8 AND (detail = 'Hard-Bounce' OR (value = 'Blocked' AND vendor = 'V1'))) AS c1,
  sum(CASE WHEN code = 5 THEN n_events ELSE 0 END) AS d,
  sum(CASE WHEN code = 12 THEN n_events ELSE 0 END) AS e,
  sum(CASE WHEN code = 6 THEN n_events ELSE 0 END) AS f
  FROM msgs WHERE ts >= '2024-01-01' AND ts < '2024-02-01' GROUP BY client) USING (client)
LEFT JOIN (SELECT client, count(*) FILTER (result IN ('Delivered', 'Failed')) AS g,
  count(*) FILTER (result = 'Delivered') AS h, count(*) FILTER (result = 'Stop') AS i
  FROM texts WHERE ts >= '2024-01-01' AND ts < '2024-02-01' GROUP BY client) USING (client)
""")


def _monthly(spark, sf):
    clients = load(spark, sf, "nation").select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("client")
    )
    return messages.channel_monthly_summary(
        clients, f.msgs(spark, sf), f.texts(spark, sf), "2024-02-10", BOUNCING,
        text_sent=["Delivered", "Failed"], text_delivered=["Delivered"], text_optout=["Stop"],
    )


@query("SELECT * FROM monthly")
def channel_monthly_summary(spark, sf):
    return _monthly(spark, sf)


@query("""
SELECT 'email_sent' AS measure, CAST(max(CAST(email_sent <> 0 AS INT)) AS INTEGER) AS has_data
FROM monthly UNION ALL
SELECT 'text_sent', CAST(max(CAST(text_sent <> 0 AS INT)) AS INTEGER) FROM monthly
""")
def missing_channels(spark, sf):
    return messages.missing_channels(_monthly(spark, sf))


@query("""
WITH people AS (SELECT CAST(account AS VARCHAR) AS account, name AS client_ref, segment AS city, state,
  left('1234' || account, 5) AS zip FROM acct),
log AS (
SELECT client_ref, ts, CASE WHEN code = 6 THEN 'IN' ELSE 'OUT' END AS direction, 'Email' AS category,
  letter AS sub_category, email AS email_address, '' AS phone_number,
  CASE WHEN code = 8 AND detail = 'Hard-Bounce' THEN 'Failed' WHEN code = 10 THEN 'Delivered'
       WHEN code = 5 THEN 'Opened' WHEN code = 12 THEN 'Clicked' WHEN code = 6 THEN 'Unsubscribed'
       ELSE 'Other' END AS result, city, state, zip
FROM msgs LEFT JOIN people ON people.account = CAST(msgs.account AS VARCHAR)
WHERE code IN (5, 6, 8, 10, 12) AND ts >= '2024-01-10' AND ts < '2024-01-20'
UNION
SELECT client_ref, ts, direction, CASE WHEN service_name LIKE '%4' THEN 'MMS' ELSE 'SMS' END,
  coalesce(letter, ''), '', CASE WHEN direction = 'OUT' THEN phone ELSE '9' || phone END, outcome,
  city, state, zip
FROM texts JOIN people ON people.account = split_part(account_ref, '-', 1)
LEFT JOIN (VALUES ('Delivered', 'Delivered', 'OUT'), ('Failed', 'Failed', 'OUT'),
  ('Reply', 'Delivered', 'IN'), ('Stop', 'Unsubscribed', 'IN')) r(result, outcome, direction)
  ON r.result = texts.result WHERE ts >= '2024-01-10' AND ts < '2024-01-20')
SELECT *, '' AS comm_id, '' AS "user", 'User' AS user_type, '' AS content, 'EN' AS language,
  '' AS consent, '' AS notes FROM log
""")
def communication_log(spark, sf):
    outcomes = lookup(spark, [
        ("Delivered", "Delivered", "OUT"), ("Failed", "Failed", "OUT"),
        ("Reply", "Delivered", "IN"), ("Stop", "Unsubscribed", "IN"),
    ], "result string, outcome string, direction string")
    names = {10: "Delivered", 8: "Failed", 5: "Opened", 12: "Clicked", 6: "Unsubscribed"}
    people = f.acct(spark, sf).select(
        "account", F.col("name").alias("client_ref"), F.col("segment").alias("city"), "state",
        F.concat(F.lit("1234"), F.col("account").cast("string")).alias("zip"))
    log = f.texts(spark, sf).drop("account").withColumn(
        "caller_phone", F.concat(F.lit("9"), F.col("phone")))
    return messages.communication_log(
        f.msgs(spark, sf), log, people, names, outcomes, "2024-01-10", "2024-01-20",
        picture_pattern="%4")


@query("""
SELECT day, event_type, count(*) AS n_events, round(sum(value), 4) AS value FROM ev
WHERE ts >= '2024-01-01' AND ts < '2024-01-26' GROUP BY ALL
""")
def activity_daily(spark, sf):
    return messages.activity_daily(
        f.ev(spark, sf), "2024-01-25", ["event_type"], ["value"]
    ).withColumn("value", r4("value"))


@query("""
SELECT event_type, CAST(isodow(ts) AS INTEGER) AS weekday_no, strftime(ts, '%a') AS weekday,
  CAST(hour(ts) AS INTEGER) AS hour_no, count(*) AS n_events FROM events GROUP BY ALL
""")
def hourly_activity(spark, sf):
    return messages.hourly_activity(load(spark, sf, "events", ["ts", "event_type"]),
                                    keys=["event_type"])


# ---- schedules --------------------------------------------------------------------------------

DAY = "2000-06-15"
cte("open_sched", """
SELECT * FROM sched WHERE (source = 'STAR' AND due_date >= DATE '2000-06-15' AND broken_date IS NULL)
  OR (source = 'LEGACY' AND due_date >= DATE '2000-05-01')
""")
cte("detail", """
SELECT payment_id, s.source, s.account, s.client, due_date, amount, state, segment, region,
  date_trunc('month', list_date)::DATE AS batch_month, date_trunc('month', due_date)::DATE AS due_month
FROM open_sched s LEFT JOIN acct a ON a.account = s.account
LEFT JOIN (SELECT 'C' || n_nationkey AS client, r_name AS region FROM nation
           JOIN region ON n_regionkey = r_regionkey) c ON c.client = s.client
""")


def _sources(spark, sf):
    """The fact source, and the other one as a current list that also holds overdue items."""
    star, legacy = f.sched_sources(spark, sf)
    return [star], [legacy.where(F.col("due_date") >= F.lit("2000-05-01").cast("date"))]


def _detail(spark, sf):
    clients = load(spark, sf, "nation").join(
        load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("client"),
             F.col("r_name").alias("region"))
    accounts = f.acct2(spark, sf).select("account", "source", "state", "segment", "list_date")
    star, legacy = _sources(spark, sf)
    return payments.postdated_detail(star, accounts, clients, DAY, legacy)


@query("SELECT * FROM detail")
def postdated_detail(spark, sf):
    return _detail(spark, sf).select(
        "payment_id", "source", "account", "client", "due_date", "amount", "state", "segment",
        "region", "batch_month", "due_month",
    )


@query("""
SELECT source, client, region, account, due_month, count(*) AS n_payments,
  round(sum(amount), 4) AS amount FROM detail GROUP BY ALL
""")
def postdated_unique(spark, sf):
    return payments.postdated_unique(
        _detail(spark, sf), ["source", "client", "region"]
    ).withColumn("amount", r4("amount"))


def _horizon(spark, sf, n, client_filter=None):
    paid = f.sched(spark, sf).select(
        "source", "account", F.col("due_date").alias("pay_date"), F.col("status").alias("kind")
    )
    star, legacy = _sources(spark, sf)
    out = payments.payment_horizon_matrix(
        star, paid, f.acct2(spark, sf).select("account", "source", "segment"),
        DAY, n, paid_since="1996-01-01", excluded_types=["P"], client_filter=client_filter,
        current_lists=legacy,
    )
    return out.withColumns({c: r4(c) for c in out.columns
                            if c.startswith("month_") or c == "over_range"})


def _horizon_sql(n, extra=""):
    slot = "(year(due_date) - 2000) * 12 + month(due_date) - 6 + 1"
    cols = ", ".join(
        f"round(sum(CASE WHEN {slot} = {i} THEN amount ELSE 0 END), 4) AS month_{i}"
        for i in range(1, n + 1)
    )
    return f"""
SELECT m.*, remaining + coalesce(n_paid, 0) AS taken, coalesce(n_paid, 0) AS n_paid, segment FROM (
  SELECT source, account, client, {cols},
    round(sum(CASE WHEN {slot} NOT BETWEEN 1 AND {n} THEN amount ELSE 0 END), 4) AS over_range, count(*) AS remaining
  FROM open_sched {extra} GROUP BY source, account, client) m
LEFT JOIN (SELECT source, account, count(*) AS n_paid FROM sched
  WHERE due_date >= '1996-01-01' AND status <> 'P' GROUP BY ALL) USING (source, account)
LEFT JOIN (SELECT account, segment FROM acct) USING (account)
"""


@query(_horizon_sql(13))
def payment_horizon_matrix(spark, sf):
    return _horizon(spark, sf, 13)


@query(_horizon_sql(25, "WHERE client IN ('C1', 'C2', 'C3')"))
def payment_horizon_long(spark, sf):
    return _horizon(spark, sf, 25, F.col("client").isin("C1", "C2", "C3"))


def _age_case():
    parts = []
    for lo, hi, label in payments.AGE_BANDS:
        test = " AND ".join(t for t in (
            f"age >= {lo}" if lo is not None else "", f"age < {hi}" if hi is not None else "") if t)
        parts.append(f"WHEN {test} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


@query(f"""
SELECT batch_month, source, client, state, {_age_case()} AS charge_off_band,
  CASE WHEN bal > 0 AND bal < 500 THEN 'A-0-$499' WHEN bal >= 500 AND bal < 1000 THEN 'B-$500-$999'
       WHEN bal >= 1000 AND bal < 2500 THEN 'C-$1000-$2499'
       WHEN bal >= 2500 AND bal < 4999 THEN 'D-$2500-$4999' WHEN bal >= 5000 THEN 'E-$5000+' END
    AS balance_range,
  count(*) AS promises, count(DISTINCT account) AS unq_promises, round(sum(amount), 4) AS promise_amt,
  round(sum(CASE WHEN year(due_date) = 2000 AND month(due_date) = 6 THEN amount ELSE 0 END), 4)
    AS promise_amt_month
FROM (SELECT s.*, state, initial_balance AS bal, date_trunc('month', list_date)::DATE AS batch_month,
        (coalesce(list_date, DATE '2050-01-01') - coalesce(charge_off_date, DATE '2040-01-01')) / 360.0
          AS age
      FROM open_sched s LEFT JOIN acct ON acct.account = s.account) GROUP BY ALL
""")
def promise_summary(spark, sf):
    accounts = f.acct2(spark, sf).select(
        "account", "source", "state", "list_date", "charge_off_date", "initial_balance"
    )
    star, legacy = _sources(spark, sf)
    return payments.promise_summary(star, accounts, DAY, current_lists=legacy).withColumns(
        {"promise_amt": r4("promise_amt"), "promise_amt_month": r4("promise_amt_month")}
    )


cte("snap_months", """
SELECT unnest([DATE '1999-12-01', DATE '2000-01-01', DATE '2000-02-01', DATE '2000-03-01',
               DATE '2000-04-01', DATE '2000-05-01']) AS snapshot_month
""")


@query("""
SELECT snapshot_month, source, count(*) AS n_open, count(DISTINCT account) AS n_accounts,
  round(sum(amount), 4) AS amount FROM sched JOIN snap_months
  ON due_date >= snapshot_month AND (broken_date IS NULL OR broken_date >= snapshot_month)
GROUP BY ALL
""")
def open_as_of_months(spark, sf):
    return payments.open_as_of_months(f.sched(spark, sf), DAY).groupBy(
        "snapshot_month", "source"
    ).agg(F.count(F.lit(1)).alias("n_open"), F.count_distinct("account").alias("n_accounts"),
          r4(F.sum("amount")).alias("amount"))


@query("""
SELECT payment_id, account, amount, DATE '2000-06-01' AS snapshot_month FROM sched
WHERE source = 'LEGACY' AND due_date >= '2000-06-15' AND broken_date IS NULL
UNION ALL SELECT payment_id, account, amount, snapshot_month FROM sched JOIN snap_months
  ON due_date >= snapshot_month AND (broken_date IS NULL OR broken_date >= snapshot_month)
WHERE source = 'STAR'
""")
def snapshot_history(spark, sf):
    star, legacy = f.sched_sources(spark, sf)
    live = legacy.where((F.col("due_date") >= F.lit(DAY).cast("date")) & F.col("broken_date").isNull())
    rebuilt = payments.open_as_of_months(star, DAY)
    return payments.snapshot_history(
        spark, live.select("payment_id", "account", "amount"), rebuilt,
        new_folder(spark, "snapshots"), DAY,
    )


@query("""
WITH linked_texts AS (SELECT session, CASE WHEN session % 9 <> 0 THEN account END AS account, day FROM texts)
SELECT t.session, t.account, t.day, round(coalesce(p, 0), 4) AS pay_received,
  round(coalesce(p / n, 0), 9) AS pay_share
FROM linked_texts t LEFT JOIN (SELECT account, day, count(*) AS n FROM linked_texts GROUP BY ALL) USING (account, day)
LEFT JOIN (SELECT account, pay_date AS day, sum(amount) AS p FROM pays GROUP BY ALL)
  USING (account, day)
""")
def payment_to_interaction(spark, sf):
    paid = f.pays(spark, sf).withColumnRenamed("pay_date", "day")
    rows = f.texts(spark, sf).select(
        "session", F.when(F.col("session") % 9 != 0, F.col("account")).alias("account"), "day")
    return payments.payment_to_interaction(rows, paid).withColumns(
        {"pay_received": r4("pay_received"), "pay_share": F.round("pay_share", 9)}
    )


@query("""
SELECT o_orderkey AS reference, o_custkey AS account, CAST(o_orderdate AS DATE) AS pay_date,
  o_totalprice AS amount, o_orderstatus AS kind, TIMESTAMP '2000-06-15' AS import_time FROM orders
""")
def load_schedule_file(spark, sf):
    o = load(spark, sf, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("reference"),
        F.col("o_custkey").cast("string").alias("account"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("pay_date"),
        F.format_string("%.2f", "o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("kind"),
    )
    landed = export_csv(raw.unionByName(raw), new_folder(spark, "landing"), "schedule", DAY)
    casts = {"reference": "bigint", "account": "bigint", "pay_date": "date:MM/dd/yyyy",
             "amount": "double", "kind": "string"}
    return payments.load_schedule_file(
        spark, landed, raw.columns, casts, new_folder(spark, "schedule"), DAY
    )


@query(_horizon_sql(13).replace("SELECT m.*,", "SELECT m.*, CASE WHEN source = 'LEGACY' THEN remaining END AS n_snapshot,"))
def schedule_cycle(spark, sf):
    """One source delivers its open payments as a daily file, with repeated rows. The second run
    of the day gets a file of other amounts and must leave everything as it is."""
    star, legacy = _sources(spark, sf)
    columns = ["payment_id", "source", "account", "client", "due_date", "amount"]
    casts = {"payment_id": "bigint", "source": "string", "account": "bigint", "client": "string",
             "due_date": "date:MM/dd/yyyy", "amount": "double"}

    def land(rows, name):
        return export_csv(rows, new_folder(spark, "landing"), name, DAY)

    raw = legacy[0].select(
        F.col("payment_id").cast("string").alias("payment_id"), "source",
        F.col("account").cast("string").alias("account"), "client",
        F.date_format("due_date", "MM/dd/yyyy").alias("due_date"),
        F.format_string("%.2f", "amount").alias("amount"))
    table, snapshots = new_folder(spark, "schedule"), new_folder(spark, "snapshots")
    paid = f.sched(spark, sf).select(
        "source", "account", F.col("due_date").alias("pay_date"), F.col("status").alias("kind"))
    accounts = f.acct2(spark, sf).select("account", "source", "segment")
    for landed in (land(raw.unionByName(raw), "first"), land(raw.withColumn("amount", F.lit("1.00")), "second")):
        out, history = payments.schedule_cycle(
            spark, landed, columns, casts, table, snapshots, star, paid, accounts, DAY, n_months=13,
            paid_since="1996-01-01", excluded_types=["P"])
    stored = history.where(F.col("snapshot_month") == F.lit("2000-06-01").cast("date")).groupBy(
        "source", "account", "client").agg(F.count(F.lit(1)).alias("n_snapshot"))
    return out.join(stored, ["source", "account", "client"], "left").withColumns(
        {c: r4(c) for c in out.columns if c.startswith("month_") or c == "over_range"})


# ---- spines and profiles ----------------------------------------------------------------------

cte("spine_accounts", """
SELECT 'C' || (user_id % 4) AS entity, day - CAST(k % 50 AS INTEGER) AS list_date,
  CASE WHEN k % 3 = 0 THEN day + CAST(k % 10 AS INTEGER) END AS cancel_date
FROM ev WHERE event_type = 'signup'
""")


@query("""
WITH days AS (SELECT CAST(d AS DATE) AS day FROM
                generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(d)),
spine AS (SELECT entity, day FROM (SELECT DISTINCT entity FROM spine_accounts), days),
tot AS (SELECT entity, count(*) AS all_accounts FROM spine_accounts
        WHERE list_date <= '2024-01-31' AND (cancel_date IS NULL OR cancel_date >= '2024-01-01')
        GROUP BY entity),
per_day AS (SELECT entity, cancel_date AS day, count(*) AS n FROM spine_accounts
        WHERE cancel_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY ALL),
cum AS (SELECT s.entity, s.day, (SELECT sum(n) FROM per_day c WHERE c.entity = s.entity
          AND c.day <= s.day) AS cum_cancels FROM spine s),
base AS (SELECT s.*, all_accounts, CAST(cum_cancels AS BIGINT) AS cum_cancels,
   all_accounts - cum_cancels AS avail, coalesce(e.n, 0) AS emails, c.n AS transfers
  FROM spine s LEFT JOIN tot USING (entity) LEFT JOIN cum USING (entity, day)
  LEFT JOIN (SELECT client AS entity, CAST(ts AS DATE) AS day, count(*) AS n FROM msgs WHERE code = 10
             GROUP BY ALL) e USING (entity, day)
  LEFT JOIN (SELECT client AS entity, day, count(*) AS n FROM texts WHERE result = 'Transfer'
             GROUP BY ALL) c USING (entity, day))
SELECT entity, day, all_accounts, cum_cancels, emails, transfers,
  CAST(CASE WHEN lag(avail, 1, 0) OVER w = 0 THEN all_accounts ELSE lag(avail, 1, 0) OVER w END
       AS BIGINT) AS available_accounts
FROM base WINDOW w AS (PARTITION BY entity ORDER BY day)
""")
def daily_kpi_spine(spark, sf):
    k, day = F.col("k"), F.col("day")
    accounts = f.ev(spark, sf).where(F.col("event_type") == "signup").select(
        F.concat(F.lit("C"), (F.col("user_id") % 4).cast("string")).alias("entity"),
        F.date_sub(day, k % 50).alias("list_date"),
        F.when(k % 3 == 0, F.date_add(day, k % 10)).alias("cancel_date"),
    )
    mail = f.msgs(spark, sf).where(F.col("code") == 10).groupBy(
        F.col("client").alias("entity"), F.col("ts").cast("date").alias("day")
    ).agg(F.count(F.lit(1)).alias("emails"))
    moved = f.texts(spark, sf).where(F.col("result") == "Transfer").groupBy(
        F.col("client").alias("entity"), "day"
    ).agg(F.count(F.lit(1)).alias("transfers"))
    return scorecard.daily_kpi_spine(
        accounts, accounts, [mail, moved], ["emails"], "2024-02-02"
    ).select("entity", "day", "all_accounts", "cum_cancels", "emails", "transfers",
             "available_accounts")


def _measure_sql(col, alias):
    return ", ".join(
        [f"CAST(sum({col}) AS BIGINT) AS {alias}"]
        + [f"CAST(sum(CASE WHEN {test} THEN {col} END) AS BIGINT) AS {alias}_{name}" for name, test in (
            ("inbound", "direction = 'Inbound'"), ("outbound", "direction = 'Outbound'"),
            ("manual", "call_type = 'Manual'"), ("dialer", "call_type = 'Dialer'"))]
    )


cte("score_calls", """
SELECT client, due_date AS call_date, CASE WHEN status = 'O' THEN 'Inbound' ELSE 'Outbound' END
  AS direction, CASE WHEN payment_id % 3 = 0 THEN 'Manual' ELSE 'Dialer' END AS call_type,
  1 AS n_calls, payment_id % 2 AS n_contacts, payment_id % 4 AS n_connects,
  CAST(status = 'P' AS INT) AS n_promises, payment_id % 600 AS call_seconds FROM sched
""")
cte("score_lines", """
SELECT 'C' || s_nationkey AS client, CAST(l_shipdate AS DATE) AS day, l_quantity, l_linenumber,
  l_returnflag, l_linestatus FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
""")


@query(f"""
WITH spine AS (SELECT 'C' || n_nationkey AS client, CAST(d AS DATE) AS month FROM nation,
   generate_series(DATE '1998-03-01', DATE '1999-03-01', INTERVAL 1 MONTH) t(d))
SELECT * FROM spine
LEFT JOIN (SELECT client, date_trunc('month', list_date)::DATE AS month, count(*) AS placed_count,
  round(sum(initial_balance), 4) AS placed_amount FROM acct
  WHERE list_date >= '1998-03-01' AND list_date < '1999-03-16' GROUP BY ALL) USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', call_date)::DATE AS month,
  {_measure_sql('n_calls', 'calls')}, {_measure_sql('n_contacts', 'contacts')},
  {_measure_sql('n_connects', 'connects')}, {_measure_sql('n_promises', 'promises')},
  CAST(sum(call_seconds) AS BIGINT) AS call_seconds
  FROM score_calls WHERE call_date >= '1998-03-01' AND call_date < '1999-03-16' GROUP BY ALL)
  USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', due_date)::DATE AS month,
  count(DISTINCT account) AS accounts_paid, round(sum(amount), 4) AS collections,
  round(sum(amount * 0.25), 4) AS fees, count(*) AS n_payments,
  round(sum(CASE WHEN status = 'P' THEN amount END), 4) AS first_collections,
  count(*) FILTER (status = 'P') AS first_payments
  FROM sched WHERE due_date >= '1998-03-01' AND due_date < '1999-03-16' GROUP BY ALL)
  USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', day)::DATE AS month,
  round(sum(l_quantity), 4) AS inventory_accounts FROM score_lines
  WHERE day >= '1998-03-01' AND day < '1999-03-16' GROUP BY ALL) USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', day)::DATE AS month,
  CAST(sum(l_linenumber) AS BIGINT) AS emails_sent FROM score_lines WHERE l_returnflag = 'N'
  AND day >= '1998-03-01' AND day < '1999-03-16' GROUP BY ALL) USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', day)::DATE AS month, count(*) AS letters_sent
  FROM score_lines WHERE (l_returnflag = 'R' OR (l_returnflag = 'A'
    AND (day < '1998-08-01' OR l_linestatus = 'O')))
  AND day >= '1998-03-01' AND day < '1999-03-16' GROUP BY ALL) USING (client, month)
LEFT JOIN (SELECT client, date_trunc('month', due_date)::DATE AS month,
  count(DISTINCT account) AS accounts_worked FROM sched GROUP BY ALL) USING (client, month)
""")
def kpi_scorecard(spark, sf):
    s, key = f.sched(spark, sf), F.col("payment_id")
    calls = s.select(
        "client", F.col("due_date").alias("call_date"),
        F.when(F.col("status") == "O", "Inbound").otherwise("Outbound").alias("direction"),
        F.when(key % 3 == 0, "Manual").otherwise("Dialer").alias("call_type"),
        F.lit(1).alias("n_calls"), (key % 2).alias("n_contacts"), (key % 4).alias("n_connects"),
        (F.col("status") == "P").cast("int").alias("n_promises"),
        (key % 600).alias("call_seconds"),
    )
    worked = s.groupBy("client", month_start(F.col("due_date")).alias("month")).agg(
        F.count_distinct("account").alias("accounts_worked"))
    paid = s.select(
        "client", "account", F.col("due_date").alias("pay_date"), "amount",
        (F.col("amount") * 0.25).alias("fee"), (F.col("status") == "P").cast("int").alias("is_first"),
    )
    lines = load(spark, sf, "lineitem", [
        "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber", "l_returnflag", "l_linestatus",
    ]).join(load(spark, sf, "supplier", ["s_suppkey", "s_nationkey"]),
            F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("client"),
        F.col("l_shipdate").cast("date").alias("day"), "l_quantity", "l_linenumber",
        "l_returnflag", "l_linestatus",
    )
    inventory = lines.select("client", F.col("day").alias("rpt_month"),
                             F.col("l_quantity").alias("accounts"))
    mails = lines.where(F.col("l_returnflag") == "N").select(
        "client", F.col("day").alias("send_date"), F.col("l_linenumber").alias("sent"))
    flagged = lines.where(F.col("l_returnflag") == "A").withColumnRenamed("day", "mail_date")
    other = lines.where(F.col("l_returnflag") == "R").withColumnRenamed("day", "mail_date")
    since = F.lit("1998-08-01").cast("date")
    rule = (F.col("mail_date") < since) | (F.col("l_linestatus") == "O")
    clients = load(spark, sf, "nation").select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("client"))
    out = scorecard.kpi_scorecard(
        clients, f.acct(spark, sf), calls, paid, inventory, mails, [flagged, other], "1999-03-15",
        letter_rule=rule, worked=worked, call_sums=["call_seconds"],
    )
    money = ["placed_amount", "collections", "fees", "first_collections", "inventory_accounts"]
    return out.withColumns({c: r4(c) for c in money})


cte("placed", """
SELECT o_custkey AS account, c_mktsegment AS stream, date_trunc('month', o_orderdate)::DATE AS month,
  CASE WHEN o_orderkey % 3 = 0 THEN '555' || (1000000 + o_custkey) ELSE '55' END AS phone,
  rpad(c_name, CAST(3 + o_orderkey % 6 AS INTEGER), ' ') AS address,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'T' || o_custkey || '  ' END AS tax_id,
  CAST(o_orderdate AS DATE) - CAST((o_orderkey * 13) % 900 AS INTEGER) AS open_date,
  CAST(o_orderdate AS DATE) AS list_date,
  CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS email_account
FROM orders JOIN customer ON o_custkey = c_custkey
""")


def _placed(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).join(
        load(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"]),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        cust.alias("account"), F.col("c_mktsegment").alias("stream"), month_start(day).alias("month"),
        F.when(key % 3 == 0, F.concat(F.lit("555"), (1000000 + cust).cast("string")))
        .otherwise("55").alias("phone"),
        F.expr("rpad(c_name, cast(3 + o_orderkey % 6 as int), ' ')").alias("address"),
        F.when(key % 5 != 0, F.concat(F.lit("T"), cust.cast("string"), F.lit("  "))).alias("tax_id"),
        F.date_sub(day, ((key * 13) % 900).cast("int")).alias("open_date"), day.alias("list_date"),
        F.when(key % 4 == 0, cust).alias("email_account"),
    )


def _profile_sql(edges, email, rule):
    age = ("((year(list_date) - year(open_date)) * 12 + month(list_date) - month(open_date))")
    parts = [f"count(DISTINCT CASE WHEN {age} < {edges[0]} THEN account END) AS under_{edges[0]}m"]
    parts += [f"count(DISTINCT CASE WHEN {age} >= {a} AND {age} < {b} THEN account END) AS m{a}_{b}"
              for a, b in zip(edges, edges[1:])]
    parts.append(f"count(DISTINCT CASE WHEN {age} >= {edges[-1]} THEN account END) AS from_{edges[-1]}m")
    if email:
        parts += ["count(DISTINCT email_account) AS with_email",
                  "round(count(DISTINCT email_account) / count(DISTINCT account), 9) AS pct_with_email"]
    return f"""
SELECT month, stream, {rule} AS class, count(DISTINCT account) AS accounts,
  count(DISTINCT CASE WHEN length(rtrim(phone)) = 10 THEN account END) AS with_phone,
  count(DISTINCT CASE WHEN length(rtrim(address)) > 5 THEN account END) AS with_address,
  count(DISTINCT CASE WHEN length(rtrim(tax_id)) >= 4 THEN account END) AS with_tax_id,
  {', '.join(parts)} FROM placed GROUP BY ALL"""


@query(_profile_sql((3, 6, 9, 12, 15, 18, 21, 24), True,
                    "CASE WHEN stream IN ('BUILDING') THEN 'Primes' WHEN stream IN ('MACHINERY', "
                    "'FURNITURE') THEN 'Seconds' ELSE 'Other' END"))
def placement_profile(spark, sf):
    stream = F.col("stream")
    rule = classify([(stream.isin("BUILDING"), "Primes"),
                     (stream.isin("MACHINERY", "FURNITURE"), "Seconds")], "Other")
    return scorecard.placement_profile(_placed(spark, sf), ["month", "stream"], rule).withColumn(
        "pct_with_email", F.round("pct_with_email", 9))


@query(_profile_sql((3, 6, 9, 12, 15, 18), False,
                    "CASE WHEN left(stream, 1) = 'B' THEN 'Prime' WHEN left(stream, 1) = 'M' "
                    "THEN 'Second' ELSE 'Others' END"))
def placement_profile_older(spark, sf):
    first = F.left(F.col("stream"), F.lit(1))
    rule = classify([(first == "B", "Prime"), (first == "M", "Second")], "Others")
    return scorecard.placement_profile(
        _placed(spark, sf), ["month", "stream"], rule, (3, 6, 9, 12, 15, 18), with_email=False)


cte("volumes", """
SELECT p_type AS model, l_returnflag AS client, l_linenumber AS score_group,
  date_trunc('month', l_shipdate)::DATE AS month, l_quantity AS accounts, l_suppkey % 7 AS calls,
  l_extendedprice AS payments FROM lineitem JOIN part ON l_partkey = p_partkey
""")


def _volumes(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_returnflag", "l_linenumber", "l_shipdate",
                                         "l_quantity", "l_suppkey", "l_extendedprice"])
    return lines.join(load(spark, sf, "part", ["p_partkey", "p_type"]),
                      F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("model"), F.col("l_returnflag").alias("client"),
        F.col("l_linenumber").alias("score_group"), month_start(F.col("l_shipdate")).alias("month"),
        F.col("l_quantity").alias("accounts"), (F.col("l_suppkey") % 7).alias("calls"),
        F.col("l_extendedprice").alias("payments"),
    )


@query("""
WITH old AS (SELECT * FROM volumes WHERE month <= DATE '2001-03-15'),
cur AS (SELECT model, client, month AS rpt_month, score_group, sum(accounts) AS accounts,
  CAST(sum(calls) AS BIGINT) AS calls, sum(payments) AS payments FROM volumes
  WHERE month >= DATE '2001-06-15' GROUP BY ALL),
seg AS (SELECT model, client, score_group, sum(payments) / sum(accounts) AS y FROM old GROUP BY ALL),
tot AS (SELECT model, client, sum(payments) / sum(accounts) AS ty FROM old GROUP BY ALL),
idx AS (SELECT model, client, score_group, y, y / ty AS yi FROM seg JOIN tot USING (model, client)),
pie AS (SELECT *, yi / sum(yi) OVER (PARTITION BY model, client) AS ps FROM idx)
SELECT model, client, rpt_month, score_group, accounts, calls, round(payments, 4) AS payments,
  round(calls / sum(calls) OVER (PARTITION BY model, client, rpt_month), 8) AS actual_share,
  round(y, 9) AS historic_yield, round(coalesce(ps, 0), 8) AS predicted_share,
  round(payments / accounts, 9) AS month_yield
FROM cur LEFT JOIN pie USING (model, client, score_group)
QUALIFY sum(accounts) OVER (PARTITION BY model, client, rpt_month) >= 1000
""")
def score_sloping(spark, sf):
    return scorecard.score_sloping_one_scan(
        _volumes(spark, sf), ["model", "client"], "2001-09-15",
    ).withColumns({"payments": r4("payments"), "historic_yield": F.round("historic_yield", 9),
                   "month_yield": F.round("month_yield", 9),
                   "actual_share": F.round("actual_share", 8),
                   "predicted_share": F.round("predicted_share", 8)})


@query("""
SELECT DATE '1998-05-01' AS month, source, client, count(DISTINCT account) AS accounts_worked
FROM sched WHERE due_date >= '1998-05-01' AND due_date < '1998-06-01' GROUP BY ALL
""")
def accounts_worked_monthly(spark, sf):
    star, legacy = f.sched_sources(spark, sf)
    return scorecard.accounts_worked_monthly(
        {"STAR": star, "LEGACY": legacy}, "1998-05-01", day="due_date")


@query("""
SELECT source, client, count(DISTINCT account) AS accounts_worked
FROM sched WHERE due_date >= '1998-04-01' AND due_date < '1998-06-04' GROUP BY ALL
""")
def accounts_worked_restated(spark, sf):
    """Two months stored, the second not yet complete; the load of the third day of the next
    month restates it. Counted over all three from the stored bitmaps."""
    star, legacy = f.sched_sources(spark, sf)
    path, sources = new_folder(spark, "accounts-worked"), {"STAR": star, "LEGACY": legacy}
    early = {name: df.where(F.col("due_date") < F.lit("1998-05-20").cast("date")) for name, df in sources.items()}
    write_window(
        scorecard.accounts_worked_bitmaps(early, "1998-04-01", "1998-06-01", "due_date"), path, "month")
    stored = scorecard.accounts_worked_restated(sources, path, "1998-06-03", "due_date")
    return scorecard.accounts_worked_in(stored, "1998-04-01", "1998-06-01")


@query("""
SELECT day, CASE WHEN event_type = 'click' THEN 'inbound' ELSE 'outbound' END AS feed, event_type,
  k % 5 AS service_id, count(*) AS n_records FROM ev WHERE day >= DATE '2024-01-23' GROUP BY ALL
""")
def call_stats_rolling(spark, sf):
    e = f.ev(spark, sf).withColumn("service_id", F.col("k") % 5)
    click = F.col("event_type") == "click"
    return scorecard.call_stats_rolling(
        {"inbound": e.where(click), "outbound": e.where(~click)}, ["event_type", "service_id"],
        "2024-01-30", day="day")


@query("""
SELECT session, t.account, day, result, segment FROM texts t JOIN acct ON acct.account =
  CAST(split_part(account_ref, '-', 1) AS BIGINT)
WHERE day >= '2024-01-13' AND day < '2024-01-23'
""")
def inbound_incremental(spark, sf):
    """Two overlapping loads of seven days; the second appends only new sessions."""
    people = f.acct(spark, sf).select("account", "segment")
    path = new_folder(spark, "inbound")
    calls = f.texts(spark, sf).select("session", "account_ref", "day", "result")
    key = strip_suffix(F.col("account_ref")).try_cast("bigint")
    for as_of in ("2024-01-20", "2024-01-23"):
        rows = scorecard.inbound_detail(calls, people, key, as_of, day="day")
        append_new(rows.select("session", "account", "day", "result", "segment"), path, ["session"])
    return read_table(spark, path)


@query("""
SELECT payment_id, s.account, state, segment, status FROM sched s JOIN acct ON acct.account = s.account
WHERE segment IN ('BUILDING', 'MACHINERY') OR (s.client, segment) IN
  (SELECT 'C' || n_nationkey, 'FURNITURE' FROM nation WHERE n_regionkey = 1)
""")
def allowed_rows(spark, sf):
    allow = load(spark, sf, "nation", where=F.col("n_regionkey") == 1).select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("client"),
        F.lit("FURNITURE").alias("segment"))
    out = scorecard.allowed_rows(
        f.acct(spark, sf), allow, ["client", "segment"], "segment", ["BUILDING", "MACHINERY"],
        {"payments": f.sched(spark, sf)}, detail_key="account",
    )
    return out["payments"].join(out["parents"].select("account", "state", "segment"), "account").select(
        "payment_id", "account", "state", "segment", "status")


cte("attempts", """
SELECT user_id AS account, 'P' || (k % 4) AS phone, ts, CAST(event_type = 'purchase' AS INT) AS is_contact,
  CAST(event_type = 'error' AS INT) AS is_wrong FROM ev
""")
cte("scored_phones", """
SELECT c_custkey AS account, 'P' || i AS phone, CAST((c_custkey + i) % 11 AS VARCHAR) AS score,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'A' || (c_custkey % 4) END AS activity,
  lpad(CAST(c_custkey AS VARCHAR), 9, '7') AS consumer, c_acctbal AS balance, c_mktsegment AS site,
  CASE WHEN c_custkey % 8 = 0 THEN DATE '2023-12-01' END AS cancel_date
FROM customer, (VALUES (0), (1), (2)) p(i)
""")


def _scored_phones(spark, sf):
    key = F.col("c_custkey")
    return load(spark, sf, "customer").withColumn(
        "i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    ).select(
        key.alias("account"), F.concat(F.lit("P"), F.col("i").cast("string")).alias("phone"),
        ((key + F.col("i")) % 11).cast("string").alias("score"),
        F.when(key % 3 == 0, " ").otherwise(F.concat(F.lit("A"), (key % 4).cast("string")))
        .alias("activity"),
        F.lpad(key.cast("string"), 9, "7").alias("consumer"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("site"),
        F.when(key % 8 == 0, F.lit("2023-12-01").cast("date")).alias("cancel_date"),
    )


@query("""
WITH j AS (SELECT s.* REPLACE (CASE WHEN CAST(substring(consumer, 8, 2) AS INTEGER) > 89 THEN 'Control'
             ELSE score END AS score), ts, is_contact, is_wrong
           FROM scored_phones s JOIN attempts USING (account, phone)
           WHERE ts >= '2024-01-12' AND ts < '2024-01-19'),
m AS (SELECT *, min(CASE WHEN is_contact = 1 THEN ts END) OVER w AS fc,
        min(CASE WHEN is_wrong = 1 THEN ts END) OVER w AS fw FROM j
      WINDOW w AS (PARTITION BY account, phone))
SELECT site, CASE WHEN site <> 'BUILDING' AND balance < 0 THEN 'Recovery' WHEN site <> 'BUILDING'
    THEN 'Series' ELSE 'Legal' END AS segment,
  CASE WHEN balance <= 2500 THEN '0 to 2.5k' WHEN balance >= 5000 THEN '5k & Above'
       ELSE '2.5k to 5k' END AS balance_range, score, count(*) AS attempts,
  count(DISTINCT phone) AS phones, CAST(sum(is_contact) AS BIGINT) AS contacts,
  CAST(sum(is_wrong) AS BIGINT) AS wrong, count(*) FILTER (ts = fc) AS unq_contacts,
  count(*) FILTER (ts = fw) AS unq_wrong, DATE '2024-01-12' AS week_start
FROM m GROUP BY ALL
""")
def phone_score_performance(spark, sf):
    kind, site, balance = F.col("event_type"), F.col("site"), F.col("balance")
    attempts = f.ev(spark, sf).select(
        F.col("user_id").alias("account"),
        F.concat(F.lit("P"), (F.col("k") % 4).cast("string")).alias("phone"), "ts",
        (kind == "purchase").cast("int").alias("is_contact"),
        (kind == "error").cast("int").alias("is_wrong"))
    legal = site == "BUILDING"
    segment = classify([(~legal & (balance < 0), "Recovery"), (~legal, "Series")], "Legal")
    span = F.when(balance >= 5000, "5k & Above").otherwise("2.5k to 5k")
    span = F.when(balance <= 2500, "0 to 2.5k").otherwise(span)
    return scorecard.phone_score_performance(
        _scored_phones(spark, sf), attempts, "2024-01-22", segment, span,
        control_split(F.col("consumer"), 8, 2, 89), ["site"])


@query("""
SELECT site, nullif(ltrim(activity), '') AS activity, score, count(*) AS phones FROM scored_phones
WHERE score IS NOT NULL AND cancel_date IS NULL GROUP BY ALL
""")
def phone_inventory(spark, sf):
    return scorecard.phone_inventory(_scored_phones(spark, sf), ["site"])


#: A view offers one or two kinds of event, named by their initials.
KINDS = ("click", "error", "purchase", "signup", "view")
cte("metrics", """
SELECT event_id AS metric_id, event_type AS key, ts, CASE
    WHEN event_type = 'purchase' THEN 'plan ' || (k % 7)
    WHEN event_type = 'view' AND k % 17 <> 0 THEN substr('CEPSV', CAST(1 + k % 5 AS INTEGER), 2) END AS description,
  user_id * 100 + day(ts) AS session, user_id AS account FROM ev
""")


@query("""
WITH en AS (SELECT DISTINCT session, description AS program FROM metrics WHERE key = 'purchase'),
ren AS (SELECT * REPLACE (CASE WHEN key = 'view' AND ts >= '2024-01-15'
   THEN replace(description, 'S', 'C') ELSE description END AS description) FROM metrics),
fst AS (SELECT * FROM ren r WHERE key = 'view' AND description IS NOT NULL AND ts = (
   SELECT min(ts) FROM ren q WHERE q.session = r.session AND q.key = 'view' AND q.description IS NOT NULL))
SELECT metric_id, key, ts, description, session, account, program, 'Enrolled' AS campaign,
  2 AS campaign_order, 1 AS occurrence FROM ren JOIN en USING (session)
UNION SELECT metric_id, key, ts, description, session, account, kind, 'Viewed', 1, 1
FROM fst, (SELECT DISTINCT event_type AS kind FROM events) WHERE contains(description, upper(kind[1]))
""")
def program_waterfall(spark, sf):
    k, kind = F.col("k"), F.col("event_type")
    initials = "".join(name[0].upper() for name in KINDS)
    offer = F.substring(F.lit(initials), (1 + k % 5).cast("int"), F.lit(2))
    metrics = f.ev(spark, sf).select(
        F.col("event_id").alias("metric_id"), kind.alias("key"), "ts",
        F.when(kind == "purchase", F.concat(F.lit("plan "), (k % 7).cast("string")))
        .when((kind == "view") & (k % 17 != 0), offer).alias("description"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session"),
        F.col("user_id").alias("account"))
    return scorecard.program_waterfall(
        metrics, "purchase", "view", dict(zip(initials, KINDS)), [("S", "C")], "2024-01-15")


# ---- conversations ---------------------------------------------------------------------------

EFFORT = speech.EffortRules(
    contact="A8", machine="C18", signals=("C9", "C11", "C13", "C14"),
    effort="A11", open_question="A9", closed_question="A10",
    promise_results=("Promise",),
)
cte("effort_anchor", """
SELECT h.call_id, sig.start_ms AS sig_ms, sig.category AS signal, sig.phrase AS signal_phrase,
  eff.start_ms AS eff_ms, eff.phrase AS effort_phrase, np AS n_c9, nr AS n_c11,
  nc AS n_c13, na AS n_c14
FROM (SELECT call_id, count(*) FILTER (category = 'C9') AS np,
        count(*) FILTER (category = 'C11') AS nr, count(*) FILTER (category = 'C13') AS nc,
        count(*) FILTER (category = 'C14') AS na FROM hits GROUP BY call_id
      HAVING count(*) FILTER (category = 'A8') > 0 AND count(*) FILTER (category = 'C18') = 0) h
JOIN (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY start_ms, category, phrase) AS rn
      FROM hits WHERE category IN ('C9', 'C11', 'C13', 'C14')) sig
  ON sig.call_id = h.call_id AND sig.rn = 1
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY start_ms DESC, phrase DESC) AS rn
      FROM hits WHERE category = 'A11') eff ON eff.call_id = h.call_id AND eff.rn = 1
""")


def _effort_sql(where, inside, extra):
    return f"""
SELECT c.*, signal, signal_phrase, sig_ms // 1000 AS signal_s, n_c9, n_c11, n_c13,
  n_c14, coalesce(aw, 0) AS agent_words, coalesce(cw, 0) AS customer_words,
  coalesce(oq, 0) AS open_questions, coalesce(cq, 0) AS closed_questions,
  CAST(result = 'Promise' AS INTEGER) AS promised {extra}
FROM calls c JOIN effort_anchor a USING (call_id)
LEFT JOIN (SELECT w.call_id, count(*) FILTER (speaker = 'Agent') AS aw,
             count(*) FILTER (speaker <> 'Agent') AS cw FROM words w JOIN effort_anchor a USING (call_id)
           WHERE {inside.format('w')} GROUP BY ALL) USING (call_id)
LEFT JOIN (SELECT q.call_id, count(*) FILTER (category = 'A9') AS oq,
             count(*) FILTER (category = 'A10') AS cq FROM hits q
           JOIN effort_anchor a USING (call_id) WHERE {inside.format('q')} GROUP BY ALL) USING (call_id)
{where}"""


@query(_effort_sql(
    "WHERE eff_ms > sig_ms",
    "{0}.start_ms // 1000 BETWEEN sig_ms // 1000 AND eff_ms // 1000",
    """, effort_phrase, eff_ms // 1000 AS effort_s, eff_ms // 1000 - sig_ms // 1000 AS gap_s,
  CASE WHEN eff_ms // 1000 - sig_ms // 1000 <= 120 THEN 'A.00-120 Seconds'
       WHEN eff_ms // 1000 - sig_ms // 1000 <= 240 THEN 'B.121-240 Seconds'
       WHEN eff_ms // 1000 - sig_ms // 1000 <= 360 THEN 'C.241-360 Seconds'
       WHEN eff_ms // 1000 - sig_ms // 1000 <= 480 THEN 'D.361-480 Seconds'
       ELSE 'E.480+ Seconds' END AS gap_band"""))
def conversation_effort(spark, sf):
    return speech.conversation_effort(
        f.calls(spark, sf), f.transcript(spark, sf), None, EFFORT)


@query(_effort_sql("", "{0}.start_ms // 1000 >= sig_ms // 1000", ""))
def conversation_profile(spark, sf):
    return speech.conversation_effort(
        f.calls(spark, sf), f.transcript(spark, sf), None, EFFORT, form="profile")


cte("programs", """
SELECT * FROM (VALUES ('First', 'A9', 'C11'), ('Second', 'A10', 'C9'),
  ('Third', 'A11', 'C13')) p(program, offer, success)
""")


@query("""
SELECT DISTINCT program, CAST(x.call_id AS VARCHAR) AS call_id, CAST(x.account AS VARCHAR) AS account,
  client, CAST(coalesce(o, s) // 1000 AS VARCHAR) AS offer_s, CAST(CAST(s IS NOT NULL AS INT) AS VARCHAR)
  AS succeeded, CAST(coalesce(s, 0) // 1000 AS VARCHAR) AS success_s,
  CASE program WHEN 'First' THEN segment WHEN 'Second' THEN name ELSE CAST(list_date AS VARCHAR) END
    AS detail_1,
  CASE program WHEN 'First' THEN CAST(list_date AS VARCHAR) END AS detail_2,
  CAST(NULL AS VARCHAR) AS detail_3, CAST(NULL AS VARCHAR) AS detail_4
FROM (SELECT program, c.call_id, c.account, c.client, segment, name, list_date, nation,
        min(CASE WHEN category = offer THEN start_ms END) AS o,
        min(CASE WHEN category = success THEN start_ms END) AS s
      FROM calls c JOIN hits h ON h.call_id = c.call_id CROSS JOIN programs
      JOIN (SELECT account, segment, name, list_date, nation FROM acct) a ON a.account = c.account
      GROUP BY ALL) x
WHERE coalesce(o, s) IS NOT NULL AND (
  (program = 'First' AND nation > 4 AND client <> 'C1') OR (program = 'Second' AND segment <> 'BUILDING')
  OR (program = 'Third' AND s IS NOT NULL AND coalesce(o, s) // 1000 < s // 1000))
""")
def offer_success(spark, sf):
    people = f.acct(spark, sf).select("account", "segment", "name", "list_date", "nation")
    programs = [
        speech.Program("First", "A9", "C11", F.col("nation") > 4,
                       ("segment", "list_date"), call_filter=F.col("client") != "C1"),
        speech.Program("Second", "A10", "C9", F.col("segment") != "BUILDING",
                       ("name",)),
        speech.Program("Third", "A11", "C13", F.lit(True), ("list_date",),
                       success_after_offer=True),
    ]
    return speech.offer_success(f.calls(spark, sf), f.hits(spark, sf), people, programs)


VOICE = speech.VoiceRules(
    supervisor="A15", openings=("A13", "A16"),
    signals=("C9", "C11", "C13", "C14"), script="A7",
    script_ignored=("the",),
)
cte("phrase_groups", """
SELECT DISTINCT category, phrase, 'G' || (length(phrase) % 2) || left(phrase, 1) AS grp FROM hits
""")


def _groups(spark, sf):
    return f.hits(spark, sf).select(
        "category", "phrase",
        F.concat(F.lit("G"), (F.length("phrase") % 2).cast("string"),
                 F.left(F.col("phrase"), F.lit(1))).alias("grp")).distinct()


@query("""
WITH t AS (SELECT *, start_ms // 1000 AS sec FROM hits),
v AS (SELECT call_id, max(sec) AS vs FROM t WHERE category = 'A15' GROUP BY 1),
o AS (SELECT call_id, max(sec) AS opening_s FROM t WHERE category IN ('A13', 'A16')
      AND sec <= 180 GROUP BY 1),
s AS (SELECT call_id, max(sec) AS ss FROM t WHERE category = 'A7' AND phrase NOT IN ('the') GROUP BY 1),
g AS (SELECT t.*, CASE WHEN vs > sec THEN 'A' ELSE 'S' END AS side FROM t JOIN v USING (call_id)
      WHERE category IN ('C9', 'C11', 'C13', 'C14')
      QUALIFY row_number() OVER (PARTITION BY call_id, side ORDER BY start_ms, category, phrase) = 1),
b AS (SELECT c.*, opening_s, vs, ss,
   CASE WHEN vs IS NULL THEN 'Not Applicable' ELSE coalesce(a.category, 'No Content') END AS agent_category,
   CASE WHEN vs IS NULL THEN 'Not Applicable' ELSE coalesce(a.phrase, 'No Language') END AS agent_phrase,
   coalesce(a.sec, 0) AS agent_signal_s,
   CASE WHEN vs IS NULL THEN 'Not Applicable' ELSE coalesce(x.category, 'No Content') END
     AS supervisor_category,
   CASE WHEN vs IS NULL THEN 'Not Applicable' ELSE coalesce(x.phrase, 'No Language') END
     AS supervisor_phrase, coalesce(x.sec, 0) AS supervisor_signal_s
  FROM calls c JOIN o USING (call_id) LEFT JOIN v USING (call_id) LEFT JOIN s USING (call_id)
  LEFT JOIN (SELECT * FROM g WHERE side = 'A') a ON a.call_id = c.call_id
  LEFT JOIN (SELECT * FROM g WHERE side = 'S') x ON x.call_id = c.call_id),
n AS (SELECT b.*, CASE WHEN agent_category IN ('Not Applicable', 'No Content') THEN agent_category
    ELSE p.grp END AS agent_group,
    CASE WHEN supervisor_category IN ('Not Applicable', 'No Content') THEN supervisor_category
    ELSE q.grp END AS supervisor_group
  FROM b LEFT JOIN phrase_groups p ON p.category = agent_category AND p.phrase = agent_phrase
  LEFT JOIN phrase_groups q ON q.category = supervisor_category AND q.phrase = supervisor_phrase)
SELECT call_id, opening_s, coalesce(vs, 0) AS voice_s, coalesce(ss, 0) AS script_s, agent_category,
  agent_phrase, agent_signal_s, supervisor_category, supervisor_phrase, supervisor_signal_s, agent_group,
  supervisor_group, CAST(vs IS NOT NULL AS INTEGER) AS second_voice,
  CAST(ss IS NOT NULL AS INTEGER) AS has_script, duration_s - silence_s AS talk_s,
  CASE WHEN vs IS NOT NULL THEN duration_s - vs ELSE 0 END AS supervisor_s,
  CASE WHEN vs IS NOT NULL THEN vs ELSE duration_s END AS agent_s,
  CAST(result_class = 'PTP' AS INTEGER) AS promised,
  CASE WHEN agent_group = 'No Content' AND supervisor_group = 'Not Applicable' THEN 0
       WHEN agent_group = supervisor_group THEN 0 ELSE 1 END AS behaviour_changed
FROM n
""")
def second_voice_shift(spark, sf):
    return speech.second_voice_shift(
        f.calls(spark, sf), f.hits(spark, sf), _groups(spark, sf), VOICE
    ).drop("account", "client", "duration_s", "silence_s", "direction", "result", "result_class",
           "is_contact", "is_connect", "session")


SCRIPT = speech.ScriptRules(
    recording="A12", purpose="A14", creditor="A13", balance="A16",
    voice="A15", signals=("C9", "C11", "C13", "C14"), effort="A11",
    negotiation="A17", open_question="A9", closed_question="A10",
    verification="A6", dissatisfaction="C15",
    severity=(("t", 0.0), ("a", 0.5), ("o", 0.75)),
)


@query("""
WITH rec AS (SELECT session, call_id FROM calls WHERE call_id % 6 <> 5),
t AS (SELECT DISTINCT call_id, category, phrase, start_ms // 1000 AS sec FROM hits
      WHERE call_id IN (SELECT call_id FROM rec)),
f AS (SELECT call_id, min(sec) FILTER (category = 'A12') AS recording_s,
   min(sec) FILTER (category = 'A14') AS purpose_s, min(sec) FILTER (category = 'A13') AS creditor_s,
   min(sec) FILTER (category = 'A16') AS balance_s, min(sec) FILTER (category = 'A15') AS second_voice_s,
   max(sec) FILTER (category = 'A11') AS effort_s, min(sec) FILTER (category = 'A17') AS n0,
   max(sec) FILTER (category = 'A17') AS n1, min(sec) FILTER (category = 'A6') AS verification_s,
   coalesce(min(sec) FILTER (category = 'A16'), min(sec) FILTER (category = 'A13'), 0) AS opening_s
  FROM t GROUP BY call_id),
sg AS (SELECT t.*, sec >= opening_s AS after FROM t JOIN f USING (call_id)
  WHERE category IN ('C9', 'C11', 'C13', 'C14')
  QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY sec >= opening_s DESC, sec, category, phrase) = 1),
qs AS (SELECT call_id, count(*) FILTER (category = 'A9') AS open_questions,
   count(*) FILTER (category = 'A10') AS closed_questions FROM t JOIN f USING (call_id)
  WHERE sec >= opening_s AND category IN ('A9', 'A10') GROUP BY call_id),
ds AS (SELECT call_id, count(*) FILTER (phrase LIKE 't%') AS n_t, count(*) FILTER (phrase LIKE 'a%') AS n_a,
   count(*) FILTER (phrase LIKE 'o%') AS n_o FROM t WHERE category = 'C15' GROUP BY call_id),
dw AS (SELECT call_id, phrase AS worst_phrase, sec AS worst_s FROM t WHERE category = 'C15'
  QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY CASE WHEN phrase LIKE 't%' THEN 1
    WHEN phrase LIKE 'a%' THEN 2 ELSE 3 END, sec, phrase) = 1),
j AS (SELECT c.* EXCLUDE (call_id), r.call_id, f.* EXCLUDE (call_id), sg.category AS signal,
   sg.phrase AS signal_phrase, sg.sec AS signal_s, n_t, n_a, n_o, worst_phrase, worst_s, pg.grp AS signal_group,
   open_questions, closed_questions
  FROM calls c LEFT JOIN rec r ON r.session = c.session LEFT JOIN f ON f.call_id = r.call_id
  LEFT JOIN sg ON sg.call_id = r.call_id LEFT JOIN qs ON qs.call_id = r.call_id
  LEFT JOIN ds ON ds.call_id = r.call_id LEFT JOIN dw ON dw.call_id = r.call_id
  LEFT JOIN (SELECT DISTINCT phrase, grp FROM phrase_groups) pg ON pg.phrase = sg.phrase),
p AS (SELECT *, call_id IS NOT NULL AS rec, call_id IS NOT NULL AND is_contact = 1 AS rc FROM j)
SELECT session, call_id, recording_s, purpose_s, creditor_s, balance_s, opening_s, verification_s, second_voice_s,
  signal, signal_phrase, signal_s, signal_group, effort_s, n1 - n0 AS negotiation_s, n0 - opening_s AS probing_s,
  open_questions, closed_questions, CASE WHEN rec THEN coalesce(n_t, 0) END AS n_t,
  CASE WHEN rec THEN coalesce(n_a, 0) END AS n_a, CASE WHEN rec THEN coalesce(n_o, 0) END AS n_o, worst_phrase, worst_s,
  CASE WHEN rec THEN round(CASE WHEN n_t IS NULL THEN 1 WHEN n_t > 0 THEN 0 WHEN n_a > 0 THEN 0.5
    WHEN n_o > 0 THEN 0.75 ELSE 0 END::DOUBLE, 4) END AS dissat_score,
  CAST(rec AND (result_class = 'TPC' OR is_contact = 1) AS INT) AS recording_opp,
  CAST(rc AND duration_s > 60 AS INT) AS purpose_opp, CAST(rc AND duration_s > 90 AS INT) AS creditor_opp,
  CAST(rc AND duration_s > 120 AS INT) AS balance_opp, CAST(rc AND duration_s > 240 AS INT) AS negotiation_opp,
  CAST(rc AND duration_s > 240 AND direction = 'INBOUND' AS INT) AS verification_opp,
  CAST(rec AND (result_class = 'TPC' OR is_contact = 1) AND recording_s IS NOT NULL AS INT) AS recording_hit,
  CAST(rc AND duration_s > 60 AND purpose_s IS NOT NULL AS INT) AS purpose_hit,
  CAST(rc AND duration_s > 90 AND creditor_s IS NOT NULL AS INT) AS creditor_hit,
  CAST(rc AND duration_s > 120 AND balance_s IS NOT NULL AS INT) AS balance_hit,
  CAST(rc AND duration_s > 240 AND n0 IS NOT NULL AS INT) AS negotiation_hit,
  CAST(rc AND duration_s > 240 AND direction = 'INBOUND' AND verification_s IS NOT NULL AS INT) AS verification_hit,
  CAST(duration_s > 60 AS INT) AS dissat_opp, CAST(is_connect = 1 AND duration_s >= 30 AS INT) AS speech_eligible,
  CAST(is_connect = 1 AND duration_s >= 30 AND rec AS INT) AS speech_complete,
  CAST(is_connect = 1 AND duration_s < 60 AS INT) AS early_hangup,
  CAST(second_voice_s IS NOT NULL AS INT) AS second_voice
FROM p
""")
def script_adherence(spark, sf):
    c = f.calls(spark, sf)
    recordings = c.where(F.col("call_id") % 6 != 5).select("session", "call_id")
    return speech.script_adherence(
        c.drop("call_id"), recordings, f.hits(spark, sf),
        _groups(spark, sf), SCRIPT
    ).drop("account", "client", "duration_s", "silence_s", "direction", "result", "result_class",
           "is_contact", "is_connect")
