"""The driver tables seen as the reports' inputs: one Spark frame and one SQL expression each.

events = message / interaction log, orders = scheduled payments and payments, customer and
nation = accounts and clients, lineitem and part = score volumes, conversations = calls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog.base import cte
from dunlin.sources.scans import load

# ---- events ------------------------------------------------------------------------------

cte("ev", """
SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type, value,
       CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
FROM events
""")


def ev(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), "user_id", "event_type",
        "value", F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


cte("msgs", """
SELECT user_id * 10 + k % 10 AS guid, ts, event_id,
  CASE WHEN event_type = 'signup' AND k % 8 = 5 THEN 13 WHEN event_type = 'signup' THEN 10
       WHEN event_type = 'error' THEN 8 WHEN event_type = 'view' THEN 5 WHEN k % 20 = 0 THEN 6
       WHEN k % 20 = 1 THEN 9 WHEN k % 20 = 2 THEN 100 ELSE 12 END AS code,
  CASE WHEN event_type = 'signup' AND k % 8 = 5 THEN
         CASE k % 3 WHEN 0 THEN 'Undeliverable' WHEN 1 THEN 'Bad-Record' ELSE 'Opt-Out' END
       WHEN event_type <> 'error' THEN NULL WHEN k % 4 = 0 THEN 'Hard-Bounce'
       WHEN k % 4 = 1 THEN 'NotInWhiteList' WHEN k % 4 = 2 THEN 'Opt-Out'
       ELSE 'Soft-Bounce' END AS detail,
  CASE WHEN k % 7 = 3 THEN 'Blocked' END AS value, 'V' || (k % 3) AS vendor,
  1 + k % 3 AS n_events, user_id AS account, 'C' || (user_id % 4) AS client,
  2 + user_id % 4 AS crm, 'L' || ((k % 10) % 3) AS letter,
  'u' || user_id || '@d' || (user_id % 5) || '.example' AS email,
  's' || ((k % 10) % 2) AS send_domain
FROM ev WHERE event_type <> 'purchase'
""")


def msgs(spark, sf):
    e, k, kind, user = ev(spark, sf), F.col("k"), F.col("event_type"), F.col("user_id")
    scrubbed = (kind == "signup") & (k % 8 == 5)
    why = F.when(k % 3 == 0, "Undeliverable").when(k % 3 == 1, "Bad-Record").otherwise("Opt-Out")
    code = (
        F.when(scrubbed, 13).when(kind == "signup", 10).when(kind == "error", 8).when(kind == "view", 5)
        .when(k % 20 == 0, 6).when(k % 20 == 1, 9).when(k % 20 == 2, 100).otherwise(12)
    )
    detail = (
        F.when(scrubbed, why).when(kind != "error", F.lit(None)).when(k % 4 == 0, "Hard-Bounce")
        .when(k % 4 == 1, "NotInWhiteList").when(k % 4 == 2, "Opt-Out").otherwise("Soft-Bounce")
    )
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    return e.where(kind != "purchase").select(
        (user * 10 + k % 10).alias("guid"), "ts", "event_id", code.alias("code"),
        detail.alias("detail"), F.when(k % 7 == 3, "Blocked").alias("value"),
        text("V", k % 3).alias("vendor"), (1 + k % 3).alias("n_events"), user.alias("account"),
        text("C", user % 4).alias("client"), (2 + user % 4).alias("crm"),
        text("L", (k % 10) % 3).alias("letter"),
        F.concat(F.lit("u"), user.cast("string"), F.lit("@d"), (user % 5).cast("string"),
                 F.lit(".example")).alias("email"),
        text("s", (k % 10) % 2).alias("send_domain"),
    )


cte("pays", """
SELECT event_id AS payment_id, user_id AS account, 2 + user_id % 4 AS crm, day AS pay_date,
       value AS amount, k FROM ev WHERE event_type = 'purchase'
""")
cte("revs", """
SELECT account, crm, CASE WHEN k % 2 = 0 THEN -amount ELSE amount END AS amount,
       pay_date + CAST(k % 60 AS INTEGER) AS pay_date
FROM pays WHERE k % 3 = 0
""")


def pays(spark, sf):
    return ev(spark, sf).where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.col("user_id").alias("account"),
        (2 + F.col("user_id") % 4).alias("crm"), F.col("day").alias("pay_date"),
        F.col("value").alias("amount"), "k",
    )


def revs(spark, sf):
    """Reversals: every third payment comes back, with either sign, 0 to 59 days later."""
    p = pays(spark, sf).where(F.col("k") % 3 == 0)
    return p.select(
        "account", "crm",
        F.when(F.col("k") % 2 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.date_add("pay_date", F.col("k") % 60).alias("pay_date"),
    )


def by_reference(spark, sf):
    """Payments and returned payments of the second source (system 5), told apart by ``k``; a
    return carries the reference of the payment it undoes."""
    rows = pays(spark, sf).where(F.col("crm") == 5).withColumn(
        "reference", F.concat(F.lit("R"), (F.col("k") % 4).cast("string")))
    return rows.where(F.col("k") % 10 < 7), rows.where(F.col("k") % 10 >= 7)


cte("texts", """
SELECT event_id AS session, ts, day, user_id AS account, user_id || '-' || (k % 3) AS account_ref,
  'C' || (user_id % 4) AS client,
  CASE event_type WHEN 'signup' THEN 'Delivered' WHEN 'error' THEN 'Failed'
       WHEN 'view' THEN 'Reply' WHEN 'click' THEN 'Transfer' ELSE 'Stop' END AS result,
  'Service ' || (k % 5) AS service_name, '555' || (user_id % 7) || (k % 3) AS phone,
  CASE WHEN k % 2 = 0 THEN 'L' || (k % 3) END AS letter,
  CASE WHEN k % 6 = 0 THEN 'A3' WHEN k % 6 = 1 THEN 'B1' END AS platform,
  'Name ' || (user_id % 50) AS full_name, k
FROM ev
""")


def texts(spark, sf):
    kind, user, k = F.col("event_type"), F.col("user_id"), F.col("k")
    result = (
        F.when(kind == "signup", "Delivered").when(kind == "error", "Failed")
        .when(kind == "view", "Reply").when(kind == "click", "Transfer").otherwise("Stop")
    )
    s = lambda c: c.cast("string")
    return ev(spark, sf).select(
        F.col("event_id").alias("session"), "ts", "day", user.alias("account"),
        F.concat(s(user), F.lit("-"), s(k % 3)).alias("account_ref"),
        F.concat(F.lit("C"), s(user % 4)).alias("client"), result.alias("result"),
        F.concat(F.lit("Service "), s(k % 5)).alias("service_name"),
        F.concat(F.lit("555"), s(user % 7), s(k % 3)).alias("phone"),
        F.when(k % 2 == 0, F.concat(F.lit("L"), s(k % 3))).alias("letter"),
        F.when(k % 6 == 0, "A3").when(k % 6 == 1, "B1").alias("platform"),
        F.concat(F.lit("Name "), s(user % 50)).alias("full_name"), "k",
    )


# ---- accounts and schedules ------------------------------------------------------------------

cte("acct", """
SELECT c_custkey AS account, 'C' || c_nationkey AS client, n_name AS state,
       DATE '1994-01-01' + CAST(c_custkey % 2500 AS INTEGER) AS list_date,
       CASE WHEN c_custkey % 10 = 0 THEN NULL
            ELSE DATE '1994-06-01' + CAST(c_custkey % 2500 - (c_custkey * 7) % 5800 AS INTEGER)
       END AS charge_off_date,
       c_acctbal AS initial_balance, c_mktsegment AS segment, c_name AS name, c_nationkey AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")


def acct(spark, sf):
    key = F.col("c_custkey")
    customer = load(spark, sf, "customer").join(
        load(spark, sf, "nation", ["n_nationkey", "n_name"]),
        F.col("c_nationkey") == F.col("n_nationkey"), "left",
    )
    off = F.date_add(
        F.lit("1994-06-01").cast("date"), (key % 2500 - (key * 7) % 5800).cast("int")
    )
    return customer.select(
        key.alias("account"), F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("client"),
        F.col("n_name").alias("state"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 2500).cast("int")).alias("list_date"),
        F.when(key % 10 != 0, off).alias("charge_off_date"),
        F.col("c_acctbal").alias("initial_balance"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
    )


cte("acct2", """
SELECT acct.*, source FROM acct, (VALUES ('STAR'), ('LEGACY')) s(source)
""")


def acct2(spark, sf):
    """Accounts under both source systems."""
    both = F.array(F.lit("STAR"), F.lit("LEGACY"))
    return acct(spark, sf).withColumn("source", F.explode(both))


cte("sched", """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'STAR' ELSE 'LEGACY' END
         AS source,
       o_orderkey AS payment_id, o_custkey AS account, 'C' || c_nationkey AS client,
       CAST(o_orderdate AS DATE) AS due_date, o_totalprice AS amount,
       CASE WHEN o_orderstatus = 'F'
            THEN CAST(o_orderdate AS DATE) - CAST(o_orderkey % 200 AS INTEGER) END AS broken_date,
       o_orderstatus AS status
FROM orders JOIN customer ON o_custkey = c_custkey
""")


def sched(spark, sf):
    o = load(spark, sf, "orders").join(
        load(spark, sf, "customer", ["c_custkey", "c_nationkey"]),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    star = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    day = F.col("o_orderdate").cast("date")
    broken = F.date_sub(day, (F.col("o_orderkey") % 200).cast("int"))
    return o.select(
        F.when(star, "STAR").otherwise("LEGACY").alias("source"),
        F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("account"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("client"),
        day.alias("due_date"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", broken).alias("broken_date"),
        F.col("o_orderstatus").alias("status"),
    )


def sched_sources(spark, sf):
    s = sched(spark, sf)
    return [s.where(F.col("source") == name) for name in ("STAR", "LEGACY")]


# ---- conversations -----------------------------------------------------------------------------

cte("words", r"""
SELECT conv_id AS call_id, CASE WHEN role = 'assistant' THEN 'Agent' ELSE 'Customer' END AS speaker,
       lower(w.word) AS word, turn * 60000 + (w.pos - 1) * 400 AS start_ms
FROM conversations,
     unnest(regexp_split_to_array(text, '\s+')) WITH ORDINALITY AS w(word, pos)
""")


def words(spark, sf):
    c = load(spark, sf, "conversations")
    return c.select(
        "conv_id", "turn", "role", F.posexplode(F.split("text", r"\s+")).alias("pos", "word")
    ).select(
        F.col("conv_id").alias("call_id"),
        F.when(F.col("role") == "assistant", "Agent").otherwise("Customer").alias("speaker"),
        F.lower("word").alias("word"),
        (F.col("turn") * 60000 + F.col("pos") * 400).alias("start_ms"),
    )


# a category hit is a word of some length; the category names the speaker and the length (A11, C9)
HIT_LENGTHS = {"A": range(6, 18), "C": (9, 11, 13, 14, 15, 18)}
cte("hits", f"""
SELECT call_id, start_ms, word AS phrase, speaker[1] || length(word) AS category FROM words
WHERE {' OR '.join(f"(speaker[1] = '{who}' AND length(word) IN ({', '.join(map(str, n))}))" for who, n in HIT_LENGTHS.items())}
""")


def transcript(spark, sf):
    """Every word with its speaker, and its category if it is a hit."""
    who, n = F.left(F.col("speaker"), F.lit(1)), F.length("word")
    is_hit = F.lit(False)
    for letter, lengths in HIT_LENGTHS.items():
        is_hit = is_hit | ((who == letter) & n.isin(*lengths))
    return words(spark, sf).select(
        "call_id", "start_ms", "speaker", F.col("word").alias("phrase"),
        F.when(is_hit, F.concat(who, n.cast("string"))).alias("category"))


def hits(spark, sf):
    return transcript(spark, sf).where(F.col("category").isNotNull()).drop("speaker")


cte("calls", """
SELECT conv_id AS call_id, conv_id AS account, 'C' || (conv_id % 5) AS client,
       (max(turn) + 1) * 60 AS duration_s, 5 * (conv_id % 9) AS silence_s,
       CASE WHEN conv_id % 3 = 0 THEN 'INBOUND' ELSE 'OUTBOUND' END AS direction,
       CASE WHEN conv_id % 4 = 0 THEN 'Promise' ELSE 'Talk' END AS result,
       CASE WHEN conv_id % 4 = 0 THEN 'PTP' WHEN conv_id % 4 = 1 THEN 'TPC' ELSE 'RPC' END
         AS result_class,
       CAST(conv_id % 4 IN (0, 2) AS INTEGER) AS is_contact,
       CAST(conv_id % 5 <> 0 AS INTEGER) AS is_connect, 's' || conv_id AS session
FROM conversations GROUP BY conv_id
""")


def calls(spark, sf):
    c = load(spark, sf, "conversations", ["conv_id", "turn"])
    key = F.col("conv_id")
    return c.groupBy("conv_id").agg(((F.max("turn") + 1) * 60).alias("duration_s")).select(
        key.alias("call_id"), key.alias("account"),
        F.concat(F.lit("C"), (key % 5).cast("string")).alias("client"), "duration_s",
        (5 * (key % 9)).alias("silence_s"),
        F.when(key % 3 == 0, "INBOUND").otherwise("OUTBOUND").alias("direction"),
        F.when(key % 4 == 0, "Promise").otherwise("Talk").alias("result"),
        F.when(key % 4 == 0, "PTP").when(key % 4 == 1, "TPC").otherwise("RPC").alias("result_class"),
        (key % 4).isin(0, 2).cast("int").alias("is_contact"),
        (key % 5 != 0).cast("int").alias("is_connect"),
        F.concat(F.lit("s"), key.cast("string")).alias("session"),
    )


def r4(col):
    """Floats are compared after rounding on both sides."""
    return F.round(F.col(col) if isinstance(col, str) else col, 4)
