"""Message reports: attribution, clicks, funnels, channel summaries and the contact log.

Canonical message event columns: guid, ts, code, value, detail, vendor, n_events, account,
client, crm, letter, email, send_domain. Event codes are arguments (``Codes``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.functions.dates import as_date, day_diff, prev_month
from dunlin.functions.labels import map_outcome
from dunlin.functions.text import email_domain, strip_suffix
from dunlin.operators.aggregates import any_flag, distinct_flags, sum_where
from dunlin.operators.joins import asof_join, assemble, match_by_reference, match_reversals, semi
from dunlin.operators.sets import union_distinct
from dunlin.operators.slices import Hot, find_hot
from dunlin.operators.windows import backfill_two_stage, prev_value
from dunlin.sources.checkpoints import cut_lineage
from dunlin.sources.scans import range_scan
from dunlin.sources.sinks import presence_checks, read_table, write_upsert, write_window


@dataclass(frozen=True)
class Codes:
    """Event codes and outcome texts of the message event stream. The vendor
    whose value texts mean a bounce is deployment specific."""

    sent: int = 10
    failed: int = 8
    scrubbed: int = 13
    opened: int = 5
    clicked: int = 12
    opted_out: int = 6
    spam: tuple = (9, 100)
    bounce_details: tuple = ("Hard-Bounce", "Hard Bounce")
    bounce_values: tuple = ("INVALID_EMAIL", "Blocked", "BOUNCE")
    bounce_vendor: str = ""
    not_allowed: str = "NotInWhiteList"
    opt_out: str = "Opt-Out"
    soft_bounce: str = "Soft-Bounce"
    undeliverable: tuple = ("Undeliverable", "Bad-Record", "Bad Record")


CODES = Codes()


def outcome_flags(c: Codes = CODES) -> dict[str, Column]:
    """Row-level tests of the send outcomes."""
    code, detail = F.col("code"), F.col("detail")
    stopped = code.isin(c.failed, c.scrubbed)
    vendor_bounce = F.col("value").isin(*c.bounce_values) & (F.col("vendor") == c.bounce_vendor)
    return {
        "delivered": code == c.sent,
        "bounced": (code == c.failed) & (detail.isin(*c.bounce_details) | vendor_bounce),
        "not_allowed": stopped & (detail == c.not_allowed),
        "opted_out_before": stopped & (detail == c.opt_out),
        "invalid": ((code == c.failed) & (detail == c.soft_bounce))
        | ((code == c.scrubbed) & detail.isin(*c.undeliverable)),
    }


def last_touch(
    payments: DataFrame, touches: DataFrame, keys: Sequence[str], pay_day: str, touch_ts: str,
    touch_id: str, days: int, hot: Hot | None = None,
) -> DataFrame:
    """Credit each payment to the touch with the smallest day distance in ``0..days``.

    Touches of one day count for payments of the same day. The latest touch of a day wins
    (then the largest id), so the nearest touch is the last one up to the payment's day: an
    as-of join, which produces no payment x touch pairs."""
    by_day = touches.withColumn("__touch_day", F.col(touch_ts).cast("date").cast("timestamp_ntz"))
    pays = payments.withColumn("__pay_day", F.col(pay_day).cast("date").cast("timestamp_ntz"))
    hit = asof_join(
        pays, by_day, list(keys), "__pay_day", "__touch_day", [touch_id], tie=[touch_ts, touch_id],
        hot=hot,
    )
    gap = day_diff(F.col("__touch_day"), F.col("__pay_day"))
    return (
        hit.withColumn("days_from_touch", gap)
        .where(F.col(touch_id).isNotNull() & F.col("days_from_touch").between(0, days))
        .drop("__touch_day", "__pay_day")
    )


def message_attribution(
    events: DataFrame, payments: DataFrame, reversals: DataFrame, as_of, replay_days: int = 60,
    stored: DataFrame | None = None, pay_days: int = 15, reversal_days: int = 45,
    codes: Codes = CODES, referenced: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One row per message id with its outcome, responses and attributed payments.

    * ids: all with an event after ``as_of - replay_days``; all their events count
    * clicks are 0 when the message was opted out or marked as spam
    * payments go to the last opened message within ``pay_days`` and are netted by the
      absolute amount of a reversal within ``reversal_days`` after them; they count only for
      opened messages
    * ``referenced`` (payments, reversals) of a second source carry a ``reference``: its
      payments are attributed in the same way and netted by the absolute amount of the
      reversals with the same account and reference under another ``payment_id``
    * ``stored`` (the report so far) contributes earlier first-send dates, which are kept by
      (crm, client, account)

    All event-type aggregates come from one pass over the events of those ids instead of one
    scan each.
    """
    since = as_date(as_of) - dt.timedelta(days=replay_days)
    since = F.lit(str(since)).cast(events.schema["ts"].dataType)
    # the ids of the window first (the date filter reaches the scan), then only their events
    recent = events.where(F.col("ts") > since).select("guid").distinct()
    parts = message_parts(semi(events, recent, "guid"), codes)
    opened_log = events.where(F.col("code") == codes.opened).select("crm", "account", "guid", "ts")
    return _attribute(parts, opened_log, payments, reversals, stored, pay_days, reversal_days, codes, referenced)


SEND_COLUMNS = ("crm", "client", "letter", "account", "email", "send_domain")
RESPONSES = ("total_opens", "clicks_all", "marked_as_spam", "optouts")


def message_parts(events: DataFrame, codes: Codes = CODES) -> DataFrame:
    """Aggregates per message id that can be merged: last event, first send, outcome flags and
    response counts. Parts of disjoint sets of events merge into the part of their union."""
    c, n = F.col("code"), F.col("n_events")
    is_send = c.isin(codes.failed, codes.sent, codes.scrubbed)
    tests = (c == codes.opened, c == codes.clicked, c.isin(*codes.spam), c == codes.opted_out)
    return events.groupBy("guid").agg(
        F.max("ts").alias("last_event"),
        F.min(F.when(is_send, F.struct("ts", "code", *SEND_COLUMNS))).alias("first_send"),
        *[any_flag(pred).cast("bigint").alias(name) for name, pred in outcome_flags(codes).items()],
        *[sum_where(n, test, zero=False).alias(name) for name, test in zip(RESPONSES, tests)],
    )


def merge_parts(parts: DataFrame, codes: Codes = CODES) -> DataFrame:
    """One part per message id."""
    return parts.groupBy("guid").agg(
        F.max("last_event").alias("last_event"), F.min("first_send").alias("first_send"),
        *[F.max(name).alias(name) for name in outcome_flags(codes)],
        *[F.sum(name).alias(name) for name in RESPONSES],
    )


def _attribute(parts, opened_log, payments, reversals, stored, pay_days, reversal_days, codes, referenced):
    """The report of ``message_attribution`` from one part per message and the opens."""
    sends = parts.where(F.col("first_send").isNotNull()).select(
        "guid", F.col("first_send.ts").cast("date").alias("send_date"),
        *[F.col(f"first_send.{a}").alias(a) for a in SEND_COLUMNS], *outcome_flags(codes), *RESPONSES,
    )
    sends = cut_lineage(sends)  # used three times below; one row per message
    send_keys = ["crm", "client", "account"]
    first_send = sends.select(*send_keys, "send_date")
    if stored is not None:
        first_send = first_send.unionByName(stored.select(*send_keys, "send_date"))
    first_send = first_send.groupBy(*send_keys).agg(F.min("send_date").alias("first_send_date"))

    keys = ["crm", "account"]
    opens = semi(opened_log, sends, "guid")
    paid = payments.where(F.col("amount") > 0)
    # large accounts, counted once on the sources: every step below only narrows their rows
    sources = opened_log.select(*keys).unionByName(paid.select(*keys))
    if referenced is not None:
        paid_by_ref = referenced[0].where(F.col("amount") > 0)
        sources = sources.unionByName(paid_by_ref.select(*keys))
    hot = find_hot(sources.unionByName(reversals.select(*keys)), keys)
    touched = last_touch(paid, opens, keys, "pay_date", "ts", "guid", pay_days, hot)
    netted = match_reversals(
        touched, reversals, keys, "amount", "pay_date", "pay_date", reversal_days, hot
    )
    net = (F.col("amount") - F.coalesce("reversed_amount", F.lit(0))).alias("net")
    netted = netted.select("guid", net)
    if referenced is not None:
        by_ref = last_touch(paid_by_ref, opens, keys, "pay_date", "ts", "guid", pay_days, hot)
        netted = netted.unionByName(match_by_reference(
            by_ref, referenced[1], keys, "reference", "payment_id", "amount").select("guid", net))
    pays = netted.groupBy("guid").agg(F.sum("net").alias("paid"))

    zero = lambda col: F.coalesce(F.col(col), F.lit(0))
    opened = zero("total_opens") > 0
    unwanted = F.col("optouts").isNotNull() | F.col("marked_as_spam").isNotNull()
    return (
        sends.join(pays, "guid", "left")
        .join(first_send, send_keys, "left")
        .select(
            "guid", "send_date", "crm", "client", "letter", "account",
            email_domain(F.col("email")).alias("email_domain"), "send_domain",
            (F.col("delivered") + F.col("bounced") + F.col("not_allowed")
             + F.col("opted_out_before") + F.col("invalid")).alias("requested"),
            F.col("not_allowed").alias("whitelist_scrubbed"),
            F.col("opted_out_before").alias("optout_scrubbed"),
            F.col("invalid").alias("invalid_scrubbed"),
            (F.col("delivered") + F.col("bounced")).alias("sent"),
            "bounced", "delivered",
            F.col("total_opens").isNotNull().cast("bigint").alias("unq_opens"),
            zero("total_opens").alias("total_opens"),
            zero("optouts").alias("optouts"),
            zero("marked_as_spam").alias("marked_as_spam"),
            F.when(unwanted, F.lit(0)).otherwise(zero("clicks_all")).cast("bigint").alias("clicks"),
            (opened & F.col("paid").isNotNull()).cast("bigint").alias("payers"),
            F.when(opened, zero("paid")).otherwise(F.lit(0.0)).alias("payments"),
            "first_send_date",
        )
    )


def update_attribution_state(path: str, events: DataFrame, until, codes: Codes = CODES) -> None:
    """Add the events from the last watermark up to (not including) the date ``until`` to the state
    at ``path``; no event before the watermark is read.

    The state is two tables partitioned by the watermark they were written for: ``messages``
    (``message_parts`` of the window) and ``opens`` (last open of a message and day). A window is
    written by replacing its partition, the watermark counts once ``messages`` is there, and
    opens merge by their maximum, so a run that is repeated, or broke off, changes nothing.
    ``until`` must be the latest watermark, to repeat it, or lie after it. Events that arrive
    with a time before the watermark are not seen."""
    spark, day = events.sparkSession, as_date(until)
    known = read_table(spark, f"{path}/messages")
    marks = sorted(r[0] for r in known.select(F.col("until").cast("date")).distinct().collect()) if known is not None else []
    if marks and day < marks[-1]:
        raise ValueError(f"the state is complete up to {marks[-1]}, {day} lies before it")
    earlier = [m for m in marks if m < day]
    kind = events.schema["ts"].dataType
    window = events.where(F.col("ts") < F.lit(str(day)).cast(kind))
    if earlier:
        window = window.where(F.col("ts") >= F.lit(str(earlier[-1])).cast(kind))
    opened = window.where(F.col("code") == codes.opened)
    opens = opened.groupBy("crm", "account", "guid", F.col("ts").cast("date").alias("day")).agg(F.max("ts").alias("ts"))
    stamp = F.lit(str(day)).cast("date")
    write_window(opens.withColumn("until", stamp), f"{path}/opens", "until")
    write_window(message_parts(window, codes).withColumn("until", stamp), f"{path}/messages", "until")


def attribution_from_state(
    spark: SparkSession, path: str, payments: DataFrame, reversals: DataFrame, as_of, replay_days: int = 60,
    stored: DataFrame | None = None, pay_days: int = 15, reversal_days: int = 45,
    codes: Codes = CODES, referenced: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame | None:
    """The rows of ``message_attribution`` from the state at ``path``; the event log is not read.
    Ids of the replay window are looked up in the partitions that reach into it. None when the
    state holds no event yet."""
    parts = read_table(spark, f"{path}/messages")
    if parts is None:
        return None
    since = as_date(as_of) - dt.timedelta(days=replay_days)
    after = F.lit(str(since)).cast(parts.schema["last_event"].dataType)
    recent = parts.where((F.col("until") > F.lit(str(since)).cast("date")) & (F.col("last_event") > after))
    merged = merge_parts(semi(parts, recent.select("guid").distinct(), "guid"), codes)
    opens = read_table(spark, f"{path}/opens")
    if opens is None:  # nothing was opened yet
        opens = merged.where("false").select("first_send.crm", "first_send.account", "guid", F.col("last_event").alias("ts"))
    return _attribute(merged, opens.select("crm", "account", "guid", "ts"), payments, reversals, stored,
                      pay_days, reversal_days, codes, referenced)


def refresh_attribution(
    path: str, events: DataFrame, payments: DataFrame, reversals: DataFrame, as_of,
    state: str | None = None, **options
) -> None:
    """Run the attribution against the stored report and upsert it by message id, rewriting
    only the send months that changed. A change from or to NULL is not seen, as in a plain
    comparison of columns. With a ``state`` path, the events from the state's watermark to
    ``as_of`` are added to the state and the report is made from it; without, the events of
    all ids in the replay window are read again."""
    spark = events.sparkSession
    stored = read_table(spark, path)
    if state is None:
        report = message_attribution(events, payments, reversals, as_of, stored=stored, **options)
    else:
        update_attribution_state(state, events, as_of, options.get("codes", CODES))
        report = attribution_from_state(spark, state, payments, reversals, as_of, stored=stored, **options)
        if report is None:
            return
    report = report.withColumn("send_month", F.trunc("send_date", "MM"))
    write_upsert(path, cut_lineage(report), ["guid"], "send_month")


def message_click_detail(
    interactions: DataFrame, history: DataFrame, clicks: DataFrame, accounts: DataFrame,
    stop_results: Sequence[str], ordinary_results: Sequence[str], dialed: Sequence[str],
    connected: Sequence[str], key_rules: Mapping[str, Column],
) -> DataFrame:
    """Message rows with backfilled platform, client and click counts.

    * an ordinary message that directly follows a stop/help reply of the account is dropped
    * a missing platform is the account's first known one of the period, else of the history
    * the client is looked up under the system the platform implies: ``key_rules`` maps a
      source system to the platform test, ``accounts`` has (account, source_system, client)
    * clicks are counted per (day, account): all, and distinct (service, letter)
    """
    seen = prev_value(interactions, "account", "ts", "result", "__prev", "", tie=["session"])
    after_stop = F.col("__prev").isin(*stop_results) & F.col("result").isin(*ordinary_results)
    platformed = (
        backfill_two_stage(
            seen, history, ["account", "full_name"], "ts", "platform", "__platform",
            tie=["session"],
        )
        .where(~F.coalesce(after_stop, F.lit(False)))
        .withColumn("platform", F.col("__platform"))
        .drop("__platform", "__prev")
    )
    system = None
    for name, test in key_rules.items():
        system = F.when(test, name) if system is None else system.when(test, name)
    known = platformed.withColumn("source_system", system)
    with_client = known.join(accounts, ["account", "source_system"], "left").drop("source_system")
    day_keys = ["day", "account", "client"]
    shown = with_client.groupBy(*day_keys, "service_name").agg(F.count(F.lit(1)).alias("__rows"))
    clicked = clicks.groupBy(*day_keys, "letter").agg(F.count(F.lit(1)).alias("__clicks"))
    # counts are multiplied after aggregating both sides: no row x click pairs
    hits = shown.join(clicked, day_keys).groupBy("day", "account").agg(
        F.sum(F.col("__rows") * F.col("__clicks")).alias("total_clicks"),
        F.count_distinct("service_name", "letter").alias("unique_clicks"),
    )
    flag = lambda values: F.col("result").isin(*values).cast("int")
    return (
        with_client.join(hits, ["day", "account"], "left")
        .fillna(0, ["total_clicks", "unique_clicks"])
        .withColumns({
            "is_dialed": flag(dialed), "is_connected": flag(connected), "is_stop": flag(stop_results)
        })
    )


def channel_daily_summary(
    dialed: DataFrame, responses: DataFrame, dialed_results: Sequence[str],
    connected_results: Sequence[str], stop_results: Sequence[str], keys: Sequence[str],
) -> DataFrame:
    """Counts of the latest day of the responses (without any: of the other feed): dialled /
    connected / stop from one feed, responses from the other, on common keys. ``responses`` has
    day, keys, calls, contacts, payments, amount."""
    latest = responses.agg(F.max("day")).first()[0] or dialed.agg(F.max("day")).first()[0]
    today = F.col("day") == F.lit(str(latest) if latest else None).cast("date")
    measures = ["dialed", "connected", "stopped", "calls", "contacts", "payments", "amount"]
    result = F.col("result")
    left = dialed.where(today).groupBy("day", *keys).agg(
        F.count_if(result.isin(*dialed_results)).alias("dialed"),
        F.count_if(result.isin(*connected_results)).alias("connected"),
        F.count_if(result.isin(*stop_results)).alias("stopped"),
    )
    right = responses.where(today).groupBy("day", *keys).agg(
        *[F.sum(c).alias(c) for c in measures[3:]]
    )
    both = union_distinct(left, right, fill=True).fillna(0, measures)
    return both.groupBy("day", *keys).agg(*[F.sum(c).alias(c) for c in measures])


def channel_monthly_summary(
    clients: DataFrame, events: DataFrame, texts: DataFrame, as_of, codes: Codes = CODES,
    text_sent: Sequence[str] = (), text_delivered: Sequence[str] = (),
    text_optout: Sequence[str] = (),
) -> DataFrame:
    """Previous month per client over two channels; missing clients report zeros."""
    start, end = prev_month(as_of)
    month = range_scan(events, "ts", start, end)
    c, n = F.col("code"), F.col("n_events")
    flags = outcome_flags(codes)
    mail = month.groupBy("client").agg(
        F.count(F.lit(1)).alias("email_sent"),
        sum_where(n, c == codes.sent).alias("email_delivered"),
        F.count_if(flags["bounced"]).alias("email_bounced"),
        sum_where(n, c == codes.opened).alias("email_opened"),
        sum_where(n, c == codes.clicked).alias("email_clicked"),
        sum_where(n, c == codes.opted_out).alias("email_optouts"),
    )
    result = F.col("result")
    text = range_scan(texts, "ts", start, end).groupBy("client").agg(
        F.count_if(result.isin(*text_sent)).alias("text_sent"),
        F.count_if(result.isin(*text_delivered)).alias("text_delivered"),
        F.count_if(result.isin(*text_optout)).alias("text_optouts"),
    )
    cols = [x for x in (*mail.columns, *text.columns) if x != "client"]
    label = F.date_format(F.lit(str(start)).cast("date"), "yy-MMM")
    out = assemble(clients.select("client").distinct(), [mail, text], "client",
                   zero={x: 0 for x in cols})
    return out.select(label.alias("month_label"), "client", *cols)


def missing_channels(summary: DataFrame) -> DataFrame:
    """Which channels delivered any data (drives the missing-data notice)."""
    return presence_checks(summary, ["email_sent", "text_sent"])


def first_month_funnel(report: DataFrame, keys: Sequence[str] = ("client", "crm")) -> DataFrame:
    """Distinct accounts per stage by month of first send, from the attribution report."""
    stages = {
        "unq_requested": "requested", "unq_whitelist_scrubbed": "whitelist_scrubbed",
        "unq_optout_scrubbed": "optout_scrubbed", "unq_invalid_scrubbed": "invalid_scrubbed",
        "unq_sent": "sent", "unq_bounced": "bounced", "unq_delivered": "delivered",
        "unq_opens": "unq_opens", "unq_optouts": "optouts", "unq_spam": "marked_as_spam",
        "unq_clicks": "clicks", "payers": "payers",
    }
    dated = report.withColumnsRenamed({"payers": "__payers", "unq_opens": "__opens"}).withColumn(
        "first_send_month", F.trunc("first_send_date", "MM")
    )
    source = {"payers": "__payers", "unq_opens": "__opens"}
    flags = {out: F.col(source.get(col, col)) > 0 for out, col in stages.items()}
    return distinct_flags(
        dated, ["first_send_month", *keys], "account", flags, sums=["payments"],
        total="first_send_accounts",
    )


def communication_log(
    emails: DataFrame, texts: DataFrame, accounts: DataFrame, email_results: Mapping[int, str],
    text_results: DataFrame, start, end, codes: Codes = CODES, picture_pattern: str = "%MMS%",
    language: str = "EN",
) -> DataFrame:
    """Two channels as one 18-column log.

    ``accounts``: account, client_ref, city, state, zip. ``text_results``: result, outcome,
    direction; results it lacks keep a NULL outcome. Mails of the listed event codes are
    outbound unless they unsubscribe; texts report the dialled number outbound and the caller
    inbound, and count for known accounts only (references like ``123-1`` are cut at the
    dash). ZIP codes keep five characters."""
    people = accounts.select(
        F.col("account").cast("string").alias("account"), "client_ref", "city", "state",
        F.coalesce(F.left("zip", F.lit(5)), F.lit("")).alias("zip"),
    )
    blank = F.lit("")
    bounced = outcome_flags(codes)["bounced"]
    named = map_outcome(
        F.col("code"), {k: v for k, v in email_results.items() if k != codes.failed}
    )
    mail = (
        range_scan(emails, "ts", start, end).where(F.col("code").isin(*email_results))
        .withColumn("result", F.when(bounced, email_results[codes.failed]).otherwise(named))
        .withColumn("account", F.col("account").cast("string"))
        .join(people, "account", "left")
        .select(
            "client_ref", "ts",
            F.when(F.col("code") == codes.opted_out, "IN").otherwise("OUT").alias("direction"),
            F.lit("Email").alias("category"), F.col("letter").alias("sub_category"),
            F.col("email").alias("email_address"), blank.alias("phone_number"), "result",
            "city", "state", "zip",
        )
    )
    text = (
        range_scan(texts, "ts", start, end)
        .withColumn("account", strip_suffix(F.col("account_ref")))
        .join(people, "account").join(text_results, "result", "left")
        .select(
            "client_ref", "ts", "direction",
            F.when(F.col("service_name").like(picture_pattern), "MMS").otherwise("SMS")
            .alias("category"),
            F.coalesce("letter", blank).alias("sub_category"), blank.alias("email_address"),
            F.when(F.col("direction") == "OUT", F.coalesce("phone", blank))
            .otherwise(F.coalesce("caller_phone", blank)).alias("phone_number"),
            F.col("outcome").alias("result"), "city", "state", "zip",
        )
    )
    fixed = {"comm_id": blank, "user": blank, "user_type": F.lit("User"), "content": blank,
             "language": F.lit(language), "consent": blank, "notes": blank}
    return union_distinct(mail, text).withColumns(fixed)


def activity_daily(events: DataFrame, as_of, keys: Sequence[str], cols: Sequence[str], ts="ts"):
    """Month-to-date sums by day and keys."""
    day = as_date(as_of)
    rows = range_scan(events, ts, day.replace(day=1), day + dt.timedelta(days=1))
    return rows.groupBy(F.to_date(ts).alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n_events"), *[F.sum(c).alias(c) for c in cols]
    )


def hourly_activity(events: DataFrame, ts="ts", keys: Sequence[str] = ()) -> DataFrame:
    """Counts by weekday and hour (the batch form of the streaming hourly counts)."""
    return events.groupBy(
        *keys, (F.weekday(F.col(ts).cast("date")) + 1).alias("weekday_no"),
        F.date_format(ts, "E").alias("weekday"), F.hour(ts).alias("hour_no"),
    ).agg(F.count(F.lit(1)).alias("n_events"))

