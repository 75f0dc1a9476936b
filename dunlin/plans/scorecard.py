"""Operational reports on entity x period spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.functions.dates import (
    add_months, as_date, last_fri_week, month_diff, month_floor, month_start, report_month,
    restate_prev_month,
)
from dunlin.functions.labels import decode_flags, month_age_bands, recode
from dunlin.functions.text import ratio, text_len
from dunlin.operators.aggregates import (
    count_bitmaps, distinct_bitmaps, distinct_flags, share_of, sum_where, yield_index,
)
from dunlin.operators.joins import allow_list, allowed_detail, assemble, dim_spine
from dunlin.operators.sets import union_distinct
from dunlin.operators.windows import fill_forward, neighbours, running_sum
from dunlin.sources.scans import range_scan
from dunlin.sources.sinks import write_window


def daily_kpi_spine(
    entities: DataFrame, accounts: DataFrame, feeds: Sequence[DataFrame], zero: Sequence[str],
    as_of, lag_days: int = 3, entity="entity",
) -> DataFrame:
    """Entity x day of the report month with feeds, cumulative cancels and available accounts.

    ``accounts``: entity, list_date, cancel_date. ``feeds``: one row per (entity, day); the
    columns in ``zero`` default to 0, others stay NULL.

    * all = accounts listed by the period end and not cancelled before its start
    * cum_cancels = running cancels of the period, filled forward, NULL before the first
    * available on day t = (all - cum_cancels) of day t-1; ``all`` when that is 0 or there is
      no previous day; NULL when it is NULL

    Cancels are grouped by date in one step. The spine holds at most 31 rows per entity, so
    its windows are bounded.
    """
    start, end = report_month(as_of, lag_days)
    lo, hi = (F.lit(str(d)).cast("date") for d in (start, end))
    listed, cancelled = F.col("list_date").cast("date"), F.col("cancel_date").cast("date")
    alive = (listed <= hi) & (cancelled.isNull() | (cancelled >= lo))
    total = accounts.where(alive).groupBy(entity).agg(F.count("list_date").alias("all_accounts"))
    cancels = (
        accounts.where(cancelled.between(lo, hi))
        .groupBy(entity, cancelled.alias("day")).agg(F.count("list_date").alias("cancels"))
    )
    cumulative = running_sum(cancels, entity, "day", "cancels", "__cum", bounded=True).drop("cancels")
    spine = dim_spine(entities.select(entity).distinct(), start, end, "day")
    rows = assemble(spine, [cumulative, *feeds], [entity, "day"], {c: 0 for c in zero})
    rows = rows.join(total, entity, "left")
    filled = fill_forward(
        rows, entity, "day", "__cum", "cum_cancels", strict=True, bounded=True, own_first=True
    )
    filled = filled.withColumn("__avail", F.col("all_accounts") - F.col("cum_cancels"))
    shifted = neighbours(filled, entity, "day", {"__prev": ("__avail", 1, 0)}, bounded=True)
    available = F.when(F.col("__prev") == 0, F.col("all_accounts")).otherwise(F.col("__prev"))
    return shifted.withColumn("available_accounts", available).drop("__cum", "__avail", "__prev")


def kpi_scorecard(
    clients: DataFrame, placements: DataFrame, calls: DataFrame, payments: DataFrame,
    inventory: DataFrame, emails: DataFrame, letters: Sequence[DataFrame], as_of,
    months: int = 12, letter_rule: Column | None = None, worked: DataFrame | None = None,
    call_sums: Sequence[str] = (),
) -> DataFrame:
    """Client x month spine of the last ``months`` months with one pre-aggregated feed each.

    Inventory joins on the spine itself, so it is kept in months without calls. ``worked`` is
    the accounts-worked report (client, month, accounts_worked); ``call_sums`` are further call
    columns to add up, for example durations."""
    start, today = add_months(as_of, -months), as_date(as_of)
    tomorrow = today + dt.timedelta(days=1)

    def by_month(df, day, *aggs):
        rows = range_scan(df, day, start, tomorrow)
        return rows.groupBy("client", month_start(F.col(day)).alias("month")).agg(*aggs)

    direction, kind = F.col("direction"), F.col("call_type")
    measures = {"calls": "n_calls", "contacts": "n_contacts", "connects": "n_connects",
                "promises": "n_promises"}
    call_aggs = []
    for out, col in measures.items():
        call_aggs += [
            F.sum(col).alias(out),
            sum_where(F.col(col), direction == "Inbound", zero=False).alias(f"{out}_inbound"),
            sum_where(F.col(col), direction == "Outbound", zero=False).alias(f"{out}_outbound"),
            sum_where(F.col(col), kind == "Manual", zero=False).alias(f"{out}_manual"),
            sum_where(F.col(col), kind == "Dialer", zero=False).alias(f"{out}_dialer"),
        ]
    call_aggs += [F.sum(c).alias(c) for c in call_sums]
    first = F.col("is_first") == 1
    feeds = [
        by_month(placements, "list_date", F.count(F.lit(1)).alias("placed_count"),
                 F.sum("initial_balance").alias("placed_amount")),
        by_month(calls, "call_date", *call_aggs),
        by_month(payments, "pay_date",
                 F.count_distinct("account").alias("accounts_paid"),
                 F.sum("amount").alias("collections"), F.sum("fee").alias("fees"),
                 F.count(F.lit(1)).alias("n_payments"),
                 sum_where(F.col("amount"), first, zero=False).alias("first_collections"),
                 F.count_if(first).alias("first_payments")),
        by_month(inventory, "rpt_month", F.sum("accounts").alias("inventory_accounts")),
        by_month(emails, "send_date", F.sum("sent").alias("emails_sent")),
    ]
    if worked is not None:
        feeds.append(worked.select("client", "month", "accounts_worked"))
    if letter_rule is not None:
        letters = [letters[0].where(letter_rule), *letters[1:]]
    stacked = letters[0].select("client", "mail_date")
    for branch in letters[1:]:
        stacked = stacked.unionByName(branch.select("client", "mail_date"))
    feeds.append(by_month(stacked, "mail_date", F.count(F.lit(1)).alias("letters_sent")))
    spine = dim_spine(clients, start, month_floor(today), "month", grain="month")
    return assemble(spine, feeds, ["client", "month"])


def placement_profile(
    placements: DataFrame, keys: Sequence[str], class_rule: Column, edges: Sequence[int] = (
        3, 6, 9, 12, 15, 18, 21, 24), with_email: bool = True,
) -> DataFrame:
    """Distinct accounts by class: reachable counts and age bands in months.

    ``placements``: account, phone, address, tax_id, open_date, list_date, email_account. The
    older report form uses edges up to 18 months and no e-mail columns."""
    age = month_diff(F.col("open_date"), F.col("list_date"))
    flags = {
        "with_phone": text_len(F.col("phone")) == 10,
        "with_address": text_len(F.col("address")) > 5,
        "with_tax_id": text_len(F.col("tax_id")) >= 4,
        **month_age_bands(age, edges),
    }
    if with_email:
        flags["with_email"] = F.col("email_account").isNotNull()
    classed = placements.withColumn("class", class_rule)
    out = distinct_flags(classed, [*keys, "class"], "account", flags, total="accounts")
    if with_email:
        out = out.withColumn("pct_with_email", ratio(F.col("with_email"), F.col("accounts")))
    return out


def score_sloping(
    history: DataFrame, current: DataFrame, group: Sequence[str], as_of, lag_months: int = 6,
    current_months: int = 3, min_accounts: int = 1000, model_filter: Column | None = None,
) -> DataFrame:
    """Actual share of calls per score group against the share its historic yield predicts.

    ``history`` (list_month) and ``current`` (rpt_month) have the group columns, score_group,
    accounts, calls, payments. Groups with fewer than ``min_accounts`` accounts in the report
    month are left out."""
    group = list(group)
    day = as_date(as_of)
    old = history.where(F.col("list_month") <= F.lit(str(_shift(day, -lag_months))).cast("date"))
    new = current.where(F.col("rpt_month") >= F.lit(str(_shift(day, -current_months))).cast("date"))
    if model_filter is not None:
        old, new = old.where(model_filter), new.where(model_filter)
    pie = yield_index(old, group, "score_group", "payments", "accounts").select(
        *group, "score_group", F.col("seg_yield").alias("historic_yield"), "predicted_share"
    )
    seg = new.groupBy(*group, "rpt_month", "score_group").agg(
        *[F.sum(c).alias(c) for c in ("accounts", "calls", "payments")]
    )
    # a report month of a group has one row per score group, so its windows are small
    month = Window.partitionBy(*group, "rpt_month")
    large = seg.withColumn("__month_accounts", F.sum("accounts").over(month)).where(
        F.col("__month_accounts") >= min_accounts
    ).drop("__month_accounts")
    shared = share_of(large, [*group, "rpt_month"], "calls", "actual_share", small_groups=True)
    # a group without any history has no index total and drops out; a score group without
    # history stays with blank history columns
    known = pie.select(*group).distinct()
    return (
        shared.join(known, group, "left_semi")
        .join(pie, [*group, "score_group"], "left")
        .withColumn("month_yield", ratio(F.col("payments"), F.col("accounts")))
        .withColumn("predicted_share", F.coalesce("predicted_share", F.lit(0.0)))
    )


def score_sloping_one_scan(
    volumes: DataFrame, group: Sequence[str], as_of, lag_months: int = 6, current_months: int = 3,
    min_accounts: int = 1000, model_filter: Column | None = None, month="month",
) -> DataFrame:
    """``score_sloping`` where one table holds the history and the report months: it is scanned
    and aggregated once, a row being counted for the history, its month, or both.

    The history of a score group is its row without a month; windows hand it on to the months.
    A group's aggregated rows are score groups times months, so the windows are small."""
    group, day = list(group), as_date(as_of)
    listed = F.col(month) <= F.lit(str(_shift(day, -lag_months))).cast("date")
    shown = F.col(month) >= F.lit(str(_shift(day, -current_months))).cast("date")
    rows = volumes.where((listed | shown) & reduce(Column.__and__, [F.col(c).isNotNull() for c in group]))
    if model_filter is not None:
        rows = rows.where(model_filter)
    grains = F.array_compact(F.array(
        F.when(listed, F.struct(F.lit(None).cast("date").alias("m"))), F.when(shown, F.struct(F.col(month).cast("date").alias("m")))))
    seg = (
        rows.select(*group, "score_group", "accounts", "calls", "payments", F.explode(grains).alias("__grain"))
        .groupBy(*group, F.col("__grain.m").alias("rpt_month"), "score_group")
        .agg(*[F.sum(c).alias(c) for c in ("accounts", "calls", "payments")])
    )
    past = F.col("rpt_month").isNull()
    whole, own = Window.partitionBy(*group), Window.partitionBy(*group, "score_group")
    of_month = Window.partitionBy(*group, "rpt_month")
    total = ratio(F.sum(F.when(past, F.col("payments"))).over(whole), F.sum(F.when(past, F.col("accounts"))).over(whole))
    indexed = seg.withColumns({
        "__known": F.max(past).over(whole), "__total": total,
        "__yield": F.when(past, ratio(F.col("payments"), F.col("accounts"))),
    }).withColumn("__index", F.when(past, F.when(F.coalesce("__total", F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        ratio(F.col("__yield"), F.col("__total")))))
    shared = indexed.withColumn("__share", ratio(F.col("__index"), F.sum("__index").over(whole)))
    named = F.col("score_group").isNotNull()
    return (
        shared.withColumns({
            "historic_yield": F.max(F.when(named, F.col("__yield"))).over(own),
            "predicted_share": F.coalesce(F.max(F.when(named, F.col("__share"))).over(own), F.lit(0.0)),
            "__month_accounts": F.sum("accounts").over(of_month),
            "actual_share": ratio(F.col("calls"), F.sum("calls").over(of_month)),
            "month_yield": ratio(F.col("payments"), F.col("accounts")),
        })
        .where(~past & F.col("__known") & (F.col("__month_accounts") >= min_accounts))
        .drop("__known", "__total", "__yield", "__index", "__share", "__month_accounts")
    )


def _shift(day: dt.date, months: int) -> dt.date:
    first = add_months(day, months)
    last = add_months(first, 1) - dt.timedelta(days=1)
    return first.replace(day=min(day.day, last.day))


def accounts_worked_monthly(sources: Mapping[str, DataFrame], month, day="call_date") -> DataFrame:
    """Distinct accounts by client for one month, per source system."""
    start, end = month_floor(month), add_months(month, 1)
    parts = [
        range_scan(df, day, start, end)
        .groupBy(F.lit(str(start)).cast("date").alias("month"), F.lit(name).alias("source"), "client")
        .agg(F.count_distinct("account").alias("accounts_worked"))
        for name, df in sources.items()
    ]
    return union_distinct(*parts)


def accounts_worked_bitmaps(sources: Mapping[str, DataFrame], start, end, day="call_date") -> DataFrame:
    """Bitmaps of the accounts worked, by month, source and client, of the days from ``start``
    to before ``end``: the stored form of the distinct counts."""
    parts = [
        distinct_bitmaps(
            range_scan(df, day, start, end).withColumns({"month": F.trunc(day, "month"), "source": F.lit(name)}),
            ["month", "source", "client"], "account")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def accounts_worked_restated(sources: Mapping[str, DataFrame], path: str, as_of, day="call_date") -> DataFrame:
    """The stored bitmaps below ``path`` after a load at ``as_of``: the running month is
    replaced, and during the first seven days of a month the previous one once more. No other
    day is read, and no other month is written."""
    month = restate_prev_month(as_of)
    first = month_floor(as_of) if month is None else month_floor(month)
    fresh = accounts_worked_bitmaps(sources, first, as_date(as_of) + dt.timedelta(days=1), day)
    spark = fresh.sparkSession
    write_window(fresh, path, "month")
    return spark.read.schema(fresh.schema).parquet(path)


def accounts_worked_in(bitmaps: DataFrame, first, last) -> DataFrame:
    """Distinct accounts by source and client over the months from ``first`` to ``last``, from
    their bitmaps only: an account worked in several months counts once."""
    months = bitmaps.where(F.col("month").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))
    return count_bitmaps(months, ["source", "client"], "accounts_worked")


def call_stats_rolling(
    feeds: Mapping[str, DataFrame], keys: Sequence[str], as_of, days: int = 7, day="call_date"
) -> DataFrame:
    """Grouped record counts of the last ``days`` days per feed (written as a window replace)."""
    start = as_date(as_of) - dt.timedelta(days=days)
    parts = []
    for name, df in feeds.items():
        recent = df.where(F.col(day) >= F.lit(str(start)).cast("date"))
        parts.append(
            recent.groupBy(day, F.lit(name).alias("feed"), *keys)
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def inbound_detail(
    calls: DataFrame, accounts: DataFrame, account_key: Column, as_of, days: int = 7,
    day="call_date",
) -> DataFrame:
    """Recent calls with the attributes of the account their reference points to; the account
    key is normalised in a projection, so the join stays an equi join."""
    start = as_date(as_of) - dt.timedelta(days=days)
    recent = range_scan(calls, day, start, as_of)
    return recent.withColumn("account", account_key).join(accounts, "account")


def allowed_rows(
    parents: DataFrame, allow: DataFrame, keys: Sequence[str], class_col: str,
    classes: Sequence[str], details: Mapping[str, DataFrame] | None = None, detail_key="call_id",
) -> dict[str, DataFrame]:
    """Row security: visible parents, and the detail rows that hang off them."""
    visible = allow_list(parents, allow, keys, class_col, classes)
    out = {"parents": visible}
    for name, df in (details or {}).items():
        out[name] = allowed_detail(df, visible, detail_key)
    return out


def phone_score_performance(
    scored: DataFrame, attempts: DataFrame, as_of, segment: Column, balance_range: Column,
    control: Column, dims: Sequence[str],
) -> DataFrame:
    """Attempts on scored phones during the last Friday-to-Thursday week.

    ``scored``: phone, account, score and dimensions. ``attempts``: phone, account, ts,
    is_contact, is_wrong. A unique contact is an attempt at the first contact time of its
    (phone, account). ``control`` marks the control group, whose score reads "Control"."""
    start, end = last_fri_week(as_of)
    rows = range_scan(attempts, "ts", start, end)
    joined = recode(scored.join(rows, ["phone", "account"]), control, "score", F.lit("Control"))
    firsts = joined.groupBy("phone", "account").agg(
        F.min(F.when(F.col("is_contact") == 1, F.col("ts"))).alias("__first_contact"),
        F.min(F.when(F.col("is_wrong") == 1, F.col("ts"))).alias("__first_wrong"),
    )
    ready = joined.join(firsts, ["phone", "account"]).withColumns(
        {"segment": segment, "balance_range": balance_range}
    )
    return ready.groupBy(*dims, "segment", "balance_range", "score").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_distinct("phone").alias("phones"),
        F.sum("is_contact").alias("contacts"),
        F.sum("is_wrong").alias("wrong"),
        F.count_if(F.col("ts") == F.col("__first_contact")).alias("unq_contacts"),
        F.count_if(F.col("ts") == F.col("__first_wrong")).alias("unq_wrong"),
    ).withColumn("week_start", F.lit(str(start)).cast("date"))


def phone_inventory(phones: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Active scored phones by dimension; a blank activity code counts as NULL."""
    cleaned = phones.withColumn(
        "activity", F.nullif(F.ltrim(F.col("activity")), F.lit(""))
    ).where(F.col("score").isNotNull() & F.col("cancel_date").isNull())
    return cleaned.groupBy(*dims, "activity", "score").agg(F.count(F.lit(1)).alias("phones"))


def program_waterfall(
    metrics: DataFrame, enroll_key: str, offer_key: str, flags: Mapping[str, str],
    renames: Sequence[tuple[str, str]], changed_on,
) -> DataFrame:
    """Enrolled sessions' rows with their programs, plus the programs viewed in each
    session's first offer.

    ``metrics``: metric_id, key, ts, description, session, account. ``flags`` maps an offer
    character to a program; ``renames`` are (old, new) characters from ``changed_on`` on."""
    key, text = F.col("key"), F.col("description")
    offered = (key == offer_key) & text.isNotNull()
    in_session = metrics.where(F.col("session").isNotNull())
    programs = in_session.where(key == enroll_key).select("session", text.alias("program")).distinct()
    first_offers = in_session.where(offered).groupBy("session").agg(F.min("ts").alias("ts"))
    renamed = metrics
    since = F.col("ts").cast("date") >= F.lit(str(as_date(changed_on))).cast("date")
    for old, new in renames:
        renamed = recode(
            renamed, (key == offer_key) & since & F.contains(text, F.lit(old)), "description",
            F.replace(text, F.lit(old), F.lit(new)),
        )

    cols = metrics.columns
    enrolled = renamed.join(programs, "session").select(
        *cols, "program", F.lit("Enrolled").alias("campaign"), F.lit(2).alias("campaign_order"))
    seen = F.array_compact(F.array(*[
        F.when(flag == 1, F.lit(name)) for name, flag in decode_flags(text, flags).items()
    ]))
    viewed = renamed.where(offered).join(first_offers, ["session", "ts"]).select(
        *cols, F.explode(seen).alias("program"), F.lit("Viewed").alias("campaign"), F.lit(1).alias("campaign_order"))
    return union_distinct(enrolled, viewed).withColumn("occurrence", F.lit(1))
