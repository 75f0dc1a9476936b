"""Exception reports: contact caps, message thresholds, restricted accounts, letters, mapping gaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.functions.dates import as_date, day_diff, to_date_key
from dunlin.operators.joins import after_join, anti, missing_keys, pattern_join, semi
from dunlin.operators.slices import find_hot
from dunlin.operators.windows import attempt_no, neighbours, next_event, prev_k


def contact_frequency_exceptions(
    contacts: DataFrame, customer="customer", ts="start_time", session="session",
    k: int = 3, days: int = 30, eligible: Column | None = None, as_of=None, scan_days: int = 60,
) -> DataFrame:
    """Contacts whose 1st..k-th previous contacts of the same customer all lie fewer than
    ``days`` days back. Rows without a customer never match and are dropped first. Adds, per
    step i, the earlier session, its time and the day distance."""
    rows = contacts if eligible is None else contacts.where(eligible)
    if as_of is not None:
        start = as_date(as_of) - dt.timedelta(days=scan_days)
        rows = rows.where(F.col(ts) >= F.lit(str(start)).cast(rows.schema[ts].dataType))
    rows = rows.where(F.col(customer).isNotNull())
    stepped = prev_k(rows, customer, ts, [session, ts], k, tie=[session])
    gaps = {f"days_{i}": day_diff(F.col(f"{ts}_{i}"), F.col(ts)) for i in range(1, k + 1)}
    hit = F.lit(True)
    for name in gaps:
        hit = hit & (F.col(name) < days)
    return stepped.withColumns(gaps).where(hit)


def message_threshold_exceptions(
    messages: DataFrame, rules: DataFrame, customer="customer", phone="phone", ts="sent_at",
    name="service_name", since=None, tie: Sequence[str] = (), direction: str = ">",
) -> DataFrame:
    """Messages that break the rule whose pattern matches their service name.

    The interval is taken to the customer's previous message in (phone, time) order, so it may
    span two phones, while attempts are numbered per phone. ``direction`` states which side of
    the rule's interval is the violation (the reference reports gaps *above* it)."""
    hot = find_hot(messages, customer)  # one count serves both windows
    numbered = attempt_no(
        messages, [customer, phone], ts, tie=tie, row="attempt", rank="attempt_rank", hot=hot
    )
    stepped = neighbours(
        numbered, customer, phone, {"prev_at": (ts, 1)}, tie=[ts, *tie], hot=hot,
    ).withColumn("gap_days", day_diff(F.col("prev_at"), F.col(ts)))
    active = rules.where("is_active").drop("is_active")
    ruled = pattern_join(stepped, active, name, "pattern")
    gap, limit = F.col("gap_days"), F.col("interval_days")
    breaks = gap > limit if direction == ">" else gap < limit
    out = ruled.where(gap.isNotNull() & (breaks | (F.col("attempt") >= F.col("attempt_limit"))))
    if since is not None:
        out = out.where(F.col(ts) >= F.lit(str(since)).cast(messages.schema[ts].dataType))
    return out.withColumns({
        "interval_exception": breaks.cast("int"),
        "attempt_exception": (F.col("attempt") > F.col("attempt_limit")).cast("int"),
        "limit_reached": (F.col("attempt") == F.col("attempt_limit")).cast("int"),
    })


def restricted_contact_exceptions(
    accounts: DataFrame, history: DataFrame, contacts: DataFrame, restricted, since,
    customer="customer", status="status", updated="updated", inserted="inserted",
    contact_ts="contact_ts",
) -> DataFrame:
    """Contacts per day made after an account became restricted.

    ``restricted`` is a one-column frame of status codes. The restriction date is the earliest
    history row with the account's current status, else the account's own update date.
    Only days after ``since`` (the last reported exception) count."""
    codes = restricted.select(F.col(restricted.columns[0]).alias(status))
    earliest = semi(history, codes, status).groupBy(customer, status).agg(
        F.min(inserted).cast("date").alias("__first")
    )
    dated = F.coalesce(F.col("__first"), F.col(updated).cast("date"))
    anchors = (
        semi(accounts, codes, status).select(customer, status, updated)
        .join(earliest, [customer, status], "left")
        .select(customer, status, dated.alias("restricted_on")).distinct()
        .withColumn("restricted_key", to_date_key(F.col("restricted_on")))
    )
    floor = F.lit(str(as_date(since))).cast("date")
    days = (
        contacts.select(customer, F.col(contact_ts).cast("date").alias("contact_date"))
        .where(F.col("contact_date") > floor)
        .groupBy(customer, "contact_date").agg(F.count(F.lit(1)).alias("n_contacts"))
        .withColumn("contact_key", to_date_key(F.col("contact_date")))
    )
    late = after_join(days, anchors, customer, "contact_key", "restricted_key", inclusive=False)
    return late.select(
        customer, status, "restricted_on", "contact_key", F.col("n_contacts").alias("n_exceptions")
    )


def letter_sequence_exceptions(
    letters: DataFrame, initial: str, follow: str, days: int = 50, customer="customer",
    ts="requested", kind="letter_type", key="letter_key",
) -> DataFrame:
    """Initial notices (LIKE ``initial``) whose customer's next letter is of the ``follow``
    kind within ``days`` days."""
    stepped = next_event(letters, customer, ts, [kind, ts, key], tie=[key])
    gap = day_diff(F.col(ts), F.col(f"next_{ts}"))
    hit = F.col(kind).like(initial) & F.col(f"next_{kind}").like(follow) & (gap <= days)
    return stepped.where(hit).withColumn("days_since_initial", gap)


def unmapped_keys(
    facts: DataFrame, mapping: DataFrame, key: str, day: str, as_of, look_back_days: int = 365,
    count_as="n_placements",
) -> DataFrame:
    """Keys in use during the last year that the mapping does not know, with counts."""
    start = as_date(as_of) - dt.timedelta(days=look_back_days)
    recent = facts.where(F.col(day) >= F.lit(str(start)).cast(facts.schema[day].dataType))
    return missing_keys(recent, mapping, key, count_as)


def new_mapping_rows(keys: DataFrame, mapping: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Rows to add to a mapping: unknown keys with default attributes."""
    new = anti(keys.select(key).distinct(), mapping, key)
    return new.withColumns({c: F.lit(v) for c, v in defaults.items()})
