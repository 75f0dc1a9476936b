"""Scheduled-payment reports: postdated detail, horizon matrix, promise summary, snapshots.

Two kinds of source deliver scheduled payments; both have the columns source, account,
client, due_date, amount, broken_date. ``sources`` are fact tables: a payment counts while
it is due on or after ``as_of`` and not broken. ``current_lists`` are daily files that hold
only what is scheduled now: they are taken as they are, whatever their dates. The reports
union all branches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.functions.dates import add_months, as_date, day_diff, month_floor, month_start
from dunlin.functions.labels import band
from dunlin.operators.aggregates import slot_pivot, sum_where
from dunlin.operators.sets import union_distinct
from dunlin.sources.scans import read_flat_file, typed_load
from dunlin.sources.sinks import freshness_days, read_table, snapshot_if_due, update_from, write_full

# Charge-off age bands in years of 360.00 days, lower edge included.
AGE_BANDS: tuple = (
    (None, 0, "S -Missing Info"), (0, 0.5, "A - <6mos"), (0.5, 1, "B -6mos-12mos"),
    (1, 1.5, "C -12mos-18mos"), (1.5, 2, "D -18mos-24mos"), (2, 3, "E -2yr-3yrs"),
    (3, 4, "F -3yr-4yrs"), (4, 5, "G -4yr-5yrs"), (5, 6, "H -5yr-6yrs"), (6, 7, "I -6yr-7yrs"),
    (7, 8, "J -7yr-8yrs"), (8, 9, "K -8yr-9yrs"), (9, 10, "L -9yr-10yrs"),
    (10, 11, "M -10yr-11yrs"), (11, 12, "N -11yr-12yrs"), (12, 13, "O -12yr-13yrs"),
    (13, 14, "P -13yr-14yrs"), (14, 15, "Q -14yr-15yrs"), (15, None, "R -15+ years"),
)
# Balance bands. 0 and below, and [4999, 5000), lie in no band.
BALANCE_BANDS: tuple = (
    (500, 1000, "B-$500-$999"), (1000, 2500, "C-$1000-$2499"), (2500, 4999, "D-$2500-$4999"),
    (5000, None, "E-$5000+"),
)
MISSING_CHARGE_OFF, MISSING_LIST = "2040-01-01", "2050-01-01"


def charge_off_age(charge_off: Column, listed: Column) -> Column:
    """Years of 360.00 days from charge-off to listing; sentinels stand in for NULL dates."""
    start = F.coalesce(charge_off.cast("date"), F.lit(MISSING_CHARGE_OFF).cast("date"))
    end = F.coalesce(listed.cast("date"), F.lit(MISSING_LIST).cast("date"))
    return day_diff(start, end) / F.lit(360.0)


def balance_band(balance: Column) -> Column:
    low = F.when((balance > 0) & (balance < 500), "A-0-$499")
    return F.coalesce(low, band(balance, BALANCE_BANDS))


def _open_from(schedule: DataFrame, day) -> DataFrame:
    return schedule.where(
        (F.col("due_date") >= F.lit(str(as_date(day))).cast("date"))
        & F.col("broken_date").isNull()
    )


def _scheduled(sources, current_lists, as_of) -> list[DataFrame]:
    return [*[_open_from(s, as_of) for s in sources], *current_lists]


def postdated_detail(
    sources: Sequence[DataFrame], accounts: DataFrame, clients: DataFrame, as_of,
    current_lists: Sequence[DataFrame] = (),
) -> DataFrame:
    """Scheduled payments of all sources with account and client attributes."""
    rows = union_distinct(*_scheduled(sources, current_lists, as_of))
    return (
        rows.join(accounts, ["account", "source"], "left")
        .join(clients, ["client"], "left")
        .withColumns({
            "batch_month": month_start(F.col("list_date")),
            "due_month": month_start(F.col("due_date")),
        })
    )


def postdated_unique(detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per account and due month with the summed amount."""
    return detail.groupBy(*keys, "account", "due_month").agg(
        F.count(F.lit(1)).alias("n_payments"), F.sum("amount").alias("amount")
    )


def month_slot(due: Column, as_of, n: int) -> Column:
    """1..n for the next n calendar months (the month of yesterday is slot 1), else n+1."""
    first = month_floor(as_date(as_of) - dt.timedelta(days=1))
    slot = (F.year(due) - first.year) * 12 + F.month(due) - first.month + 1
    return F.when(slot.between(1, n), slot).otherwise(n + 1)


def payment_horizon_matrix(
    sources: Sequence[DataFrame], payments: DataFrame, accounts: DataFrame, as_of, n_months: int = 13,
    paid_since="2016-01-01", excluded_types: Sequence[str] = (), client_filter: Column | None = None,
    current_lists: Sequence[DataFrame] = (), paid_filter: Column | None = None,
) -> DataFrame:
    """Scheduled amounts per account in month slots 1..n plus overflow, with the number of
    remaining, already paid and total payments. ``paid_filter`` is a further test on
    payments, for rules that differ by source.

    The slot is month arithmetic on the due date, so no calendar table is joined. Counts and
    amounts come from one aggregation; payments are aggregated per account before joining.
    """
    rows = union_distinct(*[
        s.withColumn("slot", month_slot(F.col("due_date"), as_of, n_months))
        .groupBy("source", "account", "client", F.trunc("due_date", "MM").alias("due_month"), "slot")
        .agg(F.count(F.lit(1)).alias("n_due"), F.sum("amount").alias("amount"))
        for s in _scheduled(sources, current_lists, as_of)
    ])
    if client_filter is not None:
        rows = rows.where(client_filter)
    keys = ["source", "account", "client"]
    matrix = slot_pivot(
        rows, keys, "slot", "amount", n_months, extra={"remaining": F.sum("n_due")}
    )
    counted = payments.where(
        (F.col("pay_date") >= F.lit(str(paid_since)).cast("date"))
        & ~F.col("kind").isin(*excluded_types)
        & (F.lit(True) if paid_filter is None else paid_filter)
    ).groupBy("source", "account").agg(F.count(F.lit(1)).alias("n_paid"))
    return (
        matrix.join(counted, ["source", "account"], "left")
        .withColumn("n_paid", F.coalesce("n_paid", F.lit(0)))
        .withColumn("taken", F.col("n_paid") + F.col("remaining"))
        .join(accounts, ["account", "source"], "left")
    )


def promise_summary(
    sources: Sequence[DataFrame], accounts: DataFrame, as_of, keys: Sequence[str] = (),
    current_lists: Sequence[DataFrame] = (),
) -> DataFrame:
    """Promises by batch month, client, state, charge-off age and balance band.

    ``accounts`` has account, source, state, list_date, charge_off_date, initial_balance."""
    day = as_date(as_of)
    due = F.col("due_date")
    this_month = (F.month(due) == day.month) & (F.year(due) == day.year)
    rows = union_distinct(*_scheduled(sources, current_lists, as_of)).join(
        accounts, ["account", "source"], "left"
    )
    age = charge_off_age(F.col("charge_off_date"), F.col("list_date"))
    dims = {
        "batch_month": month_start(F.col("list_date")),
        "charge_off_band": band(age, AGE_BANDS),
        "balance_range": balance_band(F.col("initial_balance")),
    }
    return rows.withColumns(dims).groupBy(
        "batch_month", "source", "client", "state", "charge_off_band", "balance_range", *keys
    ).agg(
        F.count(F.lit(1)).alias("promises"),
        F.count_distinct("account").alias("unq_promises"),
        F.sum("amount").alias("promise_amt"),
        sum_where(F.col("amount"), this_month).alias("promise_amt_month"),
    )


def open_as_of_months(schedule: DataFrame, as_of, months_back: int = 6) -> DataFrame:
    """Point-in-time rebuild: one row per payment and month start m of the last
    ``months_back`` months at which it was open (due >= m, and not broken before m).

    Each row explodes into exactly the months it qualifies for, from the window's first month
    to the earlier of its due and broken month, so there is no loop and no cross join."""
    first, last = add_months(as_of, -months_back), add_months(as_of, -1)
    until = F.least(
        F.lit(str(last)).cast("date"), month_start(F.col("due_date")),
        F.coalesce(month_start(F.col("broken_date")), F.lit(str(last)).cast("date")),
    )
    start = F.lit(str(first)).cast("date")
    months = F.when(until >= start, F.sequence(start, until, F.expr("interval 1 month")))
    return schedule.withColumn("snapshot_month", F.explode(months))


def snapshot_history(
    spark: SparkSession, live: DataFrame, rebuilt: DataFrame, path: str, as_of
) -> DataFrame:
    """Store this month's snapshot of the live feed when due, and return the full history
    with the other source rebuilt point in time."""
    snapshot_if_due(live, path, as_of)
    stored = read_table(spark, path)
    return stored.unionByName(rebuilt.select(*stored.columns))


def payment_to_interaction(
    interactions: DataFrame, payments: DataFrame, account="account", day="day"
) -> DataFrame:
    """Daily payments per account on the interactions of that account and day; 0 elsewhere,
    also where the account or day is NULL.

    The reference writes the day's total to every interaction of the day, which counts it
    several times when summed; that column is kept, and ``pay_share`` splits the total over
    the interactions of the day."""
    totals = payments.groupBy(account, day).agg(F.sum("amount").alias("pay_received"))
    days = interactions.groupBy(account, day).agg(F.count(F.lit(1)).alias("__n"))
    paid = update_from(days, totals, [account, day], "pay_received", 0.0).withColumn(
        "pay_share", F.col("pay_received") / F.col("__n")
    )
    return interactions.join(paid.drop("__n"), [account, day], "left").fillna(
        0.0, ["pay_received", "pay_share"])


def load_schedule_file(
    spark: SparkSession, file_path: str, columns: Sequence[str], casts: Mapping[str, str],
    table_path: str, as_of,
) -> DataFrame | None:
    """Daily schedule file -> typed, distinct, current table. Returns None when the table was
    already loaded today (freshness 0 days)."""
    stored = read_table(spark, table_path)
    if stored is not None:
        days = freshness_days(stored, "import_time", as_of).first()[0]
        if days is not None and days <= 0:
            return None
    typed = typed_load(read_flat_file(spark, file_path, columns), casts, as_of)
    write_full(typed, table_path)
    return read_table(spark, table_path)


def schedule_cycle(
    spark: SparkSession, file_path: str, columns: Sequence[str], casts: Mapping[str, str],
    table_path: str, snapshot_path: str, sources: Sequence[DataFrame], payments: DataFrame,
    accounts: DataFrame, as_of, **matrix,
) -> tuple[DataFrame, DataFrame]:
    """The daily run of a schedule file: load it unless the table was already loaded today,
    store the month's snapshot of the loaded list when due, and return the horizon matrix of
    the fact ``sources`` and that list, with the history of snapshots. ``matrix`` goes to
    ``payment_horizon_matrix``.

    A second run on the same day changes neither table and returns the same rows."""
    load_schedule_file(spark, file_path, columns, casts, table_path, as_of)
    listed = read_table(spark, table_path).drop("import_time")
    snapshot_if_due(listed, snapshot_path, as_of)
    rows = payment_horizon_matrix(sources, payments, accounts, as_of, current_lists=[listed], **matrix)
    return rows, read_table(spark, snapshot_path)
