"""Measure registry: named aggregates evaluated after filters and grouping.

A measure is an aggregate ``Column``; ``by_dimension`` applies any of them to any allowed
dimension, which reproduces filter context for sums and ratios. All measures of one call
share a single aggregation pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.functions.text import ratio
from dunlin.operators.percentiles import percentile_exc, percentile_inc, quartile_band
from dunlin.sources.checkpoints import cut_lineage


def _ratio(num, den) -> Column:
    total = lambda cols: sum(F.sum(c) for c in ([cols] if isinstance(cols, str) else cols))
    return ratio(total(num), total(den))


# Measure name -> (numerator columns, denominator column).
INVENTORY = {
    "avg_balance": ("balances", "accounts"),
    "call_penetration": ("calls", "accounts"),
    "unq_call_penetration": ("unq_calls", "accounts"),
    "rpc_call_penetration": ("rpc_calls", "accounts"),
    "unq_rpc_call_penetration": ("unq_rpc_calls", "accounts"),
    "letter_penetration": ("letters", "accounts"),
    "unq_letter_penetration": ("unq_letters", "accounts"),
    "account_conversion": ("unq_payers", "accounts"),
    "payments_per_call": ("payments", "calls"),
    "liquidation": ("payments", "balances"),
    "gross_unit_yield": ("payments", "accounts"),
    "call_penetration_ob": ("calls_ob", "accounts"),
    "call_penetration_ib": ("calls_ib", "accounts"),
    "unq_rpc_call_penetration_ib": ("unq_rpc_calls_ib", "accounts"),
    "unq_rpc_call_penetration_ob": ("unq_rpc_calls_ob", "accounts"),
    "sms_penetration": ("sms_sent", "accounts"),
    "unq_sms_penetration": ("unq_sms_sent", "accounts"),
    "email_penetration": ("emails_sent", "accounts"),
    "unq_email_penetration": ("unq_emails_sent", "accounts"),
    "channel_penetration": (("calls", "sms_sent", "emails_sent", "letters"), "accounts"),
}
MESSAGE = {
    "bounce_rate": ("bounced", "sent"),
    "delivered_rate": ("delivered", "sent"),
    "open_rate": ("unq_opens", "delivered"),
    "optout_rate": ("optouts", "delivered"),
    "spam_rate": ("marked_as_spam", "delivered"),
    "click_rate": ("clicks", "delivered"),
    "pay_rate": ("payers", "delivered"),
    "paid_per_delivered": ("payments", "delivered"),
    "scrub_rate": (("invalid_scrubbed", "optout_scrubbed", "whitelist_scrubbed"), "requested"),
    "overall_open_rate": ("total_opens", "delivered"),
    "clicks_to_opens": ("clicks", "unq_opens"),
}
COHORT = {
    "unq_scrub_rate": (("unq_invalid_scrubbed", "unq_optout_scrubbed", "unq_whitelist_scrubbed"),
                       "unq_requested"),
    "unq_bounce_rate": ("unq_bounced", "unq_sent"),
    "unq_delivered_rate": ("unq_delivered", "unq_sent"),
    "unq_open_rate": ("unq_opens", "unq_delivered"),
    "unq_optout_rate": ("unq_optouts", "unq_delivered"),
    "unq_spam_rate": ("unq_spam", "unq_delivered"),
    "unq_click_rate": ("unq_clicks", "unq_delivered"),
    "unq_pay_rate": ("payers", "unq_delivered"),
    "unq_paid_per_delivered": ("payments", "unq_delivered"),
}
CLICK_TARGET = {
    "pct_with_click": ("clicks", "delivered"),
    "pct_clicked_website": ("clicks_website", "delivered"),
    "pct_clicked_privacy": ("clicks_privacy", "delivered"),
    "pct_clicked_regulator": ("clicks_regulator", "delivered"),
}
CONTACT = {
    "intensity": ("attempts", "phones"),
    "contact_pct_per_phone": ("unq_contacts", "phones"),
    "wrong_pct_per_phone": ("unq_wrong", "phones"),
    "contact_pct_per_attempt": ("contacts", "attempts"),
    "wrong_pct_per_attempt": ("wrong", "attempts"),
}
# Response-delay bands in minutes, upper edge included.
DELAY_BANDS = ((5, "0to5"), (10, "6to10"), (15, "11to15"), (20, "16to20"), (25, "21to25"),
               (30, "26to30"))
DELAY_REST = "30plus"


def registry(specs: Mapping, available: Sequence[str] | None = None) -> dict[str, Column]:
    """Ratio measures as aggregate columns; with ``available``, only those whose columns exist."""
    def usable(num, den):
        cols = [num] if isinstance(num, str) else list(num)
        return available is None or set([*cols, den]) <= set(available)

    return {name: _ratio(num, den) for name, (num, den) in specs.items() if usable(num, den)}


def channel_totals(cols: Sequence[str], out="total_attempts") -> dict[str, Column]:
    return {out: sum(F.sum(c) for c in cols)}


def by_dimension(
    df: DataFrame, dim: str | None, measures: Mapping[str, Column], allowed: Sequence[str] = ()
) -> DataFrame:
    """Evaluate measures per value of one dimension (or in total), from an allow-list."""
    if dim is None:
        return df.agg(*[m.alias(n) for n, m in measures.items()])
    if allowed and dim not in allowed:
        raise ValueError(f"{dim!r} is not one of {list(allowed)}")
    return df.groupBy(dim).agg(*[m.alias(n) for n, m in measures.items()])


def response_curve(df: DataFrame, keys: Sequence[str], kind: str, delay: str, kinds: Sequence[str]):
    """Per response kind: counts per delay band, their total, and each band's share."""
    labels = [label for _, label in DELAY_BANDS] + [DELAY_REST]
    band = None
    for edge, label in DELAY_BANDS:
        hit = F.col(delay) <= edge
        band = F.when(hit, label) if band is None else band.when(hit, label)
    banded = df.where(F.col(delay).isNotNull()).withColumn("__band", band.otherwise(DELAY_REST))
    cells = {
        f"{k}_{label}": F.count_if((F.col(kind) == k) & (F.col("__band") == label))
        for k in kinds for label in labels
    }
    counted = banded.groupBy(*keys).agg(*[c.alias(n) for n, c in cells.items()])
    total = {k: sum(F.col(f"{k}_{label}") for label in labels) for k in kinds}
    shares = {
        f"{k}_{label}_share": ratio(F.col(f"{k}_{label}"), total[k])
        for k in kinds for label in labels
    }
    return counted.withColumns({f"total_{k}": t for k, t in total.items()}).withColumns(shares)


def message_calculated_columns(df: DataFrame, day: str, delivered: str, unit_saving: float):
    """Row-level columns of the message model: labels, sort keys, savings."""
    d = F.col(day)
    return df.withColumns({
        "month_label": F.date_format(d, "MMM-yy"),
        "month_sort": F.year(d) * 100 + F.month(d),
        "month_start": F.trunc(d.cast("date"), "MM"),
        "day_of_week": F.date_format(d, "E"),
        "day_of_week_no": F.weekday(d.cast("date")) + 1,
        "savings": F.col(delivered) * F.lit(unit_saving),
    })


def contact_percentiles(
    df: DataFrame, dims: Sequence[str], num="unq_contacts", den="phones", wrong="unq_wrong"
) -> DataFrame:
    """Percentiles of the contact rate over the rows of a summary by ``dims``: the exclusive
    median, the inclusive median and 75th percentile, and each row's quartile band. The ``row_*``
    columns are taken over the rows of ``df`` themselves: exclusive medians of the contact and the
    wrong-party rate, inclusive 75th percentile of the contact rate.

    The model's "75th" and "50th" percentile measures evaluate 0.5 and 0.25; the levels here
    are the ones their names state."""
    rates = cut_lineage(df.groupBy(*dims).agg(_ratio(num, den).alias("rate")))  # read five times
    banded = quartile_band(rates, "rate", "quartile")
    median = percentile_exc(rates, [], "rate", {"p": 0.5}).first()
    inc = percentile_inc(rates, [], "rate", {"p50": 0.5, "p75": 0.75}).first()
    rate = lambda kind, c: F.struct(F.lit(kind).alias("kind"), ratio(F.col(c), F.col(den)).alias("rate"))
    each = cut_lineage(df.select(F.inline(F.array(rate("contact", num), rate("wrong", wrong)))))
    row_exc = {r["kind"]: r["p"] for r in percentile_exc(each, ["kind"], "rate", {"p": 0.5}).collect()}  # two rows
    row_inc = {r["kind"]: r["p"] for r in percentile_inc(each, ["kind"], "rate", {"p": 0.75}).collect()}
    number = lambda v: F.lit(v).cast("double")
    return banded.withColumns({
        "median_exc": number(median["p"] if median else None),
        "median_inc": number(inc["p50"] if inc else None),
        "p75_inc": number(inc["p75"] if inc else None),
        "row_median_exc": number(row_exc.get("contact")),
        "row_wrong_median_exc": number(row_exc.get("wrong")),
        "row_p75_inc": number(row_inc.get("contact")),
    })
