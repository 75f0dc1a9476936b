"""Join operators. No broadcast hints on data: Spark broadcasts a side whose estimated or
measured size is below its threshold and shuffles otherwise; AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.functions.dates import day_diff
from dunlin.operators.slices import Hot
from dunlin.operators.windows import _list, fill_forward, neighbours, running_total
from dunlin.sources.checkpoints import cut_lineage


_EPOCH, _MIRROR = "1970-01-01", "2500-01-01"


def star_join(fact: DataFrame, dims: Sequence[tuple], how: str = "left") -> DataFrame:
    """Join a fact to dimensions. Each entry is ``(dim, fact key, dim key)`` or
    ``(dim, shared key)``. Use ``how="inner"`` where a filter on dimension columns would
    undo a left join anyway."""
    out = fact
    for dim, *keys in dims:
        if len(keys) == 1:
            out = out.join(dim, _list(keys[0]), how)
        else:
            out = out.join(dim, F.col(keys[0]) == F.col(keys[1]), how)
    return out


def left_expand(df: DataFrame, other: DataFrame, on: Sequence[str], cols: Sequence[str]):
    """Left outer lookup that adds only ``cols``."""
    return df.join(other.select(*on, *cols), list(on), "left")


def missing_keys(fact: DataFrame, mapping: DataFrame, key: str, count_as="n") -> DataFrame:
    """Keys that facts use and the mapping lacks, with their row counts. Counting first
    shrinks the anti join to one row per key."""
    counted = fact.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(count_as)
    )
    return counted.join(mapping.select(key).distinct(), key, "left_anti")


def anti(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    return df.join(other.select(*_list(keys)).distinct(), _list(keys), "left_anti")


def semi(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    return df.join(other.select(*_list(keys)), _list(keys), "left_semi")


def allowed_detail(df: DataFrame, allowed: DataFrame, key) -> DataFrame:
    """Detail rows whose parent is visible (a semi join, so parents never duplicate rows)."""
    return semi(df, allowed, key)


def allow_list(
    df: DataFrame, allow: DataFrame, keys: Sequence[str], class_col: str, classes: Sequence[str]
) -> DataFrame:
    """Keep rows of the listed classes, and rows whose ``keys`` are on the allow list."""
    listed = allow.select(*keys).distinct().withColumn("__ok", F.lit(True))
    kept = F.col(class_col).isin(list(classes)) | F.col("__ok").isNotNull()
    return df.join(listed, list(keys), "left").where(kept).drop("__ok")


def dim_spine(dim: DataFrame, start, end, out: str, grain: str = "day") -> DataFrame:
    """Every dimension row with every period of the range: an explode on the dimension rows
    instead of a cross join."""
    step = {"day": "interval 1 day", "month": "interval 1 month"}[grain]
    series = F.expr(f"sequence(date'{start}', date'{end}', {step})")
    return dim.withColumn(out, F.explode(series))


def interval_join(
    left: DataFrame, right: DataFrame, keys, ts_l: str, ts_r: str, lo: int, hi: int
) -> DataFrame:
    """Pairs of the same key whose day distance ``d(left, right)`` lies in ``lo..hi``.

    The time axis is cut into buckets as wide as the interval, so the equi join is on (key,
    bucket): each left row goes to at most two buckets, and a key with very many rows is
    spread over its buckets.
    """
    keys = _list(keys)
    width = hi - lo + 1
    day_l = F.datediff(F.col(ts_l).cast("date"), F.lit("1970-01-01").cast("date"))
    day_r = F.datediff(F.col(ts_r).cast("date"), F.lit("1970-01-01").cast("date"))
    first, last = F.floor((day_l + lo) / width), F.floor((day_l + hi) / width)
    spread = left.withColumn("__bucket", F.explode(F.sequence(first, last)))
    placed = right.withColumn("__bucket", F.floor(day_r / width))
    gap = day_diff(F.col(ts_l), F.col(ts_r))
    return spread.join(placed, [*keys, "__bucket"]).where(gap.between(lo, hi)).drop("__bucket")


def between_join(points, spans, key, t: str, lo: str, hi: str) -> DataFrame:
    """Points that lie between two offsets of their own key (``spans``: few rows per key)."""
    inside = F.col(t).between(F.col(lo), F.col(hi))
    return points.join(spans, _list(key)).where(inside)


def after_join(points, anchors, key, t: str, anchor: str, inclusive=True) -> DataFrame:
    """Points at or after (or strictly after) the anchor of their key."""
    later = F.col(t) >= F.col(anchor) if inclusive else F.col(t) > F.col(anchor)
    return points.join(anchors, _list(key)).where(later)


LEAD = 8  # characters of a pattern's literal start that key its join
RULE_BATCH = 1_000  # rules without a literal start that a name is tested against in one row


def _trigrams(text):
    """Distinct runs of three characters of a text."""
    return F.when(F.length(text) >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def _required_trigrams(pattern):
    """Trigrams that every match of a LIKE pattern holds; none for a pattern with escapes."""
    literal = F.when(F.contains(pattern, F.lit("\\")), F.array().cast("array<string>")).otherwise(F.split(pattern, "[%_]"))
    return F.array_distinct(F.flatten(F.transform(literal, _trigrams)))


def pattern_join(df: DataFrame, rules: DataFrame, col: str, pattern_col: str) -> DataFrame:
    """Attach the rules whose LIKE pattern matches ``col``: the columns of ``df``, ``col``
    first, then those of ``rules``. NULL names and NULL patterns match nothing.

    Patterns are tested once per distinct name and the match is joined back on the name, so
    fact rows never meet patterns. A rule with a literal start is joined on its first
    characters to the starts of the names, with LIKE as a filter. A rule that begins with a
    wildcard is found by an index of trigrams: of those in its literal parts, which a name must
    hold, the one that fewest names hold keys its join. Rules without three literal characters
    in a row have no key: they are grouped into batches of about ``RULE_BATCH`` by hash, and
    each name filters each batch."""
    names = df.select(col).where(F.col(col).isNotNull()).distinct()
    lead = F.regexp_extract(F.col(pattern_col), r"^[^%_\\]*", 0)
    keyed = rules.select(F.struct("*").alias("__rule"), F.left(lead, F.lit(LEAD)).alias("__key"))

    def matches(rule):
        return F.like(F.col(col), rule[pattern_col])

    lengths = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(LEAD), F.length(col))))
    starts = names.withColumn("__key", F.explode(F.transform(lengths, lambda n: F.left(F.col(col), n))))
    matched = starts.join(keyed.where("__key <> ''"), "__key").where(matches(F.col("__rule"))).select(col, "__rule.*")
    loose = keyed.where("__key = ''").select("__rule", _required_trigrams(F.col("__rule")[pattern_col]).alias("__grams"))
    indexed, loose = loose.where("size(__grams) > 0"), loose.where("size(__grams) = 0").select("__rule")
    if not indexed.isEmpty():
        held = cut_lineage(names.select(col, F.explode(_trigrams(F.col(col))).alias("__gram")))
        asked = indexed.select("__rule", F.explode("__grams").alias("__gram"))
        counts = held.join(asked.select("__gram").distinct(), "__gram", "left_semi").groupBy("__gram").agg(
            F.count(F.lit(1)).alias("__n"))
        rarest = asked.join(counts, "__gram", "left").groupBy("__rule").agg(
            F.min_by("__gram", F.struct(F.coalesce("__n", F.lit(0)), "__gram")).alias("__gram"))
        found = held.join(rarest, "__gram").where(matches(F.col("__rule"))).select(col, "__rule.*")
        matched = matched.union(found)
    batches = -(-loose.count() // RULE_BATCH)
    if batches:
        numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(batches - 1).cast("bigint"))
        batched = loose.groupBy(F.pmod(F.xxhash64("__rule"), F.lit(batches)).alias("__batch")).agg(
            F.collect_list("__rule").alias("__rules"))
        tested = names.withColumn("__batch", F.explode(numbers)).join(batched, "__batch")
        matched = matched.union(tested.select(col, F.inline(F.filter("__rules", matches))))
    return df.join(matched, col)


def asof_join(
    left: DataFrame, right: DataFrame, keys, ts_l: str, ts_r: str, cols: Sequence[str],
    tie: Sequence[str] = (), strict: bool = False, forward: bool = False, hot: Hot | None = None,
) -> DataFrame:
    """For each left row, the nearest right row of its key at or before ``ts_l`` (``forward``:
    at or after). ``tie`` orders right rows with equal time; the last one wins backward, the
    first one forward. Adds ``ts_r`` and ``cols``; unmatched rows get NULL.

    One right row per (key, time) is kept by a combined aggregate, then both sides are
    stacked and the latest value is filled forward: no pairs are produced.
    """
    keys = _list(keys)
    order = F.struct(ts_r, *tie)
    pick = F.min_by if forward else F.max_by
    payload = F.struct(F.col(ts_r).alias(ts_r), *cols)
    best = right.groupBy(*keys, F.col(ts_r).alias("__t")).agg(
        pick(payload, order).alias("__hit")
    )
    first_left = strict != forward
    own = left.columns
    stacked = left.withColumns(
        {"__t": F.col(ts_l), "__left": F.lit(True), "__seq": F.lit(0 if first_left else 1)}
    ).unionByName(
        best.withColumns({"__left": F.lit(False), "__seq": F.lit(1 if first_left else 0)}),
        allowMissingColumns=True,
    )
    filler = _fill_backward if forward else fill_forward
    filled = filler(stacked, keys, "__t", "__hit", "__match", tie=["__seq"], hot=hot)
    return filled.where("__left").select(
        *own, *[F.col(f"__match.{c}").alias(c) for c in (ts_r, *cols)]
    )


def _fill_backward(df, keys, ts, col, out, tie=(), hot=None):
    """First non-null value after each row: fill forward on the mirrored time axis."""
    mirrored = F.lit(_MIRROR).cast("timestamp_ntz") - (
        F.col(ts) - F.lit(_EPOCH).cast("timestamp_ntz")
    )
    flipped = df.withColumns({"__rev": mirrored, **{f"__m_{c}": -F.col(c) for c in tie}})
    filled = fill_forward(flipped, keys, "__rev", col, out, tie=[f"__m_{c}" for c in tie],
                          hot=hot)
    return filled.drop("__rev", *[f"__m_{c}" for c in tie])


def match_reversals(
    payments: DataFrame, reversals: DataFrame, keys, amount: str, ts_p: str, ts_r: str, days: int,
    hot: Hot | None = None,
) -> DataFrame:
    """Payments with the first reversal of the same key and absolute amount within ``days``
    days after them (columns ``reversed_on`` and ``reversed_amount``, NULL without one).

    The reference window only bounds reversals before the payment; the intended window is
    the one after it. The reversed amount is returned as an absolute value because sources
    disagree on its sign."""
    keys = _list(keys)
    right = reversals.select(
        *keys, F.abs(amount).alias("__abs"), F.col(ts_r).cast("timestamp_ntz").alias("reversed_on"),
        F.abs(amount).alias("reversed_amount"),
    )
    left = payments.withColumns(
        {"__abs": F.abs(amount), "__paid_on": F.col(ts_p).cast("timestamp_ntz")}
    )
    matched = asof_join(
        left, right, [*keys, "__abs"], "__paid_on", "reversed_on", ["reversed_amount"],
        forward=True, hot=hot,
    )
    near = day_diff(F.col("__paid_on"), F.col("reversed_on")) <= days
    return (
        matched.withColumn("reversed_amount", F.when(near, F.col("reversed_amount")))
        .withColumn("reversed_on", F.when(near, F.col("reversed_on")))
        .drop("__abs", "__paid_on")
    )


def match_reversals_once(
    payments: DataFrame, reversals: DataFrame, keys, amount: str, ts_p: str, ts_r: str, days: int,
    id_p: str, id_r: str, hot: Hot | None = None,
) -> DataFrame:
    """Payments with the one reversal that undoes them, each reversal undoing one payment: it
    takes the latest payment of its key and absolute amount, at or before it, that no earlier
    reversal has taken, if that is at most ``days`` days back. Adds ``reversed_on`` and
    ``reversal_id`` (text; NULL without one). Equal times: payments first, then by id.

    Payments open a level and reversals close the last one, like brackets: a running sum of +1
    and -1 gives the level, and within a level the row after a payment is its reversal. No
    pairs are formed, and large keys are split as for any ordered operator."""
    by, own = [*_list(keys), "__abs"], payments.columns

    def rows(df, ts, id_col, kind, row):
        return df.select(
            *_list(keys), F.abs(amount).alias("__abs"), F.col(ts).cast("timestamp_ntz").alias("__t"), F.lit(kind).alias("__kind"),
            F.col(id_col).cast("string").alias("__id"), row.alias("__row"))

    paid = rows(payments, ts_p, id_p, 0, F.struct(*own))
    back = rows(reversals, ts_r, id_r, 1, F.lit(None).cast(paid.schema["__row"].dataType))
    step = F.when(F.col("__kind") == 0, 1).otherwise(-1)
    levels = running_total(paid.unionByName(back), by, ["__t", "__kind", "__id"], step, "__sum", hot=hot)
    levels = levels.withColumn("__level", F.col("__sum") + F.col("__kind"))
    after = neighbours(
        levels, [*by, "__level"], "__t", {f"__next{c}": (c, -1) for c in ("__kind", "__t", "__id")}, tie=["__kind", "__id"], hot=hot)
    taken = (F.col("__next__kind") == 1) & (day_diff(F.col("__t"), F.col("__next__t")) <= days)
    return after.where("__kind = 0").select(
        "__row.*", F.when(taken, F.col("__next__t")).alias("reversed_on"), F.when(taken, F.col("__next__id")).alias("reversal_id"))


def match_by_reference(
    payments: DataFrame, reversals: DataFrame, keys, ref: str, id_col: str, amount: str
) -> DataFrame:
    """Payments with the summed absolute amount of the reversals that carry the same reference
    under another id (NULL without one): the reference's total less the row's own part, so no
    payment x reversal pairs are formed."""
    grp = [*_list(keys), ref]
    value = F.abs(amount)
    totals = reversals.groupBy(*grp).agg(
        F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__n")
    )
    own = reversals.groupBy(id_col).agg(
        F.sum(value).alias("__own"), F.count(F.lit(1)).alias("__own_n")
    )
    joined = payments.join(totals, grp, "left").join(own, id_col, "left")
    others = F.col("__n") - F.coalesce("__own_n", F.lit(0))
    rest = F.col("__sum") - F.coalesce("__own", F.lit(0))
    return joined.withColumn("reversed_amount", F.when(others > 0, rest)).drop(
        "__sum", "__n", "__own", "__own_n"
    )


def coalesce_join(df: DataFrame, sources: Sequence[DataFrame], on, cols: Sequence[str]):
    """Look the key up in several sources; the first non-null value wins."""
    on, out = _list(on), df
    for i, source in enumerate(sources):
        renamed = source.select(*on, *[F.col(c).alias(f"__{c}_{i}") for c in cols])
        out = out.join(renamed, on, "left")
    picked = {c: F.coalesce(*[F.col(f"__{c}_{i}") for i in range(len(sources))]) for c in cols}
    return out.withColumns(picked).drop(
        *[f"__{c}_{i}" for c in cols for i in range(len(sources))]
    )


def join_date_key(df: DataFrame, key_col: str, dim_date: DataFrame, how="inner") -> DataFrame:
    """Join an integer ``yyyymmdd`` key to the calendar (column ``date_key``)."""
    return df.join(dim_date, F.col(key_col) == F.col("date_key"), how)


def join_on_date(df: DataFrame, ts: str, dim_date: DataFrame, how="left") -> DataFrame:
    """Join a timestamp to the calendar (column ``day``) on its date part only."""
    return df.join(dim_date, F.col(ts).cast("date") == F.col("day"), how)


def assemble(spine: DataFrame, feeds: Sequence[DataFrame], keys, zero: Mapping | None = None):
    """Left join pre-aggregated feeds (one row per key) onto a spine; ``zero`` fills."""
    keys = _list(keys)
    out = reduce(lambda left, feed: left.join(feed, keys, "left"), feeds, spine)
    return out.fillna(dict(zero)) if zero else out

