"""Ordered, join, aggregate and ranking operators, on both the plain and the split path."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dunlin.operators import aggregates, joins, percentiles, ranking, sets, windows
from dunlin.operators.slices import PLACE, SLICE, split_hot
from tests.conftest import day, rows, ts

SEED = 7


def log(spark, n=240, hot_share=0.5):
    """Rows of a few keys, one of them holding half of the rows; some equal times and NULLs."""
    rng = random.Random(SEED)
    data = []
    for i in range(n):
        key = 1 if rng.random() < hot_share else rng.choice([2, 3, 4, None])
        at = ts(f"2024-01-{rng.randint(1, 4):02d} {rng.randint(0, 3):02d}:{rng.randint(0, 5):02d}:00")
        data.append((i, key, at, rng.choice([None, float(rng.randint(1, 9))])))
    return spark.createDataFrame(data, "id bigint, key bigint, at timestamp_ntz, v double")


def both_paths(spark, fn, *cols):
    """Run an operator plainly and with every key above 8 rows split; return both results."""
    spark.conf.unset("dunlin.hotKeyRows")
    plain = rows(fn(), *cols)
    spark.conf.set("dunlin.hotKeyRows", "8")
    try:
        return plain, rows(fn(), *cols)
    finally:
        spark.conf.unset("dunlin.hotKeyRows")


def test_slices_are_made_only_for_large_keys(hot):
    df = log(hot)
    plain, sliced = split_hot(df, ["key"], ["at", "id"])
    sizes = df.groupBy("key").count().where("count > 8").select("key")
    assert rows(sliced.select("key").distinct()) == rows(sizes)
    assert rows(plain.select("id").unionByName(sliced.select("id"))) == rows(df.select("id"))


def hot_tables(spark):
    """Large keys of every kind: sparse, a single time, one time for half of the rows, many
    phones, texts and dates as order, NULL times, and full ties."""
    rng, base = random.Random(3), dt.datetime(2024, 1, 1)
    at = {
        "sparse": lambda i: base + dt.timedelta(days=7 * i), "single": lambda i: base, "null": lambda i: None,
        "half": lambda i: base if i % 2 else base + dt.timedelta(minutes=rng.randint(-30, 30)),
    }
    data = [(1_000 * k + i, name, f(i), f"p{rng.randint(0, 40):02d}", rng.choice([None, 1.0, 2.5]), i % 5)
            for k, (name, f) in enumerate(at.items()) for i in range(90)]
    data += [(9_000 + i, None, base, None, 1.0, 0) for i in range(40)]
    df = spark.createDataFrame(data, "id bigint, key string, at timestamp_ntz, phone string, v double, t int")
    return df.withColumn("day", F.to_date("at"))


@pytest.mark.parametrize("order", [["at", "id"], ["phone", "at", "id"], ["day", "phone", "id"], ["t", "id"]])
def test_large_keys_of_any_shape_equal_the_plain_window(spark, order):
    df = hot_tables(spark)
    outs = {"p1": ("id", 1), "p2": ("phone", 2, "none"), "n1": ("v", -1)}
    ts_, tie = order[0], order[1:]
    for fn, cols in (
        (lambda: windows.neighbours(df, "key", ts_, outs, tie=tie), list(outs)),
        (lambda: windows.attempt_no(df, "key", ts_, tie=tie), ["rank_no", "row_no"]),
        (lambda: windows.running_sum(df, "key", ts_, "v", "s"), ["s"]),
        (lambda: windows.fill_forward(df, "key", ts_, "v", "f", tie=tie), ["f"]),
    ):
        plain, split = both_paths(spark, fn, "id", *cols)
        assert plain == split and len(plain) == df.count()


@pytest.mark.parametrize("limit", [8, 50])
def test_slices_stay_below_the_limit_with_few_edges(spark, limit):
    df = hot_tables(spark)
    spark.conf.set("dunlin.hotKeyRows", str(limit))
    try:
        for order in (["at"], ["phone", "at"], ["t"]):
            _, sliced = split_hot(df, ["key"], order)
            sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
            assert sum(sizes) == (400 if limit == 8 else 360) and max(sizes) <= limit and len(sizes) <= 4 * df.count() / limit
            assert sliced.groupBy(SLICE, PLACE).count().where("count > 1").count() == 0
    finally:
        spark.conf.unset("dunlin.hotKeyRows")


def test_percentiles_of_large_integers_and_decimals_are_exact(spark):
    big = 2**53
    data = [(k % 2, big + 2 * k + 1, decimal.Decimal(10**37 + 3 * k)) for k in range(201)]
    df = spark.createDataFrame(data, "g int, i bigint, d decimal(38,0)")
    want = {g: sorted(r[1] for r in data if r[0] == g) for g in (0, 1)}
    for limit in ("2000000", "10"):
        spark.conf.set("dunlin.hotKeyRows", limit)
        try:
            got = rows(percentiles.percentile_inc(df.where("g = 0"), ["g"], "i", {"m": 0.5, "q": 0.25}, exact=True))
            assert got == [(0, decimal.Decimal(want[0][50]), decimal.Decimal(want[0][25]))]
            one = percentiles.percentile_inc(df, [], "d", {"m": 0.5}, exact=True).first().m
            assert one == 10**37 + 300
            bands = percentiles.quartile_band(df.where("g = 0"), "i", "b").groupBy("b").count()
            assert rows(bands) == [(1, 26), (2, 25), (3, 25), (4, 25)]
        finally:
            spark.conf.unset("dunlin.hotKeyRows")


@pytest.mark.parametrize("outs", [
    {"p1": ("id", 1), "p3": ("id", 3), "n1": ("id", -1), "pv": ("v", 2, -1.0)},
    {"n2": ("id", -2)},
])
def test_neighbours(spark, outs):
    df = log(spark)
    plain, split = both_paths(
        spark, lambda: windows.neighbours(df, "key", "at", outs, tie=["id"]), "id", *outs)
    assert plain == split and len(plain) == 240


def test_running_sum_peers_share(spark):
    df = log(spark)
    plain, split = both_paths(spark, lambda: windows.running_sum(df, "key", "at", "v", "s"), "id", "s")
    assert plain == split
    peers = windows.running_sum(df, "key", "at", "v", "s").groupBy("key", "at").agg(
        F.count_distinct("s").alias("n"))
    assert peers.where("n > 1").count() == 0


def test_attempt_numbers(spark):
    df = log(spark)
    plain, split = both_paths(
        spark, lambda: windows.attempt_no(df, "key", "at", tie=["id"]), "id", "rank_no", "row_no")
    assert plain == split


@pytest.mark.parametrize("strict", [True, False])
def test_fill_forward_equals_lateral_lookup(spark, strict):
    df = log(spark)
    plain, split = both_paths(
        spark, lambda: windows.fill_forward(df, "key", "at", "v", "f", strict=strict, tie=["id"]), "id", "f")
    assert plain == split
    local = [tuple(r) for r in df.collect()]

    def lookup(i, key, at, v):
        earlier = [(t, j, x) for j, k, t, x in local if k == key and x is not None
                   and ((t, j) < (at, i) or (not strict and j == i))]
        return max(earlier)[2] if earlier else None

    assert plain == sorted(((i, lookup(i, k, t, v)) for i, k, t, v in local), key=repr)


@pytest.mark.parametrize("strict,forward", [(False, False), (True, False), (False, True), (True, True)])
def test_asof_join_equals_brute_force(spark, strict, forward):
    df = log(spark, 120).where("key is not null")
    left = df.where("id % 2 = 0").select("id", "key", "at")
    right = df.where("id % 2 = 1").select("key", F.col("at").alias("rt"), F.col("id").alias("rid"))
    plain, split = both_paths(
        spark, lambda: joins.asof_join(left, right, "key", "at", "rt", ["rid"], tie=["rid"],
                                       strict=strict, forward=forward), "id", "rid")
    assert plain == split
    r = [tuple(x) for x in right.collect()]

    def match(key, at):
        if forward:
            near = [(t, j) for k, t, j in r if k == key and (t > at if strict else t >= at)]
            return min(near)[1] if near else None
        near = [(t, j) for k, t, j in r if k == key and (t < at if strict else t <= at)]
        return max(near)[1] if near else None

    assert plain == sorted(((i, match(k, t)) for i, k, t in (tuple(x) for x in left.collect())), key=repr)


def test_input_order_does_not_matter(spark):
    df = log(spark)
    shuffled = df.orderBy(F.rand(3))
    a = rows(windows.neighbours(df, "key", "at", {"p": ("id", 1)}, tie=["id"]), "id", "p")
    assert a == rows(windows.neighbours(shuffled, "key", "at", {"p": ("id", 1)}, tie=["id"]), "id", "p")


def test_partitioned_lag_equals_unpartitioned_lag_with_key_check(spark):
    from pyspark.sql import Window

    df = log(spark).where("key is not null")
    whole = Window.orderBy("key", "at", "id")
    naive = df.select("id", F.when(F.lag("key").over(whole) == F.col("key"), F.lag("id").over(whole)).alias("p"))
    assert rows(naive) == rows(windows.neighbours(df, "key", "at", {"p": ("id", 1)}, tie=["id"]), "id", "p")


def test_days_since_prev(spark):
    df = spark.createDataFrame([(1, ts("2024-01-01 23:00")), (1, ts("2024-01-02 01:00"))], "k int, t timestamp_ntz")
    assert rows(windows.days_since_prev(df, "k", "t"), "days_since_prev") == [(1,), (None,)]


def test_first_and_last_per(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 2, "c"), (2, None, "z")], "k int, t int, v string")
    assert rows(windows.first_per(df, "k", ["t", "v"])) == [(1, 1, "a"), (2, None, "z")]
    assert rows(windows.last_per(df, "k", ["t", "v"])) == [(1, 2, "c"), (2, None, "z")]


def test_backfill_two_stage(spark):
    full = spark.createDataFrame(
        [(1, 1, "old"), (1, 5, None), (2, 5, None), (2, 6, "new"), (3, 5, None)], "k int, t int, p string")
    out = windows.backfill_two_stage(full.where("t >= 5"), full, "k", "t", "p", "f")
    assert rows(out, "k", "t", "f") == [(1, 5, "old"), (2, 5, "new"), (2, 6, "new"), (3, 5, None)]


@pytest.mark.parametrize("method", ["inc", "exc"])
def test_percentiles(spark, method):
    rng = random.Random(SEED)
    data = [(k, float(rng.randint(0, 30))) for k in (1, 2, None) for _ in range(60 if k == 1 else 3)]
    df = spark.createDataFrame(data + [(1, None)], "k int, v double")
    ps = {"a": 0.1, "b": 0.5, "c": 0.9}
    plain, split = both_paths(spark, lambda: percentiles.percentile_by_rank(df, ["k"], "v", ps, method))
    assert plain == split

    def exact(values, p):
        x, n = sorted(values), len(values)
        pos = p * (n - 1) + 1 if method == "inc" else p * (n + 1)
        if not 1 <= pos <= n:
            return None
        lo = int(np.floor(pos))
        hi = int(np.ceil(pos))
        return x[lo - 1] + (pos - lo) * (x[hi - 1] - x[lo - 1])

    for k, *got in plain:
        values = [v for kk, v in data if kk == k]
        for p, g in zip(ps.values(), got):
            want = exact(values, p)
            assert (g is None) == (want is None) and (want is None or abs(g - want) < 1e-9)


@pytest.mark.parametrize("desc", [True, False])
def test_deciles_equal_ntile_with_frequent_values(spark, desc):
    from pyspark.sql import Window

    rng = random.Random(SEED)
    data = [(i, rng.choice([None, 5.0, 5.0, 5.0, float(rng.randint(0, 50))])) for i in range(1003)]
    df = spark.createDataFrame(data, "id bigint, v double")
    value = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    want = df.select("id", F.ntile(10).over(Window.orderBy(value, "id")).alias("d"))
    spark.conf.unset("dunlin.hotKeyRows")
    assert rows(percentiles.deciles(df, "v", "id", "d", desc=desc), "id", "d") == rows(want)
    for limit in ("20", "1"):
        spark.conf.set("dunlin.hotKeyRows", limit)
        assert rows(percentiles.deciles(df, "v", "id", "d", desc=desc), "id", "d") == rows(want)
    spark.conf.unset("dunlin.hotKeyRows")


def test_approximate_deciles_cover_all_bands(spark):
    df = spark.range(1000).withColumn("v", F.col("id").cast("double"))
    out = percentiles.deciles(df, "v", "id", "d", exact=False).groupBy("d").count()
    assert {r["d"] for r in out.collect()} == set(range(1, 11))


def test_quartile_band(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)], "v double")
    assert rows(percentiles.quartile_band(df, "v", "q")) == [
        (1.0, 1), (2.0, 1), (3.0, 2), (4.0, 2), (5.0, 3), (6.0, 3), (7.0, 4), (8.0, 4)]


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(SEED)
    left = [(i, rng.randint(1, 2), day(f"2024-01-{rng.randint(1, 28):02d}")) for i in range(40)]
    right = [(i, rng.randint(1, 2), day(f"2024-02-{rng.randint(1, 20):02d}")) for i in range(40)]
    a = spark.createDataFrame(left, "i int, k int, a date")
    b = spark.createDataFrame(right, "j int, k int, b date")
    want = sorted(((i, j) for i, k, x in left for j, q, y in right if k == q and 3 <= (y - x).days <= 17), key=repr)
    assert rows(joins.interval_join(a, b, "k", "a", "b", 3, 17), "i", "j") == want


def test_match_reversals_window(spark):
    pay = spark.createDataFrame([(1, 7, 10.0, day("2024-01-10")), (2, 7, 20.0, day("2024-01-10")),
                                 (3, 7, 30.0, day("2024-01-10"))], "id int, k int, amt double, d date")
    rev = spark.createDataFrame([(7, -10.0, day("2024-02-24")), (7, 20.0, day("2024-02-25")),
                                 (7, -30.0, day("2024-01-09"))], "k int, amt double, d date")
    out = joins.match_reversals(pay, rev, "k", "amt", "d", "d", 45)
    assert rows(out, "id", "reversed_amount") == [(1, 10.0), (2, None), (3, None)]


def test_match_by_reference_ignores_own_row(spark):
    pay = spark.createDataFrame([(1, 7, "r", 10.0), (2, 7, "r", 5.0), (3, 7, "s", 1.0)], "id int, k int, ref string, amt double")
    out = joins.match_by_reference(pay, pay.where("id >= 2"), "k", "ref", "id", "amt")
    assert rows(out, "id", "reversed_amount") == [(1, 5.0), (2, None), (3, None)]


def test_pattern_join_matches_like(spark):
    df = spark.createDataFrame([("sms a",), ("sms b",), ("x",), (None,)], "n string")
    rules = spark.createDataFrame([("sms%", 1), ("%a", 2)], "p string, w int")
    assert rows(joins.pattern_join(df, rules, "n", "p"), "n", "w") == [("sms a", 1), ("sms a", 2), ("sms b", 1)]


def test_pattern_join_of_no_rules_keeps_the_columns(spark):
    df = spark.createDataFrame([(1, "sms a")], "z int, n string")
    rules = spark.createDataFrame([("sms%", 1)], "p string, w int")
    none = joins.pattern_join(df, rules.where("w > 1"), "n", "p")
    assert none.columns == joins.pattern_join(df, rules, "n", "p").columns == ["n", "z", "p", "w"]
    assert none.collect() == []


def test_pattern_join_of_many_rules_has_no_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(joins, "RULE_BATCH", 200)
    patterns = [f"{'%' if i % 5 == 0 else ''}name {i}{'%' if i % 3 else '_'}" for i in range(5000)]
    patterns += ["", "%", "a\\%b", None, "_", "n%7_"]
    names = [f"name {i}" for i in range(0, 600, 7)] + ["", "a%b", "axb", "x", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "z int, n string")
    rules = spark.createDataFrame(list(enumerate(patterns)), "r int, p string")
    out = joins.pattern_join(df, rules, "n", "p")
    want = df.crossJoin(rules).where("n like p")
    assert rows(out, "z", "r") == rows(want, "z", "r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan

def test_allow_list(spark):
    df = spark.createDataFrame([("A", 1), ("B", 1), ("B", 2), ("C", 3)], "c string, k int")
    allow = spark.createDataFrame([("B", 2), ("B", 2)], "c string, k int")
    assert rows(joins.allow_list(df, allow, ["c", "k"], "c", ["A"])) == [("A", 1), ("B", 2)]


def test_union_is_idempotent(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "i int, s string")
    assert rows(sets.union_distinct(a, a)) == rows(a.distinct())
    assert sets.union_all(a, a).count() == 6


def test_pivot_keeps_the_total(spark):
    rng = random.Random(SEED)
    data = [(rng.randint(1, 3), rng.randint(1, 9), float(rng.randint(1, 99))) for _ in range(200)]
    df = spark.createDataFrame(data, "k int, slot int, v double")
    wide = aggregates.slot_pivot(df, ["k"], "slot", "v", 5)
    total = sum(sum(v for v in r[1:]) for r in rows(wide))
    assert total == sum(v for _, _, v in data)


def test_distinct_flags_equal_conditional_distinct_counts(spark):
    df = log(spark)
    got = aggregates.distinct_flags(df, ["key"], "v", {"early": F.hour("at") < 2, "late": F.hour("at") >= 2}, total="n")
    want = df.groupBy("key").agg(
        F.count_distinct("v").alias("n"), aggregates.distinct_where("v", F.hour("at") < 2).alias("early"),
        aggregates.distinct_where("v", F.hour("at") >= 2).alias("late"))
    assert rows(got.select("key", "n")) == rows(want.select("key", "n"))


def test_value_list_and_single(spark):
    df = spark.createDataFrame([("g", c) for c in "fbadcea"] + [("h", "z"), ("h", None)], "g string, v string")
    out = df.groupBy("g").agg(aggregates.value_list("v").alias("l"), aggregates.single_or("v", "many").alias("s"))
    assert rows(out) == [("g", "a, b, c, d, e, etc.", "many"), ("h", "z", "z")]
    assert rows(aggregates.value_lists(df, ["g"], "v", "l")) == [("g", "a, b, c, d, e, etc."), ("h", "z")]


def test_top_n_keeps_ties_and_other(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 2), ("e", 1)], "e string, v int")
    assert rows(ranking.top_n(df, "e", F.sum("v"), 2)) == [("Other", 3), ("a", 5), ("b", 5), ("c", 3)]
    assert rows(ranking.top_n(df, "e", F.sum("v"), 1, desc=False, other=None)) == [("e", 1)]


def test_rank_total_is_dense_on_both_paths(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 2)], "e string, v int")
    small = rows(ranking.rank_total(df, "e", F.sum("v")), "e", "rnk")
    spark.conf.set("dunlin.hotKeyRows", "1")
    large = rows(ranking.rank_total(df, "e", F.sum("v")), "e", "rnk")
    spark.conf.unset("dunlin.hotKeyRows")
    assert small == large
    assert small == rows(ranking.rank_total(df, "e", F.sum("v")), "e", "rnk") == [
        ("a", 1), ("b", 1), ("c", 2), ("d", 3)]


def test_yield_index_zero_total(spark):
    df = spark.createDataFrame([("m", 1, 0.0, 5.0), ("m", 2, 0.0, 5.0), ("n", 1, 4.0, 2.0)],
                               "g string, s int, pay double, acc double")
    out = aggregates.yield_index(df, ["g"], "s", "pay", "acc")
    assert rows(out, "g", "s", "yield_idx", "predicted_share") == [
        ("m", 1, 0.0, 0.0), ("m", 2, 0.0, 0.0), ("n", 1, 1.0, 1.0)]


def test_priority_score(spark):
    df = spark.createDataFrame([(1, "Low x"), (1, "High y"), (2, "Mid"), (3, "Low"), (4, "?")], "k int, p string")
    out = aggregates.priority_score(df, "k", "p", [("H", 0.0), ("M", 0.5), ("L", 0.75)], 1.0)
    assert rows(out, "k", "score") == [(1, 0.0), (2, 0.5), (3, 0.75), (4, 1.0)]


def test_global_rank_does_not_depend_on_the_limit(spark):
    from dunlin.operators.percentiles import deciles

    data = [(None if k % 11 == 0 else "v" if k % 2 else f"t{k % 5}", f"tie{k:03d}") for k in range(60)]
    df = spark.createDataFrame(data, "v string, t string")
    days = spark.range(40).selectExpr("date_add(date'2024-01-01', cast(id % 7 as int)) as v", "id as t")
    plain = [rows(deciles(x, "v", "t", "d", desc=desc)) for x in (df, days) for desc in (False, True)]
    spark.conf.set("dunlin.hotKeyRows", "7")
    try:
        cut = [rows(deciles(x, "v", "t", "d", desc=desc)) for x in (df, days) for desc in (False, True)]
    finally:
        spark.conf.unset("dunlin.hotKeyRows")
    assert plain == cut


def test_distinct_flags_without_entity(spark):
    df = spark.createDataFrame([("g", None, True, 2), ("g", 1, True, 3), ("g", 1, False, 4)], "g string, e int, f boolean, s int")
    out = aggregates.distinct_flags(df, ["g"], "e", {"hit": F.col("f")}, ["s"], "all")
    assert rows(out, "g", "all", "hit", "s") == [("g", 1, 1, 9)]


def test_each_reversal_takes_one_payment(spark):
    rng = random.Random(5)
    base = dt.date(2024, 1, 1)
    moves = [(k, "a" if rng.random() < 0.8 else "b", base + dt.timedelta(days=rng.randint(0, 60)), rng.choice([5.0, -5.0, 7.0]))
             for k in range(160)]
    paid, back = [m for m in moves if m[0] % 5 < 3], [m for m in moves if m[0] % 5 >= 3]
    want = {m[0]: None for m in paid}
    for account in "ab":
        for amount in (5.0, 7.0):
            own = [(m[2], kind, str(m[0]), m[0]) for kind, ms in enumerate((paid, back)) for m in ms if m[1] == account and abs(m[3]) == amount]
            unpaid = []
            for day_, kind, text_id, k in sorted(own):
                if kind == 0:
                    unpaid.append((day_, k))
                elif unpaid and (day_ - unpaid[-1][0]).days <= 10:
                    want[unpaid.pop()[1]] = text_id
    schema = "id bigint, account string, on date, amount double"
    p, r = spark.createDataFrame(paid, schema), spark.createDataFrame(back, schema)
    plain, split = both_paths(
        spark, lambda: joins.match_reversals_once(p, r, "account", "amount", "on", "on", 10, "id", "id"), "id", "reversal_id")
    assert dict(plain) == dict(split) == want and any(want.values())


def test_rules_without_a_literal_start_use_trigrams(spark):
    rng = random.Random(6)
    names = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["a_b%c", "xyz", None, ""]
    patterns = [f"%{n[1:4]}%" for n in names[:200] if n] + ["%a%", "%", "_bc%d", "%xyz", "%q%", "%a\\_b%", "%abc%cba%", "%zzz%"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "id int, name string")
    rules = spark.createDataFrame([(p, k) for k, p in enumerate(patterns)], "pattern string, rule int")
    got = rows(joins.pattern_join(df, rules, "name", "pattern"), "id", "rule")
    want = rows(df.crossJoin(rules).where(F.like("name", F.col("pattern"))), "id", "rule")
    assert got == want and len(got) > 1000


def test_bitmaps_merge_to_exact_distinct_counts(spark):
    df = spark.range(3000).selectExpr("id % 3 as g", "cast(id % 2 as int) as m", "if(id % 50 = 0, null, (id * 7919) % 100003) as a")
    months = aggregates.distinct_bitmaps(df, ["g", "m"], "a")
    want = rows(df.groupBy("g").agg(F.count_distinct("a")))
    assert rows(aggregates.count_bitmaps(months, ["g"], "n"), "g", "n") == want
    assert rows(aggregates.count_bitmaps(months, ["g", "m"], "n")) == rows(df.groupBy("g", "m").agg(F.count_distinct("a")))
