"""Column and period semantics that differ from Spark's defaults."""

import datetime as dt

from pyspark.sql import functions as F

from dunlin.functions import dates, labels, text
from dunlin.plans.payments import AGE_BANDS, balance_band, charge_off_age, month_slot
from tests.conftest import day, rows


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def d(text_):
    return F.lit(text_).cast("date")


def test_month_diff_counts_boundaries(spark):
    assert one(spark, dates.month_diff(d("2024-01-31"), d("2024-02-01"))) == 1
    assert one(spark, dates.month_diff(d("2024-02-29"), d("2023-02-28"))) == -12


def test_day_diff_counts_midnights(spark):
    a, b = F.lit("2024-01-01 23:59:59").cast("timestamp_ntz"), F.lit("2024-01-02 00:00:01").cast("timestamp_ntz")
    assert one(spark, dates.day_diff(a, b)) == 1


def test_integer_seconds(spark):
    assert one(spark, text.whole_seconds(F.lit(1499))) == 1
    assert one(spark, text.whole_seconds(F.lit(1500))) == 1


def test_text_len_and_same_text(spark):
    assert one(spark, text.text_len(F.lit("ab  "))) == 2
    assert one(spark, text.same_text(F.lit("NOrth ")) == text.same_text(F.lit("noRTH")))


def test_ratio_is_blank_on_zero(spark):
    assert one(spark, text.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, text.ratio(F.lit(1), F.lit(4))) == 0.25


def test_clean_and_blank(spark):
    assert one(spark, text.clean_str(F.lit("\ta\nb\r"))) == "a b"
    assert one(spark, text.null_if_blank(F.lit("   "))) is None


def test_email_domain_keeps_text_after_first_at(spark):
    assert one(spark, text.email_domain(F.lit("a@b@c"))) == "b@c"


def test_key_rules(spark):
    rules = ["trim", ("without", "Med"), ("before", "-"), "long"]
    assert one(spark, text.norm_key(F.lit(" Med12-3 "), rules)) == 12
    assert one(spark, text.norm_key(F.lit("x"), ["long"])) is None
    assert one(spark, text.norm_key(F.lit("9007199254740993"), ["long"])) == 9007199254740993
    assert one(spark, text.norm_key(F.lit("AB12-01"), [("drop_last", 3, "-")])) == "AB12"


def test_date_keys(spark):
    assert one(spark, dates.to_date_key(d("2024-02-29"))) == 20240229
    assert one(spark, dates.from_date_key(F.lit(20240229))) == day("2024-02-29")


def test_periods():
    assert dates.report_month("2024-02-02") == (day("2024-01-01"), day("2024-01-31"))
    assert dates.report_month("2024-02-04") == (day("2024-02-01"), day("2024-02-29"))
    assert dates.prev_month("2024-01-15") == (day("2023-12-01"), day("2024-01-01"))
    assert dates.last_fri_week("2024-01-19") == (day("2024-01-12"), day("2024-01-19"))  # a Friday
    assert dates.last_fri_week("2024-01-18") == (day("2024-01-05"), day("2024-01-12"))
    assert dates.restate_prev_month("2024-03-07") == day("2024-02-01")
    assert dates.restate_prev_month("2024-03-08") is None


def test_balance_bands_have_gaps(spark):
    values = [(-1.0,), (0.0,), (499.99,), (500.0,), (4999.0,), (4999.5,), (5000.0,), (None,)]
    df = spark.createDataFrame(values, "b double").select("b", balance_band(F.col("b")).alias("band"))
    got = {r["b"]: r["band"] for r in df.collect()}
    assert got[-1.0] is None and got[0.0] is None and got[4999.0] is None and got[4999.5] is None
    assert got[499.99] == "A-0-$499" and got[500.0] == "B-$500-$999" and got[5000.0] == "E-$5000+"
    assert got[None] is None


def test_charge_off_age_sentinels(spark):
    age = charge_off_age(F.lit(None).cast("date"), F.lit(None).cast("date"))
    years = one(spark, age)
    assert abs(years - (dt.date(2050, 1, 1) - dt.date(2040, 1, 1)).days / 360.0) < 1e-9
    banded = labels.band(charge_off_age(F.lit(None).cast("date"), d("2024-01-01")), AGE_BANDS)
    assert one(spark, banded) == "S -Missing Info"


def test_month_slot(spark):
    slot = lambda x: one(spark, month_slot(d(x), "2024-01-01", 13))
    assert slot("2023-12-31") == 1  # the month of yesterday
    assert slot("2024-12-01") == 13
    assert slot("2025-01-01") == 14


def test_flags_of_null_text_are_set(spark):
    df = spark.createDataFrame([("AF",), ("X",), (None,)], "t string")
    out = df.select(*[c.alias(n) for n, c in labels.decode_flags(F.col("t"), {"A": "a", "F": "f"}).items()])
    assert rows(out) == [(0, 0), (1, 1), (1, 1)]


def test_groups_sort_keys_control(spark):
    df = spark.createDataFrame([("10",), ("3",), ("x",), (None,)], "s string")
    grouped = df.select(labels.group_values(F.col("s"), {"6+": ["10", "6"], "3-5": ["3"]}).alias("g"))
    assert rows(grouped) == [("(Blank)",), ("3-5",), ("6+",), ("x",)]
    ordered = df.select(labels.sort_key(F.col("s"), ["3", "10"]).alias("o"))
    assert rows(ordered) == [(1,), (2,), (None,), (None,)]
    ids = spark.createDataFrame([("1234567950",), ("1234567890",), ("short",)], "i string")
    assert rows(ids.select(labels.control_split(F.col("i"), 8, 2, 89).alias("c"))) == [(False,), (None,), (True,)]


def test_era_predicate(spark):
    df = spark.createDataFrame(
        [(day("2025-07-31"), "X", 1), (day("2025-08-01"), "X", 1), (day("2025-08-01"), "P", 1),
         (day("2025-08-01"), None, 1), (day("2025-08-01"), "X", 3)], "d date, f string, src int")
    kept = labels.where_by_era(df, F.col("d"), day("2025-08-01"), F.col("f").isin("P", "B"), F.col("src") == 3)
    assert kept.count() == 3


def test_where_in_with_frame(spark):
    df = spark.range(6)
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k bigint")
    assert rows(labels.where_in(df, "id", keys)) == [(1,), (3,)]
    assert labels.where_in(df, "id", keys, negate=True).count() == 4


def test_case_insensitive_collation_keys(spark):
    a = spark.createDataFrame([("North Area ",)], "s string")
    b = spark.createDataFrame([("NORTH AREA",)], "t string")
    assert a.join(b, text.same_text(F.col("s")) == text.same_text(F.col("t"))).count() == 1
