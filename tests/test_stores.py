"""Sinks, sources, models and streams."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from dunlin.plans import payments, scoring
from dunlin.sources import checkpoints, scans, sinks
from dunlin.streaming import streams
from tests.conftest import day, rows, ts

STATE = "id bigint, v double, s string, p string"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_upsert_null_changes(spark):
    old = spark.createDataFrame([(1, 1.0, None, "a"), (2, 2.0, "x", "a"), (3, None, "x", "a")], STATE)
    new = spark.createDataFrame([(1, 1.0, "now", "a"), (2, 5.0, "x", "a"), (4, 4.0, "n", "b")], STATE)
    plain = sinks.upsert(old, new, ["id"], ["v", "s"], change_as="c")
    assert rows(plain, "id", "v", "s", "c") == [
        (1, 1.0, None, "same"), (2, 5.0, "x", "update"), (3, None, "x", "same"), (4, 4.0, "n", "insert")]
    safe = sinks.upsert(old, new, ["id"], ["v", "s"], null_safe=True, change_as="c")
    assert rows(safe.where("id = 1"), "s", "c") == [("now", "update")]


def test_write_upsert_touches_changed_partitions_only(spark, path):
    old = spark.createDataFrame([(1, 1.0, "x", "a"), (2, 2.0, "x", "b"), (3, 3.0, "x", "c")], STATE)
    sinks.write_full(old, path, ["p"])
    import glob
    import os

    stamp = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/p=c/*.parquet")}
    new = spark.createDataFrame([(1, 9.0, "x", "a"), (4, 4.0, "x", "d")], STATE)
    for _ in range(2):
        sinks.write_upsert(path, new, ["id"], "p")
        assert rows(sinks.read_table(spark, path), "id", "v", "p") == [
            (1, 9.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (4, 4.0, "d")]
    assert stamp == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/p=c/*.parquet")}


def test_write_upsert_moves_the_last_row_of_a_partition(spark, path):
    sinks.write_full(spark.createDataFrame([(1, 1.0, "x", "a"), (2, 2.0, "x", "b")], STATE), path, ["p"])
    sinks.write_upsert(path, spark.createDataFrame([(1, 1.5, "x", "b")], STATE), ["id"], "p")
    assert rows(sinks.read_table(spark, path), "id", "v", "p") == [(1, 1.5, "b"), (2, 2.0, "b")]


def test_write_window_replaces_and_repeats(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.write_full(df, path, ["p"])
    for _ in range(2):
        sinks.write_window(spark.createDataFrame([(7, "b"), (8, "c")], "v int, p string"), path, "p")
    assert rows(sinks.read_table(spark, path), "v", "p") == [(1, "a"), (7, "b"), (8, "c")]


def test_append_new_is_idempotent(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.append_new(df.where("id = 1"), path, ["id"]).count() == 1
    assert sinks.append_new(df, path, ["id"]).count() == 1
    assert sinks.append_new(df, path, ["id"]).count() == 0
    assert rows(sinks.read_table(spark, path)) == [(1, "a"), (2, "b")]


def test_snapshot_gate(spark, path):
    df = spark.createDataFrame([(1,)], "v int")
    assert sinks.snapshot_if_due(df, path, "2024-01-31")
    assert not sinks.snapshot_if_due(df, path, "2024-01-31")
    assert sinks.snapshot_if_due(df, path, "2024-02-01")
    assert not sinks.snapshot_if_due(df, path, "2024-01-15")
    assert rows(sinks.read_table(spark, path), "snapshot_month") == [(day("2024-01-01"),), (day("2024-02-01"),)]


def test_watermark_and_freshness(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00"),), (ts("2024-01-02 10:00"),)], "t timestamp_ntz")
    target = df.limit(0)
    assert sinks.since_watermark(df, None, "t", "2024-01-02").count() == 1
    assert sinks.since_watermark(df, target, "t", "2023-01-01").count() == 2
    assert sinks.since_watermark(df, df, "t", "2023-01-01").count() == 1
    assert sinks.since_watermark(df, df, "t", "2023-01-01", strict=True).count() == 0
    assert sinks.freshness_days(df, "t", "2024-01-03").first()[0] == 1


def test_retention_keeps_undated_rows_and_inactive_tables(spark):
    df = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-20"),), (None,)], "d date")
    config = spark.createDataFrame([("a", 10, True, 2), ("b", 1, False, 1)], "table_name string, days int, is_active boolean, sort int")
    kept, log = sinks.apply_retention({"a": (df, "d"), "b": (df, "d")}, config, "2024-01-25")
    assert set(kept) == {"a"} and kept["a"].count() == 2
    assert rows(log) == [("a", 3, 2)]


def test_presence_checks_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b int")
    assert rows(sinks.presence_checks(df, ["a", "b"])) == [("a", 0), ("b", 0)]


def test_flat_file_quotes_and_types(spark, tmp_path):
    (tmp_path / "f.csv").write_text('"id","name","amt"\n"9007199254740993","a ""q"", b","1.5"\n"x"," ","n/a"\n"x"," ","n/a"\n')
    raw = scans.read_flat_file(spark, str(tmp_path / "f.csv"), ["id", "name", "amt"])
    typed = scans.typed_load(raw, {"id": "bigint", "name": "string", "amt": "decimal(18,2)"}, "2024-01-01")
    assert [(r["id"], r["name"]) for r in typed.orderBy("id").collect()] == [(None, None), (9007199254740993, 'a "q", b')]


def test_schedule_file_loads_once_a_day(spark, tmp_path, path):
    (tmp_path / "s.csv").write_text('"ref","due"\n"1","01/31/2024"\n"1","01/31/2024"\n')
    load = lambda d: payments.load_schedule_file(
        spark, str(tmp_path / "s.csv"), ["ref", "due"], {"ref": "bigint", "due": "date:MM/dd/yyyy"}, path, d)
    assert rows(load("2024-01-05"), "ref", "due") == [(1, day("2024-01-31"))]
    assert load("2024-01-05") is None
    assert load("2024-01-06").count() == 1


def test_json_pages_with_an_empty_page(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"id": 1, "tags": ["a"]},\n {"id": 9007199254740993}]')
    (tmp_path / "2.json").write_text("[]")
    out = scans.read_json_pages(spark, str(tmp_path), "id bigint, tags array<string>")
    assert sorted(r["id"] for r in out.collect()) == [1, 9007199254740993]
    assert out.where("raw like '%tags%'").count() == 1


def test_remote_scan_needs_a_database(spark):
    with pytest.raises(Exception, match="(?i)driver|suitable"):
        scans.read_remote(spark, "jdbc:none://x", "select 1", split=("id", 0, 10, 2))


def test_range_scan_is_pushed_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = scans.range_scan(df, "o_orderdate", "1997-01-01", "1997-02-01")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_csv_export_has_a_date_and_header(spark, tmp_path):
    out = sinks.export_csv(spark.range(3), str(tmp_path), "ids", "2024-01-31", ["id"], files=1)
    assert out.endswith("ids_20240131")
    assert spark.read.csv(out, header=True).columns == ["id"]


def test_audit_counts(spark):
    out = sinks.audit_counts({"t": {"processed": spark.range(5), "final": spark.range(3)}})
    assert rows(out) == [("t", "final", 3), ("t", "processed", 5)]


def test_shared_dir_follows_the_session(spark):
    assert checkpoints.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_target_encode_counts_logs_of_one_as_zero(spark):
    df = spark.createDataFrame([("a", 1)] * 1 + [("b", 1)] * 2 + [("b", 0)] * 2 + [("c", 0)] * 3, "c string, paid int")
    out = scoring.target_encode(df, "c", F.col("paid") == 1, "lvl", n=3)
    got = {r["c"]: (round(r["conversion"], 4), r["lvl"]) for r in out.collect()}
    assert got == {"b": (0.5, 1), "a": (0.0, 2), "c": (0.0, 3)}


def test_train_store_score(spark, tmp_path):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 3).alias("z")).withColumn("y", F.col("x") * 2.0)
    model = scoring.train_score_model(df.drop("id"), "y", ["x", "z"], rounds=8, depth=3)
    saved = scoring.save_model(model, str(tmp_path), "m")
    out = scoring.score_model(df, saved, ["x", "z"], "id").join(df, "id")
    assert out.where(F.abs(F.col("score") - F.col("y")) > 1.0).count() == 0


def test_training_rounds_read_groups(spark, monkeypatch):
    """The trees see one weighted row for each combination of bins and label; they are those of
    the rows themselves."""
    df = spark.range(0, 3000, 1, 3).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double").alias("x"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))).alias("z"), F.lit(3).alias("same"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)).cast("double")).alias("w"))
    df = df.withColumn("y", (F.sin(F.col("x") / 900) + F.coalesce("z", F.lit(0)) * F.col("w") / 90 > 1).cast("double"))
    seen, fit, f = [], GBTRegressor.fit, ["x", "z", "same", "w"]
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: (seen.append(data), fit(self, data))[1])
    scores = scoring.score_model(df, scoring.train_score_model(df, "y", f, rounds=3, depth=4), f, "id")
    few = ["z", "same"]
    scoring.train_score_model(df, "y", few, rounds=1, depth=2)
    assert seen[1].count() <= 5 * 2 and seen[1].agg(F.sum("__rows")).first()[0] == 3000

    filled = [f"{c}_f" for c in f]
    plain = Pipeline(stages=[
        Imputer(inputCols=f, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features"),
        GBTRegressor(labelCol="y", maxIter=3, maxDepth=4, stepSize=0.3, seed=42, lossType="squared", predictionCol="plain"),
    ])
    typed = df.select("id", "y", *[F.col(c).cast("double").alias(c) for c in f])
    both = plain.fit(typed).transform(typed).select("id", "plain").join(scores, "id")
    assert both.where(F.abs(F.col("score") - F.col("plain")) > 1e-9).isEmpty() and both.count() == 3000


def test_many_training_rows_keep_their_weight(spark, monkeypatch):
    """Above BINNED_ROWS rows bound the bins, but all rows train."""
    monkeypatch.setattr(scoring, "BINNED_ROWS", 500)
    df = spark.range(4000).select((F.col("id") % 1000).alias("x"), (F.col("id") % 1000 >= 500).cast("int").alias("y"))
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: (seen.append(data), fit(self, data))[1])
    scoring.train_score_model(df, "y", ["x"], rounds=1, depth=2)
    assert seen[0].count() <= 2 * scoring.BINS and seen[0].agg(F.sum("__rows")).first()[0] == 4000


# ---- streams ----------------------------------------------------------------------------------


def feed(spark, tmp_path, batches):
    folder = str(tmp_path / "in")
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, "id bigint, customer bigint, at timestamp").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id bigint, customer bigint, at timestamp").option("maxFilesPerTrigger", 1).parquet(folder)


def drain(spark, tmp_path, stream, schema=None):
    streams.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def test_stream_dedupes_across_batches(spark, tmp_path):
    rows_ = [(1, 1, utc("2024-01-01 10:00")), (2, 1, utc("2024-01-01 11:00"))]
    out = drain(spark, tmp_path, streams.dedupe_sessions(feed(spark, tmp_path, [rows_, rows_]), "id", "at"))
    assert rows(out, "id") == [(1,), (2,)]


def test_stream_hours_close_with_the_watermark(spark, tmp_path):
    batch = [(1, 1, utc("2024-01-01 10:00")), (2, 1, utc("2024-01-01 10:59")), (3, 1, utc("2024-01-01 12:30"))]
    out = drain(spark, tmp_path, streams.hourly_counts(feed(spark, tmp_path, [batch]), "at"))
    assert rows(out, "hour_no", "n_events") == [(10, 2)]


def test_stream_contact_cap_equals_batch_over_micro_batches(spark, tmp_path):
    from dunlin.plans.compliance import contact_frequency_exceptions

    data = [(i, 1 + i % 2, utc(f"2024-01-{1 + i:02d} 10:00")) for i in range(20)]
    stream = streams.contact_cap_alerts(feed(spark, tmp_path, [data[:7], data[7:8], data[8:]]), "customer", "at", "id", k=3, days=7)
    got = rows(drain(spark, tmp_path, stream), "id")
    batch = spark.createDataFrame(data, "id bigint, customer bigint, at timestamp")
    assert got == rows(contact_frequency_exceptions(batch, "customer", "at", "id", k=3, days=7), "id") and got


def test_stream_contact_cap_of_late_rows(spark, tmp_path):
    from dunlin.plans.compliance import contact_frequency_exceptions

    def at(i, hour):
        return i, 1, utc(f"2024-01-01 {hour}")

    # 9:50 comes late: no alert of its own, but now 10:20 has three contacts before it
    batches = [[at(1, "10:00"), at(2, "10:10"), at(3, "10:20")], [at(4, "09:50")], [at(5, "10:05"), at(6, "10:30")]]
    stream = streams.contact_cap_alerts(feed(spark, tmp_path, batches), "customer", "at", "id", k=3, days=2, delay="2 hours")
    got = rows(drain(spark, tmp_path, stream), "id")
    batch = spark.createDataFrame(sum(batches, []), "id bigint, customer bigint, at timestamp")
    assert got == rows(contact_frequency_exceptions(batch, "customer", "at", "id", k=3, days=2), "id") == [(2,), (3,), (6,)]


def test_the_queries_train_the_full_model(spark):
    """With few distinct feature rows, 200 rounds of depth 6 converge to the mean label of each."""
    import random

    from dunlin.catalog import models

    rng = random.Random(13)
    rows, cells = [], {}
    for cell in [(lang, source, n) for lang in "abc" for source in "xy" for n in (10, 20, 30)]:
        labels = [rng.randint(0, 1) for _ in range(rng.randint(3, 9))]
        cells[cell] = sum(labels) / len(labels)
        rows += [(*cell, q) for q in labels]
    known = spark.createDataFrame(rows, "lang string, source string, n_chars int, quality int")
    lookups = {c: spark.createDataFrame([(v, k + 1) for k, v in enumerate(values)], f"{c} string, {c}_level int")
               for c, values in (("lang", "abc"), ("source", "xy"))}
    model = models._model(known, lookups)
    trees = model.stages[-1]
    assert (trees.getNumTrees, trees.getOrDefault("maxDepth")) == (200, 6)
    typed = known.drop("quality").distinct().withColumn("n", F.col("n_chars")).join(lookups["lang"], "lang").join(lookups["source"], "source")
    got = scoring.score_model(typed, model, models.FEATURES, ["lang", "source", "n"]).collect()
    assert len(got) == len(cells)
    assert all(abs(r.score - cells[r.lang, r.source, r.n]) < 1e-4 for r in got)
