"""Report rules on small hand-written frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dunlin.sources.sinks import export_csv
from dunlin.plans import compliance, messages, payments, scorecard, speech
from tests.conftest import day, rows, ts


def contacts(spark, days, customer=1, start=1):
    data = [(customer, start + i, ts(f"{d} 10:00")) for i, d in enumerate(days)]
    return spark.createDataFrame(data, "customer int, session int, start_time timestamp_ntz")


@pytest.mark.parametrize("last,hits", [("2024-01-30", 1), ("2024-01-31", 0)])
def test_four_contacts_in_29_or_30_days(spark, last, hits):
    df = contacts(spark, ["2024-01-01", "2024-01-10", "2024-01-20", last])
    assert compliance.contact_frequency_exceptions(df).count() == hits


def test_contact_cap_ignores_null_customers_and_old_rows(spark):
    df = contacts(spark, ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"], customer=None)
    assert compliance.contact_frequency_exceptions(df).count() == 0
    df = contacts(spark, ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"])
    assert compliance.contact_frequency_exceptions(df, as_of="2024-03-02", scan_days=60).count() == 0


def test_contact_cap_on_one_huge_customer(hot):
    days = [f"2024-01-{1 + i // 4:02d}" for i in range(80)]
    df = contacts(hot, days).unionByName(contacts(hot, ["2024-01-01"] * 3, customer=2, start=900))
    split = rows(compliance.contact_frequency_exceptions(df, days=2), "session", "session_1", "session_3")
    hot.conf.unset("dunlin.hotKeyRows")
    assert split == rows(compliance.contact_frequency_exceptions(df, days=2), "session", "session_1", "session_3")
    assert len(split) == 77


def test_threshold_interval_spans_phones_and_attempts_do_not(spark):
    data = [(1, "a", ts("2024-01-01 10:00"), "sms 1", 1), (1, "a", ts("2024-01-05 10:00"), "sms 1", 2),
            (1, "b", ts("2024-01-06 10:00"), "sms 1", 3), (1, "b", ts("2024-01-20 10:00"), "other", 4)]
    df = spark.createDataFrame(data, "customer int, phone string, sent_at timestamp_ntz, service_name string, id int")
    rules = spark.createDataFrame([("sms%", 2, 3, True), ("other", 1, 1, False)],
                                  "pattern string, attempt_limit int, interval_days int, is_active boolean")
    out = compliance.message_threshold_exceptions(df, rules, tie=["id"])
    assert rows(out, "id", "attempt", "gap_days", "interval_exception", "attempt_exception", "limit_reached") == [
        (2, 2, 4, 1, 0, 1)]
    below = compliance.message_threshold_exceptions(df, rules, tie=["id"], direction="<")
    assert rows(below, "id", "gap_days", "interval_exception") == [(2, 4, 0), (3, 1, 1)]


def test_restriction_date_from_history_else_account(spark):
    accounts = spark.createDataFrame([(1, "R", ts("2024-01-10 00:00")), (2, "R", ts("2024-01-10 00:00")),
                                      (3, "ok", ts("2024-01-01 00:00"))], "customer int, status string, updated timestamp_ntz")
    history = spark.createDataFrame([(1, "R", ts("2024-01-05 08:00")), (1, "R", ts("2024-01-08 08:00")),
                                     (2, "old", ts("2024-01-01 08:00"))], "customer int, status string, inserted timestamp_ntz")
    calls = spark.createDataFrame([(c, ts(f"2024-01-{d:02d} 09:00")) for c in (1, 2, 3) for d in (5, 6, 6, 11)],
                                  "customer int, contact_ts timestamp_ntz")
    codes = spark.createDataFrame([("R",)], "s string")
    out = compliance.restricted_contact_exceptions(accounts, history, calls, codes, "2024-01-01")
    assert rows(out, "customer", "restricted_on", "contact_key", "n_exceptions") == [
        (1, day("2024-01-05"), 20240106, 2), (1, day("2024-01-05"), 20240111, 1), (2, day("2024-01-10"), 20240111, 1)]
    later = compliance.restricted_contact_exceptions(accounts, history, calls, codes, "2024-01-06")
    assert later.count() == 2


def test_letter_sequence_uses_the_next_letter_only(spark):
    data = [(1, 1, ts("2024-01-01 00:00"), "IDN1"), (1, 2, ts("2024-01-02 00:00"), "XX"), (1, 3, ts("2024-01-03 00:00"), "EM1"),
            (2, 4, ts("2024-01-01 00:00"), "IDN1"), (2, 5, ts("2024-02-20 00:00"), "EM1"),
            (3, 6, ts("2024-01-01 00:00"), "IDN1"), (3, 7, ts("2024-02-21 00:00"), "EM1")]
    df = spark.createDataFrame(data, "customer int, letter_key int, requested timestamp_ntz, letter_type string")
    out = compliance.letter_sequence_exceptions(df, "IDN%", "EM%")
    assert rows(out, "letter_key", "days_since_initial") == [(4, 50)]


def message(guid, at, code, account=1, detail=None, n=1, value=None, vendor=None):
    return (guid, ts(at), code, value, detail, vendor, n, account, "C", 2, "L", f"u{account}@d.example", "s")


MESSAGE = ("guid string, ts timestamp_ntz, code int, value string, detail string, vendor string, n_events int, "
           "account int, client string, crm int, letter string, email string, send_domain string")
PAY = "payment_id int, account int, crm int, pay_date date, amount double"


def attribute(spark, events, pays, revs=(), **kw):
    return messages.message_attribution(
        spark.createDataFrame(events, MESSAGE), spark.createDataFrame(pays, PAY),
        spark.createDataFrame(list(revs), "account int, crm int, pay_date date, amount double"), "2024-02-28", **kw)


def test_attribution_window_last_touch_and_ties(spark):
    events = [message("a", "2024-01-01 08:00", 10), message("b", "2024-01-02 08:00", 10),
              message("a", "2024-01-05 09:00", 5), message("b", "2024-01-05 10:00", 5),
              message("a", "2024-01-01 09:00", 5), message("c", "2024-01-20 09:00", 5)]
    pays = [(1, 1, 2, day("2024-01-05"), 10.0),   # two opens on the day: the later one
            (2, 1, 2, day("2024-01-20"), 20.0),   # 15 days after the last counted open
            (3, 1, 2, day("2024-01-21"), 40.0),   # 16 days after
            (4, 1, 2, day("2024-01-04"), 80.0),   # only the first open is before
            (5, 1, 2, day("2024-01-06"), -5.0)]   # not a payment
    out = attribute(spark, events, pays)
    assert rows(out, "guid", "payers", "payments", "total_opens") == [("a", 1, 80.0, 2), ("b", 1, 30.0, 1)]


def test_attribution_reversal_is_subtracted_whatever_its_sign(spark):
    events = [message("a", "2024-01-01 08:00", 10), message("a", "2024-01-01 09:00", 5)]
    pays = [(1, 1, 2, day("2024-01-02"), 10.0), (2, 1, 2, day("2024-01-03"), 7.0), (3, 1, 2, day("2024-01-04"), 3.0)]
    revs = [(1, 2, day("2024-01-12"), 10.0), (1, 2, day("2024-01-12"), -7.0), (1, 2, day("2024-01-01"), -3.0)]
    assert rows(attribute(spark, events, pays, revs), "payments") == [(3.0,)]


def test_attribution_of_a_second_source_netted_by_reference(spark):
    events = [message("a", "2024-01-01 08:00", 10), message("a", "2024-01-01 09:00", 5),
              message("b", "2024-01-20 08:00", 10), message("b", "2024-01-20 09:00", 5)]
    by_ref = spark.createDataFrame([
        (1, 1, 2, day("2024-01-02"), 100.0, "r1"), (2, 1, 2, day("2024-01-03"), 50.0, "r2"),
        (3, 1, 2, day("2024-01-21"), 9.0, "r3"), (4, 1, 2, day("2024-01-22"), 8.0, None),
        (5, 1, 2, day("2024-02-20"), 70.0, "r5"), (6, 1, 2, day("2024-01-21"), -3.0, "r6")], PAY + ", reference string")
    back = spark.createDataFrame([
        (11, 1, 2, -30.0, "r1"),  # another amount than the payment
        (2, 1, 2, -50.0, "r2"),   # the payment's own id
        (12, 7, 2, -9.0, "r3"),   # another account
        (13, 1, 2, -8.0, None)], "payment_id int, account int, crm int, amount double, reference string")
    out = attribute(spark, events, [(1, 1, 2, day("2024-01-04"), 10.0)], [(1, 2, day("2024-01-12"), 4.0)], referenced=(by_ref, back))
    assert rows(out, "guid", "payers", "payments") == [("a", 1, 130.0), ("b", 1, 17.0)]
    alone = attribute(spark, events, [], referenced=(by_ref, back))
    assert rows(alone, "guid", "payments") == [("a", 120.0), ("b", 17.0)]


def test_attribution_clicks_scrubs_and_replay(spark):
    events = [message("a", "2024-01-20 08:00", 10), message("a", "2024-01-20 09:00", 12, n=3), message("a", "2024-01-21 09:00", 6),
              message("b", "2024-01-20 08:00", 8, detail="Hard Bounce"), message("b", "2024-01-20 09:00", 12, n=2),
              message("c", "2024-01-20 08:00", 13, detail="Bad-Record"), message("d", "2024-01-20 08:00", 13, detail="Opt-Out"),
              message("e", "2024-01-20 08:00", 8, value="BOUNCE", vendor="V"), message("old", "2023-11-01 08:00", 10)]
    codes = messages.Codes(bounce_vendor="V")
    out = attribute(spark, events, [(1, 1, 2, day("2024-01-21"), 5.0)], codes=codes)
    got = {r["guid"]: r for r in out.collect()}
    assert set(got) == {"a", "b", "c", "d", "e"}
    assert got["a"]["clicks"] == 0 and got["a"]["optouts"] == 1 and got["b"]["clicks"] == 2
    assert (got["b"]["sent"], got["b"]["bounced"], got["e"]["bounced"]) == (1, 1, 1)
    assert (got["c"]["requested"], got["c"]["sent"], got["c"]["invalid_scrubbed"]) == (1, 0, 1)
    assert got["d"]["optout_scrubbed"] == 1 and got["a"]["payers"] == 0 and got["a"]["payments"] == 0.0
    assert got["a"]["email_domain"] == "d.example" and got["a"]["first_send_date"] == day("2024-01-20")
    stored = spark.createDataFrame([(2, "C", 1, day("2023-05-01")), (2, "D", 1, day("2022-05-01"))],
                                   "crm int, client string, account int, send_date date")
    again = attribute(spark, events, [], stored=stored, codes=codes)
    assert {r["first_send_date"] for r in again.collect()} == {day("2023-05-01")}


def test_clicks_drop_messages_after_stop_and_backfill(spark):
    cols = "session int, day date, ts timestamp_ntz, account int, full_name string, result string, platform string, service_name string"
    row = lambda i, at, acc, result, plat: (i, day(at[:10]), ts(at), acc, "n", result, plat, "S")
    full = [row(1, "2023-12-01 10:00", 2, "Delivered", "B"), row(2, "2024-01-01 10:00", 1, "Stop", None),
            row(3, "2024-01-01 11:00", 1, "Delivered", None), row(4, "2024-01-01 12:00", 1, "Delivered", "A"),
            row(5, "2024-01-01 10:00", 2, "Delivered", None), row(6, "2024-01-01 10:00", 3, "Delivered", None)]
    history = spark.createDataFrame(full, cols)
    clicks = spark.createDataFrame([(day("2024-01-01"), 1, "C1", "x"), (day("2024-01-01"), 1, "C1", "y"),
                                    (day("2024-01-01"), 1, "C9", "z")], "day date, account int, client string, letter string")
    people = spark.createDataFrame([(1, "ALPHA", "C1"), (2, "BETA", "C2")], "account int, source_system string, client string")
    out = messages.message_click_detail(
        history.where("day >= '2024-01-01'"), history, clicks, people, ["Stop"], ["Delivered"], ["Stop", "Delivered"],
        ["Delivered"], {"ALPHA": F.col("platform") == "A", "BETA": F.col("platform") != "A"})
    assert rows(out, "session", "platform", "client", "total_clicks", "unique_clicks", "is_stop") == [
        (2, "A", "C1", 4, 2, 1), (4, "A", "C1", 4, 2, 0), (5, "B", "C2", 0, 0, 0), (6, None, None, 0, 0, 0)]


def test_spine_availability_rules(spark):
    accounts = spark.createDataFrame(
        [("e", day("2023-12-01"), None), ("e", day("2024-01-05"), day("2024-01-03")), ("e", day("2024-01-05"), day("2024-01-03")),
         ("e", day("2023-01-01"), day("2023-12-31")), ("f", day("2024-02-01"), None), ("g", day("2024-01-01"), None)],
        "entity string, list_date date, cancel_date date")
    mails = spark.createDataFrame([("e", day("2024-01-02"), 4)], "entity string, day date, emails int")
    calls = spark.createDataFrame([("e", day("2024-01-02"), 9)], "entity string, day date, calls int")
    out = scorecard.daily_kpi_spine(accounts, accounts, [mails, calls], ["emails"], "2024-02-02")
    assert out.count() == 3 * 31
    e = {r["day"].day: r for r in out.where("entity = 'e'").collect()}
    assert e[1]["all_accounts"] == 3 and e[1]["available_accounts"] == 3       # no previous day
    assert e[2]["cum_cancels"] is None and e[3]["available_accounts"] is None  # unknown before the first cancel
    assert e[3]["cum_cancels"] == 2 and e[4]["available_accounts"] == 1 and e[31]["cum_cancels"] == 2
    assert (e[2]["emails"], e[3]["emails"], e[2]["calls"], e[3]["calls"]) == (4, 0, 9, None)
    assert {r["all_accounts"] for r in out.where("entity = 'f'").collect()} == {None}


def test_spine_reports_all_when_none_available(spark):
    accounts = spark.createDataFrame([("e", day("2023-12-01"), day("2024-01-03"))], "entity string, list_date date, cancel_date date")
    out = scorecard.daily_kpi_spine(accounts, accounts, [], [], "2024-02-02")
    got = {r["day"].day: r["available_accounts"] for r in out.collect()}
    assert got[3] is None and got[4] == 1 and got[5] == 1  # 1 - 1 = 0 reads as all


def test_horizon_counts_and_overflow(spark):
    cols = "source string, payment_id int, account int, client string, due_date date, amount double, broken_date date"
    s = spark.createDataFrame([("A", 1, 1, "c", day("2024-01-10"), 5.0, None), ("A", 2, 1, "c", day("2024-01-20"), 5.0, None),
                               ("A", 3, 1, "c", day("2025-03-01"), 7.0, None), ("A", 4, 1, "c", day("2024-02-01"), 9.0, day("2024-01-02")),
                               ("A", 5, 1, "c", day("2024-01-01"), 9.0, None)], cols)
    paid = spark.createDataFrame([("A", 1, day("2016-01-01"), "PAY"), ("A", 1, day("2015-12-31"), "PAY"), ("A", 1, day("2020-01-01"), "NSF")],
                                 "source string, account int, pay_date date, kind string")
    people = spark.createDataFrame([(1, "A")], "account int, source string")
    out = payments.payment_horizon_matrix([s], paid, people, "2024-01-05", 13, excluded_types=["NSF"])
    r = out.first()
    assert (r["month_1"], r["month_2"], r["over_range"], r["remaining"], r["n_paid"], r["taken"]) == (10.0, 0.0, 7.0, 3, 1, 4)


def test_open_as_of_months(spark):
    s = spark.createDataFrame([(1, day("2024-03-15"), None), (2, day("2024-03-15"), day("2024-02-10")), (3, day("2023-12-31"), None),
                               (4, day("2025-01-01"), day("2023-01-01"))], "id int, due_date date, broken_date date")
    out = payments.open_as_of_months(s, "2024-04-20", 4)
    assert rows(out.groupBy("id").agg(F.min("snapshot_month"), F.max("snapshot_month"))) == [
        (1, day("2023-12-01"), day("2024-03-01")), (2, day("2023-12-01"), day("2024-02-01")), (3, day("2023-12-01"), day("2023-12-01"))]


def test_branch_duplicates_collapse(spark):
    cols = "source string, account int, client string, due_date date, amount double, broken_date date"
    s = spark.createDataFrame([("A", 1, "c", day("2024-02-10"), 5.0, None)] * 2, cols)
    people = spark.createDataFrame([(1, "A", day("2024-01-01"))], "account int, source string, list_date date")
    clients = spark.createDataFrame([("c", "p")], "client string, parent string")
    assert payments.postdated_detail([s, s], people, clients, "2024-01-05").count() == 1


def test_inventory_survives_months_without_calls(spark):
    clients = spark.createDataFrame([("c",)], "client string")
    empty = lambda cols: spark.createDataFrame([], cols)
    inv = spark.createDataFrame([("c", day("2024-01-01"), 8)], "client string, rpt_month date, accounts int")
    out = scorecard.kpi_scorecard(
        clients, empty("client string, list_date date, initial_balance double"),
        empty("client string, call_date date, direction string, call_type string, n_calls int, n_contacts int, n_connects int, n_promises int"),
        empty("client string, account int, pay_date date, amount double, fee double, is_first int"), inv,
        empty("client string, send_date date, sent int"), [empty("client string, mail_date date")], "2024-02-10", months=1)
    assert rows(out, "month", "inventory_accounts", "calls") == [(day("2024-01-01"), 8, None), (day("2024-02-01"), None, None)]


def test_payment_share_adds_up(spark):
    calls = spark.createDataFrame([(1, 7, day("2024-01-01")), (2, 7, day("2024-01-01")), (3, 8, day("2024-01-01"))],
                                  "session int, account int, day date")
    pays = spark.createDataFrame([(7, day("2024-01-01"), 6.0), (7, day("2024-01-01"), 4.0)], "account int, day date, amount double")
    out = payments.payment_to_interaction(calls, pays)
    assert rows(out, "session", "pay_received", "pay_share") == [(1, 10.0, 5.0), (2, 10.0, 5.0), (3, 0.0, 0.0)]


HITS = "call_id int, category string, phrase string, start_ms bigint"
EFFORT = speech.EffortRules("RPC", "MM", ("Ask", "Delay"), "Effort", "Open", "Close", promise_results=("PTP",))


def test_effort_needs_to_follow_the_signal(spark):
    calls = spark.createDataFrame([(1, "PTP"), (2, "x"), (3, "x"), (4, "x")], "call_id int, result string")
    hits = spark.createDataFrame(
        [(1, "RPC", "p", 0), (1, "Ask", "p", 1499), (1, "Delay", "q", 5000), (1, "Effort", "e", 122000), (1, "Open", "o", 1000),
         (1, "Close", "c", 122999), (1, "Open", "o", 130000),
         (2, "RPC", "p", 0), (2, "Effort", "e", 1000), (2, "Ask", "p", 2000),
         (3, "RPC", "p", 0), (3, "MM", "m", 0), (3, "Ask", "p", 1000), (3, "Effort", "e", 2000),
         (4, "Ask", "p", 1000), (4, "Effort", "e", 2000)], HITS)
    words = spark.createDataFrame([(1, "Agent", 1000), (1, "Agent", 999), (1, "Customer", 122000), (1, "Customer", 123000),
                                   (2, "Agent", 9000)], "call_id int, speaker string, start_ms bigint")
    r = speech.conversation_effort(calls, hits, words, EFFORT).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["signal"], r["signal_s"], r["effort_s"], r["gap_s"], r["gap_band"]) == ("Ask", 1, 122, 121, "B.121-240 Seconds")
    assert (r["agent_words"], r["customer_words"], r["open_questions"], r["closed_questions"]) == (1, 1, 1, 1)
    assert (r["n_ask"], r["n_delay"], r["promised"]) == (1, 1, 1)
    profile = speech.conversation_effort(calls, hits, words, EFFORT, form="profile")
    assert rows(profile, "call_id", "agent_words", "customer_words", "open_questions") == [(1, 1, 2, 2), (2, 1, 0, 0)]


def test_speech_reports_scan_the_hits_once(spark, tmp_path):
    import random

    pick = random.Random(3)
    cats = ["RPC", "Ask", "Delay", "Effort", "Open", "Close", "Second", "bad", None]
    data = [(pick.randint(1, 9), pick.choice(["Agent", "Customer"]), pick.choice(cats), pick.choice("Hmx"), pick.randint(0, 300_000))
            for _ in range(900)]
    path = str(tmp_path / "transcript")
    spark.createDataFrame(data, "call_id int, speaker string, category string, phrase string, start_ms bigint").write.parquet(path)
    script = spark.read.parquet(path)
    hits, words = script.where("category is not null").drop("speaker"), script.select("call_id", "speaker", "start_ms")
    cols = "call_id int, session string, duration_s int, silence_s int, direction string, is_contact int, is_connect int, result string, result_class string"
    calls = spark.createDataFrame([(i, f"s{i}", 300, 5, "INBOUND", 1, 1, "PTP", "PTP") for i in range(1, 11)], cols)
    groups = spark.createDataFrame([("Ask", "H", "G1"), ("Delay", "m", "G2")], "category string, phrase string, grp string")
    both = speech.conversation_effort(calls, hits, words, EFFORT)
    one = speech.conversation_effort(calls, script, None, EFFORT)
    assert rows(one) == rows(both) and one.count()
    voice = speech.second_voice_shift(
        calls, hits, groups, speech.VoiceRules("Second", ("Open",), ("Ask", "Delay"), "Close"))
    rules = speech.ScriptRules("RPC", "Open", "Close", "Open", "Second", ("Ask", "Delay"), "Effort", "Effort", "Open", "Close", "RPC", "bad")
    adherence = speech.script_adherence(calls.drop("call_id"), calls.select("session", "call_id"), hits, groups, rules)
    for report in (one, voice, adherence):
        assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    # the folded parts against plain Python
    for r in one.collect():
        mine = [(ms, cat, text, who) for c, who, cat, text, ms in data if c == r["call_id"]]
        signal = min(h[:3] for h in mine if h[1] in ("Ask", "Delay"))
        effort = max(h[:3] for h in mine if h[1] == "Effort")
        inside = [h for h in mine if signal[0] // 1000 <= h[0] // 1000 <= effort[0] // 1000]
        assert (r["agent_words"], r["customer_words"], r["open_questions"], r["closed_questions"], r["n_ask"]) == (
            sum(h[3] == "Agent" for h in inside), sum(h[3] == "Customer" for h in inside),
            sum(h[1] == "Open" for h in inside), sum(h[1] == "Close" for h in inside), sum(h[1] == "Ask" for h in mine))
    for r in voice.collect():
        mine = [(ms, cat, text) for c, _, cat, text, ms in data if c == r["call_id"]]
        at = max((h[0] // 1000 for h in mine if h[1] == "Second"), default=None)
        signals = sorted(h for h in mine if h[1] in ("Ask", "Delay"))
        before = next((h[2] for h in signals if h[0] // 1000 < at), "No Language")
        after = next((h[2] for h in signals if h[0] // 1000 >= at), "No Language")
        assert (r["agent_phrase"], r["supervisor_phrase"]) == (before, after)


def test_success_without_offer_implies_one(spark):
    calls = spark.createDataFrame([(1, 1, "c"), (2, 2, "c"), (3, 3, "x")], "call_id int, account int, client string")
    people = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, 5.0)], "account int, status double")
    hits = spark.createDataFrame([(1, "SUC", "p", 5400), (2, "SOL", "p", 1000), (3, "SOL", "p", 1000), (3, "SUC", "p", 1900)], HITS)
    programs = [speech.Program("P", "SOL", "SUC", F.col("status") > 0, ("status",)),
                speech.Program("Q", "SOL", "SUC", F.lit(True), success_after_offer=True)]
    out = speech.offer_success(calls, hits, people, programs)
    assert rows(out, "program", "call_id", "offer_s", "succeeded", "success_s", "detail_1") == [
        ("P", "1", "5", "1", "5", "5.0"), ("P", "3", "1", "1", "1", "5.0")]


def test_voice_shift_sides(spark):
    calls = spark.createDataFrame([(i, 300, 20, "PTP") for i in (1, 2, 3)], "call_id int, duration_s int, silence_s int, result_class string")
    rules = speech.VoiceRules("Second", ("Open",), ("Sig",), "Script")
    hits = spark.createDataFrame(
        [(1, "Open", "o", 100000), (1, "Sig", "before", 50000), (1, "Second", "s", 60000), (1, "Second", "s", 80000),
         (1, "Sig", "after", 90000), (2, "Open", "o", 10000), (2, "Sig", "x", 50000), (3, "Open", "o", 181000)], HITS)
    groups = spark.createDataFrame([("Sig", "before", "G1"), ("Sig", "after", "G2")], "category string, phrase string, grp string")
    got = {r["call_id"]: r for r in speech.second_voice_shift(calls, hits, groups, rules).collect()}
    assert set(got) == {1, 2}
    a, b = got[1], got[2]
    assert (a["agent_phrase"], a["supervisor_phrase"], a["behaviour_changed"], a["voice_s"]) == ("before", "after", 1, 80)
    assert (a["talk_s"], a["supervisor_s"], a["agent_s"]) == (280, 220, 80)
    assert (b["agent_category"], b["supervisor_group"], b["behaviour_changed"], b["agent_s"]) == ("Not Applicable", "Not Applicable", 0, 300)


def test_script_hit_without_opportunity_counts_zero(spark):
    cols = "session string, duration_s int, direction string, is_contact int, is_connect int, result_class string"
    calls = spark.createDataFrame([("s1", 70, "INBOUND", 1, 1, "RPC"), ("s2", 20, "INBOUND", 1, 1, "RPC")], cols)
    recordings = spark.createDataFrame([("s1", 1)], "session string, call_id int")
    hits = spark.createDataFrame([(1, "rec", "r", 1000), (1, "purpose", "p", 2000), (1, "creditor", "c", 3000), (1, "Sig", "early", 1000),
                                  (1, "Sig", "late", 4000), (1, "bad", "Mid", 5000), (1, "bad", "High", 6000)], HITS)
    groups = spark.createDataFrame([("Sig", "late", "G")], "category string, phrase string, grp string")
    rules = speech.ScriptRules("rec", "purpose", "creditor", "balance", "voice", ("Sig",), "eff", "neg", "open", "close", "ver", "bad")
    got = {r["session"]: r for r in speech.script_adherence(calls, recordings, hits, groups, rules).collect()}
    a, b = got["s1"], got["s2"]
    assert (a["recording_hit"], a["purpose_hit"], a["creditor_hit"], a["creditor_opp"]) == (1, 1, 0, 0)
    assert (a["signal_phrase"], a["signal_group"], a["opening_s"]) == ("late", "G", 3)
    assert (a["dissat_score"], a["worst_phrase"], a["early_hangup"]) == (0.0, "High", 0)
    assert (b["recording_opp"], b["dissat_score"], b["early_hangup"], b["speech_eligible"]) == (0, None, 1, 0)


def test_signal_before_the_opening_is_the_fallback(spark):
    cols = "session string, duration_s int, direction string, is_contact int, is_connect int, result_class string"
    calls = spark.createDataFrame([("s1", 70, "INBOUND", 1, 1, "RPC")], cols)
    recordings = spark.createDataFrame([("s1", 1)], "session string, call_id int")
    hits = spark.createDataFrame([(1, "balance", "b", 9000), (1, "Sig", "x", 2000), (1, "Sig", "y", 1000)], HITS)
    groups = spark.createDataFrame([("Sig", "q", "G")], "category string, phrase string, grp string")
    rules = speech.ScriptRules("rec", "purpose", "creditor", "balance", "voice", ("Sig",), "eff", "neg", "open", "close", "ver", "bad")
    r = speech.script_adherence(calls, recordings, hits, groups, rules).first()
    assert (r["signal_phrase"], r["signal_group"], r["dissat_score"]) == ("y", None, 1.0)


def test_sloping_needs_accounts_and_history(spark):
    cols = "g string, score_group int, m date, accounts bigint, calls bigint, payments double"
    old = spark.createDataFrame([("a", 1, day("2023-01-01"), 10, 1, 10.0), ("a", 2, day("2023-01-01"), 10, 1, 30.0)], cols)
    new = spark.createDataFrame([("a", 1, day("2024-01-01"), 600, 3, 6.0), ("a", 2, day("2024-01-01"), 400, 1, 8.0),
                                 ("b", 1, day("2024-01-01"), 5000, 1, 8.0), ("a", 1, day("2023-12-01"), 999, 1, 8.0)], cols)
    out = scorecard.score_sloping(old.withColumnRenamed("m", "list_month"), new.withColumnRenamed("m", "rpt_month"), ["g"], "2024-02-15")
    assert rows(out, "g", "score_group", "actual_share", "predicted_share", "historic_yield") == [
        ("a", 1, 0.75, 0.25, 1.0), ("a", 2, 0.25, 0.75, 3.0)]


def test_waterfall_rows_of_enrolled_and_offered_programs(spark):
    """Repeated enrolments, a NULL program, two first offers at one time, rows without session."""
    at = lambda n: ts("2024-01-01 10:00") + dt.timedelta(minutes=n)
    metrics = spark.createDataFrame([
        (1, "enroll", at(5), "Gold", 7, 70), (2, "enroll", at(6), "Gold", 7, 70), (3, "enroll", at(6), None, 7, 70),
        (4, "offer", at(1), "AB", 7, 70), (5, "offer", at(1), "C", 7, 70), (6, "offer", at(2), "B", 7, 70),
        (7, "offer", at(0), "A", 8, 80), (8, "view", at(0), "x", None, 80), (9, "offer", at(0), None, 8, 80),
    ], "metric_id int, key string, ts timestamp, description string, session int, account int")
    out = scorecard.program_waterfall(metrics, "enroll", "offer", {"A": "Alpha", "B": "Beta"}, [("C", "B")], "2024-01-01")
    enrolled = [(m, p, "Enrolled", 2, 1) for m in range(1, 7) for p in ("Gold", None)]
    viewed = [(4, "Alpha", "Viewed", 1, 1), (4, "Beta", "Viewed", 1, 1), (5, "Beta", "Viewed", 1, 1), (7, "Alpha", "Viewed", 1, 1)]
    assert rows(out, "metric_id", "program", "campaign", "campaign_order", "occurrence") == sorted(enrolled + viewed, key=repr)
    assert out.columns == [*metrics.columns, "program", "campaign", "campaign_order", "occurrence"]


@pytest.mark.parametrize("lag,shown", [(6, 3), (2, 5)])
def test_one_scan_sloping_equals_the_two_tables(spark, lag, shown):
    """Random rows with NULL groups, score groups, months and figures; with lag 2 and 5 months
    shown, the history and the report months overlap."""
    import random

    pick = random.Random(lag)
    maybe = lambda *values: pick.choice([*values, *values, None])
    data = [(maybe("a", "b", "c"), maybe("x", "y"), maybe(1, 2, 3), maybe(*[dt.date(2023 + k // 12, k % 12 + 1, 1) for k in range(16)]),
             maybe(0, 40, 300), maybe(0, 1, 5), maybe(0.0, 2.0, 8.0)) for _ in range(600)]
    volumes = spark.createDataFrame(
        data, "g string, h string, score_group int, month date, accounts bigint, calls bigint, payments double")
    args = {"lag_months": lag, "current_months": shown, "min_accounts": 900}
    one = scorecard.score_sloping_one_scan(volumes, ["g", "h"], "2024-04-15", **args)
    two = scorecard.score_sloping(
        volumes.withColumnRenamed("month", "list_month"), volumes.withColumnRenamed("month", "rpt_month"), ["g", "h"], "2024-04-15", **args)
    shares = ["actual_share", "historic_yield", "predicted_share", "month_yield"]
    cols = ["g", "h", "rpt_month", "score_group", "accounts", "calls", "payments", *[F.round(c, 9).alias(c) for c in shares]]
    got = rows(one, *cols)
    assert got and got == rows(two, *cols)
    assert sorted(one.columns) == sorted(two.columns)


def test_sloping_scans_its_table_once(spark):
    from dunlin.catalog import reports

    plan = reports.score_sloping(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len([r for r in plan.splitlines() if "Relation" in r]) == 2  # lines and parts


def test_schedule_cycle_runs_once_a_day_and_snapshots_once_a_month(spark, tmp_path):
    columns = ["source", "account", "client", "due_date", "amount"]
    casts = {"source": "string", "account": "bigint", "client": "string", "due_date": "date:MM/dd/yyyy", "amount": "double"}
    text = spark.createDataFrame([], "source string, account string, client string, due_date string, amount string")
    fact = spark.createDataFrame(
        [("S", 1, "c", day("2024-05-20"), 7.0, None), ("S", 2, "c", day("2024-05-01"), 7.0, None)],
        "source string, account bigint, client string, due_date date, amount double, broken_date date")
    paid = spark.createDataFrame([("F", 1, day("2024-01-01"), "X")], "source string, account bigint, pay_date date, kind string")
    accounts = spark.createDataFrame([(1, "F", "seg")], "account bigint, source string, segment string")

    def run(name, data, as_of):
        landed = export_csv(spark.createDataFrame(data, text.schema), str(tmp_path / "in"), name, as_of)
        matrix, history = payments.schedule_cycle(
            spark, landed, columns, casts, str(tmp_path / "table"), str(tmp_path / "snaps"), [fact], paid, accounts, as_of, n_months=2)
        return (rows(matrix, "source", "account", "month_1", "month_2", "over_range", "n_paid", "taken", "segment"),
                rows(history, "account", "amount", F.col("snapshot_month").cast("string")))

    star = ("S", 1, 7.0, 0.0, 0.0, 0, 1, None)
    first = ("F", "1", "c", "05/25/2024", "3.00")
    one = run("a", [first, first], "2024-05-10")  # the repeated row counts once
    assert one == ([("F", 1, 3.0, 0.0, 0.0, 1, 2, "seg"), star], [(1, 3.0, "2024-05-01")])
    assert run("b", [("F", "1", "c", "05/25/2024", "9.00")], "2024-05-10") == one  # loaded today: nothing changes
    matrix, history = run("c", [("F", "1", "c", "06/25/2024", "4.00")], "2024-05-11")  # new list, same month
    assert (matrix, history) == ([("F", 1, 0.0, 4.0, 0.0, 1, 2, "seg"), star], one[1])
    matrix, history = run("d", [("F", "1", "c", "06/25/2024", "4.00")], "2024-06-01")
    assert history == [(1, 3.0, "2024-05-01"), (1, 4.0, "2024-06-01")]


def test_payments_keep_interactions_without_account(spark):
    calls = spark.createDataFrame([(1, 5, day("2024-01-01")), (2, None, day("2024-01-01")), (3, 5, None)], "call int, account int, day date")
    pays = spark.createDataFrame([(5, day("2024-01-01"), 8.0)], "account int, day date, amount double")
    out = payments.payment_to_interaction(calls, pays)
    assert rows(out, "call", "pay_received", "pay_share") == [(1, 8.0, 8.0), (2, 0.0, 0.0), (3, 0.0, 0.0)]


def test_attribution_state_equals_the_rebuild(spark, tmp_path):
    """Three windows, one of them repeated; the second run cannot read what lies before the watermark."""
    import random

    pick = random.Random(5)
    span = lambda: ts("2024-01-01") + dt.timedelta(minutes=pick.randint(0, 50 * 1440))
    events = []
    for _ in range(600):
        account = pick.randint(1, 6)
        events.append((f"g{account}-{pick.randint(1, 4)}", span(), pick.choice([5, 6, 8, 9, 10, 10, 12, 13, 100]), None,
                       pick.choice(["Hard-Bounce", "Opt-Out", "Bad-Record", None]), "V", pick.randint(1, 3), account,
                       pick.choice(["C", "D"]), 2, "L", "u@d.example", "s"))
    log = spark.createDataFrame(events, MESSAGE)
    pays = spark.createDataFrame([(i, pick.randint(1, 6), 2, span().date(), float(i)) for i in range(60)], PAY)
    revs = spark.createDataFrame([], "account int, crm int, pay_date date, amount double")
    report, state = str(tmp_path / "report"), str(tmp_path / "state")
    for until in ("2024-01-20", "2024-02-05", "2024-02-05", "2024-02-28"):
        messages.update_attribution_state(state, log, until)
    got = messages.attribution_from_state(spark, state, pays, revs, "2024-02-28", replay_days=30)
    want = messages.message_attribution(log, pays, revs, "2024-02-28", replay_days=30)
    assert rows(got) == rows(want) and want.count()
    with pytest.raises(ValueError):
        messages.update_attribution_state(state, log, "2024-02-01")
    # an event before the watermark that reaches a later run would change the state: it must not
    early = spark.createDataFrame([message("g1-1", "2023-12-31 08:00", 10)], MESSAGE)
    messages.update_attribution_state(state, log.unionByName(early), "2024-03-01")
    after = messages.attribution_from_state(spark, state, pays, revs, "2024-02-28", replay_days=30)
    assert rows(after) == rows(want)
    # a stored report keeps the first send of (crm, client, account)
    messages.refresh_attribution(report, log, pays, revs, "2024-02-28", state=str(tmp_path / "other"), replay_days=60)
    stored = spark.read.parquet(report)
    firsts = {(r["client"], r["account"]): r["first_send_date"] for r in stored.collect()}
    assert len(firsts) > len({account for _, account in firsts})
    # without any event there is no state and no report
    messages.update_attribution_state(str(tmp_path / "none"), log.where("false"), "2024-01-01")
    assert messages.attribution_from_state(spark, str(tmp_path / "none"), pays, revs, "2024-01-01") is None


def test_state_without_opens(spark, tmp_path):
    log = spark.createDataFrame([message("a", "2024-01-01 08:00", 10)], MESSAGE)
    pays = spark.createDataFrame([(1, 1, 2, day("2024-01-02"), 5.0)], PAY)
    revs = spark.createDataFrame([], "account int, crm int, pay_date date, amount double")
    messages.update_attribution_state(str(tmp_path), log, "2024-01-10")
    out = messages.attribution_from_state(spark, str(tmp_path), pays, revs, "2024-01-10")
    assert rows(out, "guid", "delivered", "payments") == [("a", 1, 0.0)]
