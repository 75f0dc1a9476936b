"""Call-transcript reports.

Canonical frames: ``calls`` (one row per call_id), ``hits`` (call_id, category, phrase,
start_ms) and ``words`` (call_id, speaker, start_ms); a ``transcript`` holds both (a word that is
no hit has a NULL category). Category names are arguments. Every report reads its hits once:
they are reduced per second of a call, then per call to first and last events (min and max of
structs, which combine map-side) and one array with an entry per second. Conditions that depend
on other events of the call (after the opening, before the supervisor) are folded over that array
by higher-order functions, so no report joins the hits back to what was derived from them.
An array is bounded by the seconds of a call, not by its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.functions.labels import upto_bands
from dunlin.functions.text import whole_seconds
from dunlin.operators.joins import semi

# Signal-to-effort gap bands in seconds, upper edge included.
GAP_BANDS = (
    (120, "A.00-120 Seconds"), (240, "B.121-240 Seconds"), (360, "C.241-360 Seconds"),
    (480, "D.361-480 Seconds"),
)
GAP_REST = "E.480+ Seconds"


def _event() -> Column:
    return F.struct(
        F.col("start_ms").alias("start_ms"), F.col("category").alias("category"),
        F.col("phrase").alias("phrase"),
    )


def first_hit(pred: Column) -> Column:
    """Earliest matching hit of the group (ties: smallest category, then phrase)."""
    return F.min(F.when(pred, _event()))


def last_hit(pred: Column) -> Column:
    return F.max(F.when(pred, _event()))


def hit_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("sec", whole_seconds(F.col("start_ms")))


def transcript(hits: DataFrame, words: DataFrame) -> DataFrame:
    """Hits and words as one frame: call_id, start_ms, speaker, category, phrase."""
    none = F.lit(None).cast("string")
    return hits.select("call_id", "start_ms", none.alias("speaker"), "category", "phrase").unionByName(
        words.select("call_id", "start_ms", "speaker", none.alias("category"), none.alias("phrase")))


def fold_sum(seconds: Column, name: str, inside) -> Column:
    """Sum of a field over the seconds of a call that lie ``inside``."""
    return F.aggregate(
        seconds, F.lit(0).cast("bigint"),
        lambda total, s: total + F.when(inside(s["sec"]), s[name]).otherwise(0),
    )


def fold_first(seconds: Column, name: str, inside) -> Column:
    """Smallest event of a field over the seconds of a call that lie ``inside``."""
    return F.array_min(F.transform(F.filter(seconds, lambda s: inside(s["sec"])), lambda s: s[name]))


@dataclass(frozen=True)
class EffortRules:
    contact: str
    machine: str
    signals: tuple
    effort: str
    open_question: str
    closed_question: str
    agent: str = "Agent"
    promise_results: tuple = ()


def conversation_effort(
    calls: DataFrame, hits: DataFrame, words: DataFrame | None, rules: EffortRules, form: str = "effort"
) -> DataFrame:
    """Words and questions between the first customer signal and the last agent effort.

    Population: calls with a contact marker and no answering-machine marker. ``form="effort"``
    needs the effort to follow the signal and counts in ``signal <= t <= effort``;
    ``form="profile"`` needs only a signal and counts everything from it on. With ``words=None``,
    ``hits`` is a transcript, which is then scanned once.
    """
    cat, speaker = F.col("category"), F.col("speaker")
    names = {f"n_{name.lower()}": name for name in rules.signals}
    counts = {
        "agent_words": speaker == rules.agent, "customer_words": speaker != rules.agent,
        "open_questions": cat == rules.open_question, "closed_questions": cat == rules.closed_question,
    }
    per_second = hit_seconds(hits if words is None else transcript(hits, words)).groupBy("call_id", "sec").agg(
        F.max(cat == rules.contact).alias("__contact"), F.max(cat == rules.machine).alias("__machine"),
        first_hit(cat.isin(*rules.signals)).alias("__signal"),
        last_hit(cat == rules.effort).alias("__effort"),
        *[F.count_if(cat == name).alias(out) for out, name in names.items()],
        *[F.count_if(cond).alias(out) for out, cond in counts.items()],
    )
    counted = F.greatest(*counts) > 0
    per_call = per_second.groupBy("call_id").agg(
        F.max("__contact").alias("__contact"), F.max("__machine").alias("__machine"),
        F.min("__signal").alias("__signal"), F.max("__effort").alias("__effort"),
        *[F.sum(out).alias(out) for out in names],
        F.collect_list(F.when(counted, F.struct("sec", *counts))).alias("__seconds"),
    ).where(F.col("__contact") & ~F.coalesce("__machine", F.lit(False)) & F.col("__signal").isNotNull())
    anchored = per_call.select(
        "call_id", *names, "__seconds",
        F.col("__signal.category").alias("signal"), F.col("__signal.phrase").alias("signal_phrase"),
        whole_seconds(F.col("__signal.start_ms")).alias("signal_s"),
        F.col("__effort.phrase").alias("effort_phrase"),
        whole_seconds(F.col("__effort.start_ms")).alias("effort_s"),
        (F.col("__effort.start_ms") > F.col("__signal.start_ms")).alias("__later"),
    )
    inside = lambda sec: sec >= F.col("signal_s")
    if form == "effort":
        anchored = anchored.where("__later")
        inside = lambda sec: sec.between(F.col("signal_s"), F.col("effort_s"))
    folded = anchored.withColumns({c: fold_sum(F.col("__seconds"), c, inside) for c in counts})
    out = calls.join(folded.drop("__later", "__seconds"), "call_id").withColumn(
        "promised", F.col("result").isin(*rules.promise_results).cast("int"))
    if form == "effort":
        gap = F.col("effort_s") - F.col("signal_s")
        return out.withColumns({"gap_s": gap, "gap_band": upto_bands(gap, GAP_BANDS, GAP_REST)})
    return out.drop("effort_s", "effort_phrase")


@dataclass(frozen=True)
class Program:
    """One offer program: its offer and success categories, the filter on the account columns,
    up to four account columns to report, and whether only later successes count."""

    name: str
    offer: str
    success: str
    account_filter: Column
    details: tuple = ()
    call_filter: Column | None = None
    success_after_offer: bool = False


def offer_success(
    calls: DataFrame, hits: DataFrame, accounts: DataFrame, programs: Sequence[Program]
) -> DataFrame:
    """First offer and first success per call and program; a success without an offer implies
    an offer at the success time. Programs differ in their account filters and detail columns,
    which become text columns ``detail_1..4``.

    All programs share one pass over the hits."""
    cat = F.col("category")
    aggs = []
    for i, p in enumerate(programs):
        aggs += [
            F.min(F.when(cat == p.offer, F.col("start_ms"))).alias(f"__offer_{i}"),
            F.min(F.when(cat == p.success, F.col("start_ms"))).alias(f"__success_{i}"),
        ]
    per_call = hits.groupBy("call_id").agg(*aggs)
    base = calls.join(per_call, "call_id").join(accounts, "account")

    def entry(i: int, p: Program) -> Column:
        offer, success = F.col(f"__offer_{i}"), F.col(f"__success_{i}")
        offer_s = whole_seconds(F.coalesce(offer, success))
        success_s = whole_seconds(F.coalesce(success, F.lit(0)))
        keep = (offer.isNotNull() | success.isNotNull()) & p.account_filter
        if p.call_filter is not None:
            keep = keep & p.call_filter
        if p.success_after_offer:
            keep = keep & success.isNotNull() & (offer_s < success_s)
        text = lambda c: c.cast("string")
        details = [text(F.col(c)) for c in p.details] + [F.lit(None).cast("string")] * 4
        return F.when(keep, F.struct(
            F.lit(p.name).alias("program"), text(offer_s).alias("offer_s"),
            text(success.isNotNull().cast("int")).alias("succeeded"),
            text(success_s).alias("success_s"),
            *[c.alias(f"detail_{j}") for j, c in enumerate(details[:4], 1)],
        ))

    # one row per kept program: the branches of the union as an exploded array
    kept = F.array_compact(F.array(*[entry(i, p) for i, p in enumerate(programs)]))
    return base.select(
        *[F.col(c).cast("string").alias(c) for c in ("call_id", "account", "client")],
        F.explode(kept).alias("__p"),
    ).select("call_id", "account", "client", "__p.*").distinct()


@dataclass(frozen=True)
class VoiceRules:
    supervisor: str
    openings: tuple
    signals: tuple
    script: str
    script_ignored: tuple = ()
    opening_max_s: int = 180
    promise_class: str = "PTP"


def second_voice_shift(
    calls: DataFrame, hits: DataFrame, groups: DataFrame, rules: VoiceRules
) -> DataFrame:
    """Customer signals before ("Agent") and after ("Supervisor") the last supervisor marker.

    Calls need an opening marker within the first seconds. ``groups`` maps (category, phrase)
    to a behaviour group; ``behaviour_changed`` compares the groups on both sides."""
    cat, sec = F.col("category"), F.col("sec")
    script = (cat == rules.script) & ~F.col("phrase").isin(*rules.script_ignored)
    per_second = hit_seconds(hits).groupBy("call_id", "sec").agg(
        F.max(cat == rules.supervisor).alias("__voice"), F.max(cat.isin(*rules.openings)).alias("__opening"),
        F.max(script).alias("__script"), first_hit(cat.isin(*rules.signals)).alias("signal"),
    )
    signal = F.when(F.col("signal").isNotNull(), F.struct("sec", "signal"))
    per_call = per_second.groupBy("call_id").agg(
        F.max(F.when(F.col("__voice"), sec)).alias("voice_s"),
        F.max(F.when(F.col("__opening") & (sec <= rules.opening_max_s), sec)).alias("opening_s"),
        F.max(F.when(F.col("__script"), sec)).alias("script_s"),
        F.collect_list(signal).alias("__seconds"),
    ).where(F.col("opening_s").isNotNull())
    seconds, voice = F.col("__seconds"), F.col("voice_s")
    joined = calls.join(per_call.withColumns({
        "__agent": fold_first(seconds, "signal", lambda sec: voice > sec),
        "__supervisor": fold_first(seconds, "signal", lambda sec: voice <= sec),
    }).drop("__seconds"), "call_id")
    lone = F.col("voice_s").isNull()

    def side(name):
        hit = F.col(f"__{name}")
        return {
            f"{name}_category": F.when(lone, "Not Applicable")
            .otherwise(F.coalesce(hit["category"], F.lit("No Content"))),
            f"{name}_phrase": F.when(lone, "Not Applicable")
            .otherwise(F.coalesce(hit["phrase"], F.lit("No Language"))),
            f"{name}_signal_s": F.coalesce(whole_seconds(hit["start_ms"]), F.lit(0)),
        }

    out = joined.withColumns({**side("agent"), **side("supervisor")})
    mapping = groups.select("category", "phrase", "grp").distinct()
    for name in ("agent", "supervisor"):
        looked_up = mapping.select(
            F.col("category").alias(f"{name}_category"), F.col("phrase").alias(f"{name}_phrase"),
            F.col("grp").alias(f"__{name}_grp"),
        )
        plain = F.col(f"{name}_category").isin("Not Applicable", "No Content")
        out = out.join(looked_up, [f"{name}_category", f"{name}_phrase"], "left").withColumn(
            f"{name}_group",
            F.when(plain, F.col(f"{name}_category")).otherwise(F.col(f"__{name}_grp")),
        )
    duration, voiced = F.col("duration_s"), F.col("voice_s") > 0
    same = (F.col("agent_group") == "No Content") & (F.col("supervisor_group") == "Not Applicable")
    return out.withColumns({
        "second_voice": (~lone).cast("int"),
        "has_script": F.col("script_s").isNotNull().cast("int"),
        "script_s": F.coalesce("script_s", F.lit(0)),
        "talk_s": duration - F.col("silence_s"),
        "supervisor_s": F.when(~lone, duration - F.col("voice_s")).otherwise(0),
        "agent_s": F.when(~lone, F.col("voice_s")).otherwise(duration),
        "promised": (F.col("result_class") == rules.promise_class).cast("int"),
        "behaviour_changed": F.when(same, 0)
        .when(F.col("agent_group") == F.col("supervisor_group"), 0).otherwise(1),
        "voice_s": F.coalesce("voice_s", F.lit(0)),
    }).drop("__agent", "__supervisor", "__agent_grp", "__supervisor_grp")


@dataclass(frozen=True)
class ScriptRules:
    """Category names of the script check. ``disclosures`` are recording notice, purpose
    notice, creditor and balance in that order; the last two set the opening time."""

    recording: str
    purpose: str
    creditor: str
    balance: str
    voice: str
    signals: tuple
    effort: str
    negotiation: str
    open_question: str
    closed_question: str
    verification: str
    dissatisfaction: str
    severity: tuple = (("H", 0.0), ("M", 0.5), ("L", 0.75))
    third_party: str = "TPC"
    limits: Mapping = field(default_factory=lambda: {
        "purpose": 60, "creditor": 90, "balance": 120, "negotiation": 240, "verification": 240,
    })


def script_adherence(
    calls: DataFrame, recordings: DataFrame, hits: DataFrame, groups: DataFrame, rules: ScriptRules
) -> DataFrame:
    """Script hits against opportunities per call.

    ``calls``: session, duration_s, direction, is_contact, is_connect, result_class.
    ``recordings``: session, call_id (a call without a recording has no opportunity). A hit
    without an opportunity counts 0. The first customer signal is taken after the opening when
    one exists there, else before it. Question counts are NULL for calls without a question
    after the opening; severity counts are 0 for recorded calls without dissatisfaction.
    """
    cat, sec = F.col("category"), F.col("sec")
    timed = hit_seconds(semi(hits, recordings, "call_id")).select(
        "call_id", "category", "phrase", "sec", F.col("sec").alias("start_ms")
    ).distinct()
    bad = cat == rules.dissatisfaction
    level = F.lit(len(rules.severity))
    for i, (prefix, _) in reversed(list(enumerate(rules.severity, 1))):
        level = F.when(F.col("phrase").startswith(prefix), i).otherwise(level)
    severities = {f"n_{p.lower()}": p for p, _ in rules.severity}
    marks = {"recording": rules.recording, "purpose": rules.purpose, "creditor": rules.creditor,
             "balance": rules.balance, "verification": rules.verification}
    per_second = timed.groupBy("call_id", "sec").agg(
        *[F.max(cat == c).alias(f"__{name}") for name, c in marks.items()],
        first_hit(cat == rules.voice).alias("__voice"),
        last_hit(cat == rules.effort).alias("__effort"),
        first_hit(cat == rules.negotiation).alias("__neg_start"),
        last_hit(cat == rules.negotiation).alias("__neg_end"),
        *[F.count_if(bad & F.col("phrase").startswith(p)).alias(out) for out, p in severities.items()],
        F.min(F.when(bad, F.struct(level.alias("level"), "sec", "phrase"))).alias("__worst"),
        first_hit(cat.isin(*rules.signals)).alias("signal"),
        F.count_if(cat == rules.open_question).alias("open_questions"),
        F.count_if(cat == rules.closed_question).alias("closed_questions"),
    )
    phased = F.col("signal").isNotNull() | (F.col("open_questions") + F.col("closed_questions") > 0)
    per_call = per_second.groupBy("call_id").agg(
        *[F.min(F.when(F.col(f"__{name}"), sec)).alias(f"{name}_s") for name in marks],
        *[pick(c).alias(c) for pick, c in (
            (F.min, "__voice"), (F.max, "__effort"), (F.min, "__neg_start"), (F.max, "__neg_end"), (F.min, "__worst"))],
        *[F.sum(out).alias(out) for out in severities],
        F.collect_list(F.when(phased, F.struct("sec", "signal", "open_questions", "closed_questions")))
        .alias("__seconds"),
    ).withColumn("opening_s", F.coalesce("balance_s", "creditor_s", F.lit(0)))
    seconds = F.col("__seconds")
    later = lambda sec: sec >= F.col("opening_s")
    per_call = per_call.withColumns({
        "__signal": F.coalesce(
            fold_first(seconds, "signal", later), fold_first(seconds, "signal", lambda sec: F.lit(True))),
        "open_questions": fold_sum(seconds, "open_questions", later),
        "closed_questions": fold_sum(seconds, "closed_questions", later),
    }).drop("__seconds")
    score = F.lit(0.0)
    for prefix, value in reversed(rules.severity):
        score = F.when(F.col(f"n_{prefix.lower()}") > 0, value).otherwise(score)
    phrase_groups = groups.select("phrase", "grp").distinct().withColumnsRenamed(
        {"phrase": "__p", "grp": "signal_group"}
    )
    asked = F.col("open_questions") + F.col("closed_questions") > 0
    per_call = per_call.withColumns({
        c: F.when(asked, F.col(c)) for c in ("open_questions", "closed_questions")
    })
    rows = (
        calls.join(recordings, "session", "left")
        .join(per_call, "call_id", "left")
        .join(phrase_groups, F.col("__signal.phrase") == F.col("__p"), "left").drop("__p")
    )
    recorded, length = F.col("call_id").isNotNull(), F.col("duration_s")
    contact, limit = F.coalesce(F.col("is_contact"), F.lit(0)) == 1, rules.limits
    opp = {
        "recording": recorded & ((F.col("result_class") == rules.third_party) | contact),
        "purpose": recorded & contact & (length > limit["purpose"]),
        "creditor": recorded & contact & (length > limit["creditor"]),
        "balance": recorded & contact & (length > limit["balance"]),
        "negotiation": recorded & contact & (length > limit["negotiation"]),
        "verification": recorded & contact & (length > limit["verification"])
        & (F.col("direction") == "INBOUND"),
    }
    hit = {
        "recording": F.col("recording_s").isNotNull(), "purpose": F.col("purpose_s").isNotNull(),
        "creditor": F.col("creditor_s").isNotNull(), "balance": F.col("balance_s").isNotNull(),
        "negotiation": F.col("__neg_start").isNotNull(),
        "verification": F.col("verification_s").isNotNull(),
    }
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    connect = F.col("is_connect") == 1
    start, end = F.col("__neg_start.start_ms"), F.col("__neg_end.start_ms")
    return rows.withColumns({
        **{f"{n}_opp": flag(c) for n, c in opp.items()},
        **{f"{n}_hit": flag(opp[n] & hit[n]) for n in opp},
        **{f"n_{p.lower()}": F.when(recorded, F.coalesce(f"n_{p.lower()}", F.lit(0)))
           for p, _ in rules.severity},
        "dissat_opp": flag(length > 60),
        "speech_eligible": flag(connect & (length >= 30)),
        "speech_complete": flag(connect & (length >= 30) & recorded),
        "early_hangup": flag(connect & (length < 60)),
        "second_voice": flag(F.col("__voice").isNotNull()),
        "second_voice_s": F.col("__voice.start_ms"),
        "signal": F.col("__signal.category"), "signal_phrase": F.col("__signal.phrase"),
        "signal_s": F.col("__signal.start_ms"),
        "effort_s": F.col("__effort.start_ms"),
        "negotiation_s": end - start,
        "probing_s": start - F.col("opening_s"),
        "dissat_score": F.when(recorded, F.when(F.col("__worst").isNull(), 1.0).otherwise(score)),
        "worst_phrase": F.col("__worst.phrase"), "worst_s": F.col("__worst.sec"),
    }).drop("__voice", "__effort", "__neg_start", "__neg_end", "__signal", "__worst")
