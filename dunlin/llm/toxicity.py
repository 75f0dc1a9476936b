"""Toxicity as ordinal severity: a cumulative-link (proportional odds) model on sparse text
features.

P(grade > k) = sigmoid(score - threshold_k): one weight per feature, shared by all thresholds,
and thresholds in increasing order. The output is the expected severity, the sum of
P(grade > k) over k.

Features are the words of a document and their first 4, 5 and 6 letters, each counted once;
insults in several languages differ in their endings only. The model is fitted on a bounded
sample of labelled rows (``sample`` rows of each grade at most, those with the smallest hash
of their id): words are counted on Spark, the features that go with higher grades are kept,
and only the sample's kept features and grades, a few numbers a row, reach the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dunlin.llm.common import drop_stage, stage

SAMPLE = 4000
MAX_FEATURES = 4096
REJECT_ABOVE = 0.5  # P(grade > 0) from which a text counts as toxic
MIN_ROWS = 5  # labelled rows a feature must occur in

_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    """Lower-case words and, marked by ``*``, their prefixes. None is empty."""
    words = set(_WORD.findall(text.lower())) if text else set()
    out = set(words)
    for n in (4, 5, 6):
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


def _explode_features(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 128):  # the features of a batch take far more room than its texts
            part = batch.slice(a, 128)
            own = [sorted(features_of(x.as_py())) for x in part.column("text")]
            rows = pa.array(np.repeat(np.arange(len(own)), [len(f) for f in own]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(rows), part.column("grade").take(rows), pa.array([f for fs in own for f in fs], pa.string())],
                names=["doc_id", "grade", "feature"])


@dataclass
class OrdinalModel:
    """``weights`` by feature and increasing ``thresholds``; small enough to broadcast."""

    weights: dict[str, float]
    thresholds: list[float]

    def severity(self, text: str | None) -> tuple[list[float], float]:
        """P(grade > k) for each k, and their sum."""
        score = sum(self.weights[f] for f in features_of(text) & self.weights.keys())
        above = [1 / (1 + np.exp(np.clip(t - score, -50, 50))) for t in self.thresholds]
        return above, float(sum(above))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, n_grades: int, weight: np.ndarray | None = None,
                penalty: float = 0.02, rounds: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood, by Adam over all rows.

    With s the score, P(grade <= k) = sigmoid(t_k - s); thresholds are the first one plus
    positive steps exp(d_k), so they stay ordered. ``weight`` says how many rows each stands for.
    """
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((f for r in rows for f in r), np.int64, len(row))
    weight = np.ones(len(grades)) if weight is None else weight
    weight = weight / weight.sum()
    w, first, steps = np.zeros(n_features), np.zeros(1), np.zeros(max(n_grades - 2, 0))
    params = [w, first, steps]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for t in range(1, rounds + 1):
        score = np.bincount(row, w[col], len(rows))
        cuts = np.concatenate([[-np.inf], first[0] + np.concatenate([[0], np.cumsum(np.exp(steps))]), [np.inf]])
        sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        up, down = sig(cuts[grades + 1] - score), sig(cuts[grades] - score)
        up[grades == n_grades - 1], down[grades == 0] = 1, 0
        p = np.maximum(up - down, 1e-9)
        d_up, d_down = up * (1 - up) / p * weight, down * (1 - down) / p * weight
        g_score = d_up - d_down  # of the negative log likelihood
        g_cut = np.bincount(grades, -d_up, n_grades + 1)[:n_grades - 1]
        g_cut = g_cut + np.bincount(np.maximum(grades - 1, 0), d_down * (grades > 0), n_grades + 1)[:n_grades - 1]
        tails = np.cumsum(g_cut[::-1])[::-1]
        grads = [np.bincount(col, g_score[row], n_features) + penalty * w / max(n_features, 1),
                 tails[:1], tails[1:] * np.exp(steps)]
        for q, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w, first[0] + np.concatenate([[0], np.cumsum(np.exp(steps))])


def train(docs: DataFrame, graded: DataFrame, sample: int = SAMPLE, max_features: int = MAX_FEATURES,
          min_rows: int = MIN_ROWS, severe: tuple[int, ...] = (2, 4)) -> OrdinalModel:
    """Fit on ``docs`` (doc_id, text) and ``graded`` (doc_id, grade from 0).

    Where the labels only say 0 or 1, rows of grade 1 are graded further by how many of the
    kept whole words they hold: one more grade at each count in ``severe``.

    At most ``sample`` rows of each grade are used: those with the smallest hash of doc_id.
    Rows without an id, a text or a grade are not used. Without two grades the model gives
    severity 0 to everything.
    """
    spark = docs.sparkSession
    known = graded.selectExpr("cast(doc_id as bigint) as doc_id", "cast(grade as int) as grade").where(
        "doc_id is not null and grade is not null").dropDuplicates(["doc_id"])
    n_grades = (known.agg(F.max("grade")).first()[0] or 0) + 1
    if n_grades < 2:
        return OrdinalModel({}, [50.0])
    total = {r.grade: r["count"] for r in known.groupBy("grade").count().collect()}
    chosen = []
    for g in range(n_grades):
        rows = known.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen += [(r.doc_id, g) for r in rows.collect()]
    picked = spark.createDataFrame(chosen, "doc_id bigint, grade int")
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").where("text is not null")
    pairs = texts.join(F.broadcast(picked), "doc_id").mapInArrow(
        _explode_features, "doc_id bigint, grade int, feature string")
    pairs = stage(pairs, "toxicity-features")
    grades = dict(chosen)
    sizes = np.bincount(list(grades.values()), minlength=n_grades)
    low, high = max(sizes[0], 1), max(sizes[1:].sum(), 1)
    toxic = F.sum((F.col("grade") > 0).cast("int"))
    counts = pairs.groupBy("feature").agg(toxic.alias("hi"), F.count(F.lit(1)).alias("n")).where(f"n >= {min_rows}")
    # surplus of rows with the feature among graded rows, in standard errors
    lift = (F.col("hi") / float(high) - (F.col("n") - F.col("hi")) / float(low)) / F.sqrt(F.col("n") / float(low + high))
    kept = [r.feature for r in counts.withColumn("lift", lift).where("lift > 0.2").orderBy(
        F.desc("lift"), "feature").limit(max_features).collect()]
    place = {f: k for k, f in enumerate(kept)}
    stands_for = {d: total[g] / sizes[g] for d, g in grades.items()}  # rows of the grade for each of the sample
    own: dict[int, list[int]] = {d: [] for d in grades}
    wanted = spark.createDataFrame([(f,) for f in kept], "feature string")
    for r in pairs.join(F.broadcast(wanted), "feature").select("doc_id", "feature").toLocalIterator():
        own[r.doc_id].append(place[r.feature])
    drop_stage(pairs)
    if n_grades == 2:
        words = {k for f, k in place.items() if not f.endswith("*")}
        grades = {d: g and 1 + sum(len(words.intersection(own[d])) >= c for c in severe) for d, g in grades.items()}
        n_grades = max(grades.values()) + 1
    order = sorted(grades)
    w, cuts = fit_ordinal([sorted(set(own[d])) for d in order], np.array([grades[d] for d in order]), len(kept), n_grades,
                          np.array([stands_for[d] for d in order]))
    return OrdinalModel({f: float(w[k]) for f, k in place.items() if w[k]}, [float(t) for t in cuts])


def toxic_column(model: OrdinalModel, text, reject_above: float = REJECT_ABOVE):
    """Whether a text column is toxic, for ``where``; NULL texts count as empty."""

    @F.pandas_udf("boolean")
    def apply(texts):
        return texts.map(lambda t: bool(model.severity(t)[0][0] > reject_above)).astype(bool)

    return apply(text)


def score_severity(docs: DataFrame, model: OrdinalModel, reject_above: float = REJECT_ABOVE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, severity (expected grade), p_above
    (P(grade > k) for each k), toxic (P(grade > 0) above ``reject_above``).

    NULL and empty texts have no features; NULL and repeated doc_ids are passed through row by
    row; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            got = [model.severity(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for _, s in got], pa.float64()),
                 pa.array([[float(x) for x in p] for p, _ in got], pa.list_(pa.float64())),
                 pa.array([bool(p[0] > reject_above) for p, _ in got], pa.bool_())],
                names=["doc_id", "severity", "p_above", "toxic"])

    narrow = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return narrow.mapInArrow(run, "doc_id bigint, severity double, p_above array<double>, toxic boolean")
