"""Score models: train, store, score, and the score-and-write-back job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.functions.dates import as_date
from dunlin.operators.percentiles import deciles
from dunlin.sources.checkpoints import cut_lineage
from dunlin.sources.sinks import write_back


BINS = 32  # of a feature, as many as the tree learner makes
BINNED_ROWS = 10_000  # rows that bound the bins, as many as the learner takes for it


def _bounds(values: np.ndarray, bins: int) -> list[float]:
    """Bounds of a feature's bins (a value on a bound is below it), by the tree learner's rule:
    half way between neighbours, at every value or, where these are too many, where the rows
    so far come nearest to the next of ``bins`` equal shares."""
    found, counts = np.unique(values, return_counts=True)
    middles = found[:-1] / 2 + found[1:] / 2
    if len(middles) >= bins:
        done, share, chosen = np.cumsum(counts), len(values) / bins, []
        for k in range(len(middles)):
            target = share * (len(chosen) + 1)
            if abs(done[k] - target) < abs(done[k + 1] - target):
                chosen.append(k)
        middles = middles[chosen]
    above = np.nextafter(middles, np.inf)  # Bucketizer puts a value on a split above it
    return sorted({x for x in above.tolist() if np.isfinite(x)}) or [0.0]


def train_score_model(
    df: DataFrame, label: str, features: Sequence[str] | None = None, rounds: int = 200,
    depth: int = 6, step: float = 0.3, seed: int = 42,
) -> PipelineModel:
    """Regression trees with squared error on all columns but the label. Scores cannot equal
    those of another tree library bit by bit; the interface and the use are the same.

    The trees split a feature between bins only, so rows of the same bins and label are one to
    them. All rows are grouped by these, and each of the rounds reads the groups, weighted by
    their rows, instead of the rows: the same trees, and rounds that do not grow with the rows
    once every combination of bins has been seen."""
    cols = list(features or [c for c in df.columns if c != label])
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols],
                      F.col(label).cast("double").alias(label))
    filled, binned = [f"{c}__f" for c in cols], [f"{c}__b" for c in cols]
    imputer = Imputer(inputCols=cols, outputCols=filled).fit(typed)
    whole = imputer.transform(typed)
    n = whole.count()
    some = whole if n <= BINNED_ROWS else whole.sample(BINNED_ROWS / n, seed)
    values = some.select(*filled).toArrow()
    bounds = [_bounds(values.column(c).to_numpy(), min(BINS, n)) for c in filled]
    bins = Bucketizer(inputCols=filled, outputCols=binned, splitsArray=[[-np.inf, *x, np.inf] for x in bounds])
    groups = bins.transform(whole).groupBy(*binned, label).agg(F.count(F.lit(1)).cast("double").alias("__rows"))
    # bins are in order: without the mark of unordered categories that Bucketizer leaves on them
    groups = cut_lineage(groups.select(*[F.col(c).alias(c, metadata={}) for c in binned], label, "__rows"))
    vector = VectorAssembler(inputCols=binned, outputCol="features")
    trees = GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, maxBins=BINS,
                         lossType="squared", predictionCol="score", checkpointInterval=10, weightCol="__rows")
    return PipelineModel([imputer, bins, vector, trees.fit(vector.transform(groups))])


def save_model(model: PipelineModel, folder: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def score_model(df: DataFrame, model: PipelineModel | str, features: Sequence[str], keys: str | Sequence[str]):
    """(keys, score) of a frame under a model or a stored model path."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    fitted = PipelineModel.load(model) if isinstance(model, str) else model
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    return fitted.transform(typed).select(*keys, "score")


def target_encode(
    df: DataFrame, category: str, paid: Column, out: str, n: int = 10, as_of=None,
    day: str | None = None, look_back_days: int = 90,
) -> DataFrame:
    """Category -> conversion ln(payers)/ln(accounts) and its decile (1 = best).

    Logs of 0 and 1 count as 0, and a conversion without payers is 0. Equal conversions are
    ordered by category, of whatever type and however many there are."""
    rows = df
    if as_of is not None:
        start = as_date(as_of) - dt.timedelta(days=look_back_days)
        rows = rows.where(F.col(day) >= F.lit(str(start)).cast(df.schema[day].dataType))
    counts = rows.groupBy(category).agg(
        F.count(F.lit(1)).alias("num_accounts"), F.count_if(paid).alias("num_paid")
    )
    log_paid = F.when(F.col("num_paid") <= 1, 0.0).otherwise(F.ln("num_paid"))
    rate = F.when(log_paid == 0, 0.0).otherwise(log_paid / F.ln("num_accounts"))
    encoded = counts.withColumn("conversion", F.round(rate, 12))
    return deciles(encoded, "conversion", category, out, n, desc=True)


def score_pending(
    pending: DataFrame, model: PipelineModel | str, lookups: Mapping[str, DataFrame],
    features: Sequence[str], keys: str | Sequence[str], tie: str, as_of, is_pending: Column,
    score_col="score", group_col="score_group", stamp_col="process_date",
) -> DataFrame:
    """Encode, score, decile and write back the rows that are still pending; all other rows
    keep their values, also those with the keys of a pending one. ``keys`` (say account and
    insert date) must tell pending rows apart; ``tie`` is one of them. ``lookups`` maps a
    category column to its ``target_encode`` frame (columns category, ``<category>_level``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    todo = pending.where(is_pending)
    for category, table in lookups.items():
        todo = todo.join(table.select(category, f"{category}_level"), category, "left")
    scores = cut_lineage(score_model(todo, model, features, keys))  # read five times below
    if not scores.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"pending rows repeat their keys ({', '.join(keys)})")
    ranked = deciles(scores.withColumn("__tie", F.col(tie)), "score", "__tie", "__group", desc=True)
    stamped = ranked.select(
        *keys, F.col("score").alias(score_col), F.col("__group").alias(group_col),
        F.lit(str(as_date(as_of))).cast("date").alias(stamp_col),
    )
    return write_back(pending, stamped, keys, [score_col, group_col, stamp_col], only=is_pending)
