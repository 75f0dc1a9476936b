"""Score models over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.catalog.base import query
from dunlin.plans import scoring
from dunlin.sources.checkpoints import cut_lineage, new_folder
from dunlin.sources.scans import load


def _encode_sql(category, source):
    return f"""
WITH c AS (SELECT {category}, count(*) AS num_accounts, count(*) FILTER (l_returnflag = 'R' AND l_tax > 0.06) AS num_paid
  FROM {source} GROUP BY 1),
r AS (SELECT *, round(CASE WHEN num_paid <= 1 THEN 0.0 ELSE ln(num_paid) / ln(num_accounts) END, 12) AS conversion FROM c)
SELECT {category}, num_accounts, num_paid, round(conversion, 8) AS conversion,
  CAST(ntile(10) OVER (ORDER BY conversion DESC, {category}) AS INTEGER) AS level FROM r"""


def _encode(spark, sf, category):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_returnflag", "l_tax"]).join(
        load(spark, sf, "part", ["p_partkey", category]), F.col("l_partkey") == F.col("p_partkey"))
    paid = (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.06)
    return scoring.target_encode(lines, category, paid, "level").withColumn("conversion", F.round("conversion", 8))


@query(_encode_sql("p_brand", "lineitem JOIN part ON l_partkey = p_partkey"))
def target_encode(spark, sf):
    return _encode(spark, sf, "p_brand")


@query(_encode_sql("p_size", "lineitem JOIN part ON l_partkey = p_partkey"))
def target_encode_numeric(spark, sf):
    return _encode(spark, sf, "p_size")


FEATURES = ["n_chars", "lang_level", "source_level"]


def _documents(spark, sf):
    """Documents with their label and two target-encoded categories."""
    docs = load(spark, sf, "documents", ["doc_id", "lang", "source", "n_chars"]).join(
        load(spark, sf, "labels", ["doc_id", "quality"]), "doc_id", "left")
    known = docs.where(F.col("quality").isNotNull())
    lookups = {c: scoring.target_encode(known, c, F.col("quality") == 1, f"{c}_level") for c in ("lang", "source")}
    return docs, known, lookups


def _model(known, lookups):
    rows = known
    for c, table in lookups.items():
        rows = rows.join(table.select(c, f"{c}_level"), c, "left")
    return scoring.train_score_model(cut_lineage(rows.select(*FEATURES, "quality")), "quality", FEATURES)


@query()
def train_and_score(spark, sf):
    """Train on labelled documents, store the model by name, score all documents with it."""
    docs, known, lookups = _documents(spark, sf)
    path = scoring.save_model(_model(known, lookups), new_folder(spark, "models"), "quality_v1")
    rows = docs
    for c, table in lookups.items():
        rows = rows.join(table.select(c, f"{c}_level"), c, "left")
    return scoring.score_model(rows, path, FEATURES, "doc_id")


@query()
def score_pending(spark, sf):
    """Score, decile and write back the documents that have no label yet."""
    docs, known, lookups = _documents(spark, sf)
    table = docs.withColumns({"score": F.lit(None).cast("double"), "score_group": F.lit(None).cast("int"),
                              "process_date": F.lit(None).cast("date")})
    return scoring.score_pending(table, _model(known, lookups), lookups, FEATURES, "doc_id", "doc_id",
                                 "2024-01-31", F.col("quality").isNull())
