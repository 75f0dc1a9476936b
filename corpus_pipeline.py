"""A training-corpus pipeline over ``documents``: toxic documents go, then exact copies, then
all but one of each group of near copies; personal data is masked, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` and the check tool write
it as Parquet and read it back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dunlin.llm import digest_index, jaccard_join, packing, pii, queries, toxicity
from dunlin.llm.common import let_workers_import, sized, stage

#: Stages without a SQL form (ordinal regression, tokens): tests compare with brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``docs`` less the rows whose ``key`` is in ``dropped``; columns as they were."""
    gone = stage(dropped.select(F.col(dropped.columns[0]).alias("__gone")), "dropped")
    return docs.join(sized(gone), F.col(key) == F.col("__gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject. NULL and empty texts stay."""
    let_workers_import(spark)
    model = queries.toxicity_model(spark, sf_dir)
    return docs.where(~toxicity.toxic_column(model, F.col("text")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space the row with the smallest doc_id; of repeated rows one.
    ``docs`` must come from files, so that its rows keep their numbers."""
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    found = digest_index.exact_dedup(docs)
    return _without(numbered, found.where("not kept").select("row"), "__row").drop("__row")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id. Rows without a
    doc_id or words stay."""
    let_workers_import(spark)
    found = jaccard_join.near_duplicates(docs)
    return _without(docs, found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind and ``n_chars`` counted anew."""
    let_workers_import(spark)
    out = docs.withColumn("text", pii.redact_column(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    let_workers_import(spark)
    return packing.pack(docs, packing.read_ranks(queries.RANKS), queries.public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
