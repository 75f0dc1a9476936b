"""Every registered query against its DuckDB text on the smallest driver tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract
from dunlin import catalog
from dunlin.catalog import frames

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = catalog.QUERIES, catalog.oracle_texts()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


# neither nested-loop joins nor Python workers in any batch plan
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]
ORDERED = [
    "contact_frequency_exceptions", "message_threshold_exceptions", "letter_sequence_exceptions",
    "message_attribution", "last_touch", "click_detail", "response_curve", "fill_forward",
    "asof_matches", "neighbour_rows", "attempt_numbers", "running_sums", "days_since_previous",
    "reversal_matches", "percentiles_exclusive", "percentiles_inclusive", "score_deciles",
    "quartile_bands", "contact_percentiles", "target_encode_numeric",
]


def plain(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_large_keys_split(spark, duck, name):
    spark.conf.set("dunlin.hotKeyRows", "10")
    try:
        test_query(spark, duck, name)
    finally:
        spark.conf.unset("dunlin.hotKeyRows")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == sorted(df.columns)
    mismatched = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t) != types[c]}
    assert not mismatched
    order = sorted(names)
    left = sorted((tuple(plain(r[c]) for c in order) for r in got), key=repr)
    at = [names.index(c) for c in order]
    right = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert left == right


def test_entry(spark):
    assert contract.entry(spark).columns == ["user_id", "event_id", "ts", "days_1", "days_2", "days_3"]


def test_models_have_no_oracle_and_all_others_do():
    assert set(QUERIES) - set(ORACLES) == {"train_and_score", "score_pending"}


def test_every_outcome_of_a_message_occurs(spark):
    """Each branch of the outcome rules and both payment sources carry rows."""
    got = QUERIES["message_attribution"](spark, DATA).selectExpr(
        "sum(bounced)", "sum(whitelist_scrubbed)", "sum(optout_scrubbed)", "sum(invalid_scrubbed)", "sum(marked_as_spam)",
        "sum(optouts)", "sum(clicks)", "sum(if(crm = 5, payers, 0))", "sum(if(crm < 5, payers, 0))").first()
    assert all(n > 0 for n in got), got
    log = frames.msgs(spark, DATA)
    kinds = log.selectExpr("count_if(code = 13 and detail = 'Undeliverable')", "count_if(code = 13 and detail = 'Bad-Record')",
                           "count_if(code = 13 and detail = 'Opt-Out')", "count_if(code = 100)",
                           "count_if(code = 8 and detail <> 'Hard-Bounce' and value = 'Blocked' and vendor = 'V1')").first()
    assert all(n > 0 for n in kinds), kinds
