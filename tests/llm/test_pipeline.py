"""The pipeline's decisions on a small table, and that queries match their SQL on the smallest one."""

import duckdb
import pytest

import corpus_pipeline
from dunlin.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_drop_what_they_should(spark, tmp_path):
    insult = "grobnik"
    clean = [" ".join(f"word{(k * 37 + j * 11) % 997}" for j in range(60)) for k in range(40)]
    texts = {k: t for k, t in enumerate(clean)}
    texts |= {100 + k: f"{insult} {t}" if k % 2 else t.replace("word", insult + " ", 3) for k, t in enumerate(reversed(clean))}
    texts |= {200: clean[0].replace(" ", "  "), 201: clean[1] + " extra", 202: "write to someone@example.org now", 203: None, 204: ""}
    rows = [(i, t, "en", "s", len(t or ""), None) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(100 <= i < 200)) for i in texts if i < 200]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        step(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == now.columns
        now, kept[name] = after, {r.doc_id: r.text for r in after.collect()}
    assert set(kept["toxicity"]) == {i for i in texts if not 100 <= i < 200}
    assert set(kept["toxicity"]) - set(kept["exact_dedup"]) == {200, 204}
    assert set(kept["exact_dedup"]) - set(kept["ngram_jaccard"]) == {201}
    assert kept["personal_data"][202] == "write to <EMAIL> now" and kept["personal_data"][203] is None
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(kept["personal_data"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = ", ".join(sorted(df.columns))
    plain = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    want = sorted(map(plain, con.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall()))
    assert sorted(plain(r) for r in df.select(*sorted(df.columns)).collect()) == want
