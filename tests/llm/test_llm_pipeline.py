"""The pipeline's stages, each on its own input, and the queries against their SQL."""

import os

import duckdb
import pytest

import corpus_pipeline
from quayside.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rel = duck.sql(catalog.ORACLES[name])
    cols = sorted(rel.columns)
    assert cols == sorted(df.columns)
    at = [rel.columns.index(c) for c in cols]
    expected = sorted(repr(tuple(r[k] for k in at)) for r in rel.fetchall())
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == expected


def test_one_query_an_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 14))


def test_stages_follow_their_operators(spark, duck, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "byte_bpe":
            assert out.schema.simpleString() == docs.schema.simpleString()
        folder = os.path.join(tmp_dir, name)
        out.write.parquet(folder)
        docs = spark.read.parquet(folder)
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    kept = duck.sql(f"SELECT doc_id FROM ({catalog.ORACLES['op3_quality_rules']}) WHERE kept")
    assert ids["quality_rules"] == sorted(r[0] for r in kept.fetchall())
    clean = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({catalog.ORACLES['op1_winnow_decontamination']}) "
                                    "WHERE NOT contaminated").fetchall()}
    assert ids["decontamination"] == [d for d in ids["near_duplicates"] if d in clean]
    assert ids["byte_bpe"] == ids["secret_masking"] == ids["decontamination"]
    assert corpus_pipeline.run(spark, SF).count() == len(ids["byte_bpe"])


def test_stages_take_odd_rows(spark):
    good = " ".join(f"the word{k} of the text{k} is on" for k in range(40))
    rows = [(1, good, "en", "s", 1), (None, good + " token=abcdef123", None, None, None),
            (2, None, "en", "s", 0), (2, "", "en", "s", 0), (3, good, "en", "s", 1)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, SF).collect()
