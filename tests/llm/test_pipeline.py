"""The corpus pipeline against a brute-force version, and the SQL twins."""

import pytest

import corpus_pipeline
from llm_brute import brute_links, collapsed
from tidecast.llm import langid, packing, quality_lines, queries
from tidecast.plans.verify import compare, duckdb_conn

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, key):
    found = compare(queries.QUERIES[key](spark, SF), queries.SQL[key], duckdb_conn(SF))
    assert found["match"], found


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = [r for r, kept in zip(rows, quality_lines.judge([t for _, t in rows])["kept"]) if kept]
    good = spark.createDataFrame(rows, "doc_id bigint, text string").join(docs.select("doc_id", "lang"), "doc_id")
    tagger = langid.Tagger(langid.train(good))
    rows = [r for r, lang in zip(rows, tagger.predict([t for _, t in rows])[0]) if lang != "und"]
    first = {}
    rows = [r for r in rows if first.setdefault(collapsed(r[1]), r[0]) == r[0]]
    rows = [r for r, (i, c, _) in zip(rows, brute_links(rows)) if i == c]
    want = sorted((i, p, min(packing.CONTEXT, n - p * packing.CONTEXT)) for i, t in rows for n in [len(t.encode().split())] for p in range(-(-n // packing.CONTEXT)))
    got = sorted((r.doc_id, r.part, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
