"""The bounded sieve before text shuffles, and the pipeline on odd rows: null
and repeated ids, null, empty and long texts, repeated rows, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_brute import brute_links, collapsed
from tidecast.llm import common, exact_dedup, ngram_join, packing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _prose(word, n):
    """n sentences without repeated passages."""
    pick = random.Random(word)
    nouns, verbs = "house road teacher letter garden window story winter market friend doctor village".split(), "saw found left wrote made took heard kept".split()
    line = lambda i: f"The {word} {i} and the {pick.choice(nouns)} {pick.choice(verbs)} a {pick.choice(nouns)} {i} of {pick.choice(nouns)}, but {i} {pick.choice(verbs)} the {pick.choice(nouns)}."
    return " ".join(line(i) for i in range(n))


def _odd(spark, where):
    rows = [(1, _prose("river", 12)), (2, _prose("river", 12)), (2, _prose("river", 12)), (2, _prose("castle", 9)), (3, None), (4, ""),
            (None, _prose("market", 8)), (None, _prose("market", 8)), (None, _prose("garden", 10)), (5, " \t\n" + _prose("garden", 10).replace(" ", "  ")),
            (6, _prose("bridge", 900)), (6, _prose("bridge", 900)), (7, _prose("bridge", 899) + " The end was a quiet one."), (8, "½ ² ①"), (9, "word")]
    docs = spark.createDataFrame([(i, t, "en" if i != 9 else None, "hot", None if t is None else len(t)) for i, t in rows], SCHEMA)
    for c in ("keep_id", "key", "size", "sieve", "fp", "gone", "rep_id"):
        docs = docs.withColumn(c, F.lit("mine"))
    docs.write.parquet(f"{where}/documents.parquet")
    return spark.read.parquet(f"{where}/documents.parquet")


def test_sieve_lets_every_member_through_and_few_others(spark):
    inside, every = spark.range(0, 3000, 3), spark.range(3000)
    table = common.sieve(inside, F.col("id"))
    assert table.count() <= min(1000, common.SIEVE_SLOTS)
    through = {r.id for r in common.sifted(every, F.col("id"), table).collect()}
    assert through >= set(range(0, 3000, 3)) and len(through) < 1050
    out = {r.id for r in common.sifted(every, F.col("id"), table, inside=False).collect()}
    assert out == set(range(3000)) - through
    assert common.sifted(every, F.col("id"), common.sieve(inside.limit(0), F.col("id"))).count() == 0


@pytest.mark.parametrize("slots", [1, 1 << 20])
def test_full_sieve_changes_no_result(spark, tmp_path, monkeypatch, slots):
    monkeypatch.setattr(common, "SIEVE_SLOTS", slots)
    docs = _odd(spark, tmp_path)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sizes = {}
    for _, t in rows:
        sizes[collapsed(t)] = sizes.get(collapsed(t), 0) + 1
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted(r.group_size for r in got) == sorted(sizes[collapsed(t)] for _, t in rows)
    assert sum(r.kept for r in got) == len(sizes)
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(collapsed(r.text) for r in left.collect()) == sorted(sizes)
    # Near copies: of every class of linked texts one row stays.
    known = [(i, t) for i, t in enumerate(sorted(sizes))]
    classes = {c for (i, t), (_, c, _) in zip(known, brute_links(known)) if t.strip()}
    near = ngram_join.drop_near_copies(left)
    assert near.columns == docs.columns
    assert sum(1 for r in near.collect() if collapsed(r.text).strip()) == len(classes)


def test_pipeline_on_odd_rows(spark, tmp_path):
    docs = _odd(spark, tmp_path)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # One row stays of each clean text; 6 and 7 are near copies; the rest is no prose.
    clean = {"river", "castle", "market", "garden", "bridge"}
    texts = {}
    for r in docs.collect():
        for name in clean:
            if r.text and f"The {name} " in collapsed(r.text):
                texts.setdefault(name, (r.doc_id, len(r.text.split())))
    n = sum(min(packing.CONTEXT, size - p * packing.CONTEXT) for _, size in texts.values() for p in range(-(-size // packing.CONTEXT)))
    assert abs(sum(r.n_tokens for r in out) - n) <= 20
    assert {r.doc_id for r in out} >= {1, 2, 6, None} and not {3, 4, 8, 9} & {r.doc_id for r in out}


def test_pipeline_stages_on_null_columns(spark, tmp_path):
    empty = spark.createDataFrame([(None,) * 5, (None,) * 5], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, str(tmp_path)).columns == empty.columns, name
    assert packing.pack(empty).collect() == []
