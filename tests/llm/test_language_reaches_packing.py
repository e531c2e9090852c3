"""The language that the pipeline finds decides with which texts a text is packed."""

import corpus_pipeline
from tidecast.llm import packing

WORDS = {"en": ["the", "house", "with", "three", "windows", "stands"], "de": ["das", "schöne", "Haus", "steht", "zwischen", "Bäumen"]}


def _docs(spark):
    rows = [(i, None if i >= 36 else lang, " ".join(WORDS[lang][(i + k) % 6] for k in range(12))) for i in range(40) for lang in [("en", "de")[i % 2]]]
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string")


def test_language_stage_names_the_language(spark):
    out = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, _docs(spark), "").collect()}
    assert out == {i: ("en", "de")[i % 2] for i in range(40)}


def test_batches_hold_one_language(spark):
    found = corpus_pipeline.pack(spark, corpus_pipeline.language(spark, _docs(spark), ""), "").collect()
    assert len(found) == 40 and {r.lang for r in found} == {"en", "de"}
    assert len({(r.lang, r.bucket, r.batch_id, r.slot) for r in found}) == 40
    assert all(r.lang == ("en", "de")[r.doc_id % 2] for r in found)


def test_pack_without_group_is_unchanged(spark):
    found = packing.pack(_docs(spark))
    assert found.columns[-1] == "batch_size"
    assert len({(r.bucket, r.batch_id, r.slot) for r in found.collect()}) == 40
