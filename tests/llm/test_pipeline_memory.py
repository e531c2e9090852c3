"""Batches and arrays of the pipeline's Python steps are bounded in bytes,
whatever the number and length of the texts; results don't depend on it."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidecast.llm import langid, ngram_join, quality_lines

LIMITS = [f"spark.sql.execution.arrow.{key}" for key in ("maxRecordsPerBatch", "maxBytesPerBatch")]
EN, FR = "the house and the garden of my old friend", "la maison et le jardin de mon vieil ami"
STEPS = {
    "quality": quality_lines.keep_good,
    "language": lambda docs: langid.keep_identified(docs, langid.fit([EN * 3, FR * 3], ["en", "fr"])),
    "near": ngram_join.drop_near_copies,
}


@pytest.fixture
def limits(spark):
    """The session without limits of its own; as it was afterwards."""
    was = {k: spark.conf.get(k, None) for k in LIMITS}
    for k in LIMITS:
        spark.conf.unset(k)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def batches(docs):
    """Rows and bytes of the batches that Python gets."""
    def sizes(found):
        for b in found:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    return docs.mapInArrow(sizes, "n bigint, size bigint").collect()


@pytest.mark.parametrize("name", STEPS)
def test_batches_are_bounded_in_rows_and_bytes(spark, limits, name):
    few = spark.createDataFrame([(i, f"{EN} {i}.") for i in range(3)], "doc_id bigint, text string")
    rows, texts = spark.range(3000, numPartitions=1), spark.range(300, numPartitions=1).selectExpr("id", "repeat('a word ', 8000) as text")
    assert max(b.n for b in batches(rows)) > 1000 and max(b.size for b in batches(texts)) > 12e6
    STEPS[name](few)
    assert max(b.n for b in batches(rows)) <= 1000 and sum(b.n for b in batches(rows)) == 3000
    assert max(b.size for b in batches(texts)) < 5e6 and sum(b.n for b in batches(texts)) == 300


def test_a_limit_of_the_session_stays(spark, limits):
    spark.conf.set(LIMITS[0], "77")
    quality_lines.keep_good(spark.createDataFrame([(1, EN)], "doc_id bigint, text string"))
    assert max(b.n for b in batches(spark.range(1000, numPartitions=1))) == 77


def some_texts():
    rng = np.random.default_rng(3)
    return [" ".join(f"w{k}" for k in rng.integers(0, 400, 1 + i % 9 * 400)) for i in range(400)]


@pytest.mark.parametrize("step", [lambda t: quality_lines.repeated_words([x.encode() for x in t]), lambda t: [b for _, b, _, _ in ngram_join.gram_sets(t, 5)]])
def test_arrays_of_hashes_are_bounded(step):
    texts = some_texts()
    assert sum(map(len, texts)) > 2e6
    step(texts[:2])
    tracemalloc.start()
    step(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6


def test_hashes_do_not_depend_on_the_chunks(monkeypatch):
    texts = [*some_texts()[:60], "", "one", "a b c d e f g h " * 3]

    def found():
        words = quality_lines.repeated_words([t.encode() for t in texts])
        sets = [grams[at[d]:at[d + 1]].tolist() for a, b, grams, at in ngram_join.gram_sets(texts, 5) for d in range(b - a)]
        return words.tolist(), sets

    few = found()
    for module in (quality_lines, ngram_join):
        monkeypatch.setattr(module, "CHUNK_BYTES", 1 << 24)
    assert found() == few
