"""Operator 11: lines that repeat across documents, as keep bitmaps.

DataFrame functions only. Every line becomes a 128-bit hash of its key with
its document and position. The hashes are range-partitioned with document as
secondary key, so a line that holds a third of all rows is spread over many
partitions, sorted by position, and streamed once: the first occurrence of a
line in its document counts that document, every occurrence stays with its
position. A line that crosses partitions is the first or last hash of some
range, so at most two rows a partition correct the counts. What comes out is a
run-length bitmap for each document; text is read again only to apply it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import BLANKS, store

MIN_DOCS = 10
MIN_CHARS = 1


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() alone is right, and fast, where every character is ASCII.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, print): a document is known by its id and the hash of its
    text, so rows that share an id are told apart."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"))


def _occurrences(base: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, print, pos) of every line that is long enough."""
    lines = base.select("doc_id", "print", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "print", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "print", "pos")


def line_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, print, pos, n_docs, first): every line long enough,
    the number of documents (rows of ``docs``) that hold it, and whether it is
    the line's first occurrence in the order of doc_id (null first), text hash
    and position. Rows equal in id and text are documents of their own and
    share their occurrences' order."""
    base = _identified(docs, id_col, text_col)
    key, document = ["h1", "h2"], ["h1", "h2", "doc_id", "print"]
    # Range partitions by hash and document also cluster by them: the window
    # sorts each partition in place.
    ranged = _occurrences(base, min_chars).repartitionByRange(*document)
    rank = F.rank().over(Window.partitionBy(*document).orderBy("pos"))
    ranged = store(ranged.select(*document, "pos", (rank == 1).alias("opens"), F.spark_partition_id().alias("pid")), "lines")
    inside = Window.partitionBy("pid", *key)
    counted = ranged.withColumns({"here": F.sum(F.col("opens").cast("bigint")).over(inside),
                                  "lead": F.min(F.struct("doc_id", "print", "pos")).over(inside)})
    # A line in several ranges ends one and starts the next.
    ends = ranged.groupBy("pid").agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"))
    edge = ends.select(F.explode(F.array("low", "high")).alias("k")).select("k.*").distinct()
    across = (ranged.join(F.broadcast(edge), key, "left_semi").groupBy(*key)
              .agg(F.sum(F.col("opens").cast("bigint")).alias("all"), F.min(F.struct("doc_id", "print", "pos")).alias("start")))
    found = counted.join(F.broadcast(across), key, "left")
    lead = F.coalesce("start", "lead")
    return found.select(*document, "pos", F.coalesce("all", "here").alias("n_docs"),
                        (F.struct("doc_id", "print", "pos") == lead).alias("first"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """(doc_id, print, n_dropped, runs) of each document that loses lines:
    those found in at least ``min_docs`` documents, or with ``keep_first`` all
    of them but the first occurrence. ``runs`` is the compressed bitmap:
    lengths of runs of lines, kept and dropped in turn, starting with kept; the
    lines after the last run are kept. Documents that lose none have no row; no
    rows give no rows; null texts are one empty line."""
    hit = line_occurrences(docs, id_col, text_col, min_chars).where(F.col("n_docs") >= min_docs)
    if keep_first:
        hit = hit.where(~F.col("first"))
    gone = hit.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    before = F.filter("at", lambda x, i: (i == 0) | (F.get(F.col("at"), i - 1) != x - 1))
    after = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get(F.col("at"), i + 1) != x + 1))
    spans = gone.select("doc_id", "print", F.size("at").cast("bigint").alias("n_dropped"), before.alias("starts"), after.alias("ends"))
    kept = F.zip_with("starts", F.concat(F.array(F.lit(-1)), F.slice("ends", F.lit(1), F.size("ends") - 1)), lambda a, b: a - b - 1)
    dropped = F.zip_with("starts", "ends", lambda a, b: b - a + 1)
    runs = F.flatten(F.zip_with(kept, dropped, lambda k, d: F.array(k, d)))
    return spans.select("doc_id", "print", "n_dropped", runs.alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The lines that a bitmap keeps, joined by line feeds."""
    lines = F.split(text, "\n", -1)
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    # Beyond the last run flags are null: kept.
    marked = F.zip_with(lines, flags, lambda line, keep: F.when(F.coalesce(keep, F.lit(True)), line))
    return F.when(runs.isNull(), text).otherwise(F.array_join(F.filter(marked, lambda x: x.isNotNull()), "\n"))


def without_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): one row for each row of ``docs``, its
    text without the dropped lines. Null or empty text is one empty line; other
    columns are ignored."""
    base = _identified(docs, id_col, text_col)
    maps = keep_bitmaps(docs, id_col, text_col, **rules).select(F.col("doc_id").alias("of_id"), F.col("print").alias("of_print"), "n_dropped", "runs")
    both = base.join(maps, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("print") == F.col("of_print")), "left")
    return both.select("doc_id", F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), kept_text(F.col("text"), F.col("runs")).alias("kept"))
