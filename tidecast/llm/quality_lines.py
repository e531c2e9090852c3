"""Line-first quality rules.

Each line is judged by itself: terminal punctuation, navigation separators,
boilerplate (symbols, shouting, known phrases). Wrapped lines count as one for
punctuation: a line of five words or more that has no end mark and is followed
by a line that starts with a small letter goes on there. A known phrase costs
its sentence. Failing lines and sentences are removed, then documents that
lost too much of their text are rejected, as are those that fail the base
rules on length and repetition.

Rows are independent: no shuffle; memory is bounded by one Arrow batch.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm import textvec
from tidecast.llm.common import BLANKS, CHUNK_BYTES, chunks, map_arrow, small_batches

#: Fixed values of the rules; the SQL twin in queries.py states them again.
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
MAX_LOST_PCT = 50
MAX_SEPARATOR_PCT = 10
MAX_SYMBOL_PCT = 30
MAX_SHOUT_PCT = 50
WRAPPED_WORDS = 5
#: Rows of an Arrow batch whose texts are Python strings at a time.
JUDGED_ROWS = 1000
#: Sentence marks of scripts that put no blank after them (CJK, Devanagari, Arabic).
OWN_MARKS = "।॥。！？؟۔"
ENDS = re.compile(rf"""[.!?…:;"')\]»”{OWN_MARKS}．；：」』】）》’][\x20\x09-\x0D]*$""")
SENTENCE = re.compile(rf"[.!?][\x20\x09-\x0D]|[{OWN_MARKS}]")
PIECE = re.compile(rf"[^.!?{OWN_MARKS}]+[.!?{OWN_MARKS}]*|[.!?{OWN_MARKS}]+")
GOES_ON = re.compile(r"[\x20\x09-\x0D]*[a-zß-öø-ÿ]")
SEPARATOR = re.compile(r"(?:^|[\x20\x09-\x0D])[|>»•·]")
SYMBOL_WORD = re.compile(r"[#*$%&|<>][^\x20\x09-\x0D]*")
SHOUT_WORD = re.compile(r"[A-ZÀ-ÖØ-Þ]{2}[^\x20\x09-\x0D]*")
PHRASES = re.compile(r"(?i)lorem ipsum|javascript|cookie policy|privacy policy|terms of use|terms of service"
                     r"|all rights reserved|click here|read more|sign up|log in|[{}]")

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, n_lost_words bigint, base_failed boolean, kept boolean")


def line_fails(line: str, n_words: int, marked: bool | None = None) -> str | None:
    """The rule that a line with ``n_words`` words fails as a whole, or None;
    ``marked``: whether it, or a line that it is wrapped with, has a sentence mark."""
    if not (has_mark(line) if marked is None else marked):
        return "punctuation"
    if 100 * len(SEPARATOR.findall(line)) > MAX_SEPARATOR_PCT * n_words:
        return "navigation"
    if (100 * len(SYMBOL_WORD.findall(line)) > MAX_SYMBOL_PCT * n_words
            or 100 * len(SHOUT_WORD.findall(line)) > MAX_SHOUT_PCT * n_words):
        return "boilerplate"
    return None


def has_mark(line: str) -> bool:
    return bool(ENDS.search(line) or SENTENCE.search(line))


def _count(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass").split())


def without_phrases(line: str, n_words: int) -> tuple[str, int]:
    """The line without the sentences that hold a known phrase, and their words."""
    if not PHRASES.search(line):
        return line, 0
    pieces = PIECE.findall(line)
    hit = [bool(PHRASES.search(p)) for p in pieces]
    return "".join(p for p, h in zip(pieces, hit) if not h), min(n_words, sum(_count(p) for p, h in zip(pieces, hit) if h))


def _marked(lines: list[str], counts: list[int]) -> list[bool]:
    """Whether each line, with those it is wrapped with, has a sentence mark."""
    out = [n > 0 and has_mark(line) for line, n in zip(lines, counts)]
    first = 0  # of the wrapped lines so far
    for i, (line, n) in enumerate(zip(lines, counts)):
        if n >= WRAPPED_WORDS and i + 1 < len(lines) and counts[i + 1] and GOES_ON.match(lines[i + 1]) and not ENDS.search(line):
            continue
        if i > first:
            out[first:i + 1] = [any(out[first:i + 1])] * (i + 1 - first)
        first = i + 1
    return out


def clean(text: str | None) -> tuple[str, int, int, int]:
    """Text without failing lines and sentences, its words, the words removed,
    and the number of lines with a word that equal an earlier line."""
    good, words, lost, copies, seen = [], 0, 0, 0, set()
    lines = (text or "").split("\n")
    counts = [_count(line) for line in lines]
    for line, n, marked in zip(lines, counts, _marked(lines, counts)):
        if not n:
            good.append(line)
            continue
        words += n
        copies += line in seen
        seen.add(line)
        if line_fails(line, n, marked):
            lost += n
            continue
        line, gone = without_phrases(line, n)
        lost += gone
        if gone < n:
            good.append(line)
    return "\n".join(good), words, lost, copies


def repeated_words(texts: list[bytes]) -> np.ndarray:
    """Words of each text inside a window of 8 words that it holds twice."""
    out = np.zeros(len(texts), dtype=np.int64)
    for a, b in chunks([len(t) for t in texts], CHUNK_BYTES):
        w = textvec.words(texts[a:b])
        grams = textvec.windows(w.hashes, REPEAT_WINDOW)
        if not len(grams):
            continue
        doc = np.repeat(np.arange(b - a), np.diff(w.offsets))
        inside = doc[: len(grams)] == doc[REPEAT_WINDOW - 1:]
        key = textvec.mix(grams + doc[: len(grams)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ranked = np.sort(key[inside])
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        if not len(twice):
            continue
        spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = np.flatnonzero((twice[spot] == key) & inside)
        cover = np.zeros(len(doc) + 1, dtype=np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + REPEAT_WINDOW, -1)
        out[a:b] = np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=b - a)
    return out


def judge(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Counts and verdict of every text."""
    n = len(texts)
    out = {k: np.zeros(n, dtype=np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lost_words")}
    for i, text in enumerate(texts):
        if not text:
            continue
        _, out["n_words"][i], out["n_lost_words"][i], out["n_dup_lines"][i] = clean(text)
        out["word_chars"][i] = len(text) - sum(map(text.count, BLANKS))
        out["n_symbols"][i] = sum(map(text.count, SYMBOLS))
    out["n_repeat_words"] = repeated_words([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PCT * out["n_words"])
    out["kept"] = ~out["base_failed"] & (100 * out["n_lost_words"] <= MAX_LOST_PCT * out["n_words"])
    return out


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs`` (repeated rows and null ids too): its
    counts, base_failed and kept. Null or empty texts have no words and fail
    the base rules. Other columns are ignored; no rows give no rows."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(found[k]) for k in names[1:])], names)

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, SCHEMA)


def cleaned_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and clean_text: the text without the lines that fail a rule
    (null for a null text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [None if t is None else clean(t)[0] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(text, pa.string())], ["doc_id", "clean_text"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id bigint, clean_text string")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the documents that are rejected."""
    at = docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, kept = batch.column(at), [np.zeros(0, dtype=bool)]
        for first in range(0, batch.num_rows, JUDGED_ROWS):  # so few of them are Python strings at a time
            kept.append(judge(texts.slice(first, JUDGED_ROWS).to_pylist())["kept"])
        return batch.filter(pa.array(np.concatenate(kept)))

    return map_arrow(docs, run, docs.schema)
