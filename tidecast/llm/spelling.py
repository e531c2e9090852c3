"""Operator 12: spelling variants by permuterm rotations.

Every word, closed by a terminator, is rotated to every position. Two words
that differ by one replaced character share the rotation that ends with it, up
to that character; a word with one character less is the whole of that prefix.
So sorted rotations put near words into one range, whose rows end in different
characters: a group is never larger than the alphabet. A rotation travels as a
124-bit print of its prefix with its last character, so long words cost their
length and not its square, and a word as its rank in code-point order.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import store

MIN_CHARS = 7
MIN_COUNT = 2
FACTOR = 10
LETTERS = "A-Za-zÀ-ÿ"

# Two pairs of primes and bases; the terminator is a code point no word has.
_PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], dtype=np.uint64)
_BASES = np.array([1103515245, 1664525, 69069001, 214013017], dtype=np.uint64)
_END = np.uint64(36)
_ROWS = 1 << 18  # rotations made at a time


# -- words -------------------------------------------------------------------

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, letters: str = LETTERS, noise: int | None = 31) -> DataFrame:
    """(rank, word, n): distinct words in code-point order with their counts.
    Runs of letters, A-Z in lower case; where ``noise`` divides the crc32 of
    ``<doc_id>:<run>`` the run loses one character (null ids print as
    nothing). Null texts have no words."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{letters}]{{{min_chars},}}"), F.lit(0))
    each = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text")).select("id", F.explode(runs).alias("run"))
    # lower() is right unless a letter beyond A-Z has a lower case.
    run = F.when(F.col("run").rlike("[^a-zA-Zß-ÿ]"), F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower("run"))
    each = each.select("id", run.alias("run"))
    if noise:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
        each = each.select("run", h.alias("h"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        each = each.select(F.when(F.col("h") % noise == 0, short).otherwise(F.col("run")).alias("run"))
    counts = each.where(F.char_length("run") >= min_chars).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    kept = counts.where(F.col("n") >= min_count).repartitionByRange("word").sortWithinPartitions("word")
    # Ranges and the order inside them are those of the words, so the ids rise with them; written once, they are fixed.
    return store(kept.select(F.monotonically_increasing_id().alias("rank"), "word", "n"), "words")


# -- rotations ---------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, a row for each prime."""
    up, down = np.ones((4, n), dtype=np.uint64), np.ones((4, n), dtype=np.uint64)
    for k in range(4):
        p = int(_PRIMES[k])
        for table, b in ((up[k], int(_BASES[k])), (down[k], pow(int(_BASES[k]), -1, p))):
            have = 1
            while have < n:  # doubling
                more = min(have, n - have)
                table[have:have + more] = table[:more] * np.uint64(pow(b, have, p)) % np.uint64(p)
                have += more
    return up, down


def rotation_prints(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, k1, k2, last) of all rotations. ``last`` > 0: the print is of the
    rotation without its last character, which is ``last``; its sign bit apart,
    bit 24 marks the first of a run of equal characters. ``last`` = 0: the print
    is of the whole rotation."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    j = np.arange(len(chars)) - start[owner]
    up, down = _powers(int(size.max(initial=0)) + 3)
    splits = np.repeat(np.arange(len(words)), size + 1)
    at = np.arange(len(splits)) - (start + np.arange(len(words)))[splits]
    cut, whole = [], []
    for k in range(4):
        p = _PRIMES[k]
        sums = np.zeros(len(chars) + 1, dtype=np.uint64)
        np.cumsum(chars * up[k][j] % p, out=sums[1:])

        def between(a, b):
            return (sums[b] - sums[a]) % p

        def rotated(tail, head, shift, rest):
            """tail, terminator, head: tail has ``rest`` characters and started ``shift`` places on."""
            return (tail * down[k][shift] + _END * up[k][rest] % p + head * up[k][rest + 1]) % p

        i, n = np.arange(len(chars)), size[owner]
        cut.append(rotated(between(i + 1, start[owner] + n), between(start[owner], i), j + 1, n - j - 1))
        here, n = start[splits] + at, size[splits]
        whole.append(rotated(between(here, start[splits] + n), between(start[splits], here), at, n - at))
    opens = np.ones(len(chars), dtype=bool)
    opens[1:] = (chars[1:] != chars[:-1]) | (j[1:] == 0)
    last = chars.astype(np.int64) | (opens.astype(np.int64) << 24)
    keys = [np.concatenate([(cut[a] << np.uint64(31)) | cut[a + 1], (whole[a] << np.uint64(31)) | whole[a + 1]]).view(np.int64) for a in (0, 2)]
    return np.concatenate([owner, splits]), keys[0], keys[1], np.concatenate([last, np.zeros(len(splits), dtype=np.int64)])


def rotations(words: DataFrame) -> DataFrame:
    """(k1, k2, last, rank, n): all rotations of (rank, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, text, counts = (batch.column(c) for c in range(3))
            ranks, counts, text = ranks.to_numpy(), counts.to_numpy(), text.to_pylist()
            ends = np.cumsum([2 * len(w) + 1 for w in text])
            cuts = [0, *(np.flatnonzero(np.diff(ends // _ROWS)) + 1).tolist(), len(text)]
            for a, b in zip(cuts, cuts[1:]):
                owner, k1, k2, last = rotation_prints(text[a:b])
                for s in range(0, len(owner), _ROWS):
                    o = owner[s:s + _ROWS] + a
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1[s:s + _ROWS], k2[s:s + _ROWS], last[s:s + _ROWS].astype(np.int32), ranks[o], counts[o])],
                                                     ["k1", "k2", "last", "rank", "n"])

    return words.select("rank", "word", "n").mapInArrow(run, "k1 bigint, k2 bigint, last int, rank bigint, n bigint")


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows."""
    change = np.ones(len(columns[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(change)


def group_links(k1, k2, last, rank, n) -> tuple[np.ndarray, ...]:
    """Rows sorted by print: (rank, n_near, best_n, best) of each row that has
    a near word in its group; ``best`` is the one of largest n, then least rank.
    Linear in the rows: the best two of a group answer for all its rows."""
    start = _runs(k1, k2)
    size = np.diff(np.append(start, len(k1)))
    keep = np.repeat(size > 1, size)
    last, rank, n = last[keep], rank[keep], n[keep]
    size = size[size > 1]
    if not len(size):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    group = np.repeat(np.arange(len(size)), size)
    whole, opens = last == 0, last >= 1 << 24
    n_cut = np.bincount(group, ~whole, len(size)).astype(np.int64)
    n_open = np.bincount(group, opens, len(size)).astype(np.int64)

    def top(rows, place):
        """Row number of the best (0) or second (1) of ``rows`` in each group, -1 if none."""
        at = np.flatnonzero(rows)
        order = at[np.lexsort((rank[at], -n[at], group[at]))]
        first = _runs(group[order]) if len(order) else order
        count = np.diff(np.append(first, len(order)))
        out = np.full(len(size), -1)
        has = count > place
        out[group[order[first[has]]]] = order[first[has] + place]
        return out

    one, two, open_one, base = top(~whole, 0), top(~whole, 1), top(opens, 0), top(whole, 0)
    me = np.arange(len(group))
    replaced = np.where(one[group] == me, two[group], one[group])
    shorter = np.where(opens, base[group], -1)
    near = np.where(whole, n_open[group], n_cut[group] - 1 + (shorter >= 0))

    def better(a, b):
        take_b = (a < 0) | ((b >= 0) & ((n[b] > n[a]) | ((n[b] == n[a]) & (rank[b] < rank[a]))))
        return np.where(take_b, b, a)

    best = np.where(whole, open_one[group], better(replaced, shorter))
    hit = near > 0
    return rank[hit], near[hit].astype(np.int64), n[best[hit]], rank[best[hit]]


def near_words(words: DataFrame) -> DataFrame:
    """(rank, n_near, best_n, best) of each word with a near word; ``best`` is
    the rank of its near word of largest n (ties: smallest word)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64)] * 5

        def links(columns):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in group_links(*columns)], ["rank", "n_near", "best_n", "best"])

        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for c, h in enumerate(held)]
            if len(held[0]) >= _ROWS:
                cut = _runs(held[0], held[1])[-1]  # the last group may go on
                yield links([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(held)

    ordered = rotations(words).repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    found = ordered.mapInArrow(scan, "rank bigint, n_near bigint, best_n bigint, best bigint")
    top = F.max(F.struct("best_n", (-F.col("best")).alias("low")))
    return (found.groupBy("rank").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("rank", "n_near", F.col("top.best_n").alias("best_n"), (-F.col("top.low")).alias("best")))


# -- forms -------------------------------------------------------------------

def _follow(links: DataFrame, factor: int) -> DataFrame:
    """(rank, root) of links (rank, root): every chain to its end. Counts grow
    by ``factor`` (2 at least) a step, so a chain has at most 63 steps and
    halving it at most 6 times ends it."""
    steps, reach = 63 // (factor.bit_length() - 1), 1
    while reach < steps:
        far = links.select(F.col("rank").alias("mid"), F.col("root").alias("far"))
        links = links.join(far, links["root"] == far["mid"], "left").select("rank", F.coalesce("far", "root").alias("root"))
        links, reach = store(links, "chains"), 2 * reach
    return links


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR, **rules) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (``word_counts``).
    form: the near word (one character inserted, deleted or replaced) of
    largest n, ties smallest in code-point order, if that is at least
    ``factor`` times n, else null with form_n; root: the end of the chain of
    forms, the word itself if it has none. Repeated rows count as often as they
    occur; other columns are ignored; no rows give no rows."""
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    words = word_counts(docs, id_col, text_col, **rules)
    near = store(words.join(near_words(words), "rank", "left"), "near")
    has = F.col("best_n") >= factor * F.col("n")
    chains = _follow(store(near.where(has).select("rank", F.col("best").alias("root")), "chains"), factor)
    named = lambda a, b: words.select(F.col("rank").alias(a), F.col("word").alias(b))
    ends = (near.where(has).select("rank", "best").join(chains, "rank")
            .join(named("best", "form"), "best").join(named("root", "root_word"), "root").select("rank", "form", "root_word"))
    out = near.join(ends, "rank", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                      F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
