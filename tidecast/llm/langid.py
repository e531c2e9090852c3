"""Language identification by a linear-chain conditional random field.

Each word of a text is labelled with a language. Emissions add the weights of
affix, character n-gram and lexicon features of the word; learned transitions
couple neighbouring words; forward-backward gives the marginals, whose mean
over the words with letters names the language of the text.

Training reads a bounded sample of labelled texts (``MAX_TRAIN_DOCS``, whole
texts): their words are cut into segments, segments of all languages are
strung into code-switched sequences, and the weights follow the gradient of
the conditional likelihood. One task fits them; the model (a few MB, bounded
by the hash size) is broadcast. Prediction is independent for each row.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import regex
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import paused_gc, small_batches

#: Labelled texts that training reads at most, spread over the languages.
MAX_TRAIN_DOCS = 480
#: Hashed weights of affix and n-gram features; words met three times in the sample have one of their own.
HASH_BITS = 16
#: Bytes of prefixes and suffixes, with the edge mark.
AFFIXES = (4, 5, 6)
SEQUENCE = 96
ITERATIONS = 25
#: Word types a worker keeps before it starts anew.
MAX_WORDS = 300_000
#: Characters of texts that step together; a worker's arrays follow it.
STEP_CHARS = 500_000
UNKNOWN = "und"
_NO_LETTER = regex.compile(r"^\P{L}+|\P{L}+$")


def word_core(word: str) -> str:
    """Lower-cased word without leading and trailing non-letters."""
    core = word.lower()
    return core if core.isalpha() else _NO_LETTER.sub("", core)


def features(cores: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed features of words (each with a letter), as parts (features in
    word order, first feature of each word, the words that have some): all
    byte 2- and 3-grams of the word with its edges, prefixes and suffixes."""
    data = [b"^" + c.encode("utf-8", "surrogatepass") + b"$" for c in cores]
    size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    end = np.cumsum(size)
    begin = end - size
    buf = np.frombuffer(b"".join(data) + bytes(8), dtype=np.uint8).astype(np.uint32)
    room = np.repeat(end, size) - np.arange(int(end[-1]) if len(end) else 0)  # bytes left in the word

    def hashed(at: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(at), n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ buf[at + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        return (h >> np.uint32(32 - HASH_BITS)).astype(np.int64)

    every = np.arange(len(cores))
    parts = []
    for n in (2, 3):
        count = size - n + 1
        parts.append((hashed(np.flatnonzero(room >= n), n), np.cumsum(count) - count, every))
    for n in AFFIXES:
        rows = np.flatnonzero(size >= n)
        parts.append((hashed(begin[rows], n), np.arange(len(rows)), rows))
        rows = np.flatnonzero(size > n)
        parts.append((hashed(end[rows] - n, n), np.arange(len(rows)), rows))
    return parts


def emissions(weight: np.ndarray, cores: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """Scores of words by the weights of their features."""
    score = np.zeros((len(cores), weight.shape[1]))
    for flat, first, rows in features(cores):
        if len(rows):
            score[rows] += np.add.reduceat(weight[flat], first)
    named = [(i, lexicon[c]) for i, c in enumerate(cores) if c in lexicon]
    if named:
        i, f = np.array(named).T
        score[i] += weight[f]
    return score


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Marginals of sequences stored one after another (``emit``: words x
    labels, positive). All sequences step together, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    offset = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    most = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, most + 1), side="right")
    alpha = np.empty_like(emit)
    for t in range(most):
        at = offset[: active[t]] + t
        a = (alpha[at - 1] @ trans if t else start[None, :]) * emit[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((len(size), emit.shape[1]), dtype=emit.dtype)
    for t in range(most - 1, -1, -1):
        n = active[t]
        at = offset[:n] + t
        b = beta[:n]
        grown = emit[at] * b
        m = alpha[at] * b
        alpha[at] = m / m.sum(axis=1, keepdims=True)
        grown = grown @ trans.T
        beta[:n] = grown / grown.sum(axis=1, keepdims=True)
    return alpha


def fit(texts: list[str], langs: list[str]) -> dict:
    """Train a model. Texts come in a fixed order, so does the result."""
    labels = sorted(set(langs))
    rng = np.random.default_rng(7)
    types: dict[str, int] = {}
    segments: list[tuple[int, list[int]]] = []
    for text, lang in zip(texts, langs):
        ids = [types.setdefault(c, len(types)) for c in map(word_core, text.split()) if c]
        at = 0
        while at < len(ids):
            n = int(rng.integers(8, 48))
            segments.append((labels.index(lang), ids[at:at + n]))
            at += n
    if not types:
        return {"labels": []}
    order = rng.permutation(len(segments))
    token = np.array([i for s in order for i in segments[s][1]], dtype=np.int64)
    gold = np.array([segments[s][0] for s in order for _ in segments[s][1]], dtype=np.int64)
    n, size = len(token), len(labels)
    lengths = np.full((n + SEQUENCE - 1) // SEQUENCE, SEQUENCE, dtype=np.int64)
    lengths[-1] = n - SEQUENCE * (len(lengths) - 1)
    first = np.cumsum(lengths) - lengths

    counts = np.bincount(token, minlength=len(types))
    frequent = [t for t in np.argsort(-counts, kind="stable") if counts[t] >= 3]
    names = list(types)
    lexicon = {names[t]: (1 << HASH_BITS) + k for k, t in enumerate(frequent)}
    parts = features(names)
    flat = np.concatenate([p[0] for p in parts] + [np.array([lexicon[c] for c in names if c in lexicon], dtype=np.int64)])
    owner = np.concatenate([np.repeat(rows, np.diff(np.append(first, len(f)))) for f, first, rows in parts]
                           + [np.array([k for k, c in enumerate(names) if c in lexicon], dtype=np.int64)])
    by_owner = np.argsort(owner, kind="stable")
    flat, owner = flat[by_owner], owner[by_owner]
    begin = np.searchsorted(owner, np.arange(len(names)))
    width = (1 << HASH_BITS) + len(lexicon)

    weight = np.zeros((width, size))
    trans, start = np.zeros((size, size)), np.zeros(size)
    sums = [np.full_like(x, 1e-8) for x in (weight, trans, start)]
    inner = np.ones(n, dtype=bool)
    inner[first] = False
    pair = np.zeros((size, size))
    np.add.at(pair, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    for _ in range(ITERATIONS):
        score = np.add.reduceat(weight[flat], begin)
        emit = np.exp(score - score.max(axis=1, keepdims=True))[token]
        moves = np.exp(trans)
        marginal = forward_backward(emit, moves, np.exp(start), lengths)
        # Expected transitions from the marginals of both ends: P(t, s) is
        # proportional to alpha x move x emit x beta; alpha and beta are
        # recovered up to a factor that cancels when each pair is normalised.
        expected = _expected_pairs(emit, moves, np.exp(start), lengths)
        grad_token = -marginal
        grad_token[np.arange(n), gold] += 1
        by_type = np.stack([np.bincount(token, weights=grad_token[:, k], minlength=len(types)) for k in range(size)], axis=1)
        grad = np.stack([np.bincount(flat, weights=by_type[owner, k], minlength=width) for k in range(size)], axis=1)
        begun = np.bincount(gold[first], minlength=size) - marginal[first].sum(axis=0)
        for value, g, total in ((weight, grad - 0.01 * weight * len(labels), sums[0]), (trans, pair - expected - trans, sums[1]), (start, begun - start, sums[2])):
            total += g * g
            value += 0.5 * g / np.sqrt(total)
    return {"labels": labels, "weight": weight.astype(np.float32), "trans": trans, "start": start, "lexicon": lexicon}


def _expected_pairs(emit: np.ndarray, moves: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Expected number of moves between labels, over all sequences."""
    size = emit.shape[1]
    full = lengths == lengths[0]
    total = np.zeros((size, size))
    done = 0
    for group, steps in ((full, int(lengths[0])), (~full, int(lengths[-1]))):
        m = int(group.sum())
        if not m:
            continue
        e = emit[done:done + m * steps].reshape(m, steps, size)
        done += m * steps
        alpha = np.empty_like(e)
        a = start[None, :] * e[:, 0]
        alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            a = (alpha[:, t - 1] @ moves) * e[:, t]
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        beta = np.ones((m, size))
        for t in range(steps - 1, 0, -1):
            right = e[:, t] * beta
            joint = alpha[:, t - 1, :, None] * moves[None] * right[:, None, :]
            total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            beta = right @ moves.T
            beta /= beta.sum(axis=1, keepdims=True)
    return total


class Tagger:
    """Labels words and texts by a fitted model; keeps the word types met."""

    def __init__(self, model: dict):
        self.labels = model["labels"]
        self.weight, self.lexicon = model["weight"], model["lexicon"]
        self.moves, self.start = np.exp(model["trans"]), np.exp(model["start"])
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.size = 1
        self.emit = np.ones((1024, len(self.labels)))

    def _learn(self, words: set[str]) -> None:
        """Give new words their row of emissions; words without a letter have
        row 0."""
        cores = {w: word_core(w) for w in words}
        new = sorted({c for c in cores.values() if c not in self.known})
        if new:
            score = emissions(self.weight, new, self.lexicon)
            score = np.exp(score - score.max(axis=1, keepdims=True))
            while self.size + len(new) > len(self.emit):
                self.emit = np.concatenate([self.emit, np.ones_like(self.emit)])
            self.emit[self.size:self.size + len(new)] = score
            self.known.update(zip(new, range(self.size, self.size + len(new))))
            self.size += len(new)
        self.known.update((w, self.known[c]) for w, c in cores.items())

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all words, word counts of the texts, and which words
        have letters."""
        if len(self.known) > MAX_WORDS:
            self._clear()
        split = [t.split() for t in texts]
        lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        words = list(itertools.chain.from_iterable(split))
        new = set(words).difference(self.known)
        if new:
            self._learn(new)
        token = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        return forward_backward(self.emit[token], self.moves, self.start, lengths), lengths, token > 0

    def predict(self, texts: list[str | None] | pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and number of language changes of each text. Of an
        Arrow array, only the texts that step together become Python strings."""
        column = isinstance(texts, pa.Array)
        size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) if column else np.array([len(t or "") for t in texts])
        order = np.argsort(-size, kind="stable")  # texts of like length step together
        lang, score, moves = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        at = 0
        while at < len(order):
            end = at + max(1, int(np.searchsorted(np.cumsum(size[order[at:]]), STEP_CHARS)))
            rows = order[at:end]
            at = end
            some = texts.take(pa.array(rows)).to_pylist() if column else [texts[i] for i in rows]
            marginal, lengths, real = self.marginals([t or "" for t in some])
            doc = np.repeat(np.arange(len(rows)), lengths)[real]
            best = marginal.argmax(axis=1)[real]
            total = np.bincount(doc, minlength=len(rows))
            mass = np.stack([np.bincount(doc, weights=marginal[real, k], minlength=len(rows)) for k in range(len(self.labels))], axis=1)
            change = np.flatnonzero((doc[1:] == doc[:-1]) & (best[1:] != best[:-1]))
            changes = np.bincount(doc[change], minlength=len(rows))
            for k in np.flatnonzero(total):
                i, top = rows[k], int(mass[k].argmax())
                lang[i], score[i], moves[i] = self.labels[top], min(1.0, mass[k, top] / total[k]), changes[k]
        return lang, score, moves

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Runs of words of one language: first word, end, language."""
        marginal, _, real = self.marginals([text])
        out: list[tuple[int, int, str]] = []
        for i in np.flatnonzero(real):
            lang = self.labels[int(marginal[i].argmax())]
            if out and out[-1][2] == lang:
                out[-1] = (out[-1][0], int(i) + 1, lang)
            else:
                out.append((int(i), int(i) + 1, lang))
        return out


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS) -> dict:
    """Fit on at most ``max_docs`` rows with a language and a text, null ids
    included: as many of each language where there are enough, chosen by a hash
    of the id. The bound on rows is the only one on languages: where there are
    more languages than rows allowed, the most frequent ones have a row. With
    no such row the model has no labels and predicts nothing."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    langs = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_docs).select("lang").collect()]
    if not langs:
        return {"labels": []}
    # The first rows of each language: Spark keeps that many a partition before it shuffles.
    each = max(1, max_docs // len(langs))
    print_ = F.xxhash64("id", "text")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "print"))
    ranked = rows.where(F.col("lang").isin(langs)).select("lang", "id", F.xxhash64("id").alias("h"), print_.alias("print")).distinct()
    prints = [r[0] for r in ranked.withColumn("n", first).where(F.col("n") <= each).select("print").collect()]  # at most max_docs
    sample = rows.where(print_.isin(prints)).dropDuplicates(["id", "lang", "text"]).repartition(1).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, tags = [], []
        for batch in batches:
            tags += batch.column(1).to_pylist()
            texts += batch.column(2).to_pylist()
        with paused_gc():
            model = fit(texts, tags) if texts else {"labels": []}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return pickle.loads(bytes(sample.mapInArrow(run, "model binary").first()[0]))


def tag_languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (repeated rows and null ids too):
    doc_id, lang_pred, score (mean marginal of that language over the words
    with letters, 0 to 1), n_switches (changes of language between words),
    with ``with_spans`` also the runs of words of one language.

    Null texts, texts without a letter, and all texts if nothing could be
    learned get ``und`` and score 0. Other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, lang_pred string, score double, n_switches bigint"
    if with_spans:
        schema += ", spans array<struct<first_word: int, end_word: int, lang: string>>"
    span = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value["labels"] else None
        for batch in batches:
            n = batch.num_rows
            with paused_gc():
                lang, score, moves = tagger.predict(batch.column(1)) if tagger else ([UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=np.int64))
                arrays = [batch.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score), pa.array(moves)]
                if with_spans:
                    arrays.append(pa.array([[dict(zip(("first_word", "end_word", "lang"), s)) for s in tagger.spans(t or "")] if tagger else [] for t in batch.column(1).to_pylist()], span))
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")[: len(arrays)]])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: dict, text_col: str = "text", min_score: float = 0.5, lang_col: str | None = None) -> DataFrame:
    """``docs`` with all its columns, without texts whose language is unknown
    or scores below ``min_score``. A model without labels tells nothing of a
    text, so then only texts without a letter go. ``lang_col``: the column that
    takes the language found (``und`` if the model tells nothing)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    to = docs.columns.index(lang_col) if lang_col else None

    def named(batch: pa.RecordBatch, lang: list[str]) -> pa.RecordBatch:
        return batch if to is None else batch.set_column(to, lang_col, pa.array(lang, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value["labels"] else None
        for batch in batches:
            if tagger is None:
                letters = pa.array([any(map(str.isalpha, t or "")) for t in batch.column(at).to_pylist()], pa.bool_())
                yield named(batch, [UNKNOWN] * batch.num_rows).filter(letters)
                continue
            with paused_gc():
                lang, score, _ = tagger.predict(batch.column(at))
            yield named(batch, lang).filter(pa.array([k != UNKNOWN for k in lang]) if min_score <= 0 else pa.array([k != UNKNOWN and s >= min_score for k, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
