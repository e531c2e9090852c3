"""Toxicity by a linear classifier on character n-grams whose features are
scaled by naive Bayes log-count ratios (hashed). An n-gram gives a presence
feature for each of its ``TIMES`` levels: met at all, met twice, met four times.

Training reads a bounded sample of labelled texts (``MAX_TRAIN_DOCS``, whole
texts, as many of either label where there are enough); the intercept is then
moved back to the share of toxic rows among all labelled ones. One task fits
the weights by Newton steps; they are broadcast (2**HASH_BITS floats). Scoring is
independent for each row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_arrow, paused_gc

#: Labelled texts that training reads at most.
MAX_TRAIN_DOCS = 6000
HASH_BITS = 20
#: Lengths of the character n-grams.
NGRAMS = (4, 5)
#: A feature each for n-grams that a text holds at least so often.
TIMES = (1, 2, 4)
SMOOTHING = 1.0
#: Chosen on folds inside the training rows, as ``HASH_BITS`` is.
RIDGE = 3e-4
#: Newton steps, and conjugate gradient steps in each, at most.
NEWTON_STEPS, GRADIENT_STEPS = 15, 20
#: Share of the first gradient at which Newton steps end; the steps inside end
#: at ten times that share of their squared residue.
TOLERANCE = 1e-3
#: Texts of the sample that must hold a feature for it to count.
MIN_TEXTS = 3


def present(text: str | None) -> np.ndarray:
    """Sorted distinct features of the lower-cased text, blanks as one space,
    with a space at either end: its hashed n-grams at each level of ``TIMES``."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    code = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    every = [np.zeros(0, dtype=np.uint32)]
    for n in NGRAMS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ code[j:j + size]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        every.append(h)
    grams, times = np.unique(np.concatenate(every), return_counts=True)
    out = [grams]
    for least in TIMES[1:]:
        h = (grams[times >= least] ^ np.uint32(least)) * np.uint32(0x9E3779B1)
        out.append(h ^ (h >> np.uint32(15)))
    return np.unique(np.concatenate(out) >> np.uint32(32 - HASH_BITS)).astype(np.int64)


def solve(feature: np.ndarray, size: np.ndarray, value: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of least mean log loss + ridge / 2 * |weights|**2,
    by Newton steps whose systems preconditioned conjugate gradients solve; a
    step that doesn't lower the loss is halved. ``feature`` lists the columns
    met by row 0, row 1, ..., ``size`` of them each; a met column f has
    ``value[f]``, others 0. y holds both 0 and 1."""
    n, width = len(y), len(value)
    held, begin = size > 0, (np.cumsum(size) - size)[size > 0]

    def ahead(w: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if len(begin):
            out[held] = np.add.reduceat((w * value)[feature], begin)
        return out

    sums = lambda r: np.bincount(feature, weights=np.repeat(r, size), minlength=width)
    back = lambda r: value * sums(r)
    loss = lambda z, w: np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * (w @ w)
    w, bias = np.zeros(width), float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(n, bias)
    now, first = loss(z, w), None
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error, curve = (p - y) / n, np.maximum(p * (1 - p), 1e-6) / n
        r, r_bias = -back(error) - ridge * w, -error.sum()
        norm = np.sqrt(r @ r + r_bias * r_bias)
        first = norm if first is None else first
        if norm <= TOLERANCE * first:
            break
        scale = 1 / (value * value * sums(curve) + ridge)
        scale_bias = 1 / curve.sum()
        u, u_bias = scale * r, scale_bias * r_bias
        rho = r @ u + r_bias * u_bias
        goal = rho * 10 * TOLERANCE
        x, x_bias, moved = np.zeros(width), 0.0, np.zeros(n)
        for _ in range(GRADIENT_STEPS):
            along = ahead(u) + u_bias
            h, h_bias = back(curve * along) + ridge * u, curve @ along
            step = rho / (u @ h + u_bias * h_bias)
            x, x_bias, moved = x + step * u, x_bias + step * u_bias, moved + step * along
            r, r_bias = r - step * h, r_bias - step * h_bias
            rho, before = r @ (scale * r) + r_bias * scale_bias * r_bias, rho
            if rho <= goal:
                break
            u, u_bias = scale * r + rho / before * u, scale_bias * r_bias + rho / before * u_bias
        length = 1.0
        while (then := loss(z + length * moved, w + length * x)) > now and length > 1e-6:
            length /= 2
        if then > now:
            break
        w, bias, z, now = w + length * x, bias + length * x_bias, z + length * moved, then
    return w, bias


def fit(texts: list[str | None], toxic: list[int], share: float) -> tuple[np.ndarray, float]:
    """Weights of the features and the intercept, for a population in which
    ``share`` of the rows is toxic."""
    rows = [present(t) for t in texts]
    size = np.array([len(r) for r in rows])
    keep = size > 0
    y = np.array(toxic, dtype=np.float64)[keep]
    weight = np.zeros(1 << HASH_BITS)
    share = min(max(share, 1e-3), 1 - 1e-3)
    if not len(y) or y.min() == y.max():
        return weight.astype(np.float32), float(np.log(share / (1 - share)))
    flat = np.concatenate([r for r in rows if len(r)])
    owner = np.repeat(np.arange(len(y)), size[keep])
    seen = [np.bincount(flat[(y == k)[owner]], minlength=1 << HASH_BITS) + SMOOTHING for k in (0, 1)]
    n = [float((y == k).sum()) + 2 * SMOOTHING for k in (0, 1)]
    ratio = np.log(seen[1] / n[1]) - np.log(seen[0] / n[0])
    ratio[seen[0] + seen[1] < MIN_TEXTS + 2 * SMOOTHING] = 0
    used = np.flatnonzero(ratio)
    place = np.zeros(1 << HASH_BITS, dtype=np.int64)
    place[used] = np.arange(len(used))
    told = ratio[flat] != 0
    found, bias = solve(place[flat[told]], np.bincount(owner[told], minlength=len(y)), ratio[used], y, RIDGE)
    weight[used] = found * ratio[used]
    sampled = min(max(y.mean(), 1e-3), 1 - 1e-3)
    return weight.astype(np.float32), float(bias + np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_docs: int = MAX_TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """Fit on at most ``max_docs`` rows of ``labels`` (id, 0 or 1): half of
    either label where there are enough, chosen by a hash of the id. Null ids
    and labels are ignored; with no row, or one label, scores are constant."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    count = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))
    parts = [known.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(max_docs // 2) for k in (0, 1)]
    sample = parts[0].union(parts[1]).groupBy("id").agg(F.max("y").alias("y"))
    # The sample has max_docs ids at most, so broadcasting it is bounded.
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
            .repartition(1).sortWithinPartitions("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            y += batch.column(2).to_pylist()
        with paused_gc():
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, y, share))], pa.binary())], ["model"])

    found = rows.mapInArrow(run, "model binary").first()
    return pickle.loads(bytes(found[0])) if found else fit([], [], share)


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) of every row
    (repeated rows and null ids too). A null or empty text gets the score of a
    text without features. Other columns are ignored; no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        weight, bias = shared.value
        z = np.array([weight[present(t)].sum(dtype=np.float64) + bias for t in batch.column(1).to_pylist()], dtype=np.float64)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id bigint, score double, predicted int")
