"""N-gram Jaccard join by MinHash banding.

1. One pass over the texts makes, for each document, a 128-bit key of its set
   of word 5-grams and its MinHash band hashes. Documents with one key have
   the same set and form a class; only classes go on, so copies of any number
   are one row from here.
2. Band hashes are counted (map-side combined); those met more than once are
   buckets. A class keeps the buckets that it shares. A bucket with many
   classes is cut into hash chunks, and each pair of chunks is a work unit of
   bounded size. A pair of classes belongs to its smallest shared bucket, so
   it is verified once; a class goes only to units where it owns a pair.
3. Full n-gram sets are made again for the classes that have candidates, and
   each unit compares its pairs exactly. A unit returns, for each member, the
   number of documents linked and one edge to the root of its group in the
   unit: rows grow with members, not with pairs.
4. Connected components of the edges by alternating large and small stars.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm import textvec
from tidecast.llm.common import CHUNK_BYTES, chunks, map_arrow, normalised, paused_gc, sieve, sifted, small_batches, store

#: Words of an n-gram and the least similarity of a link.
NGRAM = 5
THRESHOLD = 0.8
#: Chance that a pair at the threshold shares a band.
TARGET_RECALL = 0.9999
#: Classes in a chunk; a unit holds two chunks at most.
CHUNK = 512


def choose_bands(threshold: float, recall: float) -> tuple[int, int]:
    """Bands and rows: the fewest hashes that give a pair at ``threshold`` the
    chance ``recall`` to share a band, among the choices under which a pair at
    half the threshold shares one in at most half of all cases."""
    best = None
    for rows in range(1, 33):
        miss = math.log1p(-(threshold ** rows))
        bands = math.ceil(math.log(1 - recall) / miss)
        if 1 - (1 - (threshold / 2) ** rows) ** bands <= 0.5 and (best is None or bands * rows < best[0] * best[1]):
            best = (bands, rows)
    return best


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seq = textvec.mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return seq[:n].astype(np.uint32) | np.uint32(1), seq[n:].astype(np.uint32)


def gram_sets(texts: list[str | None], n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: first, end, distinct sorted n-gram hashes, offsets.
    Words are lower-cased runs of characters other than the six blanks."""
    data = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    for a, b in chunks([len(t) for t in data], CHUNK_BYTES):
        grams, offsets = textvec.shingles(textvec.words(data[a:b]), n)
        parts, sizes = [], np.zeros(b - a + 1, dtype=np.int64)
        for d in range(b - a):
            s = np.sort(grams[offsets[d]:offsets[d + 1]])
            if len(s):
                s = s[np.append(True, s[1:] != s[:-1])]
                parts.append(s)
                sizes[d + 1] = len(s)
        yield a, b, np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), np.cumsum(sizes)


def _keys(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128-bit key of each n-gram set, as two columns."""
    one = np.add.reduceat(textvec.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), first)
    two = np.add.reduceat(textvec.mix(grams + np.uint64(0x14057B7EF767814F)), first)
    return np.stack([one, two], axis=1)


def signatures(docs: DataFrame, bands: int, rows: int, n: int = NGRAM) -> DataFrame:
    """doc_id, key (null without words) and band hashes of every row, and a
    column sha if there is one."""
    sha = "sha" in docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        keys: list[bytes | None] = [None] * len(texts)
        found: list[np.ndarray | None] = [None] * len(texts)
        mul, add = _multipliers(bands * rows)
        for a, b, grams, offsets in gram_sets(texts, n):
            have = np.flatnonzero(np.diff(offsets))
            if not len(have):
                continue
            first = offsets[:-1][have]
            key = _keys(grams, first)
            low = grams.astype(np.uint32)
            out = np.zeros((len(have), bands), dtype=np.uint64)
            for band in range(bands):
                h = np.full(len(have), band + 1, dtype=np.uint64)
                for j in range(band * rows, (band + 1) * rows):
                    h = textvec.mix(h ^ np.minimum.reduceat(low * mul[j] + add[j], first).astype(np.uint64))
                out[:, band] = h
            for i, d in enumerate(have):
                keys[a + d] = key[i].tobytes()
                found[a + d] = out[i].view(np.int64)
        arrays = [batch.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays + list(batch.columns[2:]), ["doc_id", "key", "bands"] + ["sha"] * sha)

    return map_arrow(docs, run, "doc_id bigint, key binary, bands array<bigint>" + ", sha binary" * sha)


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows that are equal in ``by`` (rows come sorted)."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(row[c] for c in by)
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(row)
    if rows:
        yield key, rows


def owned_pairs(bucket: int, members: list[dict], across: bool) -> np.ndarray:
    """Matrix of the pairs that this unit verifies: their smallest shared
    bucket is this one, and in a unit ``across`` two chunks they are of
    different chunks."""
    m = len(members)
    smaller = [[h for h in x["buckets"] if h < bucket] for x in members]
    ids: dict[int, int] = {}
    for hs in smaller:
        for h in hs:
            ids.setdefault(h, len(ids))
    own = np.ones((m, m), dtype=bool)
    if ids:
        has = np.zeros((m, len(ids)), dtype=np.float32)
        for i, hs in enumerate(smaller):
            has[i, [ids[h] for h in hs]] = 1
        has = has[:, has.sum(axis=0) > 1]
        own &= (has @ has.T) == 0
    if across:
        chunk = np.array([x["chunk"] for x in members])
        own &= chunk[:, None] != chunk[None, :]
    np.fill_diagonal(own, False)
    return own


def overlaps(sets: list[np.ndarray], own: np.ndarray) -> np.ndarray:
    """Sizes of the common n-grams of the pairs marked in ``own``."""
    m = len(sets)
    out = np.zeros((m, m), dtype=np.int64)
    pairs = np.argwhere(np.triu(own))
    if len(pairs) <= 4 * m:
        for i, j in pairs:
            a, b = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            spot = np.minimum(np.searchsorted(b, a), len(b) - 1)
            out[i, j] = out[j, i] = int((b[spot] == a).sum())
        return out
    every = np.concatenate(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    start = np.append(True, every[1:] != every[:-1])
    column = np.cumsum(start) - 1
    shared = np.bincount(column)[column] > 1
    column, row = column[shared], row[shared]
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + width, width)) if len(column) else []
    for a, b in zip(cuts[:-1], cuts[1:]):  # blocks of n-grams keep memory bounded
        if b > a:
            block = np.zeros((m, width), dtype=np.float32)
            block[row[a:b], column[a:b] % width] = 1
            out += (block @ block.T).astype(np.int64)
    return out


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest index of each member's group (members are sorted by key)."""
    root = np.arange(len(links))
    while True:
        new = np.minimum(root, np.where(links, root[None, :], len(links)).min(axis=1))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest key of its
    connected component. Alternating large and small stars; the edge list,
    never the nodes of a component, is what a round shuffles."""

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.when(F.col("m") < F.col("a"), F.col("m")).otherwise(F.col("a")).alias("m"))
        joined = both.join(low, "a")
        if small:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        else:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where(F.col("a") != F.col("b")).distinct()

    flip = F.col("a") > F.col("b")
    e = edges.select(F.when(flip, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(flip, F.col("b")).otherwise(F.col("a")).alias("b")).distinct()
    e = store(e, "edges")
    seen = None
    while True:
        e = store(star(star(e, False), True), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                recall: float = TARGET_RECALL, n: int = NGRAM, chunk: int = CHUNK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id (smallest id that is
    linked to it by a chain of links), rep_id (smallest id with the same
    n-gram set), n_links (rows whose n-gram sets have Jaccard similarity of at
    least ``threshold`` with it).

    Copies count as links. A text of 1 to n - 1 words has one n-gram: all its
    words. Texts without words and rows without an id are linked to nothing:
    their class_id is their own id and n_links 0. Repeated rows are copies.
    Other columns are ignored; no rows give no rows."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sigs, info = _linked(base, threshold, recall, n, chunk)
    able = sigs.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    alone = sigs.where(F.col("key").isNull() | F.col("doc_id").isNull())
    return able.select("doc_id", "key").join(info, "key").select("doc_id", "class_id", "rep_id", "n_links").union(
        alone.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), F.lit(0).cast("bigint").alias("n_links")))


def _linked(base: DataFrame, threshold: float, recall: float, n: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows of ``base`` (doc_id, text), and for each key
    its rep_id, class_id and n_links. With a third column sha, rows without an
    id are linked too, and ``keep`` is the row (no_id, doc_id, sha) of the
    class that comes first."""
    by_row = "sha" in base.columns
    bands, rows = choose_bands(threshold, recall)
    sigs = store(signatures(base, bands, rows, n), "signatures")
    able = sigs.where(F.col("key").isNotNull()) if by_row else sigs.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    keep = [F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")).alias("keep")] if by_row else []
    classes = store(able.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.count("*").alias("size"), F.first("bands").alias("bands"), *keep), "classes")

    cells = classes.select("key", F.explode("bands").alias("bucket"))
    counts = cells.groupBy("bucket").agg(F.count("*").alias("many")).where("many > 1")
    shared = (cells.join(counts, "bucket").groupBy("key")
              .agg(F.collect_list(F.struct("bucket", "many")).alias("found")))  # at most one entry a band
    shared = store(shared.join(classes.select("key", "rep_id", "size"), "key"), "shared")
    place = shared.select("key", "size", F.col("found.bucket").alias("buckets"), F.explode("found").alias("f"))
    parts = F.ceil(F.col("f.many") / F.lit(chunk)).cast("int")
    place = place.select("key", "size", "buckets", F.col("f.bucket").alias("bucket"), parts.alias("parts"),
                         F.pmod(F.xxhash64("key"), parts).cast("int").alias("chunk"))
    units = place.select("key", "size", "buckets", "bucket", "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    units = units.select("key", "size", "buckets", "bucket", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    unit = ["bucket", "lo", "hi"]
    kinds = "key binary, size bigint, buckets array<bigint>, bucket bigint, chunk int, lo int, hi int"

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("size", pa.int64()), ("buckets", pa.list_(pa.int64())), ("bucket", pa.int64()), ("chunk", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
        out: list[dict] = []
        for (bucket, lo, hi), members in _groups(batches, unit):
            if len(members) > 1:
                out += [x for x, has in zip(members, owned_pairs(bucket, members, lo != hi).any(axis=1)) if has]
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    work = store(units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(owners, kinds), "work")
    wanted = shared.join(work.select("key").distinct(), "key", "left_semi").select(F.col("rep_id").alias("doc_id"))

    def full_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, sets = [], []
        for _, _, grams, offsets in gram_sets(batch.column(1).to_pylist(), n):
            have = np.flatnonzero(np.diff(offsets))
            if len(have):
                found = _keys(grams, offsets[:-1][have])
                keys += [x.tobytes() for x in found]
                sets += [grams[offsets[d]:offsets[d + 1]].tobytes() for d in have]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "grams"])

    # The ids wanted grow with the data, so their texts come by a shuffle at
    # every size rather than by a broadcast that small inputs would allow; a
    # sieve of bounded size keeps most other texts out of that shuffle.
    texts = base.select("doc_id", "text")
    whole = F.col("doc_id").cast("bigint")
    sets = map_arrow(sifted(texts, whole, sieve(wanted, whole)).join(wanted.distinct().hint("merge"), "doc_id", "left_semi"), full_sets, "key binary, grams binary")
    if by_row:  # sets that only rows without an id have
        sets = sets.union(map_arrow(texts.where(F.col("doc_id").isNull()), full_sets, "key binary, grams binary"))
    sets = sets.dropDuplicates(["key"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])
        out: list[dict] = []
        for (bucket, lo, hi), members in _groups(batches, unit):
            if len(members) < 2:
                continue
            with paused_gc():
                members.sort(key=lambda x: x["key"])
                own = owned_pairs(bucket, members, lo != hi)
                have = [np.frombuffer(x["grams"], dtype=np.uint64) for x in members]
                length = np.array([len(s) for s in have])
                own &= np.minimum(length[:, None], length[None, :]) >= threshold * np.maximum(length[:, None], length[None, :]) - 1e-9
                if not own.any():
                    continue
                common = overlaps(have, own)
                linked = own & (common >= threshold * (length[:, None] + length[None, :] - common) - 1e-9)
                count = linked @ np.array([x["size"] for x in members], dtype=np.int64)
                root = _roots(linked)
                out += [{"key": x["key"], "root": members[r]["key"], "links": int(c)} for x, r, c in zip(members, root, count) if c]
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    links = store(work.join(sets, "key").repartition(*unit).sortWithinPartitions(*unit)
                  .mapInArrow(verify, "key binary, root binary, links bigint"), "links")
    groups = components(links.where(F.col("key") != F.col("root")).select(F.col("key").alias("a"), F.col("root").alias("b")))
    groups = store(groups.select(F.col("node").alias("key"), "root"), "components")
    first = [F.min("keep").alias("class_keep")] if by_row else []
    named = groups.join(classes.select("key", "rep_id", *["keep"] * by_row), "key").groupBy("root").agg(F.min("rep_id").alias("class_id"), *first)
    degree = links.groupBy("key").agg(F.sum("links").alias("links"))
    found = (groups.join(named, "root").select("key", "class_id", *["class_keep"] * by_row).join(degree, "key"))
    info = store(classes.select("key", "rep_id", "size", *["keep"] * by_row).join(found, "key", "left")
                 .select("key", "rep_id", F.coalesce("class_id", "rep_id").alias("class_id"),
                         (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                         *[F.coalesce("class_keep", "keep").alias("keep")] * by_row), "info")
    return sigs, info


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                     recall: float = TARGET_RECALL, n: int = NGRAM, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with all its columns; of each class of linked rows one with the
    smallest id stays. Rows are told apart by id and text, so rows of one id
    stay or go by their own texts. Null ids lose against any id; where all ids
    of a class are null, one row stays. Rows without words stay."""
    small_batches(docs.sparkSession)
    sha = lambda text: F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), sha(F.col(text_col)).alias("sha"))
    sigs, info = _linked(base, threshold, recall, n, chunk)
    rows = store(sigs.where(F.col("key").isNotNull()).groupBy("doc_id", "sha", "key").agg(F.count("*").alias("times")), "rows")
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("sha") == F.col("keep.sha"))
    gone = store(rows.join(info.select("key", "keep"), "key").where(~stays).select(F.col("doc_id").alias("gone__id"), F.col("sha").alias("gone__sha")), "gone")
    table = sieve(gone, F.col("gone__sha"))
    left = sifted(docs, sha(docs[text_col]), table, inside=False).union(sifted(docs, sha(docs[text_col]), table).join(
        gone.hint("merge"), docs[id_col].eqNullSafe(F.col("gone__id")) & (sha(docs[text_col]) == F.col("gone__sha")), "left_anti"))
    if rows.where("times > 1").limit(1).count():  # repeated rows, perhaps of one that stays
        blank = F.trim(normalised(F.col(text_col))) == ""
        once = left.where(~blank).withColumn("text__sha", sha(F.col(text_col))).dropDuplicates([id_col, "text__sha"]).drop("text__sha")
        left = left.where(blank).union(once)
    return left
