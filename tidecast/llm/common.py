"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, tab, newline, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``. Only a
    local session without that setting falls back to a folder of its own."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalised(text: Column) -> Column:
    """Null counts as empty; every run of blanks becomes one space. (A single
    space is already right, so only longer runs and other blanks are matched.)"""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]{2,}|[\t-\r]", " ")


#: A key with this share of all rows or more is hot; there are at most so many.
HOT_KEYS = 1000


def keyed_lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` left-joined with ``table`` (unique on ``keys``, nulls equal);
    ``weight`` is how many rows have the key. Keys that hold a thousandth of the
    table's weight are at most a thousand rows and are broadcast; their rows are
    spread, by the hash of all columns, over the shuffle that joins the others."""
    table = store(table, "lookup")
    rest = [c for c in table.columns if c not in keys]
    total = table.agg(F.sum(weight).alias("total__"))
    hot = (table.join(F.broadcast(total), F.col(weight) * HOT_KEYS >= F.col("total__"))
           .select(*[F.col(c).alias(f"{c}__hot") for c in table.columns]))
    cold = table.select(*[F.col(c).alias(f"{c}__cold") for c in table.columns], F.lit(-1).cast("bigint").alias("salt__cold"))
    same = lambda side: [rows[k].eqNullSafe(F.col(f"{k}__{side}")) for k in keys]
    is_hot = F.col(f"{weight}__hot").isNotNull()
    spread = F.when(is_hot, F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_KEYS))).otherwise(-1).cast("bigint")
    marked = rows.join(F.broadcast(hot), same("hot"), "left").withColumn("salt__", spread)
    both = marked.join(cold, [*same("cold"), F.col("salt__") == F.col("salt__cold")], "left")
    return both.select(*[rows[c] for c in rows.columns], *[F.when(is_hot, F.col(f"{c}__hot")).otherwise(F.col(f"{c}__cold")).alias(c) for c in rest])


#: Slots of a sieve: at most so many rows, of two numbers each, are broadcast.
SIEVE_SLOTS = 1 << 20


def _slot(key: Column) -> tuple[Column, Column]:
    """Slot of a key and the two bits that it sets there."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("bigint")
    bit = lambda shift: F.call_function("shiftleft", one, F.pmod(F.shiftright(h, shift), F.lit(64)).cast("int"))
    return F.pmod(F.xxhash64(key), F.lit(SIEVE_SLOTS)), bit(0).bitwiseOR(bit(6))


def sieve(keys: DataFrame, key: Column) -> DataFrame:
    """Blocked Bloom filter (sieve__slot, sieve__bits) of ``key`` over
    ``keys``: never more than ``SIEVE_SLOTS`` rows, whatever the input. A full
    sieve lets everything through, so what follows it must not rely on it."""
    slot, bits = _slot(key)
    return store(keys.select(slot.alias("sieve__slot"), bits.alias("sieve__bits"))
                 .groupBy("sieve__slot").agg(F.bit_or("sieve__bits").alias("sieve__bits")), "sieve")


def sifted(rows: DataFrame, key: Column, table: DataFrame, inside: bool = True) -> DataFrame:
    """Rows whose key may be in the sieve (all that are, and few others), or
    with ``inside`` false those whose key surely isn't."""
    slot, bits = _slot(key)
    met = (slot == F.col("sieve__slot")) & (F.col("sieve__bits").bitwiseAND(bits) == bits)
    return rows.join(F.broadcast(table), met, "left_semi" if inside else "left_anti")


def id_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the decimal id modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


#: Rows and bytes of an Arrow batch of whole texts. A task holds one outside its
#: heap on the way to Python, its worker holds it and what it returns.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``
    from now on, where the session sets no limits itself. Spark reads them when
    a query runs and has none for a single one; rows and results don't change."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", most)


@contextlib.contextmanager
def paused_gc() -> Iterator[None]:
    """No cycle collection meanwhile: it would walk large word caches, which
    hold no cycles, again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with paused_gc():
                out = fn(batch)
            if isinstance(out, pa.Table):
                yield from out.to_batches()
            else:
                yield out

    return df.mapInArrow(run, schema)


#: Bytes of texts whose words are hashed together; numpy's arrays take thirty to sixty times that.
CHUNK_BYTES = 1 << 18


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit``; an item
    over the limit gets a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
