"""Words and shared small helpers of the text operators.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab,
form feed and carriage return; where lower case is asked for, only A-Z change.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbre import scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Most bytes of an Arrow batch on its way to a Python worker, a single longer row aside.
BATCH_BYTES = 4 << 20
#: Bytes of text after which a worker returns freed memory to the system.
GIVE_BACK = 64 << 20


def word_count(text: Column) -> Column:
    """Words of a text as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_crc32(doc_id: Column) -> Column:
    """Unsigned crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


#: Most rows of a table of keys that is sent out.
BROADCAST_ROWS = 1_000_000


def text_hash(text: Column) -> Column:
    """64 bits of a text; with the id, what tells a row from rows of other texts. Null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id and text are in ``gone`` (doc_id, text_hash).

    Null ids are equal here, and texts decide beside ids, so that no row goes for another
    one's sake. ``gone`` is sent out only if it is few by count.
    """
    gone = scratch.save(gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct(), "gone", compact=True)
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = docs[id_col].cast("long").eqNullSafe(gone["_gone_id"]) & (text_hash(docs[text_col]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def small_batches(spark: SparkSession) -> None:
    """Lower this session's limit of an Arrow batch to BATCH_BYTES, if it is higher.

    Spark fills batches by rows up to 64 MB, which the JVM and the Python worker then both hold.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) if now else -1
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


@cache
def lean_worker() -> None:
    """Let the worker's allocations go through malloc, which gives large ones back when they are freed."""
    pa.set_memory_pool(pa.system_memory_pool())
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD, which otherwise rises to 32 MB
        mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD


def give_back() -> None:
    """Return freed memory to the system: Python workers are used again by later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each piece."""
    lean_worker()
    handled = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(sizes)
        piece = upto // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(int(a), int(b - a))
        handled += int(upto[-1])
        if handled > GIVE_BACK:
            handled = 0
            give_back()
    give_back()


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: a number from 0 among the rows of equal ``keys``.

    For rows that are alike but for nothing that matters, so that any numbering will do. A
    key's rows are numbered in the parts in which they are read and the parts' counts
    summed, so that no task holds a whole key.
    """
    marked = rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    marked = scratch.save(marked, "numbered")
    counts = marked.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_part").orderBy("_at")
    local = marked.withColumn("_local", F.row_number().over(within) - 1)
    same = F.lit(True)
    for k in [*keys, "_part"]:
        same = same & local[k].eqNullSafe(starts[k])
    return local.join(starts, same).select(*[local[c] for c in rows.columns], (F.col("_start") + F.col("_local")).cast("long").alias(name))


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, distinct words, first word of each text and the end).

    Null texts have no words.
    """
    texts = pc.fill_null(texts, "")
    texts = pc.utf8_trim(pc.ascii_lower(texts) if lower else texts, " \t\n\x0b\x0c\r")
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    empty = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if empty.any():
        before = np.concatenate([[0], np.cumsum(empty)])
        offsets = offsets - before[offsets]
        flat = flat.filter(pa.array(~empty))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, offsets
