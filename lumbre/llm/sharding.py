"""Sharding by a two-pass external shuffle.

Pass one scatters the records by seeded hashes into buckets of about ``bucket_bytes``
each; every bucket belongs to one shard. Pass two takes one bucket at a time into
memory, in partitions of ``PARTITION_BUCKETS`` buckets on average, brings it into an order that depends on its content alone, shuffles it
(Fisher-Yates with a seed of its own) and writes it. A shard is its buckets one after
another; a record's slot is its place in its shard.

The shard of a record is decided by its id and the number of shards alone (the shard
with the highest hash of id and shard number), so that one more shard takes records
only into itself.

Defined results
    null id           one key like any other
    null text         size 1, crc32 of the empty text
    repeated rows     each has a slot of its own; equal rows that together fill more than
                      a bucket are numbered and spread over all buckets of their shard
    very long texts   one record, held in memory by the task that shuffles its bucket
    empty table       no rows
    clashing names    columns of ``docs`` named like those that are added are dropped
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre import scratch
from lumbre.llm.words import give_back, lean_worker, numbered, small_batches

PARTITION_BUCKETS = 4
#: From here on a partition gets more buckets, still with one at a time in memory.
MOST_PARTITIONS = 1 << 16
ADDED = ["shard", "bucket", "place", "slot", "grown_shard"]


def shard_of(key: Column, n_shards: int, seed: int) -> Column:
    """The shard whose hash with the key is highest (rendezvous hashing)."""
    drawn = [F.struct(F.xxhash64(key, F.lit(i), F.lit(seed)).alias("h"), F.lit(i).alias("i")) for i in range(n_shards)]
    return (F.greatest(*drawn) if n_shards > 1 else drawn[0])["i"]


def _fisher_yates(seed: int):
    def shuffle(table: pa.Table) -> pa.Table:
        lean_worker()
        bucket = table.column("bucket")[0].as_py()
        fixed = np.lexsort((table.column("_row").to_numpy(), table.column("_key").to_numpy()))
        order = fixed[np.random.Generator(np.random.Philox(key=[seed, bucket])).permutation(table.num_rows)]
        rows = table.drop_columns(["_key", "_row"]).take(pa.array(order))
        del table
        give_back()
        return rows.append_column("place", pa.array(np.arange(rows.num_rows, dtype=np.int64)))

    return shuffle


def shard_records(
    docs: DataFrame,
    n_shards: int = 16,
    seed: int = 7,
    bucket_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Write ``docs`` as shuffled shards below ``path`` (``shard=N`` folders of Parquet files,
    each bucket in one file in slot order) and return them as read back, with ``shard``,
    ``bucket``, ``slot`` and ``grown_shard`` (the shard under one more shard).
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or scratch.new_path(spark, "shards")
    docs = docs.select(*[F.col(c) for c in docs.columns if c not in ADDED])
    key, text = F.col(id_col), F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(64)
    row = F.xxhash64(*[F.col(c) for c in docs.columns])
    keyed = docs.withColumns({"_key": F.xxhash64(key, F.lit(seed)), "_row": row})
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    per_shard = max(1, -(-int(total) // (n_shards * bucket_bytes)))
    # Equal rows that would overfill a bucket; their number is bounded by the buckets'.
    alike = keyed.groupBy("_key", "_row").agg(F.sum(size).alias("b"), F.count("*").alias("n")).filter((F.col("n") > 1) & (F.col("b") > bucket_bytes))
    alike = scratch.save(alike.select("_key", "_row").coalesce(1), "shard-alike")
    zero = F.lit(0).cast("long")
    if per_shard > 1 and alike.head(1):
        hot = numbered(keyed.join(alike, ["_key", "_row"], "left_semi"), ["_key", "_row"], "_number")
        keyed = keyed.join(alike, ["_key", "_row"], "left_anti").withColumn("_number", zero).unionByName(hot)
    else:
        keyed = keyed.withColumn("_number", zero)
    within = F.pmod(F.xxhash64("_key", "_row", "_number", F.lit(seed)), F.lit(per_shard))
    scattered = keyed.withColumn("shard", shard_of(key, n_shards, seed)).withColumn("bucket", (F.col("shard") * per_shard + within).cast("long")).drop("_number")
    scattered = scattered.repartition(min(MOST_PARTITIONS, max(1, n_shards * per_shard // PARTITION_BUCKETS)), "bucket")
    fields = [f for f in scattered.schema.fields if f.name not in ("_key", "_row")]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields] + [T.StructField("place", T.LongType())])
    done = scattered.groupBy("bucket").applyInArrow(_fisher_yates(seed), schema)
    done.write.partitionBy("shard").parquet(path)
    read = T.StructType([f for f in schema.fields if f.name != "shard"] + [T.StructField("shard", T.IntegerType())])
    rows = spark.read.schema(read).parquet(path)
    filled = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    starts = scratch.save(starts.coalesce(1), "shard-starts")
    placed = rows.join(starts, "bucket").withColumns({"slot": F.col("_start") + F.col("place"), "grown_shard": shard_of(key, n_shards + 1, seed)})
    return placed.select(*[F.col(c) for c in docs.columns], "shard", "bucket", "slot", "grown_shard")


def op3_shard_documents(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return shard_records(docs).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
        F.col("bucket").cast("long").alias("bucket"),
    )
