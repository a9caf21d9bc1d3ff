"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

    language_id    rows without a letter, or whose language is a guess, go
    near_dedup     one document of each group of near duplicates stays
    decontaminate  documents that hold a benchmark item go
    mix_sources    documents are left out or repeated as their source's target asks
    shard          every row gets its shard and its slot

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``docs``,
the last one with ``shard`` and ``slot`` besides. All stages decide by row: rows that share
an id, or have none, are told apart by their texts, so that no text goes with another one's
id, and null ids are judged like all others. Of rows of equal id and text one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.llm import decontamination, language_id, mixing, near_dedup, sharding

#: A text counts as written in some language from this many times the probability of a guess.
OVER_CHANCE = 1.2


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    told = language_id.identify(docs, model)
    least = min(1.0, OVER_CHANCE / max(1, len(model.labels)))
    return told.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies as the mix takes; the part of a text at the edge of a budget is a whole copy."""
    mixed = mixing.mix(docs)
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    whole = mixed.filter("taken > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return whole.select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_records(docs).select(*docs.columns, "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mix_sources", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch.step(spark) as keep:  # what a stage has written for itself goes when its result is written
            now = scratch.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
            keep.append(scratch.path_of(now))
        if before is not None:
            scratch.discard(before)
        docs = before = now
    return STAGES[-1][1](spark, docs, sf_dir)


#: A classifier, MinHash, a latent index and a seeded shuffle are not expressible in SQL;
#: the stages are tested against brute-force versions.
ORACLE_SQL = None
