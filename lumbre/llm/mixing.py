"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a seeded 60-bit hash. Words are summed by source and by the leading
bits of the hash; a running sum over those buckets finds the one bucket in which a
source's budget runs out, and only the rows of that bucket are summed again by the
next bits, until the budget is placed between two hash values. Rows are then kept by
comparing their hash with their source's threshold, so nothing is sorted. A budget
above a source's size first takes the source whole as often as it goes (nested
thresholds: each pass over a source takes the same rows in the same order), then the
rows below the threshold once more.

Defined results
    null source       a source of its own, after all others
    null id           hashed as an empty id, with its text
    null, empty text  size 0, nothing to take
    repeated rows     rows of one id and text have one hash; those at the budget's edge
                      share what is left of it in proportion to their sizes, rounded down
    empty table       no rows
    clashing names    the names that ``mix`` adds replace columns of ``docs``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.llm.words import word_count

LEVEL_BITS, LEVELS = 15, 4
ADDED = ["size", "source_size", "target", "taken"]


def row_hash(doc_id: Column, text: Column, seed: str) -> Column:
    """60 bits of a seeded hash of id and text, as a long: rows that share an id are told apart."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """Words to take of each source.

    ``sizes``: one row (source, source_size) per source. Sources by code point, null
    last, get the weights in turn. ``share`` of all words is dealt out by weight; what
    a source gets above ``max_epochs`` times its size goes to the others by weight.
    With sources in ascending order of cap over weight, the sources that end at their
    cap are a prefix, which a running sum finds without iterating.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), nth + 1)
    ranked = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    # The level rises as long as sources below it are set to their caps, and falls after.
    return levels.withColumn("level", F.max("level").over(everything)).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def _boundary(hist: DataFrame) -> DataFrame:
    """The bucket of each source in which its need runs out, and what is needed inside it."""
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = hist.withColumn("upto", F.sum("words").over(running))
    return total.filter((F.col("upto") > F.col("need")) & (F.col("upto") - F.col("words") <= F.col("need")) & (F.col("words") > 0)).select(
        "source", "bucket", "words", (F.col("need") - F.col("upto") + F.col("words")).alias("need")
    )


def mixing_plan(rows: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """One row per source: its target, whole passes and hash threshold.

    ``rows``: (source, size, hash). It is read once for each level; all but the first
    read only sum the rows of the boundary buckets.
    """
    bits = LEVEL_BITS * (LEVELS - 1)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    first = scratch.save(rows.groupBy("source", F.shiftright("hash", bits).alias("bucket")).agg(F.sum("size").alias("words")), "mix-hist")
    sizes = first.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, max_epochs)
    copies = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0)
    targets = targets.withColumn("copies", copies.cast("long")).withColumn(
        "need", F.floor("target") - F.col("copies") * F.col("source_size")
    )
    targets = scratch.save(targets.coalesce(1), "mix-targets")
    edge = _boundary(first.join(targets, same(first, targets)).select(first["source"], "bucket", "words", "need"))
    for level in range(1, LEVELS):
        edge = scratch.save(edge.coalesce(1), "mix-edge")
        shift = bits - level * LEVEL_BITS
        inside = rows.join(edge, same(rows, edge) & (F.shiftright(rows["hash"], shift + LEVEL_BITS) == edge["bucket"]))
        hist = inside.groupBy(rows["source"], F.shiftright(rows["hash"], shift).alias("bucket"), "need").agg(F.sum("size").alias("words"))
        edge = _boundary(hist)
    edge = edge.select(F.col("source").alias("edge_source"), F.col("bucket").alias("edge"), F.col("words").alias("edge_words"), F.col("need").alias("edge_need"))
    plan = targets.drop("need").join(edge, targets["source"].eqNullSafe(edge["edge_source"]), "left").drop("edge_source")
    return scratch.save(plan.coalesce(1), "mix-plan")


def measured(docs: DataFrame, seed: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, hash) of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), row_hash(F.col(id_col), F.col(text_col), seed).alias("hash")
    )


def apply_plan(rows: DataFrame, plan: DataFrame, source: Column, size: Column, hashed: Column) -> DataFrame:
    """``rows`` with ``size``, ``source_size``, ``target`` and ``taken``."""
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    own = rows.withColumns({"_mix_size": size, "_mix_hash": hashed})
    joined = own.join(plan, source.eqNullSafe(plan["_mix_source"]), "left")
    edge = F.col("_mix_edge")
    part = F.floor(F.col("_mix_size") * F.col("_mix_edge_need") / F.col("_mix_edge_words"))
    once = F.when(F.col("_mix_hash") < edge, F.col("_mix_size")).when(F.col("_mix_hash") == edge, part).otherwise(0)
    taken = (F.col("_mix_copies") * F.col("_mix_size") + once).cast("long")
    kept = [F.col(c) for c in rows.columns if c not in ADDED]
    return joined.select(*kept, F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), taken.alias("taken"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with each row's size, its source's size and target, and the words taken of it.

    ``taken`` counts repeats: 2.5 times its size is two whole passes and half a text.
    The sum over a source is its target rounded down, up to the rounding of rows of
    equal hash.
    """
    rows = scratch.save(measured(docs, seed, id_col, text_col, source_col), "mix-rows")
    plan = mixing_plan(rows, weights, share, max_epochs)
    return apply_plan(docs, plan, F.col(source_col), word_count(F.col(text_col)), row_hash(F.col(id_col), F.col(text_col), seed))


def mix_digest(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """As ``mix``, without the texts: (doc_id, source, size, source_size, target, taken)."""
    rows = scratch.save(measured(docs, seed), "mix-rows")
    plan = mixing_plan(rows, weights, share, max_epochs)
    return apply_plan(rows, plan, rows["source"], rows["size"], rows["hash"]).drop("hash")


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_digest(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || 'mix' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
c AS (SELECT *, source_size * 3 AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w),
l AS (SELECT *, (CAST(total AS DOUBLE) - coalesce(CAST(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
             / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS lv
      FROM c WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)),
m AS (SELECT *, max(lv) OVER () AS best FROM l),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), best * weight) AS target FROM m),
n AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS copies FROM t),
g AS (SELECT source, h, sum(size) AS b FROM d GROUP BY source, h),
r AS (SELECT source, h, b, sum(b) OVER (PARTITION BY source ORDER BY h) - b AS before FROM g)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CAST(n.copies * d.size + CASE
         WHEN r.b = 0 OR r.before >= floor(n.target) - n.copies * n.source_size THEN 0
         WHEN r.before + r.b <= floor(n.target) - n.copies * n.source_size THEN d.size
         ELSE floor(d.size * (floor(n.target) - n.copies * n.source_size - r.before) / r.b) END AS BIGINT) AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
JOIN r ON r.source IS NOT DISTINCT FROM d.source AND r.h = d.h
"""
