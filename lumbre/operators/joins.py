"""Joins on keys, with the side to send out left to the planner's sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_latest(rows: DataFrame, log: DataFrame, key: str, seq: list[str], value: str, alias: str) -> DataFrame:
    """``rows`` with the value of the latest log row of their key, null where there is none."""
    latest = log.groupBy(key).agg(F.max(F.struct(*seq, value)).alias("_latest")).select(key, F.col(f"_latest.{value}").alias(alias))
    return rows.join(latest, key, "left").select(*rows.columns, alias)


def unseen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows none of whose keys has been seen; a null or blank key never matches.

    One anti join a key: the disjunction in one join would compare all with all.
    """
    for key in keys:
        known = seen.select(F.col(key).alias("_known")).filter((F.col("_known").isNotNull()) & (F.col("_known").cast("string") != "")).distinct()
        rows = rows.join(known, rows[key] == known["_known"], "left_anti")
    return rows


def not_in(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def existing(rows: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(files.select(*keys).distinct(), keys, "left_semi")


def fan_out(cells: DataFrame, catalogue: DataFrame, most: int = 10_000) -> DataFrame:
    """Every cell with every entry of a catalogue, which is counted and bounded first."""
    n = catalogue.limit(most + 1).count()
    if n > most:
        raise ValueError(f"the catalogue has more than {most} entries")
    return cells.crossJoin(F.broadcast(catalogue))


def suffix_match(roles: DataFrame, fields: DataFrame, role: str, field: str, seq: str, most: int = 10_000) -> DataFrame:
    """Each role with the first field whose name ends with it; both are small and bounded."""
    if roles.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} roles")
    met = fields.join(F.broadcast(roles), F.endswith(F.col(field), F.col(role)))
    return met.groupBy(role).agg(F.min_by(F.col(field), F.col(seq)).alias(field))


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], pos: str, value: str, alias: str, width: int | None = None) -> DataFrame:
    """``left`` with the value of the last ``right`` row of its key at or before its position.

    With ``width``, each key is cut into stretches of that many positions: the last value
    of each stretch is carried on in a small window over stretches, so that a key with
    most of the rows is spread over as many tasks as it has stretches.
    """
    stretch = F.floor(F.col(pos) / width).cast("long") if width else F.lit(0).cast("long")
    columns = [F.col(c) for c in left.columns]
    a = left.select(F.struct(*columns).alias("_row"), *by, F.col(pos).alias("_pos"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), stretch.alias("_stretch"))
    b = right.filter(F.col(value).isNotNull()).select(F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), *by, F.col(pos).alias("_pos"), F.lit(0).alias("_side"), F.col(value).alias("_value"), stretch.alias("_stretch"))
    w = Window.partitionBy(*by, "_stretch").orderBy("_pos", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = a.unionByName(b).withColumn("_last", F.last("_value", ignorenulls=True).over(w)).filter("_side = 1")
    if not width:
        return inside.select("_row.*", F.col("_last").alias(alias))
    ends = b.groupBy(*by, "_stretch").agg(F.max_by("_value", "_pos").alias("_end"))
    asked = a.select(*by, "_stretch").distinct().join(ends, [*by, "_stretch"], "full")
    before = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.select(*by, "_stretch", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    return inside.join(carried, [*by, "_stretch"], "left").select("_row.*", F.coalesce("_last", "_carried").alias(alias))
