"""Adaptive subdivision under a result cap.

A search answers with at most ``cap`` rows. A cell (a date range, perhaps with a class)
below the cap is COMPLETE; one at the cap is halved by date down to single days, then
dealt out by class, and what is still at the cap is SATURATED: reported, never passed
off as whole.

The only large step, counting rows by day and class, is a grouped aggregation. Its
result is bounded by the calendar and the catalogue, not by the rows; it is checked
against ``most_cells`` and planned with running sums, two lookups a cell.
"""

from __future__ import annotations

from datetime import date

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre.functions.dates import halve

CELLS = "start date, end date, class string, unclassed boolean, depth int, n long, status string"


def plan_cells(rows: DataFrame, day: str, kind: str, cap: int = 30, start: date | None = None, end: date | None = None, most_cells: int = 2_000_000, split_class: bool = True) -> DataFrame:
    """Every cell that the plan visits, with its count and its status.

    A day that is dealt out by class has a leaf of its own for the rows without a class
    (``unclassed``). Rows that no cell covers, as they have no day or one outside the range,
    are counted in a cell without dates, UNCOVERED, if there are any: no plan is complete
    with such a cell.
    """
    counts = rows.groupBy(F.col(day).cast("date").alias("d"), F.col(kind).alias("k")).agg(F.count("*").alias("n"))
    found = counts.limit(most_cells + 1).collect()
    if len(found) > most_cells:
        raise ValueError(f"more than {most_cells} days and classes")
    spark = rows.sparkSession
    if start is None or end is None:
        if not found:
            return spark.createDataFrame([], CELLS)
        dated = [r["d"] for r in found if r["d"] is not None]
        if not dated:
            return spark.createDataFrame([(None, None, None, False, 0, sum(r["n"] for r in found), "UNCOVERED")], CELLS)
        start, end = start or min(dated), end or max(dated)
    if end < start:
        raise ValueError("the range ends before it starts")
    days = (end - start).days + 1
    kinds = sorted({r["k"] for r in found if r["k"] is not None})
    place = {k: i for i, k in enumerate(kinds)}
    table = np.zeros((len(kinds) + 1, days + 1), np.int64)
    uncovered = 0
    for r in found:
        at = -1 if r["d"] is None else (r["d"] - start).days
        if 0 <= at < days:
            table[place.get(r["k"], len(kinds)), at + 1] += r["n"]
        else:
            uncovered += r["n"]
    upto = table.cumsum(axis=1)
    whole = upto.sum(axis=0)

    def count(a: date, b: date, k: str | None, bare: bool) -> int:
        line = upto[-1] if bare else whole if k is None else upto[place[k]]
        return int(line[(b - start).days + 1] - line[(a - start).days])

    out, stack = [], [(start, end, None, False, 0)]
    while stack:
        a, b, k, bare, depth = stack.pop()
        n = count(a, b, k, bare)
        if n < cap:
            out.append((a, b, k, bare, depth, n, "COMPLETE"))
        elif parts := halve(a, b):
            out.append((a, b, k, bare, depth, n, "SUBDIVIDED"))
            stack += [(x, y, k, bare, depth + 1) for x, y in reversed(parts)]
        elif k is None and not bare and kinds and split_class:
            out.append((a, b, k, bare, depth, n, "SUBDIVIDED"))
            if count(a, b, None, True):
                stack.append((a, b, None, True, depth + 1))
            stack += [(a, b, x, False, depth + 1) for x in reversed(kinds)]
        else:
            out.append((a, b, k, bare, depth, n, "SATURATED"))
    if uncovered:
        out.append((None, None, None, False, 0, uncovered, "UNCOVERED"))
    return spark.createDataFrame(out, CELLS)


def harvest(rows: DataFrame, plan: DataFrame, day: str, kind: str, order: list[str], cap: int = 30) -> DataFrame:
    """The rows that the plan's leaves yield: all of a complete cell, the first ``cap`` of a saturated one.

    Leaves do not overlap: a leaf of several days is listed under each, and a row meets the
    leaf of its day that is of no class, of its class, or of the rows without one.
    """
    from lumbre.operators.limits import top_per_group

    leaves = plan.filter("status IN ('COMPLETE', 'SATURATED')").select(F.explode(F.sequence("start", "end")).alias("_day"), F.col("start").alias("_start"), F.col("class").alias("_class"), "unclassed", "status")
    marked = rows.withColumn("_day", F.col(day).cast("date"))
    own = F.when(F.col("unclassed"), F.col(kind).isNull()).otherwise(F.col("_class").isNull() | (F.col("_class") == F.col(kind)))
    every = marked.join(leaves, "_day").filter(own)
    cut = top_per_group(every.filter("status = 'SATURATED'"), ["_start", "_class", "unclassed"], order, cap)
    return every.filter("status = 'COMPLETE'").unionByName(cut).select(*rows.columns, "status")


def search_budget(plan: DataFrame, most: int) -> DataFrame:
    """The plan as ``most`` searches leave it: cells in the order in which they are visited,
    those beyond the budget OPEN, to be searched by a later run."""
    from pyspark.sql import Window

    order = Window.orderBy(F.col("start").asc_nulls_last(), F.desc("end"), "depth", F.col("class").asc_nulls_last())
    # One task: a plan is bounded by ``most_cells`` of ``plan_cells``.
    return plan.withColumn("_n", F.row_number().over(order)).withColumn("status", F.when(F.col("_n") > most, "OPEN").otherwise(F.col("status"))).drop("_n")


def seed_cell(start: str | None, end: str | None, **criteria: str) -> dict[str, str]:
    """The first cell's criteria; at least one must be set, and dates must be days of the calendar."""
    from datetime import datetime

    set_ones = {k: v for k, v in {"dataInicio": start, "dataFim": end, **criteria}.items() if v}
    if not set_ones:
        raise ValueError("a search needs at least one criterion")
    found = [datetime.strptime(set_ones[k], "%d/%m/%Y") for k in ("dataInicio", "dataFim") if k in set_ones]
    if len(found) == 2 and found[1] < found[0]:
        raise ValueError("the range ends before it starts")
    return set_ones


