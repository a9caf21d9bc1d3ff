"""Completeness of paged panels: what was read against what the page says there is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_panels(cases: DataFrame, panels: DataFrame, case: str) -> DataFrame:
    """(case, pages, pages_read, pages_failed, complete, strict) of every case.

    ``cases``: (case, has_slider). ``panels``: one row per parsed pager: (case, last_page,
    pages_read, pages_failed, rows_read, footer), and perhaps current_page, 1 where it is not
    there. Pages are summed over panels that have pages left after the one shown; such a panel is whole if no page failed and its rows are exactly the footer's
    count, or it has no footer. A case without such a panel is complete unless it shows a
    slider of which no pager could be read. ``strict`` asks more: every footer is met, of
    panels of one page too.
    """
    many = F.col("last_page") > (F.coalesce(F.col("current_page"), F.lit(1)) if "current_page" in panels.columns else F.lit(1))
    met = F.col("footer").isNull() | (F.col("rows_read") == F.col("footer"))
    found = panels.groupBy(case).agg(
        F.count("*").alias("pagers"),
        F.count_if(many).alias("paged"),
        F.sum(F.when(many, F.col("last_page"))).alias("pages"),
        F.sum(F.when(many, F.col("pages_read"))).alias("pages_read"),
        F.sum(F.when(many, F.col("pages_failed"))).alias("pages_failed"),
        F.bool_and(F.when(many, met)).alias("met"),
        F.bool_and(met).alias("all_met"),
    )
    one = F.lit(1).cast("long")
    paged = F.coalesce(F.col("paged"), F.lit(0)) > 0
    unread = F.col("has_slider") & (F.coalesce(F.col("pagers"), F.lit(0)) == 0)
    complete = F.when(paged, (F.col("pages_failed") == 0) & F.col("met")).otherwise(~unread)
    return cases.join(found, case, "left").select(
        case,
        F.when(paged, F.col("pages")).otherwise(one).alias("pages"),
        F.when(paged, F.col("pages_read")).otherwise(one).alias("pages_read"),
        F.when(paged, F.col("pages_failed")).otherwise(F.lit(0).cast("long")).alias("pages_failed"),
        complete.alias("complete"),
        (complete & F.coalesce(F.col("all_met"), F.lit(True))).alias("strict"),
    )
