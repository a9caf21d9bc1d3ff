"""Dates printed as ``dd/MM/yyyy``, and inclusive date ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

PRINTED = r"^(\d{2})/(\d{2})/(\d{4})"


def reorder_date(c: Column) -> Column:
    """``yyyy-MM-dd`` of a printed date, without a calendar check; ``sem-data`` for none."""
    moved = F.concat_ws("-", *[F.regexp_extract(c, PRINTED, i) for i in (3, 2, 1)])
    return F.when(F.coalesce(c, F.lit("")).rlike(PRINTED), moved).otherwise("sem-data")


def parse_date(c: Column) -> Column:
    """A printed date; null for text of another form and for days that no calendar has."""
    return F.when(F.regexp_like(c, F.lit(r"^\d{2}/\d{2}/\d{4}$")), F.try_to_timestamp(c, F.lit("dd/MM/yyyy")).cast("date"))


def require_date(c: Column) -> Column:
    """As ``parse_date``, but what is no date stops the query."""
    return F.coalesce(parse_date(c), F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(c, F.lit("null")))).cast("date"))


def format_date(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def split_range(start: Column, end: Column) -> Column:
    """(first_start, first_end, second_start, second_end) of an inclusive range in halves;
    the first has the smaller one. Null for a range of a day or less."""
    half = F.floor((F.datediff(end, start) + 1) / 2).cast("int")
    cut = F.date_add(start, half - 1)
    halves = F.struct(start.alias("first_start"), cut.alias("first_end"), F.date_add(cut, 1).alias("second_start"), end.alias("second_end"))
    return F.when(end > start, halves)


def halve(start: date, end: date) -> tuple[tuple[date, date], tuple[date, date]] | None:
    """``split_range`` for the planner's loop."""
    days = (end - start).days + 1
    if days < 2:
        return None
    cut = start + timedelta(days=days // 2 - 1)
    return (start, cut), (cut + timedelta(days=1), end)
