"""Canonical keys of search cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbre.schemas import CRITERIA_FIELDS


def _set_fields(criteria: Column, names: list[str]) -> Column:
    parts = [F.when(criteria[n].isNotNull() & (criteria[n] != ""), F.concat(F.lit(f"{n}="), criteria[n])) for n in names]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def cell_key(criteria: Column, names: list[str] = CRITERIA_FIELDS) -> Column:
    """``name=value`` of all set criteria by name, joined by a bar; ``(empty)`` for none."""
    joined = F.array_join(_set_fields(criteria, sorted(names)), "|")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("(empty)"))


def describe(criteria: Column, names: list[str] = CRITERIA_FIELDS) -> Column:
    """A label for logs: set criteria in their own order."""
    joined = F.array_join(_set_fields(criteria, names), " ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("(no criteria)"))
