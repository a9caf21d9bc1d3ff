"""Keyed deduplication and upsert. Order comes from an explicit sequence column, and every
operator is an aggregation, so that partial results are combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a document with a download url brings to an earlier one without.
UPGRADED = ("downloadUrl", "formato")
UPGRADED_IF_SET = ("idBin", "numeroDocumento", "nomeArquivo")


def _spread(grouped: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return grouped.select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in columns])


def first_wins(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row with the lowest ``seq`` of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return _spread(rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_row")), keys, rows.columns)


def last_wins(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row with the highest ``seq`` of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return _spread(rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_row")), keys, rows.columns)


def upgrade_documents(rows: DataFrame, key: str, seq: str, has_url: Column, always=UPGRADED, if_set=UPGRADED_IF_SET) -> DataFrame:
    """The first row of each key, upgraded by the first that has a url where it has none itself.

    ``always`` columns come from the upgrade, ``if_set`` columns too unless null there; all
    others stay as they were seen first.
    """
    rest = [c for c in rows.columns if c != key]
    row = F.struct(*rest, has_url.alias("_has_url"))
    both = rows.groupBy(key).agg(F.min_by(row, F.col(seq)).alias("a"), F.min_by(F.when(has_url, row), F.when(has_url, F.col(seq))).alias("b"))
    upgrade = ~F.col("a._has_url") & F.col("b").isNotNull()

    def pick(c: str) -> Column:
        if c in always:
            return F.when(upgrade, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
        if c in if_set:
            return F.when(upgrade, F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))).otherwise(F.col(f"a.{c}"))
        return F.col(f"a.{c}")

    return both.select(*[F.col(key) if c == key else pick(c).alias(c) for c in rows.columns])


def non_empty_wins(rows: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """(keys, value): the last value that is not blank; blank where a key has no other."""
    full = F.col(value) != ""
    best = F.max_by(F.when(full, F.col(value)), F.when(full, F.col(seq)))
    return rows.groupBy(*keys).agg(F.coalesce(best, F.max(value)).alias(value))


def upsert_failures(rows: DataFrame, key: str = "key", seq: str = "seq", attempts: str | None = None) -> DataFrame:
    """One row a key: the latest row, with ``attempts`` summed (one for each row without any)."""
    rest = [c for c in rows.columns if c not in (key, attempts, seq)]
    count = F.sum(F.coalesce(F.col(attempts), F.lit(1))) if attempts else F.count("*")
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_row"), count.cast("long").alias("attempts"))
    return latest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], "attempts")


def clear_failures(failures: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Failures whose key has not been done since."""
    return failures.join(done.select(key).distinct(), key, "left_anti").select(*failures.columns)


def distinct_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A set of keys: done cells, saturated cells, seen cases, downloads."""
    return rows.select(*keys).distinct()
