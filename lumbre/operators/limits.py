"""Limits that say what they leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERVER_CAP = 30


def at_server_cap(rows: Column, truncated: Column, cap: int = SERVER_CAP) -> Column:
    """Whether a result may be cut short; exactly the cap counts as cut."""
    return F.coalesce(truncated, F.lit(False)) | (F.coalesce(rows, F.lit(0)) >= cap)


def capped(n: Column, cap: int = SERVER_CAP) -> Column:
    return F.least(n, F.lit(cap))


def top_per_group(rows: DataFrame, by: list[str], order: list, k: int, counts: Column | None = None) -> DataFrame:
    """The first ``k`` rows of each group; rows for which ``counts`` is false pass without using it up."""
    w = Window.partitionBy(*by).orderBy(*order)
    if counts is None:
        return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")
    used = F.sum(F.when(counts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("_n", used).filter((F.col("_n") <= k) | ~counts).drop("_n")


def bounded(rows: DataFrame, order: list, most: int) -> tuple[DataFrame, bool]:
    """(the first ``most`` rows, whether any were left): what was cut stays open."""
    more = rows.limit(most + 1).count() > most
    return rows.orderBy(*order).limit(most), more


def remaining_pages(pagers: DataFrame, current: str = "currentPage", last: str = "lastPage") -> DataFrame:
    """A row for each page that a pager has not shown."""
    left = pagers.filter(F.col(last) > F.col(current))
    return left.withColumn("page", F.explode(F.sequence(F.col(current) + 1, F.col(last))))


def pdf_problem(body: Column, content_type: Column, most_bytes: int = 50 << 20) -> Column:
    """Why a body is not an acceptable PDF; null where it is one."""
    size = F.coalesce(F.octet_length(body), F.lit(0))
    typed = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("pdf"))
    magic = F.substring(body, 1, 4) == F.lit(b"%PDF")
    return F.when(size == 0, "empty").when(~typed & ~F.coalesce(magic, F.lit(False)), "not a pdf").when(size > most_bytes, "too large")


def to_download(documents: DataFrame, downloaded: DataFrame, case: str = "ca", k: int | None = None) -> DataFrame:
    """PDF documents with a url that are not downloaded yet, at most ``k`` a case in document order."""
    pdfs = documents.filter((F.col("formato") == "pdf") & F.col("downloadUrl").isNotNull())
    left = pdfs.join(downloaded.select("idProcessoDocumento").distinct(), "idProcessoDocumento", "left_anti")
    return left if k is None else top_per_group(left, [case], ["index"], k)
