"""Retry policy as data: what may be tried again, how long to wait, runs of refusals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Response codes and transport failures after which a request may be repeated.
RETRY_STATUS = (408, 425, 429, 500, 502, 503, 504, 507, 509)
RETRY_TRANSPORT = ("ECONNRESET", "ETIMEDOUT", "ECONNABORTED", "EAI_AGAIN", "EPIPE", "ENOTFOUND", "ECONNREFUSED", "ERR_SOCKET_CONNECTION_TIMEOUT", "EHOSTUNREACH", "ENETUNREACH")


def retryable(status: Column, code: Column) -> Column:
    return F.coalesce(status.isin(*RETRY_STATUS), F.lit(False)) | F.coalesce(code.isin(*RETRY_TRANSPORT), F.lit(False))


def retry_after_ms(header: Column, now: Column) -> Column:
    """Milliseconds to wait by a header of whole seconds or of an HTTP date, which is in GMT
    whatever the session's zone; null for other text, 0 for a date that has passed."""
    seconds = F.when(F.trim(header).rlike(r"^\d+$"), F.trim(header).try_cast("long"))
    date = F.nullif(F.regexp_extract(header, r"(\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1), F.lit(""))
    at = F.try_to_timestamp(F.concat(date, F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z"))
    dated = F.greatest(F.unix_millis(at) - F.unix_millis(now), F.lit(0).cast("long"))
    return F.coalesce(seconds * 1000, F.when(at.isNotNull(), dated))


def backoff_window(attempt: Column, base: int = 2000, cap: int = 120_000) -> Column:
    """The longest wait before an attempt: doubled each time, up to a cap."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1), F.lit(float(cap))).cast("long")


def backoff_wait(attempt: Column, retry_after: Column, draw: Column, base: int = 2000, cap: int = 120_000) -> Column:
    """A random part of the window, and never less than the server asked for."""
    return F.greatest(F.floor(draw * backoff_window(attempt, base, cap)).cast("long"), F.coalesce(retry_after, F.lit(0)).cast("long"))


def refusal_runs(requests: DataFrame, by: list[str], order: list[str], refused: Column, settles: Column) -> DataFrame:
    """``requests`` with ``run``: how many refusals in a row there have been up to each row.

    Rows that neither are refusals nor settle (transport failures) leave a run unbroken.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    resets = F.sum(F.when(settles, 1).otherwise(0)).over(w)
    island = Window.partitionBy(*by, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum(F.when(refused, 1).otherwise(0)).over(island)
    return requests.withColumn("_island", resets).withColumn("run", run.cast("long")).drop("_island")
