"""Streaming ingest of captured case pages and of their panels' later pages, with durable
progress and dead letters.

Progress is the stream's checkpoint. A batch that runs twice writes the same folder
twice (its number is the folder's name), so that nothing is appended double. What a batch
holds is written as it was parsed; cases are put together as they are read, as a panel's
later page may come in another batch than its case, and keys without a time bound have to
be deduplicated there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lumbre import schemas, scratch
from lumbre.operators.dedup import first_wins
from lumbre.operators.parse import EXTRA_PAGE, case_page, extra_page, has_slider, panel_pagers, parsed, spread
from lumbre.plans.panels import assemble_cases
from lumbre.sources.sinks import document_rows
from lumbre.sources.tables import captured_text

RAW_CASE = T.StructType([*schemas.CASE.fields, T.StructField("pagers", T.ArrayType(schemas.PAGER)), T.StructField("has_slider", T.BooleanType())])
EXTRA = T.StructType([T.StructField("ca", schemas.S), T.StructField("form", schemas.S), T.StructField("page", schemas.I), *EXTRA_PAGE.fields])


def _whole_case(html: str, ca: str, url: str) -> dict:
    return {**case_page(html, ca, url), "pagers": panel_pagers(html), "has_slider": has_slider(html)}


def split_batch(captured: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda rows, _: rows) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases as parsed, later pages, dead letters) of captured responses (schema CAPTURED).

    ``keep(rows, name)`` gives what was parsed as the three read it: each of them runs the
    parsers anew unless it is written first.

    A response other than 200, one without a body, and one on which a parser fails are dead
    letters: ``detail:`` and the key, for a later page with form and page besides.
    """
    arrived = (F.col("status") == 200) & F.col("body").isNotNull()
    good = captured_text(captured.filter(F.coalesce(arrived, F.lit(False))))
    bad = captured.filter(~F.coalesce(arrived, F.lit(False)))
    url = F.coalesce("url", F.lit(""))
    pages = good.filter("form IS NULL").select("key", "page", "form", "html", url.alias("url"))
    cases = keep(parsed(spread(pages), _whole_case, ["html", "key", "url"], RAW_CASE, "case", "error", without=["html", "url"]), "ingest-cases")
    later = good.filter("form IS NOT NULL").select("key", "page", "form", "html", url.alias("url"))
    extras = keep(parsed(spread(later), extra_page, ["html", "url"], EXTRA_PAGE, "extra", "error", without=["html", "url"]), "ingest-pages")
    name = F.concat_ws(":", F.lit("detail"), "key", "form", F.when(F.col("form").isNotNull(), F.col("page").cast("string")))
    why = F.when(F.col("status").isNull(), "no status").when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status").cast("string"))).otherwise("no body")
    letter = lambda rows, error: rows.select(F.lit("detail").alias("kind"), name.alias("key"), error.alias("error"), F.lit(1).alias("attempts"))
    failures = letter(bad, why).unionByName(letter(cases.filter("error IS NOT NULL"), F.col("error"))).unionByName(letter(extras.filter("error IS NOT NULL"), F.col("error")))
    return cases.filter("case IS NOT NULL").select("case.*"), extras.filter("extra IS NOT NULL").select(F.col("key").alias("ca"), "form", "page", "extra.*"), failures


def _batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        held = []

        def keep(rows: DataFrame, name: str) -> DataFrame:
            held.append(scratch.save(rows, name))
            return held[-1]

        try:
            cases, extras, failures = split_batch(batch, keep)
            for rows, name in ((cases, "cases"), (extras, "pages"), (failures, "failures")):
                rows.write.mode("overwrite").json(f"{out}/{name}/batch={number}")
        finally:
            for rows in held:
                scratch.discard(rows)

    return write


def ingest(spark: SparkSession, captured_path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Start ingesting what is captured so far, and stop when it is all in."""
    stream = spark.readStream.schema(schemas.CAPTURED).parquet(captured_path)
    return stream.writeStream.foreachBatch(_batch_writer(out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once: the earliest batch, and in it the first row by content, wins."""
    content = F.xxhash64(F.to_json(F.struct(*[c for c in rows.columns if c != "batch"])))
    return first_wins(rows.withColumn("_seq", F.struct("batch", content.alias("content"))), keys, "_seq").drop("_seq", "batch")


def ingested_cases(spark: SparkSession, out: str) -> DataFrame:
    """All cases with all pages of their panels that have come in, in whichever batch."""
    batch = T.StructField("batch", schemas.I)
    cases = _once(spark.read.schema(T.StructType([*RAW_CASE.fields, batch])).json(f"{out}/cases"), ["ca"])
    pages = _once(spark.read.schema(T.StructType([*EXTRA.fields, batch])).json(f"{out}/pages").filter("read"), ["ca", "form", "page"])
    return assemble_cases(cases, pages)


def publish(spark: SparkSession, out: str) -> None:
    """Write the assembled cases and a row for each of their documents, whole each time."""
    held = scratch.save(ingested_cases(spark, out), "publish")
    held.write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/processes.jsonl")
    document_rows(held).write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/documents.jsonl")
    scratch.discard(held)
