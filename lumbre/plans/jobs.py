"""Jobs: ingest captured responses, export, replay dead letters, report; and their command line."""

from __future__ import annotations

import argparse
import json
import logging
import os
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre import schemas, scratch
from lumbre.log import set_up
from lumbre.operators.dedup import clear_failures, first_wins, upsert_failures
from lumbre.operators.joins import unseen, with_latest
from lumbre.operators.parse import class_catalogue, parsed
from lumbre.plans import planner
from lumbre.plans.panels import assemble_cases
from lumbre.sources import sinks, tables
from lumbre.streaming.ingest import ingest, publish, split_batch

log = logging.getLogger("lumbre")


@dataclass
class Settings:
    """From the environment, as LUMBRE_<NAME>; numbers are read strictly."""

    data_dir: str = "data"
    base_url: str = "https://example.org/"
    cap: int = 30
    csv_files: int = 0
    verbose: bool = False

    @classmethod
    def from_env(cls, env=os.environ) -> Settings:
        found = {}
        for f in fields(cls):
            raw = env.get(f"LUMBRE_{f.name.upper()}")
            if raw is not None:
                found[f.name] = raw.strip().lower() in ("1", "true", "yes", "on") if f.type == "bool" else int(raw) if f.type == "int" else raw
        return cls(**found)

    def path(self, name: str) -> str:
        return f"{self.data_dir}/{name}"


def size_or_zero(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def export_cases(cases: DataFrame) -> DataFrame:
    counted = cases.withColumns({"qtdPartes": size_or_zero(F.col("partes")), "qtdMovimentacoes": size_or_zero(F.col("movimentacoes")), "qtdDocumentos": size_or_zero(F.col("documentos"))})
    return counted.select(*schemas.EXPORT_CASES)


def export_documents(documents: DataFrame, downloads: DataFrame) -> DataFrame:
    """Documents with the path of their latest download. Repeated rows of a document stay."""
    return with_latest(documents, downloads, "idProcessoDocumento", ["downloadedAt"], "arquivoLocal", "arquivoLocal").select(*schemas.EXPORT_DOCUMENTS)


def export(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Write both CSV tables; the counts of rejected lines say what could not be read."""
    cases, bad_cases = tables.read_json_lines(spark, settings.path("processes.jsonl"), schemas.PERSISTED_CASE)
    documents, bad_documents = tables.read_json_lines(spark, settings.path("documents.jsonl"), schemas.DOCUMENT_ROW)
    downloads, bad_downloads = tables.read_json_lines(spark, settings.path("downloads.jsonl"), schemas.DOWNLOAD)
    files = settings.csv_files or None
    sinks.write_csv(export_cases(cases), settings.path("processes.csv"), files)
    sinks.write_csv(export_documents(documents, downloads), settings.path("documents.csv"), files)
    return {"rejected_cases": bad_cases.count(), "rejected_documents": bad_documents.count(), "rejected_downloads": bad_downloads.count()}


def new_cases(summaries: DataFrame, seen: DataFrame, seq: str | None = None) -> DataFrame:
    """Search rows of cases not seen yet, each case once, by key and then by number.

    The first row in order of ``seq``, or of all its columns, stays, however rows are partitioned.
    """
    place = [F.col(seq)] if seq else []
    numbered = summaries.withColumn("_seq", F.struct(*place, *[F.col(c).cast("string") if t.startswith("map") else F.col(c) for c, t in summaries.dtypes]))
    left = first_wins(unseen(numbered, seen, ["ca", "numeroProcesso"]), ["ca"], "_seq")
    named = left.filter(F.coalesce(F.col("numeroProcesso"), F.lit("")) != "")
    nameless = left.filter(F.coalesce(F.col("numeroProcesso"), F.lit("")) == "")
    return first_wins(named, ["numeroProcesso"], "_seq").unionByName(nameless).drop("_seq")


def replay(failures: DataFrame, succeeded: DataFrame, failed_again: DataFrame) -> DataFrame:
    """The dead letters after a replay: done keys are gone, others have one attempt more.

    ``failed_again``: (key, error, lastAttemptAt). Records without what a replay needs stay.
    """
    left = clear_failures(failures, succeeded)
    old = left.withColumn("seq", F.lit(0))
    again = failed_again.join(left.drop("error", "lastAttemptAt", "attempts"), "key").select("key", *[c for c in left.columns if c not in ("key", "attempts")], F.lit(1).cast("int").alias("attempts"), F.lit(1).alias("seq"))
    return upsert_failures(old.unionByName(again), "key", "seq", "attempts").select(*failures.columns)


def replayable(failures: DataFrame, kind: str | None = None) -> DataFrame:
    """Dead letters of a kind that carry the context their replay needs; searches go through the planner again."""
    needs = {"pdf": ["document", "numeroProcesso"], "detail": ["summary"], "search": ["criteria"]}
    has = F.lit(False)
    for name, parts in needs.items():
        ready = F.col("kind") == name
        for part in parts:
            ready = ready & F.get_json_object("context", f"$.{part}").isNotNull()
        has = has | ready
    chosen = failures if kind is None else failures.filter(F.col("kind") == kind)
    return chosen.filter(has)


def report(searches: DataFrame, cases: DataFrame, downloads: DataFrame, failures: DataFrame) -> dict[str, int]:
    """Counts of a run, from one aggregation a table."""
    a = searches.agg(
        F.count("*").alias("searches"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "expired").alias("expired"),
        F.count_if(F.col("outcome") == "refused").alias("refused"), F.count_if(F.col("outcome") == "failed").alias("failed"), F.count_if(F.col("saturated")).alias("saturated"),
    ).first().asDict()
    b = cases.agg(F.count("*").alias("cases"), F.count_if(~F.coalesce(F.col("movimentacoesCompleto"), F.lit(True))).alias("partial_cases")).first().asDict()
    c = downloads.agg(F.count("*").alias("downloads"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first().asDict()
    out = {**a, **b, **c, "pending_failures": failures.count()}
    if out["saturated"]:
        log.warning("%d cells are saturated: they hold more rows than a search returns", out["saturated"])
    return out


def harvest_job(spark: SparkSession, settings: Settings, rows: DataFrame, day: str, kind: str, order: list[str], most_searches: int | None = None) -> dict[str, int]:
    """Plan the searches over ``rows`` under the cap, and write what their cells yield, and the cells."""
    plan = planner.plan_cells(rows, day, kind, settings.cap)
    if most_searches is not None:
        plan = planner.search_budget(plan, most_searches)
    plan = scratch.save(plan, "plan")
    plan.write.mode("overwrite").json(settings.path("cells"))
    planner.harvest(rows, plan, day, kind, order, settings.cap).write.mode("overwrite").parquet(settings.path("harvest"))
    return {r["status"].lower(): r["count"] for r in plan.groupBy("status").count().collect()}


def replay_job(spark: SparkSession, settings: Settings, captured: str, kind: str | None = None) -> dict[str, int]:
    """Try the dead letters again on what has been captured since, and rewrite them.

    Details are parsed; those of which a page came are done, with their cases appended. The
    others have one attempt more. Searches go back to the planner, PDFs to the download.
    """
    failures = tables.read_failures(spark, settings.path("failures.jsonl"))
    pending = scratch.save(replayable(failures, kind).filter("kind = 'detail'"), "replay")
    fresh = spark.read.schema(schemas.CAPTURED).parquet(captured)
    asked = fresh.withColumn("_key", F.concat(F.lit("detail:"), "key")).join(pending.select(F.col("key").alias("_key")).distinct(), "_key", "left_semi").drop("_key")
    cases, extras, again = split_batch(asked)
    cases = scratch.save(assemble_cases(cases, extras), "replayed")
    done = cases.select(F.concat(F.lit("detail:"), "ca").alias("key"))
    seen, _ = tables.read_json_lines(spark, settings.path("processes.jsonl"), schemas.PERSISTED_CASE)
    sinks.write_cases(unseen(cases, seen, ["ca", "numeroProcesso"]), settings.path("processes.jsonl"), settings.path("documents.jsonl"))
    failed = again.join(done, "key", "left_anti").groupBy("key").agg(F.min("error").alias("error")).withColumn("lastAttemptAt", F.current_timestamp())
    left = scratch.save(replay(failures, done, failed), "left")
    sinks.rewrite(left, settings.path("failures.jsonl"))
    return {"replayed": done.count(), "pending": left.count()}


def probe(spark: SparkSession, settings: Settings) -> dict[str, object]:
    """Which tables there are, their rows, and the lines that could not be read."""
    out = {}
    for name, schema in (("processes.jsonl", schemas.PERSISTED_CASE), ("documents.jsonl", schemas.DOCUMENT_ROW), ("downloads.jsonl", schemas.DOWNLOAD), ("failures.jsonl", schemas.FAILURE)):
        rows, bad = tables.read_json_lines(spark, settings.path(name), schema)
        out[name] = {"there": tables.exists(spark, settings.path(name)), "rows": rows.count(), "rejected": bad.count()}
    out["judicial-classes.json"] = {"rows": tables.read_catalogue(spark, settings.path("judicial-classes.json")).count()}
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lumbre")
    parser.add_argument("command", choices=["export", "failures", "ingest", "publish", "harvest", "replay", "report", "probe", "classes"])
    parser.add_argument("--data-dir")
    parser.add_argument("--kind", choices=["search", "detail", "pdf"])
    parser.add_argument("--captured", help="captured responses (ingest, replay) or searchable rows (harvest), Parquet; a suggestion page (classes)")
    parser.add_argument("--day", default="dataDistribuicao")
    parser.add_argument("--class-column", default="classeJudicial")
    parser.add_argument("--order", nargs="+", default=["ca"])
    parser.add_argument("--max-searches", type=int)
    given = parser.parse_args(argv)
    settings = Settings.from_env()
    if given.data_dir:
        settings.data_dir = given.data_dir
    if given.command in ("ingest", "harvest", "replay", "classes") and not given.captured:
        parser.error(f"{given.command} needs --captured")
    set_up(settings.verbose)
    spark = SparkSession.builder.appName("lumbre").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "ingest":
        query = ingest(spark, given.captured, settings.path("ingested"), settings.path("checkpoint"))
        query.awaitTermination()
        told, code = {"batches": len(query.recentProgress)}, int(query.exception() is not None)
    elif given.command == "publish":
        publish(spark, settings.path("ingested"))
        told, code = probe(spark, settings), 0
    elif given.command == "harvest":
        told, code = harvest_job(spark, settings, spark.read.parquet(given.captured), given.day, given.class_column, given.order, given.max_searches), 0
    elif given.command == "replay":
        told = replay_job(spark, settings, given.captured, given.kind)
        code = int(told["pending"] > 0)
    elif given.command == "report":
        cells = spark.read.json(settings.path("cells")) if tables.exists(spark, settings.path("cells")) else spark.createDataFrame([], "status string")
        searches = cells.select(F.lit("ok").alias("outcome"), (F.col("status") == "SATURATED").alias("saturated"))
        read = lambda name, schema: tables.read_json_lines(spark, settings.path(name), schema)[0]
        told = report(searches, read("processes.jsonl", schemas.PERSISTED_CASE), read("downloads.jsonl", schemas.DOWNLOAD), tables.read_failures(spark, settings.path("failures.jsonl")))
        code = int(told["pending_failures"] > 0)
    elif given.command == "classes":
        pages = spark.read.text(given.captured, wholetext=True).select(F.col("value").alias("html"))
        kind = schemas.T.ArrayType(schemas.JUDICIAL_CLASS)
        found = parsed(pages, class_catalogue, ["html"], kind, "c").select(F.explode("c").alias("c")).select("c.*").distinct()
        tables.write_catalogue(found, settings.path("judicial-classes.json"))
        told, code = {"classes": tables.read_catalogue(spark, settings.path("judicial-classes.json")).count()}, 0
    elif given.command == "export":
        told, code = export(spark, settings), 0
    elif given.command == "probe":
        told, code = probe(spark, settings), 0
    else:
        told = {"replayable": replayable(tables.read_failures(spark, settings.path("failures.jsonl")), given.kind).count()}
        code = int(told["replayable"] > 0)
    log.info("done", extra={"fields": {"command": given.command, **told}})
    print(json.dumps(told))
    return code


if __name__ == "__main__":
    raise SystemExit(main())
