"""Sinks: JSON Lines, CSV, keyed rewrites, file names. Spark's committer makes each whole."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.functions.dates import reorder_date
from lumbre.functions.text import csv_cell, document_slug, sequence_text, slugify


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Header, line feeds; quotes only where needed, nulls empty, structures as JSON, cells untrimmed."""
    cells = rows.select(*[csv_cell(F.col(c), t).alias(c) for c, t in rows.dtypes])
    if files:
        cells = cells.coalesce(files)
    writer = cells.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def rewrite(rows: DataFrame, path: str) -> None:
    """Replace a table that ``rows`` may be read from: written aside first."""
    aside = scratch.save(rows, "rewrite")
    aside.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    scratch.discard(aside)


def write_cases(cases: DataFrame, cases_path: str, documents_path: str) -> None:
    """Cases, and a row for each of their documents."""
    aside = scratch.save(cases, "cases")
    append_json(aside, cases_path)
    append_json(document_rows(aside), documents_path)
    scratch.discard(aside)


def document_rows(cases: DataFrame) -> DataFrame:
    """Documents with their case's number, key and class, and their place in it."""
    parent = ["numeroProcesso", "ca", "classeJudicial"]
    return cases.select(*parent, F.posexplode("documentos").alias("index", "d")).select("d.*", *parent, "index")


def with_summary(cases: DataFrame, summaries: DataFrame) -> DataFrame:
    """Cases with what their search row knew."""
    extra = ["internalId", "foundBy", "partesResumo", "ultimaMovimentacao"]
    return cases.join(summaries.select("ca", *extra), "ca", "left").select(*cases.columns, *extra)


def document_path(number: Column, index: Column, data: Column, name: Column, kind: Column, label: Column, key: Column) -> Column:
    """``<case>/<place>_<date>_<slug>_<id>.pdf``; blank parts are left out."""
    parts = [sequence_text(index), reorder_date(data), document_slug(name, kind, label), key]
    return F.concat(slugify(number), F.lit("/"), F.concat_ws("_", *[F.nullif(p, F.lit("")) for p in parts]), F.lit(".pdf"))


def write_pdfs(documents: DataFrame, folder: str, most_bytes: int = 50 << 20) -> DataFrame:
    """Write captured PDF bodies below ``folder`` and return a row for each document:
    (idProcessoDocumento, numeroProcesso, arquivoLocal, bytes, outcome).

    ``documents``: DOCUMENT_ROW, ``index``, ``body`` and ``content_type``. A body that is no
    acceptable PDF is not written and its problem is the outcome; a file that is there
    already is kept (``exists``), so that a task that runs again does no harm. Files are
    written aside and moved, through any store that Arrow can reach.
    """
    from lumbre.operators.limits import pdf_problem

    path = document_path(F.col("numeroProcesso"), F.col("index"), F.col("data"), F.col("nomeArquivo"), F.col("tipo"), F.col("rotulo"), F.col("idProcessoDocumento"))
    problem = pdf_problem(F.col("body"), F.col("content_type"), most_bytes)
    rows = documents.select("idProcessoDocumento", "numeroProcesso", path.alias("arquivoLocal"), F.when(problem.isNull(), F.col("body")).alias("body"), problem.alias("problem"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            sizes, outcomes = [], []
            for name, body, why in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist(), strict=True):
                size, outcome = None, why
                if why is None:
                    to, raw = posixpath.join(top, name), body.as_py()
                    try:
                        found = store.get_file_info(to)
                        size, outcome = (found.size, "exists") if found.type == fs.FileType.File else (len(raw), "written")
                        if outcome == "written":
                            store.create_dir(posixpath.dirname(to), recursive=True)
                            aside = f"{to}.{uuid.uuid4().hex}"
                            with store.open_output_stream(aside) as out:
                                out.write(raw)
                            store.move(aside, to)
                    except OSError as e:
                        size, outcome = None, f"{type(e).__name__}: {e}"
                sizes.append(size)
                outcomes.append(outcome)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(outcomes, pa.string())], names=["idProcessoDocumento", "numeroProcesso", "arquivoLocal", "bytes", "outcome"])

    # Written once, so that reading the outcomes again writes nothing again.
    return scratch.save(rows.mapInArrow(run, "idProcessoDocumento string, numeroProcesso string, arquivoLocal string, bytes long, outcome string"), "pdfs")


def download_log(outcomes: DataFrame, at: Column) -> DataFrame:
    """Rows of the download log: what was written, and what was there already, so that its path is known."""
    good = outcomes.filter(F.col("outcome").isin("written", "exists"))
    return good.select("idProcessoDocumento", "numeroProcesso", "arquivoLocal", "bytes", at.alias("downloadedAt"))
