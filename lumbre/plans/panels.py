"""Cases whose panels go on over several pages: later pages appended, counts reconciled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbre import schemas
from lumbre.operators.dedup import upgrade_documents
from lumbre.operators.limits import remaining_pages


def _kind_of(pages: Column) -> Column:
    """The panel that a pager drives: what its first page that was read says."""
    return F.get(F.filter(F.transform(pages, lambda p: p["kind"]), lambda k: k.isNotNull() & (k != "unknown")), F.lit(0))


def assemble_cases(cases: DataFrame, extras: DataFrame) -> DataFrame:
    """Cases with all that their panels' later pages add, and whether that is all there is.

    ``cases``: the columns of CASE, ``pagers`` (array of PAGER) and ``has_slider``. ``extras``:
    (ca, form, page, kind, read, movimentacoes, documentos), one row a page at most. Every page
    that a pager offers beyond the one shown is asked for; one without a row, or not read, has
    failed. Movements are appended in order of pager and page; documents are merged, the first
    of an id staying, upgraded by a later one with a url. The last pager of a kind has the
    footer that this kind's count must meet exactly. A case without later pages is complete
    unless it shows a slider of which no pager could be read.
    """
    paged = cases.select("ca", F.posexplode("pagers").alias("pager", "p")).select("ca", "pager", "p.*").filter("lastPage > currentPage")
    asked = remaining_pages(paged).select("ca", "pager", F.col("formId").alias("form"), "page", "lastPage", "reportedTotal")
    met = asked.join(extras.select("ca", "form", "page", "kind", "read", "movimentacoes", "documentos"), ["ca", "form", "page"], "left").withColumn("read", F.coalesce("read", F.lit(False)))
    row = F.struct("page", "kind", "read", F.when(F.col("read"), F.col("movimentacoes")).alias("movimentacoes"), F.when(F.col("read"), F.col("documentos")).alias("documentos"))
    pagers = met.groupBy("ca", "pager").agg(F.first("lastPage").alias("lastPage"), F.first("reportedTotal").alias("footer"), F.array_sort(F.collect_list(row)).alias("pages"), F.count_if("read").alias("read"), F.count_if(~F.col("read")).alias("failed"))
    pagers = pagers.withColumn("kind", _kind_of(F.col("pages")))
    footer = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.col("footer")), F.when(F.col("kind") == kind, F.col("pager")))
    added = pagers.groupBy("ca").agg(
        F.sum("lastPage").cast("int").alias("_offered"), F.sum(F.col("read") + 1).cast("int").alias("_read"), F.sum("failed").alias("_failed"),
        footer("movements").alias("_movements"), footer("documents").alias("_documents"),
        F.array_sort(F.collect_list(F.struct("pager", "pages"))).alias("_pagers"),
    )
    both = cases.join(added, "ca", "left")
    later = lambda field, empty: F.coalesce(F.flatten(F.flatten(F.transform("_pagers", lambda p: F.transform(F.filter(p["pages"], lambda x: x["read"]), lambda x: x[field])))), empty)
    none = lambda field: F.filter(F.col(field), lambda _: F.lit(False))
    both = both.withColumns({c: F.concat(F.col(c), later(c, none(c))) for c in ("movimentacoes", "documentos")})
    documents = both.select("ca", F.posexplode("documentos").alias("index", "d")).select("ca", "index", "d.*", F.struct("ca", "d.idProcessoDocumento").alias("_key"))
    once = upgrade_documents(documents, "_key", "index", F.col("downloadUrl").isNotNull())
    place = F.struct("index", F.struct(*schemas.DOCUMENT_FIELDS).alias("d"))
    merged = once.groupBy("ca").agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["d"]).alias("_merged"))
    both = both.join(merged, "ca", "left").withColumn("documentos", F.coalesce("_merged", none("documentos")))
    whole = (F.col("_failed") == 0) & (F.col("_movements").isNull() | (F.size("movimentacoes") == F.col("_movements"))) & (F.col("_documents").isNull() | (F.size("documentos") == F.col("_documents")))
    unread = F.col("has_slider") & (F.size("pagers") == 0)
    many = F.col("_offered").isNotNull()
    one = F.lit(1)
    return both.withColumns(
        {"movimentacoesPaginas": F.when(many, F.col("_offered")).otherwise(one), "movimentacoesPaginasLidas": F.when(many, F.col("_read")).otherwise(one), "movimentacoesCompleto": F.when(many, whole).otherwise(~unread)}
    ).select(*[f.name for f in schemas.CASE.fields])
