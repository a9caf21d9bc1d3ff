"""Queries for parsers, sources and sinks: pages, bodies and files are made of the driver's
tables, go through the operators, and must come out as the SQL gives them from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre import schemas, scratch
from lumbre.functions import keys, policy, text
from lumbre.operators import limits, parse
from lumbre.plans import jobs, planner
from lumbre.plans.panels import assemble_cases
from lumbre.sources import sinks, tables
from lumbre.streaming import ingest

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str):
    def register(f):
        _Q[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return register


def _t(spark, sf_dir, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cat(*parts) -> Column:
    """Text literals and columns in a row."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _field(label: str, value) -> Column:
    return _cat(f'<div class="propertyView"><div class="name"><label>{label}</label></div><div class="value">', value, "</div></div>")


def _table(name: str, rows: Column) -> Column:
    return _cat(f'<table id="f:{name}"><tbody id="f:{name}:tb">', rows, "</tbody></table>")


BASE = "https://example.org/case/view"


# --- pages --------------------------------------------------------------------------------


@_query("""
SELECT 'k' || c_custkey AS ca, lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '-11.2020.1.02.0003' AS numero, c_mktsegment AS assunto, '' AS jurisdicao,
  'Turma ' || c_nationkey AS orgao, c_custkey % 10 = 0 AS segredo, c_name || ' - CPF: ' || c_custkey || '-00 (AUTOR)' AS nome, c_custkey || '-00' AS documento, 'AUTOR' AS papel,
  'Rep ' || c_nationkey AS representante, CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS partes,
  '03/09/2023 21:01:15' AS data, CASE WHEN c_custkey % 10 = 0 THEN 'Segredo de Justiça' ELSE c_mktsegment END AS descricao,
  CAST(c_custkey AS VARCHAR) AS doc_id, 'Despacho' AS tipo, '4,62 Kb' AS tamanho, 'Decisão ' || c_nationkey AS arquivo, 'pdf' AS formato,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'https://example.org/d?idBin=8&idProcessoDocumento=' || c_custkey || '&nomeArqProcDocBin=Decis%E3o+' || c_nationkey || '&actionMethod=m' END AS url
FROM customer
""")
def parse_cases(spark, sf_dir):
    """Case pages of customers, parsed; some links are no urls."""
    c = F.col("c_custkey")
    number = _cat(F.lpad(c.cast("string"), 7, "0"), "-11.2020.1.02.0003")
    who = _cat('<tr><td><span class="text-bold">', F.col("c_name"), " - CPF: ", c, '-00 (AUTOR)</span><ul class="tree"><li>Rep ', F.col("c_nationkey"), "</li><li> </li></ul></td><td>Ativo</td></tr>")
    other = F.when(c % 3 == 0, _cat("<tr><td>Outro ", c, "</td></tr>")).otherwise("")
    moved = F.when(c % 10 == 0, "Segredo de Justiça").otherwise(F.col("c_mktsegment"))
    host = F.when(c % 7 == 0, "http://[x").otherwise("/d")
    link = _cat('<tr><td><a title="f (4,62 Kb)" href="', host, "?idBin=8&idProcessoDocumento=", c, "&nomeArqProcDocBin=Decis%E3o+", F.col("c_nationkey"), '&actionMethod=m">04/09/2023 - Ato (Despacho)</a></td></tr>')
    html = _cat(
        "<html><body><p>segredo de justiça</p>", _field("Número Processo", number), _field("Assunto", F.col("c_mktsegment")), _field("Jurisdição", " "),
        _cat('<div class="propertyView"><div class="name"><label></label></div><div class="value"><b>Órgão Julgador Colegiado</b> Turma ', F.col("c_nationkey"), "<br><b>Endereço</b></div></div>"),
        _table("processoPartesPoloAtivoResumidoList", who), _table("processoParteOutrosInteressadosResumidoList", other),
        _table("processoEvento", _cat("<tr><td>03/09/2023 21:01:15 - ", moved, "</td></tr>")), _table("processoDocumentoGridTab", link), "</body></html>",
    )
    pages = parse.spread(_t(spark, sf_dir, "customer")).select(_cat("k", c).alias("key"), F.lit(BASE).alias("url"), html.alias("html"))
    x = tables.case_pages(pages).select("case.*")
    p, m, d = (F.get(F.col(a), F.lit(0)) for a in ("partes", "movimentacoes", "documentos"))
    return x.select(
        "ca", F.col("numeroProcesso").alias("numero"), "assunto", "jurisdicao", F.col("orgaoJulgador").alias("orgao"), F.col("segredoJustica").alias("segredo"),
        p["nome"].alias("nome"), p["documento"].alias("documento"), p["papel"].alias("papel"), F.get(p["representantes"], F.lit(0)).alias("representante"), F.size("partes").cast("long").alias("partes"),
        m["data"].alias("data"), m["descricao"].alias("descricao"), d["idProcessoDocumento"].alias("doc_id"), d["tipo"].alias("tipo"), d["tamanhoTexto"].alias("tamanho"),
        d["nomeArquivo"].alias("arquivo"), d["formato"].alias("formato"), d["downloadUrl"].alias("url"),
    )


@_query("""
WITH o AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 7 = 5 THEN 'failed' WHEN n_nationkey % 7 = 3 THEN 'expired' WHEN n_nationkey % 7 = 1 THEN 'refused' ELSE 'ok' END AS outcome FROM nation)
SELECT 's' || k AS key, outcome, outcome = 'ok' AND k % 2 = 0 AS truncated, CASE WHEN outcome = 'ok' THEN 30 ELSE -1 END AS total,
  CASE outcome WHEN 'ok' THEN 1 WHEN 'failed' THEN -1 ELSE 0 END AS rejected, CASE WHEN outcome = 'refused' THEN 'criterio' END AS message,
  'k' || c_custkey AS ca, 'https://example.org/l.seam?ca=k' || c_custkey AS url, CAST(c_custkey AS VARCHAR) AS interno, CASE WHEN c_custkey IS NOT NULL THEN 'Classe é' END AS classe, 'CX ' || c_name AS titulo,
  c_mktsegment || ' X €' AS partes, CASE WHEN c_custkey IS NOT NULL THEN 'Fim' END AS ultima
FROM o LEFT JOIN customer ON c_nationkey = k AND outcome = 'ok'
""")
def parse_searches(spark, sf_dir):
    """Captured searches, one a nation, with a grid of its customers; bodies are in windows-1252."""
    c, k = F.col("c_custkey"), F.col("n_nationkey")
    row = _cat('<tr><td id="q:processosTable:', c, """:j"><a onclick="openPopUp('C','/l.seam?ca=k""", c, """')">v</a></td><td>Classe \xe9 <a href="#"><b>CX """, F.col("c_name"), "</b></a> ", F.col("c_mktsegment"), " X \x80</td><td>Fim</td></tr>")
    grid = _t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    banner = F.when(k % 2 == 0, '<div class="alert alert-danger">Mostrados somente os 30 primeiros</div>').otherwise("")
    ok = _cat("<html>", banner, '<table id="q:processosTable"><tbody id="q:processosTable:tb">', F.coalesce("rows", F.lit("")), '<tr><td>sem celulas</td></tr></tbody></table><div class="rich-table-footercell">30 resultados encontrados</div></html>')
    html = F.when(k % 7 == 3, "<html></html>").when(k % 7 == 1, '<html><span class="rich-messages-label">criterio</span></html>').otherwise(ok)
    status = F.when(k % 7 == 5, 503).otherwise(200)
    captured = _t(spark, sf_dir, "nation").join(grid, "n_nationkey", "left").select(
        _cat("s", k).alias("key"), F.lit(0).alias("page"), F.lit("u").alias("url"), status.alias("status"), F.lit("text/html; charset=windows-1252").alias("content_type"), F.encode(html, "ISO-8859-1").alias("body")
    )
    found = tables.search_results(tables.captured_text(captured), "https://example.org/")
    r = found.select("key", "outcome", "result", F.explode_outer("result.rows").alias("r"))
    return r.select(
        "key", "outcome", F.coalesce("result.truncated", F.lit(False)).alias("truncated"), F.coalesce("result.total_label", F.lit(-1)).alias("total"), F.coalesce("result.rejected", F.lit(-1)).alias("rejected"), F.col("result.message").alias("message"),
        F.col("r.ca").alias("ca"), F.col("r.detailUrl").alias("url"), F.col("r.internalId").alias("interno"), F.col("r.classeJudicial").alias("classe"), F.col("r.titulo").alias("titulo"),
        F.col("r.partesResumo").alias("partes"), F.col("r.ultimaMovimentacao").alias("ultima"),
    )


def _slider(name: str, last: Column, now: str = "1") -> Column:
    options = f"'sliderValue':'{now}','onchange':'A4J.AJAX.Submit(\\'{name}:f\\',event,{{\\'containerId\\':\\'{name}:c\\',\\'parameters\\':{{\\'{name}:t\\':\\'{name}:t\\'}} }} )'"
    return _cat(f"""<script>new Richfaces.Slider("{name}:i",{{'maxValue':'""", last, f"""',{options}}} )</script>""")


def _supplier_panels(spark, sf_dir) -> DataFrame:
    """Suppliers' captured pages: movements are the kinds of lines that they have, four a page;
    documents the parts of these lines by size, three a page. Some pages never came."""
    lines = _t(spark, sf_dir, "lineitem")
    kinds = lines.select("l_suppkey", _cat(F.col("l_returnflag"), "-", F.col("l_linestatus"), "-", F.col("l_linenumber")).alias("v")).distinct().withColumn("panel", F.lit("movements"))
    sizes = lines.select("l_suppkey", F.lpad((F.col("l_quantity").cast("int") % 11).cast("string"), 2, "0").alias("v")).distinct().withColumn("panel", F.lit("documents"))
    every = kinds.unionByName(sizes).groupBy("l_suppkey", "panel").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    size = F.when(F.col("panel") == "movements", 4).otherwise(3)
    cut = every.withColumn("last", F.ceil(F.size("vs") / size).cast("int")).withColumn("page", F.explode(F.sequence(F.lit(1), F.col("last"))))
    own = F.slice("vs", (F.col("page") - 1) * size + 1, size)
    mark = F.when(F.col("panel") == "movements", "processoEvento").otherwise("processoDocumentoGridTab")
    # The second page of a documents panel shows the last document of the first once more, without its url.
    link = lambda v: _cat('<tr><td><a href="/d?idBin=1&idProcessoDocumento=', v, '&actionMethod=m">04/09/2023 - D', v, "</a></td></tr>")
    again = F.when((F.col("page") == 2) & (F.col("panel") == "documents"), _cat("""<tr><td><a onclick="openPopUp('D','/h?idProcessoDocumento=""", F.get("vs", F.lit(2)), """')">again</a></td></tr>""")).otherwise("")
    rows = F.concat(again, F.array_join(F.transform(own, lambda v: F.when(F.col("panel") == "movements", _cat("<tr><td>03/09/2023 - ", v, "</td></tr>")).otherwise(link(v))), ""))
    return cut.select("l_suppkey", "panel", "page", "last", F.size("vs").alias("n"), F.concat(F.lit('<table id="f:'), mark, F.lit('"><tbody id="f:'), mark, F.lit(':tb">'), rows, F.lit("</tbody></table>")).alias("table"))


_PANEL_SQL = """
WITH v AS (SELECT DISTINCT l_suppkey AS s, 'movements' AS panel, 4 AS size, l_returnflag || '-' || l_linestatus || '-' || l_linenumber AS v FROM lineitem
           UNION SELECT l_suppkey, 'documents', 3, lpad(CAST(CAST(l_quantity AS INT) % 11 AS VARCHAR), 2, '0') FROM lineitem),
n AS (SELECT *, 1 + (row_number() OVER (PARTITION BY s, panel ORDER BY v) - 1) // size AS page, count(*) OVER (PARTITION BY s, panel) AS n FROM v),
p AS (SELECT s, panel, page, max(n) AS n, CAST(ceil(max(n) / CAST(max(size) AS DOUBLE)) AS BIGINT) AS last, string_agg(v, ',' ORDER BY v) AS vs,
             NOT (page > 1 AND (s % 5 = 0 AND page = 2 AND panel = 'movements' OR s % 7 = 0 AND page = 3)) AS came FROM n GROUP BY s, panel, page),
c AS (SELECT s, sum(CASE WHEN page = 1 AND last > 1 THEN last END) AS offered, bool_or(last > 1) AS many, sum(CASE WHEN came AND last > 1 THEN 1 END) AS got, bool_and(came) AS whole,
        string_agg(CASE WHEN panel = 'movements' AND came THEN vs END, ',' ORDER BY page) AS movements, string_agg(CASE WHEN panel = 'documents' AND came THEN vs END, ',' ORDER BY page) AS documents
      FROM p GROUP BY s)
SELECT 'k' || s AS ca, CAST(CASE WHEN many THEN offered ELSE 1 END AS INT) AS pages, CAST(CASE WHEN many THEN got ELSE 1 END AS INT) AS pages_read,
       whole AND s % 11 <> 4 AND s % 13 <> 6 AS complete, movements, documents FROM c
"""


def _supplier_captured(spark, sf_dir) -> DataFrame:
    """The panels as captured responses. Some footers are off by one; some pages come back without a panel."""
    panels = _supplier_panels(spark, sf_dir)
    s = F.col("l_suppkey")
    footer = F.when((s % 11 == 4) & (F.col("panel") == "movements") | (s % 13 == 6) & (F.col("panel") == "documents"), F.col("n") + 1).otherwise(F.col("n"))
    shown = F.concat(F.col("table"), _cat("<span>", footer, " resultados encontrados</span>"), F.when(F.col("panel") == "movements", _slider("mov", F.col("last"))).otherwise(_slider("doc", F.col("last"))))
    first = panels.filter("page = 1").groupBy("l_suppkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.when(F.col("panel") == "movements", 0).otherwise(1).alias("o"), shown.alias("h")))), lambda x: x["h"]), "").alias("h"))
    case = first.select(s.cast("string").alias("key"), F.lit(None).cast("int").alias("page"), _cat('<html><input name="javax.faces.ViewState" value="j1">', F.col("h"), "</html>").alias("html"), F.lit(None).cast("string").alias("form"))
    lost = (s % 5 == 0) & (F.col("page") == 2) & (F.col("panel") == "movements")
    void = (s % 7 == 0) & (F.col("page") == 3)
    ids = F.when(F.col("panel") == "movements", "f:processoEvento").otherwise("f:processoDocumentoX")
    answer = F.when(void, '<html><meta name="Ajax-Response" content="true"></html>').otherwise(_cat('<html><meta name="Ajax-Update-Ids" content="x, ', ids, '">', F.col("table"), "</html>"))
    later = panels.filter(F.col("page") > 1).filter(~lost).select(s.cast("string").alias("key"), "page", answer.alias("html"), F.when(F.col("panel") == "movements", "mov:f").otherwise("doc:f").alias("form"))
    return case.unionByName(later).select(_cat("k", F.col("key")).alias("key"), "page", F.lit(BASE).alias("url"), F.lit(200).alias("status"), F.lit("text/html; charset=utf-8").alias("content_type"), F.encode("html", "UTF-8").alias("body"), "form")


def _case_digest(cases: DataFrame) -> DataFrame:
    return cases.select(
        "ca", F.col("movimentacoesPaginas").alias("pages"), F.col("movimentacoesPaginasLidas").alias("pages_read"), F.col("movimentacoesCompleto").alias("complete"),
        F.array_join(F.transform("movimentacoes", lambda m: m["descricao"]), ",").alias("movements"), F.array_join(F.transform("documentos", lambda d: d["idProcessoDocumento"]), ",").alias("documents"),
    )


@_query(_PANEL_SQL)
def paged_cases(spark, sf_dir):
    """Cases with two paged panels, put together from all their pages."""
    cases, extras, _ = ingest.split_batch(_supplier_captured(spark, sf_dir))
    return _case_digest(assemble_cases(scratch.save(cases, "paged-cases"), scratch.save(extras, "paged-extras")))


@_query(_PANEL_SQL)
def ingested_cases(spark, sf_dir):
    """As ``paged_cases``, by way of the stream and its files, later pages in a batch before their cases."""
    there, out, mark = (scratch.new_path(spark, f"stream-{x}") for x in ("in", "out", "mark"))
    captured = scratch.save(_supplier_captured(spark, sf_dir), "stream-captured")
    for wanted in ("form IS NOT NULL", "form IS NULL"):
        captured.filter(wanted).write.mode("append").parquet(there)
        query = ingest.ingest(spark, there, out, mark)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return _case_digest(ingest.ingested_cases(spark, out))


@_query("""
SELECT p_partkey, p_partkey % 4 <> 0 AS is_ajax, CASE WHEN p_type = p_brand THEN p_type ELSE p_type || '|' || p_brand END AS update_ids, CASE WHEN p_partkey % 3 = 0 THEN 'j' || p_size END AS view_state,
  CASE p_partkey % 3 WHEN 0 THEN 'movements' WHEN 1 THEN 'documents' ELSE 'unknown' END AS kind FROM part
""")
def envelopes(spark, sf_dir):
    """Ajax envelopes: what they update, each id once, and the panel that this names."""
    k = F.col("p_partkey")
    marks = F.when(k % 4 != 0, '<meta name="Ajax-Response" content="true">').otherwise("")
    state = F.when(k % 3 == 0, _cat('<input name="javax.faces.ViewState" value="j', F.col("p_size"), '">')).otherwise("")
    page = F.when(k % 3 == 0, '<div id="a:processoEvento:0"></div>').when(k % 3 == 1, '<table id="a:processoDocumentoGridTab"></table>').otherwise("")
    html = _cat("<html>", marks, '<meta name="Ajax-Update-Ids" content="', F.col("p_type"), ", ,", F.col("p_brand"), ",", F.col("p_type"), '">', state, page, "</html>")
    made = parse.spread(_t(spark, sf_dir, "part")).select("p_partkey", html.alias("html"))
    read = parse.parsed(made, parse.envelope, ["html"], schemas.ENVELOPE, "e")
    read = parse.parsed(read.select("*", "e.update_ids"), parse.panel_kind, ["update_ids", "html"], T.StringType(), "kind")
    return read.select("p_partkey", F.col("e.is_ajax").alias("is_ajax"), F.array_join("update_ids", "|").alias("update_ids"), F.col("e.view_state").alias("view_state"), "kind")


@_query("""
SELECT s_suppkey, form, CAST(coalesce(last, -1) AS INT) AS last, CAST(coalesce(now, -1) AS INT) AS now, coalesce(total, -1) AS total, slider FROM (
  SELECT s_suppkey, 'a:f' AS form, 2 + s_suppkey % 9 AS last, 1 AS now, CAST(s_suppkey * 1000 AS INT) AS total, true AS slider FROM supplier WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT s_suppkey, 'b:f', 3, 3, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE s_suppkey * 1000 END AS INT), true FROM supplier WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL, s_suppkey % 8 = 0 FROM supplier WHERE s_suppkey % 4 = 0)
""")
def pagers(spark, sf_dir):
    """Pagers with the total printed last before them; some pages have sliders that cannot be read, some none."""
    k = F.col("s_suppkey")
    dotted = F.regexp_replace((k * 1000).cast("string"), r"(\d)(?=(\d{3})+$)", "$1.")
    good = _cat('<input name="javax.faces.ViewState" value="j">', dotted, " resultados encontrados", _slider("a", 2 + k % 9), F.when(k % 3 == 0, "7 resultados encontrados").otherwise(""), _slider("b", F.lit(3), "3"), "9 resultados encontrados")
    html = F.when(k % 4 != 0, good).when(k % 8 == 0, '<script>new Richfaces.Slider("x",{})</script>').otherwise("<p>")
    made = parse.spread(_t(spark, sf_dir, "supplier")).select("s_suppkey", html.alias("html"))
    read = parse.parsed(parse.parsed(made, parse.panel_pagers, ["html"], T.ArrayType(schemas.PAGER), "p"), parse.has_slider, ["html"], T.BooleanType(), "slider")
    return read.select("s_suppkey", F.explode_outer("p").alias("p"), "slider").select("s_suppkey", F.col("p.formId").alias("form"), *[F.coalesce(F.col(f"p.{a}"), F.lit(-1)).alias(b) for a, b in (("lastPage", "last"), ("currentPage", "now"), ("reportedTotal", "total"))], "slider")


@_query("""
SELECT n_nationkey, 'a:' || n_nationkey AS script, CASE WHEN n_nationkey % 2 = 0 THEN 'box' || n_nationkey ELSE '' END AS box, 'a:i=' || n_nationkey || '|a:t=a:t' AS form FROM nation
""")
def script_values(spark, sf_dir):
    """Ids in scripts, a guard that passes, and the request for a panel's page."""
    k = F.col("n_nationkey")
    box = F.when(k % 2 == 0, _cat("new RichFaces.Suggestion('a','b','box", k, "')")).otherwise("")
    html = _cat('<input name="javax.faces.ViewState" value="j">go=function(){x(\'parameters\':{\'a:', k, "':'a'})} function executarReCaptcha(){ if (false) {}}", box, _slider("a", k + 2))
    made = _t(spark, sf_dir, "nation").select("n_nationkey", html.alias("html"))
    kind = T.StructType([T.StructField(c, T.StringType()) for c in ("script", "box", "form")])
    return parse.parsed(made.withColumn("page", k.cast("string")), _script_values, ["html", "page"], kind, "p").select("n_nationkey", "p.*")


def _script_values(html: str, page: str) -> dict:
    parse.require_no_captcha(html)
    form = parse.page_form(parse.panel_pagers(html)[0], int(page))
    return {"script": parse.script_function_id(html, "go"), "box": parse.suggestion_box_id(html), "form": f"a:i={form['a:i']}|a:t={form['a:t']}"}


# --- files --------------------------------------------------------------------------------


@_query("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment, false AS rejected FROM customer
UNION ALL SELECT -1, 'broken ' || n_name || '{', NULL, true FROM nation
""")
def json_lines(spark, sf_dir):
    """Rows appended to a JSON Lines table and read back, with lines that are none."""
    path = scratch.new_path(spark, "lines")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"))
    sinks.append_json(rows.filter("c_custkey % 2 = 0"), path)
    sinks.append_json(rows.filter("c_custkey % 2 = 1"), path)
    _t(spark, sf_dir, "nation").select(_cat("broken ", F.col("n_name"), "{").alias("value")).union(spark.createDataFrame([("  ",)], "value string")).write.mode("append").text(path)
    good, bad = tables.read_json_lines(spark, path, rows.schema)
    return good.withColumn("rejected", F.lit(False)).unionByName(bad.select(F.lit(-1).cast("long").alias("c_custkey"), F.col("line").alias("c_name"), F.lit(None).cast("string").alias("segment"), F.lit(True).alias("rejected")))


@_query('''
SELECT p_partkey || ',' || CASE p_partkey % 4 WHEN 0 THEN '"' || p_name || ', ""x""' || '"' WHEN 1 THEN '' WHEN 2 THEN '  ' || p_type || ' ' ELSE p_type END
       || ',"[""' || p_brand || '"",' || p_size || ']",true' AS line FROM part
UNION ALL SELECT 'p_partkey,nome,lista,sim'
''')
def csv_lines(spark, sf_dir):
    """Cells as they stand in a CSV file: quoted only where needed, untrimmed, null empty, arrays as JSON."""
    path, k = scratch.new_path(spark, "csv"), F.col("p_partkey")
    name = F.when(k % 4 == 0, _cat(F.col("p_name"), ', "x"')).when(k % 4 == 2, _cat("  ", F.col("p_type"), " ")).when(k % 4 == 3, F.col("p_type"))
    listed = F.concat(F.lit('["'), F.col("p_brand"), F.lit('",'), F.col("p_size").cast("string"), F.lit("]"))
    rows = _t(spark, sf_dir, "part").select("p_partkey", name.alias("nome"), listed.alias("lista"), F.lit(True).alias("sim"))
    sinks.write_csv(rows, path, 1)
    return spark.read.text(path).select(F.col("value").alias("line"))


@_query("""
SELECT 'n' || c_custkey AS "numeroProcesso", c_mktsegment AS "classeJudicial", CAST(count(o_orderkey) AS INT) AS "qtdDocumentos", CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS "qtdPartes", 0 AS "qtdMovimentacoes"
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""")
def export_cases_job(spark, sf_dir):
    """The job's columns of cases, with the sizes of nested arrays; a null array counts 0."""
    x = _nested_cases(spark, sf_dir)
    return jobs.export_cases(x).select("numeroProcesso", "classeJudicial", "qtdDocumentos", "qtdPartes", "qtdMovimentacoes")


def _nested_cases(spark, sf_dir) -> DataFrame:
    doc = F.struct(*[(F.col("o_orderkey").cast("string") if c == "idProcessoDocumento" else F.col("o_orderpriority") if c == "rotulo" else F.lit("pdf") if c == "formato" else F.lit(None).cast("string")).alias(c) for c in schemas.DOCUMENT_FIELDS])
    docs = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", doc.alias("d")))), lambda z: z["d"]).alias("documentos"))
    party = F.struct(*[(F.col("c_name") if c == "nome" else F.lit("ativo") if c == "polo" else F.lit(None).cast(schemas.PARTY[c].dataType)).alias(c) for c in schemas.PARTY.names])
    rows = _t(spark, sf_dir, "customer").join(docs, "c_custkey", "left")
    own = {"numeroProcesso": _cat("n", F.col("c_custkey")), "ca": _cat("k", F.col("c_custkey")), "classeJudicial": F.col("c_mktsegment"), "partes": F.when(F.col("c_custkey") % 2 == 0, F.array(party)), "documentos": F.col("documentos")}
    return rows.select(*[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.CASE.fields])


@_query("""
WITH d AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, max_by('f' || l_partkey || '.pdf', (l_shipdate, 'f' || l_partkey || '.pdf')) AS path FROM lineitem GROUP BY 1)
SELECT 'n' || o_custkey AS "numeroProcesso", CAST(o_orderkey AS VARCHAR) AS "idProcessoDocumento", 'pdf' AS formato, path AS "arquivoLocal" FROM orders LEFT JOIN d ON id = CAST(o_orderkey AS VARCHAR)
""")
def export_documents_job(spark, sf_dir):
    """The job's rows of documents: case fields handed down, the path of the latest download joined."""
    docs = sinks.document_rows(_nested_cases(spark, sf_dir))
    log = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("idProcessoDocumento"), _cat("f", F.col("l_partkey"), ".pdf").alias("arquivoLocal"), F.col("l_shipdate").alias("downloadedAt"))
    return jobs.export_documents(docs, log).select("numeroProcesso", "idProcessoDocumento", "formato", "arquivoLocal")


@_query("""
SELECT CASE WHEN user_id % 2 = 0 THEN 'pdf:' ELSE 'detail:' END || user_id AS key, max_by('e' || event_id, event_id) AS error, CAST(max_by(event_id % 4, event_id) AS INT) AS attempts FROM events
WHERE event_type = 'error' AND (user_id % 2 = 0 OR user_id % 3 <> 0) AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 95) GROUP BY user_id
""")
def failures_table(spark, sf_dir):
    """Dead letters rewritten line by line: the later line of a key wins, cleared keys go, those
    without what a replay needs are left out."""
    path, u = scratch.new_path(spark, "failures"), F.col("user_id")
    events = _t(spark, sf_dir, "events")
    key = _cat(F.when(u % 2 == 0, "pdf:").otherwise("detail:"), u)
    context = F.when(u % 2 == 0, '{"document":{},"numeroProcesso":"1"}').when(u % 3 != 0, '{"summary":{}}').otherwise("{}")
    own = {"kind": F.when(u % 2 == 0, "pdf").otherwise("detail"), "key": key, "error": _cat("e", F.col("event_id")), "attempts": (F.col("event_id") % 4).cast("int"), "context": context}
    rows = events.filter("event_type = 'error'").orderBy("event_id").coalesce(1).select(*[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.FAILURE.fields])
    sinks.append_json(rows, path)
    done = events.filter("event_type = 'purchase' AND value > 95").select(key.alias("key"))
    sinks.rewrite(jobs.clear_failures(tables.read_failures(spark, path), done), path)
    left = jobs.replayable(tables.read_failures(spark, path))
    return left.select("key", "error", "attempts")


@_query("""
SELECT CAST(count(*) AS BIGINT) AS searches, CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS ok, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed,
  CAST(count(*) FILTER (WHERE value > 90) AS BIGINT) AS saturated, CAST((SELECT count(*) FROM customer) AS BIGINT) AS cases, CAST((SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS BIGINT) AS partial_cases,
  CAST((SELECT sum(l_quantity) FROM lineitem) AS BIGINT) AS bytes, CAST((SELECT count(DISTINCT user_id) FROM events) AS BIGINT) AS pending_failures FROM events
""")
def run_report(spark, sf_dir):
    """A run's counts by the report job."""
    e = _t(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "view", "ok").when(F.col("event_type") == "error", "failed").otherwise("other")
    cases = _t(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 == 0, False).when(F.col("c_custkey") % 3 == 1, True).alias("movimentacoesCompleto"))
    told = jobs.report(e.select(outcome.alias("outcome"), (F.col("value") > 90).alias("saturated")), cases, _t(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("long").alias("bytes")), e.select("user_id").distinct())
    names = ("searches", "ok", "failed", "saturated", "cases", "partial_cases", "bytes", "pending_failures")
    return spark.createDataFrame([tuple(int(told[n]) for n in names)], ", ".join(f"{n} long" for n in names))


@_query("""
WITH s AS (SELECT CAST(c_custkey // 3 AS VARCHAR) AS ca, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment || c_custkey // 5 END AS num, c_name AS nome FROM customer),
u AS (SELECT * FROM s WHERE ca NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AND num NOT IN (SELECT 'BUILDING' || s_suppkey FROM supplier)),
a AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY ca ORDER BY num, nome) = 1)
SELECT * FROM a WHERE num <> '' QUALIFY row_number() OVER (PARTITION BY num ORDER BY ca, nome) = 1 UNION ALL SELECT * FROM a WHERE num = ''
""")
def new_cases_once(spark, sf_dir):
    """Search rows of cases not seen yet, each once by key and by number."""
    c = F.col("c_custkey")
    third, fifth = F.floor(c / 3).cast("long"), F.floor(c / 5).cast("long")
    rows = _t(spark, sf_dir, "customer").select(third.cast("string").alias("ca"), F.when(c % 11 == 0, "").otherwise(_cat(F.col("c_mktsegment"), fifth)).alias("numeroProcesso"), F.col("c_name").alias("nome"))
    seen = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ca"), F.lit(None).cast("string").alias("numeroProcesso"))
    named = _t(spark, sf_dir, "supplier").select(F.lit(None).cast("string").alias("ca"), _cat("BUILDING", F.col("s_suppkey")).alias("numeroProcesso"))
    return jobs.new_cases(rows, seen.unionByName(named)).select("ca", F.col("numeroProcesso").alias("num"), "nome")


@_query("""
SELECT CAST(n_nationkey AS VARCHAR) AS codigo, CASE WHEN n_nationkey % 2 = 0 THEN 'é' ELSE 'E' END || n_name AS nome,
  CAST(row_number() OVER (ORDER BY 'e' || lower(n_name)) AS BIGINT) AS ordem FROM nation WHERE n_nationkey % 6 <> 5
""")
def class_catalogue(spark, sf_dir):
    """A class catalogue: cells of a suggestion table pivoted, saved in Portuguese order and read back."""
    from pyspark.sql import Window

    k = F.col("n_nationkey")
    name = _cat(F.when(k % 2 == 0, "é").otherwise("E"), F.col("n_name"))
    second = F.when(k % 6 != 5, _cat('<td id="s:', k, ':b"> ', name, " </td>")).otherwise("")
    row = _cat('<tr><td id="s:', k, ':a">', k, "</td>", second, "</tr>")
    html = _t(spark, sf_dir, "nation").agg(_cat('<table id="f:suggest">', F.array_join(F.collect_list(row), ""), "</table>").alias("html"))
    found = parse.parsed(html, parse.class_catalogue, ["html"], T.ArrayType(schemas.JUDICIAL_CLASS), "c").select(F.explode("c").alias("c")).select("c.*")
    path = scratch.new_path(spark, "classes")
    tables.write_catalogue(found, path)
    saved = tables.read_catalogue(spark, path)
    # A catalogue is a few hundred rows; one task numbers them.
    return saved.withColumn("ordem", F.row_number().over(Window.orderBy(F.collate("nome", "pt"))).cast("long"))


@_query("""
SELECT 'k' || c_custkey AS ca, CASE WHEN c_custkey % 2 = 0 THEN 'i' || c_nationkey END AS "internalId", CASE WHEN c_custkey % 2 = 0 THEN c_name END AS "partesResumo" FROM customer
""")
def merged_summaries(spark, sf_dir):
    """Cases with what their search row knew."""
    c = F.col("c_custkey")
    found = _t(spark, sf_dir, "customer").filter(c % 2 == 0).select(_cat("k", c).alias("ca"), _cat("i", F.col("c_nationkey")).alias("internalId"), F.lit(None).cast(schemas.CRITERIA).alias("foundBy"), F.col("c_name").alias("partesResumo"), F.lit("x").alias("ultimaMovimentacao"))
    return sinks.with_summary(_t(spark, sf_dir, "customer").select(_cat("k", c).alias("ca")), found).select("ca", "internalId", "partesResumo")


# --- values -------------------------------------------------------------------------------


@_query("""
SELECT event_id, CAST(CASE event_id % 8 WHEN 0 THEN 5000 WHEN 1 THEN 7000 WHEN 5 THEN 60000 WHEN 6 THEN 0 ELSE -1 END AS BIGINT) AS espera FROM events
""")
def retry_after_headers(spark, sf_dir):
    """Whole seconds and HTTP dates, in GMT; nothing else counts."""
    forms = ["5", " 7 ", "1.5", "1e3", "-4", "Fri, 01 Mar 2024 10:01:00 GMT", "Thu, 29 Feb 2024 10:00:00 GMT", "soon"]
    header = F.element_at(F.array(*[F.lit(x) for x in forms]), (F.col("event_id") % 8 + 1).cast("int"))
    now = F.to_timestamp(F.lit("2024-03-01 10:00:00 +0000"), "yyyy-MM-dd HH:mm:ss Z")
    return _t(spark, sf_dir, "events").select("event_id", F.coalesce(policy.retry_after_ms(header, now), F.lit(-1).cast("long")).alias("espera"))


@_query("SELECT p_partkey, p_name || ' ' || CASE p_partkey % 7 WHEN 0 THEN '€' WHEN 1 THEN '€' WHEN 2 THEN 'é' WHEN 3 THEN 'é' WHEN 4 THEN 'Ж' WHEN 5 THEN 'é' ELSE 'ã' END AS corpo FROM part")
def charset_bodies(spark, sf_dir):
    """Bodies decoded by the charset of their header."""
    forms = [("80", "text/html; charset=windows-1252"), ("A4", 'text/html; charset="ISO-8859-15"'), ("C3A9", "text/html"), ("E9", "text/html;charset=latin1"), ("C6", "text/html; charset=windows-1251"), ("C3A9", "text/html; charset=nobody-knows"), ("E3", "text/html; charset=Windows-1252")]
    at = (F.col("p_partkey") % 7 + 1).cast("int")
    raw = F.concat(F.encode(_cat(F.col("p_name"), " "), "UTF-8"), F.unhex(F.element_at(F.array(*[F.lit(x) for x, _ in forms]), at)))
    raw = F.when(F.lit(True), raw)
    return _t(spark, sf_dir, "part").select("p_partkey", text.decode_body(raw, F.element_at(F.array(*[F.lit(y) for _, y in forms]), at)).alias("corpo"))


@_query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Decisão ' || p_size || '.pdf' WHEN 1 THEN 'a' || p_size || '.pdf' WHEN 2 THEN 'São ' || p_size ELSE NULL END AS nome, 'v' || p_size AS tipo FROM part
""")
def header_names(spark, sf_dir):
    """File names in headers: extended, plain, and UTF-8 that was read as ISO-8859-1."""
    k, s = F.col("p_partkey"), F.col("p_size")
    value = F.when(k % 4 == 0, _cat("attachment; filename=\"x\"; filename*=UTF-8''Decis%C3%A3o%20", s, ".pdf")).when(k % 4 == 1, _cat('attachment; filename="a', s, '.pdf"')).when(k % 4 == 2, _cat("attachment; filename=S\xc3\xa3o ", s)).otherwise("inline")
    headers = text.normal_headers(F.create_map(F.lit("Content-Disposition"), value, F.lit("X-Kind"), _cat("v", s), F.lit("X-None"), F.lit(None).cast("string")))
    return _t(spark, sf_dir, "part").select("p_partkey", headers.alias("h")).select("p_partkey", text.header_filename(F.col("h")["content-disposition"]).alias("nome"), F.col("h")["x-kind"].alias("tipo"))


@_query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '/l?ca=k' || c_custkey || '&x=1' WHEN 1 THEN NULL ELSE NULL END AS popup,
  CASE c_custkey % 3 WHEN 2 THEN '/h?ca=k' || c_custkey WHEN 0 THEN '/l?ca=k' || c_custkey || '&amp;x=1' ELSE 'about:blank' END AS caminho, CASE c_custkey % 3 WHEN 1 THEN NULL ELSE 'k' || c_custkey END AS ca,
  c_name AS primeiro, CAST(c_nationkey AS VARCHAR) AS interno, 'nomeParte=' || c_name || ' classeJudicial=' || c_mktsegment AS resumo,
  'a' || c_custkey AS escolhido, 'b' || c_custkey AS aproximado, lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '-11.2020.1.02.0003' AS numero
FROM customer
""")
def handler_values(spark, sf_dir):
    """Urls in handlers, keys in paths, first values, labels of criteria, picks from maps."""
    c = F.col("c_custkey")
    handler = F.when(c % 3 == 0, _cat("openPopUp('x', '/l?ca=k", c, "&amp;x=1')")).when(c % 3 == 1, "openPopUp('x','about:blank')")
    href = F.when(c % 3 == 2, _cat("/h?ca=k", c)).otherwise("#")
    path = text.detail_path(F.coalesce(handler, F.lit("")), href)
    criteria = F.struct(F.col("c_name").alias("nomeParte"), F.lit("").alias("ufOAB"), F.col("c_mktsegment").alias("classeJudicial"))
    fields = F.create_map(F.lit("Orgao Julgador Colegiado"), _cat("b", c), F.lit("Numero"), _cat("a", c), F.lit("Vazio"), F.lit(""))
    number = _cat("Processo ", F.lpad(c.cast("string"), 7, "0"), "-11.2020.1.02.0003 x")
    return _t(spark, sf_dir, "customer").select(
        "c_custkey", text.popup_url(handler).alias("popup"), path.alias("caminho"), text.case_key(path).alias("ca"),
        text.first_non_empty(F.array(F.lit(None).cast("string"), F.lit(" \t"), _cat(" ", F.col("c_name"), "\n"), F.lit("z"))).alias("primeiro"),
        text.internal_id(_cat("q:processosTable:", F.col("c_nationkey"), ":j")).alias("interno"), keys.describe(criteria, ["nomeParte", "ufOAB", "classeJudicial"]).alias("resumo"),
        text.pick(fields, "Nada", "Numero", "Vazio").alias("escolhido"), text.pick_starting(fields, "Orgao Julgador").alias("aproximado"), text.process_number(number).alias("numero"),
    )


@_query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'pdf' ELSE 'html' END AS formato, row_number() OVER () AS rid FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM d WHERE formato = 'pdf' AND l_partkey % 3 <> 0
      AND CAST(l_partkey AS VARCHAR) NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 40))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE l_partkey % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'not a pdf' WHEN 2 THEN 'too large' END AS problema FROM p WHERE rn <= 2
""")
def pdf_checks(spark, sf_dir):
    """PDF documents with a url that are not downloaded yet, two a case, and what is wrong with their bodies."""
    k = F.col("l_partkey")
    index = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    docs = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", k.cast("string").alias("idProcessoDocumento"), index.alias("index"), F.when(F.col("l_returnflag") == "R", "pdf").otherwise("html").alias("formato"), F.when(k % 3 != 0, _cat("/d", k)).alias("downloadUrl")
    )
    done = _t(spark, sf_dir, "part").filter("p_size > 40").select(F.col("p_partkey").cast("string").alias("idProcessoDocumento"))
    wanted = limits.to_download(docs, done, "l_orderkey", 2)
    body = F.when(k % 5 == 0, F.lit(b"")).when(k % 5 == 1, F.lit(b"<html>")).when(k % 5 == 2, F.lit(b"%PDF-1.4 and more of it")).otherwise(F.lit(b"%PDF-1.4"))
    kind = F.when(k % 5 == 1, "text/html").when(k % 5 == 2, "application/PDF")
    return wanted.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", limits.pdf_problem(body, kind, 16).alias("problema"))


# --- plans --------------------------------------------------------------------------------

_NULL_CLASS = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END"
_NULL_DAY = "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END"
_NULL_SQL = f"""
WITH o AS (SELECT o_orderkey, {_NULL_DAY} AS d, {_NULL_CLASS} AS k FROM orders),
y AS (SELECT d, count(*) AS n FROM o WHERE d IS NOT NULL GROUP BY d),
z AS (SELECT o.*, y.n AS day_n, count(*) OVER (PARTITION BY o.d, o.k) AS class_n, row_number() OVER (PARTITION BY o.d, o.k ORDER BY o_orderkey) AS class_rn,
             row_number() OVER (PARTITION BY o.d ORDER BY o_orderkey) AS day_rn FROM o JOIN y ON y.d = o.d)
"""


def _nullish(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 97 != 0, F.col("o_orderdate").cast("date")).alias("d"), F.when(k % 4 != 0, F.col("o_orderpriority")).alias("k"))


@_query(_NULL_SQL + "SELECT o_orderkey, CASE WHEN day_n < 3 OR class_n < 3 THEN 'COMPLETE' ELSE 'SATURATED' END AS status FROM z WHERE day_n < 3 OR class_rn <= 3 OR class_n < 3")
def harvest_null_class(spark, sf_dir):
    """Rows without a class have a leaf of their own on days that are dealt out by class."""
    rows = _nullish(spark, sf_dir)
    return planner.harvest(rows, planner.plan_cells(rows, "d", "k", 3), "d", "k", ["o_orderkey"], 3).select("o_orderkey", "status")


@_query(_NULL_SQL + "SELECT o_orderkey, CASE WHEN day_n < 3 THEN 'COMPLETE' ELSE 'SATURATED' END AS status FROM z WHERE day_rn <= 3")
def harvest_no_class_axis(spark, sf_dir):
    """Without a class axis a saturated day yields the cap once, whatever classes it holds."""
    rows = _nullish(spark, sf_dir)
    return planner.harvest(rows, planner.plan_cells(rows, "d", "k", 3, split_class=False), "d", "k", ["o_orderkey"], 3).select("o_orderkey", "status")


@_query(_NULL_SQL + """
SELECT 'UNCOVERED' AS status, false AS unclassed, CAST(count(*) AS BIGINT) AS rows FROM o WHERE d IS NULL
UNION ALL SELECT CASE WHEN day_n < 3 OR class_n < 3 THEN 'COMPLETE' ELSE 'SATURATED' END, day_n >= 3 AND k IS NULL, CAST(count(*) AS BIGINT) FROM z GROUP BY ALL
""")
def plan_covers_all_rows(spark, sf_dir):
    """What a plan's leaves hold, by status; rows without a day are counted as not covered."""
    plan = planner.plan_cells(_nullish(spark, sf_dir), "d", "k", 3)
    return plan.filter("status != 'SUBDIVIDED'").groupBy("status", "unclassed").agg(F.sum("n").alias("rows")).filter("rows > 0")


def searches_left(spark, sf_dir):
    """A plan of which 50 searches were made: the rest stays open."""
    from lumbre.queries import _plan

    return planner.search_budget(_plan(spark, sf_dir, 30), 50)


@_query("SELECT c_custkey, (SELECT count(*) > 100 FROM customer) AS more FROM customer ORDER BY c_custkey LIMIT 100")
def first_cases(spark, sf_dir):
    """The first hundred cases, and that there are more."""
    cut, more = limits.bounded(_t(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], 100)
    return cut.withColumn("more", F.lit(more))


def queries() -> dict:
    return {**_Q, "searches_left": searches_left}


def oracle_sql() -> dict[str, str]:
    from lumbre.queries import _PLAN_SQL

    left = _PLAN_SQL.format(cap=30) + """SELECT start, "end", class, unclassed, depth, n,
      CASE WHEN row_number() OVER (ORDER BY start NULLS LAST, "end" DESC, depth, class NULLS LAST) > 50 THEN 'OPEN' ELSE status END AS status FROM p"""
    return {**_SQL, "searches_left": left}
