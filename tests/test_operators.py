import json
import os
import random
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lumbre import queries, schemas
from lumbre.components import connected_components
from lumbre.operators import dedup, dom, joins, limits, parse, reconcile
from lumbre.plans import jobs, planner
from lumbre.sources import sinks, tables
from lumbre.streaming import ingest

PAGE = """<html><body><div class="propertyView"><div class="name"><label>Número Processo</label></div><div class="value">0001223-51.2020.1.02.0003</div></div>
<div class="propertyView"><div class="name"><label>Assunto</label></div><div class="value"> </div></div>
<div class="propertyView"><div class="name"><label></label></div><div class="value"><b>Órgão Julgador Colegiado</b> Turma A<br><b>Endereço</b></div></div>
<table id="x:processoPartesPoloAtivoResumidoList"><tbody id="x:processoPartesPoloAtivoResumidoList:tb"><tr><td><span class="text-bold">Ana Um - CPF: 111.222.333-44 (AUTOR)</span>
<ul class="tree"><li>Rep Dois</li><li> </li></ul></td><td>Ativo</td></tr></tbody></table>
<table id="x:processoEvento"><tbody id="x:processoEvento:tb"><tr><td>03/09/2023 21:01:15 - Juntada</td><td><a href="/d?idBin=7&idProcessoDocumento=70&nomeArqProcDocBin=Decis%E3o&actionMethod=m"><span class="sr-only">Visualizar</span></a></td></tr>
<tr><td>sem data</td></tr></tbody></table><span>2 resultados encontrados</span>
<input name="javax.faces.ViewState" value="j_id3">
<table id="x:processoDocumentoGridTab"><tbody id="x:processoDocumentoGridTab:tb"><tr><td><a title="f (4,62 Kb)" href="/d?idBin=8&idProcessoDocumento=80&actionMethod=m">04/09/2023 - Ato (Despacho)</a></td></tr></tbody></table>
<span>1.030 resultados encontrados</span>
<script>new Richfaces.Slider("f:1:2",{'maxValue':'3','sliderValue':'1','onchange':'A4J.AJAX.Submit(\\'f:1\\',event,{\\'containerId\\':\\'f:0\\',\\'parameters\\':{\\'f:1:3\\':\\'f:1:3\\'} } )'} )</script></body></html>"""

GRID = """<html><head><meta name="Ajax-Response" content="true"><meta name="Ajax-Update-Ids" content="a, b,a"></head><body><div class="alert alert-danger">somente os 30 primeiros</div>
<table id="q:processosTable"><tbody id="q:processosTable:tb"><tr><td id="q:processosTable:77:j"><a onclick="openPopUp('C','/l.seam?ca=k1')">v</a></td>
<td>Classe X <a href="#"><b>CX 0001223-51.2020.1.02.0003 - Tema</b></a> Ana X Beto</td><td>Fim</td></tr><tr><td>só uma</td></tr><tr><td>a</td><td>sem link</td></tr></tbody></table>
<div class="rich-table-footercell">30 resultados encontrados</div></body></html>"""


def test_case_page():
    case = parse.case_page(PAGE, "k1", "https://e.org/c")
    assert case["dadosProcesso"] == {"Numero Processo": "0001223-51.2020.1.02.0003", "Assunto": "", "Orgao Julgador Colegiado": "Turma A"}
    assert case["assunto"] == "" and case["jurisdicao"] is None and case["orgaoJulgador"] == "Turma A"
    (person,) = case["partes"]
    assert (person["documento"], person["papel"], person["situacao"], person["representantes"]) == ("111.222.333-44", "AUTOR", "Ativo", ["Rep Dois"])
    assert [(m["data"], m["descricao"]) for m in case["movimentacoes"]] == [("03/09/2023 21:01:15", "Juntada"), (None, "sem data")]
    grid, moved = case["documentos"]
    assert (grid["idProcessoDocumento"], grid["tipo"], grid["tamanhoTexto"], grid["formato"]) == ("80", "Despacho", "4,62 Kb", "pdf")
    assert (moved["nomeArquivo"], moved["rotulo"], moved["downloadUrl"][:16]) == ("Decisão", "03/09/2023 21:01:15 - Juntada", "https://e.org/d?")


def test_search_page():
    got = parse.search_result(GRID, "https://e.org/x")
    assert got["has_grid"] and got["truncated"] and got["total_label"] == 30 and got["rejected"] == 2
    (row,) = got["rows"]
    assert (row["internalId"], row["ca"], row["classeJudicial"], row["partesResumo"], row["detailUrl"]) == ("77", "k1", "Classe X", "Ana X Beto", "https://e.org/l.seam?ca=k1")
    assert parse.search_result("<html></html>", "https://e.org")["has_grid"] is False
    assert parse.envelope(GRID) == {"is_ajax": True, "update_ids": ["a", "b"], "view_state": None}


def test_pagers():
    (pager,) = parse.panel_pagers(PAGE)
    assert (pager["formId"], pager["triggerId"], pager["containerId"], pager["lastPage"], pager["reportedTotal"]) == ("f:1", "f:1:3", "f:0", 3, 1030)
    broken = PAGE.replace("containerId", "x")
    assert parse.panel_pagers(broken) == [] and parse.has_slider(broken) and not parse.has_slider("<p>")
    assert parse.extra_page(PAGE, "https://e.org/")["kind"] == "movements"
    assert parse.extra_page("<html></html>", "https://e.org/")["read"] is False
    assert parse.page_form(pager, 2)["f:1:2"] == "2"


def test_small_parsers():
    assert parse.script_function_id("go=function(){x('parameters':{'a:b':'a:b'})}", "go") == "a:b"
    with pytest.raises(ValueError):
        parse.script_function_id("", "go")
    with pytest.raises(ValueError):
        parse.require_no_captcha("function executarReCaptcha(){ if (true) {}}")
    parse.require_no_captcha("function executarReCaptcha(){ if (false) {}}")
    assert parse.suggestion_box_id("new RichFaces.Suggestion('a','b','c')") == "c" and parse.suggestion_box_id("") == ""
    table = '<table id="f:suggest"><tr><td id="s:0:a">12</td><td id="s:0:b"> Classe  A </td></tr><tr><td id="s:1:a">13</td></tr></table>'
    assert parse.class_catalogue(table) == [{"codigo": "12", "nome": "Classe A"}]
    assert parse.panel_kind(["x:processoDocumentoY"], "") == "documents"


def test_pages_of_one_file_are_parsed_by_all_cores(spark, sf_dir):
    """a packed file of narrow rows is one task, and held all pages of ``parse_cases``."""
    at = queries.queries()["parse_cases"](spark, sf_dir).select(F.spark_partition_id().alias("at"), "ca", "doc_id")
    assert at.select("at").distinct().count() >= spark.sparkContext.defaultParallelism


def test_pages_do_not_come_back_from_the_parser(spark):
    rows = spark.createDataFrame([("a", "7", "u"), ("b", None, "v")], "key string, html string, url string")
    got = parse.parsed(rows, int, ["html"], schemas.L, "p", without=["html", "url"])
    assert got.columns == ["key", "p"] and {tuple(r) for r in got.collect()} == {("a", 7), ("b", None)}


def _content(node):
    """Tags, attributes and text in order; how text is cut does not count."""
    out = []
    for c in node.children:
        if isinstance(c, dom.Node):
            out.append((c.tag, c.attrs, _content(c)))
        elif out and isinstance(out[-1], str):
            out[-1] += c
        else:
            out.append(c)
    return out


def test_plain_pages_have_the_tokenizers_tree():
    bits = ["<p>", "</p>", "<div id='x:y' class=\"a b\">", "</div>", "a & b", "&notit;", "&", "<", "<br/>", "<br>", "<li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<script>", "</script>", "<script>x && '</p>' &lt;</script>", "<script><!-- </script>", "<title>a &amp; b</title>"]
    bits += ["<textarea>", "</textarea>", "<!-- c -->", "<!---->", "<!-- a -- b -->", "<!doctype html>", "<a href=\"/d?a=1&idB=2&notx=3&copy=4\">", "</A>", "<a b=c>", "<a b = \"c\">", "<a b=\"c\"d=\"e\">", "<a b=\">\">", "</ a>", "</a >", "<div/>", "<script/>", "<STYLE>a&amp;</style >", "<noscript>", "<xmp>&amp;", "</xmp>", "é\xa0€\n"]
    draw, plain = random.Random(3), 0
    for _ in range(4000):
        page = "".join(draw.choice(bits) for _ in range(draw.randint(1, 7)))
        whole = dom._tokenized(page)
        assert _content(dom.parse(page)) == _content(whole), page
        assert [n.tag for n in whole.walk()] == [n.tag for n in dom.parse(page).walk()]
        plain += dom._plain(page) is not None
    assert plain > 400
    root = dom.parse("<ul><li>a<b>b</b><li>c</ul><p>d")
    assert [[x.tag for x in n.walk()] for n in root.walk()] == [["li", "b", "li"], ["b"], [], [], []]


def test_dedup(spark):
    rows = spark.createDataFrame([("a", 1, None, "html", "x"), ("a", 2, "u", "pdf", None), ("b", 3, "v", "pdf", "y"), ("b", 4, "w", "pdf", "z")], "k string, seq int, downloadUrl string, formato string, idBin string")
    got = dedup.upgrade_documents(rows, "k", "seq", F.col("downloadUrl").isNotNull(), if_set=("idBin",)).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 1, "u", "pdf", "x"), ("b", 3, "v", "pdf", "y")]
    assert {r["k"]: r["seq"] for r in dedup.first_wins(rows, ["k"], "seq").collect()} == {"a": 1, "b": 3}
    assert {r["k"]: r["seq"] for r in dedup.last_wins(rows, ["k"], "seq").collect()} == {"a": 2, "b": 4}
    once = dedup.first_wins(rows, ["k"], "seq")
    assert sorted(dedup.first_wins(once, ["k"], "seq").collect()) == sorted(once.collect())
    blank = spark.createDataFrame([("k", "", 1), ("k", "v", 2), ("k", "", 3), ("j", "", 1)], "k string, v string, seq int")
    assert {r["k"]: r["v"] for r in dedup.non_empty_wins(blank, ["k"], "v", "seq").collect()} == {"k": "v", "j": ""}
    assert dedup.first_wins(rows.limit(0), ["k"], "seq").count() == 0


def test_failures(spark):
    rows = spark.createDataFrame([("detail:1", "e1", 1), ("detail:1", "e2", 2)], "key string, error string, seq int")
    (r,) = dedup.upsert_failures(rows).collect()
    assert (r["error"], r["attempts"]) == ("e2", 2)
    made = [("detail", "detail:1", "t", "old", None, 2, None, '{"summary":{}}'), ("pdf", "pdf:2", "t", "old", None, 1, None, '{"document":{}}')]
    failures = spark.createDataFrame(made, schemas.FAILURE)
    assert [r["key"] for r in jobs.replayable(failures).collect()] == ["detail:1"]
    again = spark.createDataFrame([("pdf:2", "new", None)], "key string, error string, lastAttemptAt timestamp")
    left = jobs.replay(failures, spark.createDataFrame([("detail:1",)], "key string"), again)
    assert [(r["key"], r["error"], r["attempts"]) for r in left.collect()] == [("pdf:2", "new", 2)]


def test_unseen_and_union(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", ""), ("d", None)], "ca string, numeroProcesso string")
    seen = spark.createDataFrame([("a", "9"), ("z", "2"), ("y", "")], "ca string, numeroProcesso string")
    assert sorted(r["ca"] for r in joins.unseen(rows, seen, ["ca", "numeroProcesso"]).collect()) == ["c", "d"]
    twice = rows.union(spark.createDataFrame([("e", "1")], "ca string, numeroProcesso string"))
    assert sorted(r["ca"] for r in jobs.new_cases(twice, seen).collect()) == ["c", "d", "e"]


@pytest.mark.parametrize("width", [None, 3])
def test_asof(spark, width):
    left = spark.createDataFrame([("k", p) for p in (0, 4, 5, 9, 20)], "k string, pos int")
    right = spark.createDataFrame([("k", 4, 40), ("k", 8, 80), ("j", 1, 1)], "k string, pos int, v int")
    got = {r["pos"]: r["t"] for r in joins.asof_backward(left, right, ["k"], "pos", "v", "t", width).collect()}
    assert got == {0: None, 4: 40, 5: 40, 9: 80, 20: 80}


def test_limits(spark):
    rows = spark.createDataFrame([("a", i, i % 2 == 0) for i in range(6)], "g string, i int, used boolean")
    assert sorted(r["i"] for r in limits.top_per_group(rows, ["g"], ["i"], 2).collect()) == [0, 1]
    assert sorted(r["i"] for r in limits.top_per_group(rows, ["g"], ["i"], 2, F.col("used")).collect()) == [0, 1, 2, 3, 5]
    cut, more = limits.bounded(rows, ["i"], 4)
    assert more and cut.count() == 4
    bodies = spark.createDataFrame([(b"%PDF-1", None), (b"<html>", "text/html"), (b"x", "application/pdf"), (b"", "application/pdf"), (None, None)], "b binary, t string")
    assert [r[0] for r in bodies.select(limits.pdf_problem(F.col("b"), F.col("t"))).collect()] == [None, "not a pdf", None, "empty", "empty"]
    assert spark.range(1).select(limits.at_server_cap(F.lit(30), F.lit(False))).first()[0] is True


def test_reconcile(spark):
    cases = spark.createDataFrame([("full", True), ("short", True), ("failed", True), ("unread", True), ("plain", False), ("single", True)], "ca string, has_slider boolean")
    panels = spark.createDataFrame(
        [("full", 2, 2, 0, 30, 30), ("full", 3, 3, 0, 40, None), ("short", 2, 2, 0, 29, 30), ("failed", 2, 1, 1, 30, 30), ("single", 1, 1, 0, 9, 10)],
        "ca string, last_page int, pages_read int, pages_failed int, rows_read int, footer int",
    )
    got = {r["ca"]: (r["pages"], r["pages_read"], r["complete"], r["strict"]) for r in reconcile.reconcile_panels(cases, panels, "ca").collect()}
    assert got == {"full": (5, 5, True, True), "short": (2, 2, False, False), "failed": (2, 1, False, False), "unread": (1, 1, False, False), "plain": (1, 1, True, True), "single": (1, 1, True, False)}


def test_planner_leaves_partition_the_range(spark):
    start = date(2025, 1, 1)
    rows = spark.createDataFrame([(start + timedelta(days=d), k) for d in range(10) for k in "ab" for _ in range(d)], "day date, kind string")
    plan = planner.plan_cells(rows, "day", "kind", cap=6)
    leaves = plan.filter("status != 'SUBDIVIDED'").collect()
    assert sum(r["n"] for r in leaves) == rows.count()
    assert {r["status"] for r in leaves} == {"COMPLETE", "SATURATED"} and all((r["n"] < 6) == (r["status"] == "COMPLETE") for r in leaves)
    got = planner.harvest(rows.withColumn("id", F.monotonically_increasing_id()), plan, "day", "kind", ["id"], 6)
    assert got.count() == sum(min(r["n"], 6) for r in leaves)
    assert planner.plan_cells(rows.limit(0), "day", "kind").count() == 0
    with pytest.raises(ValueError):
        planner.seed_cell(None, None)
    with pytest.raises(ValueError):
        planner.seed_cell("31/02/2025", None)
    with pytest.raises(ValueError):
        planner.seed_cell("02/01/2025", "01/01/2025")
    with pytest.raises(ValueError):
        planner.plan_cells(rows, "day", "kind", most_cells=3)


def test_json_lines_and_csv(spark, tmp_path):
    (tmp_path / "downloads.jsonl").write_text('{"idProcessoDocumento":"1","arquivoLocal":"a, \\"b\\".pdf","downloadedAt":"2024-01-01T00:00:00Z"}\n\nbroken\n{"idProcessoDocumento":"1","arquivoLocal":" c ","downloadedAt":"2024-01-02T00:00:00Z"}\n')
    rows, rejected = tables.read_json_lines(spark, f"file://{tmp_path}/downloads.jsonl", schemas.DOWNLOAD)
    assert rows.count() == 2 and [r["line"] for r in rejected.collect()] == ["broken"]
    assert tables.read_json_lines(spark, f"file://{tmp_path}/none.jsonl", schemas.DOWNLOAD)[0].count() == 0
    documents = spark.createDataFrame([("1", "n,1"), ("2", None)], "idProcessoDocumento string, numeroProcesso string")
    for c in ("data", "tipo", "nomeArquivo", "tamanhoTexto", "formato", "downloadUrl"):
        documents = documents.withColumn(c, F.lit(None).cast("string"))
    sinks.write_csv(jobs.export_documents(documents, rows), f"file://{tmp_path}/out", 1)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == ",".join(schemas.EXPORT_DOCUMENTS) and sorted(lines[1:]) == ['"n,1",1,,,,,,, c ', ",2,,,,,,,"]


def test_export_job(spark, tmp_path):
    case = parse.case_page(PAGE, "k1", "https://e.org/c")
    cases = spark.createDataFrame([case], schemas.CASE)
    settings = jobs.Settings.from_env({"LUMBRE_DATA_DIR": f"file://{tmp_path}", "LUMBRE_CSV_FILES": "1"})
    sinks.write_cases(cases, settings.path("processes.jsonl"), settings.path("documents.jsonl"))
    assert jobs.export(spark, settings) == {"rejected_cases": 0, "rejected_documents": 0, "rejected_downloads": 0}
    (part,) = (tmp_path / "processes.csv").glob("part-*.csv")
    assert part.read_text().splitlines()[1].split(",")[8:11] == ["1", "2", "2"]
    (part,) = (tmp_path / "documents.csv").glob("part-*.csv")
    assert len(part.read_text().splitlines()) == 3
    with pytest.raises(ValueError):
        jobs.Settings.from_env({"LUMBRE_CAP": "30x"})


def test_search_outcomes(spark):
    captured = spark.createDataFrame([("a", 0, "u", 200, None, GRID.encode(), None), ("b", 0, "u", 200, None, b"<html></html>", None), ("c", 0, "u", 503, None, b"x", None), ("d", 0, "u", 200, None, None, None)], schemas.CAPTURED)
    got = tables.search_results(tables.captured_text(captured), "https://e.org/")
    assert {r["key"]: r["outcome"] for r in got.collect()} == {"a": "ok", "b": "expired", "c": "failed", "d": "failed"}
    pagers = spark.createDataFrame([("k", "https://other.org/c", "f", 1, 3)], "ca string, url string, form string, currentPage int, lastPage int")
    pages = spark.createDataFrame([("k", 2, PAGE)], "key string, page int, html string")
    got = {r["page"]: r for r in tables.remaining(pagers, pages).collect()}
    assert {k: r["read"] for k, r in got.items()} == {2: True, 3: False}
    assert got[2]["extra"]["documentos"][0]["downloadUrl"].startswith("https://other.org/d?")


def later_page(kind, rows):
    """A panel's later page, of movements or of documents."""
    if kind == "movements":
        body = "".join(f"<tr><td>0{i % 9 + 1}/09/2023 - M{i}</td></tr>" for i in rows)
        return f'<html><meta name="Ajax-Update-Ids" content="x:processoEvento"><table id="x:processoEvento"><tbody id="x:processoEvento:tb">{body}</tbody></table></html>'.encode()
    body = "".join(f'<tr><td><a href="/d?idBin=9&idProcessoDocumento={i}&actionMethod=m">01/09/2023 - D{i}</a></td></tr>' for i in rows)
    return f'<html><meta name="Ajax-Update-Ids" content="x:processoDocumento"><table id="x:processoDocumentoGridTab"><tbody id="x:processoDocumentoGridTab:tb">{body}</tbody></table></html>'.encode()


def two_sliders():
    """A case of 65 movements on five pages and of 23 documents on two, as captured."""
    slider = lambda f, last: f"""<script>new Richfaces.Slider("{f}:i",{{'maxValue':'{last}','sliderValue':'1','onchange':'A4J.AJAX.Submit(\\'{f}\\',event,{{\\'containerId\\':\\'c\\',\\'parameters\\':{{\\'{f}:t\\':\\'{f}:t\\'}} }} )'}} )</script>"""
    part = lambda kind, rows: later_page(kind, rows).decode().split(">", 2)[2].removesuffix("</html>")
    first = '<html><input name="javax.faces.ViewState" value="j">' + part("movements", range(15)) + "<span>65 resultados encontrados</span>" + slider("m", 5) + part("documents", range(15)) + "<span>23 resultados encontrados</span>" + slider("d", 2) + "</html>"
    rows = [("k9", None, "https://e.org/c", 200, None, first.encode(), None)]
    rows += [("k9", p, "https://e.org/c", 200, None, later_page("movements", range(15 * (p - 1), min(65, 15 * p))), "m") for p in range(2, 6)]
    return [*rows, ("k9", 2, "https://e.org/c", 200, None, later_page("documents", range(15, 23)), "d")]


def test_ingest(spark, tmp_path):
    rows = [("k1", 0, "https://e.org/c", 200, "text/html", PAGE.encode(), None), ("k2", 0, "u", 500, None, b"", None), ("k3", 0, "u", None, None, b"", None), ("k4", 2, "u", 404, None, b"", "m")]
    pages = two_sliders()
    for at, batch in enumerate(([*rows, *pages[1:4]], [*pages[:1], *pages[4:], pages[2]], [])):  # later pages before their case, one twice; then nothing new
        if batch:
            spark.createDataFrame(batch, schemas.CAPTURED).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        query = ingest.ingest(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
        query.awaitTermination(120)
        assert query.exception() is None
    cases = {r["ca"]: r for r in ingest.ingested_cases(spark, f"file://{tmp_path}/out").collect()}
    case = cases["k1"]
    assert (case["movimentacoesCompleto"], case["movimentacoesPaginas"], case["movimentacoesPaginasLidas"], len(case["documentos"])) == (False, 3, 1, 2)
    case = cases["k9"]
    assert [m["descricao"] for m in case["movimentacoes"]] == [f"M{i}" for i in range(65)] and [d["idProcessoDocumento"] for d in case["documentos"]] == [str(i) for i in range(23)]
    assert (case["movimentacoesCompleto"], case["movimentacoesPaginas"], case["movimentacoesPaginasLidas"]) == (True, 7, 7)
    told = {r["key"]: r["error"] for r in spark.read.json(f"file://{tmp_path}/out/failures").collect()}
    assert told == {"detail:k2": "status 500", "detail:k3": "no status", "detail:k4:m:2": "status 404"}
    ingest.publish(spark, f"file://{tmp_path}/out")
    documents, _ = tables.read_json_lines(spark, f"file://{tmp_path}/out/documents.jsonl", schemas.DOCUMENT_ROW)
    assert documents.filter("ca = 'k9'").count() == 23


def test_a_batch_is_parsed_once_by_all_cores(spark, tmp_path, monkeypatch):
    """each of the three tables of a batch parsed its pages anew, and a packed file was one task."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def marked(html, url):
        from pyspark import TaskContext

        (calls / f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}").touch()
        return parse.extra_page({}[html] if html == "broken" else html, url)

    monkeypatch.setattr(ingest, "extra_page", marked)
    rows = [(f"k{i}", 2, "u", 200, None, later_page("movements", [i]), "m") for i in range(63)] + [("k63", 2, "u", 200, None, b"broken", "m")]
    ingest._batch_writer(f"file://{tmp_path}/out")(spark.createDataFrame(rows, schemas.CAPTURED).coalesce(1), 0)
    assert spark.read.json(f"file://{tmp_path}/out/pages").count() == 63
    assert [r["key"] for r in spark.read.json(f"file://{tmp_path}/out/failures").collect()] == ["detail:k63:m:2"]
    names = [f.name for f in calls.iterdir()]
    assert len(names) == 64
    assert len({n.split("-")[0] for n in names}) >= spark.sparkContext.defaultParallelism


def test_parser_errors_are_dead_letters(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "key string, html string")
    got = {r["key"]: (r["p"], r["e"]) for r in parse.parsed(rows, int, ["html"], schemas.L, "p", "e").collect()}
    assert got["a"] == (1, None) and got["c"] == (None, None) and got["b"][0] is None and got["b"][1].startswith("ValueError")
    assert parse.absolute("https://e.org/", "http://[x") is None
    assert parse.url_value("/d?id%50=7&idP=8", "idP") == "7" and parse.url_value("/d?a%zz=1", "a%zz") == "1"


def test_pdfs(spark, tmp_path):
    docs = [("1", "n 1", 0, "01/02/2024", None, "Ato", "x", b"%PDF-1", None), ("2", "n 1", 1, None, None, None, "y", b"<html>", "text/html"), ("3", "n 1", 2, None, "a", None, "z", None, None)]
    rows = spark.createDataFrame(docs, "idProcessoDocumento string, numeroProcesso string, index int, data string, nomeArquivo string, tipo string, rotulo string, body binary, content_type string")
    first = {r["idProcessoDocumento"]: r for r in sinks.write_pdfs(rows, f"file://{tmp_path}/pdf").collect()}
    assert {k: r["outcome"] for k, r in first.items()} == {"1": "written", "2": "not a pdf", "3": "empty"}
    assert [str(p.relative_to(tmp_path / "pdf")) for p in (tmp_path / "pdf").rglob("*.pdf")] == [first["1"]["arquivoLocal"]] == ["n-1/0001_2024-02-01_ato_1.pdf"]
    again = sinks.write_pdfs(rows, f"file://{tmp_path}/pdf")
    assert [(r["idProcessoDocumento"], r["bytes"]) for r in sinks.download_log(again, F.lit(None).cast("timestamp")).collect()] == [("1", 6)]


def test_log_lines():
    import logging

    from lumbre.log import KeyValues, shown

    assert [shown(x) for x in (None, True, "a", "a b", 3, {"k": [1]})] == ["null", "true", "a", '"a b"', "3", '{"k": [1]}']
    record = logging.LogRecord("x", logging.INFO, "f", 1, "done", None, None)
    record.fields = {"n": 1, "s": "x y"}
    assert KeyValues().format(record).endswith('INFO  done n=1 s="x y"')


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_report_and_downloads(spark):
    searches = spark.createDataFrame([("ok", False), ("ok", True), ("expired", False), ("failed", False)], "outcome string, saturated boolean")
    cases = spark.createDataFrame([(True,), (False,), (None,)], "movimentacoesCompleto boolean")
    downloads = spark.createDataFrame([("1", 10), ("2", 5)], "idProcessoDocumento string, bytes long")
    failures = spark.createDataFrame([("k",)], "key string")
    got = jobs.report(searches, cases, downloads, failures)
    assert (got["searches"], got["ok"], got["saturated"], got["cases"], got["partial_cases"], got["bytes"], got["pending_failures"]) == (4, 2, 1, 3, 1, 15, 1)
    documents = spark.createDataFrame(
        [("1", "k", 0, "pdf", "u"), ("3", "k", 1, "pdf", "u"), ("4", "k", 2, "html", None), ("5", "k", 3, "pdf", None), ("6", "k", 4, "pdf", "u"), ("7", "k", 5, "pdf", "u")],
        "idProcessoDocumento string, ca string, index int, formato string, downloadUrl string",
    )
    assert sorted(r[0] for r in limits.to_download(documents, downloads, k=2).select("idProcessoDocumento").collect()) == ["3", "6"]


def test_lines_of_one_write_keep_their_order_whichever_file_ends_last(spark, tmp_path):
    path = f"file://{tmp_path}/failures.jsonl"
    for a, b in (("first", "second"), ("third", "fourth")):
        made = [("detail", "k", "t", x, None, 1, None, "{}") for x in (a, b)]
        sinks.append_json(spark.createDataFrame(made, schemas.FAILURE).repartitionByRange(2, F.expr(f"error = '{b}'")), path)
        for part in (tmp_path / "failures.jsonl").glob("part-*.json"):
            late = {"first": 4, "second": 0, "third": 9, "fourth": 5}[json.loads(part.read_text().splitlines()[0])["error"]]
            os.utime(part, (1_700_000_000 + late, 1_700_000_000 + late))
        (row,) = tables.read_failures(spark, path).collect()
        assert row["error"] == b
    assert len(list((tmp_path / "failures.jsonl").glob("part-*.json"))) == 4


def test_tables_that_are_read_and_rewritten(spark, tmp_path):
    path = f"file://{tmp_path}/failures.jsonl"
    made = [("detail", "detail:1", "t", "old", None, 1, None, "{}"), ("detail", "detail:1", "t", "new", 500, 2, None, "{}"), ("pdf", "pdf:1", "t", "x", None, 1, None, "{}")]
    sinks.append_json(spark.createDataFrame(made[:2], schemas.FAILURE), path)
    sinks.append_json(spark.createDataFrame(made[2:], schemas.FAILURE), path)
    now = tables.read_failures(spark, path)
    assert {r["key"]: (r["error"], r["attempts"], r["status"]) for r in now.collect()} == {"detail:1": ("new", 2, 500), "pdf:1": ("x", 1, None)}
    sinks.rewrite(dedup.clear_failures(now, spark.createDataFrame([("pdf:1",)], "key string")), path)
    assert [r["key"] for r in tables.read_failures(spark, path).collect()] == ["detail:1"]
    (tmp_path / "classes.json").write_text('[{"codigo":"2","nome":"\\u00c9poca"},{"codigo":"1","nome":"Zelo"},{"codigo":"3"},{"codigo":"4","nome":"Fato"}]')
    classes = tables.sorted_catalogue(tables.read_catalogue(spark, f"file://{tmp_path}/classes.json"))
    assert [r["nome"] for r in classes.collect()] == ["Época", "Fato", "Zelo"]
    (tmp_path / "bad.json").write_text("{broken")
    assert tables.read_catalogue(spark, f"file://{tmp_path}/bad.json").count() == 0 and tables.read_catalogue(spark, f"file://{tmp_path}/no.json").count() == 0
    cases = spark.createDataFrame([parse.case_page(PAGE, "k1", "https://e.org/c")], schemas.CASE)
    summaries = spark.createDataFrame([("k1", "77", None, "Ana X Beto", "Fim")], schemas.T.StructType([schemas.T.StructField("ca", schemas.S), schemas.T.StructField("internalId", schemas.S), schemas.T.StructField("foundBy", schemas.CRITERIA), schemas.T.StructField("partesResumo", schemas.S), schemas.T.StructField("ultimaMovimentacao", schemas.S)]))
    (row,) = sinks.with_summary(cases, summaries).collect()
    assert (row["internalId"], row["partesResumo"], row["numeroProcesso"]) == ("77", "Ana X Beto", "0001223-51.2020.1.02.0003")
