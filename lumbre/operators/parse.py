"""Parsers of captured responses: result pages, case pages, pagers and envelopes.

The parsers are plain functions on text that return plain records; ``parsed`` runs one
over a column in Arrow batches. Filters belong before it: Spark moves none across it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote_to_bytes, urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lumbre import schemas
from lumbre.operators.dom import Node, clean, parse

#: The forms in which the pages print numbers, stamps, links, counts and widgets.
NUMBER = re.compile(r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}")
STAMP = re.compile(r"^(\d{2}/\d{2}/\d{4}(?:\s+\d{2}:\d{2}:\d{2})?)\s*[-–]\s*(.*)$", re.S)
POPUP = re.compile(r"openPopUp\(\s*'[^']*'\s*,\s*'([^']+)'\s*\)")
IN_BRACKETS = re.compile(r"\(([^()]+)\)\s*$")
TAXPAYER = re.compile(r"\b(?:CPF|CNPJ)\s*:\s*([\d./-]+)", re.I)
SIZE = re.compile(r"\(([\d.,]+\s*[KMG]?b)\)\s*$", re.I)
CAP_NOTICE = re.compile(r"somente os \d+ primeiros", re.I)
TOTAL = re.compile(r"([\d.]+)\s*resultados?\s+encontrados", re.I)
SLIDER = re.compile(r"new\s+Richfaces\.Slider\(\s*\"([^\"]+)\"\s*,\s*\{(.*?)\}\s*\)", re.S)
VIEW_STATE = re.compile(r"name=\"javax\.faces\.ViewState\"[^>]*value=\"([^\"]*)\"")
PANELS = (("processoPartesPoloAtivoResumidoList", "ativo"), ("processoPartesPoloPassivoResumidoList", "passivo"), ("processoParteOutrosInteressadosResumidoList", "outros"))


def bare(text: str) -> str:
    """Without diacritics."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F)


def _unquoted(text: str, otherwise: Callable[[bytes], str]) -> str:
    """Percent escapes as UTF-8, and what ``otherwise`` makes of bytes that are not."""
    if "%" not in text:
        return text
    raw = unquote_to_bytes(text)
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return otherwise(raw)


def absolute(base: str, path: str) -> str | None:
    """A path on the base's host as a full url; null where it is no url at all."""
    try:
        return urljoin(base, path)
    except ValueError:
        return None


def url_values(url: str) -> dict[str, str]:
    """Each query parameter's first value, as ``text.query_param`` reads it: names are decoded
    too; bytes are UTF-8, or ISO-8859-1 where they are not."""
    out: dict[str, str] = {}
    _, mark, query = url.partition("?")
    for pair in query.partition("#")[0].split("&") if mark else ():
        key, _, value = pair.partition("=")
        if pair and (name := _unquoted(key, lambda _: key)) not in out:  # noqa: B023
            out[name] = _unquoted(value.replace("+", " "), lambda raw: raw.decode("latin-1"))
    return out


def url_value(url: str, name: str) -> str | None:
    """One query parameter's first value."""
    return url_values(url).get(name)


def _table_rows(root: Node, suffix: str) -> list[Node]:
    table = root.first("table", id_end=suffix)
    body = table.first("tbody", id_end=":tb") if table else None
    return body.elements("tr") if body else []


def _popup(anchor: Node) -> str | None:
    found = POPUP.search(anchor.attrs.get("onclick", ""))
    return None if found is None or found[1] == "about:blank" else found[1].replace("&amp;", "&")


def _detail_path(cell: Node) -> str | None:
    for a in cell.all("a"):
        if found := POPUP.search(a.attrs.get("onclick", "")):
            return found[1]
        if "ca=" in (href := a.attrs.get("href", "")):
            return href
    return None


def _summary(row: Node, base: str) -> dict | None:
    cells = row.elements("td")
    if len(cells) < 2:
        return None
    path = _detail_path(cells[0]) or _detail_path(cells[1])
    key = re.search(r"[?&]ca=([^&\"']+)", path or "")
    if key is None:
        return None
    inside = re.search(r"processosTable:([^:]+):", cells[0].attrs.get("id") or cells[1].attrs.get("id") or "")
    info, link = cells[1], cells[1].first("a")
    # The class stands before the links of the cell, the parties after them, both as bare text.
    before, after, seen = [], [], False
    links = set(map(id, info.all("a")))
    for child in info.children:
        holds = isinstance(child, Node) and (id(child) in links or any(id(x) in links for x in child.walk()))
        if holds:
            seen, after = True, []
        else:
            (after if seen else before).append(child if isinstance(child, str) else child.text())
    title = clean(link.text()) if link else ""
    number = NUMBER.search(title) or NUMBER.search(info.text())
    return {
        "internalId": inside[1] if inside else "",
        "ca": key[1],
        "detailUrl": absolute(base, path),
        "numeroProcesso": number[0] if number else "",
        "classeJudicial": clean("".join(before)) if seen else "",
        "titulo": title,
        "partesResumo": clean("".join(after)) if seen else "",
        "ultimaMovimentacao": clean(cells[2].text()) if len(cells) > 2 else "",
    }


def search_result(html: str, base: str) -> dict:
    """A result page. ``has_grid`` false means that the view has expired, which is no empty result."""
    root = parse(html)
    messages = [m for m in (n.text().strip() for n in root.all(cls="rich-messages-label")) if m]
    banner = root.first(cls="alert-danger")
    footer = "".join(n.text() for n in root.all(cls="rich-table-footercell"))
    total = re.search(r"(\d+)\s+resultados?\s+encontrados", footer, re.I)
    rows = [_summary(r, base) for r in _table_rows(root, ":processosTable")]
    return {
        "has_grid": root.first("table", id_end=":processosTable") is not None,
        "rows": [r for r in rows if r],
        "rejected": sum(r is None for r in rows),
        "total_label": int(total[1]) if total else None,
        "truncated": bool(banner and CAP_NOTICE.search(banner.text())),
        "message": messages[0] if messages else None,
    }


def property_fields(root: Node) -> dict[str, str]:
    """Label and value of the innermost property blocks.

    A blank value counts only where a label has no other. A block without a label is read
    by its bold headings.
    """
    out: dict[str, str] = {}
    for block in root.all(cls="propertyView"):
        if block.first(cls="propertyView"):
            continue
        name = block.first(cls="name")
        label = clean(name.first("label").text()) if name and name.first("label") else ""
        value = block.first(cls="value")
        if label:
            text = clean(value.text()) if value else ""
            if text or bare(label) not in out:
                out[bare(label)] = text
            continue
        heading, body = None, []
        for piece in [*_bold_pieces(value)] if value else []:
            if piece[0]:
                if heading and clean("".join(body)):
                    out[bare(heading)] = clean("".join(body))
                heading, body = clean(piece[1]), []
            else:
                body.append(piece[1])
        if heading and clean("".join(body)):
            out[bare(heading)] = clean("".join(body))
    return out


def _bold_pieces(node: Node) -> Iterator[tuple[bool, str]]:
    for child in node.children:
        if isinstance(child, str):
            yield False, child
        elif child.tag == "b":
            yield True, child.text()
        else:
            yield from _bold_pieces(child)


def parties(root: Node, suffix: str, polo: str) -> list[dict]:
    out = []
    for row in _table_rows(root, f":{suffix}"):
        cells = row.elements("td")
        if not cells:
            continue
        bold = cells[0].first(cls="text-bold")
        name = (clean(bold.text()) if bold else "") or clean(cells[0].text())
        if not name:
            continue
        listed = [clean(li.text()) for ul in cells[0].all("ul", cls="tree") for li in ul.all("li")]
        tax, role = TAXPAYER.search(name), IN_BRACKETS.search(name)
        out.append({
            "polo": polo,
            "nome": name,
            "documento": tax[1] if tax else None,
            "papel": role[1] if role else None,
            "situacao": (clean(cells[1].text()) or None) if len(cells) > 1 else None,
            "representantes": [x for x in listed if x],
        })
    return out


def movements(root: Node) -> list[dict]:
    out = []
    for row in _table_rows(root, ":processoEvento"):
        cells = row.elements("td")
        raw = clean(cells[0].text()) if cells else ""
        if not raw:
            continue
        stamp = STAMP.match(raw)
        link = cells[1].first("a") if len(cells) > 1 else None
        out.append({
            "data": stamp[1] if stamp else None,
            "descricao": stamp[2] if stamp else raw,
            "documento": (clean(link.text(without="sr-only")) or None) if link else None,
            "documentoUrl": _popup(link) if link else None,
        })
    return out


def _document(anchor: Node, fallback: str, base: str) -> dict | None:
    label = clean(anchor.text(without="sr-only")) or fallback
    href, popup = anchor.attrs.get("href", ""), _popup(anchor)
    is_pdf = "idBin=" in href and "actionMethod=" in href
    source = href if is_pdf else popup or ""
    values = url_values(source)
    key = values.get("idProcessoDocumento", values.get("idProcessoDoc"))
    if not key:
        return None
    stamp, kind, size = STAMP.match(label), IN_BRACKETS.search(label), SIZE.search(clean(anchor.attrs.get("title", "")))
    return {
        "idProcessoDocumento": key,
        "idBin": values.get("idBin"),
        "numeroDocumento": values.get("numeroDocumento"),
        "nomeArquivo": values.get("nomeArqProcDocBin"),
        "rotulo": label,
        "data": stamp[1] if stamp else None,
        "tipo": kind[1] if kind else None,
        "tamanhoTexto": size[1] if size else None,
        "formato": "pdf" if is_pdf else "html",
        "downloadUrl": absolute(base, href) if is_pdf else None,
        "htmlViewUrl": absolute(base, popup) if popup else None,
    }


def documents(root: Node, base: str) -> list[dict]:
    """Documents of the grid, then of all other links to a file; the first of an id wins."""
    found: dict[str, dict] = {}
    seen = set()
    for row in _table_rows(root, ":processoDocumentoGridTab"):
        cells = row.elements("td")
        link = cells[0].first("a") if cells else None
        seen.add(id(link))
        if link and (d := _document(link, "", base)):
            found.setdefault(d["idProcessoDocumento"], d)
    for link in root.all("a", test=lambda n: "idBin=" in n.attrs.get("href", "") and id(n) not in seen):
        row = link.above("tr")
        cells = row.elements("td") if row else []
        if d := _document(link, clean(cells[0].text()) if cells else "", base):
            found.setdefault(d["idProcessoDocumento"], d)
    return list(found.values())


def case_page(html: str, ca: str, url: str) -> dict:
    """A case page as one nested record. The secrecy phrase counts in the case's own fields
    and panels alone, as pages carry it in notices of their own."""
    root = parse(html)
    fields = property_fields(root)
    number = next((fields[k] for k in ("Numero Processo", "Numero do Processo") if k in fields), None)
    if number is None:
        found = NUMBER.search(root.text())
        number = found[0] if found else ""
    starting = lambda label: fields.get(label, next((v for k, v in fields.items() if k.startswith(label)), None))
    people = [p for suffix, polo in PANELS for p in parties(root, suffix, polo)]
    moved = movements(root)
    stated = " ".join([*fields, *fields.values(), *(m["descricao"] for m in moved)])
    return {
        "numeroProcesso": number,
        "ca": ca,
        "detailUrl": url,
        "dadosProcesso": fields,
        "dataDistribuicao": fields.get("Data da Distribuicao"),
        "classeJudicial": fields.get("Classe Judicial"),
        "assunto": fields.get("Assunto"),
        "jurisdicao": fields.get("Jurisdicao"),
        "orgaoJulgador": starting("Orgao Julgador"),
        "orgaoJulgadorColegiado": starting("Orgao Julgador Colegiado"),
        "segredoJustica": re.search("segredo de justi", stated, re.I) is not None,
        "partes": people,
        "movimentacoes": moved,
        "documentos": documents(root, url),
        "movimentacoesPaginas": None,
        "movimentacoesPaginasLidas": None,
        "movimentacoesCompleto": None,
        "scrapedAt": None,
    }


def has_slider(html: str) -> bool:
    return re.search(r"new\s+Richfaces\.Slider\(", html) is not None


def panel_pagers(html: str) -> list[dict]:
    """Pagers in page order; those that cannot be read are left out (see ``has_slider``)."""
    state = VIEW_STATE.search(html)
    totals = [(m.start(), int(d)) for m in TOTAL.finditer(html) if (d := re.sub(r"\D", "", m[1]))]
    out = []
    for slider in SLIDER.finditer(html) if state else ():
        options = slider[2].replace("\\'", "'")
        keys = [re.search(p, options) for p in (r"A4J\.AJAX\.Submit\('([^']+)'", r"'parameters'\s*:\s*\{\s*'([^']+)'", r"'containerId'\s*:\s*'([^']+)'")]
        last, now = (re.search(rf"'{k}'\s*:\s*'(\d+)'", options) for k in ("maxValue", "sliderValue"))
        last, now = (int(m[1]) if m else 1 for m in (last, now))
        if all(keys) and last >= 1:
            before = [n for at, n in totals if at <= slider.start()]
            form, trigger, container = (k[1] for k in keys)
            out.append({"formId": form, "inputId": slider[1], "triggerId": trigger, "containerId": container, "lastPage": last, "currentPage": now, "viewState": state[1], "reportedTotal": before[-1] if before else None})
    return out


def envelope(body: str) -> dict:
    """Whether an answer is partial, what it updates, and its view state."""
    return _envelope(body, parse(body))


def _envelope(body: str, root: Node) -> dict:
    metas = {n: [m.attrs["content"] for m in root.all("meta") if m.attrs.get("name") == n and "content" in m.attrs] for n in ("Ajax-Response", "Ajax-Update-Ids")}
    ids = [i.strip() for c in metas["Ajax-Update-Ids"] for i in c.split(",")]
    box = root.first(test=lambda n: n.attrs.get("id") == "ajax-view-state")
    state = [i.attrs.get("value") for part in (box, root) if part for i in part.all("input") if i.attrs.get("name") == "javax.faces.ViewState"]
    return {"is_ajax": metas["Ajax-Response"][:1] == ["true"] or "ajax-view-state" in body, "update_ids": list(dict.fromkeys(i for i in ids if i)), "view_state": state[0] if state else None}


def panel_kind(update_ids: list[str], html: str) -> str:
    """movements, documents or unknown: what the server names goes before what the page holds."""
    return _named_kind(update_ids) or _held_kind(parse(html))


def _named_kind(update_ids: list[str]) -> str | None:
    named = " ".join(update_ids).lower()
    for word, kind in (("processoevento", "movements"), ("processodocumento", "documents")):
        if word in named:
            return kind
    return None


def _held_kind(root: Node) -> str:
    if root.first(test=lambda n: "processoEvento:" in n.attrs.get("id", "")):
        return "movements"
    return "documents" if root.first("table", id_end=":processoDocumentoGridTab") else "unknown"


def extra_page(body: str, base: str) -> dict:
    """One later page of a panel; an unknown panel is a failed page, not an empty one."""
    root = parse(body)
    kind = _named_kind(_envelope(body, root)["update_ids"]) or _held_kind(root)
    known = kind != "unknown"
    return {"kind": kind, "read": known, "movimentacoes": movements(root) if known else [], "documentos": documents(root, base) if known else []}


def script_function_id(html: str, name: str) -> str:
    """The parameter that a page's script function posts; an error where it has none."""
    at = html.find(f"{name}=function")
    found = re.search(r"'parameters'\s*:\s*\{\s*'([^']+)'\s*:", html[at : at + 2000]) if at >= 0 else None
    if found is None:
        raise ValueError(f"no parameter id for the function {name}")
    return found[1]


def suggestion_box_id(html: str) -> str:
    found = re.search(r"new RichFaces\.Suggestion\('[^']*','[^']*','([^']+)'", html)
    return found[1] if found else ""


def require_no_captcha(html: str) -> None:
    at = html.find("function executarReCaptcha")
    found = re.search(r"if\s*\(\s*(true|false)\s*\)", html[at : at + 400]) if at >= 0 else None
    if found and found[1] == "true":
        raise ValueError("the site asks for a captcha")


def class_catalogue(html: str) -> list[dict]:
    """(codigo, nome) of a suggestion table: the first two filled cells of each numbered row."""
    rows: dict[str, list[str]] = {}
    for table in parse(html).all("table", id_end=":suggest"):
        for cell in table.all("td", test=lambda n: "id" in n.attrs):
            parts, text = cell.attrs["id"].split(":"), clean(cell.text())
            if len(parts) > 1 and parts[-2].isdigit() and text:
                rows.setdefault(parts[-2], []).append(text)
    return [{"codigo": v[0], "nome": v[1]} for v in rows.values() if len(v) > 1]


def page_form(pager: dict, page: int) -> dict[str, str]:
    """The request for a page of a panel."""
    form = pager["formId"]
    return {
        "AJAXREQUEST": pager["containerId"], form: form, pager["inputId"]: str(page), "autoScroll": "", f"{form}:_link_hidden_": "", f"{form}:j_idcl": "",
        "javax.faces.ViewState": pager["viewState"], pager["triggerId"]: pager["triggerId"], "AJAX:EVENTS_COUNT": "1",
    }


EXTRA_PAGE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("read", T.BooleanType()), T.StructField("movimentacoes", T.ArrayType(schemas.MOVEMENT)), T.StructField("documentos", T.ArrayType(schemas.DOCUMENT))])


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out evenly to all cores, four parts each. A file packs rows far more closely
    than they take to parse, so that one row group, which one task reads, may hold hours of work.
    Before pages are made of narrow rows it moves least."""
    return rows.repartition(4 * max(1, rows.sparkSession.sparkContext.defaultParallelism))


def parsed(rows: DataFrame, parser: Callable[..., object], inputs: list[str], kind: T.DataType, alias: str = "parsed", errors: str | None = None, without: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``parser(*inputs)`` as a column; rows with a null input get null.

    With ``errors`` a row on which the parser fails gets null, and what failed in that column;
    without, it stops the query. Columns in ``without`` do not come back: Spark prunes none
    across the parser, and a page is larger than what is read of it.
    """
    kept = [f for f in rows.schema.fields if f.name not in (alias, errors, *without)]
    schema = T.StructType([*kept, T.StructField(alias, kind), *([T.StructField(errors, T.StringType())] if errors else [])])
    names, arrow = [f.name for f in kept], to_arrow_type(kind)
    # Inputs that are kept are sent once; the others beside them.
    sent = {c: c if c in names else f"_in{i}" for i, c in enumerate(inputs)}

    def attempt(args: tuple) -> tuple[object, str | None]:
        if None in args:
            return None, None
        if errors is None:
            return parser(*args), None
        try:
            return parser(*args), None
        except Exception as e:  # the row's own trouble, kept as data
            return None, f"{type(e).__name__}: {e}"[:500]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(sent[c]).to_pylist() for c in inputs]
            tried = [attempt(args) for args in zip(*columns, strict=True)]
            made = [list(m.items()) if isinstance(kind, T.MapType) and m is not None else m for m, _ in tried]
            told = [pa.array([e for _, e in tried], pa.string())] if errors else []
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, arrow), *told], names=[*names, alias, *([errors] if errors else [])])

    return rows.select(*[F.col(n) for n in names], *[F.col(c).alias(at) for c, at in sent.items() if at not in names]).mapInArrow(run, schema)
