"""Explicit schemas of captured responses, parsed records and persisted tables.

Null means that the page did not have the field; an empty string, that it was printed
blank. The two are never merged.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


CRITERIA_FIELDS = ["numeroProcesso", "nomeParte", "nomeAdvogado", "classeJudicial", "documentoParte", "numeroOAB", "ufOAB", "dataInicio", "dataFim"]
CRITERIA = _struct(**dict.fromkeys(CRITERIA_FIELDS, S))
SUMMARY_FIELDS = ["internalId", "ca", "detailUrl", "numeroProcesso", "classeJudicial", "titulo", "partesResumo", "ultimaMovimentacao"]
SUMMARY = _struct(**dict.fromkeys(SUMMARY_FIELDS, S))
RESULT = _struct(has_grid=B, rows=T.ArrayType(SUMMARY), rejected=I, total_label=I, truncated=B, message=S)
PARTY = _struct(polo=S, nome=S, documento=S, papel=S, situacao=S, representantes=T.ArrayType(S))
MOVEMENT = _struct(data=S, descricao=S, documento=S, documentoUrl=S)
DOCUMENT_FIELDS = ["idProcessoDocumento", "idBin", "numeroDocumento", "nomeArquivo", "rotulo", "data", "tipo", "tamanhoTexto", "formato", "downloadUrl", "htmlViewUrl"]
DOCUMENT = _struct(**dict.fromkeys(DOCUMENT_FIELDS, S))
PAGER = _struct(formId=S, inputId=S, triggerId=S, containerId=S, lastPage=I, currentPage=I, viewState=S, reportedTotal=I)
ENVELOPE = _struct(is_ajax=B, update_ids=T.ArrayType(S), view_state=S)
CASE = _struct(
    numeroProcesso=S, ca=S, detailUrl=S, dadosProcesso=T.MapType(S, S), dataDistribuicao=S, classeJudicial=S, assunto=S, jurisdicao=S, orgaoJulgador=S, orgaoJulgadorColegiado=S, segredoJustica=B,
    partes=T.ArrayType(PARTY), movimentacoes=T.ArrayType(MOVEMENT), documentos=T.ArrayType(DOCUMENT),
    movimentacoesPaginas=I, movimentacoesPaginasLidas=I, movimentacoesCompleto=B, scrapedAt=T.TimestampType(),
)
PERSISTED_CASE = T.StructType([*CASE.fields, *_struct(internalId=S, foundBy=CRITERIA, partesResumo=S, ultimaMovimentacao=S).fields])
DOCUMENT_ROW = T.StructType([*DOCUMENT.fields, *_struct(numeroProcesso=S, ca=S, classeJudicial=S).fields])
DOWNLOAD = _struct(idProcessoDocumento=S, numeroProcesso=S, arquivoLocal=S, bytes=L, downloadedAt=T.TimestampType())
FAILURE = _struct(kind=S, key=S, target=S, error=S, status=I, attempts=I, lastAttemptAt=T.TimestampType(), context=S)
JUDICIAL_CLASS = _struct(codigo=S, nome=S)
#: A response as captured: its search or detail key, page number, body and headers; ``form``
#: names the pager that a later page of a panel answers, null for other responses.
CAPTURED = _struct(key=S, page=I, url=S, status=I, content_type=S, body=T.BinaryType(), form=S)
DEAD_LETTER = _struct(kind=S, key=S, error=S, attempts=I)
EXPORT_CASES = ["numeroProcesso", "classeJudicial", "dataDistribuicao", "assunto", "jurisdicao", "orgaoJulgador", "orgaoJulgadorColegiado", "segredoJustica", "qtdPartes", "qtdMovimentacoes", "qtdDocumentos", "detailUrl", "scrapedAt"]
EXPORT_DOCUMENTS = ["numeroProcesso", "idProcessoDocumento", "data", "tipo", "nomeArquivo", "tamanhoTexto", "formato", "downloadUrl", "arquivoLocal"]
