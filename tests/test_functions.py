from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lumbre.functions import dates, keys, policy, text


def value(spark, column, **given):
    frame = spark.createDataFrame([Row(**given)]) if given else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


def one(spark, f, x, kind="string"):
    return spark.createDataFrame([(x,)], f"c {kind}").select(f(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("  a   b\n\tc ", "a b c"), ("", ""), (" ", ""), (None, None)])
def test_collapse_spaces(spark, raw, want):
    assert one(spark, text.collapse_spaces, raw) == want


@pytest.mark.parametrize("raw,want", [("Órgão Julgador", "Orgao Julgador"), ("é", "e"), ("ß", "ß"), ("Ђ", "Ђ"), (None, None)])
def test_deaccent(spark, raw, want):
    assert one(spark, text.deaccent, raw) == want


@pytest.mark.parametrize("raw,want", [("Inteiro Teor (Acórdão)", "inteiro-teor-acordao"), ("///", "documento"), (None, "documento"), ("a" * 79 + " b", "a" * 79 + "-")])
def test_slugify(spark, raw, want):
    assert one(spark, text.slugify, raw) == want


@pytest.mark.parametrize(
    "query,want",
    [("n=Decis%E3o", "Decisão"), ("n=Decis%C3%A3o", "Decisão"), ("n=Inteiro+Teor", "Inteiro Teor"), ("n=a%zz", "a%zz"), ("m=1&n=2#n=3", "2"), ("n", ""), ("n=", ""), ("m=1", None), ("n=1&n=2", "1")],
)
def test_query_param(spark, query, want):
    assert one(spark, lambda c: text.query_param(c, "n"), f"https://example.org/x?{query}") == want


def test_query_param_without_query(spark):
    assert one(spark, lambda c: text.query_param(c, "n"), "https://example.org/n=1") is None


def test_leading_timestamp(spark):
    for raw, want in [("03/09/2023 21:01:15 - Some thing", ("03/09/2023 21:01:15", "Some thing")), ("03/09/2023 – x\ny", ("03/09/2023", "x\ny")), ("plain", (None, "plain"))]:
        a = one(spark, lambda c: text.leading_timestamp(c)[0], raw)
        b = one(spark, lambda c: text.leading_timestamp(c)[1], raw)
        assert (a, b) == want


def test_popup_and_links(spark):
    assert one(spark, text.popup_url, "openPopUp('x', '/a?b=1&amp;c=2')") == "/a?b=1&c=2"
    assert one(spark, text.popup_url, "openPopUp('x', 'about:blank')") is None
    assert one(spark, text.case_key, "/l?x=1&ca=abc&z") == "abc"
    assert one(spark, text.process_number, "case 0001223-51.2020.1.02.0003 x") == "0001223-51.2020.1.02.0003"
    assert one(spark, lambda c: text.absolute_url("https://e.org/a/b", c), "/x") == "https://e.org/x"
    assert one(spark, lambda c: text.absolute_url("https://e.org/a/b", c), "x") == "https://e.org/a/x"


def test_fields_of_maps(spark):
    row = spark.createDataFrame([({"Orgao Julgador Colegiado": "c", "Assunto": ""},)], "m map<string,string>")
    got = row.select(text.pick(F.col("m"), "Nada", "Assunto"), text.pick_starting(F.col("m"), "Orgao Julgador"), text.pick_starting(F.col("m"), "Zzz")).first()
    assert tuple(got) == ("", "c", None)


def test_first_non_empty(spark):
    assert one(spark, text.first_non_empty, ["", " ", " a "], "array<string>") == "a"
    assert one(spark, text.first_non_empty, [], "array<string>") is None


def test_headers(spark):
    assert one(spark, text.header_filename, 'attachment; filename="a b.pdf"') == "a b.pdf"
    assert one(spark, text.header_filename, "attachment; filename*=UTF-8''Decis%C3%A3o.pdf") == "Decisão.pdf"
    assert one(spark, text.header_filename, 'attachment; filename="DecisÃ£o.pdf"') == "Decisão.pdf"
    frame = spark.createDataFrame([("Decisão".encode("latin-1"), "text/html; charset=ISO-8859-1"), ("ã".encode(), None), ("ã".encode(), "x; charset=none-such")], "b binary, t string")
    assert [r[0] for r in frame.select(text.decode_body(F.col("b"), F.col("t"))).collect()] == ["Decisão", "ã", "ã"]
    assert one(spark, text.sequence_text, 2, "int") == "0003" and one(spark, text.sequence_text, 12344, "int") == "12345"
    assert one(spark, text.size_bytes, "4,62 Kb") == 4731


@pytest.mark.parametrize("raw,want", [("13/08/2025 10:00", "2025-08-13"), ("31/02/2025", "2025-02-31"), ("x", "sem-data"), (None, "sem-data")])
def test_reorder_date(spark, raw, want):
    assert one(spark, dates.reorder_date, raw) == want


@pytest.mark.parametrize("raw,want", [("29/02/2024", date(2024, 2, 29)), ("29/02/2026", None), ("31/02/2025", None), ("32/01/2025", None), ("01/13/2025", None), ("1/1/2025", None), (None, None)])
def test_parse_date(spark, raw, want):
    assert one(spark, dates.parse_date, raw) == want


def test_require_date_stops(spark):
    with pytest.raises(Exception, match="not a date"):
        one(spark, dates.require_date, "31/02/2025")


def test_split_range(spark):
    assert dates.halve(date(2025, 1, 1), date(2025, 1, 4)) == ((date(2025, 1, 1), date(2025, 1, 2)), (date(2025, 1, 3), date(2025, 1, 4)))
    assert dates.halve(date(2025, 1, 1), date(2025, 1, 1)) is None
    frame = spark.createDataFrame([(date(2025, 1, 1), date(2025, 1, 3)), (date(2025, 1, 1), date(2025, 1, 1))], "a date, b date")
    got = [r[0] for r in frame.select(dates.split_range(F.col("a"), F.col("b"))).collect()]
    assert tuple(got[0]) == (date(2025, 1, 1), date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)) and got[1] is None


def test_policy(spark):
    frame = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n int")
    assert [r[0] for r in frame.select(policy.backoff_window(F.col("n"), 10, 40)).collect()] == [10, 20, 40, 40]
    now = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    for raw, want in [("30", 30000), ("junk", None), ("Mon, 01 Jan 2024 00:00:05 GMT", 5000), ("Sun, 31 Dec 2023 00:00:00 GMT", 0), (None, None)]:
        assert one(spark, lambda c: policy.retry_after_ms(c, now), raw) == want
    assert one(spark, lambda c: policy.retryable(c, F.lit(None).cast("string")), 501, "int") is False
    assert one(spark, lambda c: policy.retryable(F.lit(None).cast("int"), c), "EPIPE") is True


def test_cell_key(spark):
    frame = spark.createDataFrame([("x", None, ""), (None, None, None)], "nomeParte string, classeJudicial string, ufOAB string")
    names = ["nomeParte", "classeJudicial", "ufOAB"]
    got = frame.select(keys.cell_key(F.struct(*names), names), keys.describe(F.struct(*names), names)).collect()
    assert [tuple(r) for r in got] == [("nomeParte=x", "nomeParte=x"), ("(empty)", "(no criteria)")]
