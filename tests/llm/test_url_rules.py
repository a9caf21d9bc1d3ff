import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbre.llm import url_rules as u


def as_regex(glob):
    parts = re.split(r"(\*+|\?)", glob)
    return "".join({"*": "[^/]*", "?": "[^/]"}.get(p, ".*" if set(p) == {"*"} and p else re.escape(p)) for p in parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aé/.*?\U0001f600", max_size=12).filter(lambda g: "***" not in g), min_size=1, max_size=20), st.lists(st.text("aé/.\U0001f600", max_size=14), min_size=1, max_size=8))
def test_automaton_equals_regex(globs, urls):
    automaton = u.GlobAutomaton(globs)
    got = automaton.match([x.encode() for x in urls])
    for i, x in enumerate(urls):  # alone, on long integers
        state = automaton.match_alone(x.encode())
        assert [bool(state[b // 64] >> np.uint64(b % 64) & np.uint64(1)) for b in automaton.end_bits] == got[i].tolist()
    for i, x in enumerate(urls):
        for k, g in enumerate(globs):
            assert bool(got[i, k]) == bool(re.fullmatch(as_regex(g), x, re.S)), (g, x)


def test_many_words():
    globs = [f"**/{i:03d}/*" for i in range(200)]
    automaton = u.GlobAutomaton(globs)
    assert automaton.words > 10
    got = automaton.match([b"a/b/017/x", b"a/199/", b"a/017/x/y", b""])
    assert [r.nonzero()[0].tolist() for r in got] == [[17], [199], [], []]


def test_verdicts():
    judge = u.UrlJudge()
    cases = {
        "http://a.com/": ("a.com", "/", "com/", "allow"),
        "http://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://x.www.example.com/en/": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "https://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "https://a.net/en/1": ("a.net", "/en/1", None, "allow"),
        "https://a.org/x.example.com/en/": ("a.org", "/x.example.com/en/", None, "allow"),
        "https://spam-farm.example.org/": ("spam-farm.example.org", "/", None, "block"),
        "http://com": ("com", "", None, "allow"),
        "http://a.com#/x": ("a.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://a.com/" + "x" * 50_000: ("a.com", "/" + "x" * 50_000, "com/", "allow"),
        "http://x.org/a.com\0/b": ("x.org", "/a.com\0/b", None, "allow"),
        "http://x.org/spam.": ("x.org", "/spam.", None, "allow"),
        "http://x.org/a/wp-login.php": ("x.org", "/a/wp-login.php", None, "block"),
    }
    assert list(zip(*judge.judge(list(cases)))) == list(cases.values())


def test_messy(spark):
    rows = [(1, "http://a.com/", "own"), (1, "http://a.com/", "own"), (None, None, None)]
    got = u.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert [(r["page_id"], r["host"], r["verdict"]) for r in got] == [(1, "a.com", "allow"), (1, "a.com", "allow"), (None, "", "allow")]
    assert u.judge_urls(spark.createDataFrame([], "url string")).count() == 0


def test_many_rules_from_a_table(spark):
    rows = [(f"Site{i}.example", "/a/" if i % 2 else None, "block" if i % 3 else "allow", None) for i in range(10_000)]
    table = spark.createDataFrame([*rows, (None, None, None, "**junk**"), (None, "/x", "block", None), ("y.org", "/", None, None)], "host string, path string, verdict string, glob string")
    sites, globs = u.read_rules(table)
    assert len(sites) == 10_000 and globs == ("**junk**",)
    judge = u.UrlJudge(sites, globs)
    urls = ["http://www.site9999.example/a/b", "http://site3.example/a/b", "http://site4.example/x", "http://site5.example/b", "http://z/junk", "http://z/"]
    assert judge.judge(urls)[2:] == (["site9999.example/a/", "site3.example/a/", "site4.example/", None, None, None], ["allow", "allow", "block", "allow", "block", "allow"])


def test_a_very_long_url_costs_little():
    judge, began = u.UrlJudge(), time.time()
    assert judge.judge(["http://a.net/fr/" + "ã" * 500_000, "http://b.com/"])[3] == ["block", "allow"]
    assert time.time() - began < 10


def test_one_character_is_not_one_byte():
    assert u.GlobAutomaton(["a?c", "a??c", "?"]).match(["aéc".encode(), "a\U0001f600c".encode(), "é".encode(), b"/"]).tolist() == [[True, False, False], [True, False, False], [False, False, True], [False, False, False]]
