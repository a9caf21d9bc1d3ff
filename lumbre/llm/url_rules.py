"""URL filtering by a bit-parallel wildcard automaton.

All glob rules are laid side by side in one bit vector of as many 64-bit words as
they need (Shift-And with self-loops): bit i says that the first i symbols of its rule
match what has been read. One step over a byte of UTF-8 shifts every rule at once, masks
with the byte's row and keeps the bits that stand before a wildcard which takes the
byte. A batch of URLs moves through the automaton together, one position a step; URLs
of over ``LONG`` bytes, and all where rules fill many words, move alone, on Python's
long integers, so that one very long URL costs a moment and not a batch's time.

Glob syntax, matched against the whole canonical URL: ``**`` any run of characters,
``*`` any run without ``/``, ``?`` one character other than ``/``, all else itself.
The canonical URL is ``.`` + host + END + path, END being a byte that UTF-8 never holds: it
ends the host alone, so that a site rule, ``**.`` + its host + END + its path + ``**``, takes
the host and all its subdomains and cannot be met by text inside a path.

Rules and globs are given as they are or read from a table (``read_rules``).

Defined results
    null url, no ``://``   empty host and path; no rule matches, the default verdict
    empty and very long    a very long URL costs its length in steps of its own
    repeated rows          judged alike, all kept
    equally long rules     the one listed first
    clashing names         the result has the columns of ``docs`` and those added, an
                           added name replacing one of ``docs``
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (host, path, verdict): a rule fits its host and all subdomains.
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Globs that decide where no site rule fits; what none of them takes is allowed. Hosts whose
#: name says that they serve junk, under any top-level domain, and pages that are no documents.
FALLBACK_GLOBS = ("*spam*.**", "*pills*.**", "*casino*.**", "*adult*.**", "**/wp-login.php", "**/cgi-bin/**")
END = b"\xff"
#: Bytes from which a URL is judged alone.
LONG = 4096
MOST_RULES = 200_000


class GlobAutomaton:
    """All globs in one Shift-And automaton."""

    def __init__(self, globs: Sequence[str | bytes]):
        literal, loops, ends, starts = [], [], [], []
        for glob in globs:
            starts.append(len(literal))
            literal.append(None)
            loops.append("")
            raw, i = glob.encode("utf-8") if isinstance(glob, str) else glob, 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    loops[-1], i = "any", i + 2
                elif raw[i : i + 1] == b"*":
                    loops[-1], i = "any" if loops[-1] == "any" else "segment", i + 1
                else:
                    literal.append(raw[i : i + 1])
                    # A character's first byte moves on, its others stay.
                    loops.append("rest" if raw[i : i + 1] == b"?" else "")
                    i += 1
            ends.append(len(literal) - 1)
        self.bits, self.words = len(literal), max(1, -(-len(literal) // 64))
        self.start_bits, self.end_bits = np.array(starts, np.int64), np.array(ends, np.int64)
        wanted = np.array([-1 if x is None else x[0] for x in literal], np.int64)
        loops = np.array(loops, "U8")
        self.take, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        question, stays_any, stays_segment, stays_rest = wanted == ord("?"), loops == "any", loops == "segment", loops == "rest"
        for c in range(256):
            slash, rest = c == ord("/"), 0x80 <= c < 0xC0
            self.take[c] = self._packed((wanted == c) & ~question | (question if not slash and not rest and c != END[0] else False))
            self.stay[c] = self._packed(stays_any | (stays_segment if not slash else False) | (stays_rest | question if rest else False))
        self.start = self._packed(np.isin(np.arange(self.bits), self.start_bits))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        raw = np.zeros(self.words * 8, np.uint8)
        found = np.packbits(bits, bitorder="little")
        raw[: len(found)] = found
        return raw.view("<u8")

    def step(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        moved = state << np.uint64(1)
        moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return moved & self.take[chars] | state & self.stay[chars]

    @cached_property
    def _integers(self) -> tuple[list[int], list[int], int]:
        whole = lambda rows: [int.from_bytes(r.tobytes(), "little") for r in rows]
        return whole(self.take), whole(self.stay), int.from_bytes(self.start.tobytes(), "little")

    def match_alone(self, url: bytes) -> np.ndarray:
        """The last state of one URL, as a row of words."""
        take, stay, state = self._integers
        for c in url:
            state = state << 1 & take[c] | state & stay[c]
            if not state:
                break
        return np.frombuffer(state.to_bytes(self.words * 8, "little"), "<u8")

    def match(self, urls: Sequence[bytes]) -> np.ndarray:
        """One row per URL, one column per glob."""
        lengths = np.array([len(u) for u in urls], np.int64)
        state = np.tile(self.start, (len(urls), 1)) if len(urls) else np.zeros((0, self.words), np.uint64)
        alone = lengths > (LONG if self.words <= 64 else 0)
        for i in np.flatnonzero(alone):
            state[i] = self.match_alone(urls[i])
        some = np.flatnonzero(~alone)
        order = some[np.argsort(-lengths[some], kind="stable")]
        sizes = lengths[order]
        flat = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        first = np.cumsum(sizes) - sizes
        moving = state[order]
        for at in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -at, side="left"))
            moving[:live] = self.step(moving[:live], flat[first[:live] + at])
        state[order] = moving
        return state[:, self.end_bits // 64] >> (self.end_bits % 64).astype(np.uint64) & np.uint64(1) != 0


def canonical(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL: host up to ``/ ? #`` with A-Z lower-cased, path up to ``? #``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(65, 91)}


class UrlJudge:
    """Site rules, the longest of which wins, before fallback globs; one automaton for both."""

    def __init__(self, rules=SITE_RULES, fallback=FALLBACK_GLOBS, default: str = "allow"):
        self.rules, self.n, self.default = list(rules), len(rules), default
        sites = [b"**.%s%s%s**" % (host.encode(), END, path.encode()) for host, path, _ in self.rules]
        self.automaton = GlobAutomaton([*sites, *fallback])
        self.rank = np.array([len(host) + len(path) for host, path, _ in self.rules], np.int64)

    def judge(self, urls: Sequence[str | None]) -> tuple[list[str], list[str], list[str | None], list[str]]:
        parts = [canonical(u) for u in urls]
        rules, verdicts = [], []
        sites = self.automaton.match([b".%s%s%s" % (h.encode("utf-8", "replace"), END, p.encode("utf-8", "replace")) for h, p in parts])
        fits = np.where(sites[:, : self.n], self.rank[None, :], -1) if self.n else np.full((len(parts), 1), -1)
        best = fits.argmax(axis=1)
        blocked = sites[:, self.n :].any(axis=1)
        for i in range(len(parts)):
            if fits[i, best[i]] >= 0:
                host, path, verdict = self.rules[best[i]]
                rules.append(host + path)
                verdicts.append(verdict)
            else:
                rules.append(None)
                verdicts.append("block" if blocked[i] else self.default)
        return [h for h, _ in parts], [p for _, p in parts], rules, verdicts


ADDED = ["host", "path", "rule", "verdict"]


def read_rules(table: DataFrame) -> tuple[tuple[tuple[str, str, str], ...], tuple[str, ...]]:
    """(site rules, fallback globs) of a table (host, path, verdict, glob), in order of their text.

    A row with a glob is one; other rows are site rules, a null path being ``/``. Rows with
    neither host nor glob, or without a verdict, are no rules. More than MOST_RULES are an error.
    """
    rows = table.select("host", "path", "verdict", "glob").distinct().orderBy("host", "path", "verdict", "glob").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    sites = tuple((r["host"].translate(_LOWER), r["path"] or "/", r["verdict"]) for r in rows if r["glob"] is None and r["host"] and r["verdict"])
    return sites, tuple(r["glob"] for r in rows if r["glob"] is not None)


def judge_urls(docs: DataFrame, url_col: str = "url", rules=SITE_RULES, fallback=FALLBACK_GLOBS, default: str = "allow") -> DataFrame:
    """``docs`` with host, path, rule (null where none fits) and verdict of each URL."""
    kept = [f for f in docs.schema.fields if f.name not in ADDED]
    schema = T.StructType([*kept, *[T.StructField(c, T.StringType()) for c in ADDED]])
    source = docs.select(*[F.col(f.name) for f in kept], F.col(url_col).alias("_url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = UrlJudge(rules, fallback, default)
        for batch in batches:
            *own, urls = batch.columns
            found = [pa.array(x, pa.string()) for x in judge.judge(urls.to_pylist())]
            yield pa.RecordBatch.from_arrays([*own, *found], names=[*batch.schema.names[:-1], *ADDED])

    return source.mapInArrow(run, schema)


def op10_judge_urls(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH p AS (SELECT page_id, row_number() OVER () AS rid, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
c AS (SELECT page_id, rid, coalesce(regexp_extract(rest, '^[^#?]*'), '') AS u FROM p),
h AS (SELECT page_id, rid, translate(regexp_extract(u, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(u, '/.*$', 0, 's') AS path FROM c),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(rh, rp, rv)),
m AS (SELECT h.page_id, h.host, h.path, r.rh || r.rp AS rule, r.rv,
             row_number() OVER (PARTITION BY h.rid ORDER BY length(r.rh || r.rp) DESC) AS rn
      FROM h LEFT JOIN r ON ends_with('.' || h.host, '.' || r.rh) AND starts_with(h.path, r.rp))
SELECT page_id, host, path, rule,
       coalesce(rv, CASE WHEN regexp_matches(host, '(spam|pills|casino|adult).*\.', 's') OR ends_with(path, '/wp-login.php')
                           OR contains(path, '/cgi-bin/') THEN 'block' ELSE 'allow' END) AS verdict
FROM m WHERE rn = 1
"""
