"""Language identification by sparse multinomial logistic regression.

Features are character 1- to 3-grams of the lower-cased text with every run of
non-letters as one space, hashed into ``FEATURES`` cells, weighted
(1 + ln count) x inverse document frequency and scaled to length one. Document
frequencies come from all training documents; the classifier is fitted on a bounded
sample of them (``sample_rows``, dealt evenly over the languages) with
follow-the-regularised-leader (per-coordinate rates, elastic-net penalty), and a part
of the sample that it was not fitted on sets the temperature of the softmax.

Defined results
    null text, no letter   ``und`` with score 0
    nothing to learn from  ``und`` with score 0 for every row
    null lang              not learned from
    null id                counts as the empty text where rows are dealt by id
    very long texts        read whole, in pieces
    repeated rows          predicted alike, all kept; in the sample they count once
    over MOST_LABELS       languages: an error, as weights grow with their number
    ties                   the language first by code point
    clashing names         only the id, text and language columns are read
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.words import id_crc32, slices, small_batches

FEATURES = 1 << 15
PIECE = 1 << 18
MOST_LABELS = 1000
#: Most numbers of a product, a single text aside.
PRODUCT = 1 << 21


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _cells(parts: list[np.ndarray]) -> np.ndarray:
    """Cells of n-grams given as code points, one array for each place."""
    h = np.full(len(parts[-1]), len(parts), np.uint32)
    for p in parts:
        h = (h ^ p[: len(h)]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(cells in ascending order, counts) of a whole text; None without a letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    before = np.concatenate([[True], letter[:-1]])
    codes = np.where(letter, codes, np.uint32(32))[letter | before]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    total = None
    for at in range(0, max(1, len(codes) - 2), PIECE):
        a = codes[at : at + PIECE]
        b, c = codes[at + 1 : at + PIECE + 1], codes[at + 2 : at + PIECE + 2]
        found = np.bincount(np.concatenate([_cells([a]), _cells([a, b]), _cells([a, b, c])]), minlength=FEATURES)
        total = found if total is None else total + found
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class LanguageModel:
    """What a prediction needs: labels, inverse document frequencies, weights, temperature."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[cells]
        return x / max(np.sqrt(x @ x), 1e-12)

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        """Labels and scores of texts, many in one sparse product."""
        found = [ngram_counts(t) if self.labels else None for t in texts]
        labels, scores = ["und"] * len(found), np.zeros(len(found))
        there = np.array([i for i, x in enumerate(found) if x is not None], np.int64)
        sizes = np.array([len(found[i][0]) for i in there], np.int64)
        part = np.cumsum(sizes) * len(self.labels) // PRODUCT
        for k in np.unique(part):
            own, n = there[part == k], sizes[part == k]
            cells = np.concatenate([found[i][0] for i in own])
            starts = np.cumsum(n) - n
            x = (1 + np.log(np.concatenate([found[i][1] for i in own]))) * self.idf[cells]
            norms = np.maximum(np.sqrt(np.add.reduceat(x * x, starts)), 1e-12)
            logits = np.add.reduceat(x[:, None] * self.weights[cells], starts) / norms[:, None] / self.temperature
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            scores[own] = np.minimum(1.0, p[np.arange(len(own)), best])
            for i, label in zip(own, best, strict=True):
                labels[i] = self.labels[label]
        return labels, scores


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5, epochs: int = 3, seed: int = 1
) -> np.ndarray:
    """Weights (features x classes) from (cells, values, class) by FTRL-proximal."""
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))

    def weights(zi, ni):
        return -np.sign(zi) * np.maximum(np.abs(zi) - l1, 0) / ((beta + np.sqrt(ni)) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            cells, x, y = rows[k]
            zi, ni = z[cells], n[cells]
            w = weights(zi, ni)
            g = _softmax(x @ w)
            g[y] -= 1
            g = x[:, None] * g[None, :]
            more = ni + g * g
            z[cells] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[cells] = more
    return weights(z, n)


def fit_temperature(logits: list[np.ndarray], classes: list[int]) -> float:
    """The temperature with the least negative log-likelihood on rows that were not fitted.

    A share of 1 / (rows + 2) of each target goes evenly to all classes: without an error
    among so many rows, certainty beyond that is not supported.
    """
    if not logits:
        return 1.0
    x, y = np.array(logits), np.array(classes)
    spread = 1 / (len(y) + 2)

    def loss(t: float) -> float:
        s = x / t
        s -= s.max(axis=1, keepdims=True)
        own = (1 - spread) * s[np.arange(len(y)), y] + spread * s.mean(axis=1)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - own))

    low, high = np.log(0.02), np.log(20.0)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs = np.zeros(FEATURES, np.int64), 0
    for batch in slices(batches, "text", 1 << 20):
        for text in batch.column(0):
            if (found := ngram_counts(text.as_py())) is not None:
                seen[found[0]] += 1
                docs += 1
    cells = np.flatnonzero(seen)
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1)), pa.array(np.append(seen[cells], docs))], names=["cell", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        rows = [ngram_counts(t.as_py()) for t in batch.column(2)]
        cells = pa.array([None if r is None else r[0].astype("<u2").tobytes() for r in rows], pa.binary())
        counts = pa.array([None if r is None else r[1].astype("<u4").tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells, counts], names=["h", "lang", "cells", "counts"])


def train(docs: DataFrame, sample_rows: int = 4000, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on ``docs``, rows without a language aside.

    Languages, their rows and the document frequencies are counted over all rows. The
    weights are fitted on about ``sample_rows`` rows, taken by a hash of id and text, each
    language as far as its share goes; at most twice as many come to the driver, as features.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} languages")
    labels = sorted(sizes)
    if not labels:
        return LanguageModel([], np.zeros(FEATURES), np.zeros((FEATURES, 1)), 1.0)
    counted = rows.select("text").mapInArrow(_frequencies, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES)
    total = 0
    for r in counted:
        if r["cell"] < 0:
            total = r["n"]
        else:
            df[r["cell"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1

    h = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.coalesce("text", F.lit("")), F.lit(seed)), F.lit(1 << 40))
    each = max(1, sample_rows // len(labels))
    bound = spark_map({k: int(min(1.0, each / n) * (1 << 40)) for k, n in sizes.items()})
    sample = rows.withColumn("h", h).filter(F.col("h") < F.element_at(bound, F.col("lang"))).select("h", "lang", "text")
    found = sample.mapInArrow(_sampled, "h long, lang string, cells binary, counts binary").filter("cells IS NOT NULL").dropDuplicates(["h", "lang"])
    found = sorted(found.orderBy("h", "lang").limit(2 * sample_rows).collect(), key=lambda r: (r["h"], r["lang"], r["cells"]))
    model = LanguageModel(labels, idf, np.zeros((FEATURES, len(labels))), 1.0)
    number = {k: i for i, k in enumerate(labels)}
    fitted, held = [], []
    for i, r in enumerate(found):
        cells, counts = np.frombuffer(r["cells"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4")
        (held if i % 5 == 4 else fitted).append((cells, model.vector(cells, counts), number[r["lang"]]))
    model.weights = fit_ftrl(fitted, len(labels))
    model.temperature = fit_temperature([x @ model.weights[c] for c, x, _ in held], [y for _, _, y in held])
    return model


def spark_map(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``lang_pred`` and ``score``; the text alone decides them."""
    added = ["lang_pred", "score"]
    kept = [f for f in docs.schema.fields if f.name not in added and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = [f.name for f in kept]
    read = text_col if text_col in names else "_text"
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, read, 1 << 20):
            labels, scores = own.predict(t.as_py() for t in batch.column(read))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(labels, pa.string()), pa.array(scores)], names=[*names, *added])

    columns = [F.col(c) for c in names] + ([] if read in names else [F.col(text_col).alias(read)])
    return docs.select(*columns).mapInArrow(run, schema)


def op4_identify_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.pmod(id_crc32(F.col("doc_id")), F.lit(4)) == 2
    model = train(docs.filter(~fold))
    rows = docs.select("doc_id", fold.alias("held_out"), "text")
    return identify(rows, model, keep=["doc_id", "held_out"])
