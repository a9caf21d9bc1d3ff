import collections
import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from lumbre.llm import fingerprints as fp


def counts(text):
    return collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def jaccard(a, b):
    a, b = counts(a), counts(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edited(text, following):
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def brute(docs):
    """(doc_id, n_chars, sha256, edited, next) of texts in descending id order."""
    docs = sorted(docs, key=lambda d: (-d[0], d[1]))
    out = []
    for i, (key, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        e = edited(text, following)
        out.append((key, len(text), hashlib.sha256(e.encode()).hexdigest(), e, following, text))
    return out


def test_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in fp.fingerprint_neighbours(spark.createDataFrame(docs, "doc_id long, text string"), range_bytes=20_000).collect()}
    assert len(got) == len(docs)
    off, prints = [], {}
    for key, n, sha, e, following, text in brute(docs):
        r = got[key]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        off += [r["near_edited"] - jaccard(text, e), r["near_next"] - jaccard(text, following)]
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.075
    assert len(set(prints.values())) == len(prints)


def test_collision_rate_is_generalised_jaccard(spark):
    """Many draws over weights that are no counts' sets: sum of min over sum of max."""
    texts = spark.createDataFrame([(0, "a " * 1 + "b " * 4 + "c " * 9 + "d " * 2), (1, "a " * 3 + "b " * 4 + "c " * 3 + "e " * 5)], "k int, t string")
    prints = {r["k"]: r["fingerprint"] for r in fp.weighted_samples(fp.weighted_words(texts, ["k"], ["t"]), ["k"], 600, {"fingerprint": "log_weight0"}).collect()}
    parts = lambda s: [s[i : i + fp.DIGITS] for i in range(0, len(s), fp.DIGITS)]
    same = np.mean([x == y for x, y in zip(parts(prints[0]), parts(prints[1]), strict=True)])
    assert abs(same - (1 + 4 + 3) / (3 + 4 + 9 + 2 + 5)) < 0.06


def test_messy(messy, nothing):
    got = fp.fingerprint_neighbours(messy, range_bytes=10_000).collect()
    rows = [(-(2**63) if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in messy.collect()]
    want = sorted((k, n, sha) for k, n, sha, *_ in brute(rows))
    assert sorted((-(2**63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    zeros = "0" * fp.DIGITS * fp.SAMPLES
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == zeros) == (r["doc_id"] in (2, 3, 4) or r["n_chars"] == 0)
    assert fp.fingerprint_neighbours(nothing).count() == 0


def test_one_row_follows_itself(spark):
    (r,) = fp.fingerprint_neighbours(spark.createDataFrame([(7, "abc def")], "doc_id long, text string")).collect()
    assert (r["n_chars"], r["near_next"], r["edited_sha256"]) == (7, 1.0, hashlib.sha256(b"abc abc").hexdigest())


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = fp.fingerprint_neighbours(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_one_id(spark):
    got = fp.fingerprint_neighbours(spark.range(50).select(F.lit(3).alias("doc_id"), F.concat(F.lit("t "), F.col("id")).alias("text")))
    assert got.count() == 50


def test_accuracy_of_the_query(spark, sf_dir):
    """The likenesses that the query itself gives, against the exact ones."""
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in fp.op8_fingerprint_documents(spark, sf_dir).collect()}
    assert {len(r["fingerprint"]) for r in got.values()} == {fp.SAMPLES * fp.DIGITS}
    off = []
    for key, _, _, e, following, text in brute(docs):
        off += [got[key]["near_edited"] - jaccard(text, e), got[key]["near_next"] - jaccard(text, following)]
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.075


def test_words_that_stand_once_rank_as_by_the_whole_formula(spark):
    words = spark.range(2000, numPartitions=1).select(F.xxhash64("id").alias("w"), F.when(F.col("id") % 4 > 0, F.ln((F.col("id") % 4).cast("double"))).alias("x"))
    one, two = F.xxhash64("w", F.lit(10)), F.xxhash64("w", F.lit(11))
    r, beta = -F.ln(fp._part(one, 0, 21) * fp._part(one, 21, 21)), fp._part(one, 42, 22)
    whole = F.ln(-F.ln(fp._part(two, 0, 32) * fp._part(two, 32, 32))) - r * (F.floor(F.col("x") / r + beta) - beta + 1)
    rows = words.select(fp._rank(F.col("w"), F.col("x"), 5).alias("got"), whole.alias("want"), "x").collect()
    assert all(r["got"] == r["want"] and (r["got"] is None) == (r["x"] is None) for r in rows)
