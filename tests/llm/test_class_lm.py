import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumbre.llm import class_lm as lm


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(docs, held):
    c, n = collections.Counter(), 0
    for i, t in docs:
        if not held(i):
            w = words(t)
            c.update(w)
            c[None] += 1
            n += len(w) + 1
    v = len(c)
    out = []
    for i, t in docs:
        tokens = [*words(t), None]
        out.append((i, held(i), len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)))
    return out


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def same(got, want):
    order = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=order)
    want = sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(abs(a[5] - b[5]) < 1e-6 * (1 + abs(b[5])) for a, b in zip(got, want))


def test_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = lm.op9_score_documents(spark, sf_dir).collect()
    same(got, base(docs, is_held))
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_meet_their_counts_in_the_join(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    model, tail = lm.train(frame.filter(~fold), frequent=60, core=20)
    assert len(model.words) <= 60 and tail.count() > 100
    taught = {w for i, t in docs if not is_held(i) for w in words(t)}
    assert len(model.words) + tail.count() == len(taught)  # every word has a class, and one count
    assert (model.states[:-1] < lm.CLASSES).all() and (model.states[:-1] > 0).all()
    assert tail.filter("cls IS NULL OR cls < 1 OR cls > 63").count() == 0
    same(lm.score(frame, model, tail, fold).collect(), base(docs, is_held))


def test_scores_by_brute_force(spark, sf_dir):
    """Counts of class bigrams, and every text's score, from the words' classes alone."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    taught = [(i, t) for i, t in docs if i % 4]
    model, tail = lm.train(frame.filter("doc_id % 4 != 0"), frequent=300, core=100)
    h = lambda w: int(lm._hashes(pa.array([w]))[0])
    beyond = {r["h"]: r["cls"] for r in tail.collect()}
    everything = collections.Counter(w for _, t in taught for w in words(t))
    number = {w: int(model.words.look_up(np.array([h(w)]))[0]) for _, t in docs for w in words(t)}
    cls = {w: int(model.states[k]) if k >= 0 else beyond[h(w)] for w, k in number.items() if w in everything}
    state = lambda w: 0 if w is None else int(model.states[number[w]])
    n = np.zeros((65, 64))
    for _, t in taught:
        before = None
        for w in [*words(t), None]:
            n[state(before), cls[w] if w else 0] += 1
            before = w
    into = n.sum(axis=0)
    share = (into + 0.5) / (into + 0.5).sum()
    pull = np.maximum((n > 0).sum(axis=1, keepdims=True), 1)
    p = (n + pull * share) / (n.sum(axis=1, keepdims=True) + pull)
    whole = sum(everything.values()) + len(taught)
    whole += 0.1 * (len(everything) + 2)
    size = np.bincount(list(cls.values()), minlength=64)
    spare = 1 + int(size[1:].argmax())
    got = {r["doc_id"]: r["score"] for r in lm.score(frame, model, tail, F.lit(False)).collect()}
    for i, t in docs:
        total, before = 0.0, None
        for w in [*words(t), None]:
            c = 0 if w is None else cls.get(w, spare)
            alone = (everything[w] if w is not None else len(taught)) + 0.1
            given = 1 if w is None else alone / (into[c] + 0.1 * (size[c] + 1))
            total += math.log10(0.8 * p[state(before), c] * given + 0.2 * alone / whole)
            before = w
        assert abs(got[i] - total) < 1e-6 * (1 + abs(total))


def test_words_beyond_the_core_are_exchanged_by_their_own_bigrams(spark):
    rng = np.random.default_rng(1)
    kinds = {k: [f"{k}{i}" for i in range(150)] for k in "abc"}  # kinds of words that follow each other in turn
    docs = [(j, " ".join(str(rng.choice(kinds[k])) for _ in range(30) for k in "abc")) for j in range(400)]
    model, tail = lm.train(spark.createDataFrame(docs, "doc_id long, text string"), frequent=300, core=150)
    number = lambda w: int(model.words.look_up(lm._hashes(pa.array([w])))[0])
    beyond = {r["h"]: r["cls"] for r in tail.collect()}
    cls = {w: int(model.states[number(w)]) if number(w) >= 0 else beyond[int(lm._hashes(pa.array([w]))[0])] for k in "abc" for w in kinds[k]}
    owners = collections.defaultdict(collections.Counter)
    for w, c in cls.items():
        owners[c][w[0]] += 1
    assert sum(max(x.values()) for x in owners.values()) >= 0.9 * len(cls)  # classes hold one kind each


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a. a"), (3, "c c d")], "doc_id long, text string")
    model, tail = lm.train(docs)
    vocabulary = ["a", "b", "c", "d", "a."]
    assert np.allclose(model.step.sum(axis=1), 1)
    probes = spark.createDataFrame([(i, w) for i, w in enumerate(vocabulary)], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in lm.score(probes, model, tail, F.lit(False)).collect()}
    # P(word, end) summed over the words is what the path of ends leaves them, unseen words aside.
    assert 0 < sum(10 ** scores[i] for i in scores) < 1


def test_exchange_finds_classes_and_gains_likelihood():
    rng = np.random.default_rng(0)
    kinds = np.arange(1, 41) % 2
    n = np.zeros((41, 41), int)
    for _ in range(20_000):  # two kinds of words that take turns
        k = rng.integers(2)
        n[1 + rng.choice(np.flatnonzero(kinds == k)), 1 + rng.choice(np.flatnonzero(kinds != k))] += 1
    owner = lm.exchange(n, classes=3)
    assert owner[0] == 0
    for k in (0, 1):
        assert len(set(owner[1:][kinds == k])) == 1

    def likelihood(o):
        hot = np.eye(3)[o]
        c = hot.T @ n @ hot
        f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return f(c) - f(c.sum(axis=0)) - f(c.sum(axis=1))

    start = np.array([0, *(1 + np.arange(40) // 20)])
    assert likelihood(owner) > likelihood(start)
    for u in range(1, 41):  # no move is left that gains
        for c in (1, 2):
            other = owner.copy()
            other[u] = c
            assert likelihood(other) <= likelihood(owner) + 1e-6


def test_messy(messy, nothing):
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0
    model, tail = lm.train(messy.filter(~fold))
    docs = [(r["doc_id"], r["text"]) for r in messy.collect()]
    same(lm.score(messy, model, tail, fold).collect(), base(docs, is_held))
    untaught, no_tail = lm.train(nothing)
    for r in lm.score(messy, untaught, no_tail, fold).collect():
        assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, pytest.approx(0)) and math.isfinite(r["score"])
    assert lm.score(nothing, model, tail, fold).count() == 0
