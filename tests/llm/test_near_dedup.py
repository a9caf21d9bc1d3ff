import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lumbre.llm import near_dedup as nd


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """(doc_id -> (n, component, kept)) of distinct ids by comparing all with all."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def run(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(frame).collect()}


def test_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert run(spark, docs) == brute(docs)


def test_groups_chains_and_shared_passages(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(3000)]
    docs = []
    base = rng.choices(vocab, k=120)
    for _ in range(70):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        docs.append(copy)
    chain = rng.choices(vocab, k=150)
    for _ in range(12):  # each like the one before, not like the first
        chain = chain[6:] + rng.choices(vocab, k=6)
        docs.append(list(chain))
    shared = rng.choices(vocab, k=60)
    for _ in range(60):  # a passage in common, otherwise different
        docs.append(rng.choices(vocab, k=45) + shared + rng.choices(vocab, k=20))
    rng.shuffle(docs)
    docs = [(i * 3, " ".join(d)) for i, d in enumerate(docs)]
    assert run(spark, docs) == brute(docs)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 10)
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(500)]
    docs = []
    for _ in range(4):
        shared = rng.choices(vocab, k=100)
        for _ in range(25):
            copy = list(shared)
            for _ in range(rng.randint(1, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            docs.append((len(docs), " ".join(copy)))
    assert run(spark, docs) == brute(docs)


def test_similarity_is_exact_at_the_threshold():
    a = np.arange(12, dtype=np.uint64)
    assert nd.similar(a, a[:9]) and not nd.similar(a, a[:8]) and nd.similar(a, a)
    assert nd.similar(np.arange(7, dtype=np.uint64), np.arange(1, 8, dtype=np.uint64))  # 6 of 8
    assert not nd.similar(np.arange(7, dtype=np.uint64), np.arange(2, 9, dtype=np.uint64))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.75, 0.9, 0.4):
        n = 2000
        x = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        both = int(2 * n * share / (1 + share))
        a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:both], x[n : 2 * n - both]]))
        values = nd.min_hashes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        s = nd.odd_sketches(values).view(np.uint64)
        bits = int(np.bitwise_count(s[0] ^ s[1]).sum())
        got = 1 + nd.SKETCH_BITS / (4 * nd.HASHES) * np.log(1 - 2 * bits / nd.SKETCH_BITS)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(got - true) < 0.2
        assert (bits <= nd.MOST_BITS) == (share >= 0.75)


def test_short_and_long_sets():
    x, starts = nd.shingle_sets(pa.array(["a b", "a b c", "", None, "A  B", "a b c d e f", " ".join(str(i) for i in range(30_000))]))
    assert np.diff(starts).tolist() == [1, 1, 0, 0, 1, 2, 29_996]
    assert x[starts[0]] == x[starts[4]] != x[starts[1]]


def test_messy(messy, nothing):
    got = nd.near_duplicates(messy).collect()
    assert len(got) == messy.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["component_id"], r["kept"]))
    assert by[2] == [(2, True)] and by[3] == [(3, True)] and by[4] == [(4, True)]
    assert by[8] == [(8, True)] and by[9] == [(8, False)] and by[10] == [(8, False)]
    assert by[1] == [(1, True)] * 3 and by[None] == [(None, True)] * 2 and by[-5] == [(-5, True)]
    assert nd.near_duplicates(nothing).count() == 0


def test_null_id_yields_to_an_id(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = nd.near_duplicates(spark.createDataFrame([(None, text), (4, text), (None, text + " x")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got) == [(0, 4, False), (0, 4, False), (4, 4, True)]


def test_copies_of_one_text(spark):
    got = nd.near_duplicates(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("one and the same text here").alias("text")))
    assert got.filter("kept").count() == 1 and got.select("component_id").distinct().count() == 1


def test_one_of_each_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    near = a.replace("a0 ", "z ")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (2, near, "x"), (None, near, "y"), (None, c, "y"), (None, c, "z"), (3, "", "x"), (3, None, "x"), (4, c + " more", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copies string")
    got = sorted(nd.one_of_each(docs).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, a, "x"), (1, b, "x"), (3, "", "x"), (3, None, "x"), (4, c + " more", "x")], key=lambda r: str(spark.createDataFrame([r], docs.schema).first()))
    alone = docs.filter("doc_id IS NULL")
    assert sorted(r["text"] for r in nd.one_of_each(alone).collect()) == sorted([near, c])
    assert nd.one_of_each(docs.limit(0)).columns == docs.columns
