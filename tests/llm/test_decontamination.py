import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lumbre.llm import decontamination as dc

VOCAB = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("na", "ro", "ti", "les", "qu", "")]


def prose(rng, n):
    common = VOCAB[:30]
    return [rng.choice(common) if rng.random() < 0.5 else rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(n)]


def corpus(seed=1, clean=120, items=30):
    rng = random.Random(seed)
    bench = [prose(rng, rng.randint(15, 90)) for _ in range(items)]
    docs, want = [], set()
    for i in range(clean):
        docs.append((i, " ".join(prose(rng, rng.randint(1, 400)))))
    for i in range(40):
        k = i % items
        words = list(bench[k])
        if i % 4 == 1:  # other case and punctuation
            words = [w.upper() + "," for w in words]
        if i % 4 == 2:  # some words replaced
            for j in rng.sample(range(len(words)), len(words) // 10):
                words[j] = "zzz"
        if i % 4 == 3:  # words put in between
            words = [x for w in words for x in ([w, "yyy"] if rng.random() < 0.15 else [w])]
        docs.append((1000 + i, " ".join(prose(rng, rng.randint(0, 200)) + words + prose(rng, rng.randint(0, 200)))))
        want.add((1000 + i, k))
    return docs, [(k, " ".join(b)) for k, b in enumerate(bench)], want


def find(spark, docs, bench, **kwargs):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    return dc.find_leaks(d, b, **kwargs).collect()


def test_planted_leaks(spark):
    docs, bench, want = corpus()
    assert {(r["doc_id"], r["item_id"]) for r in find(spark, docs, bench)} == want


def test_candidates_miss_no_leak_of_brute_force(spark):
    """Every pair that the word check accepts anywhere in a text is found by way of latent space."""
    docs, bench, _ = corpus(seed=2, clean=40)
    index_items = []
    h, offsets = dc.word_hashes(pa.array([t for _, t in bench]))
    freq = dc.frequencies(spark.createDataFrame(docs, "doc_id long, text string"))
    for (k, _), a, b in zip(bench, offsets[:-1], offsets[1:]):
        index_items.append((k, h[a:b], None))
    nowhere = dc.LatentSpace(np.full(dc.CELLS, -1, np.int32), np.zeros((1, 1), np.float32), np.ones(1), np.zeros(1, bool))
    index = dc.build_index(index_items, freq, nowhere)
    found = {(r["doc_id"], r["item_id"]) for r in find(spark, docs, bench)}
    for key, text in docs:
        w = dc.word_hashes(pa.array([text]))[0]
        for item in index.items:
            n = len(item.words)
            regions = [w[max(0, at - n) : at + dc.WINDOW + n] for at in range(0, max(1, len(w)), dc.STEP)]
            if any(dc.decide(item, r)[0] for r in regions):
                assert (key, item.item_id) in found


def test_several_blocks(spark, monkeypatch):
    docs, bench, want = corpus(seed=3)
    monkeypatch.setattr(dc, "BLOCK_WORDS", 300)
    assert {(r["doc_id"], r["item_id"]) for r in find(spark, docs, bench)} == want


def paraphrases(seed=4, notions=45, items=40):
    """Prose of clauses, each about a notion, whose two parts can be said in two ways each; items of such
    prose with names of their own; and copies said in the other way, with two clauses swapped."""
    rng = random.Random(seed)
    ways = [((f"n{i}a", f"n{i}b"), (f"m{i}a", f"m{i}b")) for i in range(notions)]

    def talk(n):
        about = [ways[i] for i in rng.sample(range(notions), 12)]
        return [w for _ in range(n) for parts in [rng.choice(about)] for w in (rng.choice(parts[0]), rng.choice(parts[1]))]

    docs = [(i, " ".join(talk(rng.randint(30, 150)))) for i in range(600)]
    like = {x: y for parts in ways for pair in parts for x, y in (pair, pair[::-1])}
    bench = []
    for k in range(items):
        words = talk(18)
        for j in range(10):
            words.insert(rng.randint(0, len(words)), f"name{k}n{j}")
        bench.append((k, words))
    want = set()
    for k, words in bench:
        copy = [like[w] if w in like and rng.random() < 0.85 else w for w in words]
        at = rng.randint(4, 8)
        copy = [*copy[at : 2 * at], *copy[:at], *copy[2 * at :]]
        docs.append((10_000 + k, " ".join(talk(25) + copy + talk(25))))
        want.add((10_000 + k, k))
    return docs, [(k, " ".join(w)) for k, w in bench], want


def test_paraphrases_are_found_through_latent_space(spark):
    docs, bench, want = paraphrases()
    got = {(r["doc_id"], r["item_id"]) for r in find(spark, docs, bench)}
    assert not got - want and len(got) >= 0.9 * len(want)
    assert len(find(spark, docs, bench, cosine=2.0)) < 0.1 * len(want)  # without latent candidates


def test_answers(spark):
    rng = random.Random(9)
    item = prose(rng, 40)
    half = item[:26]
    docs = [(1, " ".join(prose(rng, 30) + half + ["answerword"] + prose(rng, 30))), (2, " ".join(prose(rng, 30) + half + prose(rng, 30))), (3, " ".join(prose(rng, 80)))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(5, " ".join(item), "Answerword.")], "item_id long, text string, answer string")
    got = dc.find_leaks(d, b, answer_col="answer").collect()
    assert [(r["doc_id"], r["answer_found"]) for r in got] == [(1, True)]


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(50):
        a, b = [rng.choices(range(1, 6), k=rng.randint(1, 30)) for _ in range(2)]
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert dc.common_subsequence(masks, len(a), np.array(b, np.uint64)) == table[-1][-1]


def test_randomised_svd(spark):
    rng = np.random.default_rng(0)
    a = rng.random((30, 50)) * (rng.random((30, 50)) < 0.2)
    rows = spark.createDataFrame([([int(x) for x in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for r in a], "cells array<int>, weights array<double>")
    v, values = dc.randomised_svd(rows.repartition(3), 50, 30)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-4) and np.allclose(a @ v @ v.T, a, atol=1e-4)
    assert np.allclose(values, np.linalg.svd(a)[1][: len(values)], atol=1e-3)
    few, _ = dc.randomised_svd(rows, 50, 5)
    best = np.linalg.svd(a)[2][:5].T
    assert np.linalg.norm(a - a @ few @ few.T) < 1.15 * np.linalg.norm(a - a @ best @ best.T)


def test_messy(spark, messy, nothing):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5, 30)), "x"), (2, None, "x"), (3, "", "x"), (None, "no id here but words", "x"), (4, "Ana", "x")], "item_id long, text string, doc_id string")
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["item_id"]) for r in dc.find_leaks(messy, bench).collect())
    assert got == [(False, 0, None), (True, 1, 4), (True, 1, 4), (True, 8, 1), (True, 9, 1), (True, 10, 1)]
    assert dc.find_leaks(nothing, bench).count() == 0
    assert dc.find_leaks(messy, bench.limit(0)).count() == 0


def test_a_third_of_all_rows_leak(spark):
    docs, bench, _ = corpus(seed=5, clean=60)
    copies = [(5000 + i, "start here " + bench[0][1]) for i in range(60)]
    got = find(spark, docs + copies, bench)
    assert {5000 + i for i in range(60)} <= {r["doc_id"] for r in got if r["item_id"] == 0}
    assert not {r["doc_id"] for r in got} & set(range(60))
    assert spark.createDataFrame(got).filter(F.col("doc_id") >= 5000).count() == 60


def test_copies_without_their_rarest_words(spark):
    """An item whose rarest words are replaced is found as long as its common order reaches SURE."""
    rng = random.Random(11)
    bench = [prose(rng, rng.randint(15, 90)) for _ in range(20)]
    docs = [(i, " ".join(prose(rng, rng.randint(1, 300)))) for i in range(100)]
    df = collections.Counter(w for _, t in docs for w in set(t.split()))
    want = set()
    for k, item in enumerate(bench):
        rarest = sorted(range(len(item)), key=lambda j: (df[item[j]], j))
        for percent in (5, 10, 15, 20, 25):
            gone = set(rarest[: len(item) * percent // 100])
            copy = [f"new{k}x{j}" if j in gone else w for j, w in enumerate(item)]
            docs.append((1000 + 100 * k + percent, " ".join(prose(rng, rng.randint(0, 100)) + copy + prose(rng, rng.randint(0, 100)))))
            want.add((1000 + 100 * k + percent, k))
    assert {(r["doc_id"], r["item_id"]) for r in find(spark, docs, [(k, " ".join(b)) for k, b in enumerate(bench)])} == want


def test_short_items(spark):
    """Items under SHORT words are found as a run of words, and not across two documents."""
    docs = [(1, "here secret alpha, Words four stand"), (2, "secret alpha words"), (3, "four then"), (4, "alpha secret words four"), (5, "secret secret alpha words four")]
    got = find(spark, docs, [(1, "Secret alpha words four"), (2, "four"), (3, "secret alpha words four"), (4, "...")])
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 2), (1, 3), (3, 2), (4, 2), (5, 1), (5, 2), (5, 3)]


def test_rows_are_dropped_by_id_and_text(spark):
    rng = random.Random(6)
    item = " ".join(prose(rng, 30))
    docs = spark.createDataFrame([(1, "clean words", "a"), (1, f"x {item} y", "b"), (None, item, "c"), (None, "also clean", "d"), (2, None, "e")], "doc_id long, text string, cosine string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted(r["cosine"] for r in dc.without_leaks(docs, bench).collect()) == ["a", "d", "e"]


def spied_space(spark, monkeypatch, docs, bench):
    """The latent space that a search goes by, and its frequencies."""
    seen, build = [], dc.build_index
    monkeypatch.setattr(dc, "build_index", lambda items, freq, space, cosine: seen.append((space, freq)) or build(items, freq, space, cosine))
    find(spark, docs, bench)
    return seen[0]


def test_latent_space_counts_every_passage_of_the_corpus(spark, monkeypatch):
    """Words that occur four times in 800,000 are known to the space, wherever they stand."""
    rng = random.Random(12)
    common = [a + b for a in VOCAB[:60] for b in VOCAB[:50]]
    docs = [rng.choices(common, k=400) for _ in range(2000)]
    marks = [f"mark{i}x" for i in range(300)]
    for m in marks:
        for d in rng.sample(range(2000), 4):
            docs[d].insert(rng.randint(0, len(docs[d])), m)
    space, freq = spied_space(spark, monkeypatch, [(i, " ".join(w)) for i, w in enumerate(docs)], [(1, "an item of a few words without a mark")])
    assert freq.words == sum(map(len, docs))
    assert (space.row[dc.cells_of(dc.word_hashes(pa.array(marks))[0])] >= 0).all()


def test_latent_space_is_that_of_all_distinct_passages(spark, monkeypatch):
    """Singular values against those of the whole matrix; copies of a text and of a passage count once."""
    docs, bench, _ = paraphrases()
    docs = docs[:300] + [(20_000 + i, docs[i % 5][1]) for i in range(100)] + [(30_000 + i, docs[7][1] + " " + docs[8 + i][1]) for i in range(100)]
    space, freq = spied_space(spark, monkeypatch, docs, bench)
    passages = set()
    for _, text in docs + bench:
        cells = dc.cells_of(dc.word_hashes(pa.array([text]))[0]).tolist()
        for at in range(0, max(1, len(cells) - 24) if len(cells) > 48 else 1, 24):
            passages.add(tuple(sorted(cells[at : at + 48])))
    columns = {c: i for i, c in enumerate(sorted({c for p in passages for c in p}))}
    a = np.zeros((len(passages), len(columns)))
    for row, p in zip(a, passages):
        for c, n in collections.Counter(p).items():
            row[columns[c]] = n * freq.idf[c]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    assert np.allclose(space.values[:20], np.linalg.svd(a, compute_uv=False)[:20], rtol=0.02)


def test_arrays_of_the_latent_space_stay_off_the_driver(spark):
    """The driver holds one array of all cells in half precision, not one or two in single."""
    docs, _, _ = paraphrases()
    texts = spark.createDataFrame(docs[:300], "doc_id long, text string")
    words = dc.packed_words(texts.select("text")).localCheckpoint()
    freq = dc.counted(words)
    tracemalloc.start()
    try:
        space = dc.latent_space(words, freq)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (space.row >= 0).any() and most < 3 * dc.CELLS * (dc.RANK + dc.EXTRA)
