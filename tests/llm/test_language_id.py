import zlib

import numpy as np
from pyspark.sql import functions as F

from lumbre.llm import language_id as li


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = li.op4_identify_language(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 30 and np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) >= 0.97


def test_held_out_rows_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    a = li.train(docs.filter(~fold))
    b = li.train(docs.withColumn("lang", F.when(fold, "zz").otherwise(F.col("lang"))).filter(~fold))
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_ngrams_by_brute_force():
    text = "Ab,  cé\n9d"
    cells, counts = li.ngram_counts(text)
    clean = " ab cé d "
    codes = [np.array([ord(c)], np.uint32) for c in clean]
    want = {}
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            cell = int(li._cells(codes[i : i + n])[0])
            want[cell] = want.get(cell, 0) + 1
    assert dict(zip(cells.tolist(), counts.tolist(), strict=True)) == want
    assert li.ngram_counts(None) is None and li.ngram_counts("12 !?") is None and li.ngram_counts("") is None


def test_long_text_is_read_whole(monkeypatch):
    text = "abc déf " * 500 + "zzz"
    whole = li.ngram_counts(text)
    monkeypatch.setattr(li, "PIECE", 101)
    pieces = li.ngram_counts(text)
    assert np.array_equal(whole[0], pieces[0]) and np.array_equal(whole[1], pieces[1])


def test_elastic_net_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        y = i % 2
        cells = np.unique(np.concatenate([rng.integers(0, 400, 20), [500 + y]]))
        x = np.ones(len(cells))
        rows.append((cells, x / np.sqrt(x @ x), y))
    w = li.fit_ftrl(rows, 2, l1=0.3)
    assert w[500, 0] > 0 > w[501, 0] and (w == 0).mean() > 0.98
    assert (li.fit_ftrl(rows, 2, l1=0.0) != 0).sum() > (w != 0).sum()


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    p = np.where(rng.random(4000) < 0.8, y, 1 - y)  # right four times in five, whatever the logits claim
    logits = [np.array([6.0, 0.0]) if k == 0 else np.array([0.0, 6.0]) for k in p]
    t = li.fit_temperature(logits, list(y))
    assert abs(li._softmax(np.array([6.0, 0.0]) / t)[0] - 0.8) < 0.03
    assert li.fit_temperature([], []) == 1.0


def test_messy(spark, messy, nothing, sf_dir):
    model = li.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    got = li.identify(messy, model).collect()
    assert len(got) == messy.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert li.identify(nothing, model).count() == 0
    untaught = li.train(nothing)
    assert {(r["lang_pred"], r["score"]) for r in li.identify(messy, untaught).collect()} == {("und", 0.0)}
    assert li.train(messy.filter("lang = 'pt'")).labels == ["pt"]


def test_sample_is_bounded_and_even(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2900, "aa").otherwise("bb").alias("lang"), F.when(F.col("id") < 2900, "lorem ipsum").otherwise("zwei drei").alias("text"))
    model = li.train(docs, sample_rows=200)
    assert model.labels == ["aa", "bb"] and model.predict(["zwei drei", None, "ipsum", "12"])[0] == ["bb", "und", "aa", "und"]
