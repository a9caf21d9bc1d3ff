import random

from pyspark.sql import functions as F

from lumbre.llm import mixing
from lumbre.llm.mixing import mix, mix_digest


def targets(sizes, weights, share=1.0, epochs=3):
    """Resharing one round after another."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap, full = {s: epochs * sizes[s] for s in names}, set()
    while True:
        rest = [s for s in names if s not in full]
        left = share * sum(sizes.values()) - sum(cap[s] for s in full)
        got = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = {s for s in rest if got[s] > cap[s]}
        if not over:
            return {**{s: float(cap[s]) for s in full}, **got}
        full |= over


def check(rows, sizes, epochs=3, weights=(1, 2, 3)):
    want = targets(sizes, weights, epochs=epochs)
    taken = {s: 0 for s in sizes}
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= epochs * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) < 3


def test_targets_and_budgets(spark):
    random.seed(5)
    rows = []
    for s, n in (("a", 400), ("b", 3), ("c", 40), ("d", 1), ("é", 60), (None, 9)):
        rows += [(len(rows) + i, s, "x " * random.randint(1, 80)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    got = mix_digest(docs).collect()
    assert len(got) == len(rows)
    check(got, sizes)
    assert sorted(got) == sorted(mix_digest(docs.repartition(7)).collect())


def test_levels_decide_like_a_sort(spark):
    """The histogram's threshold keeps the rows that sorting by hash would keep."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"), F.lit("one two").alias("text"))
    rows = mix_digest(docs).withColumn("h", mixing.row_hash(F.col("doc_id"), F.lit("one two"), "mix")).collect()
    for s in "ab":
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: r["h"])
        assert [r["taken"] for r in own] == sorted((r["taken"] for r in own), reverse=True)
        assert len({r["taken"] for r in own}) <= 3


def test_messy(spark, messy, nothing):
    got = mix(messy).collect()
    assert len(got) == messy.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    by = {}
    for r in got:
        by.setdefault(r["source"], [0, 0.0])[0] += r["taken"]
        by[r["source"]][1] = r["target"]
    assert all(abs(n - t) < 4 for n, t in by.values())
    assert mix(messy).columns.count("size") == 1 and "shard" in mix(messy).columns
    assert mix(nothing).count() == 0


def test_one_id_for_all_rows(spark):
    docs = spark.range(500).select(F.lit(1).alias("doc_id"), F.when(F.col("id") < 100, "a").otherwise("b").alias("source"), F.lit("a b c d e f g h").alias("text"))
    got = mix_digest(docs).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"), F.count("*").alias("k")).collect()
    assert all(r["t"] - r["n"] <= r["k"] for r in got)


def test_rows_that_share_an_id_are_told_apart(spark):
    """With one id for all rows, budgets are met but for less than the words of one row."""
    docs = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 100, "a").otherwise("b").alias("source"), F.concat(F.lit("a b t"), F.col("id")).alias("text"))
    got = mix_digest(docs).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(0 <= r["t"] - r["n"] < 3 for r in got)
